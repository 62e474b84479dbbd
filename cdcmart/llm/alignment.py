"""Alignment of the token sequences of two tokenizers: groups of tokens between byte offsets where both have an end.

A byte range of a text yields a fragment: the tokens of both sides that end in it, as an open prefix (up to the first
common end; its group may have begun before the range), closed groups, and an open suffix (behind the last common end;
its group ends in a later range). Fragments form a monoid. Composing closes the group that spans the seam, is
associative, and has the fragment without tokens as its identity, so the fragments of a text may be reduced as a tree.

Texts up to ``LONG_CHARS`` are one range. A longer one is cut into parts at single spaces between two other
characters, where both tokenizers start anew whatever stands around; parts become rows, are tokenised by any task, and
yield fragments of fixed byte ranges, which Spark reduces level by level. Only a run without such a space, however long,
is tokenised by one task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cdcmart.llm.common import map_batches, picked, ship, stored
from cdcmart.llm.pieces import SAFE

LONG_CHARS = 65_536
RANGE_BYTES = 32_768
# Fragments composed by one task at each level of the tree come from this many neighbouring ranges.
FAN_IN = 8
# Most distinct id pairs whose counts are handed to every task (17 bytes each); more are joined by shuffle.
MAX_PAIRS = 1_000_000

# Most pieces whose groups are kept by a task, some 300 bytes each.
KEPT_PIECES = 200_000

FRAGMENT = (
    "row bigint, id {kind}, range bigint, part bigint, ok boolean, bound boolean, prefix_a array<int>, prefix_b array<int>, "
    "closed string, pairs array<bigint>, n_a bigint, n_b bigint, suffix_a array<int>, suffix_b array<int>"
)
# Rows of texts, and one more for each lot of them, without ``row``, that holds how often each pair occurs in the lot.
ALIGNED = (
    "row bigint, id {kind}, n_a bigint, n_b bigint, groups_sha256 string, n_links bigint, pairs binary, "
    "lot_pairs array<bigint>, lot_counts array<bigint>"
)


class Fragment(NamedTuple):
    """``n_a`` and ``n_b`` are tokens in closed groups; ``pairs`` has one link, ``a << 32 | b``, for each of these.
    ``bound`` says whether a common end lies in the range; without one, all tokens are in the prefix."""

    ok: bool = True
    bound: bool = False
    prefix_a: tuple[int, ...] | list[int] = ()
    prefix_b: tuple[int, ...] | list[int] = ()
    closed: str = ""
    pairs: tuple[int, ...] | list[int] | np.ndarray = ()
    n_a: int = 0
    n_b: int = 0
    suffix_a: tuple[int, ...] | list[int] = ()
    suffix_b: tuple[int, ...] | list[int] = ()


def group_text(a, b) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    ok = x.ok and y.ok
    if not x.bound:
        return y._replace(ok=ok, prefix_a=[*x.prefix_a, *y.prefix_a], prefix_b=[*x.prefix_b, *y.prefix_b])
    a, b = [*x.suffix_a, *y.prefix_a], [*x.suffix_b, *y.prefix_b]
    if not y.bound:
        return x._replace(ok=ok, suffix_a=a, suffix_b=b)
    closed = ";".join(t for t in (x.closed, group_text(a, b), y.closed) if t)
    pairs = np.concatenate([np.asarray(x.pairs, np.int64), [a[-1] << 32 | b[-1]], np.asarray(y.pairs, np.int64)])
    n_a, n_b = x.n_a + len(a) + y.n_a, x.n_b + len(b) + y.n_b
    return Fragment(ok, True, x.prefix_a, x.prefix_b, closed, pairs, n_a, n_b, y.suffix_a, y.suffix_b)


def reduced(fragments: list[Fragment]) -> Fragment:
    """Neighbours by pairs, so that no closed part is copied more often than the tree is deep."""
    while len(fragments) > 1:
        fragments = [compose(*fragments[i : i + 2]) if i + 1 < len(fragments) else fragments[i] for i in range(0, len(fragments), 2)]
    return fragments[0] if fragments else Fragment()


def whole(f: Fragment) -> tuple[int, int, str, np.ndarray]:
    """``n_a, n_b, groups_sha256, pairs`` of a text from the fragment of all its bytes. The start of the text is a
    common end, so the prefix is its first group."""
    if not f.ok or not f.bound:
        return 0, 0, "", np.empty(0, np.int64)
    assert not f.suffix_a and not f.suffix_b
    # The fragment of nothing behind an offset 0 where both sides end turns the prefix into a closed group.
    f = compose(Fragment(bound=True), f)
    return f.n_a, f.n_b, hashlib.sha256(f.closed.encode()).hexdigest(), np.asarray(f.pairs, np.int64)


class Aligner:
    """Token ids and token bytes of both sides, and fragments of them."""

    def __init__(self, a: str, b: str):
        self.a = Tokenizer.from_file(public_tokenizers.path(a))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b.vocab_size())]
        self.a_lengths = np.array([len(t) for t in self.a_bytes])
        self.b_lengths = np.array([len(t) for t in self.b_bytes])
        # Of each known piece the groups as text, the numbers of tokens (A above 32 bits of B) and the links; None where
        # a side does not give the piece back.
        self.table: dict[str, tuple[str, int, bytes] | None] = {}
        # What is written for a token inside a group, and for the last one of its side.
        self.words = [f"{i}{mark}" for mark in (",", "|") for i in range(len(self.a_bytes))]
        self.words += [f"{i}{mark}" for mark in (",", ";") for i in range(len(self.b_bytes))]
        self.word_lengths = np.array([len(w) for w in self.words])

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[tuple[bool, np.ndarray, np.ndarray]]:
        """(exact, ids of A, ids of B) of each text behind a space; exact if the bytes of both give that back."""
        of_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        of_b = self.b.encode(texts, num_threads=1)
        out = []
        for text, a, b in zip(texts, of_a, of_b):
            data = b" " + text.encode()
            exact = b"".join(map(self.a_bytes.__getitem__, a)) == data == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((exact, np.array(a, np.int64), np.array(b, np.int64)))
        return out

    def fragment(self, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Fragment:
        """The fragment of the tokens that end in one byte range."""
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not len(common):
            return Fragment(prefix_a=a.tolist(), prefix_b=b.tolist())
        last_a, last_b = np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1
        (p, q), (s, t) = (last_a[0], last_b[0]), (last_a[-1], last_b[-1])
        codes, pairs = self._closed(a, b, last_a, last_b)
        closed = "".join(map(self.words.__getitem__, codes.tolist()))[:-1]
        return Fragment(
            True, True, a[:p].tolist(), b[:q].tolist(), closed, pairs, int(s - p), int(t - q), a[s:].tolist(), b[t:].tolist()
        )

    def _closed(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(what is written for each token, the link of each group) of the groups that end behind ``last_a[1:]`` tokens of
        A and ``last_b[1:]`` of B."""
        (p, q), (s, t) = (last_a[0], last_b[0]), (last_a[-1], last_b[-1])
        pairs = a[last_a[1:] - 1] << 32 | b[last_b[1:] - 1]
        sizes_a, sizes_b = np.diff(last_a), np.diff(last_b)
        # Groups are written side by side: a token of A stands behind the B tokens of earlier groups, one of B behind
        # the A tokens of its own group too.
        codes = np.empty(s - p + t - q, np.int64)
        at_a = np.arange(s - p) + np.repeat(last_b[:-1] - q, sizes_a)
        at_b = np.arange(t - q) + np.repeat(last_a[1:] - p, sizes_b)
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        codes[at_a] = a[p:s]
        codes[at_b] = b[q:t] + 2 * n_a
        codes[at_a[last_a[1:] - 1 - p]] += n_a
        codes[at_b[last_b[1:] - 1 - q]] += n_b
        return codes, pairs

    def text(self, text: str) -> Fragment:
        """The fragment of a whole text."""
        ((exact, a, b),) = self.ids([text])
        return self.fragment(a, np.cumsum(self.a_lengths[a]), b, np.cumsum(self.b_lengths[b])) if exact else Fragment(ok=False)

    def _learn(self, pieces: list[str]) -> None:
        """Put pieces into the table, many in one string: both sides start anew at the space before each, so its end is
        an end of both, and its groups are those up to there."""
        for i in range(0, len(pieces), 1000):
            some = pieces[i : i + 1000]
            ((exact, a, b),) = self.ids([" ".join(some)])
            if not exact:
                if len(some) == 1:
                    self.table[some[0]] = None
                else:
                    half = len(some) // 2
                    self._learn(some[:half])
                    self._learn(some[half:])
                continue
            a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
            common = np.intersect1d(a_ends, b_ends, assume_unique=True)
            last_a, last_b = (np.concatenate([[0], np.searchsorted(e, common) + 1]) for e in (a_ends, b_ends))
            codes, pairs = self._closed(a, b, last_a, last_b)
            closed, links = "".join(map(self.words.__getitem__, codes.tolist())), pairs.tobytes()
            # The group behind which each piece ends, and the tokens and written characters up to there.
            group = np.searchsorted(common, np.cumsum([len(p.encode()) + 1 for p in some])) + 1
            of_a, of_b = last_a[group], last_b[group]
            written = np.cumsum(self.word_lengths[codes])[of_a + of_b - 1]
            counts = (np.diff(of_a, prepend=0) << 32 | np.diff(of_b, prepend=0)).tolist()
            k = at = 0
            for piece, g, w, n in zip(some, group.tolist(), written.tolist(), counts):
                self.table[piece] = (closed[at : w - 1], n, links[8 * k : 8 * g])
                k, at = g, w

    def texts(self, texts: list[str]) -> list[tuple[int, int, str, np.ndarray]]:
        """What ``whole`` gives for the fragment of each text, put together from the closed groups of its pieces. What a
        piece gives is kept; the table starts anew when it is full, which changes the speed only."""
        if len(self.table) > KEPT_PIECES:
            self.table.clear()
        split = [t.split(" ") for t in texts]
        fresh = set().union(*split).difference(self.table)
        odd = {p for p in fresh if not p or p[0].isspace() or p[-1].isspace()}
        if odd:
            # Beside other white space a space is no place to start anew.
            split = [parts if odd.isdisjoint(parts) else SAFE.split(t) for t, parts in zip(texts, split)]
            fresh = set().union(*split).difference(self.table)
        # Pieces with white space at an end, which only ends of texts have, cannot stand in one string with others.
        ragged = [p for p in fresh if p and (p[0].isspace() or p[-1].isspace())]
        self._learn([p for p in fresh.difference(ragged) if p])
        for p in ragged:
            self._learn([p])
        out = []
        for parts in split:
            found = list(map(self.table.__getitem__, parts)) if parts != [""] else [None]
            if None in found:
                out.append((0, 0, "", np.empty(0, np.int64)))
                continue
            groups, counts, pairs = zip(*found)
            n = sum(counts)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append((n >> 32, n & 0xFFFFFFFF, digest, np.frombuffer(b"".join(pairs), np.int64)))
        for p in odd:
            self.table.pop(p, None)
        return out

    def ranges(self, part: str, offset: int, range_bytes: int) -> list[tuple[int, Fragment]]:
        """(number of the byte range, fragment) for a part whose space lies at byte ``offset`` of the text."""
        ((exact, a, b),) = self.ids([part])
        if not exact:
            return [(offset // range_bytes, Fragment(ok=False))]
        a_ends, b_ends = offset + np.cumsum(self.a_lengths[a]), offset + np.cumsum(self.b_lengths[b])
        out = []
        for r in range(offset // range_bytes, (int(a_ends[-1]) - 1) // range_bytes + 1):
            i, j = (np.searchsorted(e, [r * range_bytes + 1, (r + 1) * range_bytes + 1]) for e in (a_ends, b_ends))
            out.append((r, self.fragment(a[slice(*i)], a_ends[slice(*i)], b[slice(*j)], b_ends[slice(*j)])))
        return out


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the others
    for the letters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


@cache
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def parts(text: str, chars: int) -> list[str]:
    """Parts of at least ``chars`` characters, cut at reset points; the space of a cut belongs to the part behind it
    and is left out, as tokenising puts one before every part."""
    out, start = [], 0
    while cut := SAFE.search(text, start + chars):
        out.append(text[start : cut.start()])
        start = cut.end()
    return [*out, text[start:]]


def _record(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _aligned(rows: pa.Array, ids: pa.Array, found: list[tuple[int, int, str, np.ndarray]]) -> pa.RecordBatch:
    """Rows of texts with what ``whole`` gives for each, and the counts of the lot. Links are packed: they are only moved
    until they are looked up again, and counted once per lot, so Spark never sees them one by one."""
    n_a, n_b, digests, links = map(list, zip(*found))
    pack = zstandard.ZstdCompressor(level=1).compress
    pairs, counts = np.unique(np.concatenate(links), return_counts=True)
    n, schema = len(found), _arrow_schema(ALIGNED, ids.type)
    texts = [rows.to_pylist(), ids, n_a, n_b, digests, [len(x) for x in links], [pack(x.tobytes()) for x in links], [None] * n, [None] * n]
    lot = [[None], pa.nulls(1, ids.type), [None], [None], [None], [None], [None], [pairs], [counts]]
    return pa.Table.from_batches([_record(texts, schema), _record(lot, schema)]).combine_chunks().to_batches()[0]


def _unpacked(pairs: pa.Array) -> np.ndarray:
    """The links of all texts of a batch, one after the other."""
    unpack = zstandard.ZstdDecompressor().decompress
    return np.frombuffer(b"".join(unpack(p) for p in pairs.to_pylist()), np.int64)


def _arrow_schema(ddl: str, id_type: pa.DataType) -> pa.Schema:
    """The Arrow form of the schemas above, whose types are few."""
    types = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}
    fields = [field.strip().split(" ", 1) for field in ddl.split(",")]
    return pa.schema([(name, id_type if kind == "{kind}" else types[kind]) for name, kind in fields])


def _by_size(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in order, up to a megabyte of characters at once: tokens take far more than their text."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size > 1 << 20:
            yield some
            some, size = [], 0
    if some:
        yield some


def _short(docs: DataFrame, kind: str, a: str, b: str) -> DataFrame:
    def make():
        own = aligner(a, b)
        row = TaskContext.get().partitionId() << 33

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal row
            found = []
            for some in _by_size([t or "" for t in batch.column("text").to_pylist()]):
                found += own.texts(some)
            rows = range(row, row + len(found))
            row += len(found)
            ids = batch.column("id")
            return _aligned(pa.array(rows, pa.int64()), ids, found)

        step.close = own.table.clear
        return step

    return map_batches(docs, make, ALIGNED.format(kind=kind))


def _cut(docs: DataFrame, kind: str, chars: int) -> DataFrame:
    """Parts of long texts as rows, with the byte offset of each."""

    def make():
        row = TaskContext.get().partitionId() << 33
        schema = [("row", pa.int64()), ("part", pa.int64()), ("offset", pa.int64()), ("text", pa.string())]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal row
            ids = batch.column("id")
            columns, at = ([], [], [], []), []
            for k, text in enumerate(batch.column("text").to_pylist()):
                row, offset = row + 1, 0
                for n, part in enumerate(parts(text, chars)):
                    for column, value in zip(columns, (-row, n, offset, part)):
                        column.append(value)
                    at.append(k)
                    offset += 1 + len(part.encode())
            return _record([*columns, ids.take(pa.array(at, pa.int64()))], pa.schema([*schema, ("id", ids.type)]))

        return step

    return map_batches(docs, make, f"row bigint, part bigint, offset bigint, text string, id {kind}")


def _fragments(cut: DataFrame, kind: str, a: str, b: str, range_bytes: int) -> DataFrame:
    def make():
        own = aligner(a, b)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, ids = [], batch.column("id")
            at = []
            for k, r in enumerate(batch.select(["row", "part", "offset", "text"]).to_pylist()):
                for number, f in own.ranges(r["text"], r["offset"], range_bytes):
                    rows.append((r["row"], number, r["part"], *f))
                    at.append(k)
            row, *rest = map(list, zip(*rows))
            return _record([row, ids.take(pa.array(at, pa.int64())), *rest], _arrow_schema(FRAGMENT, ids.type))

        return step

    return map_batches(cut, make, FRAGMENT.format(kind=kind))


def _level(fragments: DataFrame, kind: str, fan_in: int) -> DataFrame:
    """Fragments of ``fan_in`` neighbouring ranges composed into one."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("range", "ascending"), ("part", "ascending")])
        f = reduced([Fragment(**r) for r in table.select(Fragment._fields).to_pylist()])
        schema = _arrow_schema(FRAGMENT, table.schema.field("id").type)
        row = [table["row"][0].as_py(), table["id"][0].as_py(), table["range"][0].as_py() // fan_in, 0, *f]
        return pa.Table.from_batches([_record([[v] for v in row], schema)])

    ship(fragments.sparkSession)
    return fragments.groupBy("row", (F.col("range") / fan_in).cast("bigint").alias("above")).applyInArrow(run, FRAGMENT.format(kind=kind))


def _long(docs: DataFrame, kind: str, a: str, b: str, range_bytes: int, fan_in: int) -> DataFrame:
    spark = docs.sparkSession
    cut = stored(_cut(docs, kind, range_bytes), "alignment_parts")
    # Parts of one text lie side by side; dealt anew, they are worked on by all tasks.
    dealt = cut.repartition(max(1, spark.sparkContext.defaultParallelism), "row", "part")
    at = stored(_fragments(dealt, kind, a, b, range_bytes), "alignment_fragments")
    last = at.agg(F.max("range")).first()[0]
    levels = 0 if last is None else 1 + math.ceil(math.log(last + 1, fan_in))
    for _ in range(levels):
        at = stored(_level(at, kind, fan_in), "alignment_fragments")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [whole(Fragment(**r)) for r in batch.select(Fragment._fields).to_pylist()]
            ids = batch.column("id")
            return _aligned(batch.column("row"), ids, found)

        return step

    return map_batches(at, make, ALIGNED.format(kind=kind))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: the links that hold the pair in the whole table, and whether no pair of its B id has more."""
    lots = aligned.where("row IS NULL").select(F.inline(F.arrays_zip(F.col("lot_pairs").alias("pair"), F.col("lot_counts").alias("n"))))
    counts = stored(lots.groupBy("pair").agg(F.sum("n").alias("n")), "alignment_pairs")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    # One row for each id of B: as many as its vocabulary has, so it may go to every task.
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("b", b).join(F.broadcast(most), "b")
    return stored(joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment_counts")


def _sums_by_lookup(aligned: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    table = counts.orderBy("pair").toArrow()
    arrays = aligned.sparkSession.sparkContext.broadcast(
        (table["pair"].to_numpy(), table["n"].to_numpy(), table["best"].to_numpy().astype(bool))
    )

    def make():
        pair, n, best = arrays.value
        # Sums over the links up to each place, so that texts of any length and number are summed at once.
        def sums(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
            total = np.concatenate([[0], np.cumsum(values)])
            return pa.array(total[offsets[1:]] - total[offsets[:-1]], pa.int64())

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = np.searchsorted(pair, _unpacked(batch.column("pairs")))
            columns = [batch.column(c) for c in ("id", "n_a", "n_b", "groups_sha256", "n_links")]
            offsets = np.concatenate([[0], np.cumsum(batch.column("n_links").to_numpy())])
            best_sum, n_sum = (sums(v[at].astype(np.int64), offsets) for v in (best, n))
            return pa.RecordBatch.from_arrays([*columns, best_sum, n_sum], ["id", "n_a", "n_b", "groups_sha256", "n_links", "n_best", "count_sum"])

        return step

    schema = f"id {kind}, n_a bigint, n_b bigint, groups_sha256 string, n_links bigint, n_best bigint, count_sum bigint"
    return map_batches(aligned, make, schema)


def _sums_by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by shuffle: distinct pairs of each text with their number, joined with the counts. Both sides of the
    join are written tables, so that adaptive execution can split a pair that nearly every text has."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            links, sizes = _unpacked(batch.column("pairs")), batch.column("n_links").to_numpy()
            found = [np.unique(x, return_counts=True) for x in np.split(links, np.cumsum(sizes)[:-1])]
            rows = np.repeat(batch.column("row").to_numpy(), [len(p) for p, _ in found])
            return pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(np.concatenate(c)) for c in zip(*found))], ["row", "pair", "times"])

        return step

    own = stored(map_batches(aligned.select("row", "n_links", "pairs"), make, "row bigint, pair bigint, times bigint"), "alignment_own")
    joined = own.join(counts, "pair")
    per_row = joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    zero = F.lit(0).cast("bigint")
    return aligned.join(per_row, "row", "left").select(
        "id", "n_a", "n_b", "groups_sha256", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
    )


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model",
    long_chars: int = LONG_CHARS, range_bytes: int = RANGE_BYTES, fan_in: int = FAN_IN, max_pairs: int = MAX_PAIRS,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Both tokenizers read each text behind one space. A group is what lies between two neighbouring offsets where both
    end; its last tokens are its link, as tokens are never empty. ``n_best`` are the links whose pair is as frequent
    as any pair of the same B id in the whole table (ties count), ``count_sum`` the sum of the links' frequencies.

    NULL and empty texts, and texts that the tokens of one side do not give back byte by byte, have zeros and an empty
    digest, and add nothing to the counts. Repeated rows and NULL keys give a row each and count each time. An empty
    table gives no rows. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = picked(docs, id_col, text_col)
    is_long = F.coalesce(F.length("text"), F.lit(0)) > long_chars
    short = _short(rows.where(~is_long), kind, a, b)
    long = _long(rows.where(is_long), kind, a, b, range_bytes, fan_in)
    aligned = stored(short.union(long), "aligned")
    counts = pair_counts(aligned)
    few = counts.limit(max_pairs + 1).count() <= max_pairs
    texts = aligned.where("row IS NOT NULL").drop("lot_pairs", "lot_counts")
    sums = _sums_by_lookup(texts, counts, kind) if few else _sums_by_join(texts, counts)
    return sums.select(
        F.col("id").alias(id_col), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256"
    )
