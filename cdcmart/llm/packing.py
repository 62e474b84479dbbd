"""Packing of tokenised documents into fixed-length sequences: shortest pack first over the length histogram.

Documents are cut into pieces of at most ``size`` tokens. Only the histogram of the piece lengths, at most ``size``
numbers, is packed on the driver: lengths longest first, each into the shortest open pack that it fits into, whole
runs of equal packs at a time. The result is a short list of patterns with counts. Pieces find their place in it by
their rank among the pieces of their length.
"""

from __future__ import annotations

import heapq
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cdcmart.llm.common import map_batches, picked, stored
from cdcmart.llm.pieces import PieceNumbers

END_ID = 1
# Rows of one length ranked by one task.
RANKED_TOGETHER = 20_000
# Most pieces and ids kept, and what stays of both when they are full and between tasks. They change the speed only.
KEPT_PIECES, KEPT_IDS = 400_000, 8 << 20
STAYING_PIECES, STAYING_IDS = 200_000, 2 << 20
# Pieces encoded in one string; pieces whose ids are put together at once.
JOINED = 200
GATHERED = 1 << 16


class Encoder:
    """Token ids of texts, as little-endian 32-bit numbers.

    Pieces are numbered as they are met; ``starts`` and ``lengths`` say where the ids of each number lie in ``kept``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids of tokens that begin with a space
        self.opens[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.numbers = PieceNumbers()
        self.kept = np.empty(0, "<u4")
        self.starts = self.lengths = np.empty(0, np.int64)
        self.again = np.empty(0, bool)  # pieces met by more than one call

    def thin(self) -> None:
        """Only pieces that were met again stay, and not too many of those: all others cost less to encode anew than to
        keep until they come back, if they do."""
        keep = np.flatnonzero(self.again)[:STAYING_PIECES]
        keep = keep[np.cumsum(self.lengths[keep]) <= STAYING_IDS]
        number = np.full(len(self.again), -1)
        number[keep] = np.arange(len(keep))
        numbers = number.tolist()
        self.kept = self._gathered(keep)
        self.lengths = self.lengths[keep]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.again = np.zeros(len(keep), bool)
        self.numbers.restart({p: numbers[k] for p, k in self.numbers.known.items() if numbers[k] >= 0})

    def _gathered(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of the pieces, one after the other."""
        out = [np.empty(0, "<u4")]
        for at in range(0, len(numbers), GATHERED):
            some = numbers[at : at + GATHERED]
            n = self.lengths[some]
            to = np.cumsum(n)
            if to[-1] <= 16 * GATHERED:
                out.append(self.kept[np.repeat(self.starts[some] - to + n, n) + np.arange(to[-1])])
            else:  # long pieces are not worth a position for each id
                out += [self.kept[a:b] for a, b in zip(self.starts[some].tolist(), (self.starts[some] + n).tolist())]
        return np.concatenate(out)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, texts: list[str]) -> None:
        """Encode the texts that got the next numbers. Those with one space, at the beginning, are encoded many at a
        time, in one string, and told apart by the tokens that begin with a space."""
        spaced = [i for i, t in enumerate(texts) if t[:1] == " " and t.count(" ") == 1]
        single = set(range(len(texts))).difference(spaced)
        order, parts, lengths = [], [], []
        for i in range(0, len(spaced), JOINED):
            some = spaced[i : i + JOINED]
            ids = self._ids(["".join([texts[k] for k in some])])[0]
            bounds = np.flatnonzero(self.opens[ids])
            if len(bounds) == len(some) and bounds[0] == 0:
                order += some
                parts.append(ids)
                lengths.append(np.diff(bounds, append=len(ids)))
            else:
                single.update(some)
        rest = sorted(single)
        each = [ids for i in range(0, len(rest), 1000) for ids in self._ids([texts[k] for k in rest[i : i + 1000]])]
        order += rest
        n = np.concatenate([*lengths, np.array([len(ids) for ids in each], np.int64)])
        starts, ordered = np.empty((2, len(texts)), np.int64)
        starts[order], ordered[order] = len(self.kept) + np.cumsum(n) - n, n
        self.kept = np.concatenate([self.kept, *parts, *each])
        self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, ordered])
        self.again = np.concatenate([self.again, np.zeros(len(texts), bool)])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.lengths) > KEPT_PIECES or len(self.kept) > KEPT_IDS:
            self.thin()
        numbers, counts = self.numbers.of(texts)
        self.again[numbers[numbers < len(self.again)]] = True
        self._learn(self.numbers.taken())
        ids = memoryview(self._gathered(numbers)).cast("B")
        ends = np.concatenate([[0], np.cumsum(self.lengths[numbers])])
        bounds = (4 * ends[np.concatenate([[0], np.cumsum(counts)])]).tolist()
        return [bytes(ids[a:b]) for a, b in zip(bounds, bounds[1:])]


@cache
def encoder(name: str) -> Encoder:
    return Encoder(public_tokenizers.path(name))


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, size: int) -> DataFrame:
    """``id, start, length, ids_crc32, doc_tokens`` of every piece: a document is cut every ``size`` tokens."""

    def make():
        own = encoder(tokenizer)
        encode = own.encode
        end = np.array([END_ID], "<u4").tobytes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, start, length, crc, total = [], [], [], [], []
            for k, ids in enumerate(encode([t or "" for t in batch.column("text").to_pylist()])):
                ids += end
                n = len(ids) // 4
                for at in range(0, n, size):
                    part = ids[4 * at : 4 * (at + size)]
                    rows.append(k)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
            longs = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            return pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows, pa.int64())), *longs], names)

        step.close = own.thin
        return step

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return map_batches(picked(docs, id_col, text_col), make, schema)


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths in the pack) of every pattern.

    Lengths go longest first into the shortest open pack with room. If there is none, packs are opened and filled with
    this length as placing one by one would fill them."""
    by_total: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    totals: list[int] = []

    def put(count: int, pack: tuple[int, ...], total: int) -> None:
        if count:
            if not by_total.get(total):
                by_total[total] = []
                heapq.heappush(totals, total)
            by_total[total].append((count, pack))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while totals and not by_total.get(totals[0]):
                heapq.heappop(totals)
            if totals and totals[0] + length <= size:
                total = totals[0]
                count, pack = by_total[total].pop()
                used = min(count, left)
                put(count - used, pack, total)
                put(used, (*pack, length), total + length)
                left -= used
            else:
                times = size // length
                put(left // times, (length,) * times, length * times)
                rest = left % times
                put(1 if rest else 0, (length,) * rest, length * rest)
                left = 0
    return [entry for total in sorted(by_total) for entry in by_total[total]]


def places(patterns: list[tuple[int, tuple[int, ...]]], size: int) -> dict[str, np.ndarray]:
    """Patterns as ranges of ranks: the pieces of ``length`` with ranks from ``rank`` on lie in the sequences from
    ``sequence`` on, one each, at ``offset``. Sorted by length and rank."""
    rows: list[tuple[int, int, int, int]] = []
    ranked: dict[int, int] = {}
    sequence = 0
    for count, pack in patterns:
        offset = 0
        for length in pack:
            rows.append((length, ranked.get(length, 0), sequence, offset))
            ranked[length] = ranked.get(length, 0) + count
            offset += length
        sequence += count
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T.copy()))


def ranked(parts: DataFrame) -> DataFrame:
    """``parts`` with ``rank``: a number from 0 for each row among those of its length.

    A length may hold any share of the rows, so it is split into buckets by hash. Only the counts of the buckets meet
    in one place; inside a bucket a window numbers the rows."""
    n = parts.count()
    buckets = max(1, -(-n // RANKED_TOGETHER))
    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64("id", "start"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").count()
    before = counts.select("length", "bucket", (F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")).alias("before"))
    numbered = dealt.withColumn("inside", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("id", "start", "ids_crc32")) - 1)
    return numbered.join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("inside"))


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json", size: int = 2048,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every row of ``docs`` gives pieces, repeated rows and NULL keys too; a NULL or empty text is the end id alone. An
    empty table gives no rows. Sequences are numbered from 0 and filled without gaps from offset 0.
    """
    parts = stored(pieces(docs, id_col, text_col, tokenizer, size), "pieces")
    histogram = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}  # at most `size` rows
    table = places(pack_histogram(histogram, size), size)

    def make():
        # The largest rank of any length bounds the keys, so one sorted array serves all lengths.
        span = int(max(histogram.values(), default=0)) + 1
        keys = table["length"] * span + table["rank"]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * span + rank, "right") - 1
            sequence = table["sequence"][at] + rank - table["rank"][at]
            kept = [batch.column(c) for c in ("id", "start", "length", "ids_crc32", "doc_tokens")]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(table["offset"][at])], names)

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    columns = ["id", "start", "length", "ids_crc32", "doc_tokens", "rank"]
    packed = map_batches(ranked(parts).select(*columns), make, schema)
    return packed.withColumnRenamed("id", id_col)
