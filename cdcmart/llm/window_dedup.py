"""Removal of repeated word passages: every word under a window of 50 words that also starts in a document of lesser id.

The minimiser of a window is its q-gram of words with the least hash, the first one of equals. Equal windows have equal
minimisers, and consecutive windows of a text that share theirs form a super-k-mer, which travels as one packed string
of words to the bucket of that minimiser. In the bucket the windows of all strings are sorted, so equal ones stand side
by side and the least id among them is known exactly.

* Only minimisers that lie in documents of different ids can decide anything, so the strings of all others stay where
  they are; finding out takes one number per super-k-mer.
* Equal strings of a bucket are one row before they travel further, with the least id of their documents, so a group of
  copies of any size is one string for each of its super-k-mers.
* A bucket with more than ``LARGE_BUCKET`` different strings is split by window instead: the windows of its strings
  become rows under 128-bit identifiers, and their least ids come from a partially aggregated minimum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import map_batches, picked, ship, stored

WINDOW, GRAM = 50, 8
# Most different strings of a minimiser that are sorted together: some 80,000 windows, of a few hundred bytes each.
LARGE_BUCKET = 2_000
# Longer words travel as a tab, which no word holds, and their SHA-256.
LONG_WORD = 64
U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes are split at just the six separators


def packed_word(word: bytes) -> bytes:
    return word if len(word) <= LONG_WORD else b"\t" + hashlib.sha256(word).hexdigest().encode()


def minimisers(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window the hash of its minimiser and the word where that starts. ``hashes`` are those of the words."""
    with np.errstate(over="ignore"):
        h = hashes[: len(hashes) - gram + 1].copy()
        for k in range(1, gram):
            h = _mix(h * U(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - gram + 1 + k])
    at = np.arange(len(h))
    width, span = 1, window - gram + 1

    def least(shift: int):
        nonlocal h, at
        left, right = h[:-shift], h[shift:]
        later = right < left  # of equals the first stays
        h, at = np.where(later, right, left), np.where(later, at[shift:], at[:-shift])

    while 2 * width <= span:
        least(width)
        width *= 2
    if span > width:
        least(span - width)
    return h, at


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


class Runs:
    """The super-k-mers of a text: ``key`` (of the minimiser), first window, number of windows."""

    def __init__(self, text: str | None, window: int, gram: int, kept: dict[bytes, int]):
        words = words_of(text)
        self.words, self.window = words, window
        if len(words) < window:
            self.key = self.first = self.count = np.empty(0, np.int64)
            return
        for word in set(words).difference(kept):
            kept[word] = word_hash(word)
        key, at = minimisers(np.fromiter(map(kept.__getitem__, words), U, len(words)), window, gram)
        self.first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.count = np.diff(np.concatenate([self.first, [len(at)]]))
        self.key = key[self.first].view(np.int64)

    def packed(self, i: int) -> bytes:
        first = int(self.first[i])
        return b" ".join(map(packed_word, self.words[first : first + int(self.count[i]) + self.window - 1]))


def _runs_of(window: int, gram: int):
    """Runs of texts; hashes of words are kept from text to text, up to a bound."""
    kept: dict[bytes, int] = {}

    def of(text: str | None) -> Runs:
        if len(kept) > 200_000:
            kept.clear()
        return Runs(text, window, gram, kept)

    return of


def windows(string: bytes, window: int) -> list[bytes]:
    """The windows of a packed string, in order."""
    spaces = [-1, *(i for i, c in enumerate(string) if c == 0x20), len(string)]
    return [string[spaces[i] + 1 : spaces[i + window]] for i in range(len(spaces) - window)]


def least_ids(strings: list[tuple[bytes, object]], window: int) -> list[list]:
    """For every window of every string of a bucket the least id of a string that holds it: windows are sorted, and
    those of equal words stand side by side."""
    parts = [windows(string, window) for string, _ in strings]
    out = [[i] * len(part) for part, (_, i) in zip(parts, strings)]
    if len(strings) == 1:
        return out
    order = sorted((w, i, s, k) for s, (part, (_, i)) in enumerate(zip(parts, strings)) for k, w in enumerate(part))
    for _, equal in groupby(order, itemgetter(0)):
        first = next(equal)
        for _, _, s, k in equal:
            out[s][k] = first[1]
    return out


def _identity(string: bytes) -> bytes:
    return xxhash.xxh3_128_digest(string)


def _keys(docs: DataFrame, kind: str, window: int, gram: int) -> DataFrame:
    """``id, h, key`` for each minimiser of each text."""

    def make():
        runs = _runs_of(window, gram)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.unique(runs(t).key) for t in batch.column("text").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
            return pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("h").take(at), pa.array(np.concatenate(found))], ["id", "h", "key"])

        return step

    return map_batches(docs, make, f"id {kind}, h bigint, key bigint")


def _cut(docs: DataFrame, kind: str, window: int, gram: int) -> DataFrame:
    """``docs`` have the column ``keys``: minimisers that other documents have too. One row for each super-k-mer of
    these, and one for each text: with its digest where nothing can be removed from it, else with its words."""

    def make():
        runs = _runs_of(window, gram)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, at = [], []
            for k, (text, keys) in enumerate(zip(batch.column("text").to_pylist(), batch.column("keys").to_pylist())):
                if not keys:
                    words = words_of(text)
                    rows.append((None, None, None, None, None, len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
                    at.append(k)
                    continue
                r = runs(text)
                rows.append((None, None, None, None, b" ".join(r.words), len(r.words), None))
                at.append(k)
                for i in np.flatnonzero(np.isin(r.key, keys)).tolist():
                    string = r.packed(i)
                    rows.append((int(r.key[i]), int(r.first[i]), _identity(string), string, None, None, None))
                    at.append(k)
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.string()]
            names = ["key", "first", "string_id", "string", "words", "n_words", "digest"]
            at = pa.array(at, pa.int64())
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("h").take(at), *columns], ["id", "h", *names])

        return step

    schema = f"id {kind}, h bigint, key bigint, first bigint, string_id binary, string binary, words binary, n_words bigint, digest string"
    return map_batches(docs, make, schema)


def _in_buckets(strings: DataFrame, kind: str, window: int) -> DataFrame:
    """``string_id, least``: for each window of a string the least id of a document that holds it. Rows come sorted by
    bucket, so one bucket at a time is held, and the last of a batch waits for the next."""

    def found(table: pa.Table) -> pa.RecordBatch:
        key = table["key"].to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        string, ids = table["string"].to_pylist(), table["least_id"].to_pylist()
        least = []
        for i, j in zip(cuts, cuts[1:]):
            least += least_ids(list(zip(string[i:j], ids[i:j])), window)
        lists = pa.list_(table.schema.field("least_id").type)
        return pa.RecordBatch.from_arrays([table["string_id"].combine_chunks(), pa.array(least, lists)], ["string_id", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                table = pa.Table.from_batches([batch.slice(start, 1000)])
                table = table if waiting is None else pa.concat_tables([waiting, table])
                key = table["key"].to_numpy()
                last = int(np.searchsorted(key, key[-1]))
                if last:
                    yield found(table.slice(0, last).combine_chunks())
                waiting = table.slice(last)
        if waiting is not None:
            yield found(waiting.combine_chunks())

    ship(strings.sparkSession)
    dealt = strings.select("key", "string_id", "string", "least_id").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, f"string_id binary, least array<{kind}>")


def _by_window(strings: DataFrame, kind: str, window: int) -> DataFrame:
    """The same for strings of large buckets: their windows meet under identifiers, not in the bucket."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [[_identity(w) for w in windows(s, window)] for s in batch.column("string").to_pylist()]
            at = pa.array([k for k, f in enumerate(found) for _ in f], pa.int64())
            place = pa.array([i for f in found for i in range(len(f))], pa.int64())
            own = pa.array([w for f in found for w in f], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column("string_id").take(at), batch.column("least_id").take(at), place, own], ["string_id", "least_id", "place", "window"])

        return step

    rows = stored(map_batches(strings.select("string_id", "string", "least_id"), make, f"string_id binary, least_id {kind}, place bigint, window binary"), "windows")
    # Only windows of strings with different ids say anything. They are written first, so that the join can split a
    # window that very many strings hold.
    least = rows.groupBy("window").agg(F.min("least_id").alias("least"), F.max("least_id").alias("most"))
    shared = stored(least.where("least < most").select("window", "least"), "windows_shared")
    lower = rows.join(shared, "window").where(F.col("least") < F.col("least_id"))
    places = stored(lower.groupBy("string_id").agg(F.map_from_entries(F.collect_list(F.struct("place", "least"))).alias("lower")), "windows_lower")
    # Windows of a string, counted by the spaces in it; where no lesser id is known, its own least one holds.
    n = F.length(F.col("string")) - F.length(F.replace(F.col("string").cast("string"), F.lit(" "), F.lit("")).cast("binary")) + 2 - window
    every = F.transform(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1), lambda i: F.coalesce(F.try_element_at("lower", i), F.col("least_id")))
    return strings.join(places, "string_id", "left").select("string_id", every.alias("least"))


def _removed(docs: DataFrame, kind: str, window: int) -> DataFrame:
    """Texts with ``spans`` of words to be removed, ``[first, behind)``, which may overlap."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_words, removed, digest = [], [], []
            for data, spans in zip(batch.column("words").to_pylist(), batch.column("spans").to_pylist()):
                words = data.split(b" ") if data else []
                depth = np.zeros(len(words) + 1, np.int64)
                for span in spans or ():
                    depth[span["from"]] += 1
                    depth[span["to"]] -= 1
                gone = np.cumsum(depth[:-1]) > 0
                n_words.append(len(words))
                removed.append(int(gone.sum()))
                kept = [words[i] for i in np.flatnonzero(~gone).tolist()] if removed[-1] else words
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            columns = [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept_sha256"])

        return step

    return map_batches(docs, make, f"id {kind}, n_words bigint, n_removed bigint, kept_sha256 string")


def remove_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, large_bucket: int = LARGE_BUCKET,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_words, n_removed, kept_sha256`` (of the kept words joined by a space).

    A word goes if a window of ``window`` words over it starts in a document of lesser id too, whatever becomes of that
    one. NULL texts have no words. Rows that share an id are one document: they take nothing from each other, and each
    loses what lesser ids hold. A row without an id is neither less nor greater than any: it keeps all and takes
    nothing. Texts of fewer than ``window`` words keep all. An empty table gives no rows. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    # The hash tells texts apart that share an id; equal texts of one id have equal results.
    rows = picked(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    known = rows.where("id IS NOT NULL")
    keys = stored(_keys(known, kind, window, gram), "minimisers")
    shared = stored(keys.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("key"), "minimisers_shared")
    per_text = stored(keys.distinct().join(shared, "key").groupBy("id", "h").agg(F.collect_list("key").alias("keys")), "minimisers_of_texts")
    cut = stored(_cut(rows.join(per_text, ["id", "h"], "left"), kind, window, gram), "super_k_mers")

    placed = cut.where("key IS NOT NULL")
    strings = stored(placed.groupBy("key", "string_id", "string").agg(F.min("id").alias("least_id")), "strings")
    large = stored(strings.groupBy("key").count().where(F.col("count") > large_bucket).select("key"), "large_buckets")
    found = stored(
        _in_buckets(strings.join(large, "key", "left_anti"), kind, window).union(_by_window(strings.join(large, "key", "left_semi"), kind, window)), "least_ids"
    )

    # Runs of windows that a lesser id holds, as spans of words.
    held = F.transform("least", lambda x: x < F.col("id"))
    at = F.sequence(F.lit(0), F.size("least") - 1)
    begins = F.filter(at, lambda i: F.get(held, i) & ~F.coalesce(F.get(held, i - 1), F.lit(False)))
    ends = F.filter(at, lambda i: F.get(held, i) & ~F.coalesce(F.get(held, i + 1), F.lit(False)))
    span = F.transform(F.arrays_zip(begins.alias("i"), ends.alias("j")), lambda s: F.struct((F.col("first") + s["i"]).alias("from"), (F.col("first") + s["j"] + window).alias("to")))
    spans = placed.select("id", "h", "first", "string_id").distinct().join(found, "string_id").select("id", "h", F.explode(span).alias("span"))
    per_text = stored(spans.groupBy("id", "h").agg(F.collect_list("span").alias("spans")), "spans")

    whole = cut.where("digest IS NOT NULL").select("id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), F.col("digest").alias("kept_sha256"))
    texts = cut.where("words IS NOT NULL").select("id", "h", "words").join(per_text, ["id", "h"], "left")
    return whole.union(_removed(texts, kind, window)).withColumnRenamed("id", id_col)
