"""Removal of repeated passages: every byte under a 200-byte string that starts twice or more in the corpus.

Suffixes are sorted into buckets by what they begin with, and buckets are refined as far as 200 bytes, in the manner of
bucket-pointer refinement: the identifier of a longer beginning is made of identifiers at later offsets (of 2k bytes:
those of k bytes at 0 and k), which are at hand from the round before, a bucket is named by a pointer to its first
member, buckets of one are final, and only the others are sorted again. Three things keep this within linear, small
shuffles:

* Suffixes that start near each other are sorted together. A window of 200 bytes is filed under its anchor, the q-gram
  in it with the least hash. Equal windows have equal anchors at equal offsets, so windows of different anchors need
  never be compared. Neighbouring windows of one anchor form a run.
* Round 1 buckets the runs by the q-gram at their anchor. Round 2 refines by all bytes of a run: if that is repeated,
  so are all windows of the run, and one member goes on to stand for the bucket where other runs of the same q-gram
  are undecided. Undecided runs are split into blocks, aligned at the anchor, and round 3 buckets these by the bytes
  that all windows of a block share and refines by all bytes of the block; round 4 sorts the windows of the blocks
  that are left, about one for each end of a repeated passage.
* Identifiers are 64-bit hashes, computed where the text is, so what is shuffled has a fixed size.

Windows never cross texts. Counting is by partial sums and joins, so a bucket of any size is spread over tasks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.llm.common import map_batches, picked, stored

LENGTH, GRAM, BLOCK = 200, 32, 16
ANCHORS = LENGTH - GRAM + 1  # q-grams in a window; less than 256, as places in a run are kept in a byte
PLACE_BITS = 26  # of a position in the text taken at once
TEXT_AT_ONCE = 1 << 22

U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


with np.errstate(over="ignore"):
    BYTES = _mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
    FACTORS = {1 << k: U(2) * _mix(np.array([k + 1000], U))[0] + U(1) for k in range(7)}


def identifiers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the strings of GRAM and of 128 bytes at every position, by doubling. ``data`` is lengthened by
    zeros so that both are defined everywhere."""
    h = BYTES[np.concatenate([data, np.zeros(128, np.uint8)])]
    grams = None
    for k in (1, 2, 4, 8, 16, 32, 64):
        h = h[:-k] * FACTORS[k] + h[k:]
        if 2 * k == GRAM:
            grams = h
    return grams, h


def span_ids(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Identifiers of strings of 128 to 384 bytes from those of 128 at three offsets that cover them."""
    last = end - 128
    return _mix(h[start] + _mix(h[np.minimum(start + 128, last)] + _mix(h[last] + (end - start).astype(U)))).view(np.int64)


def runs(data: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of the windows of texts that lie one behind the other in ``data``: text number, start, number of windows,
    offset of the anchor, identifiers of the anchor's q-gram and of the run."""
    grams, h = identifiers(data)
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    n = len(data)
    least = _mix(grams) >> U(PLACE_BITS) << U(PLACE_BITS) | np.arange(len(grams), dtype=U)
    k = 1
    while 2 * k <= ANCHORS:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    least = np.minimum(least[: len(least) - (ANCHORS - k)], least[ANCHORS - k :])
    anchor = np.zeros(n + 1, np.int64)
    m = min(n, len(least))
    anchor[:m] = (least[:m] & U((1 << PLACE_BITS) - 1)).astype(np.int64)
    long = lengths >= LENGTH
    edge = np.zeros(n + 2, np.int64)
    np.add.at(edge, offsets[long], 1)
    np.add.at(edge, (offsets + lengths - LENGTH + 1)[long], -1)
    inside = np.cumsum(edge)[: n + 1] > 0
    # A text's first window opens a run as well: it may follow the last window of the text before.
    opens = inside.copy()
    opens[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    opens[offsets[long]] = True
    start = np.flatnonzero(opens)
    closes = np.append(opens[1:], True) | ~np.append(inside[1:], False)
    stop = np.flatnonzero(inside & closes) + 1
    # Texts without bytes share an offset with the next one; the last of equal offsets is the one that has bytes.
    text = np.searchsorted(offsets, start, "right") - 1
    end = stop - 1 + LENGTH
    return {
        "text": text, "s": start - offsets[text], "n": stop - start, "a": anchor[start] - start,
        "key": grams[anchor[start]].view(np.int64), "whole": span_ids(h, start, end),
    }


def _checked(text: str) -> tuple[bytes, int]:
    data = text.encode()
    crc = zlib.crc32(data)
    return data, crc - (1 << 32) if crc >= 1 << 31 else crc


def _together(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts taken together up to a size, or alone: (number of the first, bytes, lengths)."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= TEXT_AT_ONCE):
            size += len(texts[stop])
            stop += 1
        yield at, np.frombuffer(b"".join(texts[at:stop]), np.uint8), np.array([len(t) for t in texts[at:stop]], np.int64)
        at = stop


def _parts(text: bytes) -> Iterator[tuple[int, bytes]]:
    """A text in parts small enough for positions of PLACE_BITS; parts overlap so that each window lies in one."""
    step = (1 << PLACE_BITS) // 2
    for at in range(0, max(1, len(text) - LENGTH + 1), step):
        yield at, text[at : at + step + LENGTH - 1]


def all_runs(docs: DataFrame) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            checked = [_checked(t or "") for t in batch.column("text").to_pylist()]
            owner, base, parts = [], [], []
            for k, (data, _) in enumerate(checked):
                for at, part in _parts(data):
                    owner.append(k)
                    base.append(at)
                    parts.append(part)
            owner, base = np.array(owner), np.array(base)
            out: dict[str, list[np.ndarray]] = {c: [] for c in ("k", "s", "n", "a", "key", "whole")}
            for first, data, lengths in _together(parts):
                if not (lengths >= LENGTH).any():
                    continue
                with np.errstate(over="ignore"):
                    r = runs(data, lengths)
                at = r["text"] + first
                for c, v in (("k", owner[at]), ("s", r["s"] + base[at]), *((c, r[c]) for c in ("n", "a", "key", "whole"))):
                    out[c].append(v)
            v = {c: np.concatenate(x) if x else np.zeros(0, np.int64) for c, x in out.items()}
            crc = np.array([c for _, c in checked], np.int32)
            columns = [
                batch.column("id").take(pa.array(v["k"], pa.int64())), pa.array(crc[v["k"]], pa.int32()), pa.array(v["s"], pa.int64()),
                pa.array(v["n"].astype(np.int32)), pa.array(v["a"].astype(np.int32)), pa.array(v["key"]), pa.array(v["whole"]),
            ]
            return pa.RecordBatch.from_arrays(columns, ["id", "h", "s", "n", "a", "key", "whole"])

        return step

    kind = docs.schema["id"].dataType.simpleString()
    return map_batches(docs, make, f"id {kind}, h int, s bigint, n int, a int, key bigint, whole bigint")


def compressed(docs: DataFrame) -> DataFrame:
    """Texts for the joins by document, as their bytes packed."""

    def make():
        pack = zstandard.ZstdCompressor(level=3).compress

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            checked = [_checked(t or "") for t in batch.column("text").to_pylist()]
            columns = [batch.column("id"), pa.array([c for _, c in checked], pa.int32()), pa.array([pack(d) for d, _ in checked], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["id", "h", "z"])

        return step

    kind = docs.schema["id"].dataType.simpleString()
    return map_batches(docs, make, f"id {kind}, h int, z binary")


def _unpack(column: pa.Array) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(z) for z in column.to_pylist()]


def _by_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.withColumnsRenamed({"id": "other_id", "h": "other_h"})
    return left.join(right, left["id"].eqNullSafe(right["other_id"]) & (left["h"] == right["other_h"]), how).drop("other_id", "other_h")


def bucketed(rows: DataFrame, by: str, member: str) -> DataFrame:
    """``rows`` with the size of their bucket and whether the pointer of the bucket, its least member, is theirs."""
    # Written first: adaptive execution splits a hot bucket only where both sides of the join are plain shuffles.
    sizes = stored(rows.groupBy(by).agg(F.count("*").alias("size"), F.min(member).alias("pointer")).where("size > 1"), "bucket_sizes")
    return rows.join(sizes, by, "left").withColumns({"size": F.coalesce("size", F.lit(1)), "first": F.col("pointer").eqNullSafe(F.col(member))}).drop("pointer")


def _released(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what has been written: it does once the plans are collected."""
    spark.sparkContext._jvm.System.gc()


def contents(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes of the runs ``wanted`` (id, h, s, n, a), numbered: ``r, id, h, s, n, a, bytes``."""
    lists = wanted.dropDuplicates(["id", "h", "s"]).groupBy("id", "h").agg(F.collect_list(F.struct("s", "n", "a")).alias("runs"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, out = [], {"s": [], "n": [], "a": [], "bytes": []}
            for k, (text, found) in enumerate(zip(_unpack(batch.column("z")), batch.column("runs").to_pylist())):
                for r in found:
                    rows.append(k)
                    for c in ("s", "n", "a"):
                        out[c].append(r[c])
                    out["bytes"].append(text[r["s"] : r["s"] + r["n"] - 1 + LENGTH])
            at = pa.array(rows, pa.int64())
            columns = [batch.column("id").take(at), batch.column("h").take(at), pa.array(out["s"], pa.int64()), pa.array(out["n"], pa.int32()), pa.array(out["a"], pa.int32()), pa.array(out["bytes"], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["id", "h", "s", "n", "a", "bytes"])

        return step

    kind = docs.schema["id"].dataType.simpleString()
    # A repeated row brings its runs again: these are repeated already, so being counted twice changes nothing.
    joined = _by_document(compressed(docs), lists, "inner").select("id", "h", "z", "runs")
    found = map_batches(joined, make, f"id {kind}, h int, s bigint, n int, a int, bytes binary")
    return stored(found.withColumn("r", F.monotonically_increasing_id()), "undecided_runs")


def _run_arrays(batch: pa.RecordBatch):
    texts = batch.column("bytes").to_pylist()
    data = np.frombuffer(b"".join(texts), np.uint8)
    n, a, r = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "a", "r"))
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64)
    return identifiers(data)[1], offsets, n, a, r


def blocks(cut: DataFrame) -> DataFrame:
    """``member`` (run and first window), ``n`` windows, ``core`` and ``whole`` of the blocks of runs."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            with np.errstate(over="ignore"):
                h, offsets, n, a, r = _run_arrays(batch)
                low, high = (a - n + 1) // BLOCK, a // BLOCK  # blocks by distance from the anchor
                times = high - low + 1
                k = np.repeat(np.arange(len(n)), times)
                b = np.repeat(high, times) - (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
                w0 = np.maximum(a[k] - (b * BLOCK + BLOCK - 1), 0)
                w1 = np.minimum(a[k] - b * BLOCK, n[k] - 1)
                core = offsets[k] + a[k] - b * BLOCK
                core = span_ids(h, core, core + LENGTH - BLOCK + 1)
                whole = span_ids(h, offsets[k] + w0, offsets[k] + w1 + LENGTH)
            columns = [pa.array(r[k] << 8 | w0), pa.array((w1 - w0 + 1).astype(np.int32)), pa.array(core), pa.array(whole)]
            return pa.RecordBatch.from_arrays(columns, ["member", "n", "core", "whole"])

        return step

    return map_batches(cut.select("r", "n", "a", "bytes"), make, "member bigint, n int, core bigint, whole bigint")


def windows(cut: DataFrame, left: DataFrame) -> DataFrame:
    """``member`` and ``whole`` of the single windows of the blocks ``left``."""
    lists = left.groupBy(F.shiftright("member", 8).alias("r")).agg(F.collect_list(F.struct(F.col("member").bitwiseAND(255).cast("int").alias("w"), "n")).alias("parts"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            with np.errstate(over="ignore"):
                h, offsets, _, _, r = _run_arrays(batch)
                rows, places = [], []
                for k, parts in enumerate(batch.column("parts").to_pylist()):
                    for p in parts:
                        rows += [k] * p["n"]
                        places += range(p["w"], p["w"] + p["n"])
                k, w = np.array(rows, np.int64), np.array(places, np.int64)
                whole = span_ids(h, offsets[k] + w, offsets[k] + w + LENGTH)
            return pa.RecordBatch.from_arrays([pa.array(r[k] << 8 | w), pa.array(whole)], ["member", "whole"])

        return step

    return map_batches(cut.select("r", "n", "a", "bytes").join(lists, "r"), make, "member bigint, whole bigint")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``id, h, spans``: for each document with repeated windows the (start, number of windows) of runs of them."""
    spark = docs.sparkSession
    # Round 1: q-gram buckets.
    found = all_runs(docs)
    shared = stored(found.groupBy("key").count().where("count > 1").select("key"), "shared_keys")
    alive = stored(found.join(shared, "key"), "shared_grams")
    _released(spark)
    # Round 2: whole runs.
    placed = bucketed(alive.withColumn("member", F.struct("id", "h", "s")), "whole", "member").drop("member")
    decided = stored(placed, "runs")
    _released(spark)
    undecided = decided.where("size = 1")
    keys = undecided.select("key").dropDuplicates()
    standing = decided.where("size > 1 and first").join(keys, "key", "left_semi")
    columns = ["id", "h", "s", "n", "a"]
    cut = contents(docs, undecided.select(columns).union(standing.select(columns)))
    _released(spark)
    # Round 3: blocks that share their common bytes with another, then whole blocks.
    made = stored(blocks(cut), "blocks")
    cores = stored(made.groupBy("core").count().where("count > 1").select("core"), "shared_cores")
    block = stored(bucketed(made.join(cores, "core"), "whole", "member"), "block_buckets")
    _released(spark)
    alone = block.where("size = 1")
    standing = block.where("size > 1 and first").join(alone.select("core").dropDuplicates(), "core", "left_semi")
    # Round 4: single windows.
    single = bucketed(windows(cut, alone.select("member", "n").union(standing.select("member", "n"))), "whole", "member")
    single = single.where("size > 1").select("member", F.lit(1).alias("n"))
    inner = stored(block.where("size > 1").select("member", "n").union(single), "inner_spans")
    _released(spark)
    inner = inner.join(cut.select("r", "id", "h", "s"), F.shiftright("member", 8) == F.col("r"))
    inner = inner.select("id", "h", (F.col("s") + F.col("member").bitwiseAND(255)).alias("s"), "n")
    spans = decided.where("size > 1").select("id", "h", "s", "n").union(inner)
    return spans.groupBy("id", "h").agg(F.collect_set(F.struct("s", "n")).alias("spans"))


def merged(spans: list[dict], length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal removed byte ranges."""
    out: list[list[int]] = []
    for s, e in sorted((p["s"], p["s"] + p["n"] - 1 + length) for p in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``.

    A NULL text counts as empty. Repeated rows, also under NULL keys, count as occurrences of each other and give a
    row each. Other columns are not read. Texts under 200 bytes keep all. Strings are compared by 64-bit hashes.
    """
    rows = picked(docs, id_col, text_col)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text, spans in zip(_unpack(batch.column("z")), batch.column("spans").to_pylist()):
                removed = merged(spans or [])
                kept, at = [], 0
                for s, e in removed:
                    kept.append(text[at:s])
                    at = e
                kept.append(text[at:])
                out.append((len(text), sum(e - s for s, e in removed), len(removed), hashlib.sha256(b"".join(kept)).hexdigest()))
            columns = [pa.array([o[i] for o in out], pa.int64()) for i in range(3)]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            return pa.RecordBatch.from_arrays([batch.column("id"), *columns, pa.array([o[3] for o in out], pa.string())], names)

        return step

    joined = _by_document(compressed(rows), repeated_spans(rows), "left").select("id", "z", "spans")
    kind = docs.schema[id_col].dataType.simpleString()
    made = map_batches(joined, make, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return made.withColumnRenamed("id", id_col)
