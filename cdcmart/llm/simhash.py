"""Near-duplicates by SimHash, with candidates from pivot distance tables.

The table holds, for every distinct fingerprint, its Hamming distances to many reference fingerprints, over all 64
bits and over each of 8 segments. By the triangle inequality two fingerprints within distance k differ by at most k
in every coordinate, so a larger difference discards the pair without comparing the fingerprints. With k = 2 at most
two segments differ at all; in the coordinates of the other six the two are equal. So fingerprints meet only where
the coordinates of some six segments coincide, are discarded by the largest difference of their other coordinates,
and survivors are verified on the bits.

Copies share a fingerprint and enter once, whatever their number.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import map_batches, picked, stored
from cdcmart.llm.components import components

SHINGLE, DISTANCE, SEED = 3, 2, 42
SEGMENTS, SEGMENT_BITS, REFERENCES = 8, 8, 8
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a text: a bit is set if it is set in over half the hashes of its shingles."""
    words = text.encode().lower().split()  # bytes: lowers A-Z only, splits at the six ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        some = zip(starts[at : at + SHINGLES_AT_ONCE], stops[at : at + SHINGLES_AT_ONCE])
        hashes = np.frombuffer(b"".join([digest(joined[s:e], SEED) for s, e in some]), np.uint8).reshape(-1, 8)
        counts += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [fingerprint(t or "", shingle) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.int64())], ["id", "fp"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(picked(docs, id_col, text_col), make, f"id {kind}, fp bigint")


def references() -> list[int]:
    """Reference fingerprints: hashes of their numbers, signed."""
    return [int.from_bytes(xxhash.xxh64_digest(str(j).encode(), SEED), "big", signed=True) for j in range(REFERENCES)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def pivot_table(nodes: DataFrame) -> DataFrame:
    """``fp``, ``d0..`` the distances to the references, ``s0..`` those over each segment, four bits each."""
    fp = F.col("fp")
    columns: dict[str, Column] = {f"d{j}": F.bit_count(fp.bitwiseXOR(F.lit(r))) for j, r in enumerate(references())}
    for s in range(SEGMENTS):
        mask = F.lit(_signed(((1 << SEGMENT_BITS) - 1) << (SEGMENT_BITS * s)))
        packed = F.lit(0).cast("long")
        for j, r in enumerate(references()):
            packed = packed.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(r)).bitwiseAND(mask)).cast("long"), 4 * j))
        columns[f"s{s}"] = packed
    return nodes.select("fp", *[c.alias(n) for n, c in columns.items()])


def links(nodes: DataFrame) -> DataFrame:
    """``u, v`` for all pairs of distinct fingerprints that differ in one or two bits, each once. A fingerprint has at
    most 2,080 such neighbours, so links are linear in the fingerprints."""
    table = pivot_table(nodes)
    keys = []
    for left_out in combinations(range(SEGMENTS), DISTANCE):
        same = [f"s{s}" for s in range(SEGMENTS) if s not in left_out]
        keys.append(F.xxhash64(F.lit(SEGMENTS * left_out[0] + left_out[1]), *same))
    coordinates = [f"d{j}" for j in range(REFERENCES)]
    keyed = table.select("fp", *[F.col(c).cast("byte").alias(c) for c in coordinates], F.explode(F.array(*keys)).alias("key"))
    a = keyed.select("key", *[F.col(c).alias(f"a_{c}") for c in ["fp", *coordinates]])
    b = keyed.select("key", *[F.col(c).alias(f"b_{c}") for c in ["fp", *coordinates]])
    largest = F.greatest(*[F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) for c in coordinates])
    close = F.bit_count(F.col("a_fp").bitwiseXOR(F.col("b_fp"))) <= DISTANCE
    # Spark takes the exploded rows, 28 to a fingerprint, for as few as the fingerprints and would broadcast them all.
    met = a.withColumnRenamed("key", "a_key").join(
        b.withColumnRenamed("key", "b_key").hint("merge"),
        (F.col("a_key") == F.col("b_key")) & (F.col("a_fp") < F.col("b_fp")) & (largest <= DISTANCE) & close,
    )
    return met.select(F.col("a_fp").alias("u"), F.col("b_fp").alias("v")).dropDuplicates()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id_col, fingerprint, component_id`` per row of ``docs``; the component is named by its least key.

    A NULL text counts as empty; texts without words have fingerprint zero and are linked like any other. Repeated
    rows give a row each. A NULL key gives a row and never names a component that has another key. Other columns are
    not read.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct_fingerprints")
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # Written first, so that a component with very many fingerprints can be split in the join.
    names = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    named = rooted.join(names, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), hexed, "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` whose key names their component, one for each key: rows that share a key are one document.
    Rows with a NULL key cannot name a component and stay."""
    found = near_duplicates(docs.where(F.col(f"`{id_col}`").isNotNull()), id_col, text_col, shingle)
    kept = found.where(F.col(id_col) == F.col("component_id")).select(id_col).dropDuplicates()
    named = docs.join(kept, id_col).select(docs.columns).dropDuplicates([id_col])
    return named.union(docs.where(F.col(f"`{id_col}`").isNull()))
