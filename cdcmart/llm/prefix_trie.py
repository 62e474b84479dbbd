"""The prefix trie of conversations, from sorted turn sequences and the lengths of their longest common prefixes (LCP).

A conversation is a string of 16-byte turn digests. Strings are sorted by range partitioning into blocks; each row
knows how many turns it shares with the row before. The members of a prefix of depth d are the rows around it between
which no LCP falls below d. Every prefix searches both ends of that interval on its own, by binary search over a sparse
table of range minima, and minima and sums over the interval give its figures; nothing depends on another prefix, and
no stack is kept.

An interval may span blocks. Of each block a handful of numbers is known everywhere (rows, least LCP, least key, sums),
over which the same search finds the block where the interval ends; only that block is asked, by key and depth, how far
it reaches in. A block asks at most one question for every depth of its first and of its last row, however many rows
share a prefix. Rows hold numbers and digests, never texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import ship, stored

# Conversations of a block: what one task holds at a time.
BLOCK_ROWS = 20_000
SHARED_HEADS, SHARED_TURNS = 5, 9
DIGEST = 16

SORTED = (
    "block int, pos int, conv_id bigint, n int, lcp int, shared bigint, sizes array<bigint>, first binary, leaf boolean, last binary"
)
SORTED_SCHEMA = pa.schema(
    [("block", pa.int32()), ("pos", pa.int32()), ("conv_id", pa.int64()), ("n", pa.int32()), ("lcp", pa.int32()), ("shared", pa.int64()),
     ("sizes", pa.list_(pa.int64())), ("first", pa.binary()), ("leaf", pa.bool_()), ("last", pa.binary())]
)
QUESTION = "block int, side int, depth int, target int"
ANSWER = "block int, side int, depth int, rows bigint, least bigint, leaves bigint, shared bigint"
# kind 0: a node; 1: children of a node that begins in another block; 2: part of the members that end at a node.
FOUND = (
    "kind int, first bigint, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends string, block int"
)
RIGHT, LEFT = 0, 1
NONE = np.iinfo(np.int64).max


# Rebuilt conversations


def rebuilt(
    conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, heads: int = SHARED_HEADS, turns: int = SHARED_TURNS
) -> DataFrame:
    """``conv_id, digests, sizes``: per conversation the digests of its rebuilt turns in one string, and the UTF-8
    bytes of their texts."""
    rows = conversations.select(
        F.col(f"`{id_col}`").cast("bigint").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))),
    ).where("conv_id IS NOT NULL")
    # The length keeps ("ab", "c") and ("a", "bc") apart.
    digest = F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))
    turn = F.struct("turn", digest.alias("digest"), F.octet_length("text").cast("bigint").alias("size"))
    own = stored(rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")), "conversations")
    head = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, turns - 1).alias("head"))
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % heads).join(head, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % turns).cast("int")
    whole = F.concat(
        F.coalesce(F.slice("head", F.lit(1), h), F.array().cast(own.schema["turns"].dataType)),
        F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0))),
    )
    made = joined.select("conv_id", whole.alias("t"))
    # Joined as hexadecimal digits, since arrays of binary values cannot be joined directly.
    digests = F.unhex(F.array_join(F.transform("t.digest", F.hex), ""))
    return made.select("conv_id", digests.alias("digests"), F.col("t.size").alias("sizes"))


# Sorted rows with their LCP


def common_turns(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y)) // DIGEST
    if x[: n * DIGEST] == y[: n * DIGEST]:
        return n
    a, b = (np.frombuffer(s, np.uint64, 2 * n) for s in (x, y))
    return int(np.argmax(a != b)) // 2


def sorted_rows(sequences: DataFrame, n_blocks: int) -> DataFrame:
    """Rows in the order of their digests, then of their keys, by block and place. ``lcp`` is shared with the row
    before in the block, -1 for the first. ``sizes`` are those of the turns not shared. ``leaf`` says that the next row
    does not go on from this one; it is open for the last row. Only the first and the last row carry their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pos, before, waiting = TaskContext.get().partitionId(), 0, b"", None
        for batch in batches:
            rows = []
            for conv, digests, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "digests", "sizes"))):
                lcp = -1 if waiting is None else common_turns(before, digests)
                if waiting is not None:
                    rows.append((*waiting, lcp < waiting[3], None))
                shared = max(lcp, 0)
                waiting = (block, pos, conv, len(sizes), lcp, sum(sizes[:shared]), sizes[shared:], None if pos else digests)
                before, pos = digests, pos + 1
            if rows:
                yield _batch(rows)
        if waiting is not None:
            yield _batch([(*waiting, None, before)])

    ship(sequences.sparkSession)
    dealt = sequences.repartitionByRange(n_blocks, "digests", "conv_id").sortWithinPartitions("digests", "conv_id")
    return dealt.mapInArrow(run, SORTED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*rows), SORTED_SCHEMA)], schema=SORTED_SCHEMA)


class Blocks:
    """What every task knows of all blocks: numbers only, one row per ``BLOCK_ROWS`` conversations."""

    def __init__(self, at: DataFrame):
        per_block = {
            r["block"]: r
            for r in at.groupBy("block").agg(
                F.count("*").alias("rows"), F.min("conv_id").alias("least"), F.min(F.when(F.col("pos") > 0, F.col("lcp"))).alias("lcp"),
                F.sum("shared").alias("shared"), F.count_if("leaf").alias("leaves"), F.max_by("n", "pos").alias("last_n"), F.min_by("n", "pos").alias("first_n"),
            ).collect()
        }
        self.numbers = np.array(sorted(per_block), np.int64)
        rank = {int(b): k for k, b in enumerate(self.numbers)}
        seams = self._seams(at)
        ordered = [per_block[int(b)] for b in self.numbers]
        column = lambda name: np.array([r[name] for r in ordered], np.int64)
        self.rows, self.least, self.first_n = column("rows"), column("least"), column("first_n")
        # What the first row of a block shares with the last row of the block before; nothing lies before the first.
        self.seam = np.array([seams.get(int(b), (-1, 0))[0] for b in self.numbers], np.int64)
        self.seam_shared = np.array([seams.get(int(b), (-1, 0))[1] for b in self.numbers], np.int64)
        self.lcp = np.array([min(r["lcp"] if r["lcp"] is not None else NONE, s) for r, s in zip(ordered, self.seam)], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.rows)])
        self.shared = np.concatenate([[0], np.cumsum(column("shared") + self.seam_shared)])
        # The last row of a block is a leaf if the first one of the next does not go on from it.
        leaves = column("leaves") + (np.concatenate([self.seam[1:], [-1]]) < column("last_n"))
        self.leaves = np.concatenate([[0], np.cumsum(leaves)])
        self.rank = rank
        self.minima, self.least_table = sparse(self.lcp), sparse(self.least)

    def _seams(self, at: DataFrame) -> dict[int, tuple[int, int]]:
        """(LCP, shared bytes) of the first row of each block with the last row of the block before."""
        after = {int(a): int(b) for a, b in zip(self.numbers, self.numbers[1:])}
        if not after:
            return {}
        spark = at.sparkSession
        steps = spark.createDataFrame(list(after.items()), "block int, next int")
        last = at.where("last IS NOT NULL").select("block", "last").join(steps, "block").select(F.col("next").alias("block"), "last")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for first, last, sizes in zip(*(batch.column(c).to_pylist() for c in ("first", "last", "sizes"))):
                    lcp = common_turns(last, first)
                    out.append((lcp, sum(sizes[:lcp])))
                lcps, shared = (pa.array(v, pa.int64()) for v in (zip(*out) if out else ([], [])))
                yield pa.RecordBatch.from_arrays([batch.column("block"), lcps, shared], ["block", "lcp", "shared"])

        seams = at.where("pos = 0").select("block", "first", "sizes").join(last, "block").mapInArrow(run, "block int, lcp bigint, shared bigint")
        return {r["block"]: (r["lcp"], r["shared"]) for r in seams.collect()}


# Range minima


def sparse(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minima of 2**k neighbouring values."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def range_min(table: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least of ``[i, j)``, NONE where that is empty."""
    out = np.full(len(i), NONE, np.int64)
    size = j - i
    level = np.where(size > 0, np.frexp(np.maximum(size, 1))[1] - 1, -1)
    for k in range(len(table)):
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[k][i[at]], table[k][j[at] - (1 << k)])
    return out


def extent_right(table: list[np.ndarray], i: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """For each start the first place from there on whose value is below ``depth``; the length if there is none."""
    n, at = len(table[0]), i.copy()
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        fits = at + step <= n
        fits[fits] = table[k][at[fits]] >= depth[fits]
        at[fits] += step
    return at


def extent_left(table: list[np.ndarray], i: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """For each place the last one, up to it, whose value is below ``depth``; -1 if there is none."""
    at = i + 1  # values [at, i] are not below the depth
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        fits = at >= step
        fits[fits] = table[k][at[fits] - step] >= depth[fits]
        at[fits] -= step
    return at - 1


class Block:
    """The rows of one block, with the seam to the block before."""

    def __init__(self, table: pa.Table, blocks: Blocks, number: int):
        self.blocks, self.k = blocks, blocks.rank[number]
        table = table.sort_by("pos")
        self.conv = table["conv_id"].to_numpy()
        self.n = table["n"].to_numpy().astype(np.int64)
        self.lcp = table["lcp"].to_numpy().astype(np.int64)
        shared = table["shared"].to_numpy().copy()
        sizes = table["sizes"].combine_chunks()
        if isinstance(sizes, pa.ChunkedArray):
            sizes = pa.concat_arrays(sizes.chunks)
        offsets = sizes.offsets.to_numpy().astype(np.int64)
        self.sizes, self.size_at = sizes.flatten().to_numpy(), offsets - offsets[0]
        # The first row came with all its sizes; now that its LCP is known, the shared ones are passed over.
        self.lcp[0], shared[0] = blocks.seam[self.k], blocks.seam_shared[self.k]
        self.own_at = self.size_at[:-1].copy()
        self.own_at[0] += max(int(self.lcp[0]), 0)
        self.shared = shared
        self.shared_up_to = np.concatenate([[0], np.cumsum(shared)])
        after = np.concatenate([self.lcp[1:], [blocks.seam[self.k + 1] if self.k + 1 < len(blocks.rows) else -1]])
        self.leaves_up_to = np.concatenate([[0], np.cumsum(after < self.n)])
        self.minima, self.least = sparse(self.lcp), sparse(self.conv)
        self.start, self.size = int(blocks.starts[self.k]), len(self.n)

    def beyond(self, side: int, depths: np.ndarray) -> np.ndarray:
        """Rank of the block in which intervals that leave this one end; on the right, the one that no longer
        belongs to it as a whole."""
        b, at = self.blocks, np.full(len(depths), self.k)
        if side == RIGHT:
            return extent_right(b.minima, at + 1, depths)
        return extent_left(b.minima, at - 1, depths)

    def crossing(self) -> tuple[np.ndarray, np.ndarray]:
        """Depths at which intervals leave the block to the right and to the left."""
        b, last = self.blocks, self.k + 1 == len(self.blocks.rows)
        right = np.empty(0, np.int64) if last else np.arange(0, b.seam[self.k + 1] + 1)
        left = np.arange(0, self.lcp[0] + 1)
        # On the right only depths that some row up to the last one of the block has, on the left that it asks for.
        asked = np.unique(self.lcp)
        return right, left[np.isin(left, asked[asked <= self.lcp[0]])]

    def questions(self) -> list[tuple[int, int, int, int]]:
        """Those that another block must answer. An interval that ends with a whole block needs none."""
        out = []
        for side, depths in zip((RIGHT, LEFT), self.crossing()):
            for depth, target in zip(depths.tolist(), self.beyond(side, depths).tolist()):
                if side == LEFT or (target < len(self.blocks.rows) and self.blocks.seam[target] >= depth):
                    out.append((int(self.blocks.numbers[self.k]), side, depth, int(self.blocks.numbers[target])))
        return out

    def answers(self, asked: list[tuple[int, int, int]]) -> list[tuple]:
        """How far the intervals of other blocks reach into this one: rows, least key, leaves, shared bytes. To the
        left, those of the first row of the interval do not count as shared inside it."""
        side, depth = (np.array([q[i] for q in asked], np.int64) for i in (1, 2))
        right = side == RIGHT
        zero = np.zeros(len(asked), np.int64)
        stop = np.where(right, extent_right(self.minima, zero, depth), self.size)
        begin = np.where(right, 0, extent_left(self.minima, zero + self.size - 1, depth))
        least = range_min(self.least, begin, stop)
        leaves = self.leaves_up_to[stop] - self.leaves_up_to[begin]
        shared = self.shared_up_to[stop] - self.shared_up_to[begin]
        return [(*q, *row) for q, row in zip(asked, zip((stop - begin).tolist(), least.tolist(), leaves.tolist(), shared.tolist()))]

    def ends(self, side: int, depths: np.ndarray, answers: dict[tuple[int, int], tuple]) -> tuple[np.ndarray, ...]:
        """Of the part of intervals outside this block: rows, least key, leaves, shared bytes."""
        b, target = self.blocks, self.beyond(side, depths)
        lo, hi = (np.full(len(depths), self.k + 1), target) if side == RIGHT else (target + 1, np.full(len(depths), self.k))
        got = np.array([answers.get((side, int(d)), (0, NONE, 0, 0)) for d in depths], np.int64).reshape(-1, 4).T
        return (
            b.starts[hi] - b.starts[lo] + got[0],
            np.minimum(range_min(b.least_table, lo, hi), got[1]),
            b.leaves[hi] - b.leaves[lo] + got[2],
            b.shared[hi] - b.shared[lo] + got[3],
        )

    def found(self, answers: dict[tuple[int, int], tuple]) -> dict[str, np.ndarray | list]:
        """The nodes whose first row lies in this block, and what others need."""
        # Candidates: every prefix that a row does not share with the row before. The root belongs to the first row.
        first_own = np.maximum(self.lcp, 0 if self.start else -1)
        count = self.n - first_own
        row = np.repeat(np.arange(self.size), count)
        depth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + 1 + first_own[row]
        bytes_here = np.zeros(len(row), np.int64)
        turn = np.flatnonzero(depth > 0)
        bytes_here[turn] = self.sizes[(self.own_at - np.maximum(self.lcp, 0))[row[turn]] + depth[turn] - 1]
        # Bytes of the turns of the first row before the last one of the prefix.
        run = np.cumsum(bytes_here)
        begins = np.repeat(np.cumsum(count) - count, count)
        before = self.shared[row] + run - bytes_here - (run[begins] - bytes_here[begins] if len(row) else 0)

        stop = extent_right(self.minima, row + 1, depth)
        rows, least = stop - row, range_min(self.least, row, stop)
        leaves = self.leaves_up_to[stop] - self.leaves_up_to[row]
        shared = self.shared_up_to[stop] - self.shared_up_to[row + 1]
        right, left = self.crossing()
        out = self.ends(RIGHT, right, answers)
        crosses = np.flatnonzero((stop == self.size) & (depth <= (right[-1] if len(right) else -1)))
        at = depth[crosses]  # the depths that cross to the right are all from 0 on
        rows[crosses] += out[0][at]
        least[crosses] = np.minimum(least[crosses], out[1][at])
        leaves[crosses] += out[2][at]
        shared[crosses] += out[3][at]
        saved = shared - (rows - 1) * before

        # The prefix that a row shares with the row before: where its members begin, and the least key among them.
        p_left, p_right = extent_left(self.minima, np.arange(self.size), self.lcp), extent_right(self.minima, np.arange(self.size) + 1, self.lcp)
        if self.start == 0:
            p_left[0] = 0
        p_first = self.start + p_left
        p_least = range_min(self.least, np.maximum(p_left, 0), p_right)
        outside = np.flatnonzero(p_left < 0)
        if len(outside):
            got = self.ends(LEFT, left, answers)
            where = np.searchsorted(left, self.lcp[outside])
            p_first[outside] = self.start - got[0][where]
            p_least[outside] = np.minimum(p_least[outside], got[1][where])
        cross_right = np.flatnonzero((p_right == self.size) & (self.lcp <= (right[-1] if len(right) else -1)) & (self.lcp >= 0))
        p_least[cross_right] = np.minimum(p_least[cross_right], out[1][self.lcp[cross_right]])

        # Parents: of the first own prefix of a row that shared one, of the others the prefix before.
        parent = np.full(len(row), -1, np.int64)
        inner = np.flatnonzero((depth > first_own[row] + 1))
        parent[inner] = least[inner - 1]
        outer = np.flatnonzero((depth == first_own[row] + 1) & (depth > 0))
        parent[outer] = p_least[row[outer]]
        has_parent = depth > 0

        # Children: the next own prefix, and first own prefixes of later rows whose parent this is.
        children = (depth < self.n[row]).astype(np.int64)
        child = np.flatnonzero((count > 0) & (np.arange(self.size) + self.start > 0))
        node_at = np.cumsum(count) - count
        local = child[p_left[child] >= 0]
        np.add.at(children, node_at[p_left[local]] + self.lcp[local] - first_own[p_left[local]] - 1, 1)
        far, times = np.unique(np.stack([p_first[child[p_left[child] < 0]], self.lcp[child[p_left[child] < 0]]], 1), axis=0, return_counts=True)

        # Members that end at a node are the rows of equal turns from its first row on, by ascending key.
        copy = (self.lcp == self.n) & (np.arange(self.size) + self.start > 0)
        bounds = [*np.flatnonzero(~copy).tolist(), self.size]
        next_copies = self.k + 1 < len(self.blocks.rows) and self.blocks.seam[self.k + 1] == self.n[-1] == self.blocks.first_n[self.k + 1]
        empty = hashlib.sha256(b"").hexdigest()
        ends: list[str | None] = [empty] * len(row)
        pieces: list[tuple[int, str]] = []
        if bounds[0]:
            pieces.append((int(p_first[0]), ",".join(map(str, self.conv[: bounds[0]].tolist()))))
        for i, j in zip(bounds, bounds[1:]):
            text = ",".join(map(str, self.conv[i:j].tolist()))
            node = int(node_at[i] + self.n[i] - first_own[i] - 1)
            if j == self.size and next_copies:
                ends[node] = None
                pieces.append((self.start + i, text))
            else:
                ends[node] = hashlib.sha256(text.encode()).hexdigest()

        number = int(self.blocks.numbers[self.k])
        total = len(row) + len(times) + len(pieces)
        fill = [None] * (len(times) + len(pieces))
        return {
            "kind": [0] * len(row) + [1] * len(times) + [2] * len(pieces),
            "first": [*(self.start + row).tolist(), *far[:, 0].tolist(), *(f for f, _ in pieces)],
            "depth": [*depth.tolist(), *far[:, 1].tolist(), *([None] * len(pieces))],
            "conv_id": [*least.tolist(), *fill],
            "parent_conv_id": [*(p if h else None for p, h in zip(parent.tolist(), has_parent.tolist())), *fill],
            "n_convs": [*rows.tolist(), *fill],
            "n_children": [*children.tolist(), *times.tolist(), *([None] * len(pieces))],
            "n_leaves": [*leaves.tolist(), *fill],
            "saved_tokens": [*saved.tolist(), *fill],
            "ends": [*ends, *([None] * len(times)), *(t for _, t in pieces)],
            "block": [number] * total,
        }


# The job


FOUND_SCHEMA = pa.schema(
    [("kind", pa.int32()), *((c, pa.int64()) for c in ("first", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
     ("ends", pa.string()), ("block", pa.int32())]
)


def _ends_of_many_blocks(pieces: DataFrame) -> DataFrame:
    """``first, ends_sha256`` of nodes whose copies lie in several blocks. The digest of one node is serial by its
    definition; its parts come in order and are read as a stream, so none is held longer than for its own bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([digest.hexdigest()])], ["first", "ends_sha256"])

        for batch in batches:
            for first, text in zip(batch.column("first").to_pylist(), batch.column("ends").to_pylist()):
                if first != node:
                    if digest is not None:
                        yield row()
                    node, digest = first, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
        if digest is not None:
            yield row()

    ship(pieces.sparkSession)
    dealt = pieces.select("first", "block", "ends").repartition("first").sortWithinPartitions("first", "block")
    return dealt.select("first", "ends").mapInArrow(run, "first bigint, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    heads: int = SHARED_HEADS, turns: int = SHARED_TURNS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    Turns stand in the order of ``turn_col``, NULL first; rows of one turn in the order of the MD5 digest of
    length(role):role:text; repeated rows are turns of their own. NULL roles and texts are empty. Rows without a
    conversation are left out. Conversations without turns after rebuilding belong to the root alone. An empty table
    has no nodes. Keys must be integers; other columns are not read. Turns are compared by 128-bit digests. The
    digests and sizes of one conversation (24 bytes a turn) lie in one row.
    """
    sequences = stored(rebuilt(conversations, id_col, turn_col, role_col, text_col, heads, turns), "turn_sequences")
    total = sequences.count()
    at = stored(sorted_rows(sequences, max(1, -(-total // block_rows))), "sorted_turns")
    blocks = Blocks(at)
    rows = at.drop("first", "leaf", "last")
    spark = at.sparkSession
    ship(spark)
    known = spark.sparkContext.broadcast(blocks)

    def ask(table: pa.Table) -> pa.Table:
        out = Block(table, known.value, table["block"][0].as_py()).questions()
        columns = list(zip(*out)) if out else [[], [], [], []]
        return pa.table({c: pa.array(v, pa.int32()) for c, v in zip(("block", "side", "depth", "target"), columns)})

    def answer(table: pa.Table, asked: pa.Table) -> pa.Table:
        names, columns = ("block", "side", "depth"), [[]] * 7
        if len(asked):
            block = Block(table, known.value, table["block"][0].as_py())
            columns = list(zip(*block.answers(list(zip(*(asked[c].to_pylist() for c in names))))))
        types = [pa.int32()] * 3 + [pa.int64()] * 4
        return pa.table({c: pa.array(v, t) for c, v, t in zip((*names, "rows", "least", "leaves", "shared"), columns, types)})

    def find(table: pa.Table, answered: pa.Table) -> pa.Table:
        got = {(s, d): tuple(rest) for s, d, *rest in zip(*(answered[c].to_pylist() for c in ("side", "depth", "rows", "least", "leaves", "shared")))}
        found = Block(table, known.value, table["block"][0].as_py()).found(got)
        return pa.table([pa.array(found[f.name], f.type) for f in FOUND_SCHEMA], schema=FOUND_SCHEMA)

    by_block = rows.groupBy("block")
    asked = stored(by_block.applyInArrow(ask, QUESTION), "questions")
    answered = stored(by_block.cogroup(asked.groupBy("target")).applyInArrow(answer, ANSWER), "answers")
    found = stored(by_block.cogroup(answered.groupBy("block")).applyInArrow(find, FOUND), "nodes")

    children = found.where("kind = 1").groupBy("first", "depth").agg(F.sum("n_children").alias("more"))
    ends = _ends_of_many_blocks(found.where("kind = 2"))
    nodes = found.where("kind = 0").drop("kind", "block")
    # Both are few: at most one row for each depth of a block's first row, and one for each of its seams.
    joined = nodes.join(stored(children, "children"), ["first", "depth"], "left").join(stored(ends, "ends"), "first", "left")
    n_children = F.col("n_children") + F.coalesce("more", F.lit(0).cast("bigint"))
    sha = F.coalesce("ends", "ends_sha256")
    return joined.select("conv_id", "depth", "parent_conv_id", "n_convs", n_children.alias("n_children"), "n_leaves", "saved_tokens", sha.alias("ends_sha256"))
