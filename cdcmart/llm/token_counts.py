"""Token counts of a byte-level BPE by finite-state transducers whose transitions carry counts.

The merges are compiled, as far as the data needs it, into one deterministic transducer over bytes. Its state after a
prefix holds the longest suffix that can still grow into a token and, for each position inside that suffix, the last
token of the encoding of the text up to there with the count relative to now. That is all the future depends on: the
encoding of a prefix is the encoding of a shorter prefix plus one token, namely the only token that ends here and may
follow the token before it. A transition carries the change of the count, so a run of the transducer is a sum.

Texts are cut into chunks. The map of a chunk from the state it is entered in to the state it is left in with its
count is constant behind the first reset point (see ``pieces``), so it is kept as (open head, count, open tail).
These maps compose associatively, and a scan by pairs makes the map of the text. The result does not depend on where
the chunks were cut.
"""

from __future__ import annotations

import json
from functools import cache
from typing import NamedTuple

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import map_batches, picked
from cdcmart.llm.pieces import SAFE, SPECIAL, PieceTable

CHUNK_CHARS = 1 << 16
# Most states and token pairs kept by a worker; beyond it the compiled part starts anew.
KEPT_STATES = 200_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte_of = byte_alphabet()
        plain = lambda s: bytes(byte_of[c] for c in s)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(plain(a), plain(b)): i for i, (a, b) in enumerate(pairs)}
        special = {SPECIAL}
        self.tokens = {plain(t) for t in model["vocab"] if t not in special}
        self.prefixes = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.longest = max(map(len, self.tokens))
        self._reset()

    def _reset(self) -> None:
        self.pair_ok: dict[tuple[bytes, bytes], bool] = {}
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next: list[dict[int, tuple[int, int]]] = []
        self._state((b"", ((None, 0),)))

    def _state(self, key: tuple) -> int:
        at = self.number.get(key)
        if at is None:
            at = self.number[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
        return at

    def merged(self, word: bytes) -> list[bytes]:
        """The encoding by repeated merging, for short strings."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            a, b = parts[best], parts[best + 1]
            if (a, b) not in self.rank:
                break
            joined, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == a and parts[i + 1] == b:
                    joined.append(a + b)
                    i += 2
                else:
                    joined.append(parts[i])
                    i += 1
            parts = joined
        return parts

    def _may_follow(self, before: bytes | None, token: bytes) -> bool:
        key = (before or b"", token)
        known = self.pair_ok.get(key)
        if known is None:
            whole = (before or b"") + token
            known = self.pair_ok[key] = self.merged(whole) == ([before, token] if before else [token])
        return known

    def _step(self, at: int, byte: int) -> tuple[int, int]:
        suffix, past = self.states[at]
        grown = suffix + bytes((byte,))
        while grown not in self.prefixes:
            grown = grown[1:]
        for length in range(len(grown), 0, -1):
            token = grown[-length:]
            if token in self.tokens:
                before, behind = past[length - 1]
                if self._may_follow(before, token):
                    break
        else:
            raise ValueError("no token ends here")
        change = behind + 1
        now = ((token, 0), *((t, d - change) for t, d in past[: len(grown)]))
        found = self.next[at][byte] = (self._state((grown, now)), change)
        return found

    def count(self, word: bytes) -> int:
        """Tokens of one pre-token."""
        if len(self.states) > KEPT_STATES or len(self.pair_ok) > 4 * KEPT_STATES:
            self._reset()
        at, total, following = 0, 0, self.next
        for byte in word:
            try:
                at, change = following[at][byte]
            except KeyError:
                at, change = self._step(at, byte)
            total += change
        return total


class ChunkMap(NamedTuple):
    """``head`` is what the entry state still has to run over; a chunk without reset point is all head (``closed``
    false)."""

    head: str
    closed: bool
    count: int
    tail: str


class Counter:
    def __init__(self, path: str):
        self.transducer = Transducer(path)
        self.pretoken = regex.compile(public_tokenizers.PATTERN)
        self.table = PieceTable(self._encode, 1)

    def _encode(self, pieces: list[str]) -> list[int]:
        find, count = self.pretoken.findall, self.transducer.count
        return [sum(count(w.encode()) for w in find(p)) for p in pieces]

    def runs(self, texts: list[str]) -> list[int]:
        """Tokens of texts entered at the start state."""
        return [sum(v) for v in self.table.values(texts)]

    @staticmethod
    def cut(chunk: str) -> tuple[str, bool, str, str]:
        """(head, closed, body, tail) of a chunk: the body lies between its first and its last reset point."""
        first = SAFE.search(chunk)
        if first is None:
            return chunk, False, "", ""
        last = chunk.rfind(" ")
        while not (0 < last < len(chunk) - 1 and SAFE.match(chunk, last)):
            last = chunk.rfind(" ", 0, last)
        return chunk[: first.start()], True, chunk[first.start() : last], chunk[last:]

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if not a.closed:
            return ChunkMap(a.head + b.head, b.closed, b.count, b.tail)
        if not b.closed:
            return ChunkMap(a.head, True, a.count, a.tail + b.head)
        return ChunkMap(a.head, True, a.count + self.runs([a.tail + b.head])[0] + b.count, b.tail)

    def counts(self, texts: list[str], chunk_chars: int = CHUNK_CHARS) -> list[int]:
        short = [i for i, t in enumerate(texts) if len(t) <= chunk_chars]
        out = [0] * len(texts)
        for i, n in zip(short, self.runs([texts[i] for i in short])):
            out[i] = n
        for i, text in enumerate(texts):
            if len(text) > chunk_chars:
                # The special string is one token and a reset point of its own.
                segments = text.split(SPECIAL)
                out[i] = len(segments) - 1 + sum(self._long(s, chunk_chars) for s in segments)
        return out

    def _long(self, text: str, chunk_chars: int) -> int:
        cuts = [self.cut(text[i : i + chunk_chars]) for i in range(0, len(text), chunk_chars)]
        maps = [ChunkMap(h, c, n, t) for (h, c, _, t), n in zip(cuts, self.runs([body for _, _, body, _ in cuts]))]
        while len(maps) > 1:  # neighbours by pairs: the levels of a parallel scan
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return sum(self.runs([maps[0].head, maps[0].tail])) + maps[0].count if maps else 0


@cache
def counter(name: str) -> Counter:
    """One per worker process: what it has compiled serves all tasks."""
    return Counter(public_tokenizers.path(name))


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json",
    limit: int = 1024, chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` per row of ``docs``.

    A NULL text counts as empty (0 bytes, 0 tokens). Repeated rows and NULL keys give a row each; other columns are
    not read. Nothing is shuffled.
    """

    def make():
        counts = counter(tokenizer).counts

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n_bytes = pa.array([len(t.encode()) for t in texts], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column("id"), n_bytes, pa.array(counts(texts, chunk_chars), pa.int64())], ["id", "n_bytes", "n_tokens"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    made = map_batches(picked(docs, id_col, text_col), make, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return made.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
