"""Texts cut at single spaces between two other characters.

At such a space every byte-level tokenizer of this family ends a pre-token, whatever stands around it, so the cuts are
reset points: what a piece yields does not depend on its neighbours and can be kept by piece.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPECIAL = "<|endoftext|>"
SAFE = re.compile(r"(?<=\S) (?=\S)")
# Most entries of the table of pieces; it starts anew when it is full, which changes the speed only.
KEPT_PIECES = 700_000


class PieceTable:
    """Values of pieces, made in batches by ``encode`` (of strings) and kept up to ``limit`` entries.

    Keys of ``after`` are pieces that follow a space, without it; ``first`` starts of segments."""

    def __init__(self, encode: Callable[[list[str]], list], special, limit: int = KEPT_PIECES):
        self.encode, self.special, self.limit = encode, special, limit
        self.after: dict[str, object] = {}

    @staticmethod
    def _plain(piece: str) -> bool:
        return bool(piece) and not piece[0].isspace() and not piece[-1].isspace()

    def values(self, texts: list[str]) -> list[list]:
        """The values of the pieces of each text, in order."""
        segments: list[tuple[int, str, list[str]]] = []
        for i, text in enumerate(texts):
            for k, segment in enumerate(text.split(SPECIAL)):
                if k:
                    segments.append((i, SPECIAL, []))
                if segment:
                    first, *rest = segment.split(" ")
                    segments.append((i, first, rest))
        if len(self.after) > self.limit:
            self.after.clear()
        fresh: set[str] = set()
        for _, _, rest in segments:
            fresh.update(rest)
        fresh.difference_update(self.after)
        odd = {p for p in fresh if not self._plain(p)}
        whole: list[tuple[int, str, list[str]]] = []
        for i, first, rest in segments:
            # A segment with white space beside a space, or at an end, is cut by the pattern instead.
            if first != SPECIAL and ((odd and not odd.isdisjoint(rest)) or (rest and not self._plain(first))):
                first, *rest = SAFE.split(" ".join([first, *rest]))
                fresh.update(p for p in rest if p not in self.after)
            whole.append((i, first, rest))
        new = list(fresh)
        starts = list({first for _, first, _ in whole if first != SPECIAL})
        made = self.encode([" " + p for p in new] + starts)
        table = self.after
        table.update(zip(new, made))
        at_start = dict(zip(starts, made[len(new):]))
        out: list[list] = [[] for _ in texts]
        for i, first, rest in whole:
            if first == SPECIAL and not rest:
                out[i].append(self.special)
                continue
            out[i].append(at_start[first])
            out[i].extend(map(table.__getitem__, rest))
        for p in odd:
            table.pop(p, None)
        return out


class PieceNumbers:
    """Numbers of pieces, counted from 0 in the order in which they are met.

    ``known`` holds the pieces that follow a space, without it; starts of segments are known within one call only."""

    def __init__(self):
        self.restart({})

    def restart(self, known: dict[str, int]) -> None:
        """Only ``known`` stays, which has the numbers from 0 to its size."""
        self.known, self.count = known, len(known)
        self.new: list[str] = []  # what has got the next numbers, with the space in front
        self.starts: dict[str, int] = {}

    def _next(self, text: str) -> int:
        self.new.append(text)
        self.count += 1
        return self.count - 1

    def _start(self, text: str) -> int:
        if text not in self.starts:
            self.starts[text] = self._next(text)
        return self.starts[text]

    def _after(self, piece: str) -> int:
        number = self.known.get(piece)
        if number is None:
            number = self.known[piece] = self._next(" " + piece)
        return number

    def _by_pattern(self, text: str) -> list[int]:
        """The numbers of a text with the special string, or with white space beside a space or at an end."""
        out = []
        for k, segment in enumerate(text.split(SPECIAL)):
            if k:
                out.append(self._start(SPECIAL))
            if segment:
                first, *rest = SAFE.split(segment)
                out.append(self._start(first))
                # Only the last piece may end with white space, which no other piece does.
                out += map(self._after, rest[:-1])
                out += [self._after(p) if p == p.strip() else self._start(" " + p) for p in rest[-1:]]
        return out

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the pieces of all texts, one text after the other, and how many each text has."""
        self.starts = {}
        signs = (SPECIAL, "  ", " \n", "\n ")
        plain = [i for i, t in enumerate(texts) if t and not any(sign in t for sign in signs)]
        cut = pc.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " ")
        offsets = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        at, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        first = np.zeros(len(at), bool)
        first[offsets[:-1]] = True
        follows = np.zeros(len(words), bool)  # the others are starts of texts only
        follows[at[~first]] = True
        number = np.array(list(map(self.known.get, words, repeat(-1))), np.int32)
        odd = np.zeros(len(words), bool)
        unknown = np.flatnonzero(number < 0)
        odd[unknown] = [w.strip() != w or not w for w in map(words.__getitem__, unknown.tolist())]
        fresh = np.flatnonzero((number < 0) & follows & ~odd)
        number[fresh] = np.arange(self.count, self.count + len(fresh))
        added = list(map(words.__getitem__, fresh.tolist()))
        self.known.update(zip(added, range(self.count, self.count + len(fresh))))
        self.new += [" " + w for w in added]
        self.count += len(fresh)
        bad = np.add.reduceat(odd[at], offsets[:-1]) > 0 if plain else np.zeros(0, bool)
        flat = number[at]
        flat[first] = [-1 if b else self._start(words[k]) for k, b in zip(at[first].tolist(), bad.tolist())]
        parts: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        for i, b, lo, hi in zip(plain, bad.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            parts[i] = np.array(self._by_pattern(texts[i]), np.int32) if b else flat[lo:hi]
        for i in set(range(len(texts))).difference(plain):
            parts[i] = np.array(self._by_pattern(texts[i]), np.int32)
        return np.concatenate([np.empty(0, np.int32), *parts]), np.array([len(x) for x in parts], np.int64)

    def taken(self) -> list[str]:
        """What was numbered since the last call, in order."""
        new, self.new = self.new, []
        return new
