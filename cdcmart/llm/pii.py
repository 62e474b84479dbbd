"""Personal data: patterns, and a skip-chain conditional random field that keeps labels consistent in a document.

The patterns give the base spans. Each document is then a factor graph. Its nodes are the base spans, whose labels are
observed, and the other words that hold a digit or an ``@``; all other words are O with certainty and leave the graph.
Neighbouring nodes share a chain potential. Distant nodes that are repeated or similar (same last seven digits, same
name in front of an ``@``) share a skip potential that charges disagreement. Sum-product message passing over this
loopy graph gives marginals; a word whose most likely label is personal data becomes a span of its own. So a number
without its country code, or the name part of an address, is found where the whole form stands elsewhere in the text.

Skip edges run from every node to the hub of its group, the first observed node or else the first one, so a group of
k similar words has k - 1 edges and not all pairs.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import map_batches, picked

KINDS = ("email", "ip", "card", "phone")
# Log potentials. A word of fitting shape pays SHAPED to be personal data, any other pays UNSHAPED; a skip edge pays
# DISAGREE for unequal labels; neighbours of one kind gain CHAIN. A label needs evidence from an observed span:
# without one, all O is the most likely labelling whatever the number of edges, as SHAPED < 0.
SHAPED, UNSHAPED, DISAGREE, CHAIN, OBSERVED = -2.0, -12.0, -5.0, 0.3, 30.0
ROUNDS, DAMPING = 8, 0.3

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Nothing follows the repeated groups, so giving back what they have taken never helps; possessive, they keep no trail.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
SALIENT = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
NOT_DIGIT = re.compile(r"[^0-9]+")
EDGES = "\"'()[]{}<>,;:.!?"

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from their ``@``: the part before it reaches back as far as it can."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((0, start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns by kind, then start."""
    found = _emails(text)
    if not DIGIT.search(text):
        return found
    if "." in text:
        for m in IP.finditer(text):
            parts = (p.lstrip("0") for p in m[0].split("."))
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((3, *m.span()))
    return found


def _keys(word: str) -> list[str]:
    """What a word may be similar by."""
    keys = []
    digits = NOT_DIGIT.sub("", word)
    if len(digits) >= 7:
        keys.append(digits[-7:])
    name = word.lower().partition("@")[0]
    if len(name) >= 5 and not name.isdigit() and any(c.isalpha() for c in name):
        keys.append("@" + name)
    return keys


def _shapes(word: str) -> list[bool]:
    """Whether a word's shape allows each kind."""
    digits = len(NOT_DIGIT.sub("", word))
    letters = any(c.isalpha() for c in word)
    return [
        letters and ("@" in word or (digits > 0 and all(c in LOCAL for c in word))),
        not letters and "." in word and 4 <= digits <= 12,
        not letters and 12 <= digits <= 19,
        not letters and 7 <= digits <= 15,
    ]


class Graph:
    """Factor graphs of many documents side by side, in arrays of numbers: a word costs some tens of bytes."""

    def __init__(self):
        self.texts: list[str] = []
        self.doc, self.start, self.end, self.kind = array("i"), array("i"), array("i"), array("b")
        self.linked = array("b")  # whether a node shares a chain potential with the one before
        self.skip = array("q")  # ends of skip edges, one after the other

    def _words(self, text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """Words that hold a digit or an ``@``, without punctuation around them, outside the base spans."""
        k = 0
        for m in SALIENT.finditer(text):
            start, end = m.span()
            while start < end and text[start] in EDGES:
                start += 1
            while end > start and text[end - 1] in EDGES:
                end -= 1
            while k < len(taken) and taken[k][1] <= start:
                k += 1
            if end > start and not any(s < end and start < e for s, e in taken[k : k + 8]):
                yield start, end

    def add(self, doc: int, text: str, base: list[Span]) -> None:
        self.texts.append(text)
        spans = sorted((start, end, kind) for kind, start, end in base)
        words = ((start, end, -1) for start, end in self._words(text, [s[:2] for s in spans]))
        first = len(self.doc)
        before = None
        hubs: dict[str, int] = {}
        for start, end, kind in heapq.merge(spans, words):
            at = len(self.doc)
            for column, value in zip((self.doc, self.start, self.end, self.kind), (doc, start, end, kind)):
                column.append(value)
            self.linked.append(before is not None and start >= before and not text[before:start].strip())
            before = end
            for key in _keys(text[start:end]):
                hub = hubs.setdefault(key, at)
                if kind >= 0 and self.kind[hub] < 0:
                    hubs[key] = at
        for at in range(first, len(self.doc)):
            for key in _keys(text[self.start[at] : self.end[at]]):
                if hubs[key] != at:
                    self.skip.extend((hubs[key], at))

    def _unary(self, at: np.ndarray, texts: dict[int, str]) -> np.ndarray:
        rows = []
        for i in at.tolist():
            kind = self.kind[i]
            if kind >= 0:
                rows.append([-OBSERVED] + [0.0 if k == kind else -OBSERVED for k in range(4)])
            else:
                word = texts[self.doc[i]][self.start[i] : self.end[i]]
                rows.append([0.0] + [SHAPED if fits else UNSHAPED for fits in _shapes(word)])
        return np.array(rows).reshape(-1, 5)

    def found(self) -> list[tuple[int, int, int, int]]:
        """(document, kind, start, end) of the words labelled as personal data.

        In the rounds there are, a label travels that many edges. So only words as near to an observed node can take
        one, and what they take depends on nodes twice as far at most; all others leave the graph before it is solved.
        """
        kind = np.frombuffer(self.kind, np.int8)
        linked, skip = np.frombuffer(self.linked, np.int8)[1:] > 0, np.frombuffer(self.skip, np.int64).reshape(-1, 2)
        if not (kind < 0).any() or not (kind >= 0).any():
            return []
        steps = np.where(kind >= 0, 0, 4 * ROUNDS).astype(np.int8)
        for n in range(1, 2 * ROUNDS + 1):
            near = steps < n
            steps[1:][linked & near[:-1] & ~near[1:]] = n
            steps[:-1][linked & near[1:] & ~near[:-1]] = n
            for a, b in ((0, 1), (1, 0)):
                reached = skip[near[skip[:, a]], b]
                steps[reached] = np.minimum(steps[reached], n)
        kept = np.flatnonzero(steps <= 2 * ROUNDS)
        second = np.flatnonzero((np.diff(kept) == 1) & linked[kept[1:] - 1]) + 1
        chain = np.stack([second - 1, second], axis=1)
        skip = np.searchsorted(kept, skip[(steps[skip] <= 2 * ROUNDS).all(axis=1)])
        unary = self._unary(kept, dict(zip(dict.fromkeys(self.doc), self.texts)))
        label = marginals(unary, chain, skip).argmax(axis=1)
        out = []
        for k in np.flatnonzero((label > 0) & (kind[kept] < 0) & (steps[kept] <= ROUNDS)).tolist():
            i = int(kept[k])
            out.append((self.doc[i], int(label[k]) - 1, self.start[i], self.end[i]))
        return out


def marginals(unary: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Log beliefs by loopy sum-product, damped, all edges at once. Both potentials are the same for all edges of a kind,
    so a message is a sum over the labels and a correction of the one that is equal."""
    pairs = np.concatenate([chain, skip])
    if not len(pairs):
        return unary
    source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
    back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
    in_chain = np.tile(np.arange(len(pairs)) < len(chain), 2)
    others = np.where(in_chain, 1.0, np.exp(DISAGREE))[:, None]
    equal = np.where(in_chain[:, None], np.exp(CHAIN), 1.0) * np.ones(5)
    equal[in_chain, 0] = 1.0
    message = np.zeros((len(source), 5))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, target, message)
        out = belief[source]
        out -= message[back]
        np.exp(out - out.max(axis=1, keepdims=True), out=out)
        new = np.log(out.sum(axis=1, keepdims=True) * others + out * (equal - others))
        new -= new.max(axis=1, keepdims=True)
        message *= DAMPING
        message += (1 - DAMPING) * new
    belief = unary.copy()
    np.add.at(belief, target, message)
    return belief


def find(texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, each by kind, then start."""
    base = [base_spans(t) for t in texts]
    graph = Graph()
    for k, (text, spans) in enumerate(zip(texts, base)):
        if spans:  # without an observed node no word can leave O
            graph.add(k, text, spans)
    whole = [list(spans) for spans in base]
    for k, kind, start, end in graph.found():
        whole[k].append((kind, start, end))
    return [(b, sorted(w)) for b, w in zip(base, whole)]


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in angle brackets; of overlapping spans the union is replaced."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, base counts ``n_email, n_ip, n_card, n_phone``, ``base_sha256``, ``spans`` and ``n_added`` per row.

    A NULL text counts as empty. Repeated rows and NULL keys give a row each; other columns are not read. Positions
    are code points, ends exclusive. Nothing is shuffled.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = find([t or "" for t in batch.column("text").to_pylist()])
            counts = [pa.array([sum(k == kind for k, _, _ in b) for b, _ in found], pa.int64()) for kind in range(4)]
            digest = pa.array([hashlib.sha256(shown(b).encode()).hexdigest() for b, _ in found])
            spans = pa.array([shown(w) for _, w in found])
            added = pa.array([len(w) - len(b) for b, w in found], pa.int64())
            names = ["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
            return pa.RecordBatch.from_arrays([batch.column("id"), *counts, digest, spans, added], names)

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    return map_batches(picked(docs, id_col, text_col), make, schema).withColumnRenamed("id", id_col)


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced by ``<kind>``, and its length in ``length_col`` where
    that is named. NULL stays NULL; all rows and columns are kept."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(text_col).to_pylist()
            found = find([t or "" for t in texts])
            new = [t if t is None else masked(t, w) for t, (_, w) in zip(texts, found)]
            at = batch.schema.get_field_index(text_col)
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return step

    out = map_batches(docs, make, docs.schema)
    if length_col:
        length = F.coalesce(F.length(F.col(f"`{text_col}`")).cast(docs.schema[length_col].dataType), F.col(f"`{length_col}`"))
        out = out.withColumn(length_col, length)
    return out
