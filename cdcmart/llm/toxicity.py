"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters as the sum of two inputs: the mean of embeddings of its character 4-grams, which any word has, and an
embedding of its own if it was frequent enough in training. Two gated recurrent layers read a window of words in
opposite directions, attention pools their states, and a logistic unit scores the window. A document scores as its
highest window; windows overlap and cover the whole text.

Training is by documents: an example is the window of the document that scores highest so far, so long documents with
a few bad words are learned from as well as short ones.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import map_batches, picked

WINDOW, STRIDE = 64, 48
HIDDEN, DIM = 8, 8
GRAM, GRAM_BUCKETS = 4, 1 << 14
# Bounds of the training sample: documents per class, their length, and the words with an embedding of their own.
SAMPLE_PER_CLASS, SAMPLE_CHARS, VOCABULARY, LEAST_DOCS = 1500, 8_000, 20_000, 8
EPOCHS, BATCH, RATE = 8, 64, 0.02
KEPT_WORDS = 100_000
LONGEST_WORD, PART_CHARS = 64, 16
THRESHOLD = 0.3

Params = dict[str, np.ndarray]


def _grams(word: str) -> list[int]:
    s = f"<{word}>".encode()
    return [zlib.crc32(s[i : i + GRAM]) % GRAM_BUCKETS for i in range(max(1, len(s) - GRAM + 1))]


def words_of(text: str) -> list[str]:
    """Words between white space. Longer ones than any word, as in writing without spaces, are cut into overlapping parts,
    so that windows move over them too."""
    words = text.lower().split()
    if not words or max(map(len, words)) <= LONGEST_WORD:
        return words
    step = PART_CHARS // 2
    return [p for w in words for p in ([w] if len(w) <= LONGEST_WORD else [w[i : i + PART_CHARS] for i in range(0, len(w) - step, step)])]


class Model(NamedTuple):
    params: Params
    vocabulary: dict[str, int]
    base_rate: float | None  # set where no network could be trained: every text scores it


class Lexicon:
    """Words as rows of character and word inputs, numbered as they come."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary, self.row, self.grams, self.own = vocabulary, {}, [], []

    def rows(self, words: list[str]) -> list[int]:
        out = []
        for w in words:
            r = self.row.get(w)
            if r is None:
                r = self.row[w] = len(self.row)
                self.grams.append(_grams(w))
                self.own.append(self.vocabulary.get(w, -1))
            out.append(r)
        return out


def windows_of(n: int) -> list[tuple[int, int]]:
    """Overlapping windows over n words, the last one ending with them."""
    if n <= WINDOW:
        return [(0, n)] if n else []
    starts = [*range(0, n - WINDOW, STRIDE), n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _direction(x: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: bool):
    """States of one gated recurrent layer over x (time, batch, 3 HIDDEN: update, reset, candidate inputs)."""
    steps, n = x.shape[:2]
    h = np.zeros((n, HIDDEN), np.float32)
    states, saved = np.empty((steps, n, HIDDEN), np.float32), []
    for t in range(steps):
        hu = h @ u
        zr = _sigmoid(x[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        part = hu[:, 2 * HIDDEN :]
        c = np.tanh(x[t, :, 2 * HIDDEN :] + r * part)
        new = (z * h + (1 - z) * c) * mask[t]
        if keep:
            saved.append((h, z, r, c, part))
        states[t] = h = new
    return states, saved


def _direction_back(grad: np.ndarray, mask: np.ndarray, u: np.ndarray, saved: list):
    """Gradients of the inputs and of u from those of the states."""
    dx = np.empty((*grad.shape[:2], 3 * HIDDEN), np.float32)
    du, dh = np.zeros_like(u), np.zeros(grad.shape[1:], np.float32)
    for t in range(len(grad) - 1, -1, -1):
        h, z, r, c, part = saved[t]
        d = (grad[t] + dh) * mask[t]
        dc = d * (1 - z) * (1 - c * c)
        dz = d * (h - c) * z * (1 - z)
        dr = dc * part * r * (1 - r)
        dx[t] = np.concatenate([dz, dr, dc], axis=1)
        dhu = np.concatenate([dz, dr, dc * r], axis=1)
        du += h.T @ dhu
        dh = d * z + dhu @ u.T
    return dx, du


def forward(p: Params, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows; x holds the projected inputs of both directions (time, batch, 6 HIDDEN)."""
    fwd, sf = _direction(x[:, :, : 3 * HIDDEN], mask, p["uf"], keep)
    bwd, sb = _direction(x[::-1, :, 3 * HIDDEN :], mask[::-1], p["ub"], keep)
    h = np.concatenate([fwd, bwd[::-1]], axis=2)
    e = np.where(mask[:, :, 0] > 0, h @ p["att"], -1e9)
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", a, h)
    return pooled @ p["out"] + p["bias"][0], (h, a, pooled, sf, sb)


def backward(p: Params, mask: np.ndarray, dlogit: np.ndarray, kept) -> tuple[Params, np.ndarray]:
    h, a, pooled, sf, sb = kept
    g = {"out": pooled.T @ dlogit, "bias": dlogit.sum(keepdims=True)}
    dpool = dlogit[:, None] * p["out"]
    da = np.einsum("nh,tnh->tn", dpool, h)
    de = a * (da - (a * da).sum(axis=0))
    g["att"] = np.einsum("tn,tnh->h", de, h)
    dh = a[:, :, None] * dpool + de[:, :, None] * p["att"]
    dxf, g["uf"] = _direction_back(dh[:, :, :HIDDEN], mask, p["uf"], sf)
    dxb, g["ub"] = _direction_back(dh[::-1, :, HIDDEN:], mask[::-1], p["ub"], sb)
    return g, np.concatenate([dxf, dxb[::-1]], axis=2)


def embed(p: Params, grams: list[list[int]], own: list[int]) -> np.ndarray:
    """Inputs of words: the mean of the 4-gram embeddings plus their own embedding, if any."""
    if not grams:
        return np.zeros((0, DIM), np.float32)
    sizes = np.array([len(g) for g in grams])
    flat = np.concatenate([np.array(g) for g in grams])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    chars = np.add.reduceat(p["char"][flat], starts, axis=0) / sizes[:, None].astype(np.float32)
    own = np.array(own)
    chars[own >= 0] += p["word"][own[own >= 0]]
    return chars


def _padded(rows: list[np.ndarray]) -> np.ndarray:
    """Windows as columns (time, batch), -1 behind their ends."""
    out = np.full((max(map(len, rows)), len(rows)), -1, np.int64)
    for k, r in enumerate(rows):
        out[: len(r), k] = r
    return out


def _logits(p: Params, projected: np.ndarray, windows: list[np.ndarray]) -> np.ndarray:
    """Scores of windows given as rows of ``projected``; windows of like length share a batch."""
    out = np.empty(len(windows), np.float32)
    order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
    for at in range(0, len(order), 1024):
        some = order[at : at + 1024]
        idx = _padded([windows[i] for i in some])
        mask = (idx >= 0).astype(np.float32)[:, :, None]
        out[some] = forward(p, projected[idx], mask)[0]
    return out


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """A model of labelled texts; without both classes, the share of label 1 (0 if there are no texts)."""
    used = [(w, y) for t, y in zip(texts, labels) if (w := words_of(t))]
    y = np.array([v for _, v in used], np.float32)
    if not len(y) or y.min() == y.max():
        return Model({}, {}, float(np.mean(labels)) if len(labels) else 0.0)
    seen: dict[str, int] = {}
    for words, _ in used:
        for w in set(words):
            seen[w] = seen.get(w, 0) + 1
    frequent = sorted((w for w, n in seen.items() if n >= LEAST_DOCS), key=lambda w: (-seen[w], w))[:VOCABULARY]
    lexicon = Lexicon({w: i for i, w in enumerate(frequent)})
    windows, owner = [], []
    for k, (words, _) in enumerate(used):
        rows = np.array(lexicon.rows(words))
        for s, e in windows_of(len(rows)):
            windows.append(rows[s:e])
            owner.append(k)
    owner = np.array(owner)
    first = np.searchsorted(owner, np.arange(len(used)))
    n_windows = np.bincount(owner, minlength=len(used))

    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p: Params = {
        "char": (rng.standard_normal((GRAM_BUCKETS, DIM)) * 0.1).astype(np.float32),
        "word": np.zeros((max(1, len(frequent)), DIM), np.float32),
        "w": draw(DIM, 6 * HIDDEN), "b": np.zeros(6 * HIDDEN, np.float32),
        "uf": draw(HIDDEN, 3 * HIDDEN), "ub": draw(HIDDEN, 3 * HIDDEN),
        "att": np.zeros(2 * HIDDEN, np.float32), "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32),
    }
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    steps = 0
    for epoch in range(EPOCHS):
        scores = _logits(p, embed(p, lexicon.grams, lexicon.own) @ p["w"] + p["b"], windows) if epoch else rng.random(len(windows))
        best = np.array([f + int(np.argmax(scores[f : f + n])) for f, n in zip(first, n_windows)])
        # Before there is anything to choose windows by, only texts of few windows are learned from.
        examples = np.flatnonzero(n_windows <= 3) if epoch < 2 and (n_windows <= 3).sum() > 100 else np.arange(len(used))
        rng.shuffle(examples)
        for at in range(0, len(examples), BATCH):
            docs = examples[at : at + BATCH]
            idx = _padded([windows[best[d]] for d in docs])
            mask = (idx >= 0).astype(np.float32)[:, :, None]
            words, place = np.unique(idx, return_inverse=True)
            place = place.reshape(idx.shape)
            words[words < 0] = 0
            grams, own = [lexicon.grams[w] for w in words], np.array([lexicon.own[w] for w in words])
            inputs = embed(p, grams, own)
            logit, kept = forward(p, (inputs @ p["w"] + p["b"])[place], mask, True)
            dlogit = (_sigmoid(logit) - y[docs]) / len(docs)
            g, dx = backward(p, mask, dlogit.astype(np.float32), kept)
            dx = (dx * mask).reshape(-1, 6 * HIDDEN)
            dproj = np.zeros((len(words), 6 * HIDDEN), np.float32)
            np.add.at(dproj, place.ravel(), dx)
            g["w"], g["b"] = inputs.T @ dproj, dproj.sum(axis=0)
            dinput = dproj @ p["w"].T
            sizes = np.array([len(x) for x in grams])
            g["char"] = np.zeros_like(p["char"])
            np.add.at(g["char"], np.concatenate([np.array(x) for x in grams]), np.repeat(dinput / sizes[:, None], sizes, axis=0))
            g["word"] = np.zeros_like(p["word"])
            np.add.at(g["word"], own[own >= 0], dinput[own >= 0])
            steps += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v2[k] = 0.99 * v2[k] + 0.01 * g[k] ** 2
                p[k] -= (RATE * (1 - epoch / EPOCHS) * (m[k] / (1 - 0.9**steps)) / (np.sqrt(v2[k] / (1 - 0.99**steps)) + 1e-6)).astype(np.float32)
    return Model(p, lexicon.vocabulary, None)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.lexicon = Lexicon(self.model.vocabulary)
        self.projected = np.zeros((1 << 15, 6 * HIDDEN), np.float32)
        self.done = 0

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.model.base_rate is not None:
            return np.full(len(texts), self.model.base_rate)
        p = self.model.params
        if len(self.lexicon.row) > KEPT_WORDS:
            self._reset()
        windows, owner = [], []
        for k, text in enumerate(texts):
            rows = np.array(self.lexicon.rows(words_of(text)), np.int64)
            for s, e in windows_of(len(rows)):
                windows.append(rows[s:e])
                owner.append(k)
        total = len(self.lexicon.row)
        if total > len(self.projected):
            grown = np.zeros((max(total, 2 * len(self.projected)), 6 * HIDDEN), np.float32)
            grown[: self.done] = self.projected[: self.done]
            self.projected = grown
        self.projected[self.done : total] = embed(p, self.lexicon.grams, self.lexicon.own) @ p["w"] + p["b"]
        # A projected word is known by its row alone.
        self.lexicon.grams, self.lexicon.own, self.done = [], [], total
        out = np.zeros(len(texts))  # a text without words has no window to be toxic
        if windows:
            np.maximum.at(out, owner, _sigmoid(_logits(p, self.projected, windows).astype(np.float64)))
        return out


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[list[str], list[int]]:
    """Texts and labels of a bounded sample: up to SAMPLE_PER_CLASS documents of each class, drawn by hash among the
    labelled ones outside the held-out quarter, of up to SAMPLE_CHARS characters."""
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    marks = marks.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id"))).dropDuplicates(["id"])
    # Three times as many keys as needed, as some texts will be missing or too long; drawn from the labels alone.
    drawn = None
    for label in (0, 1):
        some = marks.where(F.col("label") == label).orderBy(F.xxhash64("id", F.lit(11)), "id").limit(3 * SAMPLE_PER_CLASS)
        drawn = some if drawn is None else drawn.union(some)
    texts = picked(docs, id_col, text_col).where(F.length("text").between(1, SAMPLE_CHARS))
    found = texts.join(F.broadcast(drawn), "id").select("id", "text", "label")  # at most 6 SAMPLE_PER_CLASS keys
    kept = []
    top = [found.where(F.col("label") == v).orderBy(F.xxhash64("id", F.lit(11)), "id", "text").limit(SAMPLE_PER_CLASS) for v in (0, 1)]
    for r in top[0].union(top[1]).collect():
        kept.append((r["text"], r["label"]))
    return [t for t, _ in kept], [v for _, v in kept]


def held_out(id_column):
    """The quarter of the documents that is never learned from."""
    return (F.crc32(id_column.cast("string").cast("binary")) % 4) == 2


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    NULL and empty texts score 0, as they have no window. Rows with a NULL key are scored, never learned from, and not
    held out. Labels other than 0 and 1, NULL labels and labels of unknown keys are not used; of several labels for a
    key one counts. Without labels of both classes every text scores the share of label 1 in the sample. Other columns
    are not read. The sample is fitted when this is called; scoring shuffles nothing.
    """
    model = train(*sample(docs, labels, id_col, text_col, label_col))

    def make():
        score = Scorer(model).scores  # of one task: what it keeps goes with it

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score(texts))], ["id", "score"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    scored = map_batches(picked(docs, id_col, text_col), make, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, whole; a text without words is kept."""
    model = train(*sample(docs, labels, id_col, text_col, label_col))

    def make():
        score = Scorer(model).scores

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = score([t or "" for t in batch.column(text_col).to_pylist()])
            return batch.filter(pa.array(scores < threshold))

        return step

    return map_batches(docs, make, docs.schema)
