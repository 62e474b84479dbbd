"""Licence notices by a trained paragraph classifier, confirmed by comparison with templates.

Sparse word n-grams feed a softmax regression over licence families and an unknown class. It is trained here on the
templates, on damaged copies of them, and on ordinary sentences that use the same words. A temperature fitted on other
damaged copies calibrates its probabilities. Every line is looked at whole and in overlapping windows of the lengths of the
templates. A prediction counts only if the window also shares enough word pairs with a template of the predicted family,
one of them a pair that no other family has.
"""

from __future__ import annotations

import re
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cdcmart.llm.common import map_batches, picked

UNKNOWN = "unknown"
# Short notices by family.
TEMPLATES = {
    "agpl": (
        "Licensed under the AGPL, version 3.",
        "This program is licensed under the GNU Affero General Public License, version 3.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "This project is released under the Apache License 2.0.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Distributed under the BSD 3-Clause License.",
        "This software is released under the BSD license.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-nc-nd": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "cc-by-nc-sa": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "epl": (
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Licensed under the GPL, version 2 or later.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "Released under the ISC License.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the LGPL, version 3.",
    ),
    "mit": (
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "Licensed under the MIT license.",
        "Published under MIT terms.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ),
    "reserved": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without permission.",
        "Alle Rechte vorbehalten.",
        "Tous droits réservés.",
        "Todos los derechos reservados.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ),
}
# Sentences with the words of notices that grant nothing.
OTHER = (
    "He lost his driving license last year.", "The public library was open to all.", "She asked for permission to leave the room.",
    "The software is free and the source was published.", "All seats were reserved for the guests.", "The restaurant reserved a table.",
    "You need a fishing license to use this lake.", "The general said that the public was right.", "The rights of the workers were published.",
    "A version of the work was released in May.", "The apache helicopter landed at the base.", "The foundation gave the program a new form.",
    "The warranty covers the following conditions.", "Copyright law is a matter of dispute in the courts.", "The copyright debate goes on.",
    "She is licensed under the state board.", "He works under the terms of his contract.", "The bar is licensed to sell wine under local law.",
    "They discussed whether the license should be renewed.", "The terms of the agreement were not published.", "Under the law all men have rights.",
)
# A paragraph without any of these cannot be a notice; every template has one.
STEMS = (
    "licen", "copyright", "rights reserved", "redistribut", "permission", "public domain", "gpl", "creative commons", "cc by", "cc-by", "cc0",
    "apache", "mozilla public", "bsd", "free software", "related rights", "eclipse public", "mit terms", "vorbehalten", "droits r", "reservados",
)
# Words that stand in notices of all kinds. A pair of two of these, or of one and a number, names no family.
COMMON = frozenset(
    "the to of is this and or a in you may not be as with under it any for all an on that are no license licensed version released work public "
    "terms software program free use at into".split()
)
# Words of the windows that a line is cut into, as long as the examples of the training.
LENGTHS = (4, 8, 16, 32, 48)
WORD = re.compile(r"[a-z0-9]+(?:[.][0-9]+)*")
LEAST_PROBABILITY, LEAST_SHARED = 0.5, 0.6
SEED, COPIES, ROUNDS, PENALTY = 5, 16, 80, 1e-4


def words_of(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def pairs(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:])) or {tuple(words)}


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Model(NamedTuple):
    classes: list[str]
    column: dict[str, int]
    weights: np.ndarray
    temperature: float

    def features(self, words: list[str]) -> list[int]:
        return [c for g in grams(words) if (c := self.column.get(g)) is not None]

    def logits(self, rows: list[list[str]]) -> np.ndarray:
        out = np.empty((len(rows), len(self.classes)))
        for k, words in enumerate(rows):
            found = self.features(words)
            out[k] = self.weights[-1] + self.weights[found].sum(axis=0) / max(1.0, len(grams(words)) ** 0.5)
        return out / self.temperature


def _damaged(words: list[str], fill: list[str], rng: np.random.Generator) -> list[str]:
    """A copy with a tenth of the words dropped and up to six others around it."""
    kept = [w for w in words if rng.random() > 0.1] or words
    before, after = (list(rng.choice(fill, rng.integers(0, 4))) for _ in range(2))
    return before + kept + after


@cache
def model() -> Model:
    """Trained once on the driver, from the fixed values alone; tasks are given the weights."""
    rng = np.random.default_rng(SEED)
    classes = [*sorted(TEMPLATES), UNKNOWN]
    others = [words_of(s) for s in OTHER]
    fill = sorted({w for s in others for w in s})

    def examples(copies: int) -> list[tuple[list[str], int]]:
        rows = []
        for k, c in enumerate(classes):
            for words in others if c == UNKNOWN else map(words_of, TEMPLATES[c]):
                rows.append((words, k))
                rows += [(_damaged(words, fill, rng), k) for _ in range(copies if c != UNKNOWN else copies // 4)]
        return rows

    train = examples(COPIES)
    column = {g: i for i, g in enumerate(sorted({g for w, _ in train for g in grams(w)}))}
    made = Model(classes, column, np.zeros((len(column) + 1, len(classes))), 1.0)
    x = np.zeros((len(train), len(column) + 1), np.float32)
    for k, (words, _) in enumerate(train):
        x[k, made.features(words)] = 1 / len(grams(words)) ** 0.5
    x[:, -1] = 1.0
    y = np.eye(len(classes), dtype=np.float32)[[c for _, c in train]]
    weights = made.weights.astype(np.float32)
    speed = np.zeros_like(weights)
    for _ in range(ROUNDS):
        grad = x.T @ (_softmax(x @ weights) - y) / len(train) + PENALTY * weights
        speed = 0.9 * speed - 8.0 * grad
        weights = weights + speed
    made = made._replace(weights=weights)
    held = examples(COPIES // 2)
    logit, truth = made.logits([w for w, _ in held]), [c for _, c in held]
    loss = lambda t: -np.log(_softmax(logit / t)[np.arange(len(truth)), truth] + 1e-12).mean()
    return made._replace(temperature=min(np.geomspace(0.25, 4, 33), key=loss))


@cache
def template_pairs(family: str) -> list[set[tuple[str, ...]]]:
    return [pairs(words_of(t)) for t in TEMPLATES[family]]


@cache
def telling(family: str) -> frozenset[tuple[str, ...]]:
    """Word pairs of the family's templates that no other family and no ordinary sentence has, with a word that names
    something: what it shares with all others, such as "licensed under the", confirms nothing."""
    elsewhere = {p for other in TEMPLATES if other != family for t in template_pairs(other) for p in t}
    elsewhere |= {p for s in OTHER for p in pairs(words_of(s))}
    own = {p for t in template_pairs(family) for p in t}
    return frozenset(p for p in own - elsewhere if any(w.isalpha() and len(w) > 1 and w not in COMMON for w in p))


def confirmed(words: list[str], family: str) -> bool:
    """Whether the word pairs of some template lie in the paragraph, or the paragraph's in it, for the most part, and one
    of them tells the family from the others."""
    own = pairs(words)
    if own.isdisjoint(telling(family)):
        return False
    return any(len(own & t) >= LEAST_SHARED * min(len(own), len(t)) for t in template_pairs(family))


def shared_span(words: list[str], family: str) -> tuple[int, int, int]:
    """How many word pairs are shared with the closest template of ``family``, and the shortest span that holds them."""
    own = list(zip(words, words[1:])) or [tuple(words)]
    template = max(template_pairs(family), key=lambda t: len(t.intersection(own)))
    last: dict[tuple[str, ...], int] = {}
    spans = []
    for i, pair in enumerate(own):
        if pair in template:
            last[pair] = i
            spans.append((-len(last), i + 2 - min(last.values()), min(last.values()), i + 2))
    return (-min(spans)[0], *min(spans)[2:]) if spans else (0, 0, len(words))


@cache
def known_words() -> frozenset[str]:
    return frozenset(w for notices in TEMPLATES.values() for t in notices for w in words_of(t))


def windows_of(words: list[str]) -> list[tuple[int, int]]:
    """The line, and overlapping windows of it around words of templates: a notice stands in one of about its length."""
    n = len(words)
    spans = {(0, n)}
    known = known_words()
    marks = np.cumsum([0] + [w in known for w in words])
    for size in LENGTHS:
        if size < n:
            starts = np.minimum(np.arange(0, n - size + size // 4, max(size // 4, 1)), n - size)
            # A window that holds less than two words of templates shares no pair with one.
            spans.update((int(i), int(i) + size) for i in starts[marks[starts + size] - marks[starts] >= 2])
    return sorted(spans)


def paragraphs(text: str) -> list[str]:
    """Lines that hold a word; notices of several lines are told by any of them."""
    return [p for p in text.split("\n") if p.strip()]


def classify(texts: list[str], m: Model) -> list[list[tuple[int, str, float]]]:
    """(paragraph number, family, probability) of the notices of each text, each family once a paragraph."""
    out: list[list[tuple[int, str, float]]] = [[] for _ in texts]
    for k, text in enumerate(texts):
        lower = text.lower()
        if not any(s in lower for s in STEMS):
            continue
        for i, p in enumerate(paragraphs(lower)):
            if any(s in p for s in STEMS):
                out[k] += [(i, f, c) for f, c in notices_in(words_of(p), m)]
    return out


def notices_in(words: list[str], m: Model) -> list[tuple[str, float]]:
    """Families and probabilities of a line. Where windows overlap, the one that shares most with a template counts, so
    that a part of a notice is not told as another one."""
    spans = windows_of(words)
    candidates = []
    for at in range(0, len(spans), 1000):
        some = spans[at : at + 1000]
        for (start, end), p in zip(some, _softmax(m.logits([words[s:e] for s, e in some]))):
            family, part = m.classes[int(p.argmax())], words[start:end]
            if family != UNKNOWN and p.max() >= LEAST_PROBABILITY and confirmed(part, family):
                shared, first, last = shared_span(part, family)
                candidates.append((-shared, -float(p.max()), start + first, start + last, family))
    taken: list[tuple[int, int]] = []
    found: dict[str, float] = {}
    for _, p, first, last, family in sorted(candidates):
        if all(last <= s or first >= e for s, e in taken):
            taken.append((first, last))
            found[family] = max(found.get(family, 0.0), -p)
    return sorted(found.items())


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_paragraphs, n_notices, families, notices`` per row of ``docs``: families sorted and comma-joined,
    notices as ``paragraph:family``, comma-joined; a paragraph has one of each of its families.

    A NULL text counts as empty. Repeated rows and NULL keys give a row each; other columns are not read. Nothing is
    shuffled.
    """

    trained = model()

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = classify(texts, trained)
            columns = [
                pa.array([len(paragraphs(t)) for t in texts], pa.int64()),
                pa.array([len(f) for f in found], pa.int64()),
                pa.array([",".join(sorted({c for _, c, _ in f})) for f in found]),
                pa.array([",".join(f"{i}:{c}" for i, c, _ in f) for f in found]),
            ]
            return pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n_paragraphs", "n_notices", "families", "notices"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_paragraphs bigint, n_notices bigint, families string, notices string"
    return map_batches(picked(docs, id_col, text_col), make, schema).withColumnRenamed("id", id_col)
