"""Licence scans with a trained paragraph classifier.

A text is cut into paragraphs (lines, long ones in overlapping windows). A
multinomial logistic regression on the words and word pairs of a paragraph gives
the probability of each licence family and of none of them. It is trained on
variations of the templates below and, for the unknown class, on mixtures of
their words and on paragraphs of a bounded sample of documents; its confidence
is calibrated on variations held back from training. A predicted family counts
only if the paragraph also compares with a template of that family. What lies before
and behind a notice in a paragraph is classified again, for further notices.

Only words and pairs known from training have a weight, so a paragraph without
a known pair is unknown without further work.

Defined results: a null or empty text has no paragraphs and no licence; repeated
rows are scanned one by one; an empty table gives no rows and training then uses
templates only; columns other than id and text are not read.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import text_bytes

# --- fixed values: notices by which the licences are commonly declared --------

TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may"
        " not use this file except in compliance with the License. You may"
        " obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software"
        " distributed under the License is distributed on an AS IS BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or"
        " implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining"
        " a copy of this software and associated documentation files (the"
        " Software), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be"
        " included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License",
        "Use of this source code is governed by a BSD-style license",
        "Redistribution and use in source and binary forms, with or without"
        " modification, are permitted provided that the following conditions"
        " are met",
        "Redistributions in binary form must reproduce the above copyright"
        " notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify"
        " it under the terms of the GNU General Public License as published by"
        " the Free Software Foundation, either version 3 of the License, or"
        " (at your option) any later version.",
        "You should have received a copy of the GNU General Public License"
        " along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software"
        " Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public"
        " License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0"
        " International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike"
        " 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons"
        " Attribution-NonCommercial 4.0 International License.",
    ),
    "public-domain": (
        "CC0 1.0 Universal Public Domain Dedication",
        "This work has been dedicated to the public domain; the author has"
        " waived all copyright and related rights.",
        "This is free and unencumbered software released into the public"
        " domain.",
    ),
    "proprietary": (
        "All rights reserved",
        "Copyright by the publisher. All rights reserved. No part of this"
        " publication may be reproduced, distributed, or transmitted in any"
        " form without the prior written permission of the publisher.",
        "Proprietary and confidential. Unauthorized copying of this file, via"
        " any medium, is strictly prohibited.",
    ),
}
LEAD_INS = (
    "", "", "", "", "copyright 2019", "copyright 2021 by the authors",
    "notice", "license", "this work", "the content of this page is",
    "unless stated otherwise", "source code",
)
# What speaks of licences without being one of these families.
UNKNOWN = (
    "Licensed under the terms of the enclosed agreement",
    "You may need a license to drive in this country",
    "See the license for details",
    "The rights of the author are protected by law",
    "This software is distributed in the hope that it will be useful",
    "All of the reserved seats were on the right",
    "Version 2.0 was released under the new management",
    "The general public was permitted to use the source",
    "Licensed under the Example Company Commercial Terms, version 7",
    "published by the foundation for free education",
)

FAMILIES = tuple(TEMPLATES)
# Variations of the notices of each family in training.
EXAMPLES = 600
WINDOW = 48
STRIDE = 24
SAMPLE_DOCS = 300
SAMPLE_PARAGRAPHS = 3000
CONFIRM = 0.6
# Words between two pairs of one notice.
NEAR = 4

TO_WORDS = bytes(
    i + 32 if 0x41 <= i <= 0x5A
    else i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80
    else 0x20
    for i in range(256)
)
OTHER = b""  # any word that no notice has
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(data: bytes) -> list[bytes]:
    return data.translate(TO_WORDS).split()


def pairs_of(words: list) -> list[tuple]:
    return list(zip(words, words[1:]))


# --- training ----------------------------------------------------------------


def variation(words: list[bytes], rng: random.Random) -> list[bytes]:
    """A notice as others might write it: cut, with words lost or replaced,
    and with something in front of it or behind it."""
    if len(words) > 12 and rng.random() < 0.5:
        start = rng.randrange(len(words) - 10)
        words = words[start : start + rng.randrange(10, 40)]
    loss = 0.0 if len(words) < 7 else rng.choice((0.0, 0.05, 0.1))
    kept = [w for w in words if rng.random() >= loss]
    front = words_of(rng.choice(LEAD_INS).encode())
    behind = words_of(rng.choice(LEAD_INS).encode())
    if rng.random() < 0.4:  # inside other text
        room = max(WINDOW - len(kept), 2)
        front = [OTHER] * rng.randrange(room) + front
        behind += [OTHER] * max(room - len(front) - rng.randrange(room), 0)
    return front + kept + behind


class Example(NamedTuple):
    words: list[bytes]
    label: int


def examples(paragraphs: list[list[bytes]], seed: int = 7) -> list[Example]:
    """Training paragraphs; the last label is the unknown class."""
    rng = random.Random(seed)
    found = []
    for label, family in enumerate(FAMILIES):
        notices = [words_of(t.encode()) for t in TEMPLATES[family]]
        for k in range(EXAMPLES):
            found.append(
                Example(variation(notices[k % len(notices)], rng), label)
            )
    none = len(FAMILIES)
    pool = [
        w for ts in TEMPLATES.values() for t in ts for w in words_of(t.encode())
    ]
    for k in range(600):
        found.append(
            Example([rng.choice(pool) for _ in range(rng.randrange(2, 30))], none)
        )
    for k in range(600):
        found.append(
            Example(
                variation(words_of(UNKNOWN[k % len(UNKNOWN)].encode()), rng), none
            )
        )
    found += [Example(p, none) for p in paragraphs]
    rng.shuffle(found)
    return found


class Model(NamedTuple):
    words: dict[bytes, int]
    pairs: dict[tuple[int, int], int]
    weights: np.ndarray  # a row per feature and the bias, a column per class
    temperature: float


def features(words: list[bytes], vocabulary: dict, pairs: dict) -> tuple:
    """Slots and values; unknown words shorten all others."""
    ids = list(map(vocabulary.get, words))
    slots = [i for i in ids if i is not None]
    slots += [
        p for p in map(pairs.get, zip(ids, ids[1:])) if p is not None
    ]
    found, counts = np.unique(np.array(slots, np.int64), return_counts=True)
    return found, np.log1p(counts) / max(len(words), 1) ** 0.25 * 2.0


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(paragraphs: list[list[bytes]], steps: int = 200) -> Model:
    """Fit on four fifths of the examples, calibrate on the rest."""
    rows = examples(paragraphs)
    vocabulary: dict[bytes, int] = {}
    pairs: dict[tuple[int, int], int] = {}
    none = len(FAMILIES)
    for words, label in rows:
        if label != none:
            for w in words:
                if w != OTHER:
                    vocabulary.setdefault(w, len(vocabulary))
    for words, label in rows:
        if label != none:
            ids = list(map(vocabulary.get, words))
            for pair in zip(ids, ids[1:]):
                if None not in pair:
                    pairs.setdefault(pair, len(vocabulary) + len(pairs))
    size = len(vocabulary) + len(pairs)
    matrix = np.zeros((len(rows), size + 1), np.float32)
    matrix[:, size] = 1
    for k, (words, _) in enumerate(rows):
        slots, values = features(words, vocabulary, pairs)
        matrix[k, slots] = values
    labels = np.array([r.label for r in rows])
    held = np.arange(len(rows)) % 5 == 0
    x, y = matrix[~held], np.eye(none + 1, dtype=np.float32)[labels[~held]]
    weights = np.zeros((size + 1, none + 1), np.float32)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        slope = x.T @ (softmax(x @ weights) - y) / len(x) + 1e-5 * weights
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        weights -= (
            0.1
            * (mean / (1 - 0.9**step))
            / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        )
    logits = matrix[held] @ weights
    loss = {
        t: -np.log(
            softmax(logits / t)[np.arange(held.sum()), labels[held]] + 1e-12
        ).mean()
        for t in np.geomspace(0.25, 8, 41)
    }
    return Model(vocabulary, pairs, weights, float(min(loss, key=loss.get)))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model with the unknown class taught by ``sample_docs`` documents,
    those with the lowest hashes of their ids."""
    drawn = (
        docs.select("doc_id")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_docs)
    )
    texts = (
        docs.join(F.broadcast(drawn), "doc_id", "left_semi")
        .select(F.explode(F.split("text", "\n")).alias("line"))
        .distinct()
        .orderBy(F.xxhash64("line"), "line")
        .limit(SAMPLE_PARAGRAPHS)
        .collect()
    )
    paragraphs = [
        words[:WINDOW]
        for words in (words_of(row.line.encode()) for row in texts)
        if words and max(similarity(words, f) for f in FAMILIES) < CONFIRM
    ]
    return train(paragraphs)


# --- scanning ----------------------------------------------------------------


def similarity(words: list[bytes], family: str) -> float:
    """Share of word pairs that a paragraph and the nearest template of a
    family have in common, of the shorter of the two."""
    own, best = set(pairs_of(words)), 0.0
    for template in TEMPLATES[family]:
        other = set(pairs_of(words_of(template.encode())))
        size = min(len(own), len(other))
        if size:
            best = max(best, len(own & other) / size)
    return best


def windows(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of words in a line; every short passage is whole in one."""
    if n <= WINDOW:
        yield 0, n
        return
    for start in range(0, n - WINDOW + STRIDE, STRIDE):
        yield start, min(start + WINDOW, n)


def confirmed(part: list[bytes], model: Model) -> tuple | None:
    """The likeliest family, of those likelier than none of them, that compares
    with a template; with its probability and similarity."""
    slots, values = features(part, model.words, model.pairs)
    if not len(slots) or slots[-1] < len(model.words):
        return None
    logit = values @ model.weights[slots] + model.weights[-1]
    p = softmax(logit / model.temperature)
    for label in np.argsort(-p, kind="stable"):
        if label == len(FAMILIES):
            return None
        alike = similarity(part, FAMILIES[label])
        if alike >= CONFIRM:
            return FAMILIES[label], float(p[label]), alike
    return None


def shared_words(part: list[bytes], family: str) -> list[int]:
    """Places of the pairs that a paragraph shares with the nearest template,
    where most of them lie close together."""
    places: list[int] = []
    for template in TEMPLATES[family]:
        other = set(pairs_of(words_of(template.encode())))
        own = [k for k, pair in enumerate(pairs_of(part)) if pair in other]
        cuts = [k for k in range(1, len(own)) if own[k] - own[k - 1] > NEAR]
        for one, other in zip([0, *cuts], [*cuts, len(own)]):
            places = max(places, own[one:other], key=len)
    return places


def notices(words: list[bytes], a: int, b: int, model: Model) -> list[tuple]:
    """Ranges of words with a confirmed family, probability and similarity. What
    lies before and behind a notice is looked at again, behind it also as if it
    began with the same verb ('licensed under one or the other')."""
    found: list[tuple] = []
    waiting: list[tuple] = [(a, b, [])]
    seen = set()
    while waiting:
        start, end, lead = waiting.pop()
        if (start, end, *lead) in seen:
            continue
        seen.add((start, end, *lead))
        hit = confirmed(lead + words[start:end], model)
        if hit is None:
            continue
        places = shared_words(lead + words[start:end], hit[0])
        own = [start + k - len(lead) for k in places if k >= len(lead)]
        # The rest of a notice isn't another one.
        if not own or found and len(own) < (1 if lead else 2):
            continue
        first, behind = own[0], own[-1] + 2
        found.append((first, behind, *hit))
        waiting.append((start, first, []))
        waiting.append((behind, end, []))
        verb = lead or words[first : first + 2]
        if verb[1:] == [b"under"]:
            while behind < end and words[behind] in (b"or", b"and"):
                behind += 1
            waiting.append((behind, end, verb))
    if len({x[2] for x in found}) == 1:  # the passage is the whole paragraph
        return [(a, b, *found[0][2:])]
    return sorted(found, key=lambda x: x[:2])


def scan(data: bytes, model: Model) -> list[dict]:
    """Passages of a text with a confirmed family: byte range, family,
    probability and similarity. Overlapping passages of one family are one."""
    found: list[dict] = []
    at = 0
    for line in data.split(b"\n"):
        words = words_of(line)
        ids = list(map(model.words.get, words))
        if any(map(model.pairs.__contains__, zip(ids, ids[1:]))):
            places = [m.span() for m in WORD.finditer(line.translate(TO_WORDS))]
            for a, b in windows(len(words)):
                for i, j, family, sure, alike in notices(words, a, b, model):
                    start, end = at + places[i][0], at + places[j - 1][1]
                    last = next(
                        (x for x in reversed(found) if x["family"] == family), None
                    )
                    if last and start <= last["end"]:
                        last["start"] = min(last["start"], start)
                        last["end"] = max(last["end"], end)
                        last["probability"] = max(last["probability"], sure)
                        last["similarity"] = max(last["similarity"], alike)
                    else:
                        found.append(
                            {
                                "start": start,
                                "end": end,
                                "family": family,
                                "probability": sure,
                                "similarity": alike,
                            }
                        )
        at += len(line) + 1
    return found


PASSAGE = (
    "struct<start: long, end: long, family: string, probability: double,"
    " similarity: double>"
)


def licences(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, the families found, and each passage as a byte range of the
    UTF-8 text."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        passage = pa.struct(
            [
                ("start", pa.int64()),
                ("end", pa.int64()),
                ("family", pa.string()),
                ("probability", pa.float64()),
                ("similarity", pa.float64()),
            ]
        )
        for rows in batches:
            found = [scan(x, model) for x in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(
                        [sorted({p["family"] for p in x}) for x in found],
                        pa.list_(pa.string()),
                    ),
                    pa.array(found, pa.list_(passage)),
                ],
                names=["doc_id", "families", "passages"],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(
        run, f"doc_id {key}, families array<string>, passages array<{PASSAGE}>"
    )
