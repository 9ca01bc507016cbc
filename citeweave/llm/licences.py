"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs (lines) become hashed word 1-, 2- and 3-grams.  A multinomial logistic regression
over them knows the licence families, `unknown` for other licence language, and `none`.  It is
trained on the templates, varied at random, and on a bounded sample of the corpus; its
probabilities are calibrated on a held-out part by a temperature, and a family counts only from
the least calibrated probability at which held-out predictions are precise; below it the
paragraph is `unknown`.  A predicted family is confirmed when the paragraph holds most of the
word triples of one of the family's templates.

Notices also run over several lines, as hard-wrapped headers do.  Wherever neighbouring lines
together hold most of a template's triples, within twice its number of words, the words from
the first such triple to the last are classified and confirmed like a paragraph.  Of a
confirmed passage the unconfirmed lines count no more; a confirmed line of its family stands
for it.

Scoring first sums, per n-gram, the most that any class gains over `none`; a paragraph in which
that can't outweigh the constants is `none` by proof, so only few are scored in full.

Defined results: null and empty texts have no licence; repeated rows are scanned each; an empty
table gives an empty answer (the model is then trained on templates alone).  Other columns are
left out.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from citeweave.llm.samples import hashed_sample
from citeweave.llm.words import as_alnum, binary, scatter, slices, word_hashes

FEATURES = 1 << 16
NONE, UNKNOWN = "none", "unknown"
#: Documents of the corpus that training draws paragraphs from, and paragraphs drawn at most.
SAMPLE_DOCS, SAMPLE_PARAGRAPHS = 400, 4000
#: Part of a template's word triples that confirms it.
CONFIRM = 0.6
PRECISION = 0.99

#: Wording of licence notices by family.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GNU General Public License, version 2 or later.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ),
    UNKNOWN: (
        "All rights reserved.",
        "Copyright (c) 2020 by the authors. All rights reserved.",
        "Use of this material is subject to the license agreement.",
        "Licensed under the terms of a commercial license.",
        "No part of this work may be reproduced without written permission of the publisher.",
        "Released under the terms of the license that comes with this work.",
    ),
}
CLASSES = (NONE, *TEMPLATES)

_GRAMS = np.random.default_rng(7).integers(1, 1 << 63, 3, np.uint64) * np.uint64(2) + np.uint64(1)


def n_grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words, one per start that has room; 1 to 3 words."""
    m = max(0, len(words) - n + 1)
    total = np.full(m, n, np.uint64)
    for k in range(n):
        total += words[k : k + m] * _GRAMS[k]
    return scatter(total)


def features(paragraphs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(paragraph, feature) of every n-gram occurrence."""
    words, counts = word_hashes([as_alnum(p) for p in paragraphs])
    owner = np.repeat(np.arange(len(paragraphs)), counts)
    rows, found = [], []
    for n in (1, 2, 3):
        grams = n_grams(words, n)
        within = owner[: len(grams)] == owner[n - 1 :] if len(grams) else np.empty(0, bool)
        rows.append(owner[: len(grams)][within])
        found.append((grams[within] & np.uint64(FEATURES - 1)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(found)


@dataclass
class Model:
    weights: np.ndarray  # (features, classes)
    constants: np.ndarray
    temperature: float = 1.0
    least: float = 0.5

    def logits(self, n: int, rows: np.ndarray, found: np.ndarray) -> np.ndarray:
        total = np.empty((n, len(self.constants)))
        for k in range(total.shape[1]):
            total[:, k] = np.bincount(rows, self.weights[found, k], n)
        return total + self.constants

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        scaled = logits / self.temperature
        grown = np.exp(scaled - scaled.max(1, keepdims=True))
        return grown / grown.sum(1, keepdims=True)

    def classify(self, paragraphs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(class, calibrated probability); paragraphs proved `none` have probability 1."""
        n = len(paragraphs)
        rows, found = features(paragraphs)
        gain = (self.weights[:, 1:] - self.weights[:, :1]).max(1)
        most = np.bincount(rows, gain[found], n) + (self.constants[1:] - self.constants[0]).max()
        kind, sure = np.zeros(n, np.int64), np.ones(n)
        open_rows = np.flatnonzero(most >= 0)
        if len(open_rows):
            place = np.full(n, -1)
            place[open_rows] = np.arange(len(open_rows))
            chosen = place[rows] >= 0
            p = self.probabilities(self.logits(len(open_rows), place[rows[chosen]], found[chosen]))
            kind[open_rows], sure[open_rows] = p.argmax(1), p.max(1)
        return kind, sure


def varied(rng: np.random.Generator, notice: str, others: list[str]) -> str:
    """A notice as it may appear: words lost, case changed, neighbouring text before or after."""
    words = [w for w in notice.split() if rng.random() > 0.05]
    text = " ".join(words)
    text = text.upper() if rng.random() < 0.1 else text.lower() if rng.random() < 0.1 else text
    if others and rng.random() < 0.3:
        near = " ".join(others[rng.integers(len(others))].split()[:20])
        text = f"{near} {text}" if rng.random() < 0.5 else f"{text} {near}"
    return text


def train(paragraphs: list[str], seed: int = 0, copies: int = 60, rounds: int = 150) -> Model:
    """Fit, calibrate and set the least probability; `paragraphs` are taken from the corpus."""
    rng = np.random.default_rng(seed)
    plain = [p for p in paragraphs if p.strip() and not confirmed_families(p.encode())]
    texts = list(plain)
    labels = [0] * len(texts)
    for k, notices in enumerate(TEMPLATES.values(), 1):
        for notice in notices:
            texts += [varied(rng, notice, plain) for _ in range(copies)]
            labels += [k] * copies
    order = rng.permutation(len(texts))
    held = order[: len(order) // 4]
    kept = order[len(order) // 4 :]
    y = np.array(labels)
    model = _fitted([texts[i].encode() for i in kept], y[kept], rounds)
    _calibrate(model, [texts[i].encode() for i in held], y[held])
    return model


def _fitted(texts: list[bytes], y: np.ndarray, rounds: int) -> Model:
    """Full-batch gradient steps with adaptive rates and a small ridge."""
    n, k = len(texts), len(CLASSES)
    rows, found = features(texts)
    used, at = np.unique(found, return_inverse=True)
    lengths = np.maximum(1, np.bincount(rows, minlength=n))
    value = np.ones(len(rows))
    weights, constants = np.zeros((len(used), k)), np.zeros(k)
    square = np.full_like(weights, 1e-8)
    target = np.eye(k)[y]
    # Classes count alike, whatever their number of texts.
    importance = (1 / np.maximum(1, np.bincount(y, minlength=k)))[y]
    importance *= n / importance.sum()
    for _ in range(rounds):
        logits = np.stack([np.bincount(rows, weights[at, c], n) for c in range(k)], 1) + constants
        grown = np.exp(logits - logits.max(1, keepdims=True))
        off = (grown / grown.sum(1, keepdims=True) - target) * importance[:, None] / n
        slope = np.stack([np.bincount(at, value * off[rows, c], len(used)) for c in range(k)], 1) + 1e-5 * weights
        square += slope**2
        weights -= 0.1 * slope / np.sqrt(square)
        constants -= 0.5 * off.sum(0)
    full = np.zeros((FEATURES, k))
    full[used] = weights
    return Model(full, constants)


def _calibrate(model: Model, texts: list[bytes], y: np.ndarray) -> None:
    rows, found = features(texts)
    logits = model.logits(len(texts), rows, found)

    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -np.log(model.probabilities(logits)[np.arange(len(y)), y] + 1e-12).mean()

    model.temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    p = model.probabilities(logits)
    family = p.argmax(1) > 1 if CLASSES[1] == UNKNOWN else (p.argmax(1) > 0) & (p.argmax(1) != CLASSES.index(UNKNOWN))
    right = (p.argmax(1) == y)[family]
    sure = p.max(1)[family]
    order = np.argsort(-sure)
    precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= PRECISION
    model.least = float(sure[order][np.flatnonzero(precise).max()]) if precise.any() else 0.5


def _triples(text: bytes) -> set[int]:
    words, _ = word_hashes([as_alnum(text)])
    return set(n_grams(words, min(3, max(1, len(words)))).tolist())


_TEMPLATE_TRIPLES = {k: [_triples(t.encode()) for t in v] for k, v in TEMPLATES.items() if k != UNKNOWN}


def confirmed_families(paragraph: bytes) -> list[str]:
    """Families of which a template is held for the most part."""
    own = _triples(paragraph)
    return [k for k, sets in _TEMPLATE_TRIPLES.items() if any(len(own & t) >= CONFIRM * len(t) for t in sets)]


#: All templates: their triples and the words that a passage which holds one may have.
_LISTED = [(_triples(t.encode()), 2 * len(as_alnum(t.encode()).split())) for v in TEMPLATES.values() for t in v]
_HOLDERS = {x: [k for k, (own, _) in enumerate(_LISTED) if x in own] for x in set().union(*(own for own, _ in _LISTED))}
_WANTED = np.sort(np.array(list(_HOLDERS), np.uint64))
_LOW_BITS = np.zeros(1 << 16, bool)
_LOW_BITS[_WANTED & np.uint64(0xFFFF)] = True


class Passage(NamedTuple):
    """Words that run over several lines: first and last line, first word and the one after the last."""

    first: int
    last: int
    start: int
    stop: int
    words: bytes


def wrapped_passages(lines: list[bytes | None], counts: np.ndarray) -> list[list[Passage]]:
    """Passages over several lines that hold most of a template, by document.

    `lines` are those of all documents, `counts` the lines of each.  Lines count from 0 in their
    document, words in all.
    """
    words, n_words = word_hashes([as_alnum(x) for x in lines])
    out: list[list[Passage]] = [[] for _ in counts]
    grams = n_grams(words, 3)
    at = np.flatnonzero(_LOW_BITS[grams & np.uint64(0xFFFF)])
    at = at[_WANTED[np.minimum(np.searchsorted(_WANTED, grams[at]), len(_WANTED) - 1)] == grams[at]]
    line_of = np.repeat(np.arange(len(lines)), n_words)
    doc_of = np.repeat(np.arange(len(counts)), counts)
    first_word, first_line = np.cumsum(n_words) - n_words, np.cumsum(counts) - counts
    doc = doc_of[line_of[at]]
    inside = doc == doc_of[line_of[at + 2]]
    at, doc = at[inside], doc[inside]
    edges = np.flatnonzero(np.diff(doc, prepend=-1, append=-1))
    for start, stop in zip(edges[:-1], edges[1:], strict=True):
        own = int(doc[start])
        for a, b in sorted(_spans(at[start:stop].tolist(), grams[at[start:stop]].tolist())):
            low, high = int(line_of[a]), int(line_of[b - 1])
            if low < high:
                text = b" ".join(as_alnum(x) for x in lines[low : high + 1]).split()
                base, top = int(first_word[low]), int(first_line[own])
                out[own].append(Passage(low - top, high - top, a, b, b" ".join(text[a - base : b - base])))
    return out


def _spans(at: list[int], grams: list[int]) -> set[tuple[int, int]]:
    """Spans of words that hold most of a template, of those that overlap the fullest and then the shortest."""
    by_template: dict[int, list[tuple[int, int]]] = {}
    for place, gram in zip(at, grams, strict=True):
        for k in _HOLDERS[gram]:
            by_template.setdefault(k, []).append((place, gram))
    chosen = set()
    for k, hits in by_template.items():
        wanted, room = _LISTED[k]
        latest: dict[int, int] = {}
        spans = []
        for place, gram in hits:
            latest[gram] = place
            held = [p for p in latest.values() if p + room >= place + 3]
            if len(held) >= CONFIRM * len(wanted):
                spans.append((-len(held), place + 3 - min(held), min(held)))
        taken: list[tuple[int, int]] = []
        for _, size, first in sorted(spans):
            after = bisect.bisect(taken, (first,))
            if (not after or taken[after - 1][1] <= first) and (after == len(taken) or taken[after][0] >= first + size):
                taken.insert(after, (first, first + size))
        chosen.update(taken)
    return chosen


def _with_passages(found: list[dict], passages: list[tuple[Passage, dict]]) -> list[dict]:
    """Findings of a document's lines and of its passages over several lines, each notice once."""
    known: dict[str, list[int]] = {}
    for f in found:
        if f["confirmed"]:
            known.setdefault(f["family"], []).append(f["paragraph"])
    covered: set[int] = set()
    added: list[dict] = []
    reach: dict[str, int] = {}
    furthest = 0
    passages = sorted(passages, key=lambda x: (x[0].start, -x[0].stop))
    for p, f in passages:
        if not f["confirmed"]:
            continue
        covered.update(range(p.first, p.last + 1))
        lines = known.get(f["family"], [])
        at = bisect.bisect_left(lines, p.first)
        # Within another notice, or the same notice by another template or by a line of it.
        if p.stop > furthest and p.start >= reach.get(f["family"], 0) and not (at < len(lines) and lines[at] <= p.last):
            added.append(f)
            reach[f["family"]] = p.stop
        furthest = max(furthest, p.stop)
    kept = [f for f in found if f["confirmed"] or f["paragraph"] not in covered]
    covered.update(f["paragraph"] for f in kept)
    for p, f in passages:
        if not f["confirmed"] and covered.isdisjoint(range(p.first, p.last + 1)):
            covered.update(range(p.first, p.last + 1))
            added.append(f)
    return sorted(kept + added, key=lambda f: f["paragraph"])


def sample_paragraphs(docs: DataFrame, n_docs: int = SAMPLE_DOCS, n_paragraphs: int = SAMPLE_PARAGRAPHS) -> list[str]:
    """Training paragraphs: of the `n_docs` documents with the smallest hashes, `n_paragraphs` spread over them."""
    chosen = hashed_sample(docs.where("text IS NOT NULL").select("doc_id", "text"), "doc_id", n_docs)
    found: list[str] = []
    for row in chosen.collect():
        lines = row["text"].split("\n")
        # Lines of a wrapped notice are no examples of other text.
        passages = wrapped_passages([x.encode() for x in lines], np.array([len(lines)]))[0]
        notice = {k for p in passages if confirmed_families(p.words) for k in range(p.first, p.last + 1)}
        found += [x for k, x in enumerate(lines) if k not in notice]
    return found if len(found) <= n_paragraphs else [found[i * len(found) // n_paragraphs] for i in range(n_paragraphs)]


_SCANNED = (
    "doc_id long, n_paragraphs long, n_confirmed long, n_unknown long, families string, "
    "found array<struct<paragraph: int, family: string, probability: double, confirmed: boolean>>"
)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_paragraphs, n_confirmed, n_unknown, families, found), a row per row of `docs`.

    `found` names each paragraph with licence language, and by its first line each passage over
    several; `families` joins the confirmed ones.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    entry = pa.struct(
        [("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("confirmed", pa.bool_())]
    )

    def finding(known: Model, paragraph: int, text: bytes, kind: int, sure: float) -> dict:
        family = CLASSES[kind] if sure >= known.least else UNKNOWN
        return {"paragraph": paragraph, "family": family, "probability": float(sure), "confirmed": family in confirmed_families(text)}

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches, "text", 2 << 20):
            lists = pc.split_pattern(pc.fill_null(batch.column("text"), ""), "\n")
            lines, counts = binary(lists.flatten()), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            kind, sure = known.classify(lines)
            wrapped = [(k, p) for k, own in enumerate(wrapped_passages(lines, counts)) for p in own]
            wrapped_kind, wrapped_sure = known.classify([p.words for _, p in wrapped])
            passages: dict[int, list[tuple[Passage, dict]]] = {}
            for i in np.flatnonzero(wrapped_kind).tolist():
                k, p = wrapped[i]
                passages.setdefault(k, []).append((p, finding(known, p.first, p.words, wrapped_kind[i], wrapped_sure[i])))
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            owner = np.repeat(np.arange(batch.num_rows), counts)
            first = np.cumsum(counts) - counts
            for i in np.flatnonzero(kind).tolist():
                found[owner[i]].append(finding(known, i - int(first[owner[i]]), lines[i], kind[i], sure[i]))
            for k, own in passages.items():
                found[k] = _with_passages(found[k], own)
            names = [sorted({f["family"] for f in own if f["confirmed"]}) for own in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([sum(f["confirmed"] for f in own) for own in found], pa.int64()),
                    pa.array([sum(not f["confirmed"] for f in own) for own in found], pa.int64()),
                    pa.array([",".join(n) for n in names], pa.string()),
                    pa.array(found, pa.list_(entry)),
                ],
                names=["doc_id", "n_paragraphs", "n_confirmed", "n_unknown", "families", "found"],
            )

    return docs.select("doc_id", "text").mapInArrow(check, _SCANNED)
