"""Licence scan: a trained paragraph classifier finds licence families, and templates confirm what it finds.

Paragraphs are the lines of a text, and notices that go over several lines of a block (neighbouring lines with words)
are found where a template's word triples stand in order. A multinomial logistic regression over hashed word n-grams (one and two words) is
trained on the templates below, on variants of them with words dropped or replaced, and on a bounded sample of the
corpus's own lines as the unknown class. A temperature fitted on held-out rows calibrates it; a paragraph whose best
family stays below the threshold is unknown. A family counts only if the paragraph also holds enough of one of its
templates' word triples.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHasher, batch_buffer, key_or_null, key_or_sentinel, materialize, mix64, slices, text_or_empty
from .quality import _LETTER

#: Short notices by which licences are named, by family.
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "bsd-3-clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Released under the BSD 3-Clause License."],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "lgpl-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "mit": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved.", "All rights reserved. No part of this publication may be reproduced without permission."],
}
FAMILIES = sorted(TEMPLATES)
UNKNOWN = len(FAMILIES)
BITS = 16
#: Lines of the corpus that the unknown class is fitted on, at most: those with the least hashes.
NEGATIVES = 3000
VARIANTS = 40
THRESHOLD = 0.5
#: Share of a template's word triples that a paragraph must hold.
CONFIRM = 0.6


def _grams(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a batch, which line each word is in, where lines start (as words), and each text's first line."""
    data, offsets = batch_buffer(texts)
    mask = np.zeros(len(data) + 2, dtype=np.int8)
    mask[1:-1] = _LETTER[data]
    edge = np.diff(mask)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, starts)
    return SpanHasher(data).spans(starts, ends), line, breaks, np.searchsorted(breaks, offsets)


def _pairs(words: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        two = mix64(words[:-1] * np.uint64(0x9FB21C651E98DF25) + words[1:])
    return two, line[:-1] == line[1:]


def _features(words: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    two, same = _pairs(words, line)
    keep = np.uint64(2**BITS - 1)
    return np.concatenate([words & keep, two[same] & keep]).astype(np.int64), np.concatenate([line, line[:-1][same]])


def _design(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, line, lines) of the words and word pairs; features of a line weigh one over the root of their number."""
    words, line, breaks, _ = _grams(texts)
    return *_features(words, line), np.arange(len(breaks))


def _word_scores(words: np.ndarray, line: np.ndarray, lines: int, weights: np.ndarray) -> np.ndarray:
    feature, line = _features(words, line)
    n = np.maximum(1, np.bincount(line, minlength=lines))
    z = np.stack([np.bincount(line, weights=weights[feature, k], minlength=lines) for k in range(weights.shape[1])], axis=1)
    return z / np.sqrt(n)[:, None]


def _scores(texts: list, weights: np.ndarray) -> np.ndarray:
    words, line, breaks, _ = _grams(texts)
    return _word_scores(words, line, len(breaks), weights)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def training_rows(negatives: list[str], seed: int = 5) -> tuple[list[str], np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    filler = " ".join(negatives).split() or ["word"]
    texts, labels = [], []
    for k, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            words = template.split()
            for v in range(VARIANTS):
                own = [w for w in words if v == 0 or rng.random() > 0.06]
                own = [filler[rng.integers(len(filler))] if v and rng.random() < 0.04 else w for w in own]
                extra = [filler[i] for i in rng.integers(len(filler), size=rng.integers(0, 4))] if v % 2 else []
                texts.append(" ".join([*extra, *own]))
                labels.append(k)
    return texts + [n.replace("\n", " ") for n in negatives], np.array(labels + [UNKNOWN] * len(negatives))


def fit(negatives: list[str], rounds: int = 80) -> tuple[np.ndarray, float]:
    """Weights (features, families + 1) and the temperature that suits every fifth row, which was held out."""
    texts, labels = training_rows(negatives)
    feature, line, lines = _design(texts)
    n = np.sqrt(np.maximum(1, np.bincount(line, minlength=len(lines))))
    train = np.arange(len(texts)) % 5 != 0
    w = np.zeros((2**BITS, UNKNOWN + 1))
    g2 = np.full_like(w, 1e-6)
    target = np.eye(UNKNOWN + 1)[labels]
    for _ in range(rounds):
        z = np.stack([np.bincount(line, weights=w[feature, k], minlength=len(lines)) for k in range(UNKNOWN + 1)], axis=1) / n[:, None]
        error = (_softmax(z) - target) * train[:, None] / n[:, None] / train.sum()
        g = np.stack([np.bincount(feature, weights=error[line, k], minlength=2**BITS) for k in range(UNKNOWN + 1)], axis=1) + 1e-6 * w
        g2 += g * g
        w -= 0.5 * g / np.sqrt(g2)
    z = _scores([t for t, x in zip(texts, train, strict=True) if not x], w)
    held = labels[~train]
    losses = {t: -np.log(np.maximum(1e-12, _softmax(z / t)[np.arange(len(held)), held])).mean() for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)}
    return w.astype(np.float32), min(losses, key=losses.get)


def _triples(words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64((words[:-2] * np.uint64(0x9FB21C651E98DF25) + words[1:-1]) * np.uint64(0x9FB21C651E98DF25) + words[2:])


class Shapes:
    """The templates' word triples, and the passages of consecutive lines that hold enough of one of them."""

    def __init__(self) -> None:
        self.all = [(k, _triples(_grams([t])[0]), len(t.split())) for k, family in enumerate(FAMILIES) for t in TEMPLATES[family]]
        self.sets = [(k, np.unique(t)) for k, t, _ in self.all]
        self.known = np.unique(np.concatenate([t for _, t in self.sets]))

    def passages(self, words: np.ndarray, line: np.ndarray, block: np.ndarray) -> list[tuple[int, int, int]]:
        """(family, first word, last word) of passages over several lines; block: the block of each word."""
        if len(words) < 3:
            return []
        triples = _triples(words)
        at = np.flatnonzero(np.isin(triples, self.known) & (block[:-2] == block[2:]))
        out = []
        for k, template, n in self.all:
            place = {int(t): i for i, t in reversed(list(enumerate(template)))}
            hits = at[np.isin(triples[at], template)]
            # A passage ends where the template starts again, and where a template's length of words has no hit.
            groups: list[list[tuple[int, int]]] = []
            for a, i in zip(hits.tolist(), (place[int(t)] for t in triples[hits]), strict=True):
                last = groups[-1][-1] if groups else None
                if last and i > last[1] and a - last[0] <= n and block[a] == block[last[0]]:
                    groups[-1].append((a, i))
                else:
                    groups.append([(a, i)])
            for g in groups:
                a, b = g[0][0], g[-1][0] + 2
                if line[a] != line[b] and len(g) >= CONFIRM * len(place):
                    out.append((k, a, b))
        return sorted(out, key=lambda x: (x[1], -x[2]))


def sample_lines(rows: DataFrame, n: int) -> list[str]:
    """n whole lines of rows (doc_id, text) at most, drawn from all their lines by hash.

    Ids and hashes are ordered by the executors; texts are read again for the chosen lines only. Before they are
    ordered, all lines go but the share of hashes below 16 n over the number of rows: as many lines as rows would
    leave 16 n, so few tasks have more than a few to order. (Far fewer lines than rows can leave fewer than n.)
    """
    split = F.split("text", "\n", -1)
    share = min(1.0, 16.0 * n / max(1, rows.count()))
    top = F.lit(int(-(2**63) + share * 2**64) if share < 1 else 2**63 - 1)
    lines = rows.select("doc_id", F.xxhash64("text").alias("sub"), F.posexplode(F.transform(split, lambda x, i: F.when(x.rlike("[A-Za-z\\x80-\\x{10FFFF}]"), F.xxhash64("doc_id", x, i)))).alias("i", "h")).filter(F.col("h") <= top)
    drawn = materialize(lines.orderBy("h", "doc_id", "sub", "i").limit(n), "drawn").groupBy("doc_id", "sub").agg(F.collect_set("i").alias("at"))
    found = rows.withColumn("sub", F.xxhash64("text")).join(F.broadcast(drawn), ["doc_id", "sub"])
    return sorted({r[0] for r in found.select(F.explode(F.transform("at", lambda i: F.get(split, i)))).collect()})


def scan_licenses(docs: DataFrame, negatives: int = NEGATIVES) -> DataFrame:
    """doc_id, n_paragraphs, n_licensed, families (sorted array of strings) of every row.

    n_paragraphs counts lines with words; n_licensed counts notices, in one line or over several. A null or empty text has none; rows that repeat a doc_id are scanned each;
    a null doc_id stays null. Whole texts are read, whatever their length. An empty table gives no rows.
    """
    rows = docs.select(key_or_sentinel("doc_id").alias("doc_id"), text_or_empty().alias("text"))
    drawn = sample_lines(rows, negatives)
    known = {t.lower() for ts in TEMPLATES.values() for t in ts}
    weights, temperature = fit([x for x in drawn if not any(t in x.lower() for t in known)])
    shapes = Shapes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["doc_id"].to_numpy()
            for lo, hi in slices(texts, 1_000_000):
                words, line, breaks, first = _grams(texts[lo:hi])
                p = _softmax(_scores(texts[lo:hi], weights) / temperature)
                bounds = np.searchsorted(line, np.arange(len(breaks) + 1))
                worded = np.diff(bounds) > 0
                best = p[:, :UNKNOWN].argmax(axis=1)
                likely = np.flatnonzero(worded & (p[np.arange(len(p)), best] >= THRESHOLD))
                sure: dict[int, int] = {}
                for i in likely:
                    own = _triples(words[bounds[i] : bounds[i + 1]]) if bounds[i + 1] - bounds[i] > 2 else words[:0]
                    if any(k == best[i] and np.isin(t, own).mean() >= CONFIRM for k, t in shapes.sets):
                        sure[i] = int(best[i])
                # Blocks are runs of lines with words, within one text.
                part = np.zeros(len(breaks), dtype=np.int64)
                part[first[:-1]] = 1
                part[1:] |= worded[1:] != worded[:-1]
                wide = shapes.passages(words, line, np.cumsum(part)[line])
                notices: dict[int, list[int]] = {i: [k] for i, k in sure.items()}
                if wide:
                    # Each passage is scored as a line of its own, by its own words.
                    sizes = np.array([b - a + 1 for _, a, b in wide])
                    q = _softmax(_word_scores(np.concatenate([words[a : b + 1] for _, a, b in wide]), np.repeat(np.arange(len(wide)), sizes), len(wide), weights) / temperature)
                    done: dict[int, int] = {}
                    for (k, a, b), r in zip(wide, q, strict=True):
                        over = range(int(line[a]), int(line[b]) + 1)
                        if r[:UNKNOWN].argmax() == k and r[k] >= THRESHOLD and done.get(k, -1) < a and not any(sure.get(i) == k for i in over):
                            done[k] = b
                            notices.setdefault(int(line[a]), []).append(k)
                out = []
                for d in range(hi - lo):
                    a, b = first[d], first[d + 1]
                    found = [k for i in range(a, b) for k in notices.get(i, ())] if notices else []
                    out.append((ids[lo + d], int(worded[a:b].sum()), len(found), sorted({FAMILIES[k] for k in found})))
                yield pd.DataFrame(out, columns=["doc_id", "n_paragraphs", "n_licensed", "families"])

    out = rows.mapInPandas(run, "doc_id long, n_paragraphs long, n_licensed long, families array<string>")
    return out.withColumn("doc_id", key_or_null("doc_id"))
