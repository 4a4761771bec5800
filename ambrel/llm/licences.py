"""Licence scans by a trained paragraph classifier.

A paragraph ends at blank lines. It is seen through windows of REACH words on either
side of each of its words, once within its line and once across single newlines, so
hard-wrapped notices are whole and long lines are not outvoted. Features are the
word 1-, 2- and 3-grams of the licence templates, of the families and of others
(a fixed set, so the model is small and sparse), present or not in the window.
Multinomial logistic regression gives the families and "unknown"; it is trained on
paragraphs made from the templates (words dropped, neighbours mixed in, names and
years put in front) against licences outside the families, look-alikes, licence
words out of order and ordinary windows from a bounded sample (SAMPLE_DOCS documents
by id hash, of those SAMPLE_WINDOWS windows by hash, in two rounds: the second adds
the ordinary windows that the first took for a licence). On held-out made paragraphs
the scores are calibrated (temperature), and the unknown class gets the threshold
that lets at most FALSE_ALARMS of held-out unknowns through, among them licences
outside the families that training never saw. A predicted family is confirmed if the
paragraph holds at least CONTAINED of the word pairs of one of the family's
templates, or the template of the paragraph.

Windows that cannot be anything but unknown are skipped exactly: the weights that
features give a family over "unknown", negative ones left out and summed over the
window, bound its score from above; only windows whose bound passes the threshold
are predicted, all of them.

A window may hold several notices. Windows are taken most certain first; the words
that a found family's closest template aligns with (local alignment) are its place,
and what stands before and after is predicted again by itself. A window centred in a
place already found is settled. Of places that overlap, the one with the better
alignment stays, of equals the first.

Null and empty texts have no paragraphs, an empty table gives no rows; texts of any
length are scanned whole, in memory in proportion. Rows may repeat and ids be null;
only doc_id and text are read, whatever other columns are called.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Short notices of each family.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "SPDX-License-Identifier: MIT", "This project is available under the terms of the MIT license"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "You may not use this file except in compliance with the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0", "Distributed under the terms of the Apache License 2.0"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only", "Released under the GPL version 2"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted", "Released under the BSD 3-Clause License.", "Licensed under the BSD license.", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC0": ["To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal", "Dedicated to the public domain under CC0", "SPDX-License-Identifier: CC0-1.0"],
}
#: Short notices of licences outside the families; those of HELD_OTHERS are for calibration only.
OTHERS = {
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "SPDX-License-Identifier: EPL-2.0", "Licensed under the Eclipse Public License"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Licensed under the ISC License.", "SPDX-License-Identifier: ISC"],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "SPDX-License-Identifier: CC-BY-ND-4.0"],
    "CC-BY-NC-ND": ["Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "BSL": ["Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"],
    "OFL": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "EULA": ["Licensed under the terms of the commercial license agreement", "use of this software is governed by the end user license agreement"],
    "CDDL": ["The contents of this file are subject to the terms of the Common Development and Distribution License", "SPDX-License-Identifier: CDDL-1.0"],
    "Artistic": ["Released under the Artistic License 2.0.", "SPDX-License-Identifier: Artistic-2.0"],
    "EUPL": ["Licensed under the European Union Public License, version 1.2", "SPDX-License-Identifier: EUPL-1.2"],
    "zlib": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely", "SPDX-License-Identifier: Zlib"],
    "PostgreSQL": ["Released under the PostgreSQL License.", "SPDX-License-Identifier: PostgreSQL"],
}
HELD_OTHERS = ("Artistic", "EUPL", "zlib", "PostgreSQL")
UNKNOWN = "unknown"
LOOK_ALIKES = ["All rights reserved.", "Copyright held by the authors, all rights reserved", "a driver's license is required", "the licensed premises were closed", "terms of use and public notice", "the general public was free to use the library", "software under development", "version 2 of the document was released under pressure", "the foundation published a source", "granted permission to use the work", "a creative work in the public library", "released under the new version", "subject to the terms of the contract"]
#: Lines with such words may be notices, so they are no examples of ordinary text.
DOUBTFUL = re.compile(r"licen[cs]|spdx|\bmit\b|\bapache\b|gpl\b|\bgnu\b|mozilla|\bmpl\b|\bbsd\b|\bcc0?\b|commons|redistribut|domain|copyright|permission|software", re.I)
WORD = re.compile(r"[a-z0-9]+")
_BLANK = re.compile(r"\n[ \t\r\f\v]*\n")
REACH = 16
SAMPLE_DOCS, SAMPLE_WINDOWS, MADE, ROUNDS, FALSE_ALARMS, CONTAINED = 200, 4000, 60, 300, 0.001, 0.6


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def words_of(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


class Classifier:
    """Weights (features, classes) and what prediction needs; small enough for every task."""

    def __init__(self, background: list[list[str]], seed: int = 1):
        self.classes = [*TEMPLATES, UNKNOWN]
        known = sorted({g for ts in [*TEMPLATES.values(), *OTHERS.values()] for t in ts for g in grams(words_of(t))})
        self.feature = {g: i for i, g in enumerate(known)}
        self.pairs = {c: [set(zip(w, w[1:])) for w in map(words_of, ts)] for c, ts in TEMPLATES.items()}
        made = self._made(np.random.Generator(np.random.PCG64(seed)), background)
        self._fit(made)
        hard = [w for w in background if (said := self.predict_words(w)) and not said[2]]
        if hard:
            self._fit(made + [(w, len(TEMPLATES), i % 4 == 0) for i, w in enumerate(hard)] * 4)

    def _fit(self, made: list[tuple[list[str], int, int]]) -> None:
        """``made``: words, class and use: 0 to train on, 1 held out, 2 held out and of a kind that training has none of."""
        y, use = np.array([c for _, c, _ in made]), np.array([int(h) for _, _, h in made])
        held = use > 0
        x = np.zeros((len(made), len(self.feature) + 1), "f4")
        x[:, -1] = 1
        for i, (w, _, _) in enumerate(made):
            x[i, [self.feature[g] for g in grams(w) if g in self.feature]] = 1
        self.weights = np.zeros((x.shape[1], len(self.classes)), "f4")
        speed = np.zeros_like(self.weights)
        one, seen = np.eye(len(self.classes), dtype="f4")[y[~held]], np.ascontiguousarray(x[~held])
        for _ in range(ROUNDS):  # accelerated gradient descent with shrinkage
            p = self._softmax(seen @ (self.weights + 0.9 * speed))
            speed = 0.9 * speed - 0.5 * (seen.T @ (p - one) / len(one) + 1e-5 * self.weights)
            self.weights += speed
        scores = x[held] @ self.weights
        losses = [(-np.log(self._softmax(scores / t)[np.arange(len(scores)), y[held]] + 1e-12).mean(), t) for t in (0.5, 0.7, 1.0, 1.4, 2.0, 3.0)]
        self.temperature = min(losses)[1]
        chance = 1 - self._softmax(scores / self.temperature)[:, -1]
        false = np.sort(chance[y[held] == len(self.classes) - 1])
        self.threshold = min(1 - 1e-9, max(0.5, float(false[min(len(false) - 1, int((1 - FALSE_ALARMS) * len(false)))])))
        self.held_out_accuracy = float((self._softmax(scores).argmax(1) == y[held])[use[held] == 1].mean())
        self.unseen_rejected = float((chance[use[held] == 2] <= self.threshold).mean())
        self._index()

    def _index(self) -> None:
        """What a feature can add to a family's score over "unknown"; features by words, so n-grams are looked up as numbers."""
        over = (self.weights[:, :-1] - self.weights[:, -1:]) / self.temperature
        self.base = over[-1]
        self.gain = np.maximum(over[:-1], 0)
        self.word = {w: i + 1 for i, w in enumerate(sorted({w for g in self.feature for w in g.split(" ")}))}
        many = len(self.word) + 1
        self.one, self.two = np.full(many, -1, "i4"), np.full(many * many, -1, "i4")
        three = []
        for g, i in self.feature.items():
            n = [self.word[w] for w in g.split(" ")]
            if len(n) == 1:
                self.one[n[0]] = i
            elif len(n) == 2:
                self.two[n[0] * many + n[1]] = i
            else:
                three.append(((n[0] * many + n[1]) * many + n[2], i))
        self.three_keys, self.three = (np.array(c, "i8") for c in zip(*sorted(three)))
        #: A window may be known only if sum_c exp(base_c + gains_c) exceeds this.
        self.needed = self.threshold / (1 - self.threshold)

    def possible(self, words: list[str]) -> np.ndarray:
        """The words whose window (REACH on either side) may be anything but unknown: all that are, and few others."""
        n = np.fromiter(map(self.word.get, words, [0] * len(words)), "i8", len(words))
        if not n.any():
            return np.empty(0, "i8")
        many = len(self.word) + 1
        found = [(np.flatnonzero(n), self.one[n[n > 0]])]
        pair = np.flatnonzero((n[:-1] > 0) & (n[1:] > 0))
        found.append((pair, self.two[n[pair] * many + n[pair + 1]]))
        triple = pair[np.isin(pair + 1, pair, assume_unique=True)]
        key = (n[triple] * many + n[triple + 1]) * many + n[triple + 2] if len(triple) else np.empty(0, "i8")
        at = np.minimum(np.searchsorted(self.three_keys, key), len(self.three_keys) - 1)
        found.append((triple, np.where(self.three_keys[at] == key, self.three[at], -1)))
        place, feature = (np.concatenate(c) for c in zip(*found))
        place, feature = place[feature >= 0], feature[feature >= 0]
        best = np.zeros(len(n) + 1)
        np.add.at(best, place + 1, self.gain[feature].max(1))
        sums = np.cumsum(best)
        lo, hi = np.maximum(np.arange(len(n)) - REACH, 0), np.minimum(np.arange(len(n)) + REACH + 1, len(n))
        rough = np.flatnonzero(sums[hi] - sums[lo] + self.base.max() + np.log(len(self.base)) > np.log(self.needed) - 1e-3)
        if not rough.size:
            return rough
        near = np.zeros(len(n) + 1, "i8")  # words that some rough window holds
        np.add.at(near, lo[rough], 1)
        np.add.at(near, hi[rough], -1)
        near = np.cumsum(near)[:-1] > 0
        row = np.cumsum(near)  # rows of the words that are near
        exact = np.zeros((int(row[-1]) + 1, len(self.base)))
        there = near[place]
        np.add.at(exact, row[place[there]], self.gain[feature[there]])
        sums = np.cumsum(exact, 0)
        before = row[lo[rough]] - 1
        bound = np.exp(np.minimum(sums[row[hi[rough] - 1]] - sums[before] + self.base, 80)).sum(1)
        return rough[bound > self.needed * (1 - 1e-3)]

    @staticmethod
    def _softmax(s: np.ndarray) -> np.ndarray:
        e = np.exp(s - s.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def _made(self, rng, background: list[list[str]]) -> list[tuple[list[str], int, int]]:
        filler = [w for p in background for w in p] or ["the", "of", "and"]
        some = lambda n: [filler[i] for i in rng.integers(0, len(filler), n)]
        unknown = len(self.classes) - 1

        def around(template: str, k: int) -> list[str]:
            w = words_of(template)
            if k % 3 == 1 and len(w) > 8:
                w = [x for x in w if rng.random() > 0.08]
            before = ["copyright", str(2000 + int(rng.integers(0, 26))), *some(2)] if k % 4 == 2 else some(int(rng.integers(0, 12)) if k % 2 else 0)
            return before + w + some(int(rng.integers(0, 12)) if k % 2 else 0)

        out = [(around(t, k), c, k % 4 == 0) for c, ts in enumerate(TEMPLATES.values()) for t in ts for k in range(MADE)]
        out += [(around(t, k), unknown, 2 if name in HELD_OTHERS else k % 4 == 0) for name, ts in OTHERS.items() for t in ts for k in range(MADE)]
        out += [(some(int(rng.integers(0, 8))) + words_of(t) + some(int(rng.integers(0, 8))), unknown, k % 4 == 0) for t in LOOK_ALIKES for k in range(MADE)]
        vocabulary = sorted({w for ts in TEMPLATES.values() for t in ts for w in words_of(t)})
        for k in range(20 * MADE):  # words of licences out of order
            w = [vocabulary[i] for i in rng.integers(0, len(vocabulary), 4)] + some(12)
            rng.shuffle(w)
            out.append((w, unknown, k % 4 == 0))
        return out + [(w, unknown, k % 4 == 0) for k, w in enumerate(background)]

    def predict(self, paragraph: str) -> tuple[str, float, bool] | None:
        """Family, its calibrated probability and whether a template confirms it; None: unknown."""
        return self.predict_words(words_of(paragraph))

    def predict_words(self, w: list[str]) -> tuple[str, float, bool] | None:
        at = [self.feature[g] for g in grams(w) if g in self.feature]
        if not at:
            return None
        p = self._softmax((self.weights[at].sum(0) + self.weights[-1])[None] / self.temperature)[0]
        if 1 - p[-1] <= self.threshold:
            return None
        best = int(p[:-1].argmax())
        mine = set(zip(w, w[1:]))
        confirmed = any(len(mine & t) >= CONTAINED * min(len(t), max(len(mine), 1)) for t in self.pairs[self.classes[best]] if t)
        return self.classes[best], float(p[best]), confirmed

    def places(self, w: list[str]) -> list[tuple[int, int, int, tuple[str, float, bool]]]:
        """(alignment score, from, to, prediction) of every notice in a window's words."""
        found, todo = [], [(0, len(w))]
        while todo:
            lo, hi = todo.pop()
            part = w[lo:hi]
            if not (said := self.predict_words(part)):
                continue
            mine = set(zip(part, part[1:]))
            closest = max(range(len(self.pairs[said[0]])), key=lambda k: len(mine & self.pairs[said[0]][k]) / len(self.pairs[said[0]][k]))
            score, a, b = aligned(part, words_of(TEMPLATES[said[0]][closest]))
            if not score:
                a, b = 0, len(part)
            found.append((score, lo + a, lo + b, said))
            todo += [(lo, lo + a), (lo + b, hi)]
        return found


def aligned(w: list[str], template: list[str]) -> tuple[int, int, int]:
    """Score, from and to of the best local alignment in ``w``: 2 a match, -1 a word changed, added or left out."""
    best, above = (0, 0, 0), [(0, 0)] * (len(template) + 1)
    for i, x in enumerate(w):
        row = [(0, i + 1)]
        for j, y in enumerate(template):
            score, start = above[j]
            if x == y:
                cell = (score + 2, start if score else i)
            else:
                score, start = max(above[j], above[j + 1], row[j])
                cell = (score - 1, start) if score > 1 else (0, i + 1)
            row.append(cell)
            if cell[0] > best[0]:
                best = (cell[0], cell[1], i + 1)
        above = row
    return best


def lowered(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def notices(model: Classifier, text: str, exhaustive: bool = False) -> list[tuple[int, int, int, str, float, bool]]:
    """Line number, start, end, family, probability and confirmed of every notice of a text, in order.

    start and end are the notice's place widened to the ends of its lines, or as far as its window goes. ``exhaustive``
    predicts every window instead of those whose bound allows it; the result is the same.
    """
    low = lowered(text)
    words = WORD.findall(low)
    centres = range(len(words)) if exhaustive else model.possible(words).tolist()
    if not centres:
        return []
    spans = [m.span() for m in WORD.finditer(low)]
    starts = [s for s, _ in spans]
    lines = [m.end() for m in re.finditer("\n", text)]
    blanks = [m.end() for m in _BLANK.finditer(text)]

    def bounds(cuts: list[int], at: int) -> tuple[int, int]:
        """Words between the cuts around a place."""
        k = bisect_right(cuts, at)
        return bisect_left(starts, cuts[k - 1]) if k else 0, bisect_left(starts, cuts[k]) if k < len(cuts) else len(words)

    windows: dict[tuple[int, int], tuple] = {}
    for i in centres:
        for cuts in (lines, blanks):
            lo, hi = bounds(cuts, starts[i])
            lo, hi = max(lo, i - REACH), min(hi, i + REACH + 1)
            if (lo, hi) not in windows and (said := model.predict_words(words[lo:hi])):
                windows[lo, hi] = (-said[1], lo, hi)
    found, settled = [], []  # settled: places in order
    for _, lo, hi in sorted(windows.values()):
        k = bisect_right(settled, [(lo + hi) // 2, len(words)])
        if k and settled[k - 1][1] > (lo + hi) // 2:
            continue
        for score, i, j, said in model.places(words[lo:hi]):
            found.append((-score, lo + i, lo + j, said, lo, hi))
            insort(settled, [lo + i, lo + j])
    kept: list[list] = []
    for _, i, j, said, lo, hi in sorted(found, key=lambda x: x[:4]):
        k = bisect_left(kept, [j])
        if k and kept[k - 1][1] > i:  # those kept do not overlap, so the last that begins before ends last
            if kept[k - 1][2] == said[0]:
                kept[k - 1][3:5] = max(kept[k - 1][3], said[1]), kept[k - 1][4] or said[2]
            continue
        insort(kept, [i, j, *said, lo, hi], key=lambda x: x[0])
    out = []
    for i, j, family, probability, confirmed, lo, hi in kept:
        line, last = bisect_right(lines, starts[i]), bisect_right(lines, starts[j - 1])
        first, end = lines[line - 1] if line else 0, lines[last] - 1 if last < len(lines) else len(text)
        if starts[lo] > first and lo and starts[lo - 1] >= first:
            first = starts[lo]  # the line begins before the window
        if hi < len(words) and starts[hi] < end:
            end = spans[hi - 1][1]
        out.append((line, first, end, family, round(probability, 4), confirmed))
    return out


def train(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Classifier:
    """A classifier whose ordinary windows come from ``sample`` documents by id hash."""
    ids = docs.where("doc_id is not null and text is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")  # sample ids at most

    def run(batches):
        size = 2 * REACH + 1
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                for line in (text or "").split("\n"):
                    if not DOUBTFUL.search(line):
                        w = words_of(line)
                        out += [" ".join(w[i : i + size]) for i in range(0, len(w), size)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["w"])

    rows = chosen.mapInArrow(run, "w string").distinct().orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WINDOWS).collect()
    return Classifier([r["w"].split(" ") for r in rows])


def licence_scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """A row for every notice of a known family: doc_id, paragraph (line number), start, end (code points), family, probability, confirmed."""

    def run(batches):
        for batch in batches:
            which, out = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if not text:
                    continue
                rows = notices(model, text)
                which += [i] * len(rows)
                out += rows
            cols = [*zip(*out)] or [()] * 6
            types = (pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(which, pa.int32())), *[pa.array(list(c), t) for c, t in zip(cols, types)]], ["doc_id", "paragraph", "start", "end", "family", "probability", "confirmed"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, paragraph int, start long, end long, family string, probability double, confirmed boolean")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return licence_scan(docs, train(docs))
