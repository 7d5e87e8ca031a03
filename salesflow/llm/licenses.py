"""Licence notices in documents: a paragraph classifier confirmed by templates.

A paragraph is a line. Its features are the word unigrams and bigrams that occur in
the templates (sparse), the share of its words that do not, and its length. A softmax
regression over them is trained on the templates (whole, with words dropped, with
other words around them) and, as the unknown class, on paragraphs of a bounded,
hash-chosen sample of the documents and on shuffled template words. Its temperature
is fitted on a held-out part, and so is the least probability at which a family is
accepted: the one that ``leak`` of the held-out unknown paragraphs that a template confirms pass, 0.5 at least. The unknown class also holds
notices of licences without templates. A family is reported only if one of its templates confirms it: ``confirm`` of the
template's bigrams, in the paragraph, with a word that marks the family and none that marks a sibling (Lesser,
Affero, NonCommercial). A whole sentence such as "All rights reserved" must end where its template does, unless the paragraph
says copyright.

A notice may run over line ends. Within lines that follow each other without one that
has no word (comment marks are no words), the stretch of words that holds most bigrams
of a template, less ``GAP`` for each other place in it, is a notice if it lies on more
than one line, the template confirms it, and the classifier gives its words the
template's family. It spans all its lines, and stands for the notices of its family that
one of these lines holds alone if it has more bigrams than they; overlapping ones of a
family are one.

Lines without any template word are unknown without further work (their features
are those of the emptiest unknown paragraph); all others are scored.

Defined results: null and empty texts have no licence; the family with the most
confident paragraph is the document's, ties to the earlier paragraph; spans count
code points; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import text_sample, text_slices
from salesflow.llm.textbytes import ALNUM, mix, text_bytes, words

# fixed values: short customary notices of each family
TEMPLATES = {
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004", "SPDX-License-Identifier: Apache-2.0"],
    "bsd": [
        "Released under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by": [
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0"],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GPL v3.", "Licensed under the GPL v2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: GPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later"],
    "isc": [
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "mit": [
        "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "proprietary": [
        "All rights reserved.", "Copyright. All rights reserved.", "No part of this publication may be reproduced without prior written permission."],
    "public-domain": [
        "This work is in the public domain.", "Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright."],
}
FAMILIES = ["unknown", *sorted(TEMPLATES)]
# fixed values: words, or pairs of words, of which a notice of the family has one
MARKS = {"agpl": ["affero", "agpl"], "apache": ["apache"], "bsd": ["bsd", "redistribution"], "cc-by": ["cc by", "creative commons"],
         "cc-by-nc": ["by nc", "noncommercial"], "cc-by-nd": ["by nd", "noderivatives"], "cc-by-sa": ["by sa", "sharealike"], "epl": ["eclipse", "epl"],
         "gpl": ["gpl", "gnu"], "isc": ["isc", "granted"], "lgpl": ["lesser", "lgpl"], "mit": ["mit", "granted"], "mpl": ["mozilla", "mpl"]}
# fixed values: words, or pairs of words, of which a notice of the family has none, as they mark another one
_TERMS = {"nc": ["noncommercial", "by nc", "nc sa", "nc nd"], "nd": ["noderivatives", "noderivs", "by nd", "nc nd"], "sa": ["sharealike", "by sa", "nc sa"]}
FOREIGN = {"agpl": ["lesser", "lgpl"], "gpl": ["lesser", "lgpl", "affero", "agpl"], "lgpl": ["affero", "agpl"],
           "cc-by": [*_TERMS["nc"], *_TERMS["nd"], *_TERMS["sa"]], "cc-by-nc": [*_TERMS["nd"], *_TERMS["sa"]],
           "cc-by-nd": [*_TERMS["nc"], *_TERMS["sa"]], "cc-by-sa": [*_TERMS["nc"], *_TERMS["nd"]]}
#: families whose templates are sentences of everyday words: they end where the template does
SENTENCES = ("proprietary", "public-domain")
# fixed values: notices of licences without a family
OTHERS = [
    "SPDX-License-Identifier: OFL-1.1", "SPDX-License-Identifier: Zlib", "SPDX-License-Identifier: WTFPL", "SPDX-License-Identifier: BSL-1.0",
    "Licensed under the Artistic License 2.0.", "Released under the Boost Software License, Version 1.0.", "Licensed under the Open Software License version 3.0.",
    "Licensed under the European Union Public Licence v1.2.", "Licensed under CC BY-NC-ND 4.0.", "Licensed under CC BY-NC-SA 4.0.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."]
GAP = 0.2
_PAIR = mix(np.arange(31, 33, dtype=np.uint64)) | np.uint64(1)


def _bigrams(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * _PAIR[0] + h[1:] * _PAIR[1]) if len(h) > 1 else np.zeros(0, np.uint64)


def _hashes(text: str) -> np.ndarray:
    return words(*text_bytes(pa.array([text])), ALNUM).hash


def _term(text: str) -> int:
    """The hash of a word, or of a pair of words."""
    h = _hashes(text)
    return int(h[0] if len(h) == 1 else _bigrams(h)[0])


_MARKS = {FAMILIES.index(f): frozenset(map(_term, w)) for f, w in MARKS.items()}
_FOREIGN = {FAMILIES.index(f): frozenset(map(_term, w)) for f, w in FOREIGN.items()}
_SENTENCES = frozenset(map(FAMILIES.index, SENTENCES))
_COPYRIGHT = frozenset(map(_term, ("copyright", "©")))


def allowed(h: np.ndarray, line: np.ndarray, lines: int) -> np.ndarray:
    """(lines, families): whether a line has a mark of the family and none of a sibling; the unknown class always is."""
    same = line[1:] == line[:-1]
    key, of = np.r_[h, _bigrams(h)[same]], np.r_[line, line[1:][same]]
    hits = np.isin(key, np.array(sorted(frozenset().union(*_MARKS.values(), *_FOREIGN.values())), np.uint64))
    key, of = key[hits], of[hits]
    out = np.ones((lines, len(FAMILIES)), bool)
    for k in range(1, len(FAMILIES)):
        if k in _MARKS:
            out[:, k] = np.bincount(of[np.isin(key, np.array(sorted(_MARKS[k]), np.uint64))], minlength=lines) > 0
        if k in _FOREIGN:
            out[of[np.isin(key, np.array(sorted(_FOREIGN[k]), np.uint64))], k] = False
    return out


@dataclass
class Scanner:
    vocabulary: np.ndarray         # sorted hashes of template unigrams and bigrams
    weight: np.ndarray             # (vocabulary + 2) x families; last rows: share of foreign words, log of words
    bias: np.ndarray
    least: float
    templates: list[tuple[int, frozenset]]  # family and its bigrams (or its word, of a one-word template)
    confirm: float
    ends: list[int]                # the last bigram (or word) of each template

    def score(self, h: np.ndarray, line: np.ndarray, lines: int) -> np.ndarray:
        """Probabilities of each line's allowed families; ``h``: word hashes, ``line``: their lines, ascending."""
        x_line, x_cell = features(self.vocabulary, h, line)
        n = np.bincount(line, minlength=lines)
        known = np.bincount(line, weights=_known(self.vocabulary, h), minlength=lines)
        z = np.zeros((lines, len(FAMILIES)))
        root = np.sqrt(np.maximum(n, 1))
        for k in range(len(FAMILIES)):
            z[:, k] = np.bincount(x_line, weights=self.weight[x_cell, k], minlength=lines) / root
        z += np.column_stack([1 - known / np.maximum(n, 1), np.log1p(n)]) @ self.weight[-2:] + self.bias
        return _softmax(np.where(allowed(h, line, lines), z, -np.inf))

    def allowed(self, family: int, have: set) -> bool:
        """Whether the words and pairs of a paragraph hold a mark of the family and none of a sibling."""
        return (family not in _MARKS or not _MARKS[family].isdisjoint(have)) and _FOREIGN.get(family, frozenset()).isdisjoint(have)

    def confirmed(self, family: int, h: np.ndarray, runs_on: np.ndarray | None = None) -> float:
        """The largest share of a template of the family that the paragraph holds; ``runs_on``: words that another one follows at once."""
        pairs = _bigrams(h).tolist()
        have = {*h.tolist(), *pairs}
        if not self.allowed(family, have):
            return 0.0
        ended = have
        if family in _SENTENCES and runs_on is not None and have.isdisjoint(_COPYRIGHT):
            ended = {x for x, on in zip([*h.tolist(), *pairs], [*runs_on.tolist(), *runs_on[1:].tolist()], strict=True) if not on}
        return max((len(t & have) / len(t) for (f, t), end in zip(self.templates, self.ends, strict=True)
                    if f == family and (end not in have or end in ended)), default=0.0)

    def matched(self, family: int, h: np.ndarray) -> int:
        """The most bigrams that the paragraph shares with a template of the family that confirms it."""
        have = {*h.tolist(), *_bigrams(h).tolist()}
        return max((len(t & have) for f, t in self.templates if f == family and len(t & have) >= self.confirm * len(t)), default=0)

    def stretches(self, h: np.ndarray, line: np.ndarray, row: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(first word, last word, family, bigrams) of the stretches over several lines that a template confirms."""
        if len(h) < 2:
            return []
        pairs = np.unique(np.array([x for _, t in self.templates for x in t], np.uint64))
        member = np.array([np.isin(pairs, np.array([*t], np.uint64)) for _, t in self.templates]).T
        joined = (row[1:] == row[:-1]) & (line[1:] - line[:-1] <= 1)
        b = _bigrams(h)
        at = np.searchsorted(pairs, b)
        at[at == len(pairs)] = 0
        k = np.flatnonzero((pairs[at] == b) & joined)
        kind, paragraph = at[k], np.r_[0, np.cumsum(~joined)][k]
        # paragraphs with enough different bigrams of a template anywhere
        key = np.unique(paragraph * len(pairs) + kind)
        some, of = np.unique(key // len(pairs), return_inverse=True)
        held = np.zeros((len(some), member.shape[1]), np.int64)
        np.add.at(held, of, member[key % len(pairs)])
        out = []
        for i, j in zip(*np.nonzero(held >= self.confirm * member.sum(0)), strict=True):
            a, z = np.searchsorted(paragraph, [some[i], some[i] + 1])
            on = member[kind[a:z], j]
            family, template = self.templates[j]
            for first, last, n in _segments(k[a:z][on].tolist(), kind[a:z][on].tolist(), self.confirm * len(template)):
                if line[first] != line[last + 1]:
                    out.append((first, last + 1, family, n))
        return out

    def wrapped(self, h: np.ndarray, line: np.ndarray, row: np.ndarray) -> list[tuple[int, int, int, float, float, int]]:
        """(first line, last line, family, probability, template share, bigrams) of the notices over several lines."""
        out = []
        for first, last, family, n in self.stretches(h, line, row):
            core = h[first:last + 1]
            p = self.score(core, np.zeros(len(core), np.int64), 1)[0]
            around = np.flatnonzero((line >= line[first]) & (line <= line[last]) & (row == row[first]))
            have = {*h[around].tolist(), *_bigrams(h[around]).tolist()}
            if p[1:].argmax() + 1 == family and p[family] > self.least and self.allowed(family, have):
                out.append((int(line[first]), int(line[last]), family, float(p[family]), self.confirmed(family, core), n))
        return out


def _segments(at: list[int], kind: list[int], least: float) -> list[tuple[int, int, int]]:
    """(first place, last place, kinds) of the best stretches, apart from each other, with ``least`` kinds.

    ``at``: ascending places with a bigram of the template, ``kind``: which one.
    """
    found = []
    for i in range(len(at)):
        seen: set[int] = set()
        best = (0.0, 0, 0)
        for j in range(i, len(at)):
            places = at[j] - at[i] + 1
            if len(seen) + 1 <= GAP * (places - len(seen) - 1):
                break
            if kind[j] not in seen:
                seen.add(kind[j])
                worth = len(seen) - GAP * (places - len(seen))
                if worth > best[0]:
                    best = (worth, j, len(seen))
        if best[2] >= least:
            found.append((best[0], at[i], at[best[1]], best[2]))
    out: list[tuple[int, int, int]] = []
    for _, a, b, n in sorted(found, key=lambda x: (-x[0], x[1])):
        if all(b < c or a > d for c, d, _ in out):
            out.append((a, b, n))
    return sorted(out)


def _known(vocabulary: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = np.searchsorted(vocabulary, h)
    at[at == len(vocabulary)] = 0
    return vocabulary[at] == h


def features(vocabulary: np.ndarray, h: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, vocabulary cell) of each unigram and of each bigram within a line that the vocabulary has."""
    same = line[1:] == line[:-1]
    key, of = np.r_[h, _bigrams(h)[same]], np.r_[line, line[1:][same]]
    at = np.searchsorted(vocabulary, key)
    at[at == len(vocabulary)] = 0
    on = vocabulary[at] == key
    return of[on], at[on]


def _matrix(vocabulary: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    x = np.zeros((len(rows), len(vocabulary) + 2))
    for i, h in enumerate(rows):
        _, cell = features(vocabulary, h, np.zeros(len(h), np.int64))
        np.add.at(x[i], cell, 1 / max(len(h), 1) ** 0.5)
        x[i, -2] = 1 - _known(vocabulary, h).mean() if len(h) else 1
        x[i, -1] = np.log1p(len(h))
    return x


def train(docs: DataFrame, sample_docs: int = 500, confirm: float = 0.6, leak: float = 0.01,
          copies: int = 40, seed: int = 9) -> Scanner:
    """Fit on the templates and on paragraphs of about ``sample_docs`` documents (8 paragraphs of each at most)."""
    templates = [(FAMILIES.index(f), _hashes(t)) for f in sorted(TEMPLATES) for t in TEMPLATES[f]]
    vocabulary = np.unique(np.concatenate([np.r_[h, _bigrams(h)] for _, h in templates]))
    shapes = [(f, frozenset((_bigrams(h) if len(h) > 1 else h).tolist())) for f, h in templates]
    ends = [int(_bigrams(h)[-1] if len(h) > 1 else h[-1]) for _, h in templates]
    blank = Scanner(vocabulary, np.zeros((len(vocabulary) + 2, len(FAMILIES))), np.zeros(len(FAMILIES)), 1.0, shapes, confirm, ends)
    lines = (text_sample(docs, sample_docs)
             .select(F.slice(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), 1, 8).alias("p")))
    rng = np.random.default_rng(seed)
    unknown = []
    everyday_lines = []
    for some in (r["p"] for r in lines.collect() if r["p"]):
        hashes = [_hashes(x) for x in some]
        of = np.repeat(np.arange(len(some)), [len(h) for h in hashes])
        notice = {x for a, b, *_ in blank.stretches(np.concatenate(hashes), of, np.zeros(len(of))) for x in range(of[a], of[b] + 1)}
        everyday_lines += [x for i, x in enumerate(some) if i not in notice]
    for row in sorted(everyday_lines):
        h = _hashes(row)
        have = {*h.tolist(), *_bigrams(h).tolist()}
        if len(h) and all(len(t & have) < confirm * len(t) for _, t in shapes):
            unknown.append(h)
    everyday = np.concatenate(unknown) if unknown else mix(np.arange(500, dtype=np.uint64))
    bag = np.concatenate([h for _, h in templates])
    rows, y = [], []
    for family, h in templates:
        for c in range(copies):
            some = h[rng.random(len(h)) > 0.15] if c and len(h) > 4 else h
            around = [rng.choice(everyday, int(rng.integers(0, 9)) if c > copies // 2 else 0) for _ in range(2)]
            rows.append(np.r_[around[0], some, around[1]]), y.append(family)
    unknown += [rng.permutation(rng.choice(bag, int(rng.integers(1, 12)))) for _ in range(len(rows) // 2)]
    unknown += [np.r_[rng.choice(bag, int(rng.integers(1, 4))), rng.choice(everyday, int(rng.integers(3, 30)))] for _ in range(len(rows) // 2)]
    for h in map(_hashes, OTHERS):
        for c in range(copies):
            unknown.append(np.r_[h, rng.choice(everyday, int(rng.integers(0, 5)) if c > copies // 2 else 0)])
    y = np.array(y + [0] * len(unknown))
    x = _matrix(vocabulary, rows + unknown).astype(np.float32)
    held = rng.random(len(y)) < 0.25
    weight, bias = np.zeros((x.shape[1], len(FAMILIES)), np.float32), np.zeros(len(FAMILIES), np.float32)
    balance = 1 / np.bincount(y[~held], minlength=len(FAMILIES)).clip(1)[y[~held]]
    balance = (balance / balance.sum())[:, None].astype(np.float32)
    target, move, move_b = np.eye(len(FAMILIES), dtype=np.float32)[y[~held]], np.float32(0), np.float32(0)
    learn = x[~held]
    # what the marks rule out is not the regression's to tell apart; a thinned notice may have lost its mark
    every = rows + unknown
    barred = ~allowed(np.concatenate(every), np.repeat(np.arange(len(every)), [len(h) for h in every]), len(every))
    barred[np.arange(len(y)), y] = False
    wall = np.where(barred, np.float32(-1e9), np.float32(0))
    for _ in range(200):
        p = _softmax(learn @ weight + bias + wall[~held])
        g = (p - target) * balance
        move = 0.9 * move - 2.0 * (learn.T @ g + 1e-4 * weight)
        move_b = 0.9 * move_b - 2.0 * g.sum(0)
        weight, bias = weight + move, bias + move_b
    z = x[held] @ weight + bias + wall[held]
    heat = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0), key=lambda t: -np.log(_softmax(z / t)[np.arange(len(z)), y[held]] + 1e-12).mean())
    p = _softmax(z / heat)
    # paragraphs that no template confirms are never reported, whatever their probability
    passes = [any(blank.confirmed(f, h) >= confirm for f in range(1, len(FAMILIES))) for h, k, out in zip(every, y, held, strict=True) if out and not k]
    unknown_p = p[y[held] == 0, 1:].max(1)[np.array(passes, bool)]
    least = max(0.5, float(np.quantile(unknown_p, 1 - leak))) if len(unknown_p) >= 1 / leak else 0.5
    blank.weight, blank.bias, blank.least = weight / heat, bias / heat, least
    return blank


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _merged(single: list[tuple], wrapped: list[tuple]) -> list[tuple]:
    """Notices of one line and of several, by place; those of a family that overlap are one."""
    wide: list[list] = []
    for x in sorted(wrapped):
        inside = [y for y in single if y[2] == x[2] and x[0] <= y[0] <= x[1]]
        if any(y[5] >= x[5] for y in inside):
            continue
        same = next((y for y in wide if y[2] == x[2] and y[1] >= x[0]), None)
        if same:
            same[1] = max(same[1], x[1])
            same[3:] = max(same[3:], list(x[3:]))
        else:
            wide.append(list(x))
    return sorted([tuple(x) for x in wide] + [y for y in single if not any(x[2] == y[2] and x[0] <= y[0] <= x[1] for x in wide)])


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """doc_id, licence (family or null), its probability and template share, number of notices, spans (family:start:end)."""
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    end_of_line = np.zeros(256, bool)
    end_of_line[10] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                n = part.num_rows
                w = words(data, offsets, ALNUM)
                # lines: cut at line ends and at rows
                cuts = np.unique(np.r_[offsets[:-1], np.flatnonzero(end_of_line[data]) + 1])
                line = np.searchsorted(cuts, w.start, "right") - 1
                found: list[list] = [[] for _ in range(n)]
                if len(line):
                    notices = []  # first line, last line, family, probability, share, bigrams
                    # only lines with a template word are scored
                    with_known = np.unique(line[_known(s.vocabulary, w.hash)])
                    pick = np.isin(line, with_known)
                    h, of = w.hash[pick], np.searchsorted(with_known, line[pick])
                    # a word with one blank between it and the next
                    stop = w.start + w.length
                    runs_on = np.zeros(len(stop), bool)
                    runs_on[:-1] = (w.start[1:] == stop[:-1] + 1) & (data[np.minimum(stop[:-1], len(data) - 1)] == 0x20) & (w.doc[1:] == w.doc[:-1])
                    runs_on = runs_on[pick]
                    first = np.searchsorted(of, np.arange(len(with_known) + 1))
                    p = s.score(h, of, len(with_known))
                    best = p[:, 1:].argmax(1) + 1 if len(p) else np.zeros(0, np.int64)
                    for i in np.flatnonzero((p[np.arange(len(p)), best] > s.least) & (best != 0)):
                        one = h[first[i]:first[i + 1]]
                        share = s.confirmed(int(best[i]), one, runs_on[first[i]:first[i + 1]])
                        if share >= s.confirm:
                            at = int(with_known[i])
                            notices.append((at, at, int(best[i]), float(p[i, best[i]]), share, s.matched(best[i], one)))
                    for i, j, family, prob, share, _ in _merged(notices, s.wrapped(w.hash, line, w.doc)):
                        a = int(cuts[i])
                        row = int(np.searchsorted(offsets, a, "right") - 1)
                        b = int(min(cuts[j + 1] if j + 1 < len(cuts) else len(data), offsets[row + 1]))
                        if b > a and data[b - 1] == 10:
                            b -= 1
                        start = len(data[offsets[row]:a].tobytes().decode())
                        found[row].append((FAMILIES[family], start, start + len(data[a:b].tobytes().decode()), prob, share))
                top = [max(f, key=lambda x: (x[3], -x[1])) if f else (None, 0, 0, 0.0, 0.0) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([t[0] for t in top], pa.string()), pa.array([t[3] for t in top], pa.float64()),
                     pa.array([t[4] for t in top], pa.float64()), pa.array([len(f) for f in found], pa.int64()),
                     pa.array([",".join(f"{k}:{a}:{b}" for k, a, b, *_ in f) for f in found])],
                    ["doc_id", "licence", "probability", "template_share", "n_notices", "spans"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {key}, licence string, probability double, template_share double, n_notices long, spans string")
