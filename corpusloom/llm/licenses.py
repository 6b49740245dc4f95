"""Operator 7: licence scans by the Dice coefficient of word bigrams.

A text is lower-cased and cut into words; every window of its words, whatever its line breaks, counts
against each licence template by ``2 |A ∩ B| / (|A| + |B|)`` over their sets of word bigrams.  Only
these windows need a look, and all others are no better:

* of templates of which the text has ``t / (2 - t)`` of the bigrams; no other reaches the coefficient ``t``;
* those that begin and end with a bigram of the template;
* those whose first bigram does not come again, since the window without it has the same bigrams.

A template of one word is met by that word.  Of overlapping windows the one counts that explains most:
with the most shared bigrams less those that only one side has, so that a licence that holds all of
another's text (BSD-3-Clause) is not taken for it; then the shortest, the earliest, the first template.
``Scanner.matches`` has runs of whole lines, by coefficient first.

Templates are the notices below and the full texts beside this module (``full_texts``); callers may
pass any list of (name, text) instead.  A null or empty text matches nothing.  Repeated rows give
repeated results.  An empty table gives an empty result.  Other columns pass through ``scan``.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Names of licences and the notices by which texts refer to them or carry them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0"""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution."""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version."""),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means."""),
]

#: Notices that are looked for besides ``TEMPLATES``.
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} General
    Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option)
    any later version."""
_BSD = TEMPLATES[[name for name, _ in TEMPLATES].index("BSD-2-Clause")][1]
MORE = [
    ("BSD-3-Clause", _BSD + """ Neither the name of the copyright holder nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written permission."""),
    ("AGPL-3.0", _GNU.format("Affero", 3)), ("LGPL-3.0", _GNU.format("Lesser", 3)), ("LGPL-2.1", _GNU.format("Lesser", 2.1)),
    ("GPL-2.0", _GNU.format("", 2)),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""),
]
TEXTS = Path(__file__).with_name("license_texts")


def full_texts() -> list[tuple[str, str]]:
    """(name, text) of the files of whole licences; read on the driver."""
    return [(path.stem, path.read_text(encoding="utf-8")) for path in sorted(TEXTS.glob("*.txt"))]


def default_templates() -> list[tuple[str, str]]:
    return [*TEMPLATES, *MORE, *full_texts()]


_WORDS = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def bigrams(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:])) if len(words) > 1 else {(word,) for word in words}


class Scanner:
    """Templates and the bigrams that lead to them."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.names = [name for name, _ in templates]
        self.sets = [bigrams(_WORDS.findall(text.lower())) for _, text in templates]
        self.of: dict[tuple, list[int]] = defaultdict(list)
        for at, found in enumerate(self.sets):
            for one in found:
                self.of[one].append(at)
        self.every = frozenset(self.of)
        self.single = any(len(one) == 1 for one in self.every)
        reach = threshold / (2 - threshold)
        self.bounds = [(math.ceil(len(s) * reach - 1e-9), math.floor(len(s) / reach + 1e-9)) for s in self.sets]

    def windows(self, text: str) -> list[tuple[str, int, int, float]]:
        """(licence, first line, number of lines, coefficient) of the windows of words that match."""
        text = text.lower()
        words = _WORDS.findall(text)
        pairs = list(zip(words, words[1:]))
        found = self.every.intersection(pairs)
        single = [(-1, 0, at, template, at - 1, 1.0) for at, word in enumerate(words) if (word,) in self.every
                  for template in self.of[(word,)]] if self.single else []
        counts = Counter(template for pair in found for template in self.of[pair])
        near = [template for template, n in counts.items() if n >= self.bounds[template][0]]
        if not near and not single:
            return []
        number: dict[tuple, int] = {}
        codes = np.array([number.setdefault(pair, len(number)) for pair in pairs], np.int64)
        order = np.argsort(codes, kind="stable")
        again = np.flatnonzero(codes[order][1:] == codes[order][:-1])
        before, after = np.full(len(codes), -1), np.full(len(codes), len(codes))
        before[order[again + 1]], after[order[again]] = order[again], order[again + 1]
        hits = {}
        for template in near:
            mine = np.zeros(len(number), bool)
            mine[[number[pair] for pair in found if pair in self.sets[template]]] = True
            hits[template] = mine[codes]

        def best(template: int, start: int, limit: int) -> tuple[int, int, int, int, int, float] | None:
            """The best window from the bigram at ``start`` that ends before the one at ``limit``."""
            high, width = self.bounds[template][1], 2 * self.bounds[template][1] + 16
            end = min(int(after[start]), limit)
            while True:
                new = before[start : min(end, start + width)] < start
                size = np.cumsum(new)
                if start + width >= end or size[-1] > high:
                    break
                width *= 2
            both = np.cumsum(new & hits[template][start : start + len(new)])
            sizes = size + len(self.sets[template])
            dice = 2 * both / sizes
            score = np.where(dice >= self.threshold, 3 * both - sizes, -sizes[-1] - 1)
            at = int(score.argmax())
            if dice[at] < self.threshold:
                return None
            return -int(score[at]), at + 1, start, template, start + at, float(dice[at])

        heap = single + [one for template in near for start in np.flatnonzero(hits[template])
                         if (one := best(template, int(start), len(codes)))]
        heapq.heapify(heap)
        starts: list[int] = []
        ends: dict[int, int] = {}
        kept = []
        while heap:
            _, _, start, template, end, dice = heapq.heappop(heap)
            at = bisect_right(starts, start)
            if at and ends[starts[at - 1]] >= start:
                continue
            if at < len(starts) and end + 1 >= starts[at]:  # it runs into a better one: what is left before that
                left = best(template, start, starts[at] - 1) if starts[at] - 1 > start else None
                if left:
                    heapq.heappush(heap, left)
                continue
            insort(starts, start)
            ends[start] = end + 1
            kept.append((start, end + 1, template, dice))
        behind = np.cumsum([len(_WORDS.findall(line)) for line in text.split("\n")])
        made = []
        for start, last, template, dice in sorted(kept):
            first, final = (int(np.searchsorted(behind, at, side="right")) for at in (start, last))
            made.append((self.names[template], first, final - first + 1, dice))
        return made

    def matches(self, text: str) -> list[tuple[str, int, int, float]]:
        """(licence, first line, number of lines, coefficient) of the runs that match."""
        lines = [_WORDS.findall(line) for line in text.lower().split("\n")]
        touched: dict[int, list[int]] = defaultdict(list)
        for at, words in enumerate(lines):
            # A bigram may lie across lines: a line answers for the one it begins in.
            after = next((w[0] for w in lines[at + 1 : at + 2] if w), None)
            whole = [*words, after] if after is not None else words
            if not self.every.isdisjoint(zip(whole, whole[1:])) or len(words) == 1 and (words[0],) in self.every:
                hit = {t for pair in bigrams(whole) | bigrams(words) for t in self.of.get(pair, ())}
                for template in hit:
                    touched[template].append(at)
        good = [run for template, at in sorted(touched.items()) for run in self._runs(lines, template, at)]
        taken, kept = set(), []
        for dice, start, last, template in sorted(good, key=lambda g: (-g[0], g[2] - g[1], *g[1:])):
            if taken.isdisjoint(range(start, last + 1)):
                taken.update(range(start, last + 1))
                kept.append((self.names[template], start, last - start + 1, dice))
        return sorted(kept, key=lambda k: k[1])

    def _runs(self, lines: list[list[str]], template: int, touched: list[int]) -> list[tuple[float, int, int, int]]:
        """(coefficient, first line, last line, template) of the runs that reach the threshold."""
        target, (low, high) = self.sets[template], self.bounds[template]
        ends = sorted({*touched, *(at + 1 for at in touched if at + 1 < len(lines))})
        good, inside = [], set(touched)
        for start in ends:
            words: list[str] = []
            own: set = set()
            for last in range(start, len(lines)):
                before = len(words)
                words += lines[last]
                own = bigrams(words) if before < 2 else own | set(zip(words[before - 1 :], words[before:]))
                if len(own) > high:
                    break
                if len(own) >= low and (last in inside or last - 1 in inside):
                    dice = 2 * len(own & target) / (len(own) + len(target))
                    if dice >= self.threshold:
                        good.append((dice, start, last, template))
        return good


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``matches``: an array of (license, first_line, n_lines, dice).

    An input column of that name gives way to it; other columns pass through.
    """
    docs = docs.drop("matches")
    chosen = default_templates() if templates is None else templates
    kind = pa.list_(pa.struct([("license", pa.string()), ("first_line", pa.int32()), ("n_lines", pa.int32()),
                               ("dice", pa.float64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, threshold)
        names = ("license", "first_line", "n_lines", "dice")
        for batch in batches:
            found = [[dict(zip(names, m)) for m in scanner.windows(text.as_py() or "")] for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "matches"])

    empty = F.array().cast("array<struct<license:string,first_line:int,n_lines:int,dice:double>>")
    return docs.mapInArrow(scanned, docs.select("*", empty.alias("matches")).schema)


def licences(docs: DataFrame, threshold: float = THRESHOLD, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per document: doc_id, n_matches, license (the best match's, null if none), dice, licenses."""
    found = scan(docs.select("doc_id", "text"), templates=templates, threshold=threshold)
    best = F.array_max(F.transform("matches", lambda m: F.struct(m.dice.alias("dice"), (-m.first_line).alias("at"),
                                                                 m.license.alias("license"))))
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m.license))), ",")
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"), best["license"].alias("license"),
        F.coalesce(best["dice"], F.lit(0.0)).alias("dice"), names.alias("licenses"),
    )
