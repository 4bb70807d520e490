"""Licence scans by conditional compression: a template that explains a block makes it compress to little."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import importable, whole

#: Licence notices, and the grants of the short licences (fixed values): (licence, text). <...> stands for any words.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Proprietary", "All rights reserved."),
)

#: What every notice holds, whatever its lines end on.
CUES = (
    r"(?i)licen[cs]|public\W+domain|creative\W+commons|copyright|hereby\W+granted|free\W+software|all\W+rights\W+reserved"
    r"|redistribut|without\W+restriction|sublicen[cs]e|spdx|\bcc0\b|warrant"
)
#: Words of a template that may be missing, or come between its words, as a share of its words.
DIFFERENCES = 0.1

_WORD = re.compile(r"[\w.+/:-]*\w")
#: Between the halves of a word that was wrapped at its hyphen.
_WRAPPED = re.compile(r"-[ \t\r]*\n[^\w\n]*")
#: Words that tell one licence from another: names and versions. None of them may be missing or replaced.
_TELLING = re.compile(r"\d|^(?:apache|mit|bsd|isc|gnu|lesser|affero|general|mozilla|mpl|gpl|cc0?|by|by-.*|attribution.*)$")


def words(text: str, known: frozenset[str] = frozenset()) -> list[tuple[str, int, int]]:
    """Lower-case words with their places; a full stop that ends a word is not part of it.

    The halves of a word that a line end cuts at its hyphen are one word where that is a known one.
    """
    out = []
    for m in _WORD.finditer(text):
        if out and text[out[-1][2]] == "-" and _WRAPPED.fullmatch(text, out[-1][2], m.start()):
            whole_word = f"{out[-1][0]}-{m[0].lower()}"
            if whole_word in known:
                out[-1] = whole_word, out[-1][1], m.end()
                continue
        out.append((m[0].lower(), m.start(), m.end()))
    return out


def places(template: list[str], block: list[str]) -> list[tuple[int, int, int, list[str], list[str]]]:
    """(differences, first, last + 1, missing, added): the parts of the block that read as the template but for
    DIFFERENCES, apart from each other. Of parts that overlap, the one with the fewest differences, then the first.

    A difference is a word to delete from the template or to add to it; a telling word may be neither.
    """
    m, most = len(template), int(DIFFERENCES * len(template))
    out = []
    for low, high in _dense(template, block, most):
        n = high - low
        part, never = block[low:high], most + 1
        lose = [never if _TELLING.search(w) else 1 for w in template]
        more = [never if _TELLING.search(w) else 1 for w in part]
        # cost[j]: fewest differences of the template's words so far against a part of the block that ends before word j
        cost, begin, steps = [0] * (n + 1), list(range(n + 1)), []
        for i in range(m):
            new, start, step = [cost[0] + lose[i]], [begin[0]], ["m"]
            for j in range(n):
                best, at, how = cost[j + 1] + lose[i], begin[j + 1], "m"
                if new[j] + more[j] < best:
                    best, at, how = new[j] + more[j], start[j], "a"
                if template[i] == part[j] and cost[j] <= best:
                    best, at, how = cost[j], begin[j], "="
                new.append(best)
                start.append(at)
                step.append(how)
            cost, begin = new, start
            steps.append(step)
        ends = sorted((cost[j], j) for j in range(n + 1) if cost[j] <= most and begin[j] < j)
        free = [True] * n
        for least, end in ends:
            if not all(free[begin[end] : end]):
                continue
            free[begin[end] : end] = [False] * (end - begin[end])
            i, j, missing, added = m - 1, end, [], []
            while i >= 0:
                how = steps[i][j]
                if how == "=":
                    i, j = i - 1, j - 1
                elif how == "a":
                    j -= 1
                    added.append(part[j])
                else:
                    missing.append(template[i])
                    i -= 1
            out.append((least, low + begin[end], low + end, missing[::-1], added[::-1]))
    return out


def _dense(template: list[str], block: list[str], most: int) -> list[tuple[int, int]]:
    """The parts of the block outside which no place can be: one with `most` differences has all but `most` words of the
    template, within as many words as the template has and `most` more."""
    m = len(template)
    need, width = Counter(template), m + most
    shared, out = 0, []
    for j, word in enumerate(block):
        if word in need:
            need[word] -= 1
            shared += need[word] >= 0
        if j >= width and block[j - width] in need:
            shared -= need[block[j - width]] >= 0
            need[block[j - width]] += 1
        if shared >= m - most:
            low = max(0, j - width + 1)
            if out and low <= out[-1][1]:
                out[-1] = out[-1][0], j + 1
            else:
                out.append((low, j + 1))
    return out


class Templates:
    """The templates as raw zstandard dictionaries, and their words."""

    def __init__(self, templates: tuple[tuple[str, str], ...], level: int = 9):
        self.names = [name for name, _ in templates]
        self.words = [[w for w, _, _ in words(text)] for _, text in templates]
        self.counts = [Counter(w) for w in self.words]
        self.known = frozenset(w for one in self.words for w in one)
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False)
        kind = zstandard.DICT_TYPE_RAWCONTENT
        self.given = [
            zstandard.ZstdCompressor(
                level=level,
                write_content_size=False,
                dict_data=zstandard.ZstdCompressionDict(" ".join(w).encode(), dict_type=kind),
            )
            for w in self.words
        ]

    def scan(self, block: str) -> list[tuple[str, float, int, int, str, str]]:
        """(licence, reduction, start, end, missing, added) of the confirmed winners, apart from each other.

        What lies between them is scanned again, until nothing more is confirmed. The reduction is that of the part
        of the block that was scanned.
        """
        found = words(block, self.known)
        tokens = [w for w, _, _ in found]
        out, todo = [], [(0, len(tokens))]
        while todo:
            low, high = todo.pop()
            taken = self._winners(tokens[low:high])
            for i, part, a, b, missing, added in taken:
                place = found[low + a][1], found[low + b - 1][2]
                out.append((self.names[i], part, *place, " ".join(missing), " ".join(added)))
            if taken:
                edges = [low, *(low + x for _, _, a, b, _, _ in taken for x in (a, b)), high]
                todo += [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]
        return sorted(out, key=lambda x: x[2])

    def _winners(self, tokens: list[str]) -> list[tuple[int, float, int, int, list[str], list[str]]]:
        """(template, reduction, first, last + 1, missing, added) in order: the longest places that do not overlap.

        Every template that DIFFERENCES could still allow is compared by wording: one with all its telling words, and
        all but so many of the others, in the part.
        """
        has = Counter(tokens)
        text, plain, sure = " ".join(tokens).encode(), 0, []
        for i, needed in enumerate(self.counts):
            short = [(w, n - has[w]) for w, n in needed.items() if has[w] < n]
            lacking = sum(n for _, n in short)
            if lacking > DIFFERENCES * len(self.words[i]) or any(_TELLING.search(w) for w, _ in short):
                continue
            got = places(self.words[i], tokens)
            if not got:
                continue
            plain = plain or len(self.plain.compress(text))
            part = (plain - len(self.given[i].compress(text))) / plain
            sure += [(a - b, least, -part, i, a, b, missing, added) for least, a, b, missing, added in got]
        out, free = [], [True] * len(tokens)
        for _, _, part, i, a, b, missing, added in sorted(sure, key=lambda x: x[:5]):
            if all(free[a:b]):
                free[a:b] = [False] * (b - a)
                out.append((i, -part, a, b, missing, added))
        return sorted(out, key=lambda x: x[2])


@lru_cache(4)
def _templates(templates: tuple[tuple[str, str], ...]) -> Templates:
    return Templates(templates)


#: Characters around a cue in which the notice lies, across line ends: every template has a cue and is shorter than this.
REACH = 1000


def blocks(text: str, cue: re.Pattern) -> Iterator[tuple[int, str]]:
    """(place, block): the parts of the text within REACH of a cue, apart from each other."""
    start = end = None
    for m in cue.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if start is not None and a > end:
            yield start, text[start:end]
            start = None
        start, end = a if start is None else start, b
    if start is not None:
        yield start, text[start:end]


_FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("license", T.StringType()),
            T.StructField("reduction", T.DoubleType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("missing", T.StringType()),
            T.StructField("added", T.StringType()),
        ]
    )
)
_ARROW = pa.list_(
    pa.struct(
        [("license", pa.string()), ("reduction", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]
        + [("missing", pa.string()), ("added", pa.string())]
    )
)


def licenses_in(text: str, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> list[tuple]:
    """(licence, reduction, start, end, missing, added) for each confirmed notice in the whole text, in order."""
    known, cue = _templates(templates), re.compile(CUES)
    out = []
    for at, block in blocks(text, cue):
        out += [(name, part, at + a, at + b, less, more) for name, part, a, b, less, more in known.scan(block)]
    return out


def with_licenses(
    docs: DataFrame, out: str = "licenses", templates: tuple[tuple[str, str], ...] = TEMPLATES, text_col: str = "text"
) -> DataFrame:
    """The documents with their licence notices: (license, reduction, start, end, missing, added), in order.

    Places are code points of the text, end exclusive. Texts without a cue are not sent to Python. Null, empty and
    cueless texts have an empty list. No rows are moved; repeated rows get the same list.
    """
    names = [f.name for f in _FOUND.elementType.fields]

    @F.arrow_udf(_FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        found = [licenses_in(x.as_py() or "", templates) for x in texts]
        return pa.array([[dict(zip(names, x)) for x in one] for one in found], _ARROW)

    scan = scan.asNondeterministic()  # else Spark calls it once to filter and once to read
    text = whole(text_col)
    return importable(docs).withColumn(out, scan(F.when(text.rlike(CUES), text).otherwise("")))


def notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per confirmed notice: the id column, license, reduction, start, end, missing, added."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return with_licenses(rows).select(F.col("id").alias(id_col), F.inline("licenses"))
