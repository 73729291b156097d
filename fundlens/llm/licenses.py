"""License scan by conditional compression against license templates.

A block of license-like lines is compressed alone and with each template as a raw
dictionary; templates are ranked by how much smaller the block gets, and the winner is
confirmed by the exact differences in wording.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = 9
#: Least size reduction of a winner and most words that a confirmed block may differ in, as a share of its words.
MIN_REDUCTION = 0.25
MAX_DIFFERENCE = 0.2
# fixed values: license notices as they are commonly worded
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Neither the name of the copyright holder nor the names of its contributors "
        "may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or "
                                           "neighboring rights to this work."),
    "all-rights-reserved": ("All rights reserved.",),
}
# fixed values: words that make a line a candidate
MARKS = ("licen", "copyright", "©", "(c)", "all rights reserved", "permission is hereby", "redistribut", "creative commons",
         "cc by", "cc0", "free software", "public domain", "warrant", "spdx")
_word = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def words_of(text: str) -> tuple[str, ...]:
    return tuple(_word.findall(text.lower()))


def blocks_of(text: str | None) -> list[tuple[int, int, str]]:
    """(first line, number of lines, text) of each run of candidate lines."""
    low = (text or "").lower()
    if not any(m in low for m in MARKS):
        return []
    out: list[tuple[int, int, str]] = []
    for i, line in enumerate(text.split("\n")):
        if any(m in line.lower() for m in MARKS):
            if out and out[-1][0] + out[-1][1] == i:
                first, n, block = out[-1]
                out[-1] = (first, n + 1, f"{block}\n{line}")
            else:
                out.append((i, 1, line))
    return out


def differences(block: tuple[str, ...], template: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """(template words the block lacks, block words the template lacks) inside the best aligned stretch."""
    m = SequenceMatcher(None, block, template, autojunk=False)
    same = m.get_matching_blocks()[:-1]
    if not same:
        return list(template), list(block)
    lo, hi = same[0].a, same[-1].a + same[-1].size
    missing, extra = list(template[:same[0].b]), []
    for op, a0, a1, b0, b1 in SequenceMatcher(None, block[lo:hi], template[same[0].b:], autojunk=False).get_opcodes():
        if op != "equal":
            extra += block[lo:hi][a0:a1]
            missing += template[same[0].b:][b0:b1]
    return missing, extra


class Scanner:
    """Best license of a block; answers for repeated blocks are remembered in a bounded cache."""

    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES, min_reduction: float = MIN_REDUCTION,
                 max_difference: float = MAX_DIFFERENCE):
        kind = zstandard.DICT_TYPE_RAWCONTENT
        make = lambda **k: zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, **k)
        self._alone = make()
        self._given = [(name, t, make(dict_data=zstandard.ZstdCompressionDict(t.encode(), dict_type=kind), write_dict_id=False))
                       for name, variants in templates.items() for t in variants]
        self._least, self._most = min_reduction, max_difference
        self.best = lru_cache(maxsize=20_000)(self._best)

    def _best(self, block: str) -> tuple[str | None, float, list[str], list[str], bool]:
        """(license, size reduction, missing words, extra words, confirmed); the license is null if none is near."""
        data = block.encode()
        alone = len(self._alone.compress(data))
        ranked = sorted(((1 - len(c.compress(data)) / alone, name, t) for name, t, c in self._given),
                        key=lambda x: (-x[0], x[1], x[2]))
        # templates that share most of their wording come out close; the wording decides among them
        near = [r for r in ranked if r[0] >= max(self._least, ranked[0][0] - 0.15)]
        words, found = words_of(block), []
        for reduction, name, t in near:
            missing, extra = differences(words, words_of(t))
            found.append((max(len(missing), len(extra)), -reduction, name, missing, extra, len(words_of(t))))
        if not found:
            return None, round(ranked[0][0], 6) if ranked else 0.0, [], [], False
        n, reduction, name, missing, extra, size = min(found)
        return name, round(-reduction, 6), missing, extra, n <= self._most * size


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per block of license-like lines, of whole texts.

    Returns doc_id, first_line, n_lines, license_id (null if no template is near), reduction,
    missing and extra (words) and confirmed.  Null and empty texts have no blocks; rows with a
    null id and repeated rows are scanned each; equal reductions go to the fewest differing
    words, then the first template by name; an empty table gives no rows; other columns are not read.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_()]
        for b in batches:
            rows = [(doc, first, n, *scanner.best(block))
                    for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for first, n, block in blocks_of(text)]
            cols = list(zip(*rows)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "first_line", "n_lines", "license_id", "reduction", "missing",
                                                    "extra", "confirmed"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        search, "doc_id long, first_line int, n_lines int, license_id string, reduction double, "
                "missing array<string>, extra array<string>, confirmed boolean")
