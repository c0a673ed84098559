"""License scans by patience alignment.

Text and template are aligned on the words that are unique in both, in the order of the
longest increasing subsequence of their places; the gaps between are aligned in the same
way. Coverage is the share of the template's words that are aligned. Only stretches that
hold enough of a template's words are aligned; a stretch that holds fewer can't reach the
coverage, so nothing is lost.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.shared import filled, tune
from forgelake.llm.text import PUNCTUATED, hash_words, text_blocks

#: Notices as their licenses give them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "MIT-notice": "Released under the MIT License",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "proprietary": "All rights reserved",
}
COVERAGE = 0.8


def _words(text: str) -> list[int]:
    data = np.frombuffer(text.encode(), np.uint8)
    return hash_words(data, np.array([0, len(data)]), PUNCTUATED)[0].tolist()


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence."""
    tops, places, before = [], [], []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            places.append(i)
        else:
            tops[k], places[k] = v, i
        before.append(places[k - 1] if k else -1)
    out, i = [], places[-1] if places else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(template: list[int], text: list[int]) -> list[tuple[int, int]]:
    """Aligned places (template, text), in order."""
    out: list[tuple[int, int]] = []
    stack = [(0, len(template), 0, len(text))]
    while stack:
        a, b, c, d = stack.pop()
        while a < b and c < d and template[a] == text[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        once = Counter(template[a:b]), Counter(text[c:d])
        at = {w: c + k for k, w in enumerate(text[c:d]) if once[1][w] == 1}
        anchors = [(a + k, at[w]) for k, w in enumerate(template[a:b]) if once[0][w] == 1 and w in at]
        if not anchors:
            continue
        chain = [anchors[k] for k in increasing([y for _, y in anchors])]
        out += chain
        edges = [(a - 1, c - 1), *chain, (b, d)]
        stack += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def find(words: np.ndarray, template: list[int], coverage: float) -> Iterator[tuple[int, int, float]]:
    """(first word, end word, coverage) of stretches of a text, none overlapping, that the template covers."""
    n = len(template)
    known = np.array(sorted(set(template)), dtype=np.uint64)
    at = np.flatnonzero(known[np.minimum(np.searchsorted(known, words), len(known) - 1)] == words)
    need, width, k = int(np.ceil(coverage * n - 1e-9)), 2 * n, 0
    while k + need <= len(at):
        if at[k + need - 1] - at[k] >= width:
            k += 1
            continue
        low = int(at[k])
        pairs = patience(template, words[low : low + width].tolist())
        if len(pairs) < need or pairs[0][1] > 0:  # a better start comes later
            k += 1
            continue
        end = low + pairs[-1][1] + 1
        yield low, end, len(pairs) / n
        k = int(np.searchsorted(at, end))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """doc_id, license, start_word, end_word, coverage of each license text found in each whole text.

    Words are runs of letters and digits in lower case. A template's findings don't overlap
    each other; those of different templates may. A finding starts at a word of the
    template. Null and empty texts have none; rows with a null or repeated id are scanned
    like any other. Templates are few and small: they go to every task.
    """
    spark = tune(docs.sparkSession)
    sequences = {name: _words(text) for name, text in (TEMPLATES if templates is None else templates).items()}
    sequences = {name: words for name, words in sequences.items() if words}
    shared = spark.sparkContext.broadcast(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(shared.value)
        vocabulary = np.array(sorted({w for s in shared.value.values() for w in s}), dtype=np.uint64)
        # How many words of each template a present word can account for at most.
        share = np.zeros((len(vocabulary), len(names)))
        for t, s in enumerate(shared.value.values()):
            for w, c in Counter(s).items():
                share[np.searchsorted(vocabulary, np.uint64(w)), t] = c / len(s)
        for batch in batches:
            rows, out = [], []
            for low, _, data, offsets in text_blocks(batch.column(1)):
                words, _, _, firsts = hash_words(data, offsets, PUNCTUATED)
                if not len(words) or not len(vocabulary):
                    continue
                place = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
                hit = np.flatnonzero(vocabulary[place] == words)
                text = np.searchsorted(firsts, hit, side="right") - 1
                present = np.zeros((len(offsets) - 1, len(vocabulary)), dtype=bool)
                present[text, place[hit]] = True
                for i, t in np.argwhere(present @ share >= coverage - 1e-9):
                    for s, e, c in find(words[firsts[i] : firsts[i + 1]], shared.value[names[t]], coverage):
                        rows.append(low + i)
                        out.append((names[t], s, e, c))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(columns[k], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.float64()))]], names=["doc_id", "license", "start_word", "end_word", "coverage"]
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), filled(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, license string, start_word long, end_word long, coverage double")
