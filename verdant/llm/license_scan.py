"""License scan by sparse TF-IDF cosine, with directory inheritance (operator 1).

Files are ``doc_id, path, text``.  Every line of a text is compared with the
templates (short headers and the opening passages of licence files) as sparse
TF-IDF vectors.  So is, for templates of :data:`PASSAGE` terms and more, every
passage of the template's length, across lines, anywhere in the text: a window
slides over the terms and its products and norm are kept up to date.  Document
frequencies of the templates' terms are counted over all lines of all files;
terms outside the templates weigh like unseen ones and only lengthen a line.

A line can reach the cosine threshold with a template only if it shares one of
the template's *leading* terms: the rest of its terms, by weight, has a norm
below the threshold.  Lines without any leading term are skipped, and windows
slide only over the places within reach of one; this is exact.

A file takes the licence of its best line.  A file without one inherits from
the nearest ancestor directory that holds a licence file (LICENSE, COPYING,
NOTICE, UNLICENSE or COPYRIGHT, any extension) with a licence: directories are
joined to the licence table by their ancestors' paths once each, then files to
their directories.

Edge cases: a null or empty text has no lines and can only inherit; a null
path has no directory and neither gives nor inherits; several licence files
of one directory: the best score, then the smallest licence name and path;
equal scores: the smallest template name; repeated rows are scanned each; an
empty table gives an empty result.  Only the three columns are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import staged

THRESHOLD = 0.55
PASSAGE = 12                          # terms from which a template is a passage, met across lines as well
FILE_NAME = r"(?i)^(licen[cs]e|copying|notice|unlicen[cs]e|copyright)([._-].*)?$"

# Short headers and opening passages of common licences.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is distributed under the MIT License, see the LICENSE file",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
                 "Licensed under the GNU Lesser General Public License, version 2.1."],
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
                 "Licensed under the GNU Affero General Public License, version 3."],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Neither the name of the copyright holder nor the names of its contributors may be used to endorse",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has dedicated all copyright to the public domain, CC0 1.0 Universal."],
    "ISC": ["Licensed under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
_TERM = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class Matcher:
    """Template vectors, their leading terms and the cosine of a passage."""

    def __init__(self, templates: dict[str, list[str]], df: dict[str, int], lines: int, threshold: float):
        self.threshold = threshold
        self.top = math.log(1 + lines) + 1
        self.idf = {t: math.log((1 + lines) / (1 + n)) + 1 for t, n in df.items()}
        self.names: list[str] = []
        self.postings: dict[str, list[tuple[int, float]]] = {}
        self.leading: set[str] = set()
        # by template length: leading terms, and term -> (template, weight)
        self.passages: dict[int, tuple[set[str], dict[str, list[tuple[int, float]]]]] = {}
        for name in sorted(templates):
            for text in templates[name]:
                found = terms(text)
                vector = self.weights(Counter(found))
                norm = math.sqrt(sum(w * w for w in vector.values())) or 1.0
                long = self.passages.setdefault(len(found), (set(), {})) if len(found) >= PASSAGE else None
                n = len(self.names)
                self.names.append(name)
                rest = 0.0
                for t, w in sorted(vector.items(), key=lambda x: (x[1], x[0])):
                    self.postings.setdefault(t, []).append((n, w / norm))
                    rest += (w / norm) ** 2
                    if math.sqrt(rest) >= threshold:      # this and heavier terms: no match without one
                        self.leading.add(t)
                        if long:
                            long[0].add(t)
                    if long:
                        long[1].setdefault(t, []).append((n, w / norm))

    def weights(self, counts: Counter) -> dict[str, float]:
        return {t: (1 + math.log(c)) * self.idf.get(t, self.top) for t, c in counts.items()}

    def best(self, found: list[str]) -> tuple[float, str] | None:
        """(cosine, licence) of the template nearest to a passage's terms, at or over the threshold."""
        if self.leading.isdisjoint(found):
            return None
        vector = self.weights(Counter(found))
        norm = math.sqrt(sum(w * w for w in vector.values()))
        dots: dict[int, float] = {}
        for t, w in vector.items():
            for n, tw in self.postings.get(t, ()):
                dots[n] = dots.get(n, 0.0) + w * tw
        n, dot = min(dots.items(), key=lambda x: (-round(x[1], 12), self.names[x[0]]))
        score = round(dot / norm, 6)
        return (score, self.names[n]) if score >= self.threshold else None

    def best_passage(self, found: list[str]) -> tuple[float, str, int] | None:
        """(cosine, licence, first term) of the best window of a long template's length in
        a text's terms; of equal ones the first."""
        best = None
        places = [i for i, t in enumerate(found) if t in self.leading]
        if not places:
            return None
        for size in sorted(self.passages):
            leading, postings = self.passages[size]
            last = max(len(found) - size, 0)
            # runs of window starts that hold a leading term
            runs: list[list[int]] = []
            for i in places:
                if found[i] in leading:
                    lo, hi = min(max(i - size + 1, 0), last), min(i, last)
                    if runs and lo <= runs[-1][1] + 1:
                        runs[-1][1] = hi
                    else:
                        runs.append([lo, hi])
            for lo, hi in runs:
                for score, n, start in self._slide(found, size, lo, hi, postings):
                    got = (-score, self.names[n], start)
                    if best is None or got < best:
                        best = got
        return (-best[0], best[1], best[2]) if best else None

    def _slide(self, found: list[str], size: int, lo: int, hi: int, postings: dict[str, list[tuple[int, float]]]):
        """``(cosine, template, start)`` at or over the threshold of the windows that start in ``lo..hi``."""
        counts: Counter[str] = Counter()
        dots: dict[int, float] = {n: 0.0 for meets in postings.values() for n, _ in meets}
        square = 0.0

        def change(t: str, by: int) -> None:
            nonlocal square
            idf, c = self.idf.get(t, self.top), counts[t]
            counts[t] = c + by
            was, now = ((1 + math.log(k)) * idf if k else 0.0 for k in (c, c + by))
            square += now * now - was * was
            for n, w in postings.get(t, ()):
                dots[n] += (now - was) * w

        for t in found[lo:lo + size]:
            change(t, 1)
        for start in range(lo, hi + 1):
            norm = math.sqrt(square)
            for n, dot in dots.items():
                if dot >= (self.threshold - 1e-6) * norm:
                    score = round(dot / norm, 6)
                    if score >= self.threshold:
                        yield score, n, start
            if start < hi:
                change(found[start], -1)
                change(found[start + size], 1)


def line_frequencies(files: DataFrame, vocabulary: list[str]) -> tuple[dict[str, int], int]:
    """Lines of all files that hold each template term, and the number of lines."""
    position = {t: i for i, t in enumerate(vocabulary)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary) + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    for line in text.lower().split("\n"):
                        total[-1] += 1
                        for t in position.keys() & set(_TERM.findall(line)):
                            total[position[t]] += 1
        yield pa.RecordBatch.from_pydict({"term": pa.array(range(len(total)), pa.int32()), "n": pa.array(total)})

    sums = {r.term: r.n for r in files.select("text").mapInArrow(count, "term int, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect()}       # one row a template term
    return {t: int(sums.get(i, 0)) for t, i in position.items()}, int(sums.get(len(vocabulary), 0))


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher: Matcher = shared.value
        for batch in batches:
            names, scores, line_nos = [], [], []
            for text in batch.column("text").to_pylist():
                found = None
                lines = [terms(line) for line in text.lower().split("\n")] if text else []
                for no, line in enumerate(lines):
                    got = matcher.best(line)
                    if got and (found is None or (-got[0], got[1]) < (-found[0], found[1])):
                        found = (*got, no)
                got = matcher.best_passage([t for line in lines for t in line])
                if got and (found is None or got[0] > found[0]):
                    ends = list(accumulate(map(len, lines)))
                    found = (got[0], got[1], bisect_right(ends, got[2]))
                names.append(found[1] if found else None)
                scores.append(found[0] if found else None)
                line_nos.append(found[2] if found else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("path"), batch.column("is_file"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(line_nos, pa.int32())],
                names=["doc_id", "path", "is_file", "license", "score", "line_no"])
    return run


def scan(files: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per file: ``doc_id, path, license, score, via, origin``.

    ``via`` is ``file`` (a licence file's own), ``header`` (found in another's text),
    ``inherited`` (from ``origin``, the directory of a licence file) or ``none``.
    """
    spark = files.sparkSession
    templates = TEMPLATES if templates is None else templates
    files = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"), "text")
    vocabulary = sorted({t for texts in templates.values() for x in texts for t in terms(x)})
    df, lines = line_frequencies(files, vocabulary)
    matcher = spark.sparkContext.broadcast(Matcher(templates, df, lines, threshold))
    name = F.element_at(F.split("path", "/"), -1)
    found = staged(
        files.withColumn("is_file", F.coalesce(name.rlike(FILE_NAME), F.lit(False)))
        .mapInArrow(_scan(matcher),
                    "doc_id long, path string, is_file boolean, license string, score double, line_no int"), "found")
    found = found.withColumn("dir", F.expr("CASE WHEN path LIKE '%/%' THEN substring_index(path, '/', "
                                           "size(split(path, '/')) - 1) WHEN path IS NOT NULL THEN '' END"))
    # the licence of each directory that holds a licence file
    given = (found.where("is_file and license is not null and dir is not null").groupBy("dir")
             .agg(F.min(F.struct((-F.col("score")).alias("minus"), F.col("license"), F.col("path"))).alias("best"))
             .select(F.col("dir").alias("origin"), F.col("best.license").alias("from_license"),
                     (-F.col("best.minus")).alias("from_score")))
    # each directory once: its ancestors, nearest first, against that table
    dirs = found.where("license is null and dir is not null").select("dir").distinct()
    up = dirs.select("dir", F.posexplode(F.expr(
        "CASE WHEN dir = '' THEN array('') ELSE concat(transform(sequence(size(split(dir, '/')), 1), "
        "k -> substring_index(dir, '/', k)), array('')) END")).alias("steps", "origin"))
    nearest = (up.join(given, "origin").groupBy("dir")
               .agg(F.min(F.struct("steps", "origin", "from_license", "from_score")).alias("n"))
               .select("dir", F.col("n.origin").alias("origin"), F.col("n.from_license").alias("from_license"),
                       F.col("n.from_score").alias("from_score")))
    none = found.where("license is null")
    inherited = none.join(nearest, "dir", "left").select(
        "doc_id", "path", F.col("from_license").alias("license"), F.col("from_score").alias("score"),
        F.when(F.col("origin").isNotNull(), "inherited").otherwise("none").alias("via"), "origin")
    own = found.where("license is not null").select(
        "doc_id", "path", "license", "score", F.when(F.col("is_file"), "file").otherwise("header").alias("via"),
        F.lit(None).cast("string").alias("origin"))
    return own.unionByName(inherited)
