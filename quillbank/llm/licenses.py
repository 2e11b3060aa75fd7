"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Every line and every paragraph of a whole text is a possible header; so is each of a licence file. Its TF-IDF vector is compared
with those of the templates. Document frequencies of the templates' terms are counted over all lines of all texts. A term that no
template has weighs like one found in a single line, which can only lower a cosine, never raise it.

A file without a license of its own takes that of the licence file in the nearest directory above it. Directories are few
against files: each distinct directory is resolved once by joining the paths above it with the directories that hold licence
files, and files join their directory with a salt, so a directory with a third of all files is spread.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillbank.llm.frames import Shared, attach, cut, slices, words

THRESHOLD = 0.6
SALTS = 32
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"

# The short notices of common licenses, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
     "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
     "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0-or-later", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


#: A line that names its license by SPDX identifier, up to an operator of an expression.
SPDX = re.compile(rb"SPDX-License-Identifier:\s*\(?\s*([A-Za-z0-9.+-]+)", re.I)
#: Older identifiers of the same licenses.
SPDX_OLD = {f"{k}-{v}{sign}": f"{k}-{v}-{word}" for k, v in (("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0")) for sign, word in (("", "only"), ("+", "or-later"))}
#: Terms that tell licenses of one family apart, beside the version.
TELLING = frozenset(b"lesser affero nc sa nd noncommercial sharealike later".split())


def telling(terms: list[bytes]) -> frozenset[bytes]:
    """The distinguishing terms, and the numbers behind the word version; a text and its template must agree in them."""
    found = TELLING.intersection(terms)
    for k, t in enumerate(terms):
        if t in (b"version", b"v") and terms[k + 1 : k + 2] and terms[k + 1].isdigit():
            minor = terms[k + 2 : k + 3] == [b"1"]
            found |= {terms[k + 1] + b".1" * minor}
    return found


@dataclass
class Templates:
    """Unit vectors of the templates, and the weight of each term; `other` is that of terms no template has."""

    names: list[str]
    vectors: list[dict[bytes, float]]
    weight: dict[bytes, float]
    other: float
    telling: list[frozenset[bytes]]

    @classmethod
    def of(cls, templates: list[tuple[str, str]], lines: int, seen: dict[bytes, int]) -> Templates:
        counts = [Counter(words(text.encode())) for _, text in templates]
        weight = {t: math.log((1 + lines) / (1 + seen.get(t, 0))) + 1 for c in counts for t in c}
        vectors = []
        for c in counts:
            v = {t: n * weight[t] for t, n in c.items()}
            size = math.sqrt(sum(x * x for x in v.values()))
            vectors.append({t: x / size for t, x in v.items()})
        return cls([n for n, _ in templates], vectors, weight, math.log((1 + lines) / min(2, 1 + lines)) + 1,
                   [telling(words(text.encode())) for _, text in templates])

    def best(self, terms: list[bytes], threshold: float, agree: bool = False) -> tuple[float, str] | None:
        """The best (cosine, name) of a line or paragraph, if it reaches the threshold; `agree`: of templates with its distinguishing terms."""
        known = Counter(t for t in terms if t in self.weight)
        if not known:
            return None
        here = {t: n * self.weight[t] for t, n in known.items()}
        own = sum(x * x for x in here.values())
        strange = len(terms) - sum(known.values())
        if own < threshold**2 * (own + strange * self.other**2):
            return None
        rest = sum(n * n for n in Counter(t for t in terms if t not in self.weight).values()) * self.other**2
        size = math.sqrt(own + rest)
        scored = [(sum(x * v.get(t, 0.0) for t, x in here.items()) / size, name) for v, name in zip(self.vectors, self.names)]
        if agree:
            own_telling = telling(terms)
            scored = [x for x, t in zip(scored, self.telling) if t == own_telling] or [(0.0, "")]
        score, name = min(scored, key=lambda s: (-round(s[0], 12), s[1]))
        return (min(score, 1.0), name) if score >= threshold else None


def scan(text: bytes, templates: Templates, threshold: float = THRESHOLD) -> tuple[float, str, int] | None:
    """The best (cosine, name, line from 0) over all lines and paragraphs; of equal ones the first line, then by name."""
    found: list[tuple[float, int, str]] = []
    paragraph: list[bytes] = []
    began = 0
    lines = text.split(b"\n")
    for k, line in enumerate([*lines, b""]):
        terms = words(line)
        if terms:
            named = SPDX.search(line)
            if named:
                name = named[1].decode()
                hit = 1.0, SPDX_OLD.get(name, name)
            else:
                hit = templates.best(terms, threshold, True)
            if hit:
                found.append((-round(hit[0], 12), k, hit[1]))
            if not paragraph:
                began = k
            paragraph += terms
        if not line.strip():
            if paragraph and k - began > 1 and (hit := templates.best(paragraph, threshold, True)):
                found.append((-round(hit[0], 12), began, hit[1]))
            paragraph = []
    if not found:
        return None
    score, line, name = min(found)
    return -score, name, line


def line_counts(texts: DataFrame, templates: list[tuple[str, str]]) -> tuple[int, dict[bytes, int]]:
    """The number of lines with words in `texts`, and in how many of them each term of the templates is."""
    wanted = {t for _, text in templates for t in words(text.encode())}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, seen = 0, Counter()
        for batch in batches:
            for text in slices(batch.column(0)):
                for line in text.split(b"\n"):
                    if terms := words(line):
                        lines += 1
                        seen.update(wanted.intersection(terms))
        seen[b""] = lines
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    rows = texts.select("text").mapInArrow(count, "term binary, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    seen = {bytes(r.term): r.n for r in rows}
    return seen.pop(b"", 0), seen


def with_own_license(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """`files` packed by `attach`; `found` has the license of the text itself, the cosine and the line it begins in, or nulls."""
    shared = Shared(files.sparkSession, Templates.of(templates, *line_counts(files, templates)))

    def work(batches: Iterator[dict[str, pa.Array]]) -> Iterator[pa.Array]:
        known = shared.get()
        for batch in batches:
            found = [scan(t, known, threshold) or (None, None, None) for t in slices(batch["text"])]
            yield pa.StructArray.from_arrays(
                [pa.array([f[1] for f in found], pa.string()), pa.array([f[0] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int64())],
                ["license", "score", "line"],
            )

    return attach(files, ["text"], work, "license string, score double, line bigint", keep)


def directory(path: Column) -> Column:
    """What stands before the last slash; '' for files at the top."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), ""))


def nearest_above(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, license, from_dir) for each distinct `dir` that has a licensed directory (dir, license) at or above it."""
    parts = F.split("dir", "/")
    above = directories.select("dir", F.explode(F.array_append(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")), "")).alias("up"))
    licensed = licensed.select(F.col("dir").alias("from_dir"), "license")
    joined = above.distinct().join(licensed, F.col("up") == F.col("from_dir"))
    best = F.max(F.struct(F.length("from_dir").alias("n"), "from_dir", "license")).alias("best")
    return joined.groupBy("dir").agg(best).select("dir", "best.license", "best.from_dir")


def licenses(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, path, own_license, score, line, license, from_dir) for every row of `files` (doc_id, path, text).

    license is the row's own or else that of the nearest licence file in its directory or above, whose directory is from_dir. Of
    several licence files in one directory the one with the best cosine counts, then the first by name of the license. Null and empty texts
    have no license of their own; a null path inherits none; repeated rows each get their result.
    """
    scanned = with_own_license(files.select("doc_id", "path", "text"), templates, threshold, ["doc_id", "path"])
    scanned = scanned.select("row.*", F.col("found.license").alias("own_license"), "found.score", "found.line")
    scanned = cut(scanned.withColumn("dir", directory(F.col("path"))))
    name = F.regexp_extract("path", "[^/]*$", 0)
    held = scanned.where(F.col("own_license").isNotNull() & name.rlike(LICENSE_FILE))
    licensed = held.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "own_license")).alias("best")).select("dir", F.col("best.own_license").alias("license"))
    resolved = nearest_above(scanned.where("own_license IS NULL AND dir IS NOT NULL").select("dir").distinct(), licensed)
    resolved = resolved.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = scanned.withColumn("salt", F.pmod(F.xxhash64("doc_id", "path"), F.lit(SALTS)).cast("int"))
    joined = salted.join(resolved, ["dir", "salt"], "left")
    inherited = F.col("own_license").isNull()
    return joined.select(
        "doc_id", "path", "own_license", "score", "line", F.coalesce("own_license", "license").alias("license"),
        F.when(inherited, F.col("from_dir")).alias("from_dir"),
    )
