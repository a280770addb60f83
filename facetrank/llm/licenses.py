"""License scans: sparse TF-IDF cosines to templates, inherited along directories.

Every line of a file, and the whole text of a licence file, is compared with the
licence templates as TF-IDF vectors. Words of no template take the weight of a
word that no file has, so only counts of template words are needed; those are
taken over all files. A file without a licence of its own takes that of the
nearest directory above it that holds a licence file, found by joining
directories with their ancestors' paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetrank.llm.common import in_arrow, stored
from facetrank.llm.words import parts_of

THRESHOLD = 0.6
_PART_BYTES = 1 << 20
_WORD = re.compile(rb"[a-z0-9][a-z0-9.+-]*")
LICENSE_FILE = r"(?i)^(licen[sc]e|copying|notice|unlicense)([-._].*)?$"

# Identifiers and usual wording of public licence notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def words_of(text: bytes) -> list[bytes]:
    """Lowered words; a dot or dash belongs to a word only inside it."""
    return [w.rstrip(b".+-") for w in _WORD.findall(text.lower())]


VOCABULARY = sorted({w for _, text in TEMPLATES for w in words_of(text.encode())})


class Scanner:
    """Best template of a piece of text by the cosine of TF-IDF vectors.

    ``holding`` says how many of ``files`` files hold each template word.
    """

    def __init__(self, files: int, holding: dict[str, int], threshold: float):
        self.unknown = math.log(files + 1) + 1
        self.idf = {
            w: math.log((files + 1) / (holding.get(w.decode(), 0) + 1)) + 1 for w in VOCABULARY
        }
        self.threshold = threshold
        self.weights: dict[bytes, list[tuple[int, float]]] = {}
        for number, (_, text) in enumerate(TEMPLATES):
            vector = {w: n * self.idf[w] for w, n in Counter(words_of(text.encode())).items()}
            length = math.sqrt(sum(x * x for x in vector.values()))
            for word, x in vector.items():
                self.weights.setdefault(word, []).append((number, x / length))

    def best(self, text: bytes) -> tuple[float, str] | None:
        """Highest cosine and its licence; equal ones go to the first template."""
        counts = Counter(words_of(text))
        if not counts.keys() & self.weights.keys():
            return None
        square, dots = 0.0, [0.0] * len(TEMPLATES)
        for word, n in counts.items():
            x = n * self.idf.get(word, self.unknown)
            square += x * x
            for number, weight in self.weights.get(word, ()):
                dots[number] += x * weight
        top = max(range(len(dots)), key=dots.__getitem__)
        cosine = dots[top] / math.sqrt(square)
        return (cosine, TEMPLATES[top][0]) if cosine >= self.threshold else None

    def scan(self, text: bytes, is_license: bool) -> tuple[float, str] | None:
        """Best over all lines, and over the whole text of a licence file."""
        parts = {line for line in text.split(b"\n") if line.strip()}
        if is_license:
            parts.add(text)
        found = [x for x in map(self.best, sorted(parts)) if x]
        return max(found, key=lambda x: x[0]) if found else None


def _held_words(batches):
    vocabulary = frozenset(VOCABULARY)
    for batch in batches:
        held: Counter = Counter()
        for part in parts_of(batch, 0, _PART_BYTES):
            for text in part.column(0).to_pylist():
                held.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(["", *(w.decode() for w in held)], pa.string()),
                pa.array([batch.num_rows, *held.values()], pa.int64()),
            ],
            ["word", "files"],
        )


def _scan(files: int, holding: dict[str, int], threshold: float):
    def run(batches):
        scanner = Scanner(files, holding, threshold)
        for batch in (part for whole in batches for part in parts_of(whole, 2, _PART_BYTES)):
            _, paths, texts, flags = (c.to_pylist() for c in batch.columns)
            found = [scanner.scan(t, f) for t, f in zip(texts, flags, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(paths, pa.string()),
                    batch.column(3),
                    pa.array([x and x[1] for x in found], pa.string()),
                    pa.array([x and x[0] for x in found], pa.float64()),
                ],
                ["file_id", "path", "is_license", "license", "score"],
            )

    return run


def scan_licenses(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``files (file_id, path, text)``.

    ``license`` with ``origin`` 'own' (a line, or a licence file's whole text,
    reaches the threshold; ``score`` is its cosine) or 'inherited' (``score`` and
    ``from_dir`` are those of the nearest directory with a licence file that has
    one), else null. Of several licence files in a directory the best score counts,
    then the smaller licence. Paths use '/'; a null path is a file at the top,
    whose directory is ''. Null and empty texts have no licence of their own.
    Repeated rows are scanned each; other columns are ignored.
    """
    source = files.select(
        F.col("file_id").cast("bigint").alias("file_id"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    source = source.withColumn(
        "is_license", F.element_at(F.split("path", "/"), -1).rlike(LICENSE_FILE)
    )
    # At most as many rows as template words.
    counts = {
        r.word: r.files
        for r in in_arrow(source.select("text"), _held_words, "word string, files bigint")
        .groupBy("word")
        .agg(F.sum("files").alias("files"))
        .collect()
    }
    total = counts.pop("", 0)
    own = stored(
        in_arrow(
            source,
            _scan(total, counts, threshold),
            "file_id bigint, path string, is_license boolean, license string, score double",
        ).withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")),
        "own_licenses",
    )
    least = F.min(F.struct((-F.col("score")).alias("minus"), F.col("license")))
    given = stored(
        own.where("is_license and license is not null")
        .groupBy(F.col("dir").alias("from_dir"))
        .agg(least.alias("top"))
        .select("from_dir", F.col("top.license").alias("given"), (-F.col("top.minus")).alias("given_score")),
        "directory_licenses",
    )
    # Each directory once, whatever the number of its files.
    parts = F.split("dir", "/")
    levels = F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts)))
    above = (
        own.where("license is null")
        .select("dir")
        .distinct()
        .select("dir", F.explode(levels).alias("depth"))
        .select("dir", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("from_dir"))
    )
    nearest = stored(
        above.join(given, "from_dir")
        .groupBy("dir")
        .agg(F.max_by(F.struct("from_dir", "given", "given_score"), "depth").alias("near")),
        "nearest_licenses",
    )
    has_own = F.col("license").isNotNull()
    inherited = F.when(~has_own, F.col("near"))
    return own.join(nearest, "dir", "left").select(
        "file_id",
        "path",
        F.coalesce("license", inherited["given"]).alias("license"),
        F.when(has_own, "own").when(inherited.isNotNull(), "inherited").alias("origin"),
        F.coalesce("score", inherited["given_score"]).alias("score"),
        inherited["from_dir"].alias("from_dir"),
    )
