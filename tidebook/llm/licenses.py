"""License scans: cosine to templates, then inheritance from the nearest directory (3).

Every line of every file, and every two neighbouring lines, are compared with the license templates
by the cosine of sparse TF-IDF vectors; a template's version and the words that tell its license
from its relatives must be there. A licence file is also compared as a whole, with the templates and
with the full texts in ``license_texts``; a full text counts before any line. A file without a header of its own takes the
license of the licence file in its directory, or in the nearest directory above, which a join on
paths finds. Directories are resolved once each, however many files they hold.

The terms are those of the templates, weighted by the number of documents that hold them; every
other term weighs as much as one that occurs nowhere else, so foreign words only lower a cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm.registry import query, table
from tidebook.llm.tfidf import BREAKS, document_counts, positions
from tidebook.llm.words import lowered, word_hash, words

#: Sentences by which licenses are named. Several may stand for one license.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found "
                     "in the LICENSE file."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files."),
    ("proprietary", "All rights reserved."),
    ("Apache-1.1", "Licensed under the Apache Software License, Version 1.1."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    *((name, text.format(kind=kind, version=version)) for name, kind, version in (
        ("GPL-1.0", "", "1"), ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"),
        ("LGPL-2.0", "Library ", "2"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"),
        ("AGPL-3.0", "Affero ", "3")) for text in (
            "This work is licensed under the GNU {kind}General Public License, version {version}.",
            "it under the terms of the GNU {kind}General Public License as published by the Free "
            "Software Foundation, either version {version} of the License, or")),
    *((name, f"SPDX-License-Identifier: {name}{end}") for name, end in (
        ("Apache-2.0", ""), ("BSD-2-Clause", ""), ("BSD-3-Clause", ""), ("ISC", ""), ("MIT", ""),
        ("MPL-2.0", ""), ("GPL-2.0", "-only"), ("GPL-2.0", "-or-later"), ("GPL-3.0", "-only"),
        ("GPL-3.0", "-or-later"), ("LGPL-2.1", "-only"), ("LGPL-2.1", "-or-later"),
        ("LGPL-3.0", "-only"), ("LGPL-3.0", "-or-later"), ("AGPL-3.0", "-only"),
        ("AGPL-3.0", "-or-later"))),
]
#: Full license texts, without their owners.
TEXTS = [(p.stem, p.read_text()) for p in sorted(Path(__file__).with_name(
    "license_texts").glob("*.txt"))]
#: Words of a template that a line must have for it: versions, and names of licenses.
REQUIRED = frozenset("""1 2 3 4 apache bsd mit isc mozilla mpl general lesser library affero cc by nc
    sa nd gpl lgpl agpl""".split())
#: Words that make a line with the first word one of another license, if its template lacks them.
FOREIGN = {"general": ("lesser", "affero"), "cc": ("nc", "sa", "nd")}
#: Words that a whole file has about as often as its text: the licenses' texts differ little else.
COUNTED = ("lesser", "library", "affero")
#: Least cosine of a line, or of a whole licence file, to its template.
COSINE = 0.6
#: Least cosine of a licence file to a full text: texts of one family are alike.
TEXT_COSINE = 0.9
#: Lines compared with all templates at once.
CHUNK = 4096
#: A path whose last part matches is a licence file.
LICENSE_NAME = r"(?i)^(licen[cs]e|copying|notice)([-._].*)?$"


@dataclass
class Templates:
    names: list[str]
    terms: np.ndarray
    weights: np.ndarray
    unknown: float  #: weight of every other term
    vectors: np.ndarray  #: unit vectors (templates, terms)
    counts: np.ndarray  #: words of each (templates, terms)
    required: np.ndarray  #: whether a line must have a term (templates, terms)
    foreign: np.ndarray  #: whether it must not


@dataclass
class Scanner:
    lines: Templates
    texts: Templates


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts, and the text of each."""
    column = pa.array(texts, pa.string())
    for found in words(lowered(column), BREAKS, piece_bytes=1 << 40):
        return found.hash, np.repeat(np.arange(len(texts)), np.diff(found.word_at))
    return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)


def scanner(files: DataFrame, templates: list[tuple[str, str]] | None = None,
            texts: list[tuple[str, str]] | None = None) -> Scanner:
    """Templates and texts as vectors, with document frequencies over all ``files``."""
    if texts is None:
        texts = TEXTS if templates is None else []
    templates = TEMPLATES if templates is None else templates
    both = [_hashed([t for _, t in named]) for named in (templates, texts)]
    every = np.unique(np.concatenate([h for h, _ in both]))
    documents, total = document_counts(files, every)
    out = []
    for named, (hashes, owner) in zip((templates, texts), both, strict=True):
        terms = np.unique(hashes)
        weights = np.log((1 + total) / (1 + documents[positions(every, terms)])) + 1
        counts = np.zeros((len(named), len(terms)))
        np.add.at(counts, (owner, positions(terms, hashes)), 1)
        vectors = counts * weights
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)

        def known(chosen, terms=terms):
            at = positions(terms, np.array([word_hash(w) for w in chosen], dtype=np.uint64))
            return at[at >= 0]

        required, foreign = np.zeros(counts.shape, bool), np.zeros(counts.shape, bool)
        must = known(sorted(REQUIRED))
        required[:, must] = counts[:, must] > 0
        for word, others in FOREIGN.items():
            own, other = known([word]), known(others)
            if len(own):
                foreign[:, other] |= (counts[:, own] > 0) & (counts[:, other] == 0)
        out.append(Templates([n for n, _ in named], terms, weights, float(np.log(1 + total) + 1),
                             vectors, counts, required, foreign))
    return Scanner(*out)


def _cosines(unit: np.ndarray, number: int, at: np.ndarray, t: Templates,
             text: np.ndarray | None = None, whole: bool = False):
    """Best template of each unit and its cosine; words are given by unit and term (-1: other).

    Units come in order. With ``text``, the text of each unit, a unit may also be taken together
    with the next one of its text. ``whole`` units are held against full texts.
    """
    best, cosine = np.zeros(number, dtype=np.int64), np.zeros(number)
    size = len(t.terms)
    if not len(t.names):
        return best, cosine
    others = np.bincount(unit[at < 0], minlength=number)
    unit, at = unit[at >= 0], at[at >= 0]
    telling = np.flatnonzero((t.required | t.foreign).any(axis=0))
    required, foreign = (x[:, telling].T.astype(float) for x in (t.required, t.foreign))
    counted = positions(t.terms, np.array([word_hash(w) for w in COUNTED], dtype=np.uint64))
    for a in range(0, number, CHUNK):
        end = min(a + CHUNK, number)
        last = min(end + (text is not None), number)
        low, high = np.searchsorted(unit, (a, last))
        counts = np.bincount((unit[low:high] - a) * size + at[low:high],
                             minlength=(last - a) * size).reshape(-1, size).astype(float)
        other = others[a:last].astype(float)
        forms = [(np.arange(a, end), counts[:end - a], other[:end - a])]
        if text is not None:
            first = np.flatnonzero(text[a:last][1:] == text[a:last][:-1])
            forms.append((a + first, counts[first] + counts[first + 1],
                          other[first] + other[first + 1]))
        for own, found, strange in forms:
            value = found * t.weights
            square = strange * t.unknown ** 2 + (value ** 2).sum(axis=1)
            near = value @ t.vectors.T / np.sqrt(np.maximum(square, 1e-12))[:, None]
            if whole:
                for c in counted[counted >= 0]:
                    have, want = found[:, c, None], t.counts[None, :, c]
                    near[(have > 2 * want + 1) | (want > 2 * have + 1)] = 0
            else:
                has = (found[:, telling] > 0).astype(float)
                near[((1 - has) @ required > 0) | (has @ foreign > 0)] = 0
            near = np.round(near, 12)
            k = near.argmax(axis=1)
            value = near[np.arange(len(own)), k]
            better = value > cosine[own]
            best[own[better]], cosine[own[better]] = k[better], value[better]
    return best, cosine


def _scan(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    s: Scanner = shared.value
    for batch in batches:
        whole = batch.column("is_license").to_numpy(zero_copy_only=False).astype(bool)
        names: list = [None] * len(whole)
        cosines = np.zeros(len(whole))
        for found in words(lowered(batch.column("text")), BREAKS):
            number = found.last - found.first
            at = positions(s.lines.terms, found.hash)
            text = np.repeat(np.arange(number), np.diff(found.word_at))
            # A line is a unit: words with as many line ends before them, in one text.
            line = np.cumsum(found.data == 10)[found.start] if len(at) else at
            new = np.ones(len(at), dtype=bool)
            new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
            unit = np.cumsum(new) - 1
            owner = text[new]
            best, cosine = _cosines(unit, len(owner), at, s.lines, owner)
            order = np.lexsort((-np.arange(len(owner)), cosine, owner))
            for i in order.tolist():  # the best and first line of a text comes last
                if cosine[i] > 0:
                    names[found.first + owner[i]] = s.lines.names[best[i]]
                    cosines[found.first + owner[i]] = cosine[i]
            files = np.flatnonzero(whole[found.first:found.last])
            inside = np.isin(text, files)
            place = np.searchsorted(files, text[inside])
            best, cosine = _cosines(place, len(files), at[inside], s.lines)
            full, full_cosine = _cosines(place, len(files), positions(
                s.texts.terms, found.hash[inside]), s.texts, whole=True)
            for i, file in enumerate((found.first + files).tolist()):
                if full_cosine[i] >= TEXT_COSINE:
                    names[file], cosines[file] = s.texts.names[full[i]], full_cosine[i]
                elif cosine[i] > cosines[file]:
                    names[file], cosines[file] = s.lines.names[best[i]], cosine[i]
        rest = [batch.column(c) for c in ("file_id", "path", "is_license")]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(names, pa.string()), pa.array(cosines)],
            ["file_id", "path", "is_license", "own", "cosine"])


def _directory(path: Column) -> Column:
    """The path without its last part; the root is the empty path."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame, templates: list[tuple[str, str]] | None = None,
         cosine: float = COSINE) -> DataFrame:
    """``file_id, path, license, cosine, inherited_from`` of every row of
    ``files(file_id, path, text)``.

    ``license`` is the file's own if a full text, a line or two lines reach ``cosine``, else that of the nearest directory
    with a licence file that has one; of several in a directory the most similar counts, then the
    one with the smallest path. ``cosine`` is that of the file's full text or own best line, 0 for null or empty
    texts. A file with a null path inherits nothing. Rows are independent: null and repeated ids
    keep a row each. Other columns are ignored; an empty table gives no rows.
    """
    spark = files.sparkSession
    shared = spark.sparkContext.broadcast(scanner(files, templates))
    rows = files.select(
        F.col("file_id").cast("long"), "path", "text",
        F.coalesce(F.element_at(F.split("path", "/"), -1).rlike(LICENSE_NAME), F.lit(False))
        .alias("is_license"))
    scanned = rows.select("file_id", "path", "is_license", "text").mapInArrow(
        lambda b: _scan(b, shared),
        "file_id long, path string, is_license boolean, own string, cosine double")
    scanned = scanned.withColumn("own", F.when(F.col("cosine") >= cosine, F.col("own"))
                                 ).withColumn("folder", _directory(F.col("path")))
    granted = scanned.where("is_license and own is not null and path is not null").groupBy(
        F.col("folder").alias("above")).agg(F.min_by(
            F.struct("own", "path"), F.struct(-F.col("cosine"), F.col("path"))).alias("grant"))
    folders = scanned.where("folder is not null").select("folder").distinct()
    parts = F.filter(F.split("folder", "/"), lambda p: p != "")
    rooted = F.when(F.col("folder").startswith("/"), "/").otherwise("")
    ancestors = folders.select("folder", F.explode(F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(n.alias("depth"), F.when(n == F.size(parts), F.col("folder")).otherwise(
            F.concat(F.when(n > 0, rooted).otherwise(""), F.array_join(F.slice(parts, 1, n), "/"))
        ).alias("above")))).alias("a")).select("folder", "a.*")
    nearest = ancestors.join(granted.hint("merge"), "above").groupBy("folder").agg(
        F.max_by("grant", "depth").alias("grant"))
    both = scanned.join(nearest.hint("merge"), "folder", "left")
    return both.select(
        "file_id", "path", F.coalesce("own", "grant.own").alias("license"), "cosine",
        F.when(F.col("own").isNull(), F.col("grant.path")).alias("inherited_from"))


def files_of(docs: DataFrame) -> DataFrame:
    """Documents as files: a source is a tree, ids are dealt over two levels of directories, and
    every tenth file is its directory's licence file."""
    number = F.col("doc_id").cast("long")
    name = F.when(number % 10 == 0, F.concat(F.lit("LICENSE-"), number)).otherwise(
        F.concat(number.cast("string"), F.lit(".txt")))
    return docs.select(
        number.alias("file_id"),
        F.concat_ws("/", "source", (number / 1000).cast("long"), (number / 100).cast("long"), name)
        .alias("path"), "text")


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(files_of(table(spark, sf_dir, "documents")))
    return found.withColumnRenamed("file_id", "doc_id")
