"""License scans: sparse TF-IDF cosine to templates, then inheritance from directories.

A whole text becomes its terms, so comment marks and line breaks do not matter. At each term that
names a licence (an anchor) the text is aligned with every template that has this anchor, and the
window of the template's length there is compared with it by the cosine of sparse TF-IDF vectors;
windows and templates meet by joins on terms. A window above a threshold is a passage under the
template's licence. Document frequencies of the templates' terms cover the surroundings of all
anchors in all distinct texts; any other term weighs like one that a single text has. A tag
``SPDX-License-Identifier:`` names its licence at once. Equal texts are compared once, however often
they occur.

A file whose passages cover enough of its words, or whose name says so, is a licence file and
speaks for its directory; any other passage is a header and speaks for its own file. A file
without a licence of its own takes that of its nearest ancestor directory that has one: distinct
directories are joined with licensed ones by all their ancestor paths.

All of it is DataFrame operations; there is no Python on the executors. Whole texts are read once.

Cases: a null or empty text has no passage; a null path is the root directory's file without a
name; of several passages the highest cosine counts, ties go to the first licence by name; of
several licence files in a directory, the one that is surest, then the first by path; repeated
rows (id and path) each get a row and share what their texts say; very long texts are read whole and
only the surroundings of anchors are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

THRESHOLD = 0.55
#: Share of a file's words in licence passages from which the file is a licence file.
FILE_SHARE = 0.2
#: Directories with a licence above or in them that are broadcast.
BROADCAST_DIRECTORIES = 100_000
FILE_NAME = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"
SPDX = r"(?i)SPDX-License-Identifier:\s*([A-Za-z0-9.+-]+)"
TERM = r"[\p{L}\p{N}]+(?:\.[\p{N}]+)*"

# Terms at which texts and templates are aligned, and short notices of common licences.
ANCHORS = ["license", "licensed", "licenses", "copyright", "permission", "redistribution", "redistribute", "domain", "commons", "rights"]
SPEAKS = r"(?i)licen[cs]e|copyright|permission|redistribut|domain|commons|rights"
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "Released under the MIT License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "either version 3 of the License, or (at your option) any later version"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated this work to the public domain. CC0 1.0 Universal."),
    ("Proprietary", "Copyright. All rights reserved."),
]


def template_terms() -> list[list[str]]:
    """The terms of each template, in the spelling that texts are brought to."""
    return [[w.replace("licence", "license") for w in re.findall(r"[^\W_]+(?:\.[0-9]+)*", t.lower())] for _, t in TEMPLATES]


#: The longest template, and so the surroundings of an anchor that are kept on either side.
REACH = max(map(len, template_terms()))


def terms(text: str) -> F.Column:
    """Lower-cased words and numbers, with points within them, in one spelling."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(F.col(text)), "licence", "license"), F.lit(f"({TERM})"), F.lit(0))


def surroundings(texts: DataFrame) -> DataFrame:
    """(key, at, anchor, lead, around): each anchor of texts (key, terms) with up to ``REACH`` terms
    on either side, of which ``lead`` are before it."""
    known = F.array(*map(F.lit, ANCHORS))
    found = F.transform("terms", lambda w, i: F.when(F.array_contains(known, w), F.struct(
        i.alias("at"), w.alias("anchor"), F.least(i, F.lit(REACH)).alias("lead"),
        F.slice("terms", F.greatest(i - REACH, F.lit(0)) + 1, F.least(i, F.lit(REACH)) + REACH + 1).alias("around"),
    )))
    return texts.select("key", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x")).select("key", "x.*")


def windows(around: DataFrame) -> DataFrame:
    """(key, template, start, words): the windows that alignments of anchors give, each once."""
    rows = []
    for t, words in enumerate(template_terms()):
        rows += [(w, t, words.index(w), len(words)) for w in sorted(set(words) & set(ANCHORS))]
    aligned = F.broadcast(shared.literal_rows(around.sparkSession, rows, "anchor string, template int, ahead int, length int"))
    cut = around.join(aligned, "anchor").withColumn("first", F.greatest(F.col("lead") - F.col("ahead"), F.lit(0)))
    until = F.col("lead") - F.col("ahead") + F.col("length")
    cut = cut.select("key", "template", (F.col("at") - F.col("ahead")).alias("start"), F.slice("around", F.col("first") + 1, until - F.col("first")).alias("words"))
    return cut.groupBy("key", "template", "start").agg(F.first("words").alias("words"))


def matched(texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, license, cosine, start, past): the passages of distinct texts (key, terms)."""
    spark: SparkSession = texts.sparkSession
    around = shared.stored(surroundings(texts), "surroundings")
    fixed = [(t, w, words.count(w)) for t, words in enumerate(template_terms()) for w in sorted(set(words))]
    fixed = shared.literal_rows(spark, fixed, "template int, term string, n int")
    n = around.select("key").distinct().count() + len(TEMPLATES)
    # The templates' terms are a fixed few hundred; only their frequencies are needed.
    vocabulary = F.broadcast(fixed.select("term").distinct())
    uses = around.select("key", F.explode("around").alias("term")).join(vocabulary, "term").distinct()
    counts = uses.groupBy("term").count().union(fixed.groupBy("term").count()).groupBy("term").agg(F.sum("count").alias("n"))
    idf = shared.stored(counts.select("term", (F.log((1 + F.lit(float(n))) / (1 + F.col("n"))) + 1).alias("idf")), "frequencies")
    rare = F.log((1 + F.lit(float(n))) / 2) + 1
    y = ((1 + F.log("n")) * F.col("idf")).alias("y")
    weights = fixed.join(F.broadcast(idf), "term").select("template", "term", y)
    sizes = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("y_norm"))
    names = shared.literal_rows(spark, [(t, name, len(w)) for t, ((name, _), w) in enumerate(zip(TEMPLATES, template_terms(), strict=True))], "template int, license string, length int")
    cut = windows(around)
    own = cut.select("key", "template", "start", "words", F.explode(F.array_distinct("words")).alias("term"))
    tf = 1 + F.log(F.size(F.filter("words", lambda w: w == F.col("term"))))
    own = own.select("key", "template", "start", "term", tf.alias("tf")).join(F.broadcast(idf), "term", "left")
    own = own.withColumn("x", F.col("tf") * F.coalesce("idf", rare)).join(F.broadcast(weights), ["template", "term"], "left")
    both = own.groupBy("key", "template", "start").agg(F.sum(F.col("x") * F.col("y")).alias("dot"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("x_norm"))
    both = both.filter("dot is not null").join(F.broadcast(sizes), "template").join(F.broadcast(names), "template")
    cosine = F.round(F.col("dot") / (F.col("x_norm") * F.col("y_norm")), 9)
    near = both.select("key", "license", cosine.alias("cosine"), "start", (F.col("start") + F.col("length")).alias("past"))
    return near.filter(F.col("cosine") >= threshold)


def covered(passages: str) -> F.Column:
    """How many terms the passages (start, past) cover, each once."""
    zero = F.struct(F.lit(0).cast("long").alias("until"), F.lit(0).cast("long").alias("n"))

    def step(done, p):
        first = F.greatest(done["until"], p["start"].cast("long"))
        return F.struct(F.greatest(done["until"], p["past"].cast("long")).alias("until"), (done["n"] + F.greatest(F.lit(0).cast("long"), p["past"] - first)).alias("n"))

    return F.aggregate(F.array_sort(passages), zero, step)["n"]


def named(tag: F.Column) -> F.Column:
    """The licence that an SPDX identifier names: without -only and -or-later, as in the templates."""
    plain = F.regexp_replace(tag, r"(?i)(-only|-or-later|\+|\.)$", "")
    out = plain
    for name in sorted({n for n, _ in TEMPLATES}):
        out = F.when(F.lower(plain) == name.lower(), name).otherwise(out)
    return out


def directory(path: str) -> F.Column:
    return F.regexp_extract(F.col(path), r"^(?s:(.*))/[^/]*$", 1)


def ancestors(directory: str) -> F.Column:
    """(path, depth) of a directory and all above it; the root is '' at depth 0."""
    parts = F.filter(F.split(F.col(directory), "/"), lambda x: x != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(F.array_join(F.slice(parts, F.lit(1), i), "/").alias("ancestor"), i.alias("depth")))


def licensed_files(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(file, own, own_cosine, said, words) of the files (file, text) with a licence of their own."""
    speaks = files.filter(F.col("text").rlike(SPEAKS))
    tags = F.transform(F.regexp_extract_all("text", F.lit(SPDX), F.lit(1)), named)
    spoken = shared.stored(speaks.select("file", F.sha2("text", 256).alias("key"), terms("text").alias("terms"), tags.alias("tags")), "spoken")
    texts = spoken.groupBy("key").agg(F.first("terms").alias("terms"), F.first("tags").alias("tags"))
    texts = shared.stored(texts, "spoken_texts")
    tagged = texts.select("key", F.explode("tags").alias("license"), F.lit(1.0).alias("cosine"), F.lit(0).alias("start"), F.lit(0).alias("past"))
    found = matched(texts.select("key", "terms"), threshold).unionByName(tagged).groupBy("key")
    # An SPDX tag goes before any passage.
    best = F.min(F.struct((F.col("past") > 0).alias("untagged"), (-F.col("cosine")).alias("c"), "license")).alias("b")
    found = found.agg(best, F.collect_list(F.struct("start", "past")).alias("passages"))
    found = found.select("key", "b", covered("passages").alias("said"))
    found = found.join(texts.select("key", F.size("terms").alias("words")), "key")
    by_file = spoken.select("file", "key").join(found, "key").groupBy("file")
    by_file = by_file.agg(F.min("b").alias("b"), F.sum("said").alias("said"), F.sum("words").alias("words"))
    out = shared.stored(by_file.select("file", F.col("b.license").alias("own"), (-F.col("b.c")).alias("own_cosine"), "said", "words"), "licensed_files")
    for done in (spoken, texts):
        shared.discard(done)
    return out


def scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row a file: doc_id, path, license, cosine, how (own, directory or none), directory (whose
    licence file decided)."""
    rows = files.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    per_file = licensed_files(rows.select(F.struct("doc_id", "path").alias("file"), "text"), threshold)
    clean = F.array_join(F.filter(F.split(directory("path"), "/"), lambda x: x != ""), "/")
    speaks = F.regexp_extract(F.col("path"), r"([^/]*)$", 1).rlike(FILE_NAME) | (F.col("said") >= FILE_SHARE * F.col("words"))
    licensed = per_file.select(F.col("file.path").alias("path"), "own", "own_cosine", "said", "words").filter(speaks)
    licensed = licensed.withColumn("ancestor", clean).groupBy("ancestor")
    licensed = licensed.agg(F.min(F.struct((-F.col("own_cosine")).alias("c"), "path", F.col("own").alias("license"))).alias("b"))
    licensed = licensed.select("ancestor", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))
    narrow = rows.select("doc_id", "path", clean.alias("directory"))
    up = narrow.select("directory").distinct().select("directory", F.explode(ancestors("directory")).alias("a")).select("directory", "a.*")
    nearest = up.join(licensed, "ancestor").groupBy("directory").agg(F.max(F.struct("depth", "ancestor", "license", "cosine")).alias("n"))
    # A hot directory's files need not meet in a task: what directories say is sent to the files
    # where it is small, and beyond that Spark splits skewed directories above the stored table.
    nearest = shared.stored(nearest, "nearest")
    if nearest.limit(BROADCAST_DIRECTORIES + 1).count() <= BROADCAST_DIRECTORIES:
        nearest = F.broadcast(nearest)
    own = per_file.select("file.doc_id", "file.path", "own", "own_cosine")
    out = narrow.join(own, [narrow["doc_id"].eqNullSafe(own["doc_id"]), narrow["path"] == own["path"]], "left")
    out = out.select(narrow["doc_id"], narrow["path"], "directory", "own", "own_cosine").join(nearest, "directory", "left")
    by_own, by_dir = F.col("own").isNotNull(), F.col("n").isNotNull()
    return out.select(
        "doc_id", "path", F.coalesce("own", "n.license").alias("license"), F.coalesce("own_cosine", "n.cosine").alias("cosine"),
        F.when(by_own, "own").when(by_dir, "directory").otherwise("none").alias("how"),
        F.when(~by_own & by_dir, F.col("n.ancestor")).alias("directory"),
    )
