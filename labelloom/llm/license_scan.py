"""Licences of files by TF-IDF cosine to templates, inherited down the directories.

Statements of a file are its lines and its paragraphs. Each is compared with the
templates as a sparse TF-IDF vector. Words that no template has can't add to a
cosine but make a statement longer; they weigh as much as a word that no file
has. Most lines share too little with any template to reach the threshold: the
statements that are taken apart have a word without which no template reaches
it, which is proved from the templates' weights.

A file's own licence is its best statement's. A file named like a licence file
licenses its directory; where there is none, one that is nine tenths a licence
statement does. Files without a licence of their own take that of the nearest
ancestor directory that has one, by a join on the ancestors of each distinct
directory.

Defined results for odd input: a null or empty text has no statement and may
inherit; a null path is the root directory's; equal cosines go by the template's
name, licence files of one directory by name, cosine, then path; rows that repeat a
path are judged one by one; an empty table gives an empty result. Columns
other than path and text are carried along; those named like a result's are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.shared import attach
from labelloom.operators.pin import settle

#: Opening or notice of common licences, as their authors ask to put them in files.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["To the extent possible under law, the author has dedicated all copyright to the public domain under CC0 1.0"],
}

#: Names of files that license their directory.
LICENSE_FILE = r"(?i)^(licen[sc]e|copying|unlicense)(\..*)?$"

#: A statement has a template's licence from this cosine on.
THRESHOLD = 0.75

RESULT = ("license", "cosine", "origin", "license_dir")

#: A word: letters, or digits with points in them.
WORD = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"


def template_words(templates: Mapping[str, list[str]]) -> dict[tuple[str, int], dict[str, int]]:
    """Word counts by licence and number of its template."""
    found = {}
    for name, texts in templates.items():
        for number, text in enumerate(texts):
            words = re.findall(WORD, text.lower())
            found[name, number] = {word: words.count(word) for word in sorted(set(words))}
    return found


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"))


def document_frequencies(files: DataFrame, text: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """The number of files and, for each word of the templates, the number that have it. One row per word comes back."""
    having = F.array_intersect(words_of(F.col(text)), F.array(*map(F.lit, vocabulary)))
    words = files.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(having, F.array()))).alias("word"))
    counted = {row.word: row.n for row in words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return counted.get("", 0), {word: counted.get(word, 0) for word in vocabulary}


def telling_words(vectors: Mapping[tuple, Mapping[str, float]], threshold: float) -> list[str]:
    """Words of which a statement has at least one if its cosine to any template reaches the threshold.

    Of each template the lightest words are left out as long as they alone
    couldn't reach it: a statement with only those has at most their share of
    the template's length as its cosine.
    """
    needed = set()
    for vector in vectors.values():
        limit = threshold**2 * sum(w * w for w in vector.values())
        rest = 0.0
        for word, weight in sorted(vector.items(), key=lambda x: (x[1], x[0])):
            rest += weight * weight
            if rest >= limit * (1 - 1e-9):
                needed.add(word)
    return sorted(needed)


def telling_statements(text: Column, telling: list[str]) -> Column:
    """The lines and paragraphs of a text that have one of the words ``telling``, each once."""
    pattern = r"(?<![a-z])(" + "|".join(re.escape(word) for word in telling) + r")(?![a-z])"
    paragraphs = F.split(text, r"\n[\x20\x09\r]*\n")
    both = F.array_distinct(F.concat(F.split(text, r"\n"), paragraphs))
    found = F.filter(both, lambda s: F.lower(s).rlike(pattern))
    return F.when(F.lower(text).rlike(pattern), found).otherwise(F.array().cast("array<string>"))


def best_templates(texts: DataFrame, vectors: Mapping[tuple, Mapping[str, float]], idf: Mapping[str, float], unknown: float, threshold: float) -> DataFrame:
    """``key, license, cosine`` for the rows ``key, statement`` of ``texts`` that reach the threshold.

    What is broadcast are the templates, whose number and length the caller sets.
    """
    spark = texts.sparkSession
    weights = F.broadcast(spark.createDataFrame(list(idf.items()), "word string, idf double"))
    of_templates = []
    for (name, number), vector in vectors.items():
        length = math.sqrt(sum(w * w for w in vector.values()))
        of_templates += [(name, number, word, w / length) for word, w in vector.items()]
    templates = F.broadcast(spark.createDataFrame(of_templates, "license string, template int, word string, share double"))
    words = texts.select("key", F.explode(words_of(F.col("statement"))).alias("word"))
    counted = words.groupBy("key", "word").agg(F.count(F.lit(1)).alias("tf")).join(weights, "word", "left")
    counted = counted.select("key", "word", (F.col("tf") * F.coalesce("idf", F.lit(unknown))).alias("weight"))
    lengths = counted.groupBy("key").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    dots = counted.join(templates, "word").groupBy("key", "license", "template").agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    cosine = F.round(F.col("dot") / F.col("length"), 6)
    scored = dots.join(lengths, "key").select("key", "license", cosine.alias("cosine")).where(F.col("cosine") >= threshold)
    best = scored.groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("less"), "license")).alias("best"))
    return best.select("key", F.col("best.license").alias("license"), (-F.col("best.less")).alias("cosine"))


def own_licenses(files: DataFrame, path_col: str, text_col: str, templates: Mapping[str, list[str]], threshold: float) -> DataFrame:
    """``row, file, path, dir, license, cosine, is_named, is_license_file``, one row per row of ``files``; ``file`` has its columns but the text.

    A statement that many files share is compared once.
    """
    counts = template_words(templates)
    vocabulary = sorted({word for words in counts.values() for word in words})
    n, having = document_frequencies(files, text_col, vocabulary)
    idf = {word: math.log((n + 1) / (having[word] + 1)) + 1 for word in vocabulary}
    vectors = {key: {word: tf * idf[word] for word, tf in words.items()} for key, words in counts.items()}
    path = F.coalesce(F.col(path_col), F.lit(""))
    found = telling_statements(F.coalesce(F.col(text_col), F.lit("")), telling_words(vectors, threshold))
    # The row numbers are fixed by being written.
    scanned = settle(
        files.select(
            F.monotonically_increasing_id().alias("row"),
            F.struct(*[c for c in files.columns if c not in (text_col, *RESULT)]).alias("file"),
            path.alias("path"),
            F.regexp_replace(F.regexp_replace(path, r"/+", "/"), r"/?[^/]*$", "").alias("dir"),
            F.size(words_of(F.col(text_col))).alias("n_words"),
            found.alias("statements"),
        )
    )
    lines = settle(scanned.select("row", "n_words", F.explode("statements").alias("statement")).withColumn("key", F.md5("statement")))
    texts = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.any_value("statement").alias("statement"))
    texts = settle(texts)
    best = best_templates(texts, vectors, idf, math.log(n + 1) + 1, threshold)
    verdicts = settle(texts.select("key", "n").join(best, "key"))
    judged = attach(lines, verdicts, "key", "n", lines.count()).where("license is not null")
    length = F.size(words_of(F.col("statement")))
    by_row = judged.groupBy("row").agg(
        F.min(F.struct((-F.col("cosine")).alias("less"), "license")).alias("best"), F.max(10 * length >= 9 * F.col("n_words")).alias("is_statement")
    )
    named = F.regexp_extract("path", r"[^/]*$", 0).rlike(LICENSE_FILE)
    return scanned.join(by_row, "row", "left").select(
        "row", "file", "path", "dir", F.col("best.license").alias("license"), (-F.col("best.less")).alias("cosine"),
        named.alias("is_named"), (named | F.coalesce("is_statement", F.lit(False))).alias("is_license_file"),
    )


def inherited_licenses(own: DataFrame) -> DataFrame:
    """``dir, n, inherited, license_dir``: by distinct directory of ``own``, its files and the nearest licence at or above it."""
    dirs = settle(own.groupBy("dir").agg(F.count(F.lit(1)).alias("n")))
    first = F.min(F.struct((~F.col("is_named")).alias("unnamed"), (-F.col("cosine")).alias("less"), "path", "license")).alias("first")
    licensed = own.where("is_license_file and license is not null").groupBy("dir").agg(first)
    licensed = licensed.select(F.col("dir").alias("ancestor"), F.col("first.license").alias("inherited"))
    # Cut off behind k names; the root, of paths with or without a slash in front, has none.
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(F.split("dir", "/")))
    levels = dirs.select("dir", F.explode(F.sequence(F.lit(0), depth)).alias("depth"))
    ancestors = settle(levels.select("dir", "depth", F.expr("substring_index(dir, '/', depth)").alias("ancestor")))
    sizes = ancestors.groupBy("ancestor").agg(F.count(F.lit(1)).alias("n_below"))
    table = settle(licensed.join(sizes, "ancestor"))
    found = attach(ancestors, table, "ancestor", "n_below", ancestors.count()).where("inherited is not null")
    nearest = found.groupBy("dir").agg(F.max(F.struct("depth", "inherited", "ancestor")).alias("nearest"))
    return dirs.join(nearest, "dir").select(
        "dir", "n", F.col("nearest.inherited").alias("inherited"), F.col("nearest.ancestor").alias("license_dir")
    )


def licenses(
    files: DataFrame, path_col: str, text_col: str, templates: Mapping[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``files``: its columns but the text, and ``license, cosine, origin, license_dir``.

    ``origin`` is ``own`` or ``inherited``, ``license_dir`` the directory that an
    inherited licence comes from. Whole texts are read twice and never shuffled;
    a large directory's files look their licence up without being gathered.
    """
    own = settle(own_licenses(files, path_col, text_col, templates, threshold))
    found = attach(own, settle(inherited_licenses(own)), "dir", "n", own.count())
    has_own, has_any = F.col("license").isNotNull(), F.col("inherited").isNotNull()
    return found.select(
        "file.*",
        F.coalesce("license", "inherited").alias("license"),
        "cosine",
        F.when(has_own, "own").when(has_any, "inherited").alias("origin"),
        F.when(~has_own, F.col("license_dir")).alias("license_dir"),
    )
