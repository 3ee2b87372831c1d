"""Licence scan: sparse TF-IDF cosine of notices and licence files to templates, then inheritance along directories.

Units of a file are its lines, its whole text where that is no longer than twice the longest template, and windows: runs of as
many terms as a template has, over line ends, laid so that three terms in a row, an anchor of the template among them, stand
where the template has them. So a notice is found wrapped at any width, in a text of any length and amid a long line. A unit is scored against a template by
the cosine of their TF-IDF vectors; the document frequencies of template terms are counted over all files, and a term of no
template weighs like one never seen. Only units with an anchor are scored. The anchors of a template are its heaviest terms,
so many that the others alone stay below the wanted cosine, by the Cauchy-Schwarz inequality; no unit that could match is
left out. Long licences are known by their notices and by the paragraphs that set them apart, a template each: a common term
that comes often in one long template would be an anchor.

A file without a licence of its own takes that of the nearest directory above it that holds one, by a join of the
directories above each file with those that hold licences.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import stored

#: Cosine from which a unit states the licence of the template.
COSINE = 0.75
#: Terms in a row that lay a window.
SEED = 3

# Notices of public licences by SPDX identifier; one licence may have several.
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3.",),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
BREAKS = r"[^a-z0-9.+\-]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: str) -> list[str]:
    """Lower-case runs of letters, digits, dots, plus and minus signs, without dots and minus signs at the ends."""
    lowered = text.translate(str.maketrans(UPPER, LOWER))
    return [t for t in (w.strip(".-") for w in re.split(BREAKS, lowered)) if t]


def term_column(text: Column) -> Column:
    cut = F.transform(F.split(F.translate(text, UPPER, LOWER), BREAKS), lambda w: F.btrim(w, F.lit(".-")))
    return F.filter(cut, lambda w: w != "")


def _templates(templates: Mapping[str, tuple[str, ...]]) -> list[tuple[str, Counter]]:
    return [(licence, Counter(terms(text))) for licence, texts in templates.items() for text in texts]


def inverse_frequency(files: int, seen: int) -> float:
    return math.log((1 + files) / (1 + seen)) + 1


def _weights(files: DataFrame, counted: list[tuple[str, Counter]]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of each template term over all files, and that of a term never seen."""
    vocabulary = sorted({t for _, c in counted for t in c})
    in_file = F.array_intersect(term_column(F.col("text")), F.array(*map(F.lit, vocabulary)))
    seen = {
        r["term"]: r["files"]
        for r in files.select(F.explode(in_file).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("files")).collect()
    }
    total = files.count()
    return {t: inverse_frequency(total, seen.get(t, 0)) for t in vocabulary}, inverse_frequency(total, 0)


def anchors(weights: Mapping[str, float], counted: list[tuple[str, Counter]], cosine: float) -> list[str]:
    """Terms of which a unit must hold one to reach ``cosine`` with any template."""
    found = set()
    for _, counts in counted:
        squares = sorted(((n * weights[t]) ** 2, t) for t, n in counts.items())
        whole, rest = sum(x for x, _ in squares), 0.0
        for square, term in squares:
            rest += square
            if rest >= cosine * cosine * whole * (1 - 1e-9):
                found.add(term)
    return sorted(found)


def seeds(templates: Mapping[str, tuple[str, ...]], weights: Mapping[str, float], cosine: float) -> list[tuple]:
    """The runs of ``SEED`` terms of a template that hold an anchor of it, each with its offset and the template's length."""
    found = set()
    for text in (text for texts in templates.values() for text in texts):
        known = terms(text)
        heavy = set(anchors(weights, [("", Counter(known))], cosine))
        for at in range(len(known) - SEED + 1):
            if heavy.intersection(known[at:at + SEED]):
                found.add((*known[at:at + SEED], at, len(known)))
    return sorted(found)


def _windows(noted: DataFrame, laid: list[tuple], longest: int) -> DataFrame:
    """``file, unit, terms`` of the windows of files (``file, lines``); units below -1."""
    names = [f"term{k}" for k in range(SEED)]
    places = noted.sparkSession.createDataFrame(laid, ", ".join(f"{n} string" for n in names) + ", offset int, length int")
    whole = noted.select("file", F.flatten("lines").alias("whole"))
    shifted = [F.slice("whole", k + 1, F.size("whole")).alias(n) for k, n in enumerate(names)]
    starts = (
        whole.select("file", F.posexplode(F.arrays_zip(*shifted)).alias("at", "run"))
        .select("file", "at", "run.*").join(F.broadcast(places), names)
        .select("file", "length", F.greatest(F.col("at") - F.col("offset"), F.lit(0)).alias("start")).distinct()
    )
    return whole.join(stored(starts, "starts"), "file").select(
        "file", (-2 - F.col("start").cast("bigint") * (longest + 1) - F.col("length")).alias("unit"),
        F.slice("whole", F.col("start") + 1, F.col("length")).alias("terms"))


def own_licences(files: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """Best match of each file that has one: ``path, licence, score``; of equal scores the first licence by name."""
    counted = _templates(templates)
    weights, unseen = _weights(files, counted)
    longest = max(sum(c.values()) for _, c in counted)
    rows = []
    for number, (licence, counts) in enumerate(counted):
        norm = math.sqrt(sum((n * weights[t]) ** 2 for t, n in counts.items()))
        rows += [(t, number, licence, n * weights[t] ** 2 / norm) for t, n in sorted(counts.items())]
    spark = files.sparkSession
    template_terms = spark.createDataFrame(rows, "term string, template int, licence string, part double")
    term_weights = spark.createDataFrame(sorted(weights.items()), "term string, weight double")

    anchor = F.array(*map(F.lit, anchors(weights, counted, cosine)))
    lines = F.transform(F.split("text", "\n"), term_column)
    noted = stored(
        files.select("path", lines.alias("lines")).filter(F.exists("lines", lambda t: F.arrays_overlap(t, anchor)))
        .withColumn("file", F.monotonically_increasing_id()), "noted")
    whole = F.flatten("lines")
    alone = noted.select("file", F.posexplode("lines").alias("unit", "terms")).withColumn("unit", F.col("unit").cast("bigint"))
    short = noted.filter(F.size(whole) <= 2 * longest).select("file", F.lit(-1).cast("bigint").alias("unit"), whole.alias("terms"))
    units = alone.unionByName(short).unionByName(_windows(noted, seeds(templates, weights, cosine), longest))
    scored = (
        units.filter(F.arrays_overlap("terms", anchor)).select("file", "unit", F.explode("terms").alias("term"))
        .groupBy("file", "unit", "term").agg(F.count(F.lit(1)).alias("times"))
        .join(F.broadcast(term_weights), "term", "left")
        .withColumn("weight", F.coalesce("weight", F.lit(unseen)))
    )
    scored = stored(scored, "units")
    norms = scored.groupBy("file", "unit").agg(F.sqrt(F.sum(F.pow(F.col("times") * F.col("weight"), 2))).alias("norm"))
    dots = (
        scored.join(F.broadcast(template_terms), "term").groupBy("file", "unit", "template", "licence")
        .agg(F.sum(F.col("times") * F.col("part")).alias("dot"))
    )
    return (
        dots.join(norms, ["file", "unit"])
        .withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).filter(F.col("score") >= cosine)
        .join(noted.select("file", "path"), "file")
        .groupBy("path").agg(F.min_by(F.struct("licence", "score"), F.struct(-F.col("score"), F.col("licence"))).alias("best"))
        .select("path", "best.licence", "best.score")
    )


def directory(path: Column) -> Column:
    """The path up to its last slash, empty at the top."""
    return F.regexp_replace(path, r"/?[^/]*\z", "")


def scan(files: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """Per row of ``files`` (``path, text``; other columns are kept in front of the result) ``licence, score,
    stated_by, levels_up``.

    ``stated_by`` is the file that states the licence: the file itself at 0 levels up, or the best match of the nearest
    directory above that holds one, its own directory being 1 level up; of several in a directory the highest score, then
    the smallest path. Files without either have nulls. A null text is empty; a null path states and inherits nothing.
    Rows that share a path are one file with the units of each. An empty table gives no rows.
    """
    known = files.select(F.col("path").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = stored(own_licences(known.filter("path is not null"), templates, cosine), "own")
    holders = stored(
        own.groupBy(directory(F.col("path")).alias("above"))
        .agg(F.min_by(F.struct("licence", "score", "path"), F.struct(-F.col("score"), F.col("path"))).alias("held")),
        "holders")

    def above(path: Column) -> Column:
        """Directories above a path, nearest first."""
        parts = F.split(path, "/")
        depth = F.size(parts) - 1
        return F.transform(
            F.sequence(F.lit(0), depth), lambda up: F.array_join(F.slice(parts, 1, depth - up), "/"))

    paths = files.select(F.col("path").cast("string").alias("path")).filter("path is not null").distinct()
    inherited = (
        paths.select("path", F.posexplode(above(F.col("path"))).alias("up", "above")).join(holders, "above")
        .groupBy("path").agg(F.min_by(F.struct("held.*", "up"), "up").alias("near"))
    )
    best = stored(
        inherited.join(own.select("path", F.struct("licence", "score").alias("own")), "path", "full").select(
            F.col("path").alias("__path"),
            F.coalesce("own.licence", "near.licence").alias("__licence"),
            F.coalesce("own.score", "near.score").alias("__score"),
            F.when(F.col("own").isNotNull(), F.col("path")).otherwise(F.col("near.path")).alias("__stated_by"),
            F.when(F.col("own").isNotNull(), 0).otherwise(F.col("near.up") + 1).cast("int").alias("__levels_up")),
        "best")
    kept = [c for c in files.columns if c not in ("text", "licence", "score", "stated_by", "levels_up")]
    return files.join(best, files["path"].cast("string") == best["__path"], "left").select(
        *[files[c] for c in kept], F.col("__licence").alias("licence"), F.col("__score").alias("score"),
        F.col("__stated_by").alias("stated_by"), F.col("__levels_up").alias("levels_up"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: ``source/language/`` and the id in groups of three digits, three groups at least, the last of which
    names the file. Every id has a path of its own."""
    digits = F.col("doc_id").cast("string")
    width = F.greatest(F.lit(9), F.ceil(F.char_length(digits) / 3) * 3).cast("int")
    number = F.regexp_replace(F.lpad(digits, width, F.lit("0")), "(.{3})(?=.)", "$1/")
    path = F.concat_ws(
        "/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.concat(number, F.lit(".txt")))
    return docs.select("doc_id", F.when(F.col("doc_id").isNotNull(), path).alias("path"), "text")
