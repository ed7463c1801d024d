"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest folder above.

Only DataFrame functions: terms, weights and joins stay in the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.session import cut

#: Notices by SPDX identifier, in the wording their licences give.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0)."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Lines with one of these are notices, the only lines compared; every template has one.
ANCHORS = ["licen[cs]e", "copyright", "permission", "permitted", "public domain"]
_GNU_FREE = (
    "{this} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation, {version}, or (at your option) any later version."
)
_GNU_ONLY = "{this} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} {version} as published by the Free Software Foundation."
_GNU = [
    ("GPL-2.0", "General Public License", "2", "June 1991"), ("GPL-3.0", "General Public License", "3", "29 June 2007"),
    ("LGPL-2.1", "Lesser General Public License", "2.1", "February 1999"), ("LGPL-3.0", "Lesser General Public License", "3", "29 June 2007"),
    ("AGPL-3.0", "Affero General Public License", "3", "19 November 2007"),
]
#: What blocks of several lines are compared with besides: usual file headers, and the titles of licence texts.
BLOCKS = [
    *[(spdx, form.format(this="This program", name=name, version=f"either version {v} of the License" if form is _GNU_FREE else f"version {v}"))
      for spdx, name, v, _ in _GNU for form in (_GNU_FREE, _GNU_ONLY)],
    *[(spdx, f"GNU {name} Version {v}, {date}") for spdx, name, v, date in _GNU],
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
]
#: SPDX identifiers that a tag can name; endings such as -only and -or-later are left off.
TAG = r"(?i)SPDX-License-Identifier:\s*\(?\s*([A-Za-z0-9.-]+?)(?:-only|-or-later|\+)?(?=[\s)*/>]|$)"
#: Comment marks around a line.
MARKS = r"^[\s#*/;%!<>-]+|[\s#*/>-]+$|^(?i:rem|dnl)\s"
#: Names of files whose licence holds for their folder and those below, in any case.
LICENSE_FILES = ["LICENSE", "LICENCE", "COPYING"]
LEAST = 0.7


def templates(spark: SparkSession, rows=None) -> DataFrame:
    """(template, license, text), a few rows."""
    numbered = [(i, *t) for i, t in enumerate(rows or TEMPLATES)]
    return spark.createDataFrame(numbered, "template int, license string, text string")


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits, repeats included."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def leading_terms(text: Column, n: int) -> Column:
    """The first n terms; what comes after them stays one piece, however long."""
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}]+", n + 2)  # one may be empty at the start
    return F.slice(F.filter(F.slice(parts, F.lit(1), F.lit(n + 1)), lambda w: w != ""), F.lit(1), F.lit(n))


def notices(files: DataFrame) -> DataFrame:
    """(path, line, words): every line of every file with an anchor word, each line apart."""
    anchor = "(?i)" + "|".join(ANCHORS)
    # files without an anchor leave before their text is split
    listed = files.filter(F.col("text").rlike(anchor)).select("path", F.posexplode_outer(F.split("text", "\n")).alias("line", "body"))
    return listed.filter(F.col("body").rlike(anchor)).select("path", "line", terms(F.col("body")).alias("words"))


def tagged(files: DataFrame, given: DataFrame) -> DataFrame:
    """(path, b) of files with an SPDX tag of a known licence; the first such tag of the file counts."""
    tags = files.filter(F.col("text").rlike("(?i)SPDX-License-Identifier:")).select("path", F.posexplode(F.split("text", "\n")).alias("line", "body"))
    named = tags.withColumn("id", F.lower(F.regexp_extract("body", TAG, 1)))
    known = given.groupBy(F.lower("license").alias("id")).agg(F.min("template").alias("template"), F.min("license").alias("license"))
    one = named.join(F.broadcast(known), "id").groupBy("path").agg(F.min_by(F.struct("template", "license"), "line").alias("k"))
    return one.select("path", F.struct(F.lit(1.0).alias("score"), (-F.col("k.template")).alias("t"), F.col("k.license").alias("license")).alias("b"))


def block_notices(files: DataFrame, sizes: list[int]) -> DataFrame:
    """(path, words): runs of words in blocks of several non-empty lines, comment marks taken off.

    A block is its whole text if short, and from the start of each of its lines on as many words as each
    template has, so that a notice counts wherever it stands in a long block. A row holds a block, or two
    stretches of its lines: windows of a long block are made stretch by stretch, around its anchors.
    """
    anchor = "(?i)" + "|".join(ANCHORS)
    bare = F.transform(F.split("text", "\r?\n"), lambda x: F.regexp_replace(x, MARKS, ""))
    # lines of marks only end a block as empty ones do
    blocks = F.split(F.array_join(bare, "\n"), "\n{2,}")
    listed = files.filter(F.col("text").rlike(anchor)).select("path", F.explode(blocks).alias("block"))
    held = cut(listed.filter(F.col("block").rlike(anchor) & F.col("block").contains("\n")).withColumn("h", F.xxhash64("block")))
    some = held.select("h", "block").dropDuplicates(["h"])
    longest = max(sizes)
    # by the first words of the anchors, as an anchor may go over a line's end
    seeds = "|".join(a.split(" ")[0] for a in ANCHORS)
    worded = F.filter(F.split("block", "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    # a line needs no more lines behind it than the longest template has words, so lines go to stretches of that many:
    # a line of a stretch is followed by the rest of it and by the next one. Only stretches before an anchor are gathered.
    lines = some.select("h", F.posexplode(worded).alias("i", "line")).withColumn("at", F.floor(F.col("i") / longest).cast("int"))
    both = F.explode(F.array(F.col("at") - 1, F.col("at"))).alias("s")
    asked = lines.filter(F.lower("line").rlike(seeds)).select("h", both).filter("s >= 0").distinct()
    near = lines.select("h", "i", "at", "line", both).join(asked, ["h", "s"])
    kept = near.select("h", "s", F.struct("i", "at", leading_terms(F.col("line"), longest).alias("w")).alias("row"))
    rows = kept.groupBy("h", "s").agg(F.sort_array(F.collect_list("row")).alias("rows"))  # two stretches at most
    starts = F.filter(F.sequence(F.lit(0), F.size("rows") - 1), lambda k: F.get("rows", k)["at"] == F.col("s"))
    ahead = lambda k: F.slice(F.flatten(F.slice(F.col("rows.w"), k + 1, F.lit(longest))), F.lit(1), F.lit(longest))
    placed = rows.select("h", F.explode(F.transform(starts, ahead)).alias("ahead"))
    near = placed.filter(F.array_join("ahead", " ").rlike(anchor))  # most lines of long blocks leave here
    runs = near.select("h", F.explode(F.array_distinct(F.array(*[F.slice("ahead", F.lit(1), F.lit(k)) for k in sizes]))).alias("words"))
    whole = some.select("h", leading_terms(F.col("block"), 2 * longest + 1).alias("words")).filter(F.size("words") <= 2 * longest)
    made = runs.unionByName(whole).filter(F.array_join("words", " ").rlike(anchor)).distinct()
    return held.select("path", "h").join(made, "h").select("path", "words")


def weights(rows: DataFrame, key: list[str], idf: DataFrame, unseen: float) -> DataFrame:
    """Sparse vectors at unit length as rows (key, term, w) for terms of ``idf``.

    Other terms count in the length only, each with the greatest idf, so that a
    line of many foreign words is far from every template.
    """
    tf = rows.select(*key, F.explode("words").alias("term")).groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf"))
    known = tf.join(idf, "term", "left")
    w = F.col("tf") * F.coalesce("idf", F.lit(unseen))
    length = known.groupBy(*key).agg(F.sqrt(F.sum(w * w)).alias("length"))
    return known.filter(F.col("idf").isNotNull()).withColumn("w", w).join(length, key).select(*key, "term", (F.col("w") / F.col("length")).alias("w"))


def own_licenses(files: DataFrame, least: float = LEAST, rows=None) -> DataFrame:
    """(path, license, score) of files with a notice close to a template; the closest counts, ties to the earlier template.

    Notices are single lines, scored on the templates alone, blocks of several lines
    without comment marks, scored on the usual headers and titles too, and SPDX tags.

    The inverse frequencies come from all distinct notices of all files, and from
    the templates, with add-one smoothing. Templates are a few rows, so their terms
    are broadcast; alike notices are scored once, however many files carry them.
    """
    spark = files.sparkSession
    given = templates(spark, rows)
    lines = _closest(cut(notices(files).select("path", "words")), given, least)
    more = templates(spark, [*(rows or TEMPLATES), *BLOCKS])
    sizes = sorted({len([w for w in re.split(r"[\W_]+", t) if w]) for _, t in [*(rows or TEMPLATES), *BLOCKS]})
    blocks = _closest(cut(block_notices(files, sizes).distinct()), more, least)
    found = lines.unionByName(blocks).unionByName(tagged(files, more))
    return found.groupBy("path").agg(F.max("b").alias("b")).select("path", "b.license", "b.score")


def _closest(found: DataFrame, given: DataFrame, least: float) -> DataFrame:
    """(path, b) of the closest template of every notice (path, words) that has one."""
    spark = found.sparkSession
    wanted = given.select("template", "license", terms(F.col("text")).alias("words"))
    alike = cut(found.select("words").distinct().withColumn("notice", F.xxhash64("words")))
    both = alike.select("words").unionByName(wanted.select("words"))
    n = both.count()
    vocabulary = wanted.select(F.explode("words").alias("term")).distinct()
    seen = both.select(F.explode(F.array_distinct("words")).alias("term")).join(F.broadcast(vocabulary), "term")
    idf = cut(seen.groupBy("term").agg((F.log((F.lit(n) + 1.0) / (F.count(F.lit(1)) + 1.0)) + 1.0).alias("idf")))
    unseen = float(spark.range(1).select((F.log((F.lit(n) + 1.0) / 2.0) + 1.0)).first()[0])
    idf = F.broadcast(idf)  # a term per word of the templates
    target = cut(weights(wanted, ["template", "license"], idf, unseen)).withColumnRenamed("w", "tw")
    cosine = (
        weights(alike, ["notice"], idf, unseen).join(F.broadcast(target), "term")
        .groupBy("notice", "template", "license").agg(F.round(F.sum(F.col("w") * F.col("tw")), 6).alias("score"))
        .filter(F.col("score") >= least)
    )
    best = cosine.groupBy("notice").agg(F.max(F.struct("score", (-F.col("template")).alias("t"), "license")).alias("b"))
    return found.select("path", F.xxhash64("words").alias("notice")).join(best, "notice").select("path", "b")


def folder(path: Column) -> Column:
    """Path without its last part; empty for a file at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(path: Column) -> Column:
    """The folder and all folders above it, the nearest first."""
    parts = F.split(path, "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), F.size(parts) - k), "/"))
    return F.when(path == "", F.array(F.lit(""))).otherwise(ups)


def scan(files: DataFrame, least: float = LEAST, rows=None) -> DataFrame:
    """(path, license, score, origin, licensed_by) of every path: its own licence, or that of the nearest folder above.

    ``files`` has path (parts joined by "/") and text. origin is "own" for a file
    with a notice of its own, "inherited" where a licence file (LICENSE, LICENCE,
    COPYING, in any case, with any ending after a ".", "-" or "_") of the folder or the nearest folder above has one, else
    "none" with nulls. Of several licence files of a folder the first name counts.
    Null texts have no notice and null paths are left out; repeated paths count as one
    file with the closest notice. Folders are resolved once each, by an equi-join of
    every folder above them with the licensed ones.
    """
    known = files.filter(F.col("path").isNotNull()).select("path", F.coalesce("text", F.lit("")).alias("text"))
    own = cut(own_licenses(known, least, rows))
    paths = known.select("path").distinct()
    named = F.regexp_extract("path", r"([^/]*)$", 1).rlike("(?i)^(" + "|".join(LICENSE_FILES) + r")([._-][^/]*)?$")
    given = own.filter(named).groupBy(folder(F.col("path")).alias("dir")).agg(F.min(F.struct("path", "license", "score")).alias("g"))
    dirs = paths.select(folder(F.col("path")).alias("dir")).distinct()
    up = dirs.select("dir", F.posexplode(ancestors(F.col("dir"))).alias("far", "above"))
    nearest = (
        up.join(given.withColumnRenamed("dir", "above"), "above")
        .groupBy("dir").agg(F.min_by("g", "far").alias("g"))
    )
    # a folder of very many files is one key here, which adaptive execution splits
    placed = paths.withColumn("dir", folder(F.col("path"))).join(nearest, "dir", "left").join(own, "path", "left")
    mine = F.col("license").isNotNull()
    return placed.select(
        "path",
        F.coalesce("license", "g.license").alias("license"),
        F.when(mine, F.col("score")).otherwise(F.col("g.score")).alias("score"),
        F.when(mine, "own").when(F.col("g").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(mine, F.col("path")).otherwise(F.col("g.path")).alias("licensed_by"),
    )
