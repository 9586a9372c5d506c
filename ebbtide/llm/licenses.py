"""Licences of files: sparse TF-IDF cosine to templates, then inheritance along directories.

The units that are compared are the lines, the blank-line blocks and the sentences of the whole text that hold one of the expressions of which
each template has one (``ANCHORS``). Templates are tags, titles, usual statements, standard headers and characteristic paragraphs. Each distinct unit is weighed once, whatever the number of its copies.
Document frequencies are counted over all units of the corpus and the templates. A unit's licence is that of
the template with the largest cosine, if that reaches ``COSINE``; a file's own licence is that of its best unit.

A file that consists of its licence unit for the most part, or is named like one (LICENSE, COPYING, NOTICE), is a licence file: it speaks
for its directory. Files without a licence of their own inherit that of the nearest ancestor directory that has one.

Defined results: null and empty texts have no licence of their own. A null path lies in no directory and inherits nothing.
Ties between templates, units or a directory's licence files go to the larger cosine (to 9 digits), between units then to the longer
one, then to the first name. Repeated rows each get their row. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.frames import named, stored

# Identifiers of widespread licences, as tags name them.
TAGS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0",
    "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
# Usual statements, titles, headers and paragraphs of widespread licences.
STATEMENTS = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "CC0 1.0 Universal, public domain dedication"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work, public domain"),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available "
        "at https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("GPL", "GNU GENERAL PUBLIC LICENSE"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("ISC", "ISC License"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, under this license",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: A tag's licence is named without what it says of later versions.
TEMPLATES = tuple(
    (tag.removesuffix("-only").removesuffix("-or-later"), f"SPDX-License-Identifier: {tag}") for tag in TAGS
) + STATEMENTS
ANCHORS = "(?i)licen[cs]e|permission|redistribution|free software|public domain"
#: What ends a sentence.
SENTENCE = r"[.!?][\x20\x09-\x0D]+"
NAMES = "(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
COSINE = 0.7
#: Directories (two paths and a name each) that may be broadcast.
BROADCAST_DIRECTORIES = 100_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def units(text: Column) -> Column:
    """Distinct lines, blocks and sentences of a text that may state a licence."""
    text = F.coalesce(text, F.lit(""))
    pieces = F.concat(F.split(text, "\n", -1), F.split(text, "\n\n+", -1), F.split(text, SENTENCE, -1))
    some = F.filter(F.array_distinct(F.transform(pieces, F.trim)), lambda u: u.rlike(ANCHORS))
    return F.when(text.rlike(ANCHORS), some).otherwise(F.array().cast("array<string>"))


def weighed(texts: DataFrame) -> DataFrame:
    """(``unit``, ``license``, ``cosine``) of every distinct unit of rows (``unit``, ``statement``, ``copies``) that reaches the
    cosine. ``unit`` is a digest: the text itself goes no further than to its words."""
    spark = texts.sparkSession
    templates = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(TEMPLATES)], "template int, license string, statement string")
    terms = stored(
        texts.select("unit", "copies", F.explode(_words(F.col("statement"))).alias("term"))
        .groupBy("unit", "copies", "term").agg(F.count("*").alias("tf")),
        "license-terms",
    )
    template_terms = (
        templates.select("template", "license", F.explode(_words(F.col("statement"))).alias("term"))
        .groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    )
    total = (texts.agg(F.sum("copies")).first()[0] or 0) + len(TEMPLATES)
    often = (
        terms.select("term", "copies").unionByName(template_terms.select("term", F.lit(1).cast("long").alias("copies")))
        .groupBy("term").agg(F.sum("copies").alias("df"))
    )
    often = often.select("term", (F.log(F.lit(1.0 + total) / (1 + F.col("df"))) + 1).alias("idf"))
    weight = (F.col("tf") * F.col("idf")).alias("weight")
    own = terms.join(often, "term").select("unit", "term", weight)
    # Some thousand rows: the templates are fixed.
    theirs = F.broadcast(template_terms).join(often, "term").select("template", "license", "term", weight)
    norms = own.groupBy("unit").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    sides = theirs.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("side"))
    dots = own.join(F.broadcast(theirs.withColumnRenamed("weight", "other")), "term").groupBy("unit", "template", "license").agg(
        F.sum(F.col("weight") * F.col("other")).alias("dot")
    )
    cosines = dots.join(F.broadcast(sides), "template").join(norms, "unit").select(
        "unit", "license", F.round(F.col("dot") / (F.col("norm") * F.col("side")), 9).alias("cosine")
    )
    best = cosines.groupBy("unit").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "license")).alias("best"))
    return best.select("unit", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("cosine")).where(
        F.col("cosine") >= COSINE
    )


def ancestors(directory: Column) -> Column:
    """The directory and those above it, nearest first: ``/a/b``, ``/a``, and the empty root."""
    parts = F.split(directory, "/", -1)
    return F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )


def scan(files: DataFrame, path: Column, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every file, with ``own_license`` and its ``cosine``, ``license`` after inheritance, and ``origin``: the
    directory it was inherited from, ``own``, or null."""
    body = F.coalesce(named(files, text), F.lit(""))
    found = units(body)
    rows = files.select(
        *[named(files, c).alias(f"keep_{i}") for i, c in enumerate(keep)],
        path.alias("path"),
        F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("directory"),
        path.rlike(NAMES).alias("by_name"),
        F.length(F.trim(body)).alias("whole"),
        found.alias("units"),
    )
    rows = stored(rows, "license-units")
    some = rows.where(F.size("units") > 0).withColumn("list", F.sha2(F.array_join("units", "\n"), 256))
    # Each distinct list of units, and each distinct unit, is looked at once.
    lists = stored(some.groupBy("list").agg(F.first("units").alias("units"), F.count("*").alias("copies")), "license-lists")
    each = lists.select("list", "copies", F.explode("units").alias("statement"))
    each = each.withColumn("unit", F.unhex(F.md5("statement")))
    # A unit's text travels once per task that has it.
    distinct = each.groupBy("unit").agg(F.sum("copies").alias("copies"), F.first("statement").alias("statement"))
    judged = weighed(distinct)
    each = each.select("list", "unit", F.length("statement").alias("size"))
    best = (
        each.join(judged, "unit").groupBy("list")
        .agg(F.min(F.struct((-F.col("cosine")).alias("minus"), (-F.col("size")).alias("size"), "license")).alias("best"))
        .select("list", F.col("best.license").alias("own_license"), (-F.col("best.minus")).alias("cosine"), (-F.col("best.size")).alias("size"))
    )
    none = rows.where(F.size("units") == 0).select(
        "*", F.lit(None).cast("string").alias("own_license"), F.lit(None).cast("double").alias("cosine"), F.lit(None).cast("int").alias("size")
    )
    told = some.join(best, "list", "left").drop("list").unionByName(none).drop("units")
    told = stored(told, "license-own")
    speaks = told.where(F.col("own_license").isNotNull() & F.col("path").isNotNull() & (F.col("by_name") | (2 * F.col("size") >= F.col("whole"))))
    spoken = speaks.groupBy("directory").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "own_license")).alias("best"))
    spoken = spoken.select(F.col("directory").alias("above"), F.col("best.own_license").alias("inherited"))
    directories = told.where(F.col("path").isNotNull()).select("directory").distinct()
    near = (
        directories.select("directory", F.posexplode(ancestors(F.col("directory"))).alias("steps", "above"))
        .join(spoken, "above").groupBy("directory").agg(F.min(F.struct("steps", "above", "inherited")).alias("best"))
        .select("directory", F.col("best.above").alias("above"), F.col("best.inherited").alias("inherited"))
    )
    # Files in directories that inherit nothing, or without a path, need no partner. Few directories are sent to the files' tasks.
    near = stored(near, "license-directories")
    near = F.broadcast(near) if near.count() <= BROADCAST_DIRECTORIES else near
    joined = told.withColumn("directory", F.when(F.col("path").isNotNull(), F.col("directory"))).join(near, "directory", "left")
    own = F.col("own_license").isNotNull()
    return joined.select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)],
        "own_license",
        "cosine",
        F.coalesce("own_license", "inherited").alias("license"),
        F.when(own, "own").otherwise(F.col("above")).alias("origin"),
    )
