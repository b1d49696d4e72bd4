"""Licence scans (operator 9): sparse TF-IDF cosine of header lines and licence
files to templates, then inheritance from the nearest ancestor directory.

DataFrame functions only.  Document frequencies of the template words are
counted over all texts; a header line is compared with each template by a
join on words, so only shared words make rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.llm.tables import packed, unpacked, written

# Wordings by which licences are recognised.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "All rights reserved"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
# A line without any of these is no header; every template holds one.
ANCHOR = r"(?i)licen[cs]e|rights reserved|permission|permitted|public domain|redistribut"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"
LEAST_COSINE = 0.7


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, licence, word, times), one row per word of a template."""
    frame = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(templates)], "template int, licence string, text string")
    return (frame.select("template", "licence", F.explode(_words(F.col("text"))).alias("word"))
            .groupBy("template", "licence", "word").agg(F.count(F.lit(1)).alias("times")))


def word_idf(files: DataFrame, templates: DataFrame, text_col: str) -> tuple[DataFrame, float]:
    """(word, idf) of the template words over all texts, and the idf of a word
    that no template has: ln((1 + N) / (1 + df)) + 1, the latter with df 0."""
    vocabulary = F.array(*[F.lit(r.word) for r in templates.select("word").distinct().orderBy("word").collect()])
    present = F.array_intersect(_words(F.coalesce(files[text_col].cast("string"), F.lit(""))), vocabulary)
    seen = (files.select(F.explode(F.concat(present, F.array(F.lit("")))).alias("word"))   # "" counts the texts
            .groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    rows = {r.word: r.df for r in seen.collect()}       # at most one row per template word
    n = rows.pop("", 0)
    table = [(r.word, float(rows.get(r.word, 0))) for r in templates.select("word").distinct().collect()]
    idf = files.sparkSession.createDataFrame(table, "word string, df double").select(
        "word", (F.log(F.lit(1.0 + n) / (F.col("df") + 1)) + 1).alias("idf"))
    unseen = files.sparkSession.range(1).select((F.log(F.lit(1.0 + n)) + 1).alias("x")).first().x
    return idf, unseen


def own_licences(files: DataFrame, least: float = LEAST_COSINE, text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """(rid, licence, score): the best template of the best header line of each
    file that has one.  ``files`` holds rid and the text.  Ties go to the first
    licence by name; scores are rounded to 9 digits so that ties are ties."""
    table = template_table(files.sparkSession, templates)
    idf, unseen = word_idf(files, table, text_col)
    lines = F.filter(F.split(F.coalesce(files[text_col].cast("string"), F.lit("")), "\n"),
                     lambda line: F.regexp_like(line, F.lit(ANCHOR)))
    headers = written(files.filter(F.size(lines) > 0).select("rid", F.posexplode(lines).alias("line", "header")))
    counted = (headers.select("rid", "line", F.explode(_words(F.col("header"))).alias("word"))
               .groupBy("rid", "line", "word").agg(F.count(F.lit(1)).alias("times")))
    weighed = counted.join(F.broadcast(idf), "word", "left").select(
        "rid", "line", "word", (F.col("times") * F.coalesce("idf", F.lit(unseen))).alias("weight"))
    norms = weighed.groupBy("rid", "line").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    marks = table.join(idf, "word").select(
        "template", "licence", "word", (F.col("times") * F.col("idf")).alias("mark"))
    sizes = marks.groupBy(F.col("template").alias("t")).agg(F.sqrt(F.sum(F.col("mark") * F.col("mark"))).alias("size"))
    # a handful of templates: bounded by TEMPLATES
    marks = F.broadcast(marks.join(sizes, F.col("template") == F.col("t")).select("template", "licence", "word", "mark", "size"))
    dots = (weighed.join(marks, "word").groupBy("rid", "line", "template", "licence")
            .agg((F.sum(F.col("weight") * F.col("mark")) / F.first("size")).alias("dot")))
    scored = (dots.join(norms, ["rid", "line"])
              .select("rid", "licence", F.round(F.col("dot") / F.col("norm"), 9).alias("score")).filter(F.col("score") >= least))
    best = scored.groupBy("rid").agg(F.min(F.struct((-F.col("score")).alias("low"), "licence")).alias("best"))
    return best.select("rid", F.col("best.licence").alias("licence"), (-F.col("best.low")).alias("score"))


def scan(files: DataFrame, carry: list[str] | None = None, path_col: str = "path", text_col: str = "text",
         least: float = LEAST_COSINE, templates=TEMPLATES) -> DataFrame:
    """``carry`` columns (default: all) plus own_licence, score, licence, inherited_from.

    A file without a licence of its own takes that of the licence file in the
    nearest directory at or above its own; of several there the best score,
    then the first name.  inherited_from is that directory, null otherwise.
    Null or empty texts have no own licence but inherit; a null path inherits
    nothing; a path without "/" lies in the root "".  Repeated paths are
    separate files.  An empty table stays empty.  Carried columns named like
    an added one are replaced.
    """
    carry = list(carry or files.columns)
    table = written(packed(files, carry, rid=F.monotonically_increasing_id(), path=files[path_col].cast("string"),
                           text=files[text_col].cast("string")))
    own = written(own_licences(table.select("rid", "text"), least, "text", templates))
    name = F.element_at(F.split("path", "/"), -1)
    parts = F.split("path", "/")
    folder = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/")
    # the text stays in the table unless it is carried
    placed = (table.drop("text").withColumn("folder", folder).join(own.withColumnRenamed("rid", "r"), F.col("rid") == F.col("r"), "left"))
    held = (placed.filter(F.regexp_like(name, F.lit(LICENCE_FILE)) & F.col("licence").isNotNull())
            .groupBy(F.col("folder").alias("holder")).agg(F.min(F.struct((-F.col("score")).alias("low"), "licence")).alias("best")))
    # folders, not files, climb the tree: a folder of any size is one row
    folders = table.select(folder.alias("of")).filter("of is not null").distinct()
    steps = F.split("of", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    climbed = folders.select("of", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), above))).alias("up"))
    nearest = (climbed.join(held, F.col("up") == F.col("holder")).groupBy("of")
               .agg(F.max(F.struct(F.length("up").alias("depth"), "up", "best")).alias("found")))
    joined = placed.join(nearest, F.col("folder") == F.col("of"), "left")
    lacks = F.col("licence").isNull()
    return unpacked(joined, carry, own_licence=F.col("licence"), score=F.col("score"),
                    licence=F.coalesce("licence", F.col("found.best.licence")),
                    inherited_from=F.when(lacks, F.col("found.up")))
