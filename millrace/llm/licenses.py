"""License scans by diagonal voting.

Every run of three words, or of fewer where a template has no more, is joined by its hash with the places where it is in a
license template.  A text that holds a template gathers hits on one diagonal
(place in the text less place in the template); inserted or missing words move
it a little, so neighbouring diagonals are merged.  What covers enough of a
template, in a stretch that isn't much longer than it, is that license.  Where
merged diagonals reach further than that, each stretch in them that begins with
a hit is looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import alnum_words, gram_hashes, place_of, same_words, text_key, written

GRAM = 3
#: Diagonals up to so many words apart are merged.
SLACK = 3
#: Share of a template's runs that a text must hold, and how much longer the stretch may be.
COVERAGE, STRETCH = 0.8, 1.25
#: Templates of so many runs, or fewer, must be held whole: a word makes a difference there.
SHORT = 12

# The phrases that count by themselves, with their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Public license notices, with their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    (
        "gpl-3",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    (
        "gpl-2",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    ),
    (
        "lgpl",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
        "by the Free Software Foundation",
    ),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "mit",
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to "
        "the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the "
        "authors or copyright holders be liable for any claim, damages or other liability, whether in an action of "
        "contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings "
        "in the software.",
    ),
    (
        "isc",
        "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness. In no event shall the author be liable for any special, "
        "direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, "
        "whether in an action of contract, negligence or other tortious action, arising out of or in connection with the "
        "use or performance of this software.",
    ),
    (
        "bsd",
        "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, "
        "including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are "
        "disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, "
        "special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or "
        "services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, "
        "whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the "
        "use of this software, even if advised of the possibility of such damage.",
    ),
    (
        "gpl-3",
        "GNU General Public License Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is "
        "permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ),
    (
        "gpl-2",
        "GNU General Public License Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., Everyone is "
        "permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ),
    ("apache-2", "Apache License Version 2.0, January 2004 Terms and Conditions for Use, Reproduction, and Distribution"),
)


#: Texts of so many characters in all are broadcast with their runs of words; more are joined.
BROADCAST_CHARS = 4_000_000


def _templates(spark: SparkSession, phrases, templates) -> DataFrame:
    """(template, label, phrase, tw, k, grams): the words, the length of the runs and how many there are.

    What has fewer words than GRAM is one run; what has none is left out.
    """
    rows = [(i, label, i < len(phrases), text) for i, (label, text) in enumerate([*phrases, *templates])]
    t = spark.createDataFrame(rows, "template int, label string, phrase boolean, text string")
    t = t.withColumn("tw", alnum_words(F.col("text"))).filter(F.size("tw") > 0)
    t = t.withColumn("k", F.least(F.size("tw"), F.lit(GRAM)))
    return t.withColumn("grams", F.size("tw") - F.col("k") + 1).drop("text")


def scan(
    documents: DataFrame, *, phrases=PHRASES, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, text_key, n_words, copies), and what they hold:
    (doc_id, text_key, label, phrase, start, end, coverage), places in words from 0.

    Phrases are held where all their words stand consecutively; templates where
    the merged diagonals cover COVERAGE of their runs of words.  The templates
    are the caller's; up to BROADCAST_CHARS of them are broadcast.
    """
    texts = [text for _, text in [*phrases, *templates]]
    few = F.broadcast if sum(map(len, texts)) <= BROADCAST_CHARS else lambda df: df
    known = _templates(documents.sparkSession, phrases, templates)
    lengths = sorted({r["k"] for r in known.select("k").distinct().collect()}, reverse=True)  # GRAM at most
    grams = (
        known.select("template", "tw", "k", F.explode(F.sequence(F.lit(0), F.col("grams") - 1)).alias("tp"))
        .select("template", "tp", F.slice("tw", F.col("tp") + 1, F.col("k")).alias("gram"))
        .groupBy("gram")
        .agg(F.collect_list(F.struct("template", "tp")).alias("places"))
        .select(F.xxhash64("gram").alias("h"), "gram", "places")
    )
    base = documents.select(
        F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), alnum_words(F.col(text_col)).alias("w")
    )
    # Hashed in a projection of its own, with a null first for the document itself; see the decontamination.
    hashed = base.select(
        "doc_id", "text_key", "w", F.concat(F.array(F.lit(None).cast("bigint")), *[gram_hashes("w", k) for k in lengths]).alias("hs")
    )
    every = hashed.select("doc_id", "text_key", "w", F.posexplode_outer("hs").alias("p", "wh"))
    start, length = place_of(lengths, F.col("p"), F.size("w"))
    found = every.join(few(grams), every["wh"] == grams["h"], "left").filter((F.col("p") == 0) | F.col("gram").isNotNull())
    found = found.withColumn("start", start - 1).filter(
        (F.col("p") == 0) | ((F.size("gram") == length) & same_words("w", F.col("start"), "gram", GRAM))
    )
    found = written(
        found.select("doc_id", "text_key", F.size("w").alias("n_words"), F.when(F.col("p") == 0, -1).otherwise(F.col("start")).alias("p"), "places"),
        "license-hits",
    )
    whole = found.filter("p < 0").groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("bigint").alias("n_words"), F.count("*").alias("copies")
    )
    hits = found.filter("p >= 0").select("doc_id", "text_key", "p", F.explode_outer("places").alias("x"))
    diagonals = hits.groupBy(
        "doc_id", "text_key", F.col("x.template").alias("template"), (F.col("p") - F.col("x.tp")).alias("diagonal")
    ).agg(F.collect_set("x.tp").alias("at"))
    diagonals = diagonals.join(few(known.drop("tw")), "template")
    exact = diagonals.filter(F.col("phrase") & (F.size("at") == F.col("grams"))).select(
        "doc_id", "text_key", "label", "phrase", F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("grams") + F.col("k") - 1).alias("end"), F.lit(1.0).alias("coverage"),
    )
    side = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(side) > SLACK
    placed = diagonals.filter(~F.col("phrase")).withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
    placed = placed.withColumn("run", F.sum("apart").over(side)).withColumn("allowed", F.floor(STRETCH * (F.col("grams") + F.col("k") - 1) + SLACK))
    run = ["doc_id", "text_key", "template", "label", "phrase", "grams", "k", "allowed", "run"]
    runs = placed.groupBy(*run).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("held"),
        F.min(F.col("diagonal") + F.array_min("at")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("at") + F.col("k")).alias("end"),
    )
    enough = F.col("held") >= F.col("grams") * F.when(F.col("grams") <= SHORT, 1.0).otherwise(COVERAGE)
    fits = F.col("end") - F.col("start") <= F.col("allowed")
    span = ["doc_id", "text_key", "label", "phrase", "start", "end", (F.col("held") / F.col("grams")).alias("coverage")]
    # Of runs that are too long, the hits that follow each one within the length that is allowed.
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("doc_id", "text_key", "template", "run")]
    long = runs.filter(enough & ~fits).alias("l").join(placed.alias("p"), same, "left_outer").select("p.*")
    hit = long.select(*run, "diagonal", F.explode("at").alias("tp")).select(*run, "tp", (F.col("diagonal") + F.col("tp")).alias("at"))
    ahead = Window.partitionBy("doc_id", "text_key", "template", "run").orderBy("at").rangeBetween(0, int(STRETCH * max(map(len, texts), default=0)) + SLACK)
    within = F.filter(F.collect_list(F.struct("at", "tp")).over(ahead), lambda x: x["at"] + F.col("k") <= F.col("start") + F.col("allowed"))
    stretches = hit.withColumn("start", F.col("at")).withColumn("hits", within).select(
        *run, "start", F.size(F.array_distinct(F.transform("hits", lambda x: x["tp"]))).alias("held"), (F.array_max(F.transform("hits", lambda x: x["at"])) + F.col("k")).alias("end")
    )
    merged = runs.filter(enough & fits).select(*span).unionByName(stretches.filter(enough).select(*span))
    # Where templates overlap, the one that is held best counts.  No span is longer than the longest
    # template allows, so spans are compared within stretches of that length alone.
    most = int(STRETCH * max(map(len, texts), default=0)) + SLACK + 1
    spans = merged.distinct().withColumn("stretch", F.explode(F.sequence(F.floor(F.col("start") / most), F.floor((F.col("end") - 1) / most))))
    span = F.struct("label", "phrase", "start", "end", "coverage")
    near = spans.groupBy("doc_id", "text_key", "stretch").agg(F.collect_list(span).alias("spans"))
    beaten = lambda x: F.exists("spans", lambda y: (y["start"] < x["end"]) & (y["end"] > x["start"]) & (y["coverage"] > x["coverage"]))
    best = (
        near.select("doc_id", "text_key", F.explode(F.transform("spans", lambda x: F.struct(x.alias("x"), beaten(x).alias("beaten")))).alias("s"))
        .groupBy("doc_id", "text_key", "s.x")
        .agg(F.bool_or("s.beaten").alias("beaten"))
        .filter("not beaten")
    )
    return whole, exact.unionByName(best.select("doc_id", "text_key", "x.*"))


def license_labels(documents: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, text_key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest coverage among what the document holds, else 0.

    Null and empty texts have no words, no places and no labels.  Repeated rows
    give a row each, with the same result.  Null ids and other columns don't
    matter.  An empty table gives no rows.
    """
    whole, held = scan(documents, **options)
    base = F.col("phrase")
    by_document = held.groupBy(F.col("doc_id").alias("i"), F.col("text_key").alias("k")).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"),
    )
    joined = whole.join(by_document, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")), "left")
    return joined.select(
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_labels(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_key")


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_SQL_ROWS = ",\n  ".join(
    f"({i}, {_sql_text(label)}, {str(i < len(PHRASES)).lower()}, {_sql_text(text)})" for i, (label, text) in enumerate([*PHRASES, *TEMPLATES])
)
_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP10_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_SQL_WORDS} AS w FROM documents),
t AS (SELECT template, label, phrase, {_SQL_WORDS} AS tw FROM (VALUES
  {_SQL_ROWS}) x(template, label, phrase, text)),
k AS (SELECT *, least(len(tw), {GRAM}) AS k, len(tw) - least(len(tw), {GRAM}) + 1 AS grams FROM t WHERE len(tw) > 0),
g AS (SELECT template, tp, k, array_to_string(tw[tp + 1:tp + k], ' ') AS gram FROM (SELECT *, unnest(range(grams)) AS tp FROM k)),
p AS (
  SELECT r, p, k, array_to_string(w[p + 1:p + k], ' ') AS gram
  FROM (SELECT r, w, k, unnest(range(len(w) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM k) WHERE len(w) >= k)),
a AS (
  SELECT r, template, p - tp AS diagonal, count(DISTINCT tp) AS n, min(tp) AS least, max(tp) AS most, list(DISTINCT tp) AS tps
  FROM p JOIN g ON p.k = g.k AND p.gram = g.gram GROUP BY ALL),
x AS (SELECT r, label, phrase, diagonal AS start, diagonal + grams + k - 1 AS stop, 1.0::DOUBLE AS coverage FROM a JOIN k USING (template) WHERE phrase AND n = grams),
m AS (
  SELECT *, sum(CASE WHEN gap > {SLACK} THEN 1 ELSE 0 END) OVER (PARTITION BY r, template ORDER BY diagonal) AS run FROM (
    SELECT a.*, label, phrase, k, grams, diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) AS gap
    FROM a JOIN k USING (template) WHERE NOT phrase)),
s AS (
  SELECT r, template, label, phrase, k, grams, run, floor({STRETCH} * (grams + k - 1) + {SLACK}) AS allowed, len(list_distinct(flatten(list(tps)))) AS held,
    min(diagonal + least) AS start, max(diagonal + most + k) AS stop FROM m GROUP BY r, template, label, phrase, k, grams, run),
e AS (SELECT * FROM s WHERE held >= grams * CASE WHEN grams <= {SHORT} THEN 1.0 ELSE {COVERAGE} END),
h AS (SELECT r, template, run, tp, diagonal + tp AS p FROM (SELECT r, template, run, diagonal, unnest(tps) AS tp FROM m)),
c AS (
  SELECT e.r, label, phrase, grams, one.p AS start, max(two.p) + any_value(k) AS stop, count(DISTINCT two.tp) AS held
  FROM e JOIN h one USING (r, template, run) JOIN h two ON two.r = e.r AND two.template = e.template AND two.run = e.run AND two.p BETWEEN one.p AND one.p + allowed - k
  WHERE stop - start > allowed GROUP BY e.r, e.template, e.run, label, phrase, grams, one.p),
f AS (
  SELECT DISTINCT r, label, phrase, start, stop, held / grams AS coverage FROM e WHERE stop - start <= allowed
  UNION SELECT r, label, phrase, start, stop, held / grams FROM c WHERE held >= grams * CASE WHEN grams <= {SHORT} THEN 1.0 ELSE {COVERAGE} END),
b AS (
  SELECT r, label, phrase, start, stop, coverage FROM x
  UNION ALL SELECT * FROM f WHERE NOT EXISTS (
    SELECT 1 FROM f y WHERE y.r = f.r AND y.start < f.stop AND y.stop > f.start AND y.coverage > f.coverage)),
z AS (
  SELECT r, count(*) FILTER (WHERE phrase) AS n_base, min(start) FILTER (WHERE phrase) AS first_word, max(start) FILTER (WHERE phrase) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase), '') AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score FROM b GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN z USING (r)
"""
