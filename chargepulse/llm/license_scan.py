"""Licence scans, in DataFrame functions only.

A text's *units* are its lines and the text as a whole, normalised (A-Z lower-cased, all but
letters and digits of ASCII one space).  A unit matches a template if the Dice coefficient of
their sets of word bigrams reaches the threshold.  With ``a`` and ``b`` bigrams the
coefficient is at most ``2 min(a, b) / (a + b)``, so only units whose word count lies in some
template's bounds are cut into bigrams, and a bigram meets only templates whose bounds
hold its unit.  Bigrams that no template has fall out of the join at once.

Notices that are wrapped over lines or stand inside a longer text are found in *windows*
of the whole normalised text, line breaks ignored: they begin at a bigram of a template and are
about as long as it.  Windows that meet a line or text that matches by itself are that match.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargepulse.llm.common import staged, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Public notices and short licence texts (SPDX names); fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def words(col):
    plain = F.trim(F.regexp_replace(F.translate(col, UPPER, LOWER), "[^a-z0-9]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def bigrams(ws):
    """Distinct word bigrams; a single word stands for itself, no word gives none."""
    n = F.greatest(F.size(ws) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(ws, F.lit(1), n), F.slice(ws, F.lit(2), n), lambda x, y: F.concat(x, F.lit(" "), y))
    return F.array_distinct(F.when(F.size(ws) >= 2, pairs).otherwise(ws))


def scan_licenses(docs: DataFrame, templates: DataFrame, dice: float = 0.8) -> DataFrame:
    """``(doc_id, text)`` rows and ``(license, text)`` templates -> one row per ``doc_id``.

    ``doc_id, n_matches`` (units that match, and windows that match and meet none of them nor a better
    window), ``license, score, line`` of the best match: the highest coefficient, ties by the smaller line
    (0: the whole text; lines count from 1; a window has the line it begins in), then the smaller name.  Nulls where nothing matches, as for null and empty texts.  A text without a
    line break is one line.  Rows with one ``doc_id`` are one document; a null id is one too.
    Templates without words match nothing.
    """
    forms = staged(templates.where("license is not null and text is not null").distinct()
                   .withColumn("form", F.xxhash64("license", "text"))
                   .select("form", "license", F.explode(bigrams(words(F.col("text")))).alias("bigram"),
                           F.size(bigrams(words(F.col("text")))).alias("b"),
                           F.greatest(F.size(words(F.col("text"))) - 1, F.lit(1)).alias("long")), "license-forms")
    bounds = forms.agg(F.min("b"), F.max("b")).first()
    if bounds[0] is None:
        bounds = (1, 0)
    # 2 min / (a + b) >= dice bounds a; words are one more than bigrams, and repeats make them more.
    least = int(bounds[0] * dice / (2 - dice))
    most = int(bounds[1] * (2 - dice) / dice) + 1
    lines = F.split(F.col("text"), "\n")
    units = docs.select("doc_id", F.posexplode(F.concat(F.array(F.col("text")), F.when(
        F.size(lines) > 1, lines).otherwise(F.array().cast("array<string>")))).alias("line", "unit"))
    # A unit of one byte a word at least: long ones cannot be short in words, so characters are no bound from above.
    # Exploding a one-element array keeps the planner from copying the expression into each of its uses.
    once = lambda x: F.explode(F.array(x))
    cut = (units.where(F.length("unit") > 2 * least).withColumn("ws", once(words(F.col("unit"))))
           .where(F.size("ws") > least - 1).withColumn("grams", once(bigrams(F.col("ws"))))
           .withColumn("a", F.size("grams")).where((F.col("a") >= least) & (F.col("a") <= most)))
    shared = (cut.select("doc_id", "line", "a", F.xxhash64("unit").alias("unit"), F.explode("grams").alias("bigram"))
              .join(forms, "bigram").where(2 * F.least("a", "b") >= dice * (F.col("a") + F.col("b")))
              .groupBy("doc_id", "line", "unit", "form", "license", "a", "b").agg(F.countDistinct("bigram").alias("n_both")))
    # Repeated rows of a document repeat its units, so bigrams are counted once.
    best = (shared.withColumn("score", 2.0 * F.col("n_both") / (F.col("a") + F.col("b"))).where(F.col("score") >= dice)
            .groupBy("doc_id", "line", "unit").agg(F.max(F.struct("score", "license")).alias("m"),
                                                   F.min(F.struct(-F.col("score"), "license")).alias("m2"))
            .select("doc_id", "line", "unit", F.col("m.score").alias("score"), F.col("m2.license").alias("license")))
    best = staged(best, "license-units")
    best = best.select("doc_id", "line", "score", "license").unionByName(_windows(docs, forms, best, dice))
    found = best.select("doc_id", F.struct((-F.col("score")).alias("s"), "line", "license").alias("hit"))
    every = docs.select("doc_id", F.lit(None).cast(found.schema["hit"].dataType).alias("hit"))
    return (found.unionByName(every).groupBy("doc_id")
            .agg(F.count("hit").alias("n_matches"), F.min("hit").alias("hit"))
            .select("doc_id", "n_matches", F.col("hit.license").alias("license"), (-F.col("hit.s")).alias("score"),
                    F.col("hit.line").alias("line")))


def _may_hold(docs: DataFrame, forms: DataFrame, dice: float) -> DataFrame:
    """``doc_id, whole, text`` of the texts that hold as many bigrams of some template as a window of it needs.

    Decided in the text's own row: few texts hold so many, and no others are written or moved.  The templates are a
    small table; their bigrams are a constant of the plan.
    """
    once = lambda x: F.explode(F.array(x))
    parts = forms.groupBy("form", "b").agg(F.collect_set("bigram").alias("bigrams")).collect()
    # 2 n >= dice (n + b)
    needs = [(math.ceil(r["b"] * dice / (2 - dice) - 1e-9), sorted(r["bigrams"])) for r in parts]
    every = sorted({g for _, grams in needs for g in grams})
    enough = F.lit(False)
    for need, grams in needs:
        enough = enough | (F.size(F.array_intersect("held", F.lit(grams))) >= need)
    rows = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("whole"), "text")
    if not every:
        return rows.where("false")
    held = F.array_intersect(bigrams(F.col("ws")), F.lit(every))
    return (rows.withColumn("ws", once(words(F.col("text")))).withColumn("held", once(held))
            .where(F.size("held") >= min(n for n, _ in needs)).where(enough).select("doc_id", "whole", "text"))


def _windows(docs: DataFrame, forms: DataFrame, units: DataFrame, dice: float) -> DataFrame:
    """``doc_id, line, score, license`` of the windows that match and meet no matching unit nor a better window.

    ``units`` are the matching lines and texts: ``doc_id, line`` and ``unit``, the hash of the line or text.
    """
    once = lambda x: F.explode(F.array(x))
    n = F.greatest(F.size("ws") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("ws", F.lit(1), n), F.slice("ws", F.lit(2), n), lambda x, y: F.concat(x, F.lit(" "), y))
    texts = staged(_may_hold(docs, forms, dice), "license-texts")
    # Windows begin and end at bigrams of their template; templates of one word have none, lines hold them.
    hits = (texts.select("doc_id", "whole", once(words(F.col("text"))).alias("ws"))
            .select("doc_id", "whole", F.posexplode(pairs).alias("start", "bigram")).join(forms, "bigram")
            .select("doc_id", "whole", "form", "license", "b", "long", "start", F.xxhash64("bigram").alias("bigram")))
    # Places are counted in lengths of the template (parts of 2^30), so one frame fits all; the longer ones leave room for added words.
    unit_length = 1 << 30
    place = (F.col("start").cast("long") * unit_length / F.col("long")).cast("long")
    of = Window.partitionBy("doc_id", "whole", "form").orderBy(place)
    most = (2 - dice) / dice
    frames = [of.rangeBetween(0, int(x * unit_length) - 2) for x in (1.0, (1 + most) / 2, most)]
    ends = F.array(*[F.struct(F.size(F.collect_set("bigram").over(w)).alias("n_both"), F.max("start").over(w).alias("end"))
                     for w in frames])
    near = (hits.withColumn("ends", ends).withColumn("w", F.explode("ends"))
            .select("*", "w.n_both", "w.end").drop("w", "ends", "bigram")
            .where(2 * F.col("n_both") >= dice * (F.col("n_both") + F.col("b"))).distinct())
    near = staged(near, "license-windows")

    # Their bigrams and lines, from their texts; a text is one row with all its windows.
    row = F.struct("form", "license", "b", "long", "start", "end", "n_both")
    asked = near.groupBy(F.col("doc_id").alias("id"), F.col("whole").alias("w")).agg(F.collect_list(row).alias("windows"))
    matched = units.groupBy(F.col("doc_id").alias("id_m")).agg(F.collect_set(F.struct("line", "unit")).alias("matched"))
    full = (texts.join(asked, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("whole") == F.col("w")))
            .dropDuplicates(["doc_id", "whole"]).join(matched, F.col("doc_id").eqNullSafe(F.col("id_m")), "left")
            .withColumn("ws", once(words(F.col("text")))).withColumn("grams", once(pairs))
            .withColumn("lines", once(F.split(F.col("text"), "\n")))
            .withColumn("of_word", once(F.flatten(F.transform("lines", lambda x, i: F.array_repeat(i + 1, F.size(words(x))))))))
    line_of = lambda word: F.element_at("of_word", word + 1)
    distinct = lambda w: F.size(F.array_distinct(F.slice("grams", w["start"] + 1, w["end"] - w["start"] + 1)))
    seen = F.transform("windows", lambda w: F.struct(
        *[w[c].alias(c) for c in ("form", "license", "long", "start", "end")],
        (2.0 * w["n_both"] / (distinct(w) + w["b"])).alias("score"),
        line_of(w["start"]).alias("line"), line_of(w["end"] + 1).alias("to")))
    unit = F.transform(F.sequence("line", "to"), lambda i: F.struct(
        i.alias("line"), F.xxhash64(F.element_at("lines", i)).alias("unit")))
    met = F.arrays_overlap(F.concat(unit, F.array(F.struct(F.lit(0).alias("line"), F.col("whole").alias("unit")))), "matched")
    good = (full.withColumn("seen", F.explode(seen)).select("doc_id", "whole", "lines", "matched", "seen.*")
            .where(F.col("score") >= dice).where(~F.coalesce(met, F.lit(False)))
            .select("doc_id", F.xxhash64("doc_id", "whole").alias("key"), "form", "license", "start", "end", "line",
                    "score", "long"))
    # The best of a template within its length, then the best of those that overlap.
    rank = F.struct(-F.col("score"), F.col("start"), F.col("license"), F.col("form"), F.col("end"))
    around = Window.partitionBy("key", "form").orderBy(place).rangeBetween(-unit_length, unit_length)
    good = (good.withColumn("rank", rank).withColumn("first", F.min("rank").over(around)).where("rank = first")
            .select("doc_id", "key", "line", "score", "license", "start", "end", "rank"))
    good = staged(good.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / 64), F.floor((F.col("end") + 1) / 64)))),
                  "license-found")
    x, y = good.alias("x"), good.alias("y")
    worse = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.cell") == F.col("y.cell"))
                   & (F.col("x.start") <= F.col("y.end") + 1) & (F.col("y.start") <= F.col("x.end") + 1)
                   & (F.col("y.rank") < F.col("x.rank"))).select("x.key", "x.rank").distinct()
    return (good.drop("cell").distinct().join(worse, ["key", "rank"], "left_anti")
            .select("doc_id", "line", "score", "license"))


def op6_license_scans(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"),
                         spark.createDataFrame(TEMPLATES, "license string, text string"))


def _values() -> str:
    return ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in TEMPLATES)


_GRAMS = ("list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) "
          "ELSE w END)")
_WORDS = ("list_filter(string_split(trim(regexp_replace(translate({}, '" + UPPER + "', '" + LOWER
          + "'), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x <> '')")
ORACLE = f"""
WITH t(license, text) AS (VALUES {_values()}),
f AS (SELECT license, {_GRAMS} AS g FROM (SELECT license, {_WORDS.format('text')} AS w FROM t)),
u AS (SELECT doc_id, 0 AS line, text AS unit FROM documents WHERE text IS NOT NULL
      UNION ALL SELECT doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS unit
      FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) WHERE len(l) > 1),
c AS (SELECT doc_id, line, {_GRAMS} AS g FROM (SELECT doc_id, line, {_WORDS.format('unit')} AS w FROM u)),
k AS (SELECT license, g, unnest(g) AS gram FROM f),
s AS (SELECT doc_id, line, license, 2.0::DOUBLE * count(*) / (a + len(k.g)) AS score
      FROM (SELECT doc_id, line, len(g) AS a, unnest(g) AS gram FROM c) x JOIN k ON x.gram = k.gram
      GROUP BY doc_id, line, license, a, k.g),
b AS (SELECT doc_id, line, max(score) AS score, min(struct_pack(s := -score, license := license)).license AS license
      FROM s WHERE score >= 0.8 GROUP BY doc_id, line),
m AS (SELECT doc_id, count(*) AS n_matches, min(struct_pack(s := -score, line := line, license := license)) AS hit FROM b GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_matches, 0) AS n_matches, hit.license AS license, -hit.s AS score, hit.line::INTEGER AS line
FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id
"""
