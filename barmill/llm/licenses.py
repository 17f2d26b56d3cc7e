"""Licence statements by a trained classifier of paragraphs, confirmed by comparison with templates.

A multinomial logistic regression over the words and pairs of words that templates hold tells licence families and
ordinary prose apart. It is fitted on variants of the templates, with words left out by a hash, and on all paragraphs of
the corpus as prose: paragraphs that hold the same of them are one row with a weight. A paragraph whose likeliest family
falls short of a threshold, calibrated on held-out prose, is of no known family. A prediction counts as confirmed if
enough of a template's n-grams stand in the paragraph.

A paragraph is a line, or a run of lines without a blank one between them, since licence texts are mostly wrapped. Runs
start at every line and reach well over the longest template; of those that say the same the likest stays.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.llm.util import stored

#: How licences announce themselves.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Distributed under the terms of the Apache License 2.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
    ],
    "lgpl": ["Licensed under the GNU Lesser General Public License.", "This library is free software under the terms of the GNU Lesser General Public License."],
    "agpl-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc0": ["This work is dedicated to the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "reserved": ["All rights reserved.", "Copyright by the authors. All rights reserved. No part may be reproduced without permission."],
}
PROSE = "none"
FAMILIES = [PROSE, *sorted(TEMPLATES)]
VARIANTS = 40
#: What all prose of a corpus weighs in the fit, however much there is; a variant of a template weighs 1.
PROSE_WEIGHT = 6000.0
#: Share of held-out prose that may pass for a licence, and of a template's n-grams that confirms one.
FALSE_ALARMS, CONFIRMED = 0.001, 0.6
#: Steps between 0 and 1 in which probabilities of held-out prose are counted.
STEPS = 10_000
#: Words that a run of lines reaches: half as many again as the longest template.
REACH = 3 * max(len(t.split()) for texts in TEMPLATES.values() for t in texts) // 2


def words(text: Column) -> Column:
    """Words in lower case; a full stop inside one, as in a version, stays."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"), F.lit(0))


def grams(w: Column, n: int) -> Column:
    if n == 1:
        return w
    following = [F.slice(w, k + 1, F.greatest(F.size(w) - n + 1, F.lit(0))) for k in range(n)]
    out = following[0]
    for more in following[1:]:
        out = F.zip_with(out, more, lambda a, b: F.concat_ws(" ", a, b))
    return out


def _bigrams(text: str) -> list[str]:
    found = re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())
    return [" ".join(p) for p in zip(found, found[1:])] or found


#: Pairs of words, and words, of any template.
PAIRS = sorted({p for texts in TEMPLATES.values() for t in texts for p in _bigrams(t)})
WORDS = sorted({w for p in PAIRS for w in p.split(" ")})


def known(w: Column) -> Column:
    """Words with null for those of no template."""
    return F.transform(w, lambda x: F.when(x.isin(WORDS), x))


def shared(k: Column) -> Column:
    """The words and pairs of words that a paragraph, as of known, has in common with any template."""
    pairs = F.zip_with(k, F.slice(k, 2, F.greatest(F.size(k), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.concat(F.filter(k, lambda x: x.isNotNull()), F.filter(pairs, lambda p: p.isin(PAIRS))))


def featured(df: DataFrame) -> DataFrame:
    """df (with parts, as of shared) and their sparse features."""
    return CountVectorizerModel.from_vocabulary([*WORDS, *PAIRS], inputCol="parts", outputCol="features", binary=True).transform(df)


def templates(spark: SparkSession) -> DataFrame:
    rows = [(family, k, text) for family, texts in TEMPLATES.items() for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, "family string, k int, text string").withColumn("words", words(F.col("text")))


def variants(spark: SparkSession) -> DataFrame:
    """Templates with about a tenth of their words left out, each time others; variant 0 is whole."""
    every = templates(spark).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    left = F.filter("words", lambda w, i: (F.col("v") == 0) | (F.pmod(F.xxhash64(w, i, "v", "k"), F.lit(10)) > 0))
    fold = F.pmod(F.xxhash64("family", "k", "v"), F.lit(5))
    return every.select("family", shared(known(left)).alias("parts"), fold.alias("fold"), F.lit(1.0).alias("weight"))


def prose(df: DataFrame, text_col: str = "text") -> DataFrame:
    """parts, fold and n of all lines of df that have words: how many lines have these parts, a fold for equal lines.

    A line with half of any template's 2-grams is no prose and is left out.
    """
    lines = F.filter(F.transform(F.split(F.col(text_col), "\n"), lambda x: words(x)), lambda w: F.size(w) > 0)
    each = df.select(F.explode(lines).alias("words"))
    each = each.select(known(F.col("words")).alias("known"), F.pmod(F.xxhash64("words"), F.lit(5)).alias("fold"))
    each = each.select(F.array_sort(shared(F.col("known"))).alias("parts"), "fold")
    counted = stored(each.groupBy("parts", "fold").agg(F.count("*").alias("n")), "prose")  # so that each is compared once
    every = F.array(*(F.array(*map(F.lit, _bigrams(t))) for texts in TEMPLATES.values() for t in texts))
    like = F.exists(every, lambda t: F.size(F.array_intersect(t, F.col("parts"))) * 2 >= F.size(t))
    return counted.where(~like)


def _may_confirm(parts: Column) -> Column:
    """Whether a template's n-grams can be in a run: CONFIRMED of them take so many of its 2-grams, whatever the words."""
    few, many = set(), set()
    for text in (t for texts in TEMPLATES.values() for t in texts):
        pairs = set(_bigrams(text))
        single = {x for p in pairs for x in p.split(" ")}
        need = CONFIRMED * (len(pairs) + len(single)) - len(single)
        (many if need > 1 else few).update(pairs if need > 0 else single)
    of = lambda some: F.size(F.filter(parts, lambda x: x.isin(sorted(some))))
    return (of(few) > 0) | (of(many) > 1)


def candidates(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row (a number for each row of df), place, rows and parts of lines, and of runs that a template may confirm.

    Paragraphs without any word of a template are left out.
    """
    lines = F.transform(F.split(F.col(text_col), "\n"), lambda x: known(words(x)))
    rows = df.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), lines.alias("lines"))
    rows = rows.select("*", F.flatten("lines").alias("flat")).select("doc_id", "row", "lines", shared(F.col("flat")).alias("own"))
    sizes = F.when(_may_confirm(F.col("own")), F.transform("lines", lambda x: F.size(x)))
    rows = rows.select("doc_id", "row", "lines", sizes.alias("sizes"))  # null where no run of the document can be confirmed

    def reached(at: Column) -> Column:
        """Lines of the run that starts at a line."""
        start = F.struct(F.lit(0).alias("w"), F.lit(0).alias("n"), F.lit(True).alias("on"))

        def more(state: Column, size: Column) -> Column:
            on = state["on"] & (size > 0) & (state["w"] < REACH)
            return F.struct((state["w"] + F.when(on, size).otherwise(0)).alias("w"), (state["n"] + on.cast("int")).alias("n"), on.alias("on"))

        return F.aggregate(F.slice("sizes", at + 1, REACH), start, more, lambda state: state["n"])

    one = F.transform("lines", lambda x, i: F.struct(i.alias("place"), F.lit(1).alias("rows"), shared(x).alias("parts")))
    starts = F.transform("sizes", lambda n, i: F.struct(i.alias("place"), F.when(n < REACH, reached(i)).otherwise(1).alias("rows")))
    runs = F.transform(F.filter(starts, lambda r: r["rows"] > 1), lambda r: F.struct(
        r["place"].alias("place"), r["rows"].alias("rows"), F.flatten(F.slice("lines", r["place"] + 1, r["rows"])).alias("known")
    ))
    runs = F.transform(runs, lambda r: F.struct(r["place"].alias("place"), r["rows"].alias("rows"), shared(r["known"]).alias("parts")))
    runs = F.coalesce(F.filter(runs, lambda r: _may_confirm(r["parts"])), F.filter(one, lambda x: F.lit(False)))
    every = rows.select("doc_id", "row", F.explode(F.concat(F.filter(one, lambda x: F.size(x["parts"]) > 0), runs)).alias("c"))
    return every.select("doc_id", "row", "c.place", "c.rows", "c.parts")


def _chosen(found: DataFrame) -> DataFrame:
    """Confirmed lines, of confirmed runs that overlap in a family the likest and then the last, unknown lines in none."""
    order = F.struct(
        F.when(F.col("family") == "unknown", 2).when(F.col("rows") > 1, 1).otherwise(0).alias("kind"), (-F.col("likeness")).alias("unlike"),
        (-F.col("place")).alias("from_end"), "place", "rows", "family", "score", "likeness",
    )
    grouped = found.where("rows = 1 or family <> 'unknown'").groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(order)).alias("all"))

    def meets(a: Column, x: Column) -> Column:
        apart = (a["place"] >= x["place"] + x["rows"]) | (x["place"] >= a["place"] + a["rows"])
        return ~apart & ((a["family"] == x["family"]) | (x["family"] == "unknown"))

    def taken(so_far: Column, x: Column) -> Column:
        return F.when(F.exists(so_far, lambda a: meets(a, x)), so_far).otherwise(F.concat(so_far, F.array(x)))

    nothing = F.filter("all", lambda x: F.lit(False))
    return grouped.select("doc_id", F.explode(F.aggregate("all", nothing, taken)).alias("x")).select(
        "doc_id", "x.place", "x.family", "x.score", "x.likeness"
    )


@dataclass(frozen=True)
class Classifier:
    model: LogisticRegressionModel
    threshold: float


def train(df: DataFrame, text_col: str = "text") -> Classifier:
    """Fit on variants of the templates and on all lines of df as prose; calibrate on a fifth that is left out."""
    rows = prose(df, text_col)
    total = rows.agg(F.sum("n")).first()[0] or 1
    rows = rows.select(F.lit(PROSE).alias("family"), "parts", "fold", (F.col("n") * (PROSE_WEIGHT / total)).alias("weight"), "n")
    rows = rows.unionByName(variants(df.sparkSession), allowMissingColumns=True)
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    rows = featured(rows.withColumn("label", label.cast("double")))
    fit = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=40, standardization=False, weightCol="weight")
    model = fit.fit(rows.where("fold > 0").select("features", "label", "weight"))
    held = model.transform(rows.where("fold = 0 and label = 0").select("features", "n"))
    steps = held.groupBy((F.ceil(_family_probability() * STEPS) / STEPS).alias("p")).agg(F.sum("n").alias("n"))  # at most STEPS rows
    alarm = F.percentile("p", F.lit(1 - FALSE_ALARMS), F.col("n"))
    return Classifier(model, max(0.5, steps.agg(alarm).first()[0] or 0.0))


def _family_probability() -> Column:
    """Of the likeliest family, prose apart."""
    return F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES) - 1))


def scan(df: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, place (of the first line), family, score and likeness of every paragraph that is taken for a licence.

    family is unknown if the score reaches the threshold and no template of the family confirms it. Null and
    empty texts have no paragraphs; rows of a repeated doc_id each give their own; other columns are left out.
    """
    scored = classifier.model.transform(featured(candidates(df, id_col, text_col)))
    chances = F.slice(vector_to_array("probability"), 2, len(FAMILIES) - 1)
    found = scored.select("doc_id", "row", "place", "rows", "parts", chances.alias("p")).withColumn("score", F.array_max("p"))
    found = found.where(F.col("score") >= classifier.threshold)
    family = F.element_at(F.array(*map(F.lit, FAMILIES[1:])), F.array_position("p", F.col("score")).cast("int"))
    found = found.select("doc_id", "row", "place", "rows", "parts", "score", family.alias("said"))
    whole = templates(df.sparkSession).withColumn("whole", shared(known(F.col("words"))))
    kept = whole.groupBy("family").agg(F.collect_list("whole").alias("templates"))  # a row for each family
    found = found.join(F.broadcast(kept.withColumnRenamed("family", "said")), "said")
    likeness = F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("parts"))) / F.size(t)))
    found = found.withColumn("likeness", likeness)
    family = F.when(F.col("likeness") >= CONFIRMED, F.col("said")).otherwise("unknown")
    return _chosen(found.withColumn("family", family))


def by_document(df: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, families (ascending, joined by commas), n_licences, n_unknown of every doc_id of df."""
    known = F.when(F.col("family") != "unknown", F.col("family"))
    sums = found.groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set(known)), ",").alias("families"), F.count(known).alias("n_licences"),
        F.count(F.when(F.col("family") == "unknown", 1)).alias("n_unknown"),
    )
    ids = df.select(F.col(id_col).alias("doc_id")).distinct()
    named = sums.withColumnRenamed("doc_id", "_id")
    out = ids.join(named, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    return out.fillna({"families": "", "n_licences": 0, "n_unknown": 0})
