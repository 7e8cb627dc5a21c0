"""License scan by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from careflow.llm.shared import fingerprint, text_of

#: Phrases that must stand word for word, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Sentences of license notices, which may be found with small changes.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("it under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved"),
)

#: Words of a rolling gram, diagonals that may lie between neighbours, and the least share of a notice.
GRAM, SHIFT, COVER = 3, 2, 0.8

#: Runs of these characters part words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased: runs of a-z, 0-9 and characters beyond ASCII."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, BETWEEN), "")


def grams(spark: SparkSession, phrases: tuple[tuple[str, str], ...], notices: tuple[tuple[str, str], ...]) -> DataFrame:
    """One row for each rolling gram of each template. Its size is that of the two fixed lists."""
    rows = []
    for number, (phrase, label) in enumerate((*phrases, *notices)):
        w = phrase.split(" ")
        rows += [(number, number < len(phrases), label, len(w), at, *w[at : at + GRAM]) for at in range(len(w) - GRAM + 1)]
    table = spark.createDataFrame(rows, "_template int, _base boolean, _label string, _size int, _tpos int, _g0 string, _g1 string, _g2 string")
    return table.withColumn("_hash", F.xxhash64("_g0", "_g1", "_g2"))


def votes(docs: DataFrame, templates: DataFrame, text: str = "text") -> DataFrame:
    """Every place where a rolling gram of a document stands in a template, by row, template and diagonal.

    The words stay beside the exploded positions within one generated stage, so that hashes, join and the comparison
    of the words themselves need no shuffle; only matches leave it.
    """
    rows = docs.select("doc_id", fingerprint(text).alias("_fp"), words(text_of(text)).alias("_words"))
    at = rows.select("doc_id", "_fp", "_words", F.posexplode_outer("_words").alias("_pos", "_w0"))
    second, third = F.get("_words", F.col("_pos") + 1), F.get("_words", F.col("_pos") + 2)
    at = at.select("doc_id", "_fp", "_pos", "_w0", second.alias("_w1"), third.alias("_w2"), F.xxhash64("_w0", second, third).alias("_key"))
    same = (at["_key"] == templates["_hash"]) & (at["_w0"] == templates["_g0"]) & (at["_w1"] == templates["_g1"]) & (at["_w2"] == templates["_g2"])
    hits = at.join(F.broadcast(templates), same)
    place = ("doc_id", "_fp", "_template", "_base", "_label", "_size")
    return hits.groupBy(*place, (F.col("_pos") - F.col("_tpos")).alias("_diagonal")).agg(F.collect_set("_tpos").alias("_tposes"))


def spans(voted: DataFrame, shift: int = SHIFT) -> DataFrame:
    """Neighbouring diagonals as one span, with the share of the template's words that the votes cover."""
    one = Window.partitionBy("doc_id", "_fp", "_template").orderBy("_diagonal")
    apart = F.coalesce(F.col("_diagonal") - F.lag("_diagonal").over(one) > shift, F.lit(True))
    parted = voted.withColumn("_apart", apart.cast("int")).withColumn("_span", F.sum("_apart").over(one.rowsBetween(Window.unboundedPreceding, 0)))
    merged = parted.groupBy("doc_id", "_fp", "_template", "_base", "_label", "_size", "_span").agg(
        F.array_distinct(F.flatten(F.collect_list("_tposes"))).alias("_tposes"),
        F.count(F.lit(1)).alias("_diagonals"),
        F.min(F.col("_diagonal") + F.array_min("_tposes")).alias("_from"),
        F.max(F.col("_diagonal") + F.array_max("_tposes") + GRAM - 1).alias("_to"),
    )
    covered = F.array_distinct(F.flatten(F.transform("_tposes", lambda t: F.array(t, t + 1, t + 2))))
    return merged.withColumn("_cover", F.size(covered) / F.col("_size"))


def best(found: DataFrame) -> DataFrame:
    """Of notices whose spans overlap, as those of one license family do, the best covered one, then that on fewest diagonals, then the longest."""
    one = Window.partitionBy("doc_id", "_fp").orderBy("_from", "_to", "_template").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("_from") > F.max("_to").over(one), F.lit(True)).cast("int")
    running = Window.partitionBy("doc_id", "_fp").orderBy("_from", "_to", "_template").rowsBetween(Window.unboundedPreceding, 0)
    grouped = found.withColumn("_apart", apart).withColumn("_group", F.sum("_apart").over(running))
    order = Window.partitionBy("doc_id", "_fp", "_group").orderBy(F.desc("_cover"), "_diagonals", F.desc("_size"), "_template")
    return grouped.withColumn("_rank", F.row_number().over(order)).where("_rank = 1")


def scan(
    docs: DataFrame,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    shift: int = SHIFT,
    cover: float = COVER,
    text: str = "text",
) -> DataFrame:
    """Licenses named in each document.

    Every rolling 3-word gram of a document that equals a template's gram votes for the diagonal of their positions.
    A phrase of ``phrases`` stands where one diagonal has all its grams: these places give ``n_base``, ``first_word``,
    ``last_word`` and ``base_labels``. For ``notices``, diagonals up to ``shift`` apart merge to a span, which counts
    where its votes cover at least ``cover`` of the notice's words and no overlapping span is covered better; these
    labels and the base ones make ``labels``, and ``score`` is the best share, 0 without one. Templates have at least three words.

    Each input row gives one row. A null text is an empty one: no words, no labels. Rows that repeat are each given
    in full; ids may repeat or be null. Columns of the input other than doc_id and the text are left out. Text length
    is not bounded: positions are rows. An empty table gives an empty result.
    """
    templates = grams(docs.sparkSession, phrases, notices)
    voted = votes(docs, templates, text)
    whole = F.col("_base") & (F.size("_tposes") == F.col("_size") - GRAM + 1)
    key = ("doc_id", "_fp")
    base = voted.where(whole).groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n_base"), F.min("_diagonal").alias("_first"), F.max("_diagonal").alias("_last"), F.collect_set("_label").alias("_base_set")
    )
    found = best(spans(voted.where(~F.col("_base")), shift).where(F.col("_cover") >= cover))
    noticed = found.groupBy(*key).agg(F.max("_cover").alias("_cover"), F.collect_set("_label").alias("_set"))
    both = base.unionByName(noticed, allowMissingColumns=True).groupBy(*key)
    hits = both.agg(*(F.max(c).alias(c) for c in ("_n_base", "_first", "_last", "_base_set", "_cover", "_set"))).select(
        F.col("doc_id").alias("_id"),
        F.col("_fp").alias("_hit"),
        "_n_base",
        "_first",
        "_last",
        "_base_set",
        "_set",
        F.when(F.col("_n_base") > 0, 1.0).otherwise(F.col("_cover")).alias("_score"),
    )
    rows = docs.select("doc_id", fingerprint(text).alias("_fp"), F.size(words(text_of(text))).cast("long").alias("n_words"))
    joined = rows.join(hits, rows["doc_id"].eqNullSafe(hits["_id"]) & (rows["_fp"] == hits["_hit"]), "left")
    none = F.array().cast("array<string>")
    base_set, own_set = F.coalesce("_base_set", none), F.coalesce("_set", none)
    return joined.select(
        rows["doc_id"].alias("doc_id"),
        "n_words",
        F.coalesce("_n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("_first").cast("long").alias("first_word"),
        F.col("_last").cast("long").alias("last_word"),
        F.array_join(F.sort_array(base_set), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base_set, own_set)), ",").alias("labels"),
        F.coalesce("_score", F.lit(0.0)).alias("score"),
    )
