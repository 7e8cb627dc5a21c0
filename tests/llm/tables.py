"""Small tables with the cases that every operator has to stand."""

from __future__ import annotations

import random

VOCABULARY = [f"w{i}" for i in range(200)]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def odd_texts(rng: random.Random) -> list[tuple[int | None, str | None]]:
    """Null and empty texts, null and repeated ids, repeated rows, marks only, and a long text."""
    base = sentence(rng, 90)
    return [(900, None), (901, ""), (902, "!!! ###"), (903, "\n \t"), (None, base), (None, base), (904, base), (904, base), (904, "other " + base), (905, sentence(rng, 6000)), (906, "é" * 300), (907, "one two")]


def documents(spark, rows, **columns):
    """Rows (doc_id, text) with further columns, some named like those that operators make."""
    schema = "doc_id long, text string"
    df = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F

    for name, value in ({"n_words": "clash", "_fp": "clash", "key": "clash", "_id": "clash", "node": "clash", "a.b": "clash"} | columns).items():
        df = df.withColumn(name, F.lit(value))
    return df


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
