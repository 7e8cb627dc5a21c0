import hashlib
import random
from collections import Counter

import pytest

from careflow.llm import suffix_dedup
from careflow.llm.suffix_dedup import measure, without_repeats
from tests.llm.tables import documents, odd_texts


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    often = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, data, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if often[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def corpus(rng):
    letters = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    shared = [letters(rng.randint(20, 400)) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [rng.choice(shared)[rng.choice((0, 0, 5)) :] if rng.random() < 0.4 else letters(rng.randint(1, 300)) for _ in range(rng.randint(0, 6))]
        rows.append((i, "".join(parts)))
    return [*rows, (500, "a" * 1500), (501, "a" * 200), (502, "ab" * 400), (503, shared[0] * 3), (504, letters(47) * 9), rows[3], rows[3]]


@pytest.mark.parametrize(("length", "gram"), [(200, 110), (40, 24), (8, 8)])
def test_against_all_strings(spark, length, gram):
    rng = random.Random(length)
    rows = corpus(rng) + odd_texts(rng) + [((1 << 60) + 1, "q" * 250), ((1 << 60) + 2, "r" * 250)]
    assert sorted((tuple(r) for r in measure(documents(spark, rows), length, gram).collect()), key=repr) == brute(rows, length)


def test_blocks_and_split_runs(spark, monkeypatch):
    """Runs across bucket ends, and texts longer than a block."""
    rng = random.Random(9)
    rows = corpus(rng)
    one = rng.choice("xyz") * 100
    rows += [(1000 + i, "".join(rng.choice("klmno") for _ in range(30)) + one + "".join(rng.choice("klmno") for _ in range(30))) for i in range(60)]
    long = list(suffix_dedup.stretches(("".join(rng.choice("ab") for _ in range(3000))).encode(), 40, 24))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1024)
    parts = list(suffix_dedup.stretches(("".join(rng.choice("ab") for _ in range(3000))).encode(), 40, 24))
    assert len(long) == 1 and len(parts) == 3 and [p[2][0] for p in parts] == [0, 1024, 2048]
    monkeypatch.undo()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted((tuple(r) for r in measure(documents(spark, rows), 40, 24).collect()), key=repr) == brute(rows, 40)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_texts(spark):
    passage = "é" * 150
    docs = documents(spark, [(1, "head " + passage + " tail"), (2, passage + "!"), (3, None), (4, "short")])
    left = without_repeats(docs)
    assert left.columns == docs.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: "head  tail", 2: "!", 3: None, 4: "short"}


def test_empty_table(spark):
    assert measure(documents(spark, [])).count() == 0


def test_many_equal_rows(spark):
    """Rows that agree in id and text are worked out once, so their number does not multiply the work."""
    rng = random.Random(10)
    text = "".join(rng.choice("abcdefgh") for _ in range(2220))
    mixed = text[:600] + "".join(rng.choice("xyz") for _ in range(500))
    rows = [(None, text)] * 2000 + [(7, mixed)] * 3 + [(8, mixed[300:]), (None, "q" * 100)]
    got = Counter(tuple(r) for r in measure(documents(spark, rows)).collect())
    assert got == Counter(brute([*rows[:2], *rows[2000:]], 200)) + Counter({r: 1998 for r in brute([rows[0], rows[1]], 200)[:1]})
    left = without_repeats(documents(spark, rows).repartition(7))
    assert left.count() == len(rows) and left.where("text = ''").count() == 2004
