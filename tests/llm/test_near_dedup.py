import random
from collections import Counter

import numpy as np
import pytest

from careflow.llm.near_dedup import WORD, classes, deduplicated, joined_up, mixed, signatures, perhaps_among
from careflow.llm.shared import working_folder
from tests.llm.tables import documents, odd_texts, sentence


def test_registers_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    errors = []
    for trial in range(40):
        a = rng.integers(0, 9, 60) * (rng.random(60) < 0.5)
        b = np.where(rng.random(60) < 0.7, a, rng.integers(0, 9, 60))
        names = mixed(np.arange(60, dtype=np.uint64) + np.uint64(1000 * trial + 1))
        sets = [(names[x > 0], x[x > 0]) for x in (a, b)]
        owner = np.repeat([0, 1], [len(s[0]) for s in sets])
        found = signatures(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), owner, 2, 512)
        errors.append((found[0] == found[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 4 * 0.02 / np.sqrt(40) and np.std(errors) < 0.035


def brute(rows, similarity=0.8):
    bags = []
    for _, text in rows:
        w = WORD.findall((text or "").lower())
        n = min(5, len(w))
        bags.append(Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else None)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if bags[a] is None or bags[b] is None:
                same = bags[a] is bags[b] and (rows[a][1] or "") == (rows[b][1] or "")
            else:
                common = (bags[a] & bags[b]).total()
                same = common >= similarity * (bags[a].total() + bags[b].total() - common)
            if same:
                parent[root(a)] = root(b)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    least = lambda g: min((x for x in g if x is not None), default=None)
    return sorted(((doc_id, least(groups[root(i)]), len(groups[root(i)])) for i, (doc_id, _) in enumerate(rows)), key=repr)


def corpus(rng):
    rows = []
    for _ in range(8):
        base = sentence(rng, rng.choice((4, 30, 120))).split()
        for _ in range(rng.randint(1, 15)):
            words = list(base)
            for _ in range(rng.randint(0, len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice("abcdef")
            rows.append((len(rows), " ".join(words)))
    words = sentence(rng, 60).split()
    for _ in range(12):  # a chain: neighbours are alike, its ends are not
        rows.append((len(rows), " ".join(words)))
        words = words[2:] + sentence(rng, 2).split()
    return rows


@pytest.mark.parametrize("block", [300_000, 500])
def test_classes(spark, monkeypatch, block):
    monkeypatch.setattr("careflow.llm.near_dedup.BLOCK", block)
    rng = random.Random(13)
    rows = corpus(rng) + odd_texts(rng)
    docs = documents(spark, rows)
    want = brute(rows)
    assert sorted((tuple(r) for r in classes(docs).select("doc_id", "class_id", "class_size").collect()), key=repr) == want
    first = deduplicated(docs)
    assert first.columns == docs.columns
    assert sorted((r.doc_id for r in first.collect()), key=repr) == sorted((i for i in {c for _, c, _ in want}), key=repr)


def test_components(spark):
    rng = random.Random(14)
    links = {(a, b) for a, b in ((rng.randrange(80), rng.randrange(80)) for _ in range(60)) if a > b} | {(i + 1, i) for i in range(100, 130)}
    parent = {x: x for link in links for x in link}
    for _ in range(200):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = joined_up(spark.createDataFrame(sorted(links), "a long, b long"), working_folder(spark), "test")
    assert {r.node: r.comp for r in got.collect()} == parent


def test_empty_table(spark):
    assert classes(documents(spark, [])).count() == 0 and deduplicated(documents(spark, [])).count() == 0


def test_filter_in_front_of_the_join(spark):
    """All wanted rows pass, and few others."""
    rows = spark.range(20_000).selectExpr("id", "xxhash64(id, 'f') AS fp", "'t' AS text")
    wanted = rows.where("id % 7 = 0").selectExpr("id AS _id", "fp AS _fp")
    got = {r.id for r in perhaps_among(rows, wanted).collect()}
    assert got >= set(range(0, 20_000, 7)) and len(got) < 3000
    assert perhaps_among(rows, wanted.limit(0)).count() == 0
