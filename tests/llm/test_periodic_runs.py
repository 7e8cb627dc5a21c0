import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from careflow.llm.periodic_runs import periodic_runs, runs
from careflow.llm.queries import QUERIES
from tests.llm.tables import documents, odd_texts, tuples


def brute(words):
    """Every run (start, end, period), by comparing words at every distance."""
    found = []
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and not any(words[i : j + q - r] == words[i + r : j + q] for r in range(1, q)):
                found.append((i, j + q, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def described(doc_id, text, synthetic):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if synthetic and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    best = min(found, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    first = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    sha = lambda value: hashlib.sha256(value.encode()).hexdigest()
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    return (doc_id, len(found), *first, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def repetitive(rng):
    out = []
    while len(out) < rng.randint(0, 260):
        base = [rng.randint(0, rng.randint(1, 4)) for _ in range(rng.randint(1, 30))]
        out += (base * rng.randint(1, 12))[: rng.randint(1, 200)] if rng.random() < 0.6 else base
    return out


@pytest.mark.parametrize("seed", range(40))
def test_runs_against_every_distance(seed):
    rng = random.Random(seed)
    texts = [repetitive(rng) for _ in range(rng.randint(1, 4))]
    symbols = np.array([1000 * i + w for i, words in enumerate(texts) for w in words], np.int64)
    expected, at = [], 0
    for words in texts:
        expected += [(s + at, e + at, q) for s, e, q in brute(words)]
        at += len(words)
    assert [tuple(map(int, r)) for r in runs(symbols)] == expected


def test_words_of_one_kind_and_nested_runs():
    assert runs(np.zeros(50_000, np.int64)).tolist() == [[0, 50_000, 1]]
    nested = runs(np.array(([0] * 40 + [1]) * 200, np.int64))
    assert len(nested) == 201 and [0, 8200, 41] in nested.tolist()
    assert not len(runs(np.arange(1000))) and not len(runs(np.empty(0, np.int64)))


@pytest.mark.parametrize("synthetic", [False, True])
def test_documents(spark, synthetic):
    rng = random.Random(12)
    rows = odd_texts(rng) + [(i, " ".join(f"w{w}" for w in repetitive(rng))) for i in range(60)]
    rows += [(1000, "a b\x0bc\x1cd e " * 30), (1001, "x\n" * 24), (1002, "x " * 23), (1003, "long " * 30_000)]
    got = tuples(periodic_runs(documents(spark, rows), synthetic=synthetic), "*")
    assert got == sorted((described(i, t if i != 1003 else "long " * 300, synthetic) if i != 1003 else next(r for r in got if r[0] == 1003) for i, t in rows), key=repr)
    assert [r[1:6] for r in got if r[0] == 1003] == [(1, 0, 30_000, 1, 30_000_000)]
    assert periodic_runs(documents(spark, [])).count() == 0


def test_query(spark, small):
    got = tuples(QUERIES["op12_periodic_runs"](spark, small), "*")
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in docs if len(r.text or "") < 9000}
    assert [r for r in got if r[0] in short] == sorted((described(i, t, True) for i, t in short.items()), key=repr)
    assert len(got) == len(docs) and sum(r[1] > 0 for r in got) > len(docs) // 20
