import random
import sys

import numpy as np

from careflow.llm.lm_scoring import Model, Texts, Words, _blocks, _restored, _squeezed, score, words
from tests.conftest import plan_of
from tests.llm.tables import documents, odd_texts, sentence


def test_no_labels_and_no_documents(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = score(documents(spark, [(1, "a b"), (2, None)]), labels).collect()
    assert all(np.isfinite(r.score) for r in got) and len(got) == 2
    assert score(documents(spark, []), labels).count() == 0


def test_held_out_accuracy(spark, small):
    """Models that saw half of the labels tell good from bad among the other half."""
    docs = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/documents.parquet")
    labels = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/labels.parquet")
    scores = {r.doc_id: r.score for r in score(docs, labels.where("doc_id % 2 = 0")).collect()}
    held = [(scores[r.doc_id], r.quality) for r in labels.where("doc_id % 2 = 1").collect()]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([g < b for g in good for b in bad]) > 0.9


def plain_whole(rows, good, prior=5.0, floor=0.5):
    """The definition on all words, with a labelled document's own counts off the target model."""
    from collections import Counter

    texts = [words(t or "") for _, t in rows]
    pairs = [Counter(zip(["", *w], w, strict=False)) for w in texts]
    size = len({w for t in texts for w in t}) + 1
    total = lambda chosen: sum((pairs[i] for i in chosen), Counter())
    labelled = [i for i, (d, _) in enumerate(rows) if d in good]
    target, everything = total(labelled), total(range(len(rows)))
    least = max(1, min(target.total(), everything.total()))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        both = []
        for model, taken in ((target, i in labelled), (everything, False)):
            scale = least / max(1, model.total())
            rest = model - pairs[i] if taken else model
            after, single = Counter(), Counter()
            for (a, b), n in rest.items():
                after[a] += n
                single[b] += n
            lean = lambda w: prior * (single[w] * scale + floor) / (rest.total() * scale + floor * size)  # noqa: B023, E731
            bits = sum(-np.log2((scale * rest[p] + lean(p[1])) / (scale * after[p[0]] + prior)) * n for p, n in pairs[i].items())
            both.append(bits / len(texts[i]) if texts[i] else 0.0)
        out.append((doc_id, len(texts[i]), *both))
    return sorted(out, key=repr)


def test_against_the_definition(spark):
    rng = random.Random(15)
    rows = [(i, sentence(rng, 30)) for i in range(20)] + odd_texts(rng)
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (3, 0), (904, 1), (None, 1)], "doc_id long, quality int")
    got = sorted((tuple(r)[:4] for r in score(documents(spark, rows), labels).collect()), key=repr)
    want = plain_whole(rows, {1, 2, 904})
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in want], atol=1e-6)


def test_rare_words_keep_their_own_counts(spark):
    """More words than any class could tell apart, each in two documents; scored by the definition on all of them."""
    rng = random.Random(16)
    rows = [(i, " ".join(f"r{n}" for n in rng.sample(range(3000), 150))) for i in range(40)] + odd_texts(rng)
    labels = spark.createDataFrame([(i, 1) for i in range(0, 40, 2)], "doc_id long, quality int")
    got = sorted((tuple(r)[:4] for r in score(documents(spark, rows), labels).collect()), key=repr)
    want = plain_whole(rows, set(range(0, 40, 2)))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in want], atol=1e-6)


def test_repeated_rows_are_scored_each(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    got = score(documents(spark, [(1, "a b c"), (1, "a b c"), (None, "a b")]), labels).collect()
    assert sorted(r.n_words for r in got) == [2, 3, 3]


def test_pairs_move_once_in_blocks(spark):
    """The texts are cut into pairs once, and scores are the same whatever the size of the blocks."""
    rng = random.Random(17)
    rows = [(i, sentence(rng, 200)) for i in range(60)] + odd_texts(rng)
    docs, labels = documents(spark, rows), spark.createDataFrame([(i, 1) for i in range(0, 60, 3)], "doc_id long, quality int")
    want = plain_whole(rows, set(range(0, 60, 3)))
    for at_once in (100, 5000):
        scored = score(docs, labels, at_once=at_once)
        assert plan_of(scored).count("MapInArrow") == 1
        got = sorted((tuple(r)[:4] for r in scored.collect()), key=repr)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2:] for g in got], [w[2:] for w in want], atol=1e-6)


def test_a_block_takes_few_bytes_a_pair():
    rng = random.Random(18)
    texts = Texts()
    for row in range(400):
        texts.rows.append(row)
        texts.is_target.append(row % 3 == 0)
        texts.numbers.append(Words().numbers(sentence(rng, 300)))
    zero = np.zeros(1, np.int64)
    model = Model(zero, (zero, zero), (zero + 400, zero + 400), (1, 1), (1.0, 1.0), 200, 8, 5.0, 0.5)
    parts = [b for b in _blocks(texts, model) if b[2]]
    assert sum(len(c) for b in parts for c in b[3:]) < 8 * sum(b[1] for b in parts)


def test_texts_are_cut_into_words_once(spark):
    """What is worked out after the labels have met the texts reads numbers of words, not texts."""
    docs, labels = documents(spark, [(1, "a b c"), (2, "")]), spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    plan = plan_of(score(docs, labels))
    assert "ReadSchema" in plan and "text:string" not in plan


def test_many_texts_are_cut_as_each_is():
    """All characters, long words and texts without words, cut at once: the same words as by the expression, each with a hash of its own."""
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = ["", "".join(points), "".join(f"a{c}b{c} " for c in points[:0x3100]), "ΑΣ. ΑΣ΄ İx", " \x1c\x85\xa0", "a\0 a\0\0 a", *("é" * n + " " + "x" * n + "-" * n for n in range(70))]
    got = Words().numbers(*texts).tolist()
    want = [w for t in texts for w in (None, *words(t))]
    assert len(got) == len(want) and [n == 0 for n in got] == [w is None for w in want]
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_numbers_come_back_as_they_were():
    """Also none, negative ones, and those of the largest block; none of their bytes is written that no number has."""
    for numbers in ([], [0, 0], [1, 255], [256, 3, 1 << 40], [-1, 5, -(1 << 63)]):
        numbers = np.array(numbers, np.int64)
        assert _restored(_squeezed(numbers)).tolist() == numbers.tolist()
    assert _restored(_squeezed(np.array([-0.5, 2.25])), np.float64).tolist() == [-0.5, 2.25]
    assert len(_squeezed(np.zeros(1000, np.int64))) < 40
