import random
import re
from collections import Counter

from careflow.llm.quality_rules import accepted, rate
from tests.llm.tables import documents, odd_texts, sentence


def counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def table(rng):
    clean = [(i, "\n".join(sentence(rng, 12) for _ in range(8)).replace("w1", "x1")) for i in range(40)]
    junk = [(100 + i, " ".join(w + "###" for w in sentence(rng, 90).split())) for i in range(6)]
    shouts = [(200 + i, sentence(rng, 90).upper().replace("W", "WW")) for i in range(4)]
    again = [(300, "same three words here " * 40), (301, "a b c " * 60), (302, "one line\n" * 30 + sentence(rng, 100))]
    return clean, junk, shouts, again


def test_counts(spark):
    rng = random.Random(4)
    rows = [r for part in table(rng) for r in part] + odd_texts(rng)
    got = sorted((tuple(r) for r in rate(documents(spark, rows, lang="en", source="s")).drop("kept").collect()), key=repr)
    assert got == sorted(((i, *counts(t)) for i, t in rows), key=repr)


def test_verdicts(spark):
    clean, junk, shouts, again = table(random.Random(5))
    docs = documents(spark, clean + junk + shouts + again, lang="en", source="s")
    verdict = {r.doc_id: r.kept for r in rate(docs).collect()}
    assert all(verdict[i] for i, _ in clean)
    assert not any(verdict[i] for i, _ in junk + shouts) and not verdict[300]
    kept = accepted(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, good in verdict.items() if good)


def test_without_groups(spark):
    rows = table(random.Random(6))[0]
    assert rate(documents(spark, rows)).where("kept").count() == len(rows)
    assert rate(documents(spark, rows, lang=None, source=None)).where("kept").count() == len(rows)
    assert rate(documents(spark, [])).count() == 0 and accepted(documents(spark, [])).count() == 0
    twice = documents(spark, [*rows, rows[0]])
    assert accepted(twice).count() == len(rows) + 1


def test_a_hot_source_loosens_no_other(spark):
    """A source with a third of a language's rows and many symbols; the others, large and small, keep their limits."""
    rng = random.Random(7)
    text = lambda symbols: " ".join(w + "#" * (i < symbols) for i, w in enumerate(sentence(rng, 100).split()))
    rows = [(i, text(0), f"s{i % 4}") for i in range(160)]  # four large sources
    rows += [(1000 + i, text(0), f"t{i}") for i in range(20)]  # sources of one document
    rows += [(2000 + i, text(30), "hot") for i in range(90)]
    rows += [(3000 + i, text(80), f"s{i}") for i in range(4)] + [(3100, text(80), "t0"), (3101, text(80), "new")]
    docs = spark.createDataFrame([(i, t, "en", s) for i, t, s in rows], "doc_id long, text string, lang string, source string")
    verdict = {r.doc_id: r.kept for r in rate(docs).collect()}
    assert {i for i, good in verdict.items() if not good} == {3000, 3001, 3002, 3003, 3100, 3101}


def test_small_sources_together(spark):
    """Enough small sources have the quartiles of their own pool, whatever the large one is like."""
    rng = random.Random(8)
    text = lambda symbols: " ".join(w + "#" * (i < symbols) for i, w in enumerate(sentence(rng, 100).split()))
    rows = [(i, text(0), f"t{i}") for i in range(120)] + [(2000 + i, text(30), "hot") for i in range(60)] + [(3000, text(80), "u")]
    docs = spark.createDataFrame([(i, t, "en", s) for i, t, s in rows], "doc_id long, text string, lang string, source string")
    assert [r.doc_id for r in rate(docs).where("NOT kept").collect()] == [3000]
