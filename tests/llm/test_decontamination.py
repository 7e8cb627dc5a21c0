import random
import re
from itertools import combinations

from careflow.llm.decontamination import AGREE, MASKS, SHORT, WINDOW, allowed, clean, leaks, short_masks
from tests.llm.tables import documents, odd_texts, sentence


def test_masks_meet_every_window():
    """Whatever words of a window differ, a seed lies on those that agree."""
    for kept in combinations(range(WINDOW), AGREE):
        assert any(set(x + at for x in m) <= set(kept) for m in MASKS for at in range(WINDOW - max(m)))


def test_masks_of_short_items():
    """Whatever allowed words differ, a seed reads none of them, and seeds read at least four words where any may."""
    for size in range(1, WINDOW):
        masks, spare = short_masks(size, WINDOW, AGREE), allowed(size, WINDOW, AGREE)
        assert all(any(not set(m) & set(gone) for m in masks) for gone in combinations(range(size), spare))
        assert len(masks) <= 6 and all(len(m) == min(size, SHORT) for m in masks)


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def brute(rows, items):
    """The best diagonal of each document and item, from all diagonals."""
    out = {}
    for doc_id, text in rows:
        doc = words(text)
        for item_id, item in ((i, words(t)) for i, t in items):
            for d in range(-len(item) + 1, len(doc)):
                at = range(max(0, -d), min(len(item), len(doc) - d))
                same = [doc[d + t] == item[t] for t in at]
                wide = len(same) >= WINDOW and max(sum(same[i : i + WINDOW]) for i in range(len(same) - WINDOW + 1)) >= AGREE
                spare = len(item) // 4 if len(item) > 4 else 0
                if wide or (0 < len(item) < WINDOW and len(same) == len(item) and sum(same) >= len(item) - spare):
                    found = (sum(same), -d, len(same), max(d, 0))
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), found), found)
    return sorted(((*k, v[0], v[2], v[3]) for k, v in out.items()), key=repr)


def case(rng):
    items = [(i, sentence(rng, n)) for i, n in enumerate((20, 40, 12, 8, 5, 3, 30))]
    items += [(30, "two words"), (31, "Two, WORDS"), (32, "rareword"), *((40 + n, sentence(rng, n)) for n in range(4, 12))]
    items += [(20, items[0][1].upper()), (21, None), (22, "")]
    rows = [(i, sentence(rng, 60)) for i in range(10)]
    rows += [(400, "two words"), (401, "a rareword"), (402, "two other words")]
    for i, text in (item for item in items if item[1]):
        for k in range(3):
            changed = text.split()
            for place in rng.sample(range(len(changed)), min(k + 1, len(changed))):
                changed[place] = "other"
            rows.append((1000 + 10 * i + k, sentence(rng, 9) + " " + " ".join(changed) + " " + sentence(rng, 4)))
    for i, (_, text) in enumerate(items[:7]):
        rows.append((100 + i, sentence(rng, 30) + " " + text + ". " + sentence(rng, 30)))
        changed = [w if k % 4 else "other" for k, w in enumerate(text.split())]
        rows.append((200 + i, sentence(rng, 5) + " " + " ".join(changed)))
        rows.append((300 + i, text[len(text) // 2 :] + " " + sentence(rng, 20)))
    return rows, items


def test_against_all_places(spark):
    rng = random.Random(11)
    rows, items = case(rng)
    rows += odd_texts(rng) + [rows[10]]
    benchmark = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, _key string")
    docs = documents(spark, rows)
    got = leaks(docs, benchmark)
    assert sorted((tuple(r) for r in got.drop("_fp").collect()), key=repr) == brute(rows, items)
    flagged = {r[0] for r in brute(rows, items)}
    left = clean(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((i for i, _ in rows if i not in flagged), key=repr)


def test_seeds_in_parts(spark, monkeypatch):
    rows, items = case(random.Random(12))
    monkeypatch.setattr("careflow.llm.decontamination.SEEDS_AT_ONCE", 60)
    got = leaks(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.drop("_fp").collect()), key=repr) == brute(rows, items)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, sentence(random.Random(1), 20))], "item_id long, text string")
    docs = documents(spark, [(1, "a b c")])
    assert leaks(documents(spark, []), items).count() == 0
    assert leaks(docs, items.limit(0)).count() == 0 and clean(docs, items.limit(0)).count() == 1
