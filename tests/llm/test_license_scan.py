import random
import re

from careflow.llm.license_scan import PHRASES, scan
from tests.llm.tables import documents, odd_texts

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ALPHABET = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
NOTICE = "Licensed under the GNU General Public License, version 3."


def base(text):
    words = WORD.findall((text or "").translate(ALPHABET))
    places = [(i, label) for phrase, label in PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = sorted(i for i, _ in places)
    return len(words), len(at), at[0] if at else None, at[-1] if at else None, ",".join(sorted({x for _, x in places}))


def test_base_counts_and_labels(spark):
    rows = odd_texts(random.Random(3)) + [
        (1, "Released under the MIT License. Also under the mit-license; under the mit License"),
        (2, "Apache License, Version 2.0 and CC BY-NC 4.0"),
        (3, NOTICE),
        (4, "Under the MIT license under the mit"),
        (5, "CC BY NC, cc by nd"),
        (6, "x " * 5000 + "cc by nc"),
        (None, "cc by nc cc by nc"),
        (6, "x " * 5000 + "cc by nc"),
    ]
    got = sorted((tuple(r) for r in scan(documents(spark, rows)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()), key=repr)
    assert got == sorted(((i, *base(t)) for i, t in rows), key=repr)


def test_changed_notices(spark):
    rows = [
        (1, NOTICE),
        (2, "you may not use this file except in full compliance with the License"),  # a word more: neighbouring diagonals
        (3, "you may not use these files unless in compliance with a license"),
        (4, "the license of a file may be used"),
        (5, "Licensed under the GNU Affero General Public License version 3"),
    ]
    got = {r.doc_id: r for r in scan(documents(spark, rows)).collect()}
    assert {i: r.labels for i, r in got.items()} == {1: "gpl-3", 2: "apache-2", 3: "", 4: "", 5: "agpl"}
    assert got[1].score == 1.0 and got[4].score == 0.0 and 0.8 <= got[2].score <= 1


def test_empty_table(spark):
    assert scan(documents(spark, [])).count() == 0
