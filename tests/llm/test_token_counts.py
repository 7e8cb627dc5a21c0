import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from careflow.llm.token_counts import PrefixCounter, prefix_token_counts, token_counts
from tests.llm.tables import documents, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", " ", "  ", "\n", "'ll", "'s", "don't", "<|endoftext|>", "<|", "end", "é", "日本", "🙂", " ", "!!", "123", " x", "\t", "'"]


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_every_prefix(counter, library):
    rng = random.Random(7)
    for _ in range(150):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        want = [len(library.encode(text[:i], add_special_tokens=False)) for i in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == want, text
        for budget in (0, 1, 3, 8):
            assert counter.longest_within(text, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_documents(spark, library):
    rows = odd_texts(random.Random(1)) + [(1, "a<|endoftext|>b" * 400)]
    got = sorted((tuple(r) for r in token_counts(documents(spark, rows), PATH).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=repr)
    n = lambda t: len(library.encode(t or "", add_special_tokens=False))
    assert got == sorted(((i, len((t or "").encode()), n(t), n(t) > 1024) for i, t in rows), key=repr)
    assert token_counts(documents(spark, rows).limit(0), PATH).count() == 0


def test_counts_of_prefixes(spark):
    got = prefix_token_counts(documents(spark, [(1, "hello world"), (2, None)]), PATH).collect()
    assert {r.doc_id: len(r.counts) for r in got} == {1: 12, 2: 1}
