import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from careflow.llm.packing import encoder, pack
from tests.llm.tables import documents, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_fast_ids_are_the_librarys(spark, small, library):
    encode = encoder(PATH, RANKS, public_tokenizers.PATTERN)
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    texts += ["a<|endoftext|>b", "日本 ñ ʼn 🙂", "\u0085 ​ x", "", "  \n\n x  ", "don't we'LL"]
    for text in texts:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("length", [64, 1024])
def test_round_trip(spark, library, length):
    rows = odd_texts(random.Random(2))
    pieces = [r.asDict() for r in pack(documents(spark, rows).repartition(3), PATH, RANKS, public_tokenizers.PATTERN, length).collect()]
    want = sorted([*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows)
    places = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    at, tokens = 0, []
    for p in places:
        assert p["sequence_id"] * length + p["offset"] == at and p["offset"] + p["length"] <= length
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] and zlib.crc32(ids.tobytes()) == p["ids_crc32"]
        if p["is_start"]:
            assert p["start"] == 0
            tokens.append([])
        assert p["start"] == len(tokens[-1])
        tokens[-1] += ids.tolist()
        assert p["is_end"] == (len(tokens[-1]) == p["doc_tokens"])
        at += p["length"]
    assert sorted(tokens) == want
    rest = at % length
    last = length if not rest or rest & (rest - 1) else rest
    assert {p["padded_length"] for p in places if p["sequence_id"] == (at - 1) // length} == {last}


def test_empty_table(spark):
    assert pack(documents(spark, []), PATH).count() == 0
