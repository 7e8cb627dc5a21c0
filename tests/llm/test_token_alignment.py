import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from careflow.llm import token_alignment
from careflow.llm.queries import BYTE_BPE, BYTE_BPE_RANKS, PIECE_BPE, QUERIES
from careflow.llm.token_alignment import align
from careflow.llm.token_counts import byte_letters
from tests.llm.tables import documents, odd_texts, tuples

A, RANKS, B = (public_tokenizers.path(name) for name in (BYTE_BPE, BYTE_BPE_RANKS, PIECE_BPE))


def brute(rows):
    """The same from the definition: every A token beside every B token, by byte ranges."""
    exact, pieces, letters = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_letters()
    exact.encode_special_tokens = True

    def piece(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    def ranges(parts):
        at, out = 0, []
        for part in parts:
            out.append((at, at + len(part)))
            at += len(part)
        return out

    described, corpus = [], Counter()
    for doc_id, text in rows:
        a, b = (exact.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)) if text else ([], [])
        a_parts, b_parts = [bytes(letters[c] for c in exact.id_to_token(i)) for i in a], [piece(i) for i in b]
        if not text or b"".join(a_parts) != b" " + text.encode() or b"".join(b_parts) != b" " + text.encode():
            described.append((doc_id, [], [], [], ""))
            continue
        a_at, b_at = ranges(a_parts), ranges(b_parts)
        links = [(i, j) for (s, e), i in zip(a_at, a) for (t, f), j in zip(b_at, b) if s < f and t < e]
        cuts = sorted({e for _, e in a_at} & {e for _, e in b_at})
        groups, before = [], 0
        for cut in cuts:
            part = [",".join(str(i) for (s, e), i in zip(where, ids) if before < e <= cut) for where, ids in ((a_at, a), (b_at, b))]
            groups.append("|".join(part))
            before = cut
        corpus.update(links)
        described.append((doc_id, a, b, links, ";".join(groups), len(cuts)))
    top = Counter()
    for (_, j), n in corpus.items():
        top[j] = max(top[j], n)
    out = []
    for doc_id, a, b, links, groups, *n in described:
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((doc_id, len(a), len(b), n[0] if n else 0, len(links), sum(corpus[p] == top[p[1]] for p in links), sum(corpus[p] for p in links), sha))
    return sorted(out, key=repr)


TEXTS = [
    "Hello  world, naïve café\n\tdone", "<|endoftext|> and <s> </s> <unk>", "a ▁ b", "日本語 🙂 text", "\x00\x7f", " ", "  two", "ﬁ ①", "x" * 300, "١٢٣ ٤", "á   b",
]


@pytest.mark.parametrize("small_slices", [False, True])
def test_against_all_pairs(spark, small_slices):
    rng = random.Random(13)
    rows = [(i, t if t is None or len(t) < 3000 else t[:3000]) for i, t in odd_texts(rng)] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    rows += [(200 + i, " ".join(rng.choice(["Hello", "world", "naïve", "done,", "été"]) for _ in range(30))) for i in range(40)]
    if small_slices:  # of nine documents, each one a run of its own
        tokenizers = token_alignment.sides(A, RANKS, public_tokenizers.PATTERN, B)
        batches = []
        for number, at in enumerate(range(0, len(rows), 9)):
            part = token_alignment.Slice()
            for doc_id, value in rows[at : at + 9]:
                part.add(tokenizers, [(doc_id, tokenizers.encoded(value or ""))])
            batches.append(part.rows(number))
        spills = spark.createDataFrame([r for b in batches for r in b.to_pylist()], "slice long, radix int, runs array<binary>")
        partial = token_alignment.slice_counts(spills)
        counted = partial.select("slice", "pair").join(token_alignment.pair_counts(partial), "pair")
        got = spills.groupBy("slice").cogroup(counted.groupBy("slice")).applyInArrow(token_alignment.contributed, token_alignment.SCHEMA)
        assert any(len(r) > 2 for b in batches for r in b.column(2).to_pylist())
    else:
        got = align(documents(spark, rows).repartition(5), A, B, RANKS, public_tokenizers.PATTERN)
    assert tuples(got, "*") == brute(rows)


def test_without_ranks_and_empty(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    assert tuples(align(documents(spark, rows), A, B), "*") == brute(rows)
    assert align(documents(spark, []), A, B).count() == 0
    assert tuples(align(documents(spark, [(1, None), (None, "")]), A, B), "*") == sorted([(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")], key=repr)


def test_a_run_comes_back():
    run = token_alignment.Run(*(token_alignment.np.array(v, token_alignment.np.int64) for v in ([5, 1 << 30, (1 << 31) - 7], [1, 2, 1], [4, 4, 9, 0], [3, 1, 1, 70000])))
    back = token_alignment.Run.read(run.spilled())
    assert [v.tolist() for v in vars(back).values()] == [v.tolist() for v in vars(run).values()] and back.totals().tolist() == [3, 2, 70000]


def test_query(spark, small):
    """Counts of the corpus against the definition, on the table's shorter texts; of all texts the sums agree."""
    got = QUERIES["op13_token_alignment"](spark, small)
    rows = tuples(got, "*")
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs) and all(r[4] == r[1] + r[2] - r[3] and r[5] <= r[4] <= r[6] for r in rows)
    short = [(r.doc_id, r.text) for r in docs if len(r.text or "") < 1500]
    table = align(documents(spark, short), A, B, RANKS, public_tokenizers.PATTERN)
    assert tuples(table, "*") == brute(short)
