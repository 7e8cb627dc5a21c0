"""Exact token counts at every prefix of a text, for byte-level BPE vocabularies of the ``tokenizers`` library.

The last token of every prefix of a word is found by dynamic programming: a vocabulary entry that ends at a prefix
is its last token if the prefix before it ends in a token that keeps apart from the entry when both are merged.
The count at a prefix is then one more than the count where its last token begins. Words of a text are encoded on
their own, so the count at a prefix of a text is the sum of its whole words and the count inside its last word.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.shared import text_of

#: Words kept with their counts per Python worker; beyond that the memory starts anew. Results do not depend on it.
REMEMBERED_WORDS = 700_000

#: Fixed values of byte-level BPE: the pattern that cuts a text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, by the rule of byte-level BPE."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in own}
    rest = [b for b in range(256) if b not in set(own)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts the tokens of every prefix of a text without encoding any prefix."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        as_bytes = lambda word: bytes(letters[c] for c in word)
        specials = {t["content"] for t in spec["added_tokens"]}
        vocabulary = {as_bytes(w): i for w, i in spec["model"]["vocab"].items() if w not in specials}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        #: Entries that are what their own bytes merge to, with their ids; others never occur in an encoded text.
        self.ids = {w: i for w, i in vocabulary.items() if self._merged(w) == [w]}
        self.entries = {i: w for w, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.word = regex.compile(WORD_PATTERN)
        self.words: dict[str, int] = {}
        self._apart: dict[int, bool] = {}

    def _merged(self, word: bytes) -> list[bytes]:
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranks = [self.rank.get(pair, len(self.rank)) for pair in zip(parts, parts[1:], strict=False)]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == len(self.rank):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _keeps_apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay these two when their bytes are merged."""
        if len(self._apart) >= REMEMBERED_WORDS:
            self._apart.clear()
        a, b = self.entries[left], self.entries[right]
        known = self._apart[left << 32 | right] = self._merged(a + b) == [a, b]
        return known

    def word_prefixes(self, word: bytes) -> list[int]:
        """Token counts of the prefixes of one word, by bytes; the first is 0."""
        counts, last, find, apart = [0], [0], self.ids.get, self._apart.get
        longest = self.longest
        for end in range(1, len(word) + 1):
            for begin in range(end - 1, end - longest - 1 if end > longest else -1, -1):
                token = find(word[begin:end])
                if token is None:
                    continue
                if begin:
                    fits = apart(last[begin] << 32 | token)
                    if not (self._keeps_apart(last[begin], token) if fits is None else fits):
                        continue
                counts.append(counts[begin] + 1)
                last.append(token)
                break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return counts

    def word_count(self, word: str) -> int:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= REMEMBERED_WORDS:
                self.words.clear()
            known = self.words[word] = self.word_prefixes(word.encode())[-1]
        return known

    def _parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between special tokens, and the special tokens."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            yield text[at : found.start()], False
            yield found.group(), True
            at = found.end()
        yield text[at:], False

    def _cut(self, text: str) -> tuple[list[str], list[int]]:
        """The words and special tokens of a text and the token count of each."""
        words: list[str] = []
        counts: list[int] = []
        for part, special in self._parts(text):
            found = [part] if special else self.word.findall(part)
            words += found
            if special:
                counts.append(1)
            else:
                known = list(map(self.words.get, found))
                counts += [self.word_count(w) if n is None else n for w, n in zip(found, known, strict=True)] if None in known else known
        return words, counts

    def count(self, text: str) -> int:
        return sum(self._cut(text)[1])

    def pieces(self, text: str) -> list[tuple[int, int]]:
        """Ends of the words and special tokens of a text, in code points, each with the token count up to there."""
        words, counts = self._cut(text)
        return [(0, 0), *zip(accumulate(map(len, words)), accumulate(counts), strict=True)]

    def prefix_counts(self, text: str) -> np.ndarray:
        """Token counts of ``text[:0]``, ``text[:1]`` ... ``text``.

        A prefix that ends inside a word is that word cut short. White space at the end of a prefix, and a special
        token cut short, may join the word before, so those few ends are cut into words again from one word earlier.
        """
        ends = self.pieces(text)
        counts = np.zeros(len(text) + 1, np.int64)
        for k in range(1, len(ends)):
            counts[ends[k - 1][0] + 1 : ends[k][0] + 1] = self._inside(text, ends, k)
        return counts

    def _inside(self, text: str, ends: list[tuple[int, int]], k: int) -> list[int]:
        (begin, before), (end, total) = ends[k - 1], ends[k]
        word = text[begin:end]
        if self.special and self.special.fullmatch(word):
            return [self._joined(text, ends, k, i) for i in range(begin + 1, end)] + [total]
        by_byte = self.word_prefixes(word.encode())
        out, size = [], 0
        for i, letter in enumerate(word, begin + 1):
            size += len(letter.encode())
            blank = word[: i - begin].isspace()
            if i == end and not blank:
                out.append(total)
            elif blank or word[0] == "'" or self.word.match(word, 0, i - begin).end() < i - begin:
                out.append(self._joined(text, ends, k, i))
            else:
                out.append(before + by_byte[size])
        return out

    def _joined(self, text: str, ends: list[tuple[int, int]], k: int, i: int) -> int:
        j = max(0, k - 2)
        if j < k - 1 and self.special and self.special.fullmatch(text[ends[j][0] : ends[j + 1][0]]):
            j += 1
        return ends[j][1] + self.count(text[ends[j][0] : i])

    def longest_within(self, text: str, budget: int) -> int:
        """The most code points of a prefix of at most ``budget`` tokens."""
        return self.count_and_cut(text, budget)[1]

    def count_and_cut(self, text: str, budget: int) -> tuple[int, int]:
        """The token count of a text, and the most code points of a prefix of at most ``budget`` tokens."""
        words, counts = self._cut(text)
        if (total := sum(counts)) <= budget:
            return total, len(text)
        sums = list(accumulate(counts))
        k = bisect_right(sums, budget)
        # white space after that word may join the one before it and so fit again
        ends = [(0, 0), *zip(accumulate(map(len, words[: k + 2])), sums, strict=False)]
        best = ends[k][0]
        for j in range(k + 1, len(ends)):
            for i, n in enumerate(self._inside(text, ends, j), ends[j - 1][0] + 1):
                best = i if n <= budget else best
        return total, best


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    """One counter per Python worker and vocabulary."""
    return PrefixCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """Adds to each document ``n_bytes``, ``n_tokens``, ``over_limit`` and ``chars_in_limit``.

    ``chars_in_limit`` is the longest prefix, in code points, of at most ``limit`` tokens. A null text counts as an
    empty one: 0 bytes, 0 tokens. Repeated rows are counted each. Only doc_id is carried over from the input, so other
    columns, whatever their names, do no harm. An empty table gives an empty result.
    """

    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = counter(path)
        for batch in batches:
            rows = [counts.count_and_cut(value, limit) for value in batch]
            yield pd.DataFrame(rows, columns=["n_tokens", "chars"])

    measured = F.pandas_udf(measure, "n_tokens long, chars long")
    return (
        docs.select("doc_id", text_of(text).alias("_text"))
        .select("doc_id", F.octet_length("_text").cast("long").alias("n_bytes"), measured("_text").alias("_m"))
        .select("doc_id", "n_bytes", "_m.n_tokens", (F.col("_m.n_tokens") > limit).alias("over_limit"), F.col("_m.chars").alias("chars_in_limit"))
    )


def prefix_token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """doc_id and ``counts``, the token counts of the text's prefixes by code points, from the empty one on."""

    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = counter(path)
        for batch in batches:
            yield pd.Series([counts.prefix_counts(value) for value in batch])

    return docs.select("doc_id", F.pandas_udf(measure, "array<long>")(text_of(text)).alias("counts"))
