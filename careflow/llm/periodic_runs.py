"""Periodic runs of words, found by internal pattern matching.

Words of a batch of documents form one row of symbols, in which equal words of different documents differ. Prefix
doubling sorts its suffixes and leaves, for each power of two, the identity of every block of that length. A run of
period q and length 3 q or more holds a dyadic block (one that begins at a multiple of its length) of q / 2 to q words
together with its copy q words later. So each block asks where it occurs next in the window of the periods of its level: its
occurrences are a range of the suffix array, and a wavelet matrix over that array answers range successor. Occurrences
within a window as long as the block form a progression, whose members are the candidate periods. Comparing blocks of
decreasing length extends a candidate to both sides.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.shared import text_of

MIN_LENGTH, MIN_PERIODS = 24, 3

#: Lowest level: blocks of 8 words, whose window has all periods below 16. A run of 24 words holds such a block and its copy.
FIRST = 3

#: Words of a batch of documents sorted together; a longer document is a batch of its own.
BATCH_WORDS = 200_000

#: Candidates extended at once.
AT_ONCE = 1_000_000

SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


class Blocks:
    """Identities of all blocks of power-of-two length of a row of symbols, and its suffix array.

    ``ranks[k]`` has, for each place, the first place of the suffix array whose suffix begins with the same 2**k symbols. No
    two places have equal blocks above the last level.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        n = self.size = len(symbols)
        self.suffixes = np.argsort(symbols, kind="stable")
        slots = np.arange(n)
        rank = np.full(n + 1, -1, np.int64)  # one more: the end differs from every place
        places = self.suffixes.copy()
        keys = symbols[places]
        self.ranks: list[np.ndarray] = []
        step = 0
        while True:
            fresh = np.ones(len(keys), bool)
            fresh[1:] = keys[1:] != keys[:-1]
            first = np.flatnonzero(fresh)
            group = np.cumsum(fresh) - 1
            rank[places] = slots[first][group]
            self.suffixes[slots] = places
            self.ranks.append(rank.copy())
            several = np.diff(np.append(first, len(keys)))[group] > 1
            places, slots = places[several], slots[several]
            if not len(places):
                return
            step = step * 2 or 1
            keys = rank[places] * (n + 1) + rank[np.minimum(places + step, n)] + 1
            order = np.argsort(keys, kind="stable")
            places, keys = places[order], keys[order]

    def ahead(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``left`` and ``right``."""
        size = np.zeros(len(left), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            a, b = np.minimum(left + size, self.size), np.minimum(right + size, self.size)
            size += (self.ranks[k][a] == self.ranks[k][b]).astype(np.int64) << k
        return size

    def behind(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Length of the common suffix of what lies before ``left`` and before ``right``; ``left`` is the smaller one."""
        size = np.zeros(len(left), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            a, b = left - size - (1 << k), right - size - (1 << k)
            inside = a >= 0
            same = self.ranks[k][np.where(inside, a, 0)] == self.ranks[k][np.where(inside, b, 1)]
            size += (inside & same).astype(np.int64) << k
        return size


class WaveletMatrix:
    """Range successor over an array of numbers, bit by bit."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, np.int64)
            np.cumsum(~ones, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate((values[~ones], values[ones]))

    def below(self, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many of the values at ``lo`` to ``hi`` are less than ``limit``."""
        lo, hi, n = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        whole = limit >> self.bits > 0
        n[whole] = (hi - lo)[whole]
        for bit, before in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            a, b = before[lo], before[hi]
            ones = (limit >> bit & 1).astype(bool)
            n += np.where(ones & ~whole, b - a, 0)
            lo, hi = np.where(ones, before[-1] + lo - a, a), np.where(ones, before[-1] + hi - b, b)
        return n

    def smallest(self, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value at ``lo`` to ``hi`` that has ``rank`` smaller ones there; ``rank`` is below their number."""
        lo, hi, rank, value = lo.copy(), hi.copy(), rank.copy(), np.zeros(len(lo), np.int64)
        for bit, before in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            a, b = before[lo], before[hi]
            ones = rank >= b - a
            rank -= np.where(ones, b - a, 0)
            value |= ones.astype(np.int64) << bit
            lo, hi = np.where(ones, before[-1] + lo - a, a), np.where(ones, before[-1] + hi - b, b)
        return value


def candidates(blocks: Blocks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods such that the block at the place stands again one period later, by levels and parts."""
    if len(blocks.ranks) <= FIRST:
        return
    ranks = blocks.ranks[FIRST][:-1]
    sizes = np.bincount(ranks, minlength=blocks.size)
    often = sizes[ranks[blocks.suffixes]] > 1  # places of the suffix array whose lowest blocks repeat
    matrix = WaveletMatrix(blocks.suffixes[often])
    compact = np.concatenate(([0], np.cumsum(often)))
    for k in range(FIRST, len(blocks.ranks)):
        level = blocks.ranks[k][:-1]
        sizes = np.bincount(level, minlength=blocks.size)
        at = np.arange(0, blocks.size, 1 << k)
        at = at[sizes[level[at]] > 1]
        lo, hi = compact[level[at]], compact[level[at] + sizes[level[at]]]
        nearest = 1 if k == FIRST else 1 << k
        smaller = matrix.below(lo, hi, at + nearest)
        n = matrix.below(lo, hi, at + (2 << k)) - smaller
        found = n > 0
        at, lo, hi, smaller, n = at[found], lo[found], hi[found], smaller[found], n[found]
        first = matrix.smallest(lo, hi, smaller)
        if k == FIRST:  # a window of two lengths: its few occurrences one by one
            for i in range(int(n.max(initial=0))):
                more = n > i
                yield at[more], matrix.smallest(lo[more], hi[more], smaller[more] + i) - at[more]
            continue
        several = n > 1
        difference = np.ones(len(at), np.int64)
        difference[several] = matrix.smallest(lo[several], hi[several], smaller[several] + 1) - first[several]
        # Members within the block's own run of a smaller period have multiples of that period and give the same run.
        own = np.zeros(len(at), np.int64)
        own[several] = at[several] + difference[several] + blocks.ahead(at[several], at[several] + difference[several])
        skipped = np.where(several & (own >= at + (1 << k) + difference), np.clip((own - (1 << k) - first) // difference + 1, 0, n), 0)
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(n - skipped) // AT_ONCE)) + 1):
            many = (n - skipped)[part]
            which = np.repeat(part, many)
            member = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + skipped[which]
            yield at[which], first[which] + member * difference[which] - at[which]


def runs(symbols: np.ndarray) -> np.ndarray:
    """All runs as rows of start, end and smallest period, by start and period.

    Equal symbols of different documents have to differ. A candidate that is a multiple of the smallest period extends
    to the same stretch, of which the least period is kept.
    """
    found = [np.empty((0, 3), np.int64)]
    if len(symbols) >= MIN_LENGTH:
        blocks = Blocks(symbols)
        for at, period in candidates(blocks):
            start = at - blocks.behind(at, at + period)
            end = at + period + blocks.ahead(at, at + period)
            good = end - start >= np.maximum(MIN_LENGTH, MIN_PERIODS * period)
            found.append(np.unique(np.column_stack((start, end, period))[good], axis=0))
    rows = np.unique(np.concatenate(found), axis=0)  # by start, end and period
    least = np.ones(len(rows), bool)
    least[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[least]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def repeated_words(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's rule: where crc32 of the decimal id ends in 0, words from a place on repeat with a fixed period."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@dataclass
class Document:
    doc_id: int | None
    words: list[bytes]


def described(documents: list[Document]) -> list[tuple]:
    """Results of a batch of documents."""
    starts = np.cumsum([0, *(len(d.words) for d in documents)])
    symbols = np.empty(starts[-1], np.int64)
    used = 0
    for document, at in zip(documents, starts, strict=False):
        known: dict[bytes, int] = {}
        symbols[at : at + len(document.words)] = [known.setdefault(w, used + len(known)) for w in document.words]
        used += len(known)
    rows = runs(symbols)
    owner = np.searchsorted(starts, rows[:, 0], "right") - 1
    cuts = np.searchsorted(owner, np.arange(len(documents) + 1))
    return [digest(d, rows[cuts[i] : cuts[i + 1]] - [starts[i], starts[i], 0]) for i, d in enumerate(documents)]


def digest(document: Document, rows: np.ndarray) -> tuple:
    length = rows[:, 1] - rows[:, 0]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in zip(rows[:, 0].tolist(), length.tolist(), rows[:, 2].tolist(), strict=True))
    words, best = document.words, (None,) * 4
    if len(rows):
        top = 0
        for i in range(1, len(rows)):  # rows come by start and period, so the first of equals stays
            if int(length[i]) * int(rows[top, 2]) > int(length[top]) * int(rows[i, 2]):
                top = i
        best = (int(rows[top, 0]), int(length[top]), int(rows[top, 2]), 1000 * int(length[top]) // int(rows[top, 2]))
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, rows[:, 0] + rows[:, 2], 1)
        np.add.at(change, rows[:, 1], -1)
        words = [w for w, covered in zip(words, np.cumsum(change).tolist(), strict=False) if not covered]
    return (document.doc_id, len(rows), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())


def periodic_runs(docs: DataFrame, text: str = "text", synthetic: bool = False) -> DataFrame:
    """For each document its runs: n_runs; start, length, period and exponent_milli of the one with most periods; the hash of
    the list of all (``runs_sha256``) and that of the words without the repetitions (``collapsed_sha256``).

    Words are runs of characters other than space and U+0009 to U+000D, numbered from 0. A run is a stretch of 24 words or
    more in which words one smallest period apart are equal, at least 3 periods long and not to be extended. Of
    each run all but its first period is left out of the remaining words. ``synthetic`` puts repetitions into every tenth
    document first, by a rule on its id.

    Null and empty texts have no words and no runs, and a null id puts in none; texts of any length are handled whole.
    Of runs with equal exponents the first one is shown. Repeated rows are each described; other columns of the
    input are left out whatever their names; an empty table gives an empty result. Documents meet no others, so nothing is
    moved between tasks.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        types = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]

        def done(waiting: list[Document]) -> pa.RecordBatch:
            columns = zip(*described(waiting), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            waiting, size = [], 0
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = value.as_py().encode().split()  # bytes split at exactly these six characters
                words = repeated_words(words, doc_id) if synthetic else words
                if waiting and size + len(words) > BATCH_WORDS:
                    yield done(waiting)
                    waiting, size = [], 0
                waiting.append(Document(doc_id, words))
                size += len(words)
            if waiting:
                yield done(waiting)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(describe, SCHEMA)
