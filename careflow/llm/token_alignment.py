"""Alignment of two tokenizers' tokens over a corpus, by external spill counting.

Side A is a byte-level BPE file of ``tokenizers``, side B a ``sentencepiece`` model. Tokens of both sides whose byte ranges
overlap are linked. A task encodes documents and sorts the links of some thousand of them by B id, A id and document; such a
sorted list is parted by a radix of the B id and spilled as one run of zstd bytes per radix. The runs of a slice of
documents lie in rows of a table in the shared folder, one row per radix. A heap merges the runs of a row key by key and
counts each pair; Spark adds up the slices' counts, and the pairs of one B id give its maximum. A second merge then
walks over the runs of a slice beside its counted pairs, in the same B-major order, and streams each pair's count and
rank back to the documents in the runs.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careflow.llm.packing import COMMON
from careflow.llm.shared import kept, text_of, working_folder
from careflow.llm.token_counts import byte_letters

#: Runs of a slice by the low bits of the B id.
RADIXES = 16

#: Tokens that are sorted at once, and (document, pair) records and documents of a slice. Results do not depend on them.
CHUNK_TOKENS, SLICE_RECORDS, SLICE_DOCUMENTS = 1_000_000, 4_000_000, 60_000

#: A pair is B id * 2**A_BITS + A id.
A_BITS = 16

SPACE = b" "
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Sides:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_path: str, a_ranks: str | None, a_pattern: str | None, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(a_path)
        self.exact.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.fast = None
        if a_ranks:
            import tiktoken

            with open(a_ranks, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=a_pattern, mergeable_ranks=ranks, special_tokens={})
        letters = byte_letters()
        vocabulary = self.exact.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, token in vocabulary.items():
            self.a_bytes[token] = bytes(letters[c] for c in entry)
        self.b_bytes = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        if len(self.a_bytes) > 1 << A_BITS:
            raise ValueError("too many A tokens")
        self.a_sizes, self.b_sizes = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        a_names, b_names = ([str(i) for i in range(len(t))] for t in (self.a_bytes, self.b_bytes))
        #: Decimal ids with the sign after them: A within and at the end of a group, then the same for B.
        self.written = [f"{name}{end}" for names, ends in ((a_names, ",|"), (b_names, ",;")) for end in ends for name in names]

    def _piece(self, token: int) -> bytes:
        piece = self.pieces.id_to_piece(token)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(token) else piece.replace("▁", " ").encode()

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Both sides' ids of a text, None where a side's bytes are not the text's.

        Ids from ranks always give the bytes back, so their sizes are compared and not the bytes.
        """
        if not text:
            return None
        data = SPACE + text.encode()
        if self.fast and COMMON.fullmatch(text):
            a = self.fast.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)
            same = self.a_sizes[a].sum() == len(data)
        else:
            ids = self.exact.encode(" " + text, add_special_tokens=False).ids
            a, same = np.array(ids, np.int64), b"".join(map(self.a_bytes.__getitem__, ids)) == data
        b = self.pieces.encode(text)
        if not same or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        return a, np.fromiter(b, np.int64, len(b))


@lru_cache(maxsize=2)
def sides(*paths: str | None) -> Sides:
    return Sides(*paths)


@dataclass
class Run:
    """Sorted pairs, how many records each has, and the records: a document of the slice and its links of the pair."""

    pairs: np.ndarray
    sizes: np.ndarray
    docs: np.ndarray
    links: np.ndarray

    def spilled(self) -> bytes:
        head = np.array([len(self.pairs), len(self.docs)], np.uint32)
        columns = (head, np.diff(self.pairs, prepend=0), self.sizes, self.docs, self.links)
        return zstandard.ZstdCompressor(level=3).compress(b"".join(c.astype("<u4").tobytes() for c in columns))

    @classmethod
    def read(cls, spilled: bytes) -> Run:
        values = np.frombuffer(zstandard.ZstdDecompressor().decompress(spilled), "<u4")
        n, m = map(int, values[:2])
        deltas, sizes, docs, links = np.split(values[2:].astype(np.int64), (n, 2 * n, 2 * n + m))
        return cls(np.cumsum(deltas), sizes, docs, links)

    def totals(self) -> np.ndarray:
        """Links of each pair."""
        return np.add.reduceat(self.links, np.cumsum(self.sizes) - self.sizes) if len(self.pairs) else np.empty(0, np.int64)


@dataclass
class Slice:
    """Documents of a task that have not left it yet, and their runs by radix."""

    doc_ids: list[int | None] = field(default_factory=list)
    hashes: list[str] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)
    runs: list[list[bytes]] = field(default_factory=lambda: [[] for _ in range(RADIXES)])
    records: int = 0

    def add(self, tokenizers: Sides, documents: list[tuple[int | None, tuple[np.ndarray, np.ndarray] | None]]) -> None:
        first = len(self.doc_ids)
        self.doc_ids += [doc_id for doc_id, _ in documents]
        some = [i for i, (_, ids) in enumerate(documents) if ids is not None]
        counts, hashes = np.zeros((len(documents), len(COUNTS)), np.int64), [""] * len(documents)
        if some:
            aligned = Alignment(tokenizers, [documents[i][1] for i in some])
            counts[some] = aligned.counts
            for i, digest in zip(some, aligned.hashes(), strict=True):
                hashes[i] = digest
            self._spill(aligned.pairs, first + np.array(some)[aligned.owners])
        self.counts.append(counts)
        self.hashes += hashes

    def _spill(self, pairs: np.ndarray, docs: np.ndarray) -> None:
        records = np.sort((pairs << 32) | docs)
        fresh = np.flatnonzero(np.append(True, records[1:] != records[:-1]))
        links, records = np.diff(np.append(fresh, len(records))), records[fresh]
        self.records += len(records)
        pairs, docs = records >> 32, records & 0xFFFFFFFF
        radix = (pairs >> A_BITS) % RADIXES
        for r in np.unique(radix):
            at = radix == r
            own = pairs[at]
            keys = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            self.runs[r].append(Run(own[keys], np.diff(np.append(keys, len(own))), docs[at], links[at]).spilled())

    def rows(self, number: int) -> pa.RecordBatch:
        """A row for each radix with runs, and one (radix -1) with the documents."""
        table = np.concatenate(self.counts)
        arrays = [pa.array(self.doc_ids, pa.int64()), *(pa.array(c) for c in table.T), pa.array(self.hashes)]
        batch = pa.RecordBatch.from_arrays(arrays, ["doc_id", *COUNTS, "groups_sha256"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        found = [(-1, [zstandard.ZstdCompressor().compress(sink.getvalue().to_pybytes())])] + [(r, runs) for r, runs in enumerate(self.runs) if runs]
        columns = [pa.array([number] * len(found), pa.int64()), pa.array([r for r, _ in found], pa.int32()), pa.array([runs for _, runs in found], pa.list_(pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, ["slice", "radix", "runs"])


class Alignment:
    """Groups and links of some encoded texts, all in one row of bytes."""

    def __init__(self, tokenizers: Sides, encoded: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.tokenizers = tokenizers
        self.a, self.b = (np.concatenate([ids[side] for ids in encoded]) for side in (0, 1))
        n_a, n_b = (np.array([len(ids[side]) for ids in encoded]) for side in (0, 1))
        end_a, end_b = np.cumsum(tokenizers.a_sizes[self.a]), np.cumsum(tokenizers.b_sizes[self.b])
        self.borders_a, self.borders_b = np.cumsum(n_a), np.cumsum(n_b)
        ends = end_a[self.borders_a - 1]  # of the texts, where both sides end
        self.last_a, self.last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        common, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        self.last_a[at_a], self.last_b[at_b] = True, True
        self.through_a, self.through_b = at_a + 1, at_b + 1  # tokens up to the end of each group
        n_groups = np.diff(np.searchsorted(common, ends, "right"), prepend=0)
        # Between neighbouring ends of any side lies one link.
        cuts = np.sort(np.concatenate((end_a, end_b)), kind="stable")  # merges two sorted parts
        cuts = cuts[np.append(True, cuts[1:] != cuts[:-1])]
        self.pairs = self.b[np.searchsorted(end_b, cuts)] << A_BITS | self.a[np.searchsorted(end_a, cuts)]
        self.owners = np.searchsorted(ends, cuts)
        self.counts = np.column_stack((n_a, n_b, n_groups, n_a + n_b - n_groups))

    def hashes(self) -> Iterator[str]:
        """SHA-256 of each text's groups as decimal ids."""
        group_a = np.cumsum(self.last_a) - self.last_a
        group_b = np.cumsum(self.last_b) - self.last_b
        n_a, n_b = len(self.tokenizers.a_bytes), len(self.tokenizers.b_bytes)
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + np.append(0, self.through_b)[group_a]] = self.a + n_a * self.last_a
        codes[np.arange(len(self.b)) + self.through_a[group_b]] = 2 * n_a + self.b + n_b * self.last_b
        borders, written = np.append(0, self.borders_a + self.borders_b).tolist(), self.tokenizers.written
        for begin, end in zip(borders, borders[1:], strict=False):
            listed = "".join(map(written.__getitem__, codes[begin:end].tolist()))
            yield hashlib.sha256(listed[:-1].encode()).hexdigest()


def spilled(docs: DataFrame, paths: tuple[str | None, ...], text: str) -> DataFrame:
    """Slices of documents as rows of runs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, number = sides(*paths), TaskContext.get().partitionId() << 32
        part, waiting, tokens = Slice(), [], 0
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokenizers.encoded(value.as_py())
                waiting.append((doc_id, ids))
                tokens += 0 if ids is None else len(ids[0]) + len(ids[1])
                if tokens < CHUNK_TOKENS and len(part.doc_ids) + len(waiting) < SLICE_DOCUMENTS:
                    continue
                part.add(tokenizers, waiting)
                waiting, tokens = [], 0
                if part.records >= SLICE_RECORDS or len(part.doc_ids) >= SLICE_DOCUMENTS:
                    yield part.rows(number)
                    part, number = Slice(), number + 1
        if waiting:
            part.add(tokenizers, waiting)
        if part.doc_ids:
            yield part.rows(number)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(cut, "slice long, radix int, runs array<binary>")


def merged(runs: list[Run]) -> tuple[list[int], list[int]]:
    """Each pair of some runs, in order, with its number of links, by a heap of the runs' next pairs."""
    pairs, counts = [], []
    last = -1
    for pair, n in heapq.merge(*(zip(run.pairs.tolist(), run.totals().tolist(), strict=True) for run in runs)):
        if pair == last:
            counts[-1] += n
        else:
            pairs.append(pair)
            counts.append(n)
            last = pair
    return pairs, counts


def slice_counts(slices: DataFrame) -> DataFrame:
    """Links of each pair within each slice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, runs in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                pairs, counts = merged([Run.read(run) for run in runs.as_py()])
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(pairs), pa.int64()), pa.array(pairs, pa.int64()), pa.array(counts, pa.int64())], ["slice", "pair", "n"])

    return slices.where("radix >= 0").select("slice", "runs").mapInArrow(count, "slice long, pair long, n long")


def pair_counts(partial: DataFrame) -> DataFrame:
    """Links of each pair in the corpus, and whether no pair of its B id has more.

    A B id has at most as many pairs as there are A tokens, however many documents it stands in.
    """
    summed = partial.groupBy("pair").agg(F.sum("n").alias("count"))
    b_id = Window.partitionBy(F.shiftright("pair", A_BITS))
    return summed.withColumn("best", F.col("count") == F.max("count").over(b_id))


def streamed_back(runs: list[Run], pairs: np.ndarray, counts: np.ndarray, best: np.ndarray, sums: np.ndarray, bests: np.ndarray) -> None:
    """Adds what the links of each run count to its documents, walking over runs and counted pairs in one order."""
    known = ((pair, -1, at) for at, pair in enumerate(pairs.tolist()))
    sources = [zip(run.pairs.tolist(), repeat(number), repeat(0)) for number, run in enumerate(runs)]
    met: list[list[int]] = [[] for _ in runs]
    current = 0
    for _, number, at in heapq.merge(known, *sources):
        if number < 0:
            current = at
        else:
            met[number].append(current)
    for run, places in zip(runs, met, strict=True):
        at = np.repeat(np.array(places, np.int64), run.sizes)
        np.add.at(sums, run.docs, run.links * counts[at])
        np.add.at(bests, run.docs, run.links * best[at])


def contributed(spills: pa.Table, counted: pa.Table) -> pa.Table:
    """The result rows of one slice."""
    by_radix = dict(zip(spills.column("radix").to_pylist(), spills.column("runs").to_pylist(), strict=True))
    reader = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(by_radix.pop(-1)[0]))
    documents = reader.read_all()
    sums, bests = np.zeros(documents.num_rows, np.int64), np.zeros(documents.num_rows, np.int64)
    pairs, counts, best = (counted.column(c).to_numpy() for c in ("pair", "count", "best"))
    order = np.argsort(pairs)
    pairs, counts, best = pairs[order], counts[order], best[order].astype(np.int64)
    radix = (pairs >> A_BITS) % RADIXES
    for r, runs in by_radix.items():
        at = radix == r
        streamed_back([Run.read(run) for run in runs], pairs[at], counts[at], best[at], sums, bests)
    columns = {name: documents.column(name) for name in ("doc_id", *COUNTS)} | {"n_best": pa.array(bests), "count_sum": pa.array(sums), "groups_sha256": documents.column("groups_sha256")}
    return pa.table(columns)


def align(docs: DataFrame, a_path: str, b_path: str, a_ranks: str | None = None, a_pattern: str | None = None, text: str = "text") -> DataFrame:
    """For each document how its A and B tokens lie on each other.

    A encodes a space and the text, B the text, which puts a space before it itself; strings of special tokens are plain
    text. Where an A and a B token end at one byte, a group ends. Tokens with a common byte are linked. Given are n_a, n_b,
    n_groups, n_links; ``count_sum``, over the links, of how many links of the whole corpus have the same two ids; ``n_best``,
    the links whose count is the highest of their B id; and the SHA-256 of the groups' ids.

    Null and empty texts, and those that a side does not give back byte by byte, have no tokens: zeros and an empty string. Ids
    may be null; repeated rows count each; ties for the highest count are all highest. Other columns of the input are left
    out whatever their names. An empty table gives an empty result. Long texts are encoded whole; memory follows the
    longest one. ``a_ranks`` and ``a_pattern``, the A vocabulary as a file of ranks, speed up texts in common letters.
    """
    folder = working_folder(docs.sparkSession)
    slices = kept(spilled(docs, (a_path, a_ranks, a_pattern, b_path), text), folder, "slices")
    partial = kept(slice_counts(slices), folder, "partial")
    counted = partial.select("slice", "pair").join(pair_counts(partial), "pair")
    return slices.groupBy("slice").cogroup(counted.groupBy("slice")).applyInArrow(contributed, SCHEMA)
