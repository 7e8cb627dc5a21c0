"""Removal of byte strings that repeat anywhere in a corpus, by sorted suffixes.

Not every suffix is moved. A first sort holds one suffix for each stretch of starts that share a minimizer: the leading
``gram`` bytes at the smallest hash of a window. Equal strings have equal minimizers, so a stretch whose leading gram
occurs once cannot repeat, and a stretch that is found whole elsewhere repeats throughout. Only the starts of the
remaining stretches, at the edges of repeats, go into a second sort as suffixes of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.shared import dropped, fingerprint, kept, quoted, row_id, text_of, whole_row, working_folder

LENGTH, GRAM = 200, 110

#: Starts handled at once; longer texts go in blocks. Stretches end at block borders, which changes no result.
BLOCK = 1 << 20

#: Multiplier of the rolling hash, odd so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15

ALL, EDGE, PARTNER = 0, 1, 2  # the stretch repeats; each start has to be looked at; it repeats and edges may match it


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse."""
    n = BLOCK + 4096
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    up[1:], down[1:] = BASE, pow(BASE, -1, 1 << 64)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Hashes of all substrings of one block of bytes."""

    def __init__(self, data: bytes) -> None:
        up, self.down = powers()
        values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every window of ``size`` values, from running minima of blocks in both directions."""
    padded = np.full(-(-len(values) // size) * size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - size + 1
    return np.minimum(back[:n], ahead[size - 1 : size - 1 + n])


def stretches(data: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Leading hash, hash of all bytes that its strings touch, first start and end of each stretch, by blocks.

    The low bits of the hashes give way to the place, so that of equal grams in a window the first is the minimizer
    and every stretch has one place.
    """
    low = np.uint64((BLOCK << 1) - 1)
    for at in range(0, len(data) - length + 1, BLOCK):
        rolling = Rolling(data[at : at + BLOCK + length - 1])
        hashes = rolling.all(gram)
        minima = window_minima((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
        cuts = np.flatnonzero(minima[1:] != minima[:-1]) + 1
        begin, end = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(minima)]))
        yield hashes[minima[begin] & low], rolling.of(begin, end + length - 1) + (end - begin).astype(np.uint64), begin + at, end + at


def in_batches(parts: Iterator[tuple[np.ndarray, ...]], doc_ids: pa.Array, names: list[str], most: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Joins the columns that a batch's texts give to few Arrow batches.

    The first of a part's values is the row of its text in the batch; its id comes from ``doc_ids``. Unsigned hashes are
    given as signed numbers of the same bits.
    """

    def joined() -> pa.RecordBatch:
        row = pa.array(np.repeat([p[0] for p in waiting], [len(p[1]) for p in waiting]))
        columns = [np.concatenate(c) for c in zip(*(p[1:] for p in waiting), strict=True)]
        arrays = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns]
        return pa.RecordBatch.from_arrays([*(ids.take(row) for ids in doc_ids), *arrays], names)

    waiting: list[tuple] = []
    size = 0
    for part in parts:
        waiting.append(part)
        size += len(part[1])
        if size >= most:
            yield joined()
            waiting, size = [], 0
    if waiting:
        yield joined()


def leading(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The stretches of each document: ``lead`` and ``whole`` hashes, ``begin`` and ``end`` of the starts."""
    names = ["doc_id", "fp", "lead", "whole", "begin", "end"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = enumerate(batch.column(2))
            parts = ((row, *found) for row, text in texts for found in stretches(text.as_py().encode(), length, gram))
            yield from in_batches(parts, batch.columns[:2], names)

    return docs.mapInArrow(cut, "doc_id long, fp long, lead long, whole long, begin long, end long")


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int, most: int = 200_000) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Sorted rows in chunks that do not part a run of equal keys (the first ``keys`` columns).

    With each chunk goes, per row, whether its run may go on elsewhere: a partition's first and last run, and a run of
    over ``most`` rows, which is given in parts so that memory stays bounded.
    """
    rest: list[np.ndarray] | None = None
    opens = True

    def changes(columns: list[np.ndarray]) -> np.ndarray:
        return np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:keys]], axis=0)) + 1

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            columns = [np.concatenate(pair) for pair in zip(rest, columns, strict=True)]
        cuts = changes(columns)
        at = int(cuts[-1]) if len(cuts) else 0
        if at:
            is_open = np.zeros(at, bool)
            is_open[: cuts[0]] = opens
            yield [c[:at] for c in columns], is_open
            opens = False
        rest = [c[at:] for c in columns]
        if len(rest[0]) > most:
            yield rest, np.ones(len(rest[0]), bool)
            rest, opens = None, True
    if rest is not None:
        yield rest, np.ones(len(rest[0]), bool)


def run_numbers(columns: list[np.ndarray]) -> np.ndarray:
    """Number of the run that each sorted row belongs to."""
    change = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.concatenate(([0], np.cumsum(change)))


def classified(suffixes: DataFrame) -> DataFrame:
    """Sorts stretches by their leading gram and tells which repeat, which have to be looked at and which cannot.

    Spark's range partitioner samples splitters over all columns, so that equal grams, however many, fill several
    buckets, and each bucket is sorted where it lies. At a bucket's ends, where equals may lie in the bucket beside, a
    stretch is looked at start by start.
    """
    order = ["lead", "whole", "fp", "doc_id", "begin", "end"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, is_open in whole_runs(batches, 1):
            leads, wholes = run_numbers(columns[:1]), run_numbers(columns[:2])
            first = np.concatenate(([True], wholes[1:] != wholes[:-1]))
            several = (np.bincount(leads, weights=first)[leads] > 1) | is_open
            many = np.bincount(wholes)[wholes] > 1
            state = np.where(many, np.where(first & several, PARTNER, ALL), EDGE)
            at = many | several
            out = [columns[i][at] for i in (3, 2, 4, 5)] + [state[at].astype(np.int32)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, out)), ["doc_id", "fp", "begin", "end", "state"])

    ranged = suffixes.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(compare, "doc_id long, fp long, begin long, end long, state int")


def one_for_all_copies(found: DataFrame) -> DataFrame:
    """One row for a stretch of all rows that agree in id and text, so that what follows sees such a text once.

    A stretch that more than one of them has repeats; unless all were settled, its starts are looked at as well.
    """
    stretch = found.groupBy("doc_id", "fp", "begin", "end").agg(F.count("*").alias("_n"), F.max("state").alias("_state"))
    return stretch.select("doc_id", "fp", "begin", "end", F.when((F.col("_n") > 1) & (F.col("_state") != ALL), PARTNER).otherwise(F.col("_state")).alias("state"))


def edges_of(data: bytes, found: list[dict], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First 8 bytes, hash and place of every start of the stretches to look at, by blocks of the text."""
    blocks: dict[int, list[np.ndarray]] = {}
    for stretch in found:
        if stretch["state"] != ALL:
            blocks.setdefault(stretch["begin"] // BLOCK * BLOCK, []).append(np.arange(stretch["begin"], stretch["end"]))
    for at, starts in blocks.items():
        place = np.concatenate(starts)
        piece = data[at : int(place.max()) + length]
        eight = np.lib.stride_tricks.sliding_window_view(np.frombuffer(piece, np.uint8), 8)[place - at]
        yield np.ascontiguousarray(eight).view(">u8").ravel().astype(np.uint64), Rolling(piece).of(place - at, place - at + length), place


def edge_suffixes(texts: DataFrame, length: int) -> DataFrame:
    """One row for each start of the stretches to look at: its first 8 bytes and the hash of its ``length`` bytes."""
    names = ["fp", "doc_id", "lead", "rest", "start"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2), batch.column(3), strict=True)
            parts = ((row, *e) for row, (text, found) in enumerate(rows) for e in edges_of(text.as_py().encode(), found.as_py(), length))
            yield from in_batches(parts, [batch.column(1), batch.column(0)], names)

    some = texts.where(F.exists("found", lambda f: f["state"] != ALL))
    return some.mapInArrow(cut, "fp long, doc_id long, lead long, rest long, start long")


def compared(suffixes: DataFrame) -> DataFrame:
    """Sorts suffixes and gives those that equal another one of their bucket, and records of each bucket's ends.

    A record (``known`` false) has the key and the number ``n`` of suffixes of a run that may go on in the bucket beside.
    """
    order = ["lead", "rest", "fp", "doc_id", "start"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, is_open in whole_runs(batches, 2):
            run = run_numbers(columns[:2])
            n = np.bincount(run)[run]
            first = np.concatenate(([True], run[1:] != run[:-1]))
            known, ends = np.flatnonzero(n > 1), np.flatnonzero(first & is_open)
            at = np.concatenate((known, ends))
            flags = np.repeat([True, False], [len(known), len(ends)])
            lead, rest, fp, doc_id, start = (c[at] for c in columns)
            lead[: len(known)] = rest[: len(known)] = 0  # only the ends' keys are needed
            out = [pa.array(flags), pa.array(lead), pa.array(rest), pa.array(fp), pa.array(doc_id), pa.array(start), pa.array(n[at])]
            yield pa.RecordBatch.from_arrays(out, ["known", *order, "n"])

    ranged = suffixes.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(compare, "known boolean, lead long, rest long, fp long, doc_id long, start long, n long")


def across(found: DataFrame) -> DataFrame:
    """Starts of repeated suffixes: those known from their bucket, and bucket ends that equal one of another bucket."""
    ends = found.where("NOT known")
    shared = ends.groupBy("lead", "rest").agg(F.sum("n").alias("_n")).where("_n > 1").select(F.col("lead").alias("_l"), F.col("rest").alias("_r"))
    met = ends.where("n = 1").join(shared, (F.col("lead") == F.col("_l")) & (F.col("rest") == F.col("_r")), "left_semi")
    return found.where("known").select("doc_id", "fp", "start").unionByName(met.select("doc_id", "fp", "start"))


def removed(size: int, stretches_found: list[dict], starts: list[int], length: int) -> np.ndarray:
    """Begin and end of each maximal run of removed bytes, one row each."""
    change = np.zeros(size + 1, np.int64)
    for stretch in stretches_found:
        if stretch["state"] != EDGE:
            change[stretch["begin"]] += 1
            change[stretch["end"] + length - 1] -= 1
    at = np.unique(np.asarray(starts, np.int64))
    change[at] += 1
    np.subtract.at(change, at + length, 1)
    gone = np.concatenate(([0], (np.cumsum(change[:-1]) > 0).view(np.int8), [0]))
    return np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2)


def rest_of(texts: DataFrame, length: int) -> DataFrame:
    """For each text with repeats: removed bytes and runs, the remaining bytes and their SHA-256."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, fp, text, found, starts in zip(batch["doc_id"], batch["fp"], batch["text"], batch["found"], batch["starts"], strict=True):
                data = text.encode()
                gone = removed(len(data), list(found), [] if starts is None else starts, length)
                if len(gone):
                    borders = [0, *gone.ravel().tolist(), len(data)]
                    rest = b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2], strict=True))
                    rows.append((doc_id, fp, int((gone[:, 1] - gone[:, 0]).sum()), len(gone), hashlib.sha256(rest).hexdigest(), rest))
            out = pd.DataFrame(rows, columns=["doc_id", "fp", "n_removed", "n_spans", "kept_sha256", "rest"])
            yield out.astype({"kept_sha256": object})

    return texts.mapInPandas(cut, "doc_id long, fp long, n_removed long, n_spans long, kept_sha256 string, rest binary")


def repeats(docs: DataFrame, wanted: tuple[str, ...], length: int = LENGTH, gram: int = GRAM, text: str = "text") -> DataFrame:
    """One row for each distinct (doc_id, fp) whose text has repeated strings, with the ``wanted`` of what ``rest_of`` gives.

    ``length`` is at least 8 and at least ``gram``.
    """
    folder = working_folder(docs.sparkSession)
    rows = docs.select(row_id().alias("doc_id"), fingerprint(text).alias("fp"), text_of(text).alias("text"))
    rows = rows.where(F.octet_length("text") >= length)
    suffixes = kept(leading(rows, length, gram), folder, "leading")
    found = one_for_all_copies(classified(suffixes)).groupBy("doc_id", "fp").agg(F.collect_list(F.struct("begin", "end", "state")).alias("found"))
    found = kept(found.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), "found"), folder, "found")
    dropped(docs.sparkSession, folder, "leading")
    once = rows.groupBy("doc_id", "fp").agg(F.first("text").alias("text"))
    named = once.join(found, (once["doc_id"] == found["_id"]) & (once["fp"] == found["_fp"]))
    texts = kept(named.select("doc_id", "fp", "text", "found"), folder, "texts")
    edges = kept(edge_suffixes(texts, length), folder, "edges")
    equal = kept(compared(edges), folder, "equal")
    dropped(docs.sparkSession, folder, "edges", "found")
    starts = across(equal).groupBy("doc_id", "fp").agg(F.collect_list("start").alias("starts"))
    starts = starts.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), "starts")
    both = texts.join(starts, (texts["doc_id"] == starts["_id"]) & (texts["fp"] == starts["_fp"]), "left")
    whole = rest_of(both.select("doc_id", "fp", "text", "found", "starts"), length)
    whole = kept(whole.select("doc_id", "fp", *wanted), folder, "rest")
    dropped(docs.sparkSession, folder, "texts", "equal")
    return whole.groupBy(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp")).agg(*(F.first(c).alias(f"_{c}") for c in wanted))


def measure(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text") -> DataFrame:
    """For each document n_bytes, and of the bytes that ``length``-byte strings found elsewhere cover: n_removed,
    n_spans (maximal runs) and the SHA-256 of what remains.

    Strings are bytes of the UTF-8 text and are judged on the input; another place is any other start, in the same
    document or another row. A null text is an empty one. Repeated rows are copies of each other, so all their
    bytes go if there are ``length`` of them; they are worked out once. Texts of any length are handled in blocks. Other columns of the input are left
    out. An empty table gives an empty result.
    """
    changed = repeats(docs, ("n_removed", "n_spans", "kept_sha256"), length, gram, text)
    rows = docs.select("doc_id", row_id().alias("_key"), fingerprint(text).alias("fp"), F.octet_length(text_of(text)).cast("long").alias("n_bytes"), F.sha2(text_of(text), 256).alias("_sha"))
    joined = rows.join(changed, (rows["_key"] == changed["_id"]) & (rows["fp"] == changed["_fp"]), "left")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("_n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("_n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("_kept_sha256", "_sha").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text") -> DataFrame:
    """The documents with repeated strings taken out of their texts; other columns stay.

    A character of which only some bytes are removed goes whole. A null text stays null.
    """
    changed = repeats(docs, ("rest",), length, gram, text)
    readable = F.pandas_udf(lambda values: values.map(lambda b: None if b is None else b.decode("utf-8", "ignore")), "string")
    rows = docs.select(row_id().alias("_doc"), fingerprint(text).alias("_row_fp"), whole_row(docs).alias("_row"))
    joined = rows.join(changed, (rows["_doc"] == changed["_id"]) & (rows["_row_fp"] == changed["_fp"]), "left")
    new = F.when(F.col("_id").isNull(), F.col(f"_row.{text}")).otherwise(readable("_rest"))
    return joined.select(*(new.alias(c) if c == text else F.col(f"_row.{quoted(c)}").alias(c) for c in docs.columns))
