"""Concatenate-and-cut packing: every document's token ids, end to end, cut into sequences of fixed length."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.shared import kept, text_of, working_folder

END_ID = 0
LENGTH = 1024

#: Letters on which all versions of Unicode agree, so both libraries cut these texts alike; others go to ``tokenizers``.
COMMON = re.compile("[\x00-ɏ‐-‧]*")


@lru_cache(maxsize=4)
def encoder(path: str, ranks_path: str | None, pattern: str | None) -> Callable[[str], np.ndarray]:
    """Token ids of a text as ``tokenizers`` gives them for the file at ``path``, without added special tokens.

    With ``ranks_path``, the same vocabulary as a file of ranks, texts in common letters that hold no special token
    take the faster ``tiktoken``, which gives the same ids.
    """
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    slow = lambda text: np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
    if not ranks_path:
        return slow
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    specials = [t.content for t in exact.get_added_tokens_decoder().values()]

    def encode(text: str) -> np.ndarray:
        if COMMON.fullmatch(text) and not any(s in text for s in specials):
            return fast.encode_to_numpy(text, disallowed_special=())
        return slow(text)

    return encode


def tokens_in_order(docs: DataFrame, path: str, ranks_path: str | None, pattern: str | None, text: str) -> DataFrame:
    """Documents with their ids (4 bytes each, little-endian, closed by ``END_ID``), input partition and place in it.

    ``part`` numbers the input partitions, ``before`` counts the tokens of the partition's earlier documents.
    """
    schema = "doc_id long, ids binary, doc_tokens long, part long, before long"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path, ranks_path, pattern)
        part, before, end = TaskContext.get().partitionId(), 0, np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids, sizes, starts = [], [], []
            for value in batch.column(1).to_pylist():
                ids.append(ids_of(value).astype("<u4").tobytes() + end)
                sizes.append(len(ids[-1]) // 4)
                starts.append(before)
                before += sizes[-1]
            columns = [batch.column(0), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array([part] * len(ids), pa.int64()), pa.array(starts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "doc_tokens", "part", "before"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(encode, schema)


def pack(docs: DataFrame, path: str, ranks_path: str | None = None, pattern: str | None = None, length: int = LENGTH, text: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens, without a gap but in the last sequence.

    Pass one encodes each document once and keeps ids and each input partition's token total; the prefix sums of the
    totals give every partition, and so every document, its place in one long row of tokens. Pass two cuts that row at
    multiples of ``length`` and gives a record for each piece: doc_id, start and length within the document's ids,
    ids_crc32, doc_tokens, sequence_id, offset within the sequence, whether the piece opens and closes its document
    (``is_start``, ``is_end``), and ``padded_length``: ``length``, or the tokens in the last sequence where these
    are a power of two. ``ids`` holds the piece's ids.

    The totals are one number for each input partition, which the driver plans and tracks anyway. A null text is an
    empty one and gives only the closing id. Repeated rows are packed each. Of the input only doc_id (null too) is
    carried over, so clashing names do no harm; an empty table gives no pieces.
    """
    spark = docs.sparkSession
    tokens = kept(tokens_in_order(docs, path, ranks_path, pattern, text), working_folder(spark), "tokens")
    totals = sorted((r.part, r.n) for r in tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).collect())
    places, total = [], 0
    for part, n in totals:
        places.append((part, total))
        total += n
    begin = spark.createDataFrame(places, "part long, _begin long")  # one small row per input partition
    last, rest = divmod(total, length)
    rest_length = rest if rest and rest & (rest - 1) == 0 else length
    first, end = F.col("_at"), F.col("_at") + F.col("doc_tokens")
    placed = tokens.join(F.broadcast(begin), "part").withColumn("_at", F.col("_begin") + F.col("before"))
    pieces = placed.select("doc_id", "ids", "doc_tokens", "_at", F.explode_outer(F.sequence(F.floor(first / length), F.floor((end - 1) / length))).alias("sequence_id"))
    start = F.greatest(F.lit(0), F.col("sequence_id") * length - first).cast("long")
    stop = F.least(F.col("doc_tokens"), (F.col("sequence_id") + 1) * length - first)
    pieces = pieces.withColumn("start", start).withColumn("length", (stop - F.col("start")).cast("long"))
    pieces = pieces.withColumn("ids", F.expr("substring(ids, CAST(start * 4 + 1 AS INT), CAST(length * 4 AS INT))"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        F.col("sequence_id").cast("long").alias("sequence_id"),
        ((first + F.col("start")) % length).cast("long").alias("offset"),
        (F.col("start") == 0).alias("is_start"),
        (F.col("start") + F.col("length") == F.col("doc_tokens")).alias("is_end"),
        F.when(F.col("sequence_id") == last, F.lit(rest_length)).otherwise(length).cast("long").alias("padded_length"),
        "ids",
    )
