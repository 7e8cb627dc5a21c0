"""Cross-entropy difference of two matched bigram models with one vocabulary."""

from __future__ import annotations

import re
import struct
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.shared import NO_ID, dropped, kept, row_id, text_of, working_folder

#: Weights of the smoothing.
PRIOR, FLOOR = 5.0, 0.5

#: Pairs that a worker holds at once, and buckets of pairs at least.
PAIRS, BUCKETS = 1_500_000, 96

#: Characters that are cut into words at once, and bytes of words that are hashed together.
CHARACTERS, LONG = 500_000, 64

#: Words and starts of a block at most, unless it is of a single text: two of its words, a text and a bit then fit into 63 bits.
MOST = 2_000_000

#: Bytes of a number and numbers, before those that are compressed.
HEAD = struct.Struct("<bq")

ALL_BITS = np.uint64(0xFFFFFFFFFFFFFFFF)

WORD = re.compile(r"\w+|[^\w\s]+")


def words(text: str) -> list[str]:
    """Runs of word characters and runs of other marks, lower-cased. ``Words`` cuts many texts at once in this way."""
    return WORD.findall(text.lower())


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where a key differs from the one before; the first one does."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])


@cache
def _kinds() -> np.ndarray:
    """For each character 1 if it is one of words, 2 if it is another mark, and 0 if it is white space."""
    characters = "".join(map(chr, range(sys.maxunicode + 1)))
    kinds = np.zeros(len(characters), np.uint8)
    for kind, run in ((1, r"\w+"), (2, r"[^\w\s]+")):
        for found in re.finditer(run, characters):
            kinds[found.start() : found.end()] = kind
    return kinds


class Words:
    """Numbers of all words, hashes of 64 bits of their UTF-8 bytes; 0 stands for a text's start."""

    def numbers(self, *texts: str) -> np.ndarray:
        """Those of each text's ``words`` after a 0; all texts are cut at once, where the kind of character changes."""
        lowered = [t.lower() + "\n" for t in texts]
        whole = "".join(lowered)
        kind = _kinds()[np.frombuffer(whole.encode("utf-32-le"), np.uint32)]
        begins = _starts(kind)
        ends, some = np.r_[begins[1:], len(kind)], kind[begins] > 0
        begins, ends = begins[some], ends[some]
        starts = np.searchsorted(begins, np.cumsum([0, *map(len, lowered[:-1])]))
        data = whole.encode()
        if len(data) > len(kind):
            at = np.flatnonzero(np.frombuffer(data, np.int8) >= -64)
            begins, ends = at[begins], at[ends]
        return np.insert(_hashes(data, begins, ends), starts, 0).view(np.int64)


def _hashes(data: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of parts of the bytes, 8 bytes of all parts at a time; long parts by themselves."""
    eights = np.frombuffer(data + bytes(16 - len(data) % 8), np.uint64)
    left = ends - begins
    out = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in np.flatnonzero(left > LONG):
        out[i] = xxhash.xxh3_64_intdigest(data[begins[i] : ends[i]])
    todo = np.flatnonzero(left <= LONG)
    at, left, hashed = begins[todo], left[todo], out[todo]
    while len(todo):
        place, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        value = eights[place] >> shift | eights[place + 1] << np.uint64(64) - shift
        value &= ALL_BITS >> (np.maximum(8 - left, 0) << 3).astype(np.uint64)
        hashed = (hashed ^ value) * np.uint64(0xFF51AFD7ED558CCD)
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0xC4CEB9FE1A85EC53)
        hashed ^= hashed >> np.uint64(29)
        out[todo] = hashed
        more = np.flatnonzero(left > 8)
        todo, at, left, hashed = todo[more], at[more] + 8, left[more] - 8, hashed[more]
    return np.maximum(out, np.uint64(1))


def _distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, sorted, and the places of all among them."""
    found = pa.array(numbers).dictionary_encode()
    known = found.dictionary.to_numpy()
    order = np.argsort(known)
    rank = np.empty(len(known), np.int64)
    rank[order] = np.arange(len(known))
    return known[order], rank[found.indices.to_numpy()]


class Texts:
    """Texts as numbers of their words, each after a 0, with their rows and ids."""

    def __init__(self) -> None:
        self.rows: list[int] = []
        self.ids: list[int] = []
        self.is_target: list[bool] = []
        self.numbers: list[np.ndarray] = []

    def coded(self) -> Coded:
        numbers = np.concatenate(self.numbers)
        lengths = np.diff(np.flatnonzero(numbers == 0), append=len(numbers)) - 1
        word, code = _distinct(numbers)
        return Coded(np.array(self.rows), np.array(self.is_target), lengths, word, code[numbers != 0])


@dataclass(frozen=True)
class Coded:
    """Texts as places (``code``) of their words in ``word``, which has each of these and the start, sorted."""

    rows: np.ndarray
    is_target: np.ndarray
    lengths: np.ndarray
    word: np.ndarray
    code: np.ndarray

    def start(self) -> int:
        return int(np.searchsorted(self.word, 0))

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the texts' words begin and end."""
        ends = np.cumsum(self.lengths)
        return ends - self.lengths, ends


def _pieces(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[list[tuple]]:
    """Rows whose texts have at most ``at_once`` characters, one more counted for each text, or a single row."""
    rows, held = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("_row", "_id", "is_target", "text")), strict=True):
            if rows and held + len(row[3]) + 1 > at_once:
                yield rows
                rows, held = [], 0
            rows.append(row)
            held += len(row[3]) + 1
    if rows:
        yield rows


def _texts(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[Texts]:
    """Texts, so many that they have at most ``at_once`` words and starts, or a single one."""
    own, texts, held = Words(), Texts(), 0
    for some in _pieces(batches, min(at_once, CHARACTERS)):
        rows, ids, is_target, values = zip(*some, strict=True)
        n = own.numbers(*values)
        if held and held + len(n) > at_once:
            yield texts
            texts, held = Texts(), 0
        texts.rows += rows
        texts.ids += ids
        texts.is_target += is_target
        texts.numbers.append(n)
        held += len(n)
    if held:
        yield texts


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers of 64 bits, their first bytes, their second bytes and so on, as many as any of them has, compressed."""
    used = -(-int(np.bitwise_or.reduce(numbers.view(np.uint64))).bit_length() // 8)
    planes = numbers.view(np.uint8).reshape(-1, 8)[:, :used].T
    return HEAD.pack(used, len(numbers)) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _restored(squeezed: bytes, kind: type = np.int64) -> np.ndarray:
    used, n = HEAD.unpack_from(squeezed)
    out = np.zeros((n, 8), np.uint8)
    if used:
        planes = pa.decompress(memoryview(squeezed)[HEAD.size :], decompressed_size=used * n, codec="zstd")
        out[:, :used] = np.frombuffer(planes, np.uint8).reshape(used, n).T
    return out.view(kind).reshape(n)


#: Row groups of the table of texts, which has few long rows, in bytes, looked at after each row.
GROUPS = {"compression": "none", "parquet.block.size": str(1 << 24), "parquet.page.size.row.check.min": "1"}

#: Texts that are cut into words, many in a row.
CODED = "rows array<long>, ids array<long>, words binary, codes binary, lengths binary, targets binary"


def coded(rows: DataFrame, at_once: int) -> DataFrame:
    """The texts as places of their words, so that they are cut into words once."""
    names = [c.split()[0] for c in CODED.split(", ")]
    kinds = [pa.list_(pa.int64())] * 2 + [pa.binary()] * 4

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(batches, min(at_once, MOST)):
            c = texts.coded()
            row = (texts.rows, texts.ids, *(_squeezed(x) for x in (np.diff(c.word, prepend=0), c.code, c.lengths, c.is_target.astype(np.int64))))
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

    return rows.mapInArrow(give, CODED)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[Coded]:
    """The texts with words that ``coded`` gave."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows = batch.column("rows")[i].values.to_numpy(zero_copy_only=False)
            words, code, lengths, targets = (_restored(batch.column(c)[i].as_py()) for c in ("words", "codes", "lengths", "targets"))
            some = lengths > 0
            if len(code):
                yield Coded(rows[some], targets[some] > 0, lengths[some], np.cumsum(words), code)


def counted(texts: DataFrame) -> DataFrame:
    """For each word how often it stands in target texts and in all, and how often as a last word. The start (0) stands
    nowhere and is short of being last, so that words less last ones gives for all how often they are first ones."""
    names = ["word", "target", "everything", "target_last", "everything_last"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _coded(batches):
            size, lasts = len(c.word), c.code[c.ends()[1] - 1]
            stands = [np.bincount(some, minlength=size) for some in (c.code[np.repeat(c.is_target, c.lengths)], c.code)]
            last = [np.bincount(some, minlength=size) for some in (lasts[c.is_target], lasts)]
            for some in last:
                some[c.start()] = -some.sum()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (c.word, *stands, *last)], names=names)

    found = texts.drop("ids").mapInArrow(count, ", ".join(f"{n} long" for n in names))
    return found.groupBy("word").agg(*(F.sum(n).alias(n) for n in names[1:]))


@dataclass(frozen=True)
class Model:
    """Counts of the frequent words, sorted, the start among them, and what both models share. Arrays of two have target and everything."""

    frequent: np.ndarray
    single: tuple[np.ndarray, np.ndarray]
    after: tuple[np.ndarray, np.ndarray]
    seen: tuple[int, int]
    scales: tuple[float, float]
    size: int
    buckets: int
    prior: float
    floor: float

    def places(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are frequent, and the places of those."""
        at = np.minimum(np.searchsorted(self.frequent, word), len(self.frequent) - 1)
        return self.frequent[at] == word, at

    def over(self, m: int, pair: np.ndarray, single: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Numerators, of counts without the text's own; ``n`` is how many of all words are the text's own."""
        lean = self.prior * (single * self.scales[m] + self.floor)
        return pair * self.scales[m] + lean / ((self.seen[m] - n) * self.scales[m] + self.floor * self.size)

    def under(self, m: int, after: np.ndarray) -> np.ndarray:
        return after * self.scales[m] + self.prior


#: A part of the pairs of some texts, or (without words) texts with their words and what their frequent words say of them.
BLOCK = "bucket long, n long, m long, words binary, firsts binary, seconds binary, rows binary, lengths binary, texts binary, marks binary, ended binary"


def blocks(texts: DataFrame, model: Model) -> DataFrame:
    """The distinct pairs of each text with their counts, in buckets by second word, those with a frequent one by both words.

    Of a frequent word all counts are known here, so what it says as a first word is summed up at once, and its pairs may
    lie in several buckets. Of another word one bucket has all pairs and so all counts.
    """
    names = [c.split()[0] for c in BLOCK.split(", ")]

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _coded(batches):
            out = list(_blocks(c, model))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=names)

    return texts.drop("ids").mapInArrow(give, BLOCK)


def _sums(keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """For each row the sum over all rows with the same key."""
    if not len(keys):
        return np.zeros(0, np.int64)
    of = pa.array(keys).dictionary_encode().indices.to_numpy()
    return np.bincount(of, weights=numbers)[of].astype(np.int64)


def _within(codes: np.ndarray, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, sorted, and the places of all among these. ``scratch`` has a number for every code there may be."""
    at = np.arange(len(codes))
    scratch[codes] = at
    known = np.sort(codes[scratch[codes] == at])
    scratch[known] = np.arange(len(known))
    return known, scratch[codes]


def _blocks(texts: Texts | Coded, model: Model) -> Iterator[tuple]:
    texts = texts.coded() if isinstance(texts, Texts) else texts
    rows, is_target, lengths, word, second = texts.rows, texts.is_target, texts.lengths, texts.word, texts.code
    opens, ends = texts.ends()
    doc = np.repeat(np.arange(len(rows)), lengths)
    first = np.r_[0, second[:-1]]
    first[opens] = texts.start()
    frequent, place = model.places(word)
    wide, deep = len(word).bit_length(), len(rows).bit_length()

    # What frequent first words and the start say
    group = np.sort((doc << wide | first)[frequent[first]])
    starts = _starts(group)
    begun, group = np.diff(starts, append=len(group)), group[starts]
    of, at = group >> wide, place[group & (1 << wide) - 1]
    sums = []
    for m in (0, 1):
        own = begun * is_target[of] if m == 0 else 0
        sums.append(np.bincount(of, weights=begun * np.log2(model.under(m, model.after[m][at] - own)), minlength=len(rows)))
    none = _squeezed(rows[:0])
    yield int(rows[0] % model.buckets), len(rows), 0, none, _squeezed(sums[0]), _squeezed(sums[1]), _squeezed(rows), _squeezed(lengths), none, none, none

    # Distinct pairs of texts, by second word, first word and text; the last bit is set where the pair ends its text
    pair = ((second << wide | first) << deep | doc) << 1
    pair[ends - 1] |= 1
    del doc, first, second, group, begun, of, at
    pair.sort()
    new = _starts(pair >> 1)
    times, last = np.diff(new, append=len(pair)), pair[np.r_[new[1:], len(pair)] - 1] & 1
    pair = pair[new] >> 1
    doc, first, second = pair & (1 << deep) - 1, pair >> deep & (1 << wide) - 1, pair >> deep + wide
    del new, pair
    target = is_target[doc]
    ended = np.zeros(len(times), np.int64)
    own = np.flatnonzero(frequent[second] & target)
    ended[own] = _sums(doc[own] << wide | second[own], times[own])

    spread = word.view(np.uint64)
    by_both = (spread[second] + spread[first] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(7)
    bucket = np.where(frequent[second], by_both, spread[second]) % np.uint64(model.buckets)
    bucket = bucket.astype(np.uint16 if model.buckets <= 1 << 16 else np.int64)
    marks = times << 2 | last << 1 | target
    lengths = np.where(is_target, lengths, 0)
    del by_both, times, last, target
    order = np.argsort(bucket, kind="stable")
    scratch = np.empty(len(word), np.int64), np.empty(len(rows), np.int64)
    for some in np.split(order, _starts(bucket[order])[1:]):
        n = len(some)
        known, codes = _within(np.concatenate([first[some], second[some]]), scratch[0])
        docs, of = _within(doc[some], scratch[1])
        columns = (np.diff(word[known], prepend=0), codes[:n], np.diff(codes[n:], prepend=0), np.diff(rows[docs], prepend=0), lengths[docs], of, marks[some], ended[some])
        yield int(bucket[some[0]]), n, len(known), *(_squeezed(c) for c in columns)


def losses(parts: DataFrame, model: Model) -> DataFrame:
    """Sums of texts from the blocks of each bucket."""
    names = ["_row", "n_words", "target", "everything"]

    def work(table: pa.Table) -> pa.Table:
        out, pairs = [], []
        for b in table.to_pylist():
            if b["m"]:
                pairs.append(tuple(_restored(b[c]) for c in ("words", "firsts", "seconds", "rows", "lengths", "texts", "marks", "ended")))
            else:
                out.append((_restored(b["rows"]), _restored(b["lengths"]), *(_restored(b[c], np.float64) for c in ("firsts", "seconds"))))
        if pairs:
            row, sums = _losses(pairs, model)
            out.append((row, np.zeros(len(row), np.int64), *sums))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=names)

    return parts.groupBy("bucket").applyInArrow(work, "_row long, n_words long, target double, everything double")


def _joint(parts: list[np.ndarray], codes: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """What the parts list, once and sorted, and the codes of all parts as places in that."""
    known, at = _distinct(np.concatenate(parts))
    at = np.split(at, np.cumsum([len(p) for p in parts])[:-1])
    return known, [np.concatenate([a[c] for a, c in zip(at, some, strict=True)]) for some in codes]


def _losses(pairs: list[tuple], model: Model) -> tuple[np.ndarray, list[np.ndarray]]:
    words, firsts, seconds, rows, lengths, texts, marks, ended = zip(*pairs, strict=True)
    word, (first, second) = _joint([np.cumsum(w) for w in words], [firsts, [np.cumsum(s) for s in seconds]])
    text, (row,) = _joint([np.cumsum(r) for r in rows], [texts])
    length = np.concatenate([n[t] for n, t in zip(lengths, texts, strict=True)])
    marks, ended = np.concatenate(marks), np.concatenate(ended)

    # All rows of a pair and of a second word together
    pair = second * len(word) + first
    order = np.argsort(pair)
    pair, second, row, length, marks, ended = (x[order] for x in (pair, second, row, length, marks, ended))
    times, last, target = marks >> 2, marks >> 1 & 1, marks & 1
    begun = times - last
    pairs_at, words_at = _starts(pair), _starts(second)
    sizes = np.diff(words_at, append=len(second))
    frequent, place = model.places(word[second[words_at]])
    rare = np.repeat(~frequent, sizes)

    # Of rare words a text's own counts are all here
    own = np.flatnonzero(target & rare)
    group, own_begun = row[own] * len(word) + second[own], np.zeros(len(row), np.int64)
    ended[own], own_begun[own] = _sums(group, times[own]), _sums(group, begun[own])
    sums = []
    for m, counts in enumerate((target, 1)):
        own = target if m == 0 else 0
        single = np.where(frequent, model.single[m][place], np.add.reduceat(times * counts, words_at))
        after = np.repeat(np.add.reduceat(begun * counts, words_at), sizes)
        both = np.repeat(np.add.reduceat(times * counts, pairs_at), np.diff(pairs_at, append=len(pair)))
        over = model.over(m, both - own * times, np.repeat(single, sizes) - own * ended, own * length)
        under = np.where(rare, begun * np.log2(model.under(m, np.where(rare, after - own * own_begun, 0))), 0)
        sums.append(np.bincount(row, weights=under - times * np.log2(over)))
    return text, sums


def score(
    docs: DataFrame,
    labels: DataFrame,
    prior: float = PRIOR,
    floor: float = FLOOR,
    text: str = "text",
    at_once: int = PAIRS,
) -> DataFrame:
    """For each document doc_id, n_words, target_loss and background_loss (bits a word) and score, their difference.

    The background model counts neighbours in all documents, the target model in those that ``labels`` calls of good
    quality (``quality`` 1 in any row of the id). A labelled document is scored by what the target model knows from the
    others: its own counts are taken off there, so that labelled and unlabelled documents compare. In the background model
    they stay, as all documents are in it: without them a document with a copy would look far more like the background
    than one without. A word leans on its probability by itself with the weight ``prior``, and that on all words being
    equal with ``floor``. Both models have the same vocabulary, all words of the corpus, the same smoothing, and counts
    brought to the same total, so that they
    differ in what they have seen and not in how much. The lower the score, the more a document is like the target.

    Texts are cut into words once, and their words kept as numbers. Each text's distinct pairs move once, in compressed blocks, to the bucket of their second word, which has all pairs with
    that word and so all counts that the pair and the word need. Words that more than one in eight times ``buckets`` words is,
    so at most that many, are known to all tasks with their counts, and their pairs are dealt by both words: a hot word
    is spread, and a hot pair brings no more rows than there are documents. Buckets grow in number, about one for
    ``at_once`` pairs. The driver gets totals and the counts of those frequent words. Words are told apart by hashes of 64 bits.
    Texts meet their labels by a merge join at every size, so that what is moved grows with the input.

    A null or empty text has no words, losses and score 0. Without good labels both models are uniform mixtures and
    finite. Repeated rows count and are scored each. Null ids match no label. Other columns are left out. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = working_folder(spark)
    rows = docs.select(row_id().alias("_id"), text_of(text).alias("text"))
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("_good")).distinct()
    labelled = rows.join(good.hint("merge"), rows["_id"] == good["_good"], "left").select("_id", "text", F.col("_good").isNotNull().alias("is_target"))
    labelled = labelled.withColumn("_row", F.monotonically_increasing_id())
    texts = kept(coded(labelled, at_once), folder, "coded", **GROUPS)
    counts = kept(counted(texts), folder, "words")
    names = ("target", "everything")
    seen = counts.agg(F.count_if(F.col("word") != 0).alias("words"), *(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in names)).first()
    buckets = max(BUCKETS, seen["everything"] // at_once + 1)
    known = counts.where((F.col("word") == 0) | (F.col("everything") * (8 * buckets) > seen["everything"])).collect()
    known = sorted(known, key=lambda r: r["word"])
    model = Model(
        frequent=np.array([r["word"] for r in known] or [0], np.int64),
        single=tuple(np.array([r[m] for r in known] or [0]) for m in names),
        after=tuple(np.array([r[m] - r[f"{m}_last"] for r in known] or [0]) for m in names),
        seen=tuple(seen[m] for m in names),
        scales=tuple(max(1, min(seen[n] for n in names)) / max(1, seen[m]) for m in names),
        size=seen["words"] + 1,
        buckets=buckets,
        prior=prior,
        floor=floor,
    )
    dropped(spark, folder, "words")
    sums = losses(blocks(texts, model), model).groupBy("_row").agg(*(F.sum(n).alias(n) for n in ("n_words", *names)))
    listed = texts.select(F.explode(F.arrays_zip("rows", "ids")).alias("one")).select(F.col("one.rows").alias("_row"), F.col("one.ids").alias("_id"))
    rated = listed.join(sums, "_row", "left")
    nil = F.lit(0.0)
    rated = rated.select(
        F.nullif("_id", F.lit(NO_ID)).alias("doc_id"),
        F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
        F.coalesce(F.col("target") / F.col("n_words"), nil).alias("target_loss"),
        F.coalesce(F.col("everything") / F.col("n_words"), nil).alias("background_loss"),
    )
    return rated.withColumn("score", F.col("target_loss") - F.col("background_loss"))
