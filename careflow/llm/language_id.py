"""Language identification by a convolutional network over bytes, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.llm.shared import text_of

#: What a text without letters is given.
UNDETERMINED = "und"

#: Bytes of a window, widths of the filters in bytes, filters of each width and numbers that stand for a byte.
WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4, 5), 12, 8

#: Bounds of the labelled sample: languages (those with most rows), rows of each, rows in all, windows of a row.
LANGUAGES, LANGUAGE_ROWS, SAMPLE_ROWS, ROW_WINDOWS = 1000, 600, 20_000, 8

#: Rows of a language, in LANGUAGE_ROWS, among which its sample is chosen.
SPARE = 4

#: Training steps, windows of a step, step size.
STEPS, BATCH, RATE = 500, 64, 0.005

#: Windows that go through the network together: few, so that they stay in a core's cache.
AT_ONCE = 32

PADDING = 256
LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that nothing is learned from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sample(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], list[bytes], np.ndarray]:
    """Languages, windows and the language of each window, from a bounded number of labelled rows.

    Of each language the rows with the smallest hashes are taken. How many rows it has gives a bound that only some more
    hashes than needed are under, so few texts are moved however many there are. A row gives windows spread evenly over
    its whole text.
    """
    learnable = docs.where(F.col(lang).isNotNull() & ~held_out())
    sizes = learnable.groupBy(F.col(lang).cast("string").alias("_lang")).agg(F.count(F.lit(1)).alias("_n"))
    rows = learnable.select(F.col(lang).cast("string").alias("lang"), F.lower(text_of(text)).alias("text"), F.xxhash64("doc_id", text).alias("hash"))
    share = F.shiftrightunsigned("hash", 1) / F.lit(2.0**63)
    sizes = sizes.orderBy(F.desc("_n"), "_lang").limit(LANGUAGES)
    rows = rows.join(F.broadcast(sizes), rows["lang"] == sizes["_lang"]).withColumn("share", share).where(F.col("share") * F.col("_n") < SPARE * LANGUAGE_ROWS)
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("share", "text"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= LANGUAGE_ROWS).orderBy("rank", "lang", "share", "text").limit(SAMPLE_ROWS)
    data = F.encode("text", "UTF-8")
    last = F.greatest(F.octet_length("text") - WINDOW, F.lit(0))
    starts = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(ROW_WINDOWS - 1)), lambda i: (last * i / (ROW_WINDOWS - 1)).cast("int") + 1))
    windows = F.transform(starts, lambda at: F.substring(data, at, F.lit(WINDOW)))
    found = few.select("lang", windows.alias("windows")).collect()
    languages = sorted({r.lang for r in found})
    number = {name: i for i, name in enumerate(languages)}
    pieces = [(bytes(w), number[r.lang]) for r in found for w in r.windows]
    return languages, [w for w, _ in pieces], np.array([i for _, i in pieces], np.int64)


def matrix(windows: list[bytes]) -> np.ndarray:
    """Byte numbers, one row for each window, padded to its length and by the widest filter."""
    out = np.full((len(windows), WINDOW + max(WIDTHS) - 1), PADDING, np.int64)
    for row, window in zip(out, windows, strict=True):
        row[: len(window)] = np.frombuffer(window, np.uint8)
    return out


@dataclass
class Network:
    """Embedding of bytes, filters of several widths, their highest response in a window, and a softmax over languages.

    Filters are columns over the widest span; a narrower one is zero beyond its own width.
    """

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    @classmethod
    def new(cls, languages: int, rng: np.random.Generator) -> Network:
        n = len(WIDTHS) * FILTERS
        draw = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
        embedding = draw(PADDING + 1, EMBEDDING)
        embedding[PADDING] = 0
        filters = draw(max(WIDTHS) * EMBEDDING, n) * cls.mask() * np.float32(0.2)
        return cls(embedding, filters, np.zeros(n, np.float32), draw(n, languages) * np.float32(0.1), np.zeros(languages, np.float32))

    @staticmethod
    def mask() -> np.ndarray:
        span = np.arange(max(WIDTHS) * EMBEDDING)[:, None] // EMBEDDING
        return (span < np.repeat(WIDTHS, FILTERS)).astype(np.float32)

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        scores = np.maximum(pooled, 0) @ self.weights + self.offset
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)

    def tables(self) -> list[np.ndarray]:
        """What each byte adds to the filters that see it, by its place in their span; only filters that wide have a column."""
        steps = self.filters.reshape(max(WIDTHS), EMBEDDING, -1)
        return [self.embedding @ steps[j][:, FILTERS * sum(w <= j for w in WIDTHS) :] for j in range(max(WIDTHS))]

    def responses(self, numbers: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Each filter's response, without its bias, at each place of each window: the convolution as sums of table rows."""
        total = np.take(tables[0], numbers[:, :WINDOW], axis=0)
        for j, table in enumerate(tables[1:], 1):
            total[:, :, total.shape[2] - table.shape[1] :] += np.take(table, numbers[:, j : j + WINDOW], axis=0)
        return total

    def predict(self, numbers: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        return self.probabilities(self.responses(numbers, tables).max(axis=1) + self.bias)

    def gradients(self, numbers: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy; only the place of each filter's highest response passes anything back."""
        responses = self.responses(numbers, self.tables())
        place = responses.argmax(axis=1)
        pooled = np.take_along_axis(responses, place[:, None], axis=1)[:, 0] + self.bias
        wrong = self.probabilities(pooled)
        wrong[np.arange(len(wanted)), wanted] -= 1
        wrong /= np.float32(len(wanted))
        back = (wrong @ self.weights.T) * (pooled > 0)
        at = place[:, :, None] + np.arange(max(WIDTHS))
        bytes_seen = numbers[np.arange(len(numbers))[:, None, None], at]
        seen = self.embedding[bytes_seen].reshape(*back.shape, -1)  # window, filter, span
        filters = np.einsum("nf,nfs->sf", back, seen, optimize=True) * self.mask()
        spans = (back[:, :, None] * self.filters.T[None]).reshape(*back.shape, max(WIDTHS), EMBEDDING)
        embedding = np.zeros_like(self.embedding)
        np.add.at(embedding, bytes_seen, spans)
        embedding[PADDING] = 0
        return [embedding, filters, back.sum(axis=0), np.maximum(pooled, 0).T @ wrong, wrong.sum(axis=0)]


def trained(windows: list[bytes], wanted: np.ndarray, languages: int, seed: int = 11) -> Network:
    """A network fitted by Adam; each step draws as many windows of every language."""
    rng = np.random.default_rng(seed)
    network = Network.new(languages, rng)
    parts = list(vars(network).values())
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    numbers = matrix(windows)
    by_language = [np.flatnonzero(wanted == i) for i in range(languages)]
    for step in range(1, STEPS + 1):
        labels = rng.permutation(np.arange(BATCH) % languages) if languages <= BATCH else rng.integers(0, languages, BATCH)
        rows = np.array([rng.choice(by_language[i]) for i in labels])
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for part, slope, m, v in zip(parts, network.gradients(numbers[rows], labels), first, second, strict=True):
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            part -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def cut(text: str) -> list[bytes]:
    """All windows of a text; neighbouring ones overlap, so that a filter sees every place."""
    data = text.lower().encode()
    stride = WINDOW - max(WIDTHS) + 1
    return [data[at : at + WINDOW] for at in range(0, max(len(data) - max(WIDTHS) + 1, 1), stride)]


def recognised(texts: list[str | None], network: Network | None, languages: list[str]) -> tuple[list[str], list[float]]:
    """The language of each text with the highest probability, averaged over its windows by their bytes."""
    judged = [i for i, t in enumerate(texts) if network is not None and t is not None and LETTER.search(t)]
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    tables = network.tables() if judged else []
    sums, weights = np.zeros((len(judged), len(languages))), np.zeros(len(judged))

    def flush(owners: list[int], windows: list[bytes]) -> None:
        sizes = np.array(list(map(len, windows)), np.float64)
        np.add.at(sums, owners, network.predict(matrix(windows), tables) * sizes[:, None])
        np.add.at(weights, owners, sizes)

    owners: list[int] = []
    windows: list[bytes] = []
    for place, i in enumerate(judged):
        for window in cut(texts[i]):
            owners.append(place)
            windows.append(window)
            if len(windows) == AT_ONCE:
                flush(owners, windows)
                owners, windows = [], []
    if windows:
        flush(owners, windows)
    for place, i in enumerate(judged):
        best = int(sums[place].argmax())
        names[i], scores[i] = languages[best], min(1.0, float(sums[place, best] / weights[place]))
    return names, scores


def identify(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """For each document the language its text is most probably in: doc_id, held_out, lang_pred, score.

    The network learns from a bounded sample of rows with a language that are not held out (LANGUAGE_ROWS of each of the LANGUAGES most
    frequent languages, SAMPLE_ROWS in all); predictions see the text alone. All windows of a text are judged, whatever its length, and ``score`` is
    the mean probability of the language given. A text that is null, empty or has no letter is ``und`` with score 0, and so
    is every text where no row has a language to learn. Ids may be null or repeat; repeated rows are each judged; of tied
    languages the first by name is given. Other columns of the input are left out whatever their names. An empty
    table gives an empty result.
    """
    languages, windows, wanted = sample(docs, text, lang)
    network = trained(windows, wanted, len(languages)) if languages else None

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = recognised(batch.column(2).to_pylist(), network, languages)
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(judge, "doc_id long, held_out boolean, lang_pred string, score double")
