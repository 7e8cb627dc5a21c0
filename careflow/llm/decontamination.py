"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache, reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.llm.shared import NO_ID, fingerprint, kept, row_id, text_of, whole_row, working_folder

#: Words of a window, and how many of them have to agree.
WINDOW, AGREE = 12, 9

#: Word positions that a seed reads; it ignores those between. Any window of 12 words of which 9 agree holds one of these.
MASKS = ((0, 1, 2, 4), (0, 2, 3, 4))

#: Seeds joined at once, of about 40 bytes each. More are joined in as many parts, each over all documents.
SEEDS_AT_ONCE = 1_000_000

#: Items of up to so many words have to agree in all of them; seeds of longer ones read as many.
SHORT = 4


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), "")


def allowed(size: int, window: int, agree: int) -> int:
    """Words of an item shorter than the window that may differ: the window's share, none in up to SHORT words."""
    return 0 if size <= SHORT else size * (window - agree) // window


@lru_cache
def short_masks(size: int, window: int, agree: int) -> tuple[tuple[int, ...], ...]:
    """Word positions that the seeds of an item of ``size`` words read: whichever allowed words differ, one seed reads none.

    Masks are chosen one by one, each the one that leaves out most of the sets of words not left out so far.
    """
    spare, masks = allowed(size, window, agree), []
    left = set(combinations(range(size), spare))
    while left:
        ignored = max(combinations(range(size), max(size - SHORT, spare) if spare else 0), key=lambda gone: sum(set(gone).issuperset(x) for x in left))
        left = {x for x in left if not set(ignored).issuperset(x)}
        masks.append(tuple(i for i in range(size) if i not in ignored))
    return tuple(masks)


def all_masks(window: int, agree: int, masks: tuple[tuple[int, ...], ...]) -> tuple[list[tuple[int, ...]], dict[int, range]]:
    """The masks of windows and then those of every shorter size, numbered, and the numbers of each such size."""
    every, numbers = list(masks), {}
    for size in range(1, window):
        own = short_masks(size, window, agree)
        numbers[size] = range(len(every), len(every) + len(own))
        every += own
    return every, numbers


def items_of(benchmark: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Distinct word lists of the benchmark with a key, and the ids of each key."""
    rows = benchmark.select(F.col("item_id"), words(text_of(text)).alias("_item"))
    one = rows.groupBy("_item").agg(F.min("item_id").alias("_first")).select("_item", F.xxhash64("_first", "_item").alias("_key"))
    ids = rows.join(one, "_item").select("_key", "item_id").distinct()
    return one.select("_item", "_key", F.size("_item").alias("_size")), ids


def seed(masked: tuple[int, ...], number: int, word_list: str, at: str) -> Column:
    return F.xxhash64(F.lit(number), *(F.get(word_list, F.col(at) + i) for i in masked))


def seeds_of(items: DataFrame, window: int, agree: int, masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """Mask, hash, item and place of every seed of every item: at all places of long ones, of short ones at their start."""
    every, short = all_masks(window, agree, masks)

    def seeds(numbers: Iterable[int]) -> Column:
        return F.array(*(F.struct(F.lit(i).alias("_mask"), seed(every[i], i, "_item", "_at").alias("_seed")) for i in numbers))

    span = max(map(max, masks))
    places = items.where(F.col("_size") >= window).select("_key", "_size", "_item", F.posexplode("_item").alias("_at", "_word")).where(F.col("_at") + span < F.col("_size"))
    starts = items.where(F.col("_size").between(1, window - 1)).withColumn("_at", F.lit(0))
    of_size = F.coalesce(*(F.when(F.col("_size") == size, seeds(numbers)) for size, numbers in short.items()))
    both = (places.select("_key", "_size", "_at", seeds(range(len(masks))).alias("_all")), starts.select("_key", "_size", "_at", of_size.alias("_all")))
    return both[0].unionByName(both[1]).select("_key", "_size", "_at", F.explode("_all").alias("_one")).select("_key", "_size", "_at", "_one.*")


def hits_of(rows: DataFrame, seeds: DataFrame, masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """Documents' words beside items on diagonals with a common seed.

    The words stay beside the exploded places within one generated stage; only matches leave it, with the words that
    lie beside the item.
    """
    at = rows.select("_id", "_fp", "_words", F.posexplode_outer("_words").alias("_pos", "_word"))
    hashes = F.array(*(seed(m, i, "_words", "_pos") for i, m in masks.items())).cast("array<bigint>")
    at = at.select("_id", "_fp", "_words", "_pos", F.explode_outer(hashes).alias("_doc_seed"))
    met = at.join(F.broadcast(seeds), F.col("_doc_seed") == F.col("_seed"))
    diagonal = F.col("_pos") - F.col("_at")
    first = F.greatest(diagonal, F.lit(0))
    beside = F.slice("_words", first + 1, F.col("_size") + diagonal - first)
    return met.select("_id", "_fp", "_key", diagonal.alias("_diagonal"), beside.alias("_beside")).distinct()


def verified(hits: DataFrame, items: DataFrame, window: int, agree: int) -> DataFrame:
    """Diagonals on which some window, or the whole of a shorter item, agrees in enough words."""
    both = hits.join(items, "_key")
    item_from = F.greatest(-F.col("_diagonal"), F.lit(0))
    opposite = F.slice("_item", item_from + 1, F.size("_beside"))
    both = both.withColumn("_same", F.zip_with("_beside", opposite, lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int")))
    sums = F.transform(F.sequence(F.lit(0), F.size("_same") - window), lambda i: F.aggregate(F.slice("_same", i + 1, window), F.lit(0), lambda a, b: a + b))
    total = F.aggregate("_same", F.lit(0), lambda a, b: a + b)
    spare = F.element_at(F.array(*(F.lit(allowed(size, window, agree)) for size in range(1, window))), F.col("_size"))
    short = F.when((F.col("_size") < window) & (F.size("_same") == F.col("_size")), total >= F.col("_size") - spare).otherwise(False)
    long = F.when(F.size("_same") >= window, F.array_max(sums) >= agree).otherwise(False)
    good = both.where(short | long)
    return good.select("_id", "_fp", "_key", "_diagonal", total.alias("n_agree"), F.size("_same").alias("n_compared"), F.greatest("_diagonal", F.lit(0)).alias("first_word"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    agree: int = AGREE,
    masks: tuple[tuple[int, ...], ...] = MASKS,
    text: str = "text",
) -> DataFrame:
    """Benchmark items that stand in a document: doc_id, item_id, n_agree, n_compared, first_word; no row for clean ones.

    Words are lower-cased runs of letters, marks and digits. Seeds of documents and items that agree set an item beside
    a document's words; it counts if ``agree`` of some ``window`` words in a row agree, whatever the others are. The best
    such place is given: the words that agree, the words compared, and the document's first one of these. An item
    shorter than the window has to stand there whole and may differ in the same share of its words, rounded down, and in none
    if it has up to SHORT words.

    Null texts and items are empty, and an empty item stands nowhere. Items with the same words are compared once and
    given each; rows that repeat in doc_id and text give their pairs once. Ties take the earliest place. Other columns are left out. Empty tables give
    an empty result. Texts of any length are read whole.
    """
    folder = working_folder(docs.sparkSession)
    distinct, ids = items_of(benchmark, "text")
    items, ids = kept(distinct, folder, "items"), kept(ids, folder, "ids")
    seeds = kept(seeds_of(items, window, agree, masks), folder, "seeds")
    every = all_masks(window, agree, masks)[0]
    used = {r._mask: every[r._mask] for r in seeds.select("_mask").distinct().orderBy("_mask").collect()}  # at most all masks
    parts = max(1, -(-seeds.count() // SEEDS_AT_ONCE))
    rows = docs.select("doc_id", row_id().alias("_id"), fingerprint(text).alias("_fp"), words(text_of(text)).alias("_words"))
    found = [hits_of(rows, seeds if parts == 1 else seeds.where(F.pmod("_seed", F.lit(parts)) == i), used) for i in range(parts)]
    hits = reduce(DataFrame.union, found)
    good = verified(hits if parts == 1 else hits.distinct(), items, window, agree)
    best = good.groupBy("_id", "_fp", "_key").agg(F.max(F.struct("n_agree", (-F.col("_diagonal")).alias("_late"), "n_compared", "first_word")).alias("_best"))
    doc_id = F.when(F.col("_id") != F.lit(NO_ID), F.col("_id")).alias("doc_id")
    return best.join(ids, "_key").select(doc_id, "_fp", "item_id", *(F.col(f"_best.{c}").cast("long").alias(c) for c in ("n_agree", "n_compared", "first_word")))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, in which no benchmark item stands.

    Null and empty texts hold none, and neither does any text if the benchmark is empty. Rows that agree in id and text stay or
    go together; ids may be null, columns may have any names and texts any length.
    """
    found = leaks(docs, benchmark, text=text).select(row_id().alias("_found"), "_fp").distinct()
    rows = docs.select(row_id().alias("_id"), fingerprint(text).alias("_row_fp"), whole_row(docs).alias("_row"))
    return rows.join(found, (rows["_id"] == found["_found"]) & (rows["_row_fp"] == found["_fp"]), "left_anti").select("_row.*")
