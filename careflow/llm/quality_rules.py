"""Quality rules with thresholds that quantile sketches set for each language and source; DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.llm.shared import fingerprint, kept, text_of, whole_row, working_folder

#: Characters that part words, and that count as symbols.
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, REPEATED = 50, 50

#: Rows that a source needs for quartiles of its own, and that small sources of a language need together: five times as
#: many, so that none of them holds a quarter.
OWN_ROWS, POOL_ROWS = 20, 100


@dataclass(frozen=True)
class Feature:
    """A measure of a document and how far above its group's upper quartile it may lie.

    The reach is ``reach`` times the distance of the quartiles, at least ``least``, the finest difference that counts.
    """

    name: str
    value: Column
    reach: float
    least: float


def features() -> tuple[Feature, ...]:
    words = F.greatest("n_words", F.lit(1))
    return (
        Feature("symbols", F.col("n_symbols") / words, 6.0, 0.1),
        Feature("repeats", F.col("n_repeat_words") / words, 6.0, 0.25),
        Feature("dup_lines", F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), 6.0, 0.3),
        Feature("shouts", F.col("n_shouts") / words, 6.0, 0.2),
        Feature("word_length", F.col("word_chars") / words, 6.0, 4.0),
    )


def repeated_words(hashes: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are sorted by hash with their starts beside; those with an equal neighbour are the repeated ones, and
    their starts in order give the words they cover.
    """
    marked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    paired = F.zip_with(marked, F.slice(marked, 2, F.size(marked)), lambda a, b: F.struct(a["i"].alias("a"), F.when(a["h"] == b["h"], b["i"]).alias("b")))
    starts = F.array_distinct(F.flatten(F.transform(F.filter(paired, lambda p: p["b"].isNotNull()), lambda p: F.array(p["a"], p["b"]))))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda s: F.array(s, s + 1, s + 2))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.size(covered)).otherwise(0)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """For each row doc_id, _fp, lang, source, the counts that the rules use and ``base_failed``.

    ``n_lines`` counts lines with a word, ``n_shouts`` words that begin with two capitals.
    """
    named = [F.col(c).cast("string").alias(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    rows = docs.select("doc_id", fingerprint(text).alias("_fp"), *named, text_of(text).alias("_text"))
    whole = F.regexp_replace("_text", r"[\x20\x09-\x0D]+", " ")
    rows = rows.select(
        "doc_id",
        "_fp",
        "lang",
        "source",
        F.array_remove(F.split(whole, " "), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.regexp_count("_text", F.lit(SYMBOLS)).alias("_symbols"),
        F.regexp_count("_text", F.lit(r"(?<![^\x20\x09-\x0D])\p{Lu}\p{Lu}")).alias("_shouts"),
    )
    at = F.when(F.size("_words") >= 3, F.sequence(F.lit(0), F.size("_words") - 3)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))
    rows = rows.select(
        "doc_id",
        "_fp",
        "lang",
        "source",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.col("_symbols").cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.col("_shouts").cast("long").alias("n_shouts"),
        F.transform(at, window).alias("_hashes"),
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_shouts")
    rows = rows.select("doc_id", "_fp", "lang", "source", *counts, repeated_words(F.col("_hashes")).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def thresholds(stats: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """For each language and source the highest accepted value of every feature.

    Quartiles come from sketches that each task builds and the shuffle merges (``percentile_approx``). A source with
    OWN_ROWS rows or more has its own limits. Smaller ones have those of all small sources of their language together if
    these have POOL_ROWS rows, else the median of the limits of the language's other sources, each counting once; without
    others, those of the small ones all the same. So a source never sets another one's limit by its size.
    """
    measured = stats.where(~F.col("base_failed")).select("lang", "source", *(f.value.alias(f"_{f.name}") for f in features()))
    sketches = [F.percentile_approx(f"_{f.name}", [0.25, 0.75], accuracy).alias(f"_q_{f.name}") for f in features()]
    limits = [(F.get(f"_q_{f.name}", 1) + F.greatest(f.reach * (F.get(f"_q_{f.name}", 1) - F.get(f"_q_{f.name}", 0)), F.lit(f.least))).alias(f"_max_{f.name}") for f in features()]
    names = [f"_max_{f.name}" for f in features()]
    by_source = measured.groupBy("lang", "source").agg(F.count("*").alias("_rows"), *sketches).select("lang", "source", "_rows", *limits)
    large, small = by_source.where(F.col("_rows") >= OWN_ROWS), by_source.where(F.col("_rows") < OWN_ROWS)
    few = small.select(F.col("lang").alias("_few_lang"), F.col("source").alias("_few_source"))
    rest = measured.join(few, measured["lang"].eqNullSafe(few["_few_lang"]) & measured["source"].eqNullSafe(few["_few_source"]), "left_semi")
    pooled = rest.groupBy(F.col("lang").alias("_pool_lang")).agg(F.count("*").alias("_pool_rows"), *sketches)
    pooled = pooled.select("_pool_lang", "_pool_rows", *(c.alias(f"_pool{n}") for c, n in zip(limits, names, strict=True)))
    votes = large.groupBy(F.col("lang").alias("_vote_lang")).agg(*(F.percentile_approx(n, 0.5, accuracy).alias(f"_vote{n}") for n in names))
    both = small.join(pooled, small["lang"].eqNullSafe(F.col("_pool_lang"))).join(votes, small["lang"].eqNullSafe(F.col("_vote_lang")), "left")
    limit = lambda n: F.when(F.col("_pool_rows") >= POOL_ROWS, F.col(f"_pool{n}")).otherwise(F.coalesce(f"_vote{n}", f"_pool{n}")).alias(n)
    keys = [F.col("lang").alias("_lang"), F.col("source").alias("_source")]
    return large.select(*keys, *names).unionByName(both.select(*keys, *map(limit, names)))


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """Statistics of each row, with ``kept``: false if base_failed or a feature lies beyond its group's limit."""
    stats = kept(statistics(docs, text), working_folder(docs.sparkSession), "statistics")
    limits = thresholds(stats)
    beyond = F.lit(False)
    for f in features():
        beyond = beyond | F.coalesce(f.value > F.col(f"_max_{f.name}"), F.lit(False))
    both = stats.join(limits, stats["lang"].eqNullSafe(limits["_lang"]) & stats["source"].eqNullSafe(limits["_source"]), "left")
    return both.withColumn("kept", ~F.col("base_failed") & ~beyond)


def rate(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts and verdict for each document.

    Words are runs of characters other than space and U+0009 to U+000D. ``base_failed`` holds below 50 words or where
    more than half of the words lie in repeated 3-word windows. Other documents are kept unless symbols, repeats,
    repeated lines, shouting or word length lie far above the quartiles of their language and source; see ``thresholds``
    for sources with few documents.

    A null text has no words and fails. Null languages and sources form groups of their own, also where the table has
    no such columns. Repeated rows are each rated; ties lie on the same side of a limit. Other columns of the input
    are left out whatever their names. An empty table gives an empty result.
    """
    return judged(docs, text).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def accepted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``rate`` keeps, with all their columns, whatever their names.

    Null and empty texts go. Null ids are ids; rows that agree in id and text are kept or go together. An empty table gives
    an empty result; texts may have any length.
    """
    good = judged(docs, text).where("kept").select(F.col("doc_id").alias("_id"), "_fp")
    rows = docs.select("doc_id", fingerprint(text).alias("_row_fp"), whole_row(docs).alias("_row"))
    found = rows.join(good, rows["doc_id"].eqNullSafe(good["_id"]) & (rows["_row_fp"] == good["_fp"]), "left_semi")
    return found.select("_row.*")
