"""Near-duplicate documents by BagMinHash: banded weighted-Jaccard signatures, verified on multisets of shingles."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.shared import NO_ID, dropped, fingerprint, kept, row_id, text_of, whole_row, working_folder

#: Words of a shingle and the least weighted Jaccard similarity of a link.
SHINGLE, SIMILARITY = 5, 0.8

#: Bands and registers of a band: two texts of similarity 0.8 share no band with a chance of 5e-8.
BANDS, ROWS = 32, 4

#: Shingles of a block of texts that are compared at once.
BLOCK = 300_000

#: Bits of the filter in front of the join that finds the texts of candidates: 8 MB.
FILTER_BITS = 1 << 26

#: Hashes of words kept per Python worker; beyond that the memory starts anew.
REMEMBERED_WORDS = 500_000

WORD = re.compile(r"\w+")
_memory: dict[str, int] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def drawn(seeds: np.ndarray, stream: int) -> np.ndarray:
    """Pseudo-random numbers, always the same for a seed and a stream."""
    return mixed(seeds + np.uint64((stream * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF))


def word_hash(word: str) -> int:
    if len(_memory) >= REMEMBERED_WORDS:
        _memory.clear()
    value = _memory[word] = xxhash.xxh3_64_intdigest(word)
    return value


def shingles(words: list[str], size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of all words if there are fewer."""
    known = _memory.get
    h = np.array([known(w) or word_hash(w) for w in words], np.uint64)
    n = min(size, len(h))
    total = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        total = mixed(total + h[i : len(h) - n + 1 + i] + np.uint64(i + 1))
    return total


def signatures(seeds: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, registers: int) -> np.ndarray:
    """BagMinHash registers of ``n`` multisets, given as element hashes, whole weights and the set of each element.

    The weight axis is cut at powers of two. On each interval an element has one flat Poisson process of points, each
    with a time, a register and a place drawn evenly within the interval; points at or above the element's weight are
    rejected and a register keeps its earliest of the others. Intervals are not split further, unlike in BagMinHash's
    hierarchical process; both give the same distribution. Points are drawn up to a time by which all registers of a set should be filled,
    and further for sets that have empty ones, so only about registers * log(registers) points are drawn for a set however
    many elements it has. Two registers are equal with a probability of exactly the weighted Jaccard similarity.
    """
    out = np.full((n, registers), np.inf)
    parts = [(seeds, owner, np.zeros(len(seeds)), np.ones(len(seeds)), weights)]
    low = 1
    at = np.flatnonzero(weights > 1)
    while len(at):
        parts.append((drawn(seeds[at], 7919 * (low.bit_length() + 1)), owner[at], np.full(len(at), float(low)), np.full(len(at), float(low)), weights[at]))
        low *= 2
        at = at[weights[at] > low]
    process = [np.concatenate(p) for p in zip(*parts, strict=True)]
    total = np.bincount(owner, weights=weights, minlength=n)
    horizon = registers / np.maximum(total, 1) * (np.log(registers) + 3)
    todo = total > 0
    while todo.any():
        seed, own, begin, size, limit = (p[todo[process[1]]] for p in process)
        out[todo] = np.inf
        time = np.zeros(len(seed))
        step = 0
        while len(seed):
            u = (drawn(seed, 3 * step + 1) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            time = time - np.log1p(-u) / size
            live = time <= horizon[own]
            seed, own, begin, size, limit, time = seed[live], own[live], begin[live], size[live], limit[live], time[live]
            draw = drawn(seed, 3 * step + 2)
            place = begin + np.floor(size * ((drawn(seed, 3 * step + 3) >> np.uint64(11)).astype(np.float64) * 2.0**-53))
            hit = place < limit
            np.minimum.at(out.reshape(-1), own[hit] * registers + (draw[hit] % np.uint64(registers)).astype(np.int64), time[hit])
            step += 1
        todo = todo & ~np.isfinite(out).all(axis=1)
        horizon[todo] *= 2
    return out


def band_hashes(registers: np.ndarray, bands: int) -> np.ndarray:
    bits = registers.view(np.uint64).reshape(len(registers), bands, -1)
    total = np.zeros(bits.shape[:2], np.uint64)
    for i in range(bits.shape[2]):
        total = mixed(total + bits[:, :, i])
    return total.view(np.int64)


def signed_texts(rows: DataFrame, shingle: int, bands: int, per_band: int) -> DataFrame:
    """``key`` names a text by its words (by itself where it has none), ``size`` counts its shingles, ``bands`` is its
    signature, null without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                keys, seeds, weights, sizes = [], [], [], []
                for text in batch.column(2).to_pylist():
                    words = WORD.findall(text.lower())
                    keys.append(hashlib.md5((" ".join(words) if words else "\n" + text).encode()).hexdigest())
                    found, n = np.unique(shingles(words, shingle), return_counts=True) if words else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                    seeds.append(found)
                    weights.append(n)
                    sizes.append(len(found))
                owner = np.repeat(np.arange(len(keys)), sizes)
                registers = signatures(np.concatenate(seeds), np.concatenate(weights), owner, len(keys), bands * per_band)
                hashes = [h if n else None for h, n in zip(band_hashes(registers, bands), sizes, strict=True)]
                total = np.bincount(owner, weights=np.concatenate(weights), minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys), pa.array(total), pa.array(hashes, pa.list_(pa.int64()))], ["id", "fp", "key", "size", "bands"])

    return rows.mapInArrow(sign, "id long, fp long, key string, size long, bands array<long>")


def perhaps_among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose id and fingerprint may be those of a ``wanted`` row: all that are, and a few others.

    Bitmaps of hashes tell, FILTER_BITS in all and so of a fixed size. They keep most texts from being moved to the
    join that decides; where so many are wanted that the bitmaps are full, all texts go there.
    """
    place = lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(FILTER_BITS))
    per_map = 1 << 15  # of bitmap_construct_agg
    hashed = wanted.select(place("_id", "_fp").alias("_at"))
    maps = hashed.groupBy(F.floor(F.col("_at") / per_map).alias("_map")).agg(F.bitmap_construct_agg(F.col("_at") % per_map).alias("_bits"))
    both = rows.withColumn("_at", place("id", "fp")).join(F.broadcast(maps), F.floor(F.col("_at") / per_map) == F.col("_map"))
    byte = F.conv(F.hex(F.expr(f"substring(_bits, CAST(_at % {per_map} DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    bit = F.pow(F.lit(2), F.col("_at") % 8).cast("int")
    return both.where(byte.bitwiseAND(bit) != 0).select("id", "fp", "text")


def multisets(rows: DataFrame, shingle: int) -> DataFrame:
    """The shingles of each node's text as a set: a shingle's second and later places count as elements of their own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sets = []
                for text in batch.column(1).to_pylist():
                    h = np.sort(shingles(WORD.findall(text.lower()), shingle))
                    first = np.concatenate(([0], np.flatnonzero(h[1:] != h[:-1]) + 1))
                    again = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
                    sets.append(mixed(h + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "elements"])

    return rows.mapInArrow(cut, "node long, elements array<long>")


def joined_up(links: DataFrame, folder: str, name: str) -> DataFrame:
    """Connected components of links (a, b): ``node`` and the smallest node it is connected with, ``comp``.

    Each component hooks to its smallest neighbour; parents then jump to their parents until they are roots, and
    links are taken between roots. Every step is a table in the shared folder, which goes when the next one is there.
    """
    spark = links.sparkSession
    labels = kept(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().select("node", F.col("node").alias("comp")), folder, f"{name}_labels")
    edges, step = links.select("a", "b"), 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = kept(both.where("a > b").groupBy(F.col("a").alias("child")).agg(F.min("b").alias("parent")), folder, f"{name}_{step}_parents")
        jump = 0
        while True:
            up = parents.select(F.col("child").alias("_c"), F.col("parent").alias("_p"))
            if parents.join(up, parents["parent"] == up["_c"], "left_semi").isEmpty():
                break
            parents = kept(parents.join(up, parents["parent"] == up["_c"], "left").select("child", F.coalesce("_p", "parent").alias("parent")), folder, f"{name}_{step}_jump_{jump}")
            jump += 1
        labels = labels.join(parents, labels["comp"] == parents["child"], "left").select("node", F.coalesce("parent", "comp").alias("comp"))
        labels = kept(labels, folder, f"{name}_{step}_labels")
        dropped(spark, folder, f"{name}_labels" if not step else f"{name}_{step - 1}_labels")
        roots = parents.select(F.col("child").alias("_c"), F.col("parent").alias("_p"))
        moved = edges
        for end in ("a", "b"):
            moved = moved.join(roots, moved[end] == roots["_c"], "left").withColumn(end, F.coalesce("_p", end)).drop("_c", "_p")
        edges = kept(moved.where("a <> b").distinct(), folder, f"{name}_{step}_edges")
        dropped(spark, folder, f"{name}_{step}_parents", *(f"{name}_{step}_jump_{i}" for i in range(jump)), f"{name}_{step - 1}_edges")
        step += 1
    return labels


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose multisets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("_left"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("_right"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    common = F.size(F.array_intersect("_left", "_right"))
    return both.where(common >= F.lit(similarity) * (F.size("_left") + F.size("_right") - common)).select("a", "b")


def linked(members: pd.DataFrame, others: pd.DataFrame, similarity: float) -> list[tuple[int, int]]:
    """Links from members to others by an inverted index of the others' elements; one for each member and component."""
    sizes = np.array([len(e) for e in others["elements"]])
    elements, at = np.unique(np.concatenate(list(others["elements"])), return_inverse=True)
    order = np.argsort(at, kind="stable")
    holders = np.repeat(np.arange(len(others)), sizes)[order]
    begin = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=len(elements)))))
    nodes, comps, out = others["node"].to_numpy(), others["comp"].to_numpy(), []
    for node, comp, own in zip(members["node"], members["comp"], members["elements"], strict=True):
        place = np.searchsorted(elements, own)
        place = place[elements[np.minimum(place, len(elements) - 1)] == own]
        held = [holders[begin[i] : begin[i + 1]] for i in place]
        common = np.bincount(np.concatenate(held), minlength=len(others)) if held else np.zeros(len(others), np.int64)
        near = np.flatnonzero((common >= similarity * (sizes + len(own) - common)) & (comps != comp))
        out += [(node, nodes[near[i]]) for i in np.unique(comps[near], return_index=True)[1]]
    return out


def across(mixed_members: DataFrame, sets: DataFrame, similarity: float, folder: str) -> DataFrame:
    """Links between members of different components whose buckets hang together.

    Members outside a group's largest component meet all members of the group, block by block. A block has as many
    members as hold ``BLOCK`` shingles together, and gives links only, never the pairs that it compared.
    """
    least = mixed_members.groupBy("bucket").agg(F.min("node").alias("b"))
    chained = kept(mixed_members.join(least, "bucket").where("node <> b").select(F.col("node").alias("a"), "b").distinct(), folder, "chained")
    groups = joined_up(chained, folder, "groups").select("node", F.col("comp").alias("group"))
    nodes = kept(mixed_members.select("node", "size", "comp").distinct().join(groups, "node"), folder, "grouped")
    counts = nodes.groupBy("group", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    stats = counts.groupBy("group").agg(F.max(F.struct("n", "comp", "shingles")).alias("top"), F.sum("shingles").alias("all"))
    stats = stats.select("group", F.col("top.comp").alias("largest"), F.ceil(F.col("all") / BLOCK).alias("all_blocks"), F.ceil((F.col("all") - F.col("top.shingles")) / BLOCK).alias("out_blocks"))
    placed = nodes.join(stats, "group").join(sets.hint("merge"), "node")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ("group", "node", "comp", "elements")
    outside = placed.where("comp <> largest").select(*columns, F.lit(True).alias("is_out"), block("out_blocks").alias("out"), each("all_blocks").alias("in"))
    inside = placed.where("out_blocks > 0").select(*columns, F.lit(False).alias("is_out"), each("out_blocks").alias("out"), block("all_blocks").alias("in"))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        out, others = part[part["is_out"]], part[~part["is_out"]]
        found = linked(out, others, similarity) if len(out) and len(others) else []
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return outside.union(inside).groupBy("group", "out", "in").applyInPandas(compare, "a long, b long")


def components(members: DataFrame, sets: DataFrame, similarity: float, folder: str) -> DataFrame:
    """Components of all verified links between texts that share a bucket, without a row for each two members.

    First each member of a bucket is compared with its most central one, that with the most company in all its buckets.
    Where a bucket's members are then in several components, those outside the largest one meet the others in blocks, so no
    link between components is missed.
    """
    company = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    degree = members.join(company, "bucket").groupBy("node").agg(F.sum("n").alias("degree"))
    central = members.join(degree, "node").groupBy("bucket").agg(F.max(F.struct("degree", "node", "size")).alias("one"))
    central = central.select("bucket", F.col("one.node").alias("b"), F.col("one.size").alias("other_size"))
    fits = F.least("size", "other_size") >= F.lit(similarity) * F.greatest("size", "other_size")
    pairs = members.join(central, "bucket").where("node <> b").where(fits).select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()
    links = kept(verified(pairs, sets, similarity), folder, "links")
    comps = joined_up(links, folder, "first")
    of_node = comps.select(F.col("node").alias("_n"), "comp")
    named = kept(members.join(of_node, members["node"] == of_node["_n"], "left").select("bucket", "node", "size", F.coalesce("comp", "node").alias("comp")), folder, "members_named")
    several = named.groupBy("bucket").agg((F.min("comp") < F.max("comp")).alias("several")).where("several").select("bucket")
    more = kept(across(kept(named.join(several, "bucket", "left_semi"), folder, "mixed"), sets, similarity, folder), folder, "more")
    if more.isEmpty():
        return comps
    return joined_up(links.union(more.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).distinct(), folder, "last")


def classes(
    docs: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    per_band: int = ROWS,
    text: str = "text",
) -> DataFrame:
    """One row for each document: doc_id, _fp, class_id, class_size.

    Two texts are linked if their multisets of ``shingle``-word shingles have a weighted Jaccard similarity of
    ``similarity`` or more; a class is what links connect, and its id is the smallest doc_id in it. Words are lower-cased
    runs of letters, digits and underscores. Texts with the same words are one node. Texts of fewer words than a shingle have one
    shingle of all words. Texts without words are alike only if equal, null as empty. Rows that repeat count and are given
    each. A class whose ids are all null has a null id. Other columns are left out; an empty table gives an empty result.
    """
    folder = working_folder(docs.sparkSession)
    rows = docs.select(row_id().alias("id"), fingerprint(text).alias("fp"), text_of(text).alias("text"))
    signed = kept(signed_texts(rows, shingle, bands, per_band), folder, "signed")
    found = signed.groupBy("key").agg(F.min(F.struct("id", "fp")).alias("one"), F.min("size").alias("size"), F.min("bands").alias("bands"))
    nodes = kept(found.select(F.monotonically_increasing_id().alias("node"), "key", "one.id", "one.fp", "size", "bands"), folder, "nodes")
    banded = nodes.select("node", "size", F.posexplode("bands").alias("_band", "_hash")).select("node", "size", F.xxhash64("_band", "_hash").alias("bucket"))
    shared = banded.groupBy("bucket").count().where("count > 1").select("bucket")
    members = kept(banded.join(shared, "bucket", "left_semi"), folder, "members")
    one = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("id").alias("_id"), F.col("fp").alias("_fp"))
    one = kept(one, folder, "one")
    some = perhaps_among(rows, one)
    texts = some.join(one.hint("merge"), (some["id"] == one["_id"]) & (some["fp"] == one["_fp"])).select("node", "text")
    sets = kept(multisets(texts, shingle).dropDuplicates(["node"]), folder, "sets")
    comps = components(members, sets, similarity, folder)
    dropped(docs.sparkSession, folder, "members", "members_named", "mixed", "chained", "grouped", "sets", "one")
    of_key = nodes.join(comps, "node", "left").select("key", F.coalesce("comp", "node").alias("comp"))
    named = kept(signed.select("id", "fp", "key").join(of_key, "key").select("id", "fp", "comp"), folder, "named")
    ids = named.groupBy("comp").agg(F.min(F.nullif("id", F.lit(NO_ID))).alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.min(F.struct((F.col("id") == NO_ID).alias("is_null"), "id", "fp")).alias("_first"))
    return named.join(ids, "comp").select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), F.col("fp").alias("_fp"), "class_id", "class_size", "_first")


def deduplicated(docs: DataFrame, text: str = "text") -> DataFrame:
    """The row of each class, with all columns, that comes first by doc_id, null ids last.

    Null and empty texts are alike. Of rows that agree in id and text one stays. An empty table gives an empty result; columns
    may have any names and texts any length.
    """
    first = classes(docs, text=text).select("_first.id", "_first.fp").distinct().select(F.col("id").alias("_first_id"), F.col("fp").alias("_first_fp"))
    rows = docs.select(row_id().alias("_id"), fingerprint(text).alias("_fp"), whole_row(docs).alias("_row"))
    best = rows.join(first, (rows["_id"] == first["_first_id"]) & (rows["_fp"] == first["_first_fp"]), "left_semi")
    return best.dropDuplicates(["_id", "_fp"]).select("_row.*")
