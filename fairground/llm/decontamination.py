"""Benchmark decontamination by greedy string tiling.

Words of documents and test items meet in shared runs of ``seed`` words, by rolling Karp-Rabin hashes: the items' seeds
are a table, a bounded filter of its hashes tells which windows of a document may be one, and these are joined with it.
In each document that shares seeds with an item, the longest matches that do not overlap are marked again and again
until none of ``seed`` words is left; the share of the item's words under tiles is its coverage. Since tiles may lie in
any order, passages that were moved about are caught like whole ones. Items of fewer words are one seed each.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairground.llm.common import Scratch, concat, free_name, hash_words, mix, runs, slices, split_words, text_column

#: Bits of the filter, as powers of two: at least, and at most whatever the number of items (16 MB).
LEAST_BITS, MOST_BITS = 20, 27
#: Found rows up to this many are broadcast to the documents; more are joined by a shuffle.
BROADCAST_FOUND = 200_000

#: Base of the rolling hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

FOUND = "text_key string, item_id long, coverage double, tiles int, longest int"


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words (runs of letters and digits) of each text, and the bounds of each text."""
    words, bounds = split_words(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}]+", " "))
    return hash_words(words), bounds


def windows(hashes: np.ndarray, widths: list[int]) -> dict[int, np.ndarray]:
    """Hashes of all runs of so many words, by width: differences of one running sum, brought to the same power."""
    n = len(hashes)
    power, back = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]), dtype=np.uint64) for b in (BASE, INVERSE))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:n], dtype=np.uint64)])
    return {w: mix((total[w:] - total[: n + 1 - w]) * back[: n + 1 - w] + np.uint64(w)) if n >= w else np.zeros(0, np.uint64) for w in widths}


def tile_runs(doc: np.ndarray, item: np.ndarray, size: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(document word, item word, length)`` from all maximal matches of ``seed`` words or more.

    The longest match goes first (then the earliest in the item and the document); of a match that a tile has cut into,
    the free stretches of ``seed`` words or more stay in play.
    """
    base = int(doc.min())
    in_doc, in_item = np.zeros(int((doc + size).max()) - base, bool), np.zeros(int((item + size).max()), bool)
    heap = list(zip((-size).tolist(), item.tolist(), (doc - base).tolist()))
    heapq.heapify(heap)
    tiles = []
    while heap:
        n, i, d = heapq.heappop(heap)
        taken = in_item[i : i - n] | in_doc[d : d - n]
        if not taken.any():
            tiles.append((d + base, i, -n))
            in_item[i : i - n] = in_doc[d : d - n] = True
            # What is left of the item must still hold a seed, or no later match can.
            if not _stretches(~in_item, seed):
                break
            continue
        for a, b in _stretches(~taken, seed):
            heapq.heappush(heap, (a - b, i + a, d + a))
    return tiles


def _stretches(free: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of at least so many trues, as bounds."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= least]


def tile(doc_at: np.ndarray, item_at: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """``tile_runs`` of the places where both hold the same seed: those in a row on one diagonal are one maximal match."""
    order = np.lexsort((item_at, doc_at - item_at))
    d, i = doc_at[order], item_at[order]
    breaks = np.flatnonzero((np.diff(i) != 1) | (np.diff(d - i) != 0)) + 1
    first, end = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(i)]])
    return tile_runs(d[first], i[first], end - first + seed - 1, seed)


def item_seeds(benchmark: DataFrame, seed: int) -> DataFrame:
    """``seed, before, after, width, place, item, item_id, words``: every run of ``seed`` words of each item, or all of a shorter one.

    ``before`` and ``after`` are the hashes of the runs one word earlier and later, null where there is none.
    """

    def cut(batches):
        for batch in slices(batches):
            hashes, bounds = plain_words(concat(batch.column("text")))
            sizes = np.diff(bounds)
            width = np.minimum(sizes, seed)
            n = np.where(sizes > 0, sizes - width + 1, 0)
            row = np.repeat(np.arange(len(sizes)), n)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            found = windows(hashes, sorted(set(width.tolist()) - {0}))
            value = np.zeros(len(row), np.uint64)
            for w, own in found.items():
                at = np.flatnonzero(width[row] == w)
                value[at] = own[bounds[row[at]] + place[at]]
            taken = [batch.column(c).take(pa.array(row)) for c in ("item", "item_id")]
            value = value.view(np.int64)
            before, after = pa.array(np.roll(value, 1), mask=place == 0), pa.array(np.roll(value, -1), mask=place == n[row] - 1)
            yield pa.RecordBatch.from_arrays([pa.array(value), before, after, pa.array(width[row].astype(np.int32)), pa.array(place.astype(np.int32)), *taken, pa.array(sizes[row].astype(np.int32))], ["seed", "before", "after", "width", "place", "item", "item_id", "words"])

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_column(benchmark)).where("item_id is not null").distinct()
    return rows.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text").mapInArrow(cut, "seed long, before long, after long, width int, place int, item long, item_id long, words int")


def _bits_of(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two places of a hash in the filter."""
    return [(values >> np.uint64(64 - bits)).astype(np.int64), ((values << np.uint64(32)) >> np.uint64(64 - bits)).astype(np.int64)]


def seed_filter(seeds: DataFrame, bits: int) -> np.ndarray:
    """A filter of ``2**bits`` bits with two set for each seed, made on the executors and put together here."""

    def mark(batches):
        own = np.zeros(1 << bits, bool)
        for batch in batches:
            for at in _bits_of(batch.column("seed").to_numpy().view(np.uint64), bits):
                own[at] = True
        words = np.packbits(own).view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], ["at", "word"])

    out = np.zeros(1 << (bits - 6), np.int64)
    merged = seeds.select("seed").mapInArrow(mark, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    out[merged.column("at").to_numpy()] = merged.column("word").to_numpy()
    return np.unpackbits(out.view(np.uint8)).astype(bool)


def text_key() -> Column:
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))


def wordless() -> Column:
    """Null, empty and white texts: they match nothing, and many rows may share one of them."""
    return F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"^\s*$")


def found_in(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, seed: int, threshold: float) -> DataFrame:
    """``FOUND``: each different text and item of which tiles cover at least ``threshold``; a stored table."""
    scratch = Scratch(spark, "tiling")
    seeds = scratch.table("seeds", item_seeds(benchmark, seed))
    known = seeds.agg(F.count("*").alias("n"), F.array_sort(F.collect_set("width")).alias("widths")).first()
    if not known["n"]:
        return spark.createDataFrame([], FOUND)
    widths, bits = known["widths"], min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(64 * known["n"]))))
    held = spark.sparkContext.broadcast(np.packbits(seed_filter(seeds, bits)))

    def meet(batches):
        mask = np.unpackbits(held.value).astype(bool)
        for batch in slices(batches):
            hashes, bounds = plain_words(concat(batch.column("text")))
            rows, places, values, before, after = [], [], [], [], []
            for w, own in windows(hashes, widths).items():
                first, second = _bits_of(own, bits)
                at = np.flatnonzero(mask[first])
                at = at[mask[second[at]]]
                row = np.searchsorted(bounds, at, side="right") - 1
                inside = at + w <= bounds[row + 1]
                at, row = at[inside], row[inside]
                rows.append(row)
                places.append(at - bounds[row])
                values.append(own[at])
                before.append(pa.array(own[np.maximum(at - 1, 0)].view(np.int64), mask=at == bounds[row]))
                after.append(pa.array(own[np.minimum(at + 1, len(own) - 1)].view(np.int64), mask=at + w == bounds[row + 1]))
            keys = batch.column("text_key").take(pa.array(np.concatenate(rows)))
            columns = [pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(values).view(np.int64)), pa.concat_arrays(before), pa.concat_arrays(after)]
            yield pa.RecordBatch.from_arrays([keys, *columns], ["text_key", "at", "seed", "before", "after"])

    hits = scratch.table("hits", docs.select(text_column(docs)).select("text", text_key().alias("text_key")).mapInArrow(meet, "text_key string, at int, seed long, before long, after long").distinct())
    # A match is met at its first and its last seed only, and an item's places with one seed between the same two
    # others at once: a word that text and item repeat m and n times makes as many rows as m + n, not m * n.
    classes = seeds.groupBy("seed", "item", "item_id", "words", "width", "before", "after").agg(F.collect_list("place").alias("places"))
    classes = scratch.table("classes", classes.withColumnsRenamed({"before": "item_before", "after": "item_after"}))
    starts, ends = (~F.coalesce(F.col(c) == F.col(f"item_{c}"), F.lit(False)) for c in ("before", "after"))
    met = hits.join(classes, "seed").select("text_key", "item", "at", "places", "width", "words", "item_id", starts.alias("starts"), ends.alias("ends")).where("starts or ends")
    pairs = met.select("text_key", "item", "at", F.explode("places").alias("place"), "width", "words", "item_id", "starts", "ends")

    def cover(batches):
        for table in runs(batches, ["text_key", "item"]):
            keys, items = table.column("text_key").to_numpy(zero_copy_only=False), table.column("item").to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (items[1:] != items[:-1])) + 1
            at, place, width, words, starts, ends = (table.column(c).to_numpy() for c in ("at", "place", "width", "words", "starts", "ends"))
            found = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                own, size = int(width[a]), int(words[a])
                # On each diagonal first and last seeds take turns.
                order = a + np.lexsort((place[a:b], at[a:b] - place[a:b]))
                first, last = order[starts[order]], order[ends[order]]
                length = place[last] - place[first] + own
                # No tiling can cover more than all matches together.
                edges = np.bincount(place[first], minlength=size + 1) - np.bincount(place[first] + length, minlength=size + 1)
                if np.count_nonzero(np.cumsum(edges)) < threshold * size:
                    continue
                tiles = tile_runs(at[first], place[first], length, own)
                share = sum(t[2] for t in tiles) / size
                if share >= threshold:
                    found.append((a, share, len(tiles), max(t[2] for t in tiles)))
            rows = pa.array([f[0] for f in found], pa.int64())
            columns = [table.column(c).combine_chunks().take(rows) for c in ("text_key", "item_id")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int32()), pa.array([f[3] for f in found], pa.int32())], ["text_key", "item_id", "coverage", "tiles", "longest"])

    ordered = pairs.repartition("text_key", "item").sortWithinPartitions("text_key", "item")
    out = scratch.table("found", ordered.mapInArrow(cover, FOUND))
    scratch.drop("hits", "seeds", "classes")
    return out


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, seed: int = 5, threshold: float = 0.5) -> DataFrame:
    """``doc_id, item_id, coverage, tiles, longest``: one row for each document row and item of which tiles cover at least ``threshold`` of the words.

    Long texts are read whole; null and empty texts match nothing. An item of fewer than ``seed`` words is found where
    all its words stand in a row. Of equally long matches the earliest in the item and the document is marked first.
    Repeated rows are reported once each; items that repeat id and text are one, items without an id none. Other
    columns are ignored; empty tables give no rows.
    """
    found = found_in(spark, docs, benchmark, seed, threshold)
    side = F.broadcast(found) if found.count() <= BROADCAST_FOUND else found
    rows = docs.where(~wordless()).select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"))
    return rows.join(side, "text_key").select("doc_id", "item_id", "coverage", "tiles", "longest")


def without_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, seed: int = 5, threshold: float = 0.5) -> DataFrame:
    """The documents, all columns as they are, of which no item is covered enough; null and empty texts stay.

    What counts as covered, and nulls, ties, repeated rows and empty tables, are as in ``contaminated``: rows with equal
    texts stay or go together.
    """
    found = found_in(spark, docs, benchmark, seed, threshold).select("text_key").distinct()
    found = Scratch(spark, "leaked").table("keys", found)
    key = free_name("text_key", *docs.columns)
    keyed, found = docs.withColumn(key, text_key()), found.withColumnRenamed("text_key", key)
    if found.count() <= BROADCAST_FOUND:
        kept = keyed.join(F.broadcast(found), key, "left_anti")
    else:
        kept = keyed.where(~wordless()).join(found, key, "left_anti").select(*keyed.columns).unionByName(keyed.where(wordless()))
    return kept.select(*docs.columns)
