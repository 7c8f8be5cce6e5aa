"""Exact n-gram Jaccard self-join of documents, by rare-first prefixes.

A document is its set of word shingles. Shingles are ordered rare first, by the least of two counts over all documents:
that of their hash bucket and that of their rarest word, which still tells rare from common when every bucket is full.
Two sets that meet the threshold share a shingle among the first ``n - ceil(t * n) + 1`` of each. Length and positional
filters thin the pairs that share one, a suffix filter comes before the overlap is counted, and each pair is verified
once.

Equal sets are collapsed first. Links inside a group of near copies are not all enumerated: every member of a prefix
bucket is verified against the bucket's first and components are taken; while buckets still hold many pairs of different
components, and it helps, members are verified against a few drawn by a hash and components are taken again. Only pairs
that then lie in different components are verified one by one. This loses no component: a pair is left out only if its
ends are joined already.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairground.llm.common import Scratch, concat, hash_words, shingle_hashes, slices, split_words, text_column
from fairground.llm.components import components

#: Buckets of the counts of shingles and of words, as powers of two: the size of what is broadcast, whatever the corpus.
SHINGLE_BITS, WORD_BITS = 16, 17
#: Bytes of texts that are taken apart at a time.
SLICE = 4 << 20
#: Counts that are sent in one row.
CHUNK = 1 << 12
#: Document ids up to this many are broadcast to pick texts out of the corpus; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Members of a bucket that are compared with its first in one group, for which that one's text is sent once.
STAR = 64
#: Open pairs a row of a bucket at most when its pairs are verified one by one; above, another round of heads comes first,
#: as long as a round closes a tenth of the pairs of all such buckets.
OPEN_PAIRS, CLOSES = 16, 0.9
#: Heads of a crowded bucket in each such round; rounds beyond the last have as many as it. In the first all are compared
#: with them, later only those outside the bucket's largest component.
HEADS = (4, 64)


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and each text's bounds; words are runs of other than ASCII white space, A-Z lower-cased."""
    words, bounds = split_words(pc.ascii_lower(texts))
    return hash_words(words), bounds


def document_sets(texts: pa.Array, k: int):
    """The sorted distinct shingle hashes of each text."""
    hashes, bounds = word_hashes(texts)
    shingles = shingle_hashes(hashes, k)
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = np.sort(shingles[a : b - k + 1] if b - a >= k else shingle_hashes(hashes[a:b], k))
        yield own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) > 1 else own


def rare_first(texts: pa.Array, k: int, shingle_counts: np.ndarray, word_counts: np.ndarray):
    """The distinct shingle hashes of each text, sorted, and their places in rare-first order."""
    hashes, bounds = word_hashes(texts)
    shingles = shingle_hashes(hashes, k)
    seen = word_counts[bucket(hashes, WORD_BITS)]
    rarest = seen[: max(0, len(seen) - k + 1)].copy()
    for j in range(1, k):
        np.minimum(rarest, seen[j : j + len(rarest)], out=rarest)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= k:
            own, words = shingles[a : b - k + 1], rarest[a : b - k + 1]
        else:
            own, words = shingle_hashes(hashes[a:b], k), seen[a:b].min(keepdims=True) if b > a else seen[:0]
        order = np.argsort(own)
        own = own[order]
        new = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
        own, words = own[new], words[order[new]]
        yield own, np.argsort(np.minimum(shingle_counts[bucket(own, SHINGLE_BITS)], words), kind="stable")


def count_sketches(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts over all documents by hash bucket: of documents with a shingle, and of occurrences of words."""
    sizes = (1 << SHINGLE_BITS, 1 << WORD_BITS)

    def count(batches):
        totals = np.zeros(sum(sizes), np.int64)
        for batch in slices(batches, SLICE):
            texts = concat(batch.column("text"))
            totals[: sizes[0]] += np.bincount(bucket(np.concatenate(list(document_sets(texts, k))), SHINGLE_BITS), minlength=sizes[0])
            totals[sizes[0] :] += np.bincount(bucket(word_hashes(texts)[0], WORD_BITS), minlength=sizes[1])
        chunks = [(i, totals[i * CHUNK : (i + 1) * CHUNK]) for i in range(len(totals) // CHUNK)]
        chunks = [(i, c) for i, c in chunks if c.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in chunks], pa.int32()), pa.array([c.astype("<i8").tobytes() for _, c in chunks], pa.binary())], ["chunk", "counts"])

    def add(batches):
        total = np.zeros((sum(sizes) // CHUNK, CHUNK), np.int64)
        for batch in batches:
            for i, c in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                total[i] += np.frombuffer(c, "<i8")
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([total[i].tobytes() for i in at], pa.binary())], ["chunk", "counts"])

    # One row a chunk and task, added up by chunk.
    rows = docs.select(text_column(docs)).mapInArrow(count, "chunk int, counts binary").repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    out = np.zeros(sum(sizes), np.int64)
    for r in rows.collect():
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], "<i8")
    return out[: sizes[0]], out[sizes[0] :]


def describe_sets(spark: SparkSession, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id, n, set_key, prefix`` of every document; no shingles: ``set_key`` null and no prefix."""
    counts = spark.sparkContext.broadcast(count_sketches(docs, k))

    def describe(batches):
        for batch in slices(batches, SLICE):
            sizes, keys, prefixes = [], [], []
            for own, order in rare_first(concat(batch.column("text")), k, *counts.value):
                n = len(own)
                sizes.append(n)
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if n else None)
                prefixes.append(own[order[: n - -(-percent * n // 100) + 1]].view(np.int64))
            cuts = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(prefixes)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists], ["doc_id", "n", "set_key", "prefix"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs))
    return rows.mapInArrow(describe, "doc_id long, n long, set_key binary, prefix array<long>")


def _may_link(n1: Column, p1: Column, n2: Column, p2: Column, percent: int) -> Column:
    """Length filter, and the positional filter at the pair's first shared shingle."""
    length = F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent
    return length & (F.least(n1 - p1, n2 - p2) * (100 + percent) >= (n1 + n2) * percent)


def _members_may_link(x: str, y: str, percent: int) -> Column:
    """The filters of two members of a bucket.

    What they have in common is at most the lesser of what each has in common with the bucket's head, where both were
    compared with it, and the lesser of what each has besides.
    """
    n1, p1, c1, n2, p2, c2 = (F.col(f"{side}.{c}") for side in (x, y) for c in ("n", "pos", "common"))
    most = F.least(c1, c2) + F.least(n1 - c1, n2 - c2)
    unknown = c1.isNull() | c2.isNull()
    return _may_link(n1, p1, n2, p2, percent) & (unknown | (most * (100 + percent) >= (n1 + n2) * percent))


def _rank(set_id: str, pos: Column) -> Column:
    """The order in which the members of a bucket become its heads: those with the fewest rarer shingles first.

    What was changed in a copy is rarer than what its group has in common, so these are nearest to what the others are
    copies of, and link with most. Ties go by a hash, so that buckets of the same documents agree.
    """
    return F.shiftleft(F.least(pos, F.lit((1 << 23) - 1)), 40) + F.xxhash64(set_id).bitwiseAND((1 << 40) - 1)


def _suffix_filter(x: np.ndarray, y: np.ndarray, allowed: int, parts: int = 16) -> bool:
    """Whether the sets may differ in ``allowed`` elements at most, from their counts in equal hash ranges."""
    if len(x) < 4 * parts:
        return True
    marks = (np.arange(1, parts, dtype=np.uint64)) << np.uint64(60)
    cx, cy = np.searchsorted(x, marks), np.searchsorted(y, marks)
    return int(np.abs(np.diff(cx, prepend=0, append=len(x)) - np.diff(cy, prepend=0, append=len(y))).sum()) <= allowed


def verify(pairs: DataFrame, docs: DataFrame, scratch: Scratch, name: str, k: int, percent: int, links_only: bool = True) -> DataFrame:
    """Of stored ``pairs(a, b)``, those that meet the threshold, with the sizes ``both`` and ``either``, the smaller id as
    ``a``; a stored table. Without ``links_only`` all of them, and whether they are ``linked``.

    The partners of one ``a`` are dealt into groups of about ``STAR``; its text is sent once to each, and its set made
    once. Texts are picked out of the corpus by the ids that occur in pairs.
    """
    wanted = scratch.table(f"{name}-ids", pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    texts = scratch.table(f"{name}-texts", docs.join(ids, "doc_id", "left_semi"))
    groups = scratch.table(f"{name}-groups", pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("groups")))
    dealt = scratch.table(f"{name}-dealt", pairs.join(groups, "a").select("a", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("group"), "b"))
    heads = dealt.select("a", "group").distinct().join(texts.withColumnRenamed("doc_id", "a"), "a").select("a", "group", F.lit(None).cast("long").alias("b"), "text")
    others = dealt.join(texts.withColumnRenamed("doc_id", "b"), "b").select("a", "group", "b", "text")

    def check(batches):
        key, first = None, []
        for batch in slices(batches, SLICE):
            found = []
            for a, group, b, own in zip(*(batch.column(c).to_pylist() for c in ("a", "group", "b")), document_sets(concat(batch.column("text")), k)):
                if (a, group) != key:
                    key, first = (a, group), []
                if b is None:
                    first.append(own)
                    continue
                for x in first:
                    least = -(-percent * (len(x) + len(own)) // (100 + percent))
                    if links_only and not _suffix_filter(x, own, len(x) + len(own) - 2 * least):
                        continue
                    both = len(np.intersect1d(x, own, assume_unique=True))
                    either = len(x) + len(own) - both
                    linked = both > 0 and 100 * both >= percent * either
                    if linked or not links_only:
                        found.append((min(a, b), max(a, b), both, either, linked))
            columns = list(zip(*found)) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(list(c), pa.int64()) for c in columns[:4]), pa.array(list(columns[4]), pa.bool_())], ["a", "b", "both", "either", "linked"])

    ordered = heads.unionByName(others).repartition("a", "group").sortWithinPartitions("a", "group", F.asc_nulls_first("b"))
    checked = ordered.mapInArrow(check, "a long, b long, both long, either long, linked boolean")
    out = scratch.table(name, checked.drop("linked") if links_only else checked)
    scratch.drop(f"{name}-ids", f"{name}-texts", f"{name}-groups", f"{name}-dealt")
    return out


def similar_documents(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Documents that link when ``100 * |intersection| >= percent * |union|`` of their ``k``-word shingle sets.

    Returns ``members(doc_id, n_shingles, set_id, component_id)``, one row a document, and ``links(a, b, both,
    either)``, the verified links between set ids that span the components. ``set_id`` is the smallest document with
    the same set, ``component_id`` the smallest reachable by links.

    Fewer than ``k`` words are one shingle. Null or empty text has no shingles and links with nothing. Repeated rows
    are equal sets. Rows that share an id count as one document with several texts. Other columns are ignored.
    """
    scratch = Scratch(spark, "ngram-join")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs))
    described = scratch.table("described", describe_sets(spark, docs, k, percent))
    # Only sets that occur again meet their first document; stored, so that a join on a hot set can be split.
    again = scratch.table("again", described.where("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("set_id"), F.count("*").alias("m")).where("m > 1").select("set_key", "set_id"))
    owned = described.join(again, "set_key", "left").withColumn("set_id", F.coalesce("set_id", "doc_id"))
    members = scratch.table("members", owned.select("doc_id", "n", "set_id"))
    prefixes = scratch.table("prefixes", owned.where("n > 0 and set_id <=> doc_id").select("set_id", "n", "prefix"))
    scratch.drop("described", "again")

    # The rows that meet on a shingle are kept narrow: size and position share a number.
    entries = prefixes.select("set_id", "n", F.posexplode("prefix").alias("pos", "shingle")).select("shingle", "set_id", (F.shiftleft("n", 32) + F.col("pos")).alias("at"))
    own = F.col("at").bitwiseAND((1 << 32) - 1)
    heads = scratch.table("heads", entries.groupBy("shingle").agg(F.min(_rank("set_id", own)).alias("first"), F.count("*").alias("m")).where("m > 1").select("shingle", "first"))
    shared = scratch.table("shared", entries.join(heads, "shingle").select("shingle", "set_id", F.shiftright("at", 32).alias("n"), own.alias("pos"), (_rank("set_id", own) == F.col("first")).alias("leads")))
    scratch.drop("prefixes", "heads")

    leading = shared.where("leads").select("shingle", F.col("set_id").alias("head"), F.col("n").alias("head_n"), F.col("pos").alias("head_pos"))
    near_head = shared.join(leading, "shingle").where("set_id <> head").where(_may_link(F.col("n"), F.col("pos"), F.col("head_n"), F.col("head_pos"), percent))
    # Where both lead some bucket, the pair comes once.
    ends = near_head.groupBy(F.least("head", "set_id").alias("low"), F.greatest("head", "set_id").alias("high")).agg(F.max("head").alias("a"))
    stars = scratch.table("stars", ends.select("a", (F.col("low") + F.col("high") - F.col("a")).alias("b")))
    compared = verify(stars, plain, scratch, "compared", k, percent, links_only=False)
    star_links = compared.where("linked").drop("linked")
    # What a member has in common with its bucket's head bounds what two members have in common.
    with_head = compared.select(F.col("a").alias("head"), F.col("b").alias("set_id"), "both").unionByName(compared.select(F.col("b").alias("head"), F.col("a").alias("set_id"), "both"))
    led = scratch.table("led", shared.join(leading.select("shingle", "head"), "shingle"))
    measured = scratch.table("measured", led.join(with_head, ["head", "set_id"], "left").select("shingle", "set_id", "n", "pos", F.when(F.col("set_id") == F.col("head"), F.col("n")).otherwise(F.col("both")).alias("common")))
    scratch.drop("shared", "led")
    joined_by_stars = scratch.table("star-components", components(star_links, scratch, "star"))

    # What is left: pairs in a bucket whose ends are still in different components.
    links, tested, joined, pairs, step = star_links, stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), joined_by_stars, None, 0
    while True:
        labelled = scratch.table(f"labelled-{step}", measured.join(joined.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id")))
        kinds = labelled.groupBy("shingle", "component").agg(F.count("*").alias("m"))
        by_label = kinds.groupBy("shingle").agg(F.max(F.struct("m", "component")).alias("most"), F.count("*").alias("kinds"), F.sum("m").alias("rows"), F.sum(F.col("m").cast("double") ** 2).alias("squares"))
        by_label = scratch.table(f"by-label-{step}", by_label.where("kinds > 1").select("shingle", F.col("most.component").alias("major"), "rows", ((F.col("rows").cast("double") ** 2 - F.col("squares")) / 2).alias("pairs")))
        crowded = by_label.where(F.col("pairs") > OPEN_PAIRS * F.col("rows"))
        before, pairs = pairs, crowded.agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0]
        if not pairs or (step >= len(HEADS) and pairs > CLOSES * before):
            break
        rows, found, last = scratch.table(f"crowded-{step}", labelled.join(crowded, "shingle")), None, step
        # A round without a link changes no component, so the next one is of the same rows.
        while found is None or (step < len(HEADS) and found.isEmpty()):
            step += 1
            # Documents are dealt by a hash of them alone, and the likeliest of each deal is a head.
            deal, rank = F.pmod(F.xxhash64("set_id", F.lit(step)), F.lit(HEADS[min(step, len(HEADS)) - 1])), _rank("set_id", F.col("pos"))
            first = scratch.table(f"first-{step}", rows.groupBy("shingle", deal.alias("deal")).agg(F.min(rank).alias("first")))
            heads = rows.join(first, [rows["shingle"] == first["shingle"], deal == first["deal"], rank == first["first"]], "left_semi").alias("x")
            others = (rows if step == 1 else rows.where("component <> major")).alias("y")
            at = heads.join(others, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") != F.col("y.component")) & _members_may_link("x", "y", percent))
            ends = at.select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct()
            chosen = scratch.table(f"round-{step}-pairs", ends.join(tested, ["a", "b"], "left_anti"))
            found = verify(chosen, plain, scratch, f"round-{step}", k, percent)
            links, tested = links.unionByName(found), tested.unionByName(chosen)
            scratch.drop(f"first-{step}")
        scratch.drop(f"crowded-{last}")
        if found.isEmpty():
            step = last
            break
        edges = joined.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(found.select("a", "b"))
        joined = scratch.table(f"joined-{step}", components(edges, scratch, f"round-{step}"))
        scratch.drop(f"labelled-{last}", f"by-label-{last}")
    open_rows = scratch.table("open", labelled.join(by_label.select("shingle", "major"), "shingle"))
    scratch.drop("measured", f"labelled-{step}", f"by-label-{step}")
    minor, other = open_rows.where("component <> major").alias("x"), open_rows.alias("y")
    met = minor.join(other, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") != F.col("y.component")) & ((F.col("y.component") == F.col("y.major")) | (F.col("x.set_id") < F.col("y.set_id"))) & _members_may_link("x", "y", percent))
    later = scratch.table("later", met.select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct().join(tested, ["a", "b"], "left_anti"))
    scratch.drop("open", "stars")
    later_links = verify(later, plain, scratch, "later-links", k, percent)

    links = links.unionByName(later_links)
    spanning = joined.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(later_links.select("a", "b"))
    final = scratch.table("components", components(spanning, scratch, "all"))
    scratch.drop("star-components", "later")
    out = members.join(final.withColumnRenamed("node", "set_id"), "set_id", "left").select("doc_id", F.col("n").alias("n_shingles"), "set_id", F.coalesce("component", "set_id").alias("component_id"))
    return out, links


def keep_one_of_each(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near duplicates: of each component one row stays; columns are unchanged.

    Every row is a document of its own, by a key that is stored with it, whatever its id: rows without an id or with
    one that others share are compared by their texts like any other. Of a component the row with the smallest id
    stays, one without an id only where none has one; among equals the first stored. Rows without words have no
    shingles and all stay, but for those that repeat another's id and text.
    """
    scratch = Scratch(spark, "one-of-each")
    key = "_row"
    while key.lower() in {c.lower() for c in docs.columns}:
        key += "_"
    # The numbers differ from run to run of a task, so they are read from the table only.
    rows = scratch.table("rows", docs.withColumn(key, F.monotonically_increasing_id()))
    members, _ = similar_documents(spark, rows.select(F.col(key).alias("doc_id"), "text"), k, percent)
    blank = F.when(F.col("text").cast("string").rlike(r"^[\x20\x09-\x0D]*$"), F.col("text").cast("string"))
    owned = rows.select(F.col(key).alias("row"), F.col("doc_id").cast("long").alias("id"), blank.alias("blank")).join(members.withColumnRenamed("doc_id", "row"), "row")
    repeat = F.col("n_shingles").eqNullSafe(0) & F.col("id").isNotNull()
    groups = owned.groupBy(F.when(~repeat, F.col("component_id")).alias("component"), F.when(repeat, F.col("id")).alias("of"), F.when(repeat, F.col("blank")).alias("as"))
    kept = groups.agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")).select(F.col("first.row").alias(key))
    return rows.join(kept, key, "left_semi").select(*docs.columns)
