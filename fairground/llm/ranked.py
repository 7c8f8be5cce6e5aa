"""Ranked lexical search: postings by term, item terms joined to them, integer scores summed by item and document.

A term is a run of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. ``Index`` reads the texts
once and stores one row a document and term, in buckets of the term's hash; a term that very many documents hold is spread
over several buckets of its own by the document. ``search`` joins the terms of the items to the postings of their buckets.
A match's part of the score does not depend on the item but for a count, so it is computed once a posting and moved to the
document's partition before items are told apart: what is shuffled is one row a posting, not one an item and posting.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairground.llm.common import Scratch, concat, slices, split_words, text_column

#: Terms up to which a set of them, or of their items, goes to every worker.
BROADCAST_TERMS = 200_000
#: Documents of one term that lie in one bucket; the others go to further ones.
BUCKET_ROWS = 2_000_000
BUCKETS = 256
#: Bytes of text that a task takes apart at a time; a longer text is taken by itself.
SLICE = 4 << 20
RAW = "row bigint, doc_id {id}, n bigint, term string, tf bigint"

#: Every byte of UTF-8 as it stands in a term: letters in lower case, what parts terms as a blank.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[0x41:0x5B] += 0x20
for _from, _to in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
    _BYTES[_from:_to] = 0x20


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of each text as one array, and each text's bounds in it."""
    texts = pa.concat_arrays([texts])
    bounds, data = texts.buffers()[1], texts.buffers()[2]
    plain = pa.py_buffer(_BYTES[np.frombuffer(data, np.uint8)]) if data is not None and data.size else data
    return split_words(pa.Array.from_buffers(texts.type, len(texts), [None, bounds, plain], offset=texts.offset))


def postings(docs: DataFrame, text: str, wanted: pa.Array | None = None) -> DataFrame:
    """One row a document and term (all, or those wanted), and one a document with a null term and its number of terms.

    ``docs`` has the columns ``row``, ``doc_id`` and ``text``; null text has no terms.
    """

    def take(batches):
        for batch in slices(batches, SLICE):
            words, bounds = terms_of(concat(batch.column(2)))
            number = np.diff(bounds)
            doc = np.repeat(np.arange(len(number)), number)
            coded = words.dictionary_encode()
            names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            if wanted is not None:
                kept = pc.is_in(names, wanted).to_numpy(zero_copy_only=False)[codes] if len(codes) else np.zeros(0, bool)
                doc, codes = doc[kept], codes[kept]
            pairs, tf = np.unique(doc * max(1, len(names)) + codes, return_counts=True)
            doc, codes = pairs // max(1, len(names)), pairs % max(1, len(names))
            # The document's own row stands before its terms.
            at = np.concatenate([np.arange(len(number)), doc])
            term = pa.concat_arrays([pa.nulls(len(number), names.type), names.take(pa.array(codes))])
            tf = np.concatenate([np.zeros(len(number), np.int64), tf])
            at_ = pa.array(at)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at_), batch.column(1).take(at_), pa.array(number[at]), term, pa.array(tf)], ["row", "doc_id", "n", "term", "tf"])

    return docs.select(F.col("row").cast("long"), "doc_id", text_column(docs, text)).mapInArrow(take, RAW.format(id=docs.schema["doc_id"].dataType.simpleString()))


class Index:
    """Postings of a table of documents in term buckets, and what is known of all documents.

    ``postings``: bucket, term, row, doc_id, tf, n. ``terms``: term, df, salts. ``totals``: one row with the documents that
    hold a term and the number of all their terms. With ``wanted`` (a table with a column ``term``) postings of other terms
    are not stored; the totals count all terms either way. Rows of documents are numbered, so those that share an id, or
    have none, count each.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text", wanted: DataFrame | None = None, bucket_rows: int = BUCKET_ROWS, buckets: int = BUCKETS):
        scratch = Scratch(spark, "postings")
        numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("doc_id"), F.col(text).alias("text"))
        few = None
        if wanted is not None:
            wanted = scratch.table("wanted", wanted.select("term").where("term is not null").distinct())
            if wanted.count() <= BROADCAST_TERMS:
                few = concat(wanted.toArrow().column("term"))
        raw = scratch.table("raw", postings(numbered, "text", few))
        self.totals = scratch.table("totals", raw.where("term is null and n > 0").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("all_terms")))
        salts = F.expr(f"cast(least({int(buckets)}, 1 + (df - 1) div {int(bucket_rows)}) as int)")
        self.terms = scratch.table("terms", raw.where("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("df")).withColumn("salts", salts))
        self.buckets, self.spread = buckets, scratch.table("spread", self.terms.where("salts > 1").select("term", "salts"))
        # The terms beyond one bucket are few: each stands for as many postings as a bucket takes.
        placed = raw.where("term is not null").join(F.broadcast(self.spread), "term", "left") if self.spread.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else raw.where("term is not null").join(self.spread, "term", "left")
        salt = F.pmod(F.xxhash64("row"), F.coalesce("salts", F.lit(1))).cast("int")
        placed = placed.select(self.bucket(salt).alias("bucket"), "term", "row", "doc_id", "tf", "n")
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.postings = scratch.table("buckets", placed.repartition(tasks, "bucket").sortWithinPartitions("bucket", "term", "row"))
        scratch.drop("raw")

    def bucket(self, salt):
        """The bucket of a term: that of its hash, and for a spread term so many places further on."""
        return F.pmod(F.xxhash64("term") + salt, F.lit(self.buckets)).cast("int")


def weigh(index: Index, asked: DataFrame) -> DataFrame:
    """Terms that are asked for, with their weight by the number of documents that hold them."""
    ratio = (2 * F.col("documents") + 2) / (2 * F.col("df") + 1)
    weight = F.floor(F.lit(1000) * F.log(ratio.cast("double"))).cast("long")
    return index.terms.join(asked.select("term").distinct(), "term").crossJoin(F.broadcast(index.totals)).select("term", "salts", weight.alias("w"), "documents", "all_terms")


def search(spark: SparkSession, index: Index, items: DataFrame, id: str = "item_id", text: str = "text", k: int = 10) -> DataFrame:
    """The ``k`` best documents for each row of ``items``: item_id, rank, doc_id, score.

    A term weighs ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``; a document in which it occurs ``tf`` times gives
    ``w * (10**9 tf div (1000 tf + 8 m))`` for each of its places in the item, with ``m = 25 + 75 n N div L``: N documents hold
    a term at all, L terms in all and n in this one. Scores of 0 are no matches; equal ones go by the id, none last. Items
    that share an id, or have none, are searched for each; those without terms, and empty tables, find nothing.
    """
    scratch = Scratch(spark, "search")
    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(id).alias("item_id"), F.col(text).alias("text"))
    numbered = scratch.table("items", numbered)
    of_items = postings(numbered.select(F.col("item").alias("row"), F.col("item_id").alias("doc_id"), "text"), "text").where("term is not null")
    asked = scratch.table("asked", of_items.select(F.col("row").alias("item"), "term", F.col("tf").alias("times")))
    weights = scratch.table("weights", weigh(index, asked))
    # A spread term is looked up in each of its buckets.
    lookup = weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).withColumn("bucket", index.bucket(F.col("salt")))
    lookup = lookup.select("bucket", "term", "w", "documents", "all_terms")
    few = asked.count() <= BROADCAST_TERMS
    matched = index.postings.join(F.broadcast(lookup) if few else lookup, ["bucket", "term"])
    m = F.expr("25 + (75 * n * documents) div all_terms")
    part = F.expr("w * ((1000000000 * tf) div (1000 * tf + 8 * m))")
    matched = matched.withColumn("m", m).select("term", "row", "doc_id", part.alias("part")).where("part > 0")
    if few:
        # Parts of a document come together first, as many rows as postings; items are told apart there, with no shuffle.
        matched = matched.repartition("row")
    scores = matched.join(F.broadcast(asked) if few else asked, "term").groupBy("row", "doc_id", "item").agg(F.sum(F.col("part") * F.col("times")).alias("score"))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    top = scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
