import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import ODD

from fairground.llm import ranked
from fairground.llm.queries import op13_ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def slow(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    full = [c for _, c in held if c]
    n_docs, total = len(full), sum(c.total() for c in full)
    df = Counter(t for c in full for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in held:
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * (25 + (75 * c.total() * n_docs) // total)))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, at, None if none else doc, -s) for at, (s, none, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


WORDS = "the quick Brown fox É été 日本 don't 12,5% x_y ÀB aB ab AB".split()
TEXTS = [" ".join(WORDS[(i * j + j // 3) % len(WORDS)] for j in range(i % 17)) for i in range(90)]


@pytest.mark.parametrize("terms_bound, rows_bound, buckets", [(200_000, 2_000_000, 256), (0, 2_000_000, 7), (200_000, 10, 5), (0, 10, 1)])
def test_ranks_equal_a_slow_search(spark, make, monkeypatch, terms_bound, rows_bound, buckets):
    monkeypatch.setattr(ranked, "BROADCAST_TERMS", terms_bound)
    docs = make(*ODD, *TEXTS)
    docs = docs.union(docs.where("doc_id = 17")).unionByName(docs.where("doc_id in (18, 19)").withColumn("doc_id", F.lit(None).cast("long")))
    items = spark.createDataFrame([(1, "fox the THE fox"), (2, None), (3, "nothing-here"), (4, "ab été É"), (5, " ".join(WORDS)), (6, ""), (None, "quick"), (7, "word1 thing2 日本語")], "item_id long, text string").withColumn("row", F.lit("clash"))
    index = ranked.Index(spark, docs.withColumn("row", F.lit(1)), bucket_rows=rows_bound, buckets=buckets)
    got = sorted((tuple(r) for r in ranked.search(spark, index, items, k=5).collect()), key=str)
    assert got == slow([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 5)
    if rows_bound == 10 and buckets > 1:
        assert index.spread.count() > 3


def test_wanted_terms_do_not_change_ranks(spark, make, tmp_path):
    docs = make(*TEXTS, None, "")
    items = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS[:20])], "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((tuple(r) for r in op13_ranked_search(spark, str(tmp_path)).collect()), key=str)
    assert got == slow([(r.doc_id, r.text) for r in docs.collect()], list(enumerate(TEXTS[:20])), 10)


def test_index_serves_many_searches(spark, make):
    index = ranked.Index(spark, make(*TEXTS))
    for text in ("fox", "été 日本"):
        items = spark.createDataFrame([(9, text)], "item_id long, text string")
        assert ranked.search(spark, index, items, k=3).count() == 3


def test_empty_tables(spark, make):
    items = spark.createDataFrame([(9, "fox")], "item_id long, text string")
    assert ranked.search(spark, ranked.Index(spark, make(*TEXTS).limit(0)), items).count() == 0
    assert ranked.search(spark, ranked.Index(spark, make(*TEXTS)), items.limit(0)).count() == 0
    assert ranked.search(spark, ranked.Index(spark, make(None, "", "--")), items).count() == 0


def test_postings_lie_by_bucket(spark, make):
    """All postings of a term that is not spread lie in one bucket; a spread one's in as many as it needs."""
    index = ranked.Index(spark, make(*TEXTS), bucket_rows=20, buckets=64)
    rows = index.postings.groupBy("term").agg(F.countDistinct("bucket").alias("b"), F.count(F.lit(1)).alias("df")).join(index.terms.select("term", "salts"), "term").collect()
    assert all(r.b <= r.salts for r in rows) and any(r.b > 1 for r in rows) and all(r.salts == 1 + (r.df - 1) // 20 for r in rows)
