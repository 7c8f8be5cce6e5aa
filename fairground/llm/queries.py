"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairground.llm import ann, chat, decontamination, langid, ngram_join, packing, periodic, pii, quality, ranked, sharding, tokens, warc

#: Name of the tokenizer file of the registered queries and the id that ends a document.
TOKENIZER, END_ID = "word_bpe_49k.json", 1
#: The key of the registered query; a user passes a secret of their own.
PII_KEY = b"registered query"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    found = langid.identify(spark, docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(spark, table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op4_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"), tokenizer_path(), END_ID, max_len=2048)


def op6_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_transcripts(spark, table(spark, sf_dir, "conversations"))


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, table(spark, sf_dir, "documents"), shards=16)


def op8_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each leak: a document and the test item it holds."""
    return decontamination.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), seed=5, threshold=0.5)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = ngram_join.similar_documents(spark, table(spark, sf_dir, "documents"), k=3, percent=90)
    return members.select("doc_id", "n_shingles", "component_id")


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.replace_personal_data(spark, table(spark, sf_dir, "documents"), PII_KEY)
    return found.select("doc_id", "text", "pii_kinds")


def planted_periods(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, drawn by the id, repeats a stretch of words from a place on that is drawn too."""
    docs = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    docs = docs.withColumn("g", F.expr("h div 10"))
    docs = docs.withColumn("w", F.expr(r"if(h % 10 = 0, array_remove(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), ''), array())"))
    docs = docs.withColumn("a", F.expr("if(size(w) > 0, cast(g % size(w) as int), 0)"))
    docs = docs.withColumn("p", F.expr("cast(1 + (size(w) - a) div (3 + g % 8) as int)"))
    moved = "array_join(slice(concat(slice(w, 1, a), flatten(array_repeat(slice(w, a + 1, p), cast(ceil((size(w) - a) / p) as int)))), 1, size(w)), ' ')"
    return docs.withColumn("text", F.expr(f"if(size(w) > 0, {moved}, text)")).drop("h", "g", "w", "a", "p")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs)
    best = F.expr("aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (b, r) -> if(b is null or r.length > b.length, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    power = F.expr("1000 * b.length div b.period").alias("exponent_milli")
    return found.select("doc_id", "n_runs", "b.start", "b.length", "b.period", power, "runs_sha256", "collapsed_sha256")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_pages(spark, table(spark, sf_dir, "pages"))
    number = lambda c: F.regexp_extract(c, f"^{warc.OWN_ID}(-?[0-9]+)$", 1).try_cast("bigint")
    return found.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), "error")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    wanted = ranked.postings(items.select(F.lit(0).alias("row"), F.lit(0).alias("doc_id"), "text"), "text").select("term")
    return ranked.search(spark, ranked.Index(spark, docs, wanted=wanted), items, k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_learned_partitions, op2_cross_parsing, op3_token_files, op4_co_training, op5_packing, op6_transcripts, op7_hilbert_shards, op8_string_tiling, op9_ngram_join, op10_surrogates, op11_periodic_runs, op12_warc, op13_ranked_search)}

#: The other operators fit models, call a tokenizer or choose among equals by their own method; tests hold them to brute force.
ORACLE_SQL: dict[str, str] = {
    "op9_ngram_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM w),
e AS (SELECT doc_id, unnest(sh) AS g, len(sh) AS n FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90 GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
l AS (SELECT x, y FROM p UNION SELECT y, x FROM p),
r AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.other)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, (SELECT min(other) FROM r WHERE r.doc_id = s.doc_id) AS component_id FROM s
""",
    "op12_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS b, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, CAST(strlen(b) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(sha1(b), CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, nullif(first, page_id) AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM p
""",
    "op13_ranked_search": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS (SELECT doc_id, w, n, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS w, len(ws) AS n FROM d) GROUP BY ALL),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS all_terms FROM d WHERE len(ws) > 0),
f AS (SELECT w, count(*) AS df FROM t GROUP BY w),
i AS (SELECT item_id, w, count(*) AS q FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark) GROUP BY ALL),
m AS (SELECT item_id, doc_id, CAST(sum(q * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // all_terms)))) AS BIGINT) AS score
    FROM i JOIN t USING (w) JOIN f USING (w), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM m WHERE score > 0) WHERE rank <= 10
""",
}
