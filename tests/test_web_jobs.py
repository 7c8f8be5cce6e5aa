"""Numbers over whole tables, the lists' filters and texts, and the small jobs."""

from pyspark.sql import functions as F
from test_jobs import stored
from test_operators import comuni, table

from fairground import schemas
from fairground.operators import lifecycle
from fairground.plans import publish, views


def test_numbers_where_one_value_has_most_rows(spark):
    rows = spark.createDataFrame([(i, "" if i % 10 else f"c{i}") for i in range(500)], "id int, comune string")
    out = views.numbered(rows, [F.col("comune"), F.col("id")], "numero").collect()
    assert [r.id for r in sorted(out, key=lambda r: r.numero)] == [r[1] for r in sorted(((("" if i % 10 else f"c{i}"), i) for i in range(500)))]
    down = {r.posto: r.id for r in views.placed_by(rows, "comune", down=True).collect()}
    assert down[1] == 90 and down[51] == 1 and len(down) == 500
    plan = views.placed_by(rows, "comune")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan.split("== Physical Plan ==")[1].split("_part")[0]


def test_texts_of_lists(spark):
    df = spark.createDataFrame([("2026-10-01", "2026-10-03"), ("2026-10-01", "2026-10-01"), ("2026-10-01", None), ("presto", None), (None, None)], "a string, b string")
    assert [r.p for r in df.select(views.period(F.col("a"), F.col("b")).alias("p")).collect()] == ["dal 01/10/2026 al 03/10/2026", "01/10/2026", "01/10/2026", "presto", ""]
    assert tuple(views.shown_of(df, F.col("b").isNotNull()).first()) == (2, 5, "2 su 5 annunci")
    assert views.shown_of(df, F.lit(True)).first().testo == "5 annunci" and views.shown_of(df.limit(0), F.lit(True)).first().testo == "0 annunci"
    rows = spark.createDataFrame([("web", "Comune", "Asti", "https://a"), ("web", "Teatro", None, "https://ASTI.it"), ("facebook", "Comune", "Asti", None)], "fonte string, tipo string, comune string, url string")
    n = lambda *a: views.sources_matching(rows, *a).count()
    assert (n(), n("asti"), n(" ASTI ", "web"), n("asti", "web", "Teatro"), n("x")) == (3, 3, 2, 1, 0)


def test_import_again_keeps_what_was_done(spark):
    c = comuni(spark)
    tables = stored(spark, comuni=c, coda_follow=table(spark, schemas.QUEUE, {"source_id": "comune-asti-facebook", "piattaforma": "facebook", "handle": "vecchio", "url": "https://www.facebook.com/vecchio", "stato": "seguito", "tentativi": 2, "note": "mia"}))
    lists = [spark.createDataFrame([("Asti", "https://www.facebook.com/comuneasti")], "Comune string, Facebook string"), spark.createDataFrame([], "Comune string, Denominazione string, Facebook string, Instagram string"), spark.createDataFrame([("Guida", "https://www.facebook.com/guida", None)], "Nome string, Facebook string, Instagram string")]
    out = publish.run_import(tables, *lists)["coda_follow"]
    rows = {r.source_id: r for r in out.collect()}
    asti = rows["comune-asti-facebook"]
    assert (asti.handle, asti.stato, asti.tentativi, asti.note, asti.comune) == ("comuneasti", "seguito", 2, "mia", "Asti")
    assert len(rows) == 2 and {r.stato for r in rows.values()} == {"seguito", "da_seguire"}
    again = publish.run_import(tables | {"coda_follow": out}, *lists)["coda_follow"]
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))
    empty = lifecycle.upsert_queue(tables["coda_follow"], out.limit(0))
    assert empty.count() == 1


def test_pull_sync_and_check(spark):
    q = table(spark, schemas.QUEUE, {"source_id": "a", "piattaforma": "facebook", "handle": "a", "url": "https://fb/a", "stato": "seguito"}, {"source_id": "b", "piattaforma": "facebook", "handle": "b", "url": "https://fb/b", "stato": "da_seguire"})
    tables = stored(spark, comuni=comuni(spark), coda_follow=q, sources=table(spark, schemas.SOURCES, {"source_id": "s", "categoria": "comune"}))
    sheets = {"fonti": spark.createDataFrame([("s", "teatro", "si"), ("z", "x", "")], "source_id string, categoria string, polling_diretto string"), "coda_follow": spark.createDataFrame([("b", "Asti", "seguito")], "source_id string, comune string, stato string")}
    out = publish.run_pull(tables, sheets)
    assert out["sources"].first().categoria == "teatro" and {r.source_id: r.stato for r in out["coda_follow"].collect()} == {"a": "seguito", "b": "seguito"}
    assert {r.tabella: (r.aggiornate, r.ignorate) for r in out["pulled"].collect()} == {"sources": (1, 1), "coda_follow": (1, 0)}
    handles = spark.createDataFrame([("b",), ("mia",), ("nuova",)], "handle string")
    synced = publish.run_sync(tables, handles, spark.createDataFrame([], "handle string, soggetto string, comune string"), "https://www.facebook.com/mia", "facebook", "2026-08-22")["coda_follow"]
    assert {r.handle: r.stato for r in synced.collect()} == {"a": "seguito", "b": "seguito", "nuova": "quarantena"}
    gone = publish.run_check(tables, spark.createDataFrame([("https://fb/a", "Questo contenuto non è al momento disponibile")], "url string, text string"))["coda_follow"]
    assert {r.source_id: r.stato for r in gone.collect()} == {"a": "non_valido", "b": "da_seguire"}


def test_backups_and_stored_tables(spark, tmp_path):
    rows = table(spark, schemas.SOURCES, {"source_id": "s"})
    publish.write_table(rows.drop("polling_diretto"), f"{tmp_path}/sources")
    # A column added since is null.
    assert publish.read_table(spark, str(tmp_path), "sources").first().polling_diretto is None
    target = publish.backup(spark, f"{tmp_path}/sources", str(tmp_path), "2026-08-22")
    assert spark.read.parquet(target).count() == 1 and target.endswith("sources-2026-08-22")
    assert publish.expired_backups(["sources-2026-08-01", "sources-2026-08-20", "sources", "x-a-b-c"[:3]], "2026-08-22") == ["sources-2026-08-01"]
