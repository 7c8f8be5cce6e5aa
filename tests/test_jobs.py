"""Whole jobs: from landed payloads to written sheets, social feeds, replays, crawls."""

import json

from pyspark.sql import functions as F
from test_operators import comuni, day, table

from fairground import schemas
from fairground.config import Settings
from fairground.operators import extract, images, lifecycle, links, queue
from fairground.plans import publish

ART = schemas.ARTIFACTS.replace("image_urls array<string>, ", "")


def artifacts(spark, *rows):
    return table(spark, ART, *rows).withColumn("image_urls", F.array().cast("array<string>"))


def stored(spark, **given):
    ddl = {"comuni": schemas.COMUNI, "sources": schemas.SOURCES, "events": schemas.EVENTS, "event_sources": schemas.EVENT_SOURCES, "coda_follow": schemas.QUEUE, "series": schemas.SERIES, "extractions": schemas.EXTRACTIONS, "app_state": schemas.APP_STATE, "runs": schemas.RUNS}
    return {n: spark.createDataFrame([], d) for n, d in ddl.items()} | given


def test_from_payloads_to_sheets(spark, tmp_path):
    class Doubtful(extract.RuleProvider):
        name = "doubtful"

        def extract(self, system, prompt, images):
            answer = json.loads(super().extract(system, prompt, images))
            for e in answer.get("annunci", []):
                e |= {"confidenza": 40}
            return json.dumps(answer)

    tables = stored(spark, comuni=comuni(spark), sources=table(spark, schemas.SOURCES, {"source_id": "comune-asti", "categoria": "comune", "tier": "T1_html", "endpoint": "https://a.it", "stato": "attiva"}))
    first = artifacts(
        spark,
        {"source_id": "comune-asti", "url": "u", "kind": "ical", "titolo": "FIERA D'AUTUNNO", "data_inizio": "2026-10-01", "raw_hash": "h"},
        {"source_id": "comune-asti", "url": "v", "kind": "html", "text": "Sagra del 12 ottobre 2026 in piazza del mercato vecchio", "raw_hash": "k"},
        {"source_id": "comune-asti", "url": "w", "kind": "html", "text": "nulla di interessante qui, soltanto parole e basta", "raw_hash": "l"},
    )
    after = publish.run_publish(spark, tables, first, {}, f"{tmp_path}/db", f"{tmp_path}/out", "2026-08-22", "2026-08-22T10:00:00", Doubtful)
    assert after["extractions"].count() == 1 and after["events"].count() == 2
    sheet = spark.read.parquet(f"{tmp_path}/out/annunci").collect()
    assert [(r.data_inizio, r.stato) for r in sheet] == [("2026-10-01", "nuovo"), ("2026-10-12", "quarantena")]
    held = spark.read.parquet(f"{tmp_path}/out/quarantena").collect()
    assert len(held) == 1 and spark.read.parquet(f"{tmp_path}/out/legenda").count() > 2
    # The operator promotes it; the same payloads again change nothing and ask nobody.
    decided = spark.createDataFrame([(held[0].id, "promuovi")], "id string, azione string").withColumns({c: F.lit("") for c in schemas.COLONNE_UTENTE})
    again = publish.run_publish(spark, after, first, {"quarantena": decided}, f"{tmp_path}/db", f"{tmp_path}/out2", "2026-08-23", "2026-08-23T10:00:00", Doubtful)
    assert again["extractions"].count() == 1 and {r.event_id: r.stato for r in again["events"].collect()}[held[0].id] == "ok" and again["events"].count() == 2


def test_feed(spark):
    tables = stored(spark, comuni=comuni(spark))
    q = table(spark, schemas.QUEUE, {"source_id": "x", "piattaforma": "facebook", "handle": "ProLocoAsti", "comune": "Asti", "categoria": "proloco", "stato": "seguito"}, {"source_id": "y", "piattaforma": "facebook", "handle": "bandita", "comune": "Asti", "categoria": "proloco", "stato": "esclusa"})
    text = "Grande sagra del 12 ottobre 2026 ad Asti in piazza del mercato"
    posts = artifacts(spark, *({"source_id": None, "url": f"p{i}", "kind": "post", "text": text + str(i), "raw_hash": str(i)} for i in range(3))).withColumns({"piattaforma": F.lit("facebook"), "handle": F.when(F.col("url") == "p0", "@prolocoasti").when(F.col("url") == "p1", "bandita").otherwise("nuova"), "gruppo": F.col("url") == "p2"})
    out = publish.run_feed(posts, q, tables, "2026-08-22", "2026-08-22T10:00:00", extract.RuleProvider)
    assert {r.stato for r in out["queue"].collect()} == {"seguito", "esclusa", "candidato_da_feed"} and out["queue"].count() == 3
    assert sorted(r.source_id for r in out["outcomes"].collect()) == ["feed-facebook-nuova", "feed-facebook-prolocoasti"]
    assert "gruppo_comune_non_inferito" in {r.esito for r in out["posts"].collect()} and out["posts"].count() == 2


def test_replay(spark):
    src = table(spark, schemas.SOURCES, {"source_id": "comune-asti", "categoria": "comune", "tier": "T1_html"}, {"source_id": "comune-calosso", "categoria": "comune", "tier": "email"})
    landed = artifacts(spark, *({"source_id": s, "url": s, "kind": "html", "text": "Sagra del 12 ottobre 2026 in piazza del mercato vecchio", "raw_hash": "k"} for s in ("comune-asti", "comune-calosso")))
    tables = stored(spark, comuni=comuni(spark), sources=src)
    answers = publish.extract_new(landed, tables["extractions"], src, comuni(spark), day(), extract.RuleProvider, "x")
    old = table(spark, schemas.EVENTS, {"event_id": "old", "titolo": "Letto male", "data_inizio": "2026-09-01", "comune": "Asti", "url": "comune-asti", "archiviato": "no", "stato": "nuovo"})
    out = publish.replay(tables | {"events": old, "extractions": spark.createDataFrame(answers.collect(), answers.schema)}, landed, "2026-08-22")
    events = {r.event_id: r for r in out["events"].collect()}
    new = next(e for e in events if e != "old")
    assert len(events) == 2 and events["old"].archiviato == "si" and new in events["old"].note and events[new].comune == "Asti"
    assert [r.event_id for r in out["added"].collect()] == [new]


def test_crawl(spark):
    event = '<script type="application/ld+json">{"@type": "Event", "name": "%s", "startDate": "2026-10-03", "url": "https://other.example/e"}</script>'
    anchors = "".join(f'<a href="/it/agenda/{x}">x</a><a href="/event/{x}">y</a>' for x in ("b", "a", "a"))
    index = spark.createDataFrame([("s", "https://a.it/", anchors + event % "Indice"), ("t", "https://b.it/", anchors.replace("agenda", "news") + event % "Solo indice")], "source_id string, url string, html string")
    regional = links.event_links(index, links.REGIONAL_LINKS, "^/it/agenda/[^/]+")
    assert sorted((r.page_url, r.rank, r.link) for r in regional.collect()) == [("https://a.it/", 1, "https://a.it/it/agenda/a"), ("https://a.it/", 2, "https://a.it/it/agenda/b")]
    assert {r.link for r in links.event_links(index).collect()} == {f"https://{h}.it/event/{x}" for h in "ab" for x in "ab"}
    details = spark.createDataFrame([("https://a.it/it/agenda/a", event % "Dettaglio")], "url string, html string")
    assert sorted((r.source_id, r.titolo) for r in links.crawl(index, regional, details).collect()) == [("s", "Dettaglio"), ("t", "Solo indice")]


def test_guards_and_last_rows(spark):
    state = spark.createDataFrame([("ultimo_lotto_follow_facebook", "2026-08-22T10:00:00")], schemas.APP_STATE)
    asked = lambda at, p="facebook": lifecycle.may_read_feed(state, p, F.lit(at).cast("timestamp"), Settings()).first().permesso
    assert (asked("2026-08-22 10:30:00"), asked("2026-08-22 11:00:00"), asked("2026-08-22 10:30:00", "instagram")) == (False, True, True)
    sheet = spark.createDataFrame([(1, "a", "zz", "vecchia"), (3, "a", "ok", ""), (2, "a", "aa", "x"), (4, "", "q", "q")], "riga int, id string, stato string, note string")
    rows = spark.createDataFrame([("a", "nuovo", "mia")], "id string, stato string, note string")
    assert tuple(lifecycle.with_overrides(rows, sheet, "id", ["stato", "note"]).first()) == ("a", "ok", "mia")
    kept = queue.without_own(spark.createDataFrame([("Mia",), ("altra",), ("77",)], "handle string"), F.lit("https://www.facebook.com/mia?x=1"))
    assert sorted(r.handle for r in kept.collect()) == ["77", "altra"]
    q = table(spark, schemas.QUEUE, *({"source_id": s, "fascia": f, "categoria": c} for s, f, c in (("1", "B", "a"), ("2", "A", "z"), ("3", "A", "b"))))
    assert [r.source_id for r in queue.queue_sheet(q).collect()] == ["3", "2", "1"]


def test_image_rules(spark):
    seen = spark.createDataFrame([("small", 100, 500, None, 0.5), ("wide", 3000, 500, None, 0.5), ("known", 500, 500, "ff", 0.5), ("flat", 500, 500, "00", 0.01), ("fine", 500, 500, "0f", 0.5), ("unread", None, None, None, None)], "image string, width int, height int, phash string, edges double")
    out = {r.image: r.motivo_scarto for r in images.reasons(seen, spark.createDataFrame([("known",)], "image string")).collect()}
    assert out == {"small": "dimensioni_troppo_piccole", "wide": "aspect_ratio_implausibile", "known": "duplicato_di_immagine_nota", "flat": "densita_bordi_bassa", "fine": None, "unread": None}
    none = images.prefilter(spark.createDataFrame([("x", b"no image")], "image string, content binary"), spark.createDataFrame([], "phash string, first_seen string"))
    assert [tuple(r) for r in none.collect()] == [("x", None, None)]


def test_venues_and_series(spark):
    from fairground.operators import places

    q = table(spark, schemas.QUEUE, {"source_id": "1", "categoria": "teatro", "soggetto": "Asti - Teatro Alfieri", "comune": ""}, {"source_id": "2", "categoria": "teatro", "soggetto": "Teatro", "comune": "Calosso"}, {"source_id": "3", "categoria": "altro", "soggetto": "Asti - x"})
    out = {r.source_id: r.comune for r in places.link_venues(q, places.place_keys(comuni(spark)), ["teatro"]).collect()}
    assert out == {"1": "Asti", "2": "Calosso", "3": None}
    rule = "struct<e_ricorrente:boolean, frequenza:string, giorni_settimana:array<string>, ordinale:int, mesi_inclusi:array<int>, fine_dichiarata:string, testo_originale:string>"
    told = spark.createDataFrame([(1, "s", "Mercatino dell'antico", "fiera", "Asti", None, (True, "settimanale", ["domenica"], None, None, None, "ogni domenica")), (2, "s", "Una volta", "fiera", "Asti", None, (False, None, None, None, None, None, None))], f"seq long, source_id string, titolo string, tipologia string, comune string, luogo_testuale string, ricorrenza {rule}")
    after, dates = publish.recurring(told, spark.createDataFrame([], schemas.SERIES), comuni(spark), spark.createDataFrame([], "serie_id string, data_inizio string"), day())
    assert [r.titolo for r in after.collect()] == ["Mercatino dell'antico"]
    found = sorted(r.data_inizio for r in dates.collect())
    assert found[0] == "2026-08-23" and len(found) == 18
