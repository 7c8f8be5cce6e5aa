"""Runs from end to end: recurring events, the day's budget, pictures, counters, feeds on hold."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_jobs import artifacts, stored
from test_operators import comuni, day, table

from fairground import schemas
from fairground.config import Settings
from fairground.operators import backlog, extract, images, lifecycle
from fairground.plans import publish

WEEKLY = {"titolo": "Mercatino dell'antico", "tipologia": "fiera", "confidenza": 90, "anno_esplicito": True, "campi_incerti": [], "ricorrenza": {"e_ricorrente": True, "frequenza": "settimanale", "giorni_settimana": ["domenica"]}}


def recurring():
    """A provider that says of each text with "ogni domenica" that it recurs; made here, so that workers get it by value."""
    weekly = WEEKLY

    class Recurring(extract.RuleProvider):
        name = "recurring"

        def extract(self, system, prompt, images):
            if "ogni domenica" in prompt:
                return json.dumps({"annunci": [weekly], "non_e_un_evento": False, "motivo": None})
            return super().extract(system, prompt, images)

    return Recurring


SOURCE = {"source_id": "comune-asti", "categoria": "comune", "tier": "T1_html", "endpoint": "https://a.it", "stato": "attiva", "consecutive_errors": 2, "esiti_totali": 5, "esiti_utili": 3}
MARKET = {"source_id": "comune-asti", "url": "v", "kind": "html", "text": "Mercatino dell'antico ogni domenica in piazza Alfieri, dal 12 ottobre 2026", "raw_hash": "k"}


def test_a_run_routes_recurring_events_and_counts(spark, tmp_path):
    tables = stored(spark, comuni=comuni(spark), sources=table(spark, schemas.SOURCES, SOURCE, SOURCE | {"source_id": "comune-calosso"}))
    tables["artifacts"] = spark.createDataFrame([], schemas.ARTIFACTS + ", artifact_id string, fetched_at string")
    landed = artifacts(spark, MARKET, {"source_id": "comune-asti", "url": "w", "kind": "html", "text": "Sagra del 12 ottobre 2026 in piazza del mercato vecchio", "raw_hash": "l"}, {"source_id": "comune-calosso", "url": "x"})
    landed = landed.withColumn("errore", F.when(F.col("url") == "x", "timeout"))
    after = publish.run_publish(spark, tables, landed, {}, f"{tmp_path}/db", f"{tmp_path}/out", "2026-08-22", "2026-08-22T10:00:00", recurring())
    series = after["series"].collect()
    events = after["events"].collect()
    dates = [e for e in events if e.serie_id]
    assert [(s.titolo, s.regola_leggibile, s.stato) for s in series] == [("Mercatino dell'antico", "ogni domenica", "attiva")]
    assert len(events) == 19 and len(dates) == 18 and {e.serie_id for e in dates} == {series[0].serie_id} and min(e.data_inizio for e in dates) == "2026-08-23"
    assert sorted(e.occorrenza for e in dates)[0] == "1 di 18" and all(e.comune == "Asti" for e in events)
    assert spark.read.parquet(f"{tmp_path}/out/serie").count() == 1
    edges = {r.source_id for r in after["event_sources"].collect()}
    assert edges == {"comune-asti"} and after["event_sources"].count() == 19
    src = {r.source_id: r for r in after["sources"].collect()}
    assert (src["comune-asti"].consecutive_errors, src["comune-asti"].esiti_totali, src["comune-asti"].esiti_utili, src["comune-asti"].last_run) == (0, 7, 22, "2026-08-22T10:00:00")
    assert (src["comune-calosso"].consecutive_errors, src["comune-calosso"].ultimo_errore) == (3, "timeout")
    run = after["runs"].collect()
    assert [(r.tipo, r.fonti_tentate, r.fonti_ok, r.fonti_errore, r.artefatti, r.chiamate_llm, r.nuovi, r.aggiornati) for r in run] == [("run-publish", 2, 1, 1, 2, 2, 19, 0)]
    assert after["artifacts"].count() == 2 and spark.read.parquet(f"{tmp_path}/out/log").count() == 1
    # An operator keeps one date away; the same texts again, and an answer read again, bring no other series or event.
    gone = min(e.event_id for e in dates)
    after["events"] = after["events"].withColumn("soppressa", F.when(F.col("event_id") == gone, "si").otherwise(F.col("soppressa")))
    again = publish.replay(after, landed.where("errore is null").drop("errore"), "2026-08-22")
    assert again["series"].count() == 1 and again["events"].count() == 19 and again["added"].count() == 0
    assert again["outcomes"].count() == 18


def test_the_day_budget_stages_what_it_does_not_admit(spark, tmp_path):
    tables = stored(spark, comuni=comuni(spark), sources=table(spark, schemas.SOURCES, SOURCE, SOURCE | {"source_id": "comune-calosso", "consecutive_errors": 0}))
    text = "Sagra del 12 ottobre 2026 in piazza del mercato vecchio numero "
    landed = artifacts(spark, *({"source_id": f"comune-{'asti' if i % 2 else 'calosso'}", "url": f"u{i}", "kind": "html", "text": text + str(i), "raw_hash": str(i)} for i in range(7)))
    small = Settings(daily_extractions=4)
    run = lambda t, a, d, n: publish.run_publish(spark, t, a, {}, f"{tmp_path}/db", f"{tmp_path}/out{n}", d, f"{d}T1{n}:00:00", extract.RuleProvider, small)
    one = run(tables, landed, "2026-08-22", 0)
    assert one["extractions"].count() == 4 and one["staged"].count() == 3
    # Calosso has fewer errors and goes first: all its four are read.
    assert {r.source_id for r in one["staged"].collect()} == {"comune-asti"}
    two = run(one, landed.limit(0), "2026-08-22", 1)
    assert two["extractions"].count() == 4 and two["staged"].count() == 3
    three = run(two, landed.limit(0), "2026-08-23", 2)
    assert three["extractions"].count() == 7 and three["staged"].count() == 0
    assert len({r.artifact_id for r in three["extractions"].collect()}) == 7


@pytest.mark.parametrize("used", [0, 5, 11, 14, 20])
def test_shares_of_the_budget_as_one_by_one(spark, used):
    rows = [(i, "A" if i % 5 == 0 else "B", i % 3 == 0) for i in range(40)]
    inside, later = backlog.by_quota(spark.createDataFrame(rows, "id int, fascia string, ha_immagine boolean"), used, 20, ["id"])
    at, want = used, []
    for i, band, image in rows:
        share = at / 20
        if share < 0.7 or (share < 0.85 and (band == "A" or not image)) or (share < 1 and band == "A"):
            want.append(i)
            at += 1
    assert sorted(r.id for r in inside.collect()) == want
    assert later.count() == 40 - len(want) and later.where("rinvio is null").count() == 0


def test_a_feed_on_hold_is_not_read(spark):
    state = spark.createDataFrame([("ultimo_lotto_follow_instagram", "2026-08-22T09:30:00"), ("ultimo_lotto_follow_facebook", "2026-08-22T08:00:00")], schemas.APP_STATE)
    assert [r.piattaforma for r in lifecycle.feeds_on_hold(state, F.lit("2026-08-22 10:00:00").cast("timestamp")).collect()] == ["instagram"]
    tables = stored(spark, comuni=comuni(spark), app_state=state)
    q = table(spark, schemas.QUEUE, *({"source_id": p, "piattaforma": p, "handle": "proloco", "comune": "Asti", "categoria": "proloco", "stato": "seguito"} for p in ("facebook", "instagram")))
    posts = artifacts(spark, *(MARKET | {"source_id": None, "url": p} for p in ("facebook", "instagram"))).withColumns({"piattaforma": F.col("url"), "handle": F.lit("proloco"), "gruppo": F.lit(False)})
    out = publish.run_feed(posts, q, tables, "2026-08-22", "2026-08-22T10:00:00", recurring())
    assert [r.url for r in out["on_hold"].collect()] == ["instagram"] and out["series"].count() == 1
    # Eighteen dates of one post, whose outcome is one.
    assert out["events"].where("serie_id is not null").count() == 18 and out["posts"].count() == 1


def test_pictures_are_judged_before_a_text(spark, monkeypatch):
    judged = spark.createDataFrame([("good", "00ff", None), ("bad", "0f0f", "densita_bordi_bassa"), ("unread", None, None)], "image string, phash string, motivo_scarto string")
    monkeypatch.setattr(images, "prefilter", lambda pictures, cache: judged)
    arts = artifacts(spark, {"url": "a"}, {"url": "b"}).withColumn("image_urls", F.when(F.col("url") == "a", F.array(F.lit("bad"), F.lit("good"), F.lit("elsewhere"))))
    kept, cache = publish.without_images(arts, judged, spark.createDataFrame([("00ff", "old", None, None, None)], schemas.IMAGE_CACHE), "now")
    assert {r.url: r.image_urls for r in kept.collect()} == {"a": ["good", "elsewhere"], "b": None}
    assert [(r.phash, r.first_seen) for r in cache.collect()] == [("00ff", "old")]


def test_hash_and_edges_of_arrays():
    """A checkerboard of low waves has the hash of its cosines, and turns over with the picture; edges are where it steps."""
    n = np.arange(32)
    wave = 100 + 50 * np.outer(np.cos(np.pi * (n + 0.5) / 32), np.cos(2 * np.pi * (n + 0.5) / 32))
    a, b = images.perceptual_hash(wave), images.perceptual_hash(255 - wave)
    assert len(a) == 16 and a != b and images.perceptual_hash(wave + 3) == a
    bits = lambda h: f"{int(h, 16):064b}"
    assert bits(a)[8 + 2] == "1" and bits(b)[8 + 2] == "0"
    step = np.zeros((10, 10))
    step[:, 5:] = 200
    assert images.edge_share(step) == pytest.approx(16 / 64) and images.edge_share(np.zeros((10, 10))) == 0.0
