"""Operators and jobs on small tables made here."""

import json

import pytest
from pyspark.sql import functions as F

from fairground import schemas
from fairground.functions import text as T
from fairground.operators import dedup, extract, lifecycle, links, places, queue, series
from fairground.plans import publish, views



def day(value="2026-08-22"):
    return F.lit(value).cast("date")


def table(spark, ddl, *rows):
    names = [x.split()[0] for x in ddl.replace("\n", " ").split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)


def comuni(spark):
    base = {"provincia": "AT", "lat": 44.7, "lon": 8.2, "km": 1.0, "minuti": 2.0, "fascia": "A", "attivo": "si"}
    return table(spark, schemas.COMUNI, base | {"istat": "1", "comune": "Calosso", "alias": "Calòs; Calosso Alto"}, base | {"istat": "2", "comune": "Asti", "km": 0.5}, base | {"istat": "3", "comune": "Nizza Monferrato", "fascia": "B"}, base | {"istat": "4", "comune": "Chiusa", "attivo": "no"})


def test_places(spark):
    keys = places.place_keys(comuni(spark))
    rows = spark.createDataFrame([(1, " CALÒSSO ", "Asti", "comune"), (2, "calos", None, None), (3, None, "asti", "comune"), (4, "boh", "asti", "x"), (5, "Chiusa", None, None)], "id int, a string, b string, k string")
    out = {r.id: (r.comune, r.penalty) for r in places.resolve_places(rows, keys, F.col("a"), F.col("b"), F.col("k")).collect()}
    assert out == {1: ("Calosso", 0), 2: ("Calosso", 0), 3: ("Asti", -3), 4: ("Asti", -10), 5: (None, None)}
    src = spark.createDataFrame([("comune-asti",), ("comune-nizza-monferrato-at",), ("teatro-x",)], "source_id string")
    assert {r.source_id: r.comune for r in places.place_of_source(src, comuni(spark)).collect()} == {"comune-asti": "Asti", "comune-nizza-monferrato-at": "Nizza Monferrato", "teatro-x": None}


def test_wrong_entity(spark):
    rows = spark.createDataFrame([("proloco-calosso", "Asti"), ("ProLocoAsti", "Asti"), ("comunecalosso", "Asti"), ("calosso_asti", "Asti"), (None, "Asti")], "handle string, comune string")
    out = {r.handle: r.wrong_comune for r in places.wrong_entity(rows, comuni(spark)).collect()}
    assert out == {"proloco-calosso": "Calosso", "ProLocoAsti": None, "comunecalosso": "Calosso", "calosso_asti": None, None: None}


def event(**more):
    return {"titolo": "Sagra del Tartufo bianco", "titolo_normalizzato": "bianco del tartufo", "data_inizio": "2026-10-03", "data_fine": "2026-10-03", "comune": "Calosso", "comune_normalizzato": "calosso", "tipologia": "sagra", "url": "u"} | more


IN = "seq long, source_id string, titolo string, titolo_normalizzato string, descrizione string, tipologia string, data_inizio string, data_fine string, comune string, comune_normalizzato string, url string"


def test_upsert_events(spark):
    none, edges = spark.createDataFrame([], schemas.EVENTS), spark.createDataFrame([], schemas.EVENT_SOURCES)
    first = table(spark, IN, event(seq=1, source_id="a"), event(seq=2, source_id="b", titolo="Tartufo bianco del Monferrato", titolo_normalizzato="bianco del monferrato tartufo", url="v"), event(seq=3, source_id="c", titolo="Altro", titolo_normalizzato="altro"))
    events, seen = dedup.upsert_events(none, edges, first, "2026-08-22")
    events, seen = spark.createDataFrame(events.collect(), events.schema), spark.createDataFrame(seen.collect(), seen.schema)
    assert sorted((r.titolo, r.stato) for r in events.collect()) == [("Altro", "nuovo"), ("Tartufo bianco del Monferrato", "nuovo")]
    assert sorted(r.source_id for r in seen.collect()) == ["a", "b", "c"]
    locked = events.withColumns({"bloccato": F.lit("si"), "note": F.lit("mia")})
    again, seen = dedup.upsert_events(locked, seen, table(spark, IN, event(seq=1, source_id="d", titolo="Tartufo bianco del Monferrato vecchio", titolo_normalizzato="bianco del monferrato tartufo vecchio")), "2026-08-23")
    rows = {r.titolo: r for r in again.collect()}
    assert len(rows) == 2 and rows["Tartufo bianco del Monferrato"].ultimo_visto == "2026-08-23" and rows["Tartufo bianco del Monferrato"].note == "mia"
    assert seen.count() == 4
    twice, _ = dedup.upsert_events(events, edges, first, "2026-08-24")
    assert twice.count() == 2


def test_duplicate_pairs(spark):
    rows = spark.createDataFrame([(1, "b", "bianco del tartufo", None, ["x"]), (2, "b", "bianco del tartufo vero", None, ["y"]), (3, "b", "bianco del tartufo", None, ["x"]), (4, "b", "", "", ["x"]), (5, "b", "", "", ["x"]), (6, "c", "bianco del tartufo", None, ["x"])], "id long, k string, titolo_normalizzato string, descrizione string, fonti array<string>")
    pairs = dedup.duplicate_pairs(rows, ["k"])
    assert sorted((r.a, r.b) for r in pairs.collect()) == [(1, 2), (1, 3)]
    assert {r.id: r.canonical for r in dedup.canonical(rows, pairs).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}


def _events(draw, n):
    words = "mercato antico fiori piazza libri notte serata".split()
    title = lambda: " ".join(sorted(set(draw.choices(words, k=draw.randint(0, 5)))))
    told = lambda: draw.choice([None, "", " ", "a b c d", "A b c d ", "a b c e", "a b x y z", "b c d e f g h"])
    return [(i, draw.choice(["b", "c", None]), title(), told(), draw.sample("xyz", draw.randint(1, 2))) for i in range(n)]


@pytest.mark.parametrize("bound", [0, 100_000])
def test_canonical_as_pair_by_pair(spark, monkeypatch, bound):
    """The smallest id of the direct matches, of all pairs of a block; a row of a null block has its repeats only."""
    import random

    monkeypatch.setattr(dedup, "BROADCAST_IDS", bound)
    rows = spark.createDataFrame(_events(random.Random(4), 260), "id long, k string, titolo_normalizzato string, descrizione string, fonti array<string>").coalesce(1)
    x, y = rows.alias("x"), rows.alias("y")
    same = T.events_duplicate(*(F.col(f"{t}.{c}") for c in ("titolo_normalizzato", "descrizione", "fonti") for t in "xy"))
    want = {r.id: r.least for r in x.join(y, [F.col("x.k") == F.col("y.k"), F.col("x.id") < F.col("y.id"), same]).groupBy("y.id").agg(F.min("x.id").alias("least")).collect()}
    got = {r.id: r.canonical for r in dedup.canonical(rows, dedup.duplicate_pairs(rows, ["k"])).collect()}
    blocks = {r.id: r.k for r in rows.collect()}
    assert len(want) > 50 and {i: c for i, c in got.items() if blocks[i] and c != i} == want and len(got) == 260


def test_events_of_one_title_are_no_square(spark):
    """Events of one title with descriptions of their own are paired with the first of them, not with each other."""
    rows = spark.range(400).select("id", F.lit("b").alias("k"), F.lit("bianco del tartufo").alias("titolo_normalizzato"), F.concat(F.lit("d "), F.col("id").cast("string")).alias("descrizione"), F.array(F.lit("x")).alias("fonti"))
    pairs = dedup.duplicate_pairs(rows, ["k"])
    assert sorted((r.a, r.b) for r in pairs.select("a", "b").collect()) == [(0, i) for i in range(1, 400)]
    assert {r.canonical for r in dedup.canonical(rows, pairs).collect()} == {0}


def test_similar_images(spark):
    cache = spark.createDataFrame([("ffffffffffffffff", "2"), ("fffffffffffff00f", "1"), ("0000000000000000", "0")], "phash string, first_seen string")
    images = spark.createDataFrame([("i", "ffffffffffffff0f"), ("j", "0f0f0f0f0f0f0f0f")], "image string, phash string")
    assert [(r.image, r.phash, r.distance) for r in dedup.similar_images(cache, images).collect()] == [("i", "fffffffffffff00f", 4)]


RULE = "seq long, source_id string, titolo string, tipologia string, comune string, luogo string, frequenza string, giorni_settimana array<string>, ordinale int, mesi_inclusi array<int>, fine_dichiarata string"


def test_series(spark):
    new = spark.createDataFrame([(1, "s", "Mercatino dell'antico", "fiera", "Asti", None, "mensile", ["domenica"], 1, None, None), (2, "t", "Mercatino antico di Asti", "fiera", "Asti", "p", "mensile", ["SU"], 1, [9], None), (3, "s", "Mai", "fiera", "Asti", None, "annuale", ["SU"], None, None, None)], RULE)
    stored = spark.createDataFrame([], schemas.SERIES)
    after = series.upsert_series(stored, new, day())
    rows = after.collect()
    assert len(rows) == 1 and rows[0].stato == "attiva" and rows[0].rrule.endswith("BYMONTH=9") and rows[0].valida_dal == "2026-08-22"
    kept = spark.createDataFrame(rows, after.schema)
    gone = spark.createDataFrame([(rows[0].serie_id, "2026-09-06")], "serie_id string, data_inizio string")
    none = spark.createDataFrame([], "serie_id string, data_inizio string")
    assert [(r.data_inizio, r.occorrenza, r.confidenza) for r in series.expand_series(kept, comuni(spark), none, day()).collect()] == [("2026-09-06", "1 di 1", 90)]
    assert series.expand_series(kept, comuni(spark), gone, day()).count() == 0
    doubt = kept.withColumn("ultima_conferma", F.lit("2026-01-01"))
    assert series.expand_series(doubt, comuni(spark), none, day()).first().confidenza == 65
    locked = kept.withColumn("bloccata", F.lit("si")).withColumn("regola_leggibile", F.lit("mia"))
    assert [(r.regola_leggibile, r.ultima_conferma) for r in series.upsert_series(locked, new.where("seq = 2"), F.lit("2026-09-01").cast("date")).collect()] == [("mia", "2026-09-01")]


def test_archive_and_states(spark):
    e = table(spark, schemas.EVENTS, {"event_id": "1", "data_fine": "2020-01-01", "archiviato": "no", "stato": "quarantena"}, {"event_id": "2", "data_fine": "2030-01-01", "archiviato": "no", "stato": "ok"}, {"event_id": "3", "archiviato": "no", "stato": None})
    assert {r.event_id: r.archiviato for r in lifecycle.archive_ended(e, day()).collect()} == {"1": "si", "2": "no", "3": "no"}
    confirmed = spark.createDataFrame([("1",), ("2",)], "event_id string")
    assert {r.event_id: r.stato for r in lifecycle.leave_quarantine(e, confirmed).collect()} == {"1": "nuovo", "2": "ok", "3": None}


def test_queue_machine(spark):
    q = table(spark, schemas.QUEUE, *({"source_id": s, "piattaforma": "facebook", "handle": s, "stato": "da_seguire", "tentativi": n} for s, n in (("a", 0), ("b", 2), ("c", 0))))
    log = spark.createDataFrame([("a", "facebook", "gia_seguito", "2026-01-02", None), ("b", "facebook", "errore", "2026-01-02", "timeout")], "source_id string, piattaforma string, esito string, data_follow string, dettaglio string")
    assert {r.source_id: (r.stato, r.tentativi) for r in lifecycle.follow_outcomes(q, log).collect()} == {"a": ("seguito", 0), "b": ("fallito", 3), "c": ("da_seguire", 0)}
    state = spark.createDataFrame([("circuito_aperto_fino_facebook", "2026-08-23T00:00:00"), ("ultimo_lotto_follow_instagram", "2026-08-22T11:30:00")], schemas.APP_STATE)
    plats = spark.createDataFrame([("facebook",), ("instagram",), ("x",)], "piattaforma string")
    why = lifecycle.follow_preconditions(state, log, plats, F.lit("2026-08-22 12:00:00").cast("timestamp"))
    assert {r.piattaforma: r.motivo for r in why.collect()} == {"facebook": "circuito_aperto", "instagram": "intervallo_minimo", "x": None}
    handles, profiles = spark.createDataFrame([("@A",), ("nuovo",), ("altro",)], "handle string"), spark.createDataFrame([("nuovo", "Pro Loco Asti", "asti"), ("altro", "Bar", "asti")], "handle string, soggetto string, comune string")
    out = lifecycle.sync_followed(q, handles, profiles, places.place_keys(comuni(spark)), "facebook", "2026-08-22")
    assert {r.handle: (r.stato, r.comune) for r in out.collect()} == {"a": ("seguito", None), "b": ("da_seguire", None), "c": ("da_seguire", None), "nuovo": ("da_seguire", "Asti"), "altro": ("quarantena", "Asti")}


def test_import_links(spark):
    a = spark.createDataFrame([("Asti", "https://www.facebook.com/ComuneAsti"), ("Ignoto", "https://www.facebook.com/x")], "Comune string, Facebook string")
    b = spark.createDataFrame([("Calosso", "", "https://www.facebook.com/groups/1", "https://www.instagram.com/proloco_calosso/")], "Comune string, Denominazione string, Facebook string, Instagram string")
    s = spark.createDataFrame([("Fiere Piemonte", "https://www.facebook.com/FiereP", None)], "Nome string, Facebook string, Instagram string")
    out = queue.import_links(a, b, s, comuni(spark), places.place_keys(comuni(spark))).collect()
    assert [(r.source_id, r.handle, r.priorita) for r in out] == [("aggregatore-fiere-piemonte-facebook", "FiereP", 75), ("proloco-calosso-instagram", "proloco_calosso", 75), ("comune-asti-facebook", "ComuneAsti", 70)]


def test_links(spark):
    items = "".join(f'<a href="/ev/fiera-{i}">x</a>' for i in range(7)) + '<a href="/feed">f</a><a href="/">h</a><a href="https://altri.it/ev/1">z</a><a href="/news/2026-01-02">d</a>'
    pages = spark.createDataFrame([("https://a.it/", items), ("https://b.it/", "".join(f'<a href="/d?id={i}">x</a>' for i in (3, 20, 100, 4, 5, 6))), ("https://c.it/", "<p>nulla</p>")], "url string, html string")
    out = {}
    for r in links.detail_links(pages).orderBy("page_url", "rank").collect():
        out.setdefault(r.page_url, []).append(r.link)
    assert out["https://a.it/"] == [f"https://a.it/ev/fiera-{i}" for i in range(7)]
    assert out["https://b.it/"][:2] == ["https://b.it/d?id=100", "https://b.it/d?id=20"] and "https://c.it/" not in out


def test_probe(spark):
    homes = spark.createDataFrame([("https://a.it/", '<a href="/ev">Gli spettacoli</a>'), ("https://b.it/", "<p>"), ("https://c.it/", '<link rel="alternate" type="application/rss+xml" href="/feed/">')], "url string, html string")
    landed = spark.createDataFrame([("https://a.it/ev", '<link type="text/calendar" href="/c.ics">')], "url string, html string")
    maps = spark.createDataFrame([("https://b.it/sitemap.xml", "<loc>https://b.it/agenda/x</loc>")], "url string, text string")
    out = {r.url: (r.pagina_calendario, r.fonte_scoperta, r.tipo_endpoint, len(r.note)) for r in links.probe(homes, landed, maps).collect()}
    assert out == {"https://a.it/": ("https://a.it/ev", "homepage", "ical", 0), "https://b.it/": ("https://b.it/agenda/x", "sitemap", None, 1), "https://c.it/": ("https://c.it/", "nessuna", None, 0)}


def test_extraction(spark):
    class Canned:
        def extract(self, system, prompt, images):
            if "rotto" in prompt:
                raise RuntimeError("giù")
            return json.dumps({"annunci": [{"titolo": "Sagra del vino", "data_inizio": "2026-09-12", "data_fine": "2026-09-10", "confidenza": 80, "anno_esplicito": False, "comune_testuale": "Calosso", "tipologia": "boh", "url_approfondimento": "www.x.it", "campi_incerti": []}, {"titolo": "x", "data_inizio": "2026-09-12", "confidenza": 90}, {"titolo": "Vecchia", "data_inizio": "2020-01-01", "confidenza": 90}]})

    asked = spark.createDataFrame([("1", "ok", []), ("2", "rotto", [])], "artifact_id string, prompt string, images array<string>")
    answers = extract.ask(asked, Canned).collect()
    assert {r.artifact_id: r.errore for r in answers} == {"1": None, "2": "giù"}
    read = extract.sane(extract.parse(spark.createDataFrame(answers)), day())
    placed = places.resolve_places(read, places.place_keys(comuni(spark)), F.col("comune_testuale"), F.lit(None), F.lit(None))
    row = extract.event_rows(placed).collect()
    assert len(row) == 1 and (row[0].data_inizio, row[0].data_fine, row[0].confidenza, row[0].esito, row[0].tipologia, row[0].url_approfondimento) == ("2026-09-10", "2026-09-12", 75, "pubblicato", "altro", "https://www.x.it")
    assert row[0].dettaglio_confidenza == "confidenza LLM: 80; anno non esplicito nel testo (-5)"


def test_publish(spark, tmp_path):
    e = table(spark, schemas.EVENTS, {"event_id": "1", "titolo": "Sagra", "data_inizio": "2026-09-01", "comune": "Asti", "archiviato": "no", "stato": "nuovo", "tipologia": "sagra"}, {"event_id": "2", "titolo": "X", "data_inizio": "2020-01-01", "data_fine": "2020-01-01", "comune": "Asti", "archiviato": "no", "stato": "nuovo"})
    empty = {n: spark.createDataFrame([], d) for n, d in (("sources", schemas.SOURCES), ("coda_follow", schemas.QUEUE), ("runs", schemas.RUNS), ("series", schemas.SERIES), ("extractions", schemas.EXTRACTIONS), ("app_state", schemas.APP_STATE))}
    tables = empty | {"events": e, "comuni": comuni(spark), "event_sources": spark.createDataFrame([("1", "s", "u", "x")], schemas.EVENT_SOURCES)}
    sheets = {"annunci": spark.createDataFrame([("1", "ok", "", "", "", "")], "id string, stato string, note string, bloccato string, soppressa string, comune string")}
    publish.publish(spark, tables, sheets, str(tmp_path), "2026-08-22", "2026-08-22T10:00:00")
    assert [(r.id, r.stato, r.fonti) for r in spark.read.parquet(f"{tmp_path}/annunci").collect()] == [("1", "ok", "s")]
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/archivio").collect()] == ["2"]
    def document(name):
        """The parts of a document in the order of their names."""
        return json.loads("".join(x.read_text() for x in sorted((tmp_path / name).glob("part-*"))))

    shown = document("mappa.json")
    assert shown["generato_il"] and shown["annunci"][0]["data_fine"] == "2026-09-01" and shown["annunci"][0]["quarantena"] is False
    assert len(document("perimetro.json")["comuni"]) == 3
    assert document("fonti.json")["fonti"] == []


def test_ingest_and_merge(spark):
    arts = table(spark, schemas.ARTIFACTS.replace("image_urls array<string>, ", ""), {"source_id": "comune-asti", "url": "u", "kind": "ical", "titolo": "FIERA D'AUTUNNO", "data_inizio": "2026-10-01", "luogo_testuale": "Piazza", "raw_hash": "h"}, {"source_id": "comune-asti", "url": "v", "kind": "html", "text": "Sagra del 12 ottobre 2026 in piazza del mercato vecchio", "raw_hash": "k"}).withColumn("image_urls", F.array().cast("array<string>"))
    src = table(spark, schemas.SOURCES, {"source_id": "comune-asti", "categoria": "comune"})
    rows = publish.ingest(arts, src, comuni(spark), day(), extract.RuleProvider)
    assert sorted((r.titolo, r.comune, r.confidenza, r.esito) for r in rows.collect()) == [("Fiera D'autunno", "Asti", 92, "pubblicato"), ("Sagra del 12 ottobre 2026 in piazza del mercato vecchio", "Asti", 82, "pubblicato")]
    events, edges, outcomes = publish.merge_events(spark.createDataFrame([], schemas.EVENTS), spark.createDataFrame([], schemas.EVENT_SOURCES), rows, "2026-08-22")
    assert events.count() == 2 and edges.count() == 2 and sorted(r.esito for r in outcomes.collect()) == ["pubblicato"] * 2


ROWS = IN + ", prezzo string, esito string"


def merged(spark, stored, edges, *rows):
    events, edges, outcomes = publish.merge_events(stored, edges, publish.event_columns(table(spark, ROWS, *rows)), "2026-08-23")
    keep = lambda df: spark.createDataFrame(df.collect(), df.schema)
    return keep(events), keep(edges), {r.seq: r for r in outcomes.collect()}


def test_merge_follows_the_event_folded_into(spark):
    """Verdicts reach the event of a fuzzy match; columns the batch lacks stay; rejected rows have a reason."""
    none, edges = spark.createDataFrame([], schemas.EVENTS), spark.createDataFrame([], schemas.EVENT_SOURCES)
    near = {"titolo": "Tartufo bianco del Monferrato", "titolo_normalizzato": "bianco del monferrato tartufo"}
    events, edges, out = merged(spark, none, edges, event(seq=1, source_id="a", prezzo="5 euro", esito="pubblicato"), event(seq=2, source_id="a", comune=None, comune_normalizzato=None, esito="quarantena"), event(seq=3, source_id="a", data_inizio=None, esito="scartato"))
    assert [(out[n].esito, out[n].motivo, out[n].event_id is None) for n in (1, 2, 3)] == [("pubblicato", None, False), ("quarantena", "comune_ambiguo", True), ("scartato", "data_mancante", True)]
    first = events.first()
    # A doubtful sighting of the same event under another title: no second event, and the first is in doubt.
    events, edges, out = merged(spark, events, edges, event(seq=1, source_id="b", esito="quarantena", **near))
    assert events.count() == 1 and out[1].event_id == first.event_id and events.first().stato == "quarantena"
    # Confirmed again, by yet another title, after a doubtful one: the last to arrive decides.
    events, edges, out = merged(spark, events, edges, event(seq=7, source_id="c", esito="pubblicato", **near), event(seq=2, source_id="c", esito="quarantena"))
    assert events.first().stato == "nuovo" and edges.count() == 3
    for decided in ("ok", "scartato"):
        kept = events.withColumn("stato", F.lit(decided))
        assert merged(spark, kept, edges, event(seq=1, source_id="b", esito="quarantena"))[0].first().stato == decided
    # A batch without prices leaves them.
    plain = table(spark, IN, event(seq=1, source_id="z", titolo="Sagra del Tartufo Bianco"))
    again, _ = dedup.upsert_events(events.withColumn("prezzo", F.lit("5 euro")), edges, plain, "2026-08-24")
    row = again.first()
    assert (row.prezzo, row.titolo, row.primo_visto, row.ultimo_visto) == ("5 euro", "Sagra del Tartufo Bianco", "2026-08-23", "2026-08-24")


def fold_slowly(stored, rows):
    """One pass over all sightings against all events, by the rules as sets."""
    rules = dedup._python_rules()
    events = [dict(e) for e in stored]
    where = {}
    for r in rows:
        hit = next((e for e in events if e["id"] == r["id"]), None)
        if hit is None:
            for e in events:
                if e["open"] and (e["day"], e["town"]) == (r["day"], r["town"]) and rules(set(r["key"].split()), set(e["key"].split()), r["text"].strip().lower(), e["text"].strip().lower(), {r["source"]}, e["sources"]):
                    hit = e
                    break
        if hit is None:
            hit = {"id": r["id"], "day": r["day"], "town": r["town"], "open": True, "locked": False, "sources": set(), "key": r["as_stored"], "text": r["text"]}
            events.append(hit)
        elif not hit["locked"]:
            hit |= {"key": r["as_stored"], "text": r["text"]}
        hit["sources"] = hit["sources"] | {r["source"]}
        where[r["seq"]] = hit["id"]
    return where


def test_fold_against_one_pass(spark):
    import random

    words = "mercatino natale castello concerto banda gara pesca evento sagra".split()
    for seed in range(4):
        rng = random.Random(seed)
        rows = [event(seq=i, source_id=f"s{rng.randrange(3)}", titolo=(title := " ".join(rng.choices(words, k=rng.randint(1, 5))).capitalize()), titolo_normalizzato=title, descrizione=rng.choice(["", "vieni a trovarci", "vieni a vederci", None, title]), data_inizio=f"2026-10-0{rng.randint(1, 2)}", comune=(town := rng.choice(["Asti", "Calosso"])), comune_normalizzato=town.lower()) for i in range(120)]
        incoming = table(spark, IN, *rows).withColumn("titolo_normalizzato", T.title_key(F.col("titolo"), F.col("comune")))
        stored_rows = rows[:40:3]
        stored = publish.migrate(dedup.keyed(incoming.where(F.col("seq").isin([r["seq"] for r in stored_rows]))).dropDuplicates(["event_id"]), schemas.EVENTS).withColumns({"bloccato": F.when(F.length("titolo") % 4 == 0, "si").otherwise("no"), "archiviato": F.when(F.length("titolo") % 5 == 0, "si").otherwise("no")})
        stored = spark.createDataFrame(stored.orderBy("event_id").collect(), stored.schema)
        edges = spark.createDataFrame([(r.event_id, "s1", "u", "2026-01-01") for r in stored.collect()], schemas.EVENT_SOURCES)
        new = dedup.keyed(incoming)
        got = {r.seq: r.target for r in dedup.fold_targets(stored, edges, new).collect()}
        known = stored.withColumn("key", T.title_key(F.col("titolo"))).orderBy("event_id").collect()
        begin = [{"id": r.event_id, "day": r.data_inizio, "town": r.comune, "open": r.archiviato == "no", "locked": r.bloccato == "si", "sources": {"s1"}, "key": r.key, "text": r.descrizione or ""} for r in known]
        seen = [{"seq": r.seq, "id": r.event_id, "day": r.data_inizio, "town": r.comune, "source": r.source_id, "key": r.titolo_normalizzato, "as_stored": r.k, "text": r.descrizione or ""} for r in new.withColumn("k", T.title_key(F.col("titolo"))).orderBy("seq").collect()]
        assert got == fold_slowly(begin, seen) and len(set(got.values())) < 110
        after, links = dedup.upsert_events(stored, edges, incoming, "2026-08-22")
        assert {r.event_id for r in after.collect()} == {r.event_id for r in known} | set(got.values())
        last = {got[r["seq"]]: r["titolo"] for r in rows}
        locked = {r.event_id: r.titolo for r in known if r.bloccato == "si"}
        assert {r.event_id: r.titolo for r in after.collect() if r.event_id in last} == last | {e: t for e, t in locked.items() if e in last}


def test_similar_images_by_brute_force(spark):
    import random

    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)]
    near = [b ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 11))}) for b in base for _ in range(6)]
    cache = spark.createDataFrame([(f"{b:016x}", f"2026-01-{i + 1:02d}") for i, b in enumerate(base)] + [(None, "x"), ("zz", "y")], "phash string, first_seen string")
    images = spark.createDataFrame([(f"i{i}", f"{n:016x}") for i, n in enumerate(near)] + [("no", None)], "image string, phash string")
    for most in (8, 4, 0):
        want = set()
        for i, n in enumerate(near):
            close = [(j, (b ^ n).bit_count()) for j, b in enumerate(base) if (b ^ n).bit_count() <= most]
            if close:
                want.add((f"i{i}", f"{base[close[0][0]]:016x}", close[0][1]))
        assert {tuple(r) for r in dedup.similar_images(cache, images, most).collect()} == want


def test_extraction_records(spark):
    arts = table(spark, schemas.ARTIFACTS.replace("image_urls array<string>, ", ""), {"source_id": "comune-asti", "url": "v", "kind": "html", "text": "Sagra del 12 ottobre 2026 in piazza del mercato vecchio", "raw_hash": "k"}).withColumn("image_urls", F.array(F.lit("http://x/p.jpg")))
    src = table(spark, schemas.SOURCES, {"source_id": "comune-asti", "categoria": "comune"})
    stored = spark.createDataFrame([], schemas.EXTRACTIONS)
    new = publish.extract_new(arts, stored, src, comuni(spark), day(), extract.RuleProvider, "2026-08-22T10:00:00")
    assert new.columns == stored.columns
    new = spark.createDataFrame(new.collect(), new.schema)
    row = new.first()
    assert row.model == "rules" and row.confidence == 85 and json.loads(row.parsed_json)["annunci"][0]["data_inizio"] == "2026-10-12" and row.extraction_id
    assert publish.extract_new(arts, new, src, comuni(spark), day(), extract.RuleProvider, "x").count() == 0
    read = publish.ingest(arts, src, comuni(spark), day(), extractions=new).collect()
    assert [(r.titolo, r.url_approfondimento, r.esito) for r in read] == [("Sagra del 12 ottobre 2026 in piazza del mercato vecchio", "http://x/p.jpg", "pubblicato")]


def test_views_edge_cases(spark):
    rows = views.on_date(spark.createDataFrame([("1", "2026-08-20", None, "Asti", "sagra"), ("2", "2026-08-20", "2026-08-22", "Asti", "fiera")], "id string, data_inizio string, data_fine string, comune string, tipologia string"), day())
    assert [r.id for r in rows.collect()] == ["2"]
    assert publish.expired_backups(["a-2026-08-01", "a-2026-08-20", "b"], "2026-08-22") == ["a-2026-08-01"]
    assert spark.range(1).select(T.site_symbol(F.lit(""), F.lit(0)), T.site_symbol(F.lit("u"), F.lit(1))).first() == ("", "X")


def _one(seq, title, place):
    return (seq, "s", title, "fiera", place, None, "settimanale", ["SU"], None, None, None)


def test_series_of_one_municipality_are_not_compared_all(spark):
    """A word that all titles hold makes no pairs: every second sighting meets the series before it, by its number."""
    import time

    new = spark.createDataFrame([_one(i, f"Mercato {i // 2} {'grande' if i % 2 else ''}", "Asti") for i in range(12000)], RULE)
    began = time.perf_counter()
    got = {r.seq: (r.near_id, r.own_id) for r in series.assigned(spark.createDataFrame([], schemas.SERIES), new).select("seq", "near_id", "own_id").collect()}
    assert time.perf_counter() - began < 60
    assert all(got[i][0] == (got[i - 1][1] if i % 2 else None) for i in range(12000))


def test_similar_series_as_pair_by_pair(spark):
    """The first similar series of each sighting: among those stored, by id; else among those told before."""
    import random

    draw = random.Random(3)
    title = lambda: " ".join(draw.choices("mercato antico fiori piazza libri notte serata".split(), k=draw.randint(0, 5)))
    new = spark.createDataFrame([_one(i * 3, title(), draw.choice(["Asti", "Calosso"])) for i in range(120)], RULE)
    stored = table(spark, schemas.SERIES, *({"serie_id": f"k{i}", "titolo": title(), "comune": "Asti", "stato": "sospesa" if i % 5 == 0 else "attiva"} for i in range(6)))
    x = series.describe(new).alias("x")
    y = stored.where("stato <> 'sospesa'").select("comune", F.col("serie_id").alias("_id"), T.title_key(F.col("titolo"), F.col("comune")).alias("titolo_normalizzato"), F.lit(-1).cast("long").alias("_at"))
    y = y.unionByName(series.describe(new).select("comune", F.col("own_id").alias("_id"), "titolo_normalizzato", F.col("seq").alias("_at"))).alias("y")
    pairs = x.join(y, [F.col("x.comune") == F.col("y.comune"), F.col("y._at") < F.col("x.seq"), T.series_titles_similar(F.col("x.titolo_normalizzato"), F.col("y.titolo_normalizzato"))])
    want = {r.seq: r.m._id for r in pairs.groupBy("x.seq").agg(F.min(F.struct("y._at", "y._id")).alias("m")).collect()}
    got = {r.seq: r.near_id for r in series.assigned(stored, new).select("seq", "near_id").collect() if r.near_id}
    assert len(want) > 50 and got == want
