"""Registered queries over changes of state: pulled columns, imports, the follow queue, replays, counters and page views."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairground import schemas
from fairground.functions import filters
from fairground.functions import text as T
from fairground.operators import lifecycle, links
from fairground.plans import publish, views
from fairground.queries import AS_OF, comuni, edges, events, follow_queue, full_events, query, sources, t


@query("""$ , sh AS (SELECT source_id, CASE WHEN n % 4 = 0 THEN ' ' ELSE 'cat' || n END AS categoria, n FROM (SELECT source_id, unnest([esiti_utili, esiti_utili + 5, esiti_utili + 2]) AS n FROM sources WHERE esiti_utili % 2 = 0)), l AS (SELECT source_id, arg_max(categoria, n) AS c FROM sh GROUP BY 1)
SELECT s.source_id, CASE WHEN l.source_id IS NULL THEN categoria ELSE nullif(trim(c), '') END AS categoria FROM sources s LEFT JOIN l ON l.source_id = s.source_id""")
def pull_sources(spark, d):
    """Categories as the last row of each key has them."""
    n = F.col("esiti_utili")
    sheet = sources(spark, d).where(n % 2 == 0).select("source_id", F.explode(F.array(n, n + 5, n + 2)).alias("riga"))
    sheet = sheet.withColumns({"categoria": F.when(F.col("riga") % 4 == 0, " ").otherwise(F.concat(F.lit("cat"), F.col("riga").cast("string"))), "polling_diretto": F.lit("si")})
    return lifecycle.pull_source_columns(sources(spark, d).withColumn("polling_diretto", F.lit(None).cast("string")), sheet).select("source_id", "categoria")


@query("""$ SELECT source_id, CASE WHEN seq % 2 = 0 THEN 'X' || seq ELSE comune END AS comune, CASE WHEN seq % 3 = 0 THEN 'seguito' ELSE stato END AS stato FROM queue""")
def pull_queue(spark, d):
    q = follow_queue(spark, d)
    sheet = q.select("source_id", F.when(F.col("seq") % 2 == 0, F.concat(F.lit(" X"), F.col("seq").cast("string"))).otherwise(" ").alias("comune"), F.when(F.col("seq") % 3 == 0, "seguito").otherwise("boh").alias("stato"))
    return lifecycle.pull_queue_columns(q, sheet).select("source_id", "comune", "stato")


@query("""$ SELECT count(*) FILTER (k <= 1000000 AND source_id IS NOT NULL) AS aggiornate, count(*) FILTER (source_id IS NULL) AS ignorate FROM (SELECT s_suppkey AS k, 'teatro-' || s_suppkey AS id FROM supplier) x LEFT JOIN (SELECT DISTINCT source_id FROM sources) s ON s.source_id = x.id""")
def pull_counts(spark, d):
    sheet = t(spark, d, "supplier").select(F.concat(F.lit("teatro-"), F.col("s_suppkey").cast("string")).alias("source_id"))
    return lifecycle.pull_tally(sheet.unionByName(sheet.limit(0)), sources(spark, d))


@query("""$ , f AS (SELECT CASE WHEN s_suppkey % 2 = 1 THEN 'teatro-' || s_suppkey ELSE 'nuova-' || s_suppkey END AS source_id, 'https://i' || s_suppkey || '.example' AS e FROM supplier)
SELECT coalesce(s.source_id, f.source_id) AS source_id, coalesce(e, endpoint) AS endpoint, CASE WHEN e IS NOT NULL THEN 'importata' ELSE categoria END AS categoria, coalesce(tier, CASE WHEN e IS NOT NULL THEN 'T1_html' END) AS tier FROM sources s FULL JOIN f ON f.source_id = s.source_id""")
def import_found_sources(spark, d):
    k = F.col("s_suppkey")
    found = t(spark, d, "supplier").select(F.concat(F.when(k % 2 == 1, "teatro-").otherwise("nuova-"), k.cast("string")).alias("source_id"), F.concat(F.lit("https://i"), k.cast("string"), F.lit(".example")).alias("endpoint"), F.lit("importata").alias("categoria"))
    return lifecycle.import_sources(sources(spark, d), found).select("source_id", "endpoint", "categoria", "tier")


@query("""WITH o AS (SELECT c_custkey AS k, 'v' || c_custkey AS v FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS k, 'n' || c_custkey AS v FROM customer WHERE c_custkey % 2 = 0)
SELECT 'ultimo' AS modo, coalesce(n.k, o.k) AS k, coalesce(n.v, o.v) AS v FROM o FULL JOIN n ON n.k = o.k UNION ALL SELECT 'primo', coalesce(o.k, n.k), coalesce(o.v, n.v) FROM o FULL JOIN n ON n.k = o.k""")
def upsert_modes(spark, d):
    """New rows instead of stored ones, and only where there is none."""
    rows = lambda test, p: t(spark, d, "customer").where(test).select(F.col("c_custkey").alias("k"), F.concat(F.lit(p), F.col("c_custkey").cast("string")).alias("v"))
    old, new = rows("c_custkey % 3 <> 0", "v"), rows("c_custkey % 2 = 0", "n")
    mode = lambda df, m: df.select(F.lit(m).alias("modo"), "k", "v")
    return mode(lifecycle.upsert_latest(old, new, ["k"]), "ultimo").unionByName(mode(lifecycle.insert_missing(old, new, ["k"]), "primo"))


@query("""$ SELECT source_id, CASE WHEN tier = 'T1_html' AND esiti_utili % 4 = 0 THEN 'T0_jsonld' WHEN tier = 'T1_html' AND esiti_utili % 4 = 1 THEN 'T0_pa_design_system' ELSE tier END AS tier FROM sources""")
def tiers_promoted(spark, d):
    n = F.col("esiti_utili") % 4
    checks = sources(spark, d).select("source_id", (n == 0).alias("ha_jsonld"), (n <= 1).alias("ha_cards"))
    return lifecycle.promote_tiers(sources(spark, d), checks.unionByName(checks.select("source_id", F.lit(False).alias("ha_jsonld"), F.lit(False).alias("ha_cards")))).select("source_id", "tier")


@query("""$ SELECT source_id, seq FROM (SELECT *, row_number() OVER (ORDER BY seq) AS r FROM queue WHERE piattaforma = 'facebook' AND stato = 'da_seguire' AND tentativi < 3) WHERE r <= 7""")
def next_to_follow(spark, d):
    return lifecycle.follow_candidates(follow_queue(spark, d), "facebook", 7).select("source_id", "seq")


@query("""$ , g AS (SELECT *, stato = 'seguito' AND piattaforma = 'facebook' AND seq % 2 = 0 AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.source_id = 'feed-facebook-' || handle) AS via FROM queue)
SELECT source_id, CASE WHEN via THEN 'non_valido' ELSE stato END AS stato, CASE WHEN via THEN 'contenuto non disponibile: ''this content isn''t available''' END AS note FROM g""")
def pages_gone(spark, d):
    """Followed pages without an event whose landed page says that it is gone."""
    q = follow_queue(spark, d).withColumn("note", F.lit(None).cast("string"))
    pages = q.select("url", F.when(F.col("seq") % 2 == 0, "Sorry: This content isn't available at the moment").otherwise("Benvenuti").alias("text"))
    return lifecycle.unavailable_sources(q, edges(spark, d), pages).select("source_id", "stato", "note")


@query("""$ SELECT (SELECT count(*) FROM events) AS annunci, (SELECT count(*) FROM events WHERE archiviato = 'no') AS aperti, (SELECT count(*) FROM events WHERE archiviato = 'no' AND stato = 'quarantena') AS in_quarantena, (SELECT count(*) FROM sources) AS fonti,
(SELECT count(*) FROM sources WHERE consecutive_errors > 0) AS fonti_in_errore, (SELECT count(DISTINCT source_id) FROM edges) AS fonti_attive""")
def status_counters(spark, d):
    return views.status(events(spark, d), sources(spark, d), edges(spark, d))


@query("""$ SELECT categoria, count(*) AS n, count(*) / (SELECT count(*) FROM sources) AS quota FROM sources GROUP BY 1""")
def category_shares(spark, d):
    return links.shares(sources(spark, d), "categoria")


@query("""SELECT p_partkey FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_type), 'econ')""")
def rows_containing(spark, d):
    return views.containing(t(spark, d, "part"), "Ring", "p_name").select("p_partkey").unionByName(views.containing(t(spark, d, "part"), "ECON", "p_type").select("p_partkey")).distinct()


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'mai verificata' WHEN 1 THEN 'non seguita' ELSE strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') || ' 08:30' END AS testo FROM orders""")
def freshness_text(spark, d):
    k = F.col("o_orderkey") % 4
    when = F.when(k == 0, None).when(k == 1, "non_seguita").otherwise(F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit(" 08:30:00")))
    return t(spark, d, "orders").select("o_orderkey", views.freshness(when).alias("testo"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 72 WHEN 1 THEN 168 WHEN 2 THEN 8760 WHEN 3 THEN 72 END AS ore FROM orders""")
def hours_blocked(spark, d):
    said = F.element_at(F.array(*map(F.lit, ["Risolvi il CAPTCHA", "Riprova più tardi", "Conferma la tua identità", "checkpoint richiesto", "Benvenuto"])), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return t(spark, d, "orders").select("o_orderkey", filters.block_hours(said).alias("ore"))


@query("""$ , p AS (SELECT s_suppkey, 'h' || (s_suppkey * 3 // 2) AS handle FROM supplier), k AS (SELECT handle, min(comune) AS comune, min(categoria) AS categoria FROM queue WHERE piattaforma = 'facebook' AND coalesce(comune, '') <> '' GROUP BY 1)
SELECT s_suppkey, k.comune, k.categoria FROM p LEFT JOIN k ON k.handle = p.handle""")
def posts_attributed(spark, d):
    k = F.col("s_suppkey")
    posts = t(spark, d, "supplier").select("s_suppkey", F.lit("facebook").alias("piattaforma"), F.concat(F.lit("@H"), F.floor(k * 3 / 2).cast("string")).alias("handle"))
    return lifecycle.attribute_posts(posts, follow_queue(spark, d))[0].select("s_suppkey", "comune", "categoria")


@query("""$ , r AS (SELECT DISTINCT url FROM events WHERE CAST(event_id AS BIGINT) % 5 = 0) SELECT event_id, CASE WHEN r.url IS NOT NULL AND archiviato = 'no' THEN 'si' ELSE archiviato END AS archiviato,
CASE WHEN r.url IS NOT NULL AND archiviato = 'no' THEN coalesce(nullif(note, '') || ' | ', '') || 'sostituito da new-' || e.url ELSE note END AS note FROM events e LEFT JOIN r ON r.url = e.url""")
def replays_replace(spark, d):
    """Events of urls whose replay gave another event are archived with a note."""
    e = events(spark, d)
    found = e.where(F.col("event_id").cast("long") % 5 == 0).select("url", F.concat(F.lit("new-"), "url").alias("event_id")).unionByName(e.select("url", "event_id"))
    return lifecycle.replace_after_replay(e, found).select("event_id", "archiviato", "note")


@query("""WITH a AS (SELECT 's' || (o_custkey % 9) AS s, 'u' || (o_custkey % 50) AS u, sha1(o_orderpriority) AS h FROM orders), x AS (SELECT DISTINCT substr(sha1(s || '|' || u || '|' || h), 1, 16) AS artifact_id, s, u FROM a) SELECT artifact_id, s AS source_id, u AS url FROM x WHERE s <> 's3'""")
def artifacts_appended(spark, d):
    """Contents that are not stored yet, each once."""
    c = F.col("o_custkey")
    new = t(spark, d, "orders").select(F.concat(F.lit("s"), (c % 9).cast("string")).alias("source_id"), F.concat(F.lit("u"), (c % 50).cast("string")).alias("url"), F.sha1("o_orderpriority").alias("raw_hash"))
    from fairground.functions.text import artifact_id

    had = new.where("source_id = 's3'").select(artifact_id(F.col("source_id"), F.col("url"), F.col("raw_hash")).alias("artifact_id")).distinct()
    return publish.append_artifacts(had, new, "1998-06-15").select("artifact_id", "source_id", "url")


@query("""$ SELECT 'evento' AS cosa, e.event_id AS id, titolo AS testo, CAST(1 AS BIGINT) AS n FROM edges d JOIN events e ON e.event_id = d.event_id WHERE d.source_id = 'feed-instagram-h1'""")
def detail_of_source(spark, d):
    from fairground import schemas

    return views.source_detail("feed-instagram-h1", edges(spark, d), full_events(spark, d), spark.createDataFrame([], schemas.EXTRACTIONS), spark.createDataFrame([], "artifact_id string, source_id string, url string"))


@query("""WITH e AS (SELECT user_id, max(ts) AS t FROM events GROUP BY 1), m AS (SELECT max(ts) AS now FROM events), n AS (SELECT user_id, count(*) AS n FROM events, m WHERE event_type = 'purchase' AND CAST(ts AS DATE) = CAST(now AS DATE) GROUP BY 1)
SELECT CAST(e.user_id AS VARCHAR) AS piattaforma, CASE WHEN e.user_id % 7 = 0 THEN 'circuito_aperto' WHEN date_diff('second', date_trunc('second', t), date_trunc('second', now)) < 45 * 60 THEN 'intervallo_minimo' WHEN n >= 20 THEN 'limite_giornaliero' END AS motivo FROM e CROSS JOIN m LEFT JOIN n ON n.user_id = e.user_id""")
def follow_guards(spark, d):
    """Why each platform (a user's rows, here) may not be worked on at the time of the last row."""
    e = t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    user = F.col("user_id").cast("string")
    now = e.agg(F.date_trunc("second", F.max("ts")).cast("string").alias("n")).first()["n"]
    last = e.groupBy("user_id").agg(F.date_trunc("second", F.max("ts")).cast("string").alias("valore")).select(F.concat(F.lit("ultimo_lotto_follow_"), user).alias("chiave"), "valore")
    closed = e.where("user_id % 7 = 0").select(F.concat(F.lit("circuito_aperto_fino_"), user).alias("chiave"), F.lit("2100-01-01 00:00:00").alias("valore")).distinct()
    log = e.where("event_type = 'purchase'").select(user.alias("piattaforma"), F.col("ts").alias("data_follow"), F.lit("seguito").alias("esito"))
    return lifecycle.follow_preconditions(last.unionByName(closed), log, e.select(user.alias("piattaforma")).distinct(), F.lit(now).cast("timestamp"))


@query("""$ SELECT event_id AS id, titolo, comune, row_number() OVER (ORDER BY coalesce(comune, '') DESC, event_id) AS posto FROM events WHERE archiviato = 'no'""")
def rows_sorted(spark, d):
    """Rows by a column, the last first, with their place."""
    return views.placed_by(events(spark, d).where("archiviato = 'no'").select(F.col("event_id").alias("id"), "titolo", "comune"), "comune", down=True).select("id", "titolo", "comune", "posto")


@query("""$ SELECT count(*) FILTER (tipologia = 'sagra' AND data_inizio >= '1998-06-15') AS mostrati, count(*) AS totale, count(*) FILTER (tipologia = 'sagra' AND data_inizio >= '1998-06-15') || ' su ' || count(*) || ' annunci' AS testo FROM events""")
def shown_count(spark, d):
    return views.shown_of(events(spark, d), (F.col("tipologia") == "sagra") & (F.col("data_inizio") >= AS_OF))


@query("""$ SELECT event_id, CASE WHEN data_fine <> data_inizio THEN 'dal ' || strftime(CAST(data_inizio AS DATE), '%d/%m/%Y') || ' al ' || strftime(CAST(data_fine AS DATE), '%d/%m/%Y') ELSE strftime(CAST(data_inizio AS DATE), '%d/%m/%Y') END AS periodo FROM events""")
def period_text(spark, d):
    return events(spark, d).select("event_id", views.period(F.col("data_inizio"), F.col("data_fine")).alias("periodo"))


@query("""$ , l AS (SELECT piattaforma AS fonte, CASE categoria WHEN 'comune' THEN 'Comune' WHEN 'proloco' THEN 'Pro Loco' ELSE 'Teatro' END AS tipo, comune, url FROM queue)
SELECT * FROM l WHERE fonte = 'facebook' AND tipo = 'Teatro' AND (contains(lower(comune), 'nation_1') OR contains(lower(url), 'nation_1'))""")
def sources_filtered(spark, d):
    """Followed pages by channel, kind and words."""
    q = follow_queue(spark, d).select(F.col("piattaforma").alias("fonte"), T.category_label(F.col("categoria")).alias("tipo"), "comune", "url")
    return views.sources_matching(q, " NATION_1", "facebook", "Teatro")


@query("""$ SELECT istat, comune FROM comuni WHERE contains(lower(comune), '_1') AND provincia = 'B'""")
def perimeter_filtered(spark, d):
    return views.perimeter_matching(comuni(spark, d), "_1 ", "B").select("istat", "comune")


@query("""$ , n AS (SELECT source_id, piattaforma, max(url || '/nuova') AS url, max(comune) AS comune FROM queue WHERE seq % 2 = 0 GROUP BY 1, 2)
SELECT q.source_id, q.piattaforma, coalesce(n.url, q.url) AS url, CASE WHEN n.source_id IS NULL THEN q.comune ELSE 'X' || n.comune END AS comune, q.stato, q.tentativi FROM queue q LEFT JOIN n ON n.source_id = q.source_id AND n.piattaforma = q.piattaforma
UNION ALL SELECT 'nuova-' || source_id, piattaforma, url || '/nuova', 'X' || comune, 'da_seguire', NULL FROM queue WHERE seq % 10 = 0""")
def queue_reimported(spark, d):
    """Lists imported again: addresses change, what was done to a candidate stays."""
    q = follow_queue(spark, d)
    again = q.where("seq % 2 = 0").select("source_id", "piattaforma", "handle", F.concat("url", F.lit("/nuova")).alias("url"), "soggetto", F.concat(F.lit("X"), "comune").alias("comune"), F.lit("A").alias("fascia"), "categoria", F.lit("da_seguire").alias("stato"), "seq")
    new = again.where("seq % 10 = 0").withColumn("source_id", F.concat(F.lit("nuova-"), "source_id"))
    return lifecycle.upsert_queue(publish.migrate(q, schemas.QUEUE), again.unionByName(new).drop("seq")).select("source_id", "piattaforma", "url", "comune", "stato", "tentativi")
