"""Registered queries over the driver's tables, each an operator of the engine applied to tables staged in its own terms.

``STAGE`` holds the same staging as SQL, so that the oracles start from equal rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairground.functions import dates, filters, scores, urls
from fairground.functions import text as T
from fairground.operators import dedup, lifecycle, links, places, queue, series
from fairground.plans import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
AS_OF, NOW = "1998-06-15", "1998-06-15 12:00:00"


def query(sql: str | None = None):
    """Register a query under its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = STAGE + sql[1:] if sql.startswith("$") else sql
        return f

    return add


def day():
    return F.lit(AS_OF).cast("date")


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# -- staging ---------------------------------------------------------------------------------------------------------

STAGE = """
WITH comuni AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS istat, n_name AS comune, CASE WHEN n_nationkey % 3 = 0 THEN 'town ' || n_nationkey || ';' || lower(n_name) || ' alta' END AS alias,
    substr('ABCDE', n_regionkey + 1, 1) AS provincia, CASE WHEN n_nationkey % 9 <> 5 THEN CAST(40.0 + n_nationkey AS DOUBLE) END AS lat, CAST(7.0 + n_regionkey AS DOUBLE) AS lon,
    CAST(n_nationkey * 3 AS DOUBLE) AS km, CAST(n_nationkey * 2 AS DOUBLE) AS minuti, substr('ABCDE', n_regionkey + 1, 1) AS fascia, CASE WHEN n_nationkey % 8 = 7 THEN 'no' ELSE 'si' END AS attivo FROM nation),
events AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS event_id, 'Sagra ' || o_orderpriority AS titolo, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'd' || (o_orderkey % 11) END AS descrizione,
    CASE WHEN o_orderkey % 2 = 0 THEN 'sagra' ELSE 'fiera' END AS tipologia, strftime(o_orderdate, '%Y-%m-%d') AS data_inizio,
    CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE strftime(o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)), '%Y-%m-%d') END AS data_fine, n_name AS comune,
    CAST(n_nationkey * 3 AS DOUBLE) AS km, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN 'scartato' WHEN o_orderkey % 10 < 4 THEN 'quarantena' WHEN o_orderkey % 10 < 6 THEN 'ok' ELSE 'nuovo' END AS stato,
    CASE WHEN o_orderkey % 7 = 0 THEN 'si' ELSE 'no' END AS archiviato, 'https://ev.example/' || (o_orderkey % 97) AS url, CASE WHEN o_orderkey % 5 = 0 THEN 'vista' END AS note
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
edges AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS event_id, CASE WHEN l_suppkey % 5 = 0 THEN 'comune-' || replace(lower(n_name), ' ', '-') WHEN l_suppkey % 5 = 1 THEN 'feed-instagram-h' || l_suppkey ELSE 'feed-facebook-h' || l_suppkey END AS source_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
sources AS (
  SELECT 'comune-' || replace(lower(n_name), ' ', '-') AS source_id, CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE 'T1_html' END AS tier, CASE WHEN n_nationkey % 11 = 3 THEN NULL ELSE 'https://c' || n_nationkey || '.example' END AS endpoint,
    CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE strftime(DATE '1998-06-15' - to_days(CAST(n_nationkey AS INTEGER)), '%Y-%m-%d') || ' 08:00:00' END AS last_run, CAST(n_nationkey % 4 AS INTEGER) AS consecutive_errors,
    CAST(n_nationkey AS BIGINT) AS esiti_utili, 'comune' AS categoria, CASE WHEN n_nationkey % 10 = 9 THEN 'esclusa' ELSE 'attiva' END AS stato FROM nation
  UNION ALL
  SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'proloco-' || replace(lower(n_name), ' ', '-') || '-' || s_suppkey || '-sito' ELSE 'teatro-' || s_suppkey END, CASE WHEN s_suppkey % 3 = 0 THEN 'T0_rss' ELSE 'T1_html' END, 'https://s' || s_suppkey || '.example',
    strftime(DATE '1998-06-14' - to_days(CAST(s_suppkey % 50 AS INTEGER)), '%Y-%m-%d') || ' 09:30:00', CAST(CASE WHEN s_suppkey % 6 = 0 THEN 2 ELSE 0 END AS INTEGER), CAST(s_suppkey AS BIGINT), CASE WHEN s_suppkey % 2 = 0 THEN 'proloco' ELSE 'teatro' END,
    CASE WHEN s_suppkey % 17 = 0 THEN 'rotta' ELSE 'attiva' END FROM supplier JOIN nation ON s_nationkey = n_nationkey),
queue0 AS (
  SELECT CASE s_suppkey % 3 WHEN 0 THEN 'comune-' || replace(lower(n_name), ' ', '-') || '-facebook' WHEN 1 THEN 'proloco-' || replace(lower(n_name), ' ', '-') || '-instagram' ELSE 'teatro-' || s_suppkey || '-facebook' END AS source_id,
    CASE WHEN s_suppkey % 3 = 1 THEN 'instagram' ELSE 'facebook' END AS piattaforma, 'h' || s_suppkey AS handle, 'https://p' || s_suppkey || '.example' AS url, s_name AS soggetto, CASE WHEN s_suppkey % 13 = 0 THEN '' ELSE n_name END AS comune,
    CASE s_suppkey % 3 WHEN 0 THEN 'comune' WHEN 1 THEN 'proloco' ELSE 'teatro' END AS categoria, CASE s_suppkey % 5 WHEN 0 THEN 'da_seguire' WHEN 1 THEN 'quarantena' WHEN 2 THEN 'nessuna_fonte_trovata' ELSE 'seguito' END AS stato, CAST(s_suppkey % 3 AS INTEGER) AS tentativi, s_suppkey AS seq
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
queue AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY seq) AS rn FROM queue0) WHERE rn = 1),
counts AS (SELECT source_id, count(*) FILTER (archiviato = 'no' AND data_fine >= '1998-06-15') AS attivi, count(*) AS totale FROM edges JOIN events USING (event_id) GROUP BY 1),
fonti AS (SELECT event_id, string_agg(source_id, ', ' ORDER BY source_id) AS fonti FROM edges GROUP BY 1)
"""


def slugged(c):
    return T.slug(F.col(c))


def comuni(spark, d):
    k, letter = F.col("n_nationkey"), F.substring(F.lit("ABCDE"), F.col("n_regionkey") + 1, F.lit(1))
    return t(spark, d, "nation").select(
        k.cast("string").alias("istat"), F.col("n_name").alias("comune"), F.when(k % 3 == 0, F.concat(F.lit("town "), k.cast("string"), F.lit(";"), F.lower("n_name"), F.lit(" alta"))).alias("alias"), letter.alias("provincia"),
        F.when(k % 9 != 5, k + 40.0).alias("lat"), (F.col("n_regionkey") + 7.0).alias("lon"), (k * 3).cast("double").alias("km"), (k * 2).cast("double").alias("minuti"), letter.alias("fascia"), F.when(k % 8 == 7, "no").otherwise("si").alias("attivo"),
    )


def events(spark, d):
    k = F.col("o_orderkey")
    rows = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    begins = F.to_date("o_orderdate")
    return rows.select(
        k.cast("string").alias("event_id"), F.concat(F.lit("Sagra "), "o_orderpriority").alias("titolo"), F.when(k % 4 == 0, None).otherwise(F.concat(F.lit("d"), (k % 11).cast("string"))).alias("descrizione"), F.when(k % 2 == 0, "sagra").otherwise("fiera").alias("tipologia"),
        begins.cast("string").alias("data_inizio"), F.when(k % 6 == 0, None).otherwise(F.date_add(begins, (k % 5).cast("int")).cast("string")).alias("data_fine"), F.col("n_name").alias("comune"), (F.col("n_nationkey") * 3).cast("double").alias("km"),
        F.when(k % 10 == 0, None).when(k % 10 == 1, "scartato").when(k % 10 < 4, "quarantena").when(k % 10 < 6, "ok").otherwise("nuovo").alias("stato"), F.when(k % 7 == 0, "si").otherwise("no").alias("archiviato"),
        F.concat(F.lit("https://ev.example/"), (k % 97).cast("string")).alias("url"), F.when(k % 5 == 0, "vista").alias("note"),
    )


def full_events(spark, d):
    """The staged events with every column of the stored table."""
    from fairground import schemas
    from fairground.plans.publish import migrate

    return migrate(events(spark, d), schemas.EVENTS)


def edges(spark, d):
    k = F.col("l_suppkey")
    rows = t(spark, d, "lineitem").join(t(spark, d, "supplier"), k == F.col("s_suppkey")).join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    own = F.when(k % 5 == 0, F.concat(F.lit("comune-"), slugged("n_name"))).when(k % 5 == 1, F.concat(F.lit("feed-instagram-h"), k.cast("string"))).otherwise(F.concat(F.lit("feed-facebook-h"), k.cast("string")))
    return rows.select(F.col("l_orderkey").cast("string").alias("event_id"), own.alias("source_id")).distinct()


def sources(spark, d):
    n, k = F.col("n_nationkey"), F.col("s_suppkey")
    ago = lambda day, days, hour: F.concat(F.date_sub(F.lit(day).cast("date"), days.cast("int")).cast("string"), F.lit(hour))
    a = t(spark, d, "nation").select(
        F.concat(F.lit("comune-"), slugged("n_name")).alias("source_id"), F.when(n % 6 == 0, None).otherwise("T1_html").alias("tier"), F.when(n % 11 == 3, None).otherwise(F.concat(F.lit("https://c"), n.cast("string"), F.lit(".example"))).alias("endpoint"),
        F.when(n % 5 == 0, None).otherwise(ago(AS_OF, n, " 08:00:00")).alias("last_run"), (n % 4).cast("int").alias("consecutive_errors"), n.cast("long").alias("esiti_utili"), F.lit("comune").alias("categoria"), F.when(n % 10 == 9, "esclusa").otherwise("attiva").alias("stato"),
    )
    b = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == n).select(
        F.when(k % 2 == 0, F.concat(F.lit("proloco-"), slugged("n_name"), F.lit("-"), k.cast("string"), F.lit("-sito"))).otherwise(F.concat(F.lit("teatro-"), k.cast("string"))).alias("source_id"), F.when(k % 3 == 0, "T0_rss").otherwise("T1_html").alias("tier"), F.concat(F.lit("https://s"), k.cast("string"), F.lit(".example")).alias("endpoint"),
        ago("1998-06-14", k % 50, " 09:30:00").alias("last_run"), F.when(k % 6 == 0, 2).otherwise(0).cast("int").alias("consecutive_errors"), k.cast("long").alias("esiti_utili"), F.when(k % 2 == 0, "proloco").otherwise("teatro").alias("categoria"), F.when(k % 17 == 0, "rotta").otherwise("attiva").alias("stato"),
    )
    return a.unionByName(b)


def follow_queue(spark, d):
    k = F.col("s_suppkey")
    own = F.when(k % 3 == 0, F.concat(F.lit("comune-"), slugged("n_name"), F.lit("-facebook"))).when(k % 3 == 1, F.concat(F.lit("proloco-"), slugged("n_name"), F.lit("-instagram"))).otherwise(F.concat(F.lit("teatro-"), k.cast("string"), F.lit("-facebook")))
    rows = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        own.alias("source_id"), F.when(k % 3 == 1, "instagram").otherwise("facebook").alias("piattaforma"), F.concat(F.lit("h"), k.cast("string")).alias("handle"), F.concat(F.lit("https://p"), k.cast("string"), F.lit(".example")).alias("url"), F.col("s_name").alias("soggetto"), F.when(k % 13 == 0, "").otherwise(F.col("n_name")).alias("comune"),
        F.when(k % 3 == 0, "comune").when(k % 3 == 1, "proloco").otherwise("teatro").alias("categoria"), F.when(k % 5 == 0, "da_seguire").when(k % 5 == 1, "quarantena").when(k % 5 == 2, "nessuna_fonte_trovata").otherwise("seguito").alias("stato"), (k % 3).cast("int").alias("tentativi"), k.alias("seq"),
    )
    return dedup.first_per(rows, ["source_id"], ["seq"])


def app_state(spark):
    return spark.createDataFrame([("ultimo_giro_feed_facebook", "1998-06-14 10:00:00"), ("ultimo_giro_feed_instagram", "1998-06-13 10:00:00")], "chiave string, valore string")


# -- views -----------------------------------------------------------------------------------------------------------


@query("""$ SELECT e.event_id AS id, titolo, data_inizio, e.comune, e.km, stato, c.fascia, coalesce(fonti, '') AS fonti FROM events e
LEFT JOIN (SELECT comune, fascia FROM comuni WHERE attivo = 'si') c ON c.comune = e.comune LEFT JOIN fonti f ON f.event_id = e.event_id WHERE archiviato = 'no' AND stato <> 'scartato'""")
def active_events_view(spark, d):
    rows = views.active_events(full_events(spark, d), comuni(spark, d), edges(spark, d))
    return rows.select("id", "titolo", "data_inizio", "comune", "km", "stato", "fascia", "fonti")


@query("""$ SELECT e.event_id AS id, data_inizio, comune, coalesce(fonti, '') AS fonti FROM events e LEFT JOIN fonti f ON f.event_id = e.event_id WHERE archiviato = 'no' AND stato = 'quarantena'""")
def quarantine_view(spark, d):
    return views.quarantine(views.active_events(full_events(spark, d), comuni(spark, d), edges(spark, d))).select("id", "data_inizio", "comune", "fonti")


@query("""$ SELECT e.event_id AS id, titolo, data_fine, stato, note, coalesce(fonti, '') AS fonti FROM events e LEFT JOIN fonti f ON f.event_id = e.event_id WHERE archiviato = 'si'""")
def archive_view(spark, d):
    return views.archive(full_events(spark, d), edges(spark, d)).select("id", "titolo", "data_fine", "stato", "note", "fonti")


_MAP = """map_rows AS (SELECT e.event_id AS id, titolo, e.comune, c.lat, c.lon, c.km, data_inizio, coalesce(data_fine, data_inizio) AS data_fine, tipologia, coalesce(fonti, '') AS fonti, coalesce(stato, '') = 'quarantena' AS quarantena
FROM events e JOIN comuni c ON c.comune = e.comune AND attivo = 'si' AND lat IS NOT NULL LEFT JOIN fonti f ON f.event_id = e.event_id WHERE archiviato = 'no' AND stato <> 'scartato')"""


@query(f"$ , {_MAP} SELECT * FROM map_rows")
def map_events_view(spark, d):
    rows = views.map_events(full_events(spark, d), comuni(spark, d), edges(spark, d))
    return rows.select("id", "titolo", "comune", "lat", "lon", "km", "data_inizio", "data_fine", "tipologia", "fonti", "quarantena")


@query(f"$ , {_MAP} SELECT comune, lat, lon, count(*) AS n, string_agg(titolo, '|' ORDER BY titolo) AS titoli FROM map_rows WHERE data_inizio <= '1998-06-15' AND data_fine >= '1998-06-15' GROUP BY 1, 2, 3")
def map_markers(spark, d):
    rows = views.markers(views.map_events(full_events(spark, d), comuni(spark, d), edges(spark, d)), day())
    return rows.withColumn("titoli", F.array_join("titoli", "|"))


@query("""$ SELECT event_id AS id, data_inizio, data_fine FROM events WHERE data_inizio <= '1998-06-15' AND coalesce(data_fine, data_inizio) >= '1998-06-15' AND tipologia = 'fiera'""")
def interval_on_date(spark, d):
    return views.on_date(events(spark, d), day(), tipologia="fiera").select(F.col("event_id").alias("id"), "data_inizio", "data_fine")


@query("SELECT DISTINCT p_brand AS valore FROM part WHERE coalesce(p_brand, '') <> ''")
def facets(spark, d):
    return views.facets(t(spark, d, "part"), "p_brand")


@query("""$ SELECT * FROM counts""")
def source_counts(spark, d):
    return views.event_counts(edges(spark, d), events(spark, d), day())


@query("""$ , twins AS (SELECT regexp_replace(source_id, '-(facebook|instagram)$', '') AS source_id, max(comune) AS twin FROM queue WHERE comune <> '' GROUP BY 1),
placed AS (SELECT s.*, (SELECT c.comune FROM comuni c WHERE s.base = replace(lower(c.comune), ' ', '-') OR starts_with(s.base, replace(lower(c.comune), ' ', '-') || '-') ORDER BY s.base = replace(lower(c.comune), ' ', '-') DESC, length(c.comune) DESC LIMIT 1) AS place
  FROM (SELECT *, CASE WHEN categoria = 'comune' THEN substr(source_id, 8) WHEN categoria = 'proloco' THEN regexp_replace(substr(source_id, 9), '-sito$', '') END AS base FROM sources) s WHERE coalesce(endpoint, '') <> '' AND stato <> 'esclusa'),
rows AS (SELECT 'web' AS fonte, CASE categoria WHEN 'comune' THEN 'Comune' WHEN 'proloco' THEN 'Pro Loco' ELSE 'Teatro' END AS tipo, coalesce(CASE WHEN categoria IN ('comune', 'proloco') THEN place ELSE twin END, '') AS comune, endpoint AS url, coalesce(attivi, 0) AS attivi, coalesce(totale, 0) AS totale
  FROM placed p LEFT JOIN twins USING (source_id) LEFT JOIN counts USING (source_id)
  UNION ALL SELECT piattaforma, CASE categoria WHEN 'comune' THEN 'Comune' WHEN 'proloco' THEN 'Pro Loco' ELSE 'Teatro' END, comune, url, coalesce(attivi, 0), coalesce(totale, 0) FROM queue q LEFT JOIN counts c ON c.source_id = 'feed-' || piattaforma || '-' || handle WHERE stato = 'seguito')
SELECT *, CAST(row_number() OVER (ORDER BY coalesce(nullif(comune, ''), chr(65535)), tipo, fonte, url) AS INTEGER) AS numero FROM rows""".replace("-(facebook|instagram)$", "-(facebook|instagram)\\z").replace("-sito$", "-sito\\z"))
def sources_union(spark, d):
    return views.all_sources(sources(spark, d), follow_queue(spark, d), comuni(spark, d), edges(spark, d), events(spark, d), day())


@query("""$ , sy AS (SELECT source_id, CASE WHEN stato = 'seguito' THEN '✓' WHEN stato IN ('da_seguire', 'candidato_da_feed') THEN '○' WHEN stato IN ('fallito', 'non_valido', 'quarantena') THEN 'X' ELSE '' END AS y FROM queue),
absent AS (SELECT DISTINCT comune FROM queue WHERE stato = 'nessuna_fonte_trovata')
SELECT fascia, c.comune, coalesce((SELECT CASE WHEN coalesce(endpoint, '') = '' THEN '' WHEN coalesce(consecutive_errors, 0) > 0 THEN 'X' ELSE '✓' END FROM sources s WHERE s.source_id = 'comune-' || replace(lower(c.comune), ' ', '-')), '') AS sito_istituzionale,
  coalesce((SELECT y FROM sy WHERE source_id = 'comune-' || replace(lower(c.comune), ' ', '-') || '-facebook'), '') AS fb_comune,
  coalesce(nullif((SELECT y FROM sy WHERE source_id = 'proloco-' || replace(lower(c.comune), ' ', '-') || '-facebook'), ''), CASE WHEN a.comune IS NOT NULL THEN '—' END, '') AS fb_proloco,
  coalesce(nullif((SELECT y FROM sy WHERE source_id = 'proloco-' || replace(lower(c.comune), ' ', '-') || '-instagram'), ''), CASE WHEN a.comune IS NOT NULL THEN '—' END, '') AS ig_proloco
FROM comuni c LEFT JOIN absent a ON a.comune = c.comune WHERE attivo = 'si'""")
def coverage_matrix(spark, d):
    return views.coverage(comuni(spark, d), sources(spark, d), follow_queue(spark, d))


@query("""$ , entries AS (SELECT regexp_replace(source_id, '-(sito|facebook|instagram)\\z', '') AS nome, categoria AS tipologia, 0 AS at_, source_id FROM sources WHERE NOT starts_with(source_id, 'comune-') AND NOT starts_with(source_id, 'feed-')
  UNION ALL SELECT regexp_replace(source_id, '-(sito|facebook|instagram)\\z', ''), categoria, 1, source_id FROM queue WHERE NOT starts_with(source_id, 'comune-') AND stato <> 'nessuna_fonte_trovata'),
names AS (SELECT nome, arg_min(tipologia, at_ || source_id) AS tipologia FROM entries WHERE nome NOT IN (SELECT 'proloco-' || replace(lower(comune), ' ', '-') FROM comuni WHERE attivo = 'si') GROUP BY 1),
sy AS (SELECT regexp_replace(source_id, '-(sito|facebook|instagram)\\z', '') AS nome, piattaforma, CASE WHEN stato = 'seguito' THEN '✓' WHEN stato = 'da_seguire' THEN '○' WHEN stato = 'quarantena' THEN 'X' ELSE '' END AS y FROM queue)
SELECT tipologia, n.nome, coalesce((SELECT max(CASE WHEN consecutive_errors > 0 THEN 'X' ELSE '✓' END) FROM sources s WHERE regexp_replace(s.source_id, '-sito\\z', '') = n.nome), '') AS sito,
  coalesce((SELECT max(y) FROM sy WHERE sy.nome = n.nome AND piattaforma = 'facebook'), '') AS facebook, coalesce((SELECT max(y) FROM sy WHERE sy.nome = n.nome AND piattaforma = 'instagram'), '') AS instagram FROM names n""")
def entity_first_wins(spark, d):
    return views.other_entities(comuni(spark, d), sources(spark, d), follow_queue(spark, d))


@query("""$ , pages AS (SELECT q.*, coalesce(attivi, 0) AS a, coalesce(totale, 0) AS n, CASE WHEN stato = 'seguito' THEN CASE piattaforma WHEN 'facebook' THEN '1998-06-14 10:00:00' ELSE '1998-06-13 10:00:00' END ELSE 'non_seguita' END AS u FROM queue q LEFT JOIN counts c ON c.source_id = 'feed-' || piattaforma || '-' || handle WHERE comune <> ''),
first AS (SELECT comune, categoria, piattaforma, arg_min(url, source_id) AS url, arg_min(a, source_id) AS a, arg_min(n, source_id) AS n, arg_min(u, source_id) AS u FROM pages GROUP BY ALL)
SELECT c.istat, c.comune, c.km, coalesce(s.endpoint, '') AS sito, coalesce(k.attivi, 0) AS sito_attivi, coalesce(k.totale, 0) AS sito_totale, CASE WHEN coalesce(s.endpoint, '') <> '' THEN s.last_run END AS sito_aggiornato,
  coalesce(f.url, '') AS fb, coalesce(f.a, 0) AS fb_attivi, coalesce(f.n, 0) AS fb_totale, f.u AS fb_aggiornato, coalesce(i.url, '') AS ig, i.u AS ig_aggiornato,
  (SELECT count(DISTINCT soggetto) FROM pages p WHERE p.comune = c.comune AND categoria NOT IN ('comune', 'proloco')) AS altri, (SELECT coalesce(sum(n), 0)::BIGINT FROM pages p WHERE p.comune = c.comune AND categoria NOT IN ('comune', 'proloco')) AS altri_totale
FROM comuni c LEFT JOIN sources s ON s.source_id = 'comune-' || replace(lower(c.comune), ' ', '-') LEFT JOIN counts k ON k.source_id = s.source_id
LEFT JOIN first f ON f.comune = c.comune AND f.categoria = 'comune' AND f.piattaforma = 'facebook' LEFT JOIN first i ON i.comune = c.comune AND i.categoria = 'proloco' AND i.piattaforma = 'instagram' WHERE attivo = 'si'""")
def perimeter_view(spark, d):
    rows = views.perimeter(comuni(spark, d), sources(spark, d), follow_queue(spark, d), edges(spark, d), events(spark, d), app_state(spark), day())
    return rows.select("istat", "comune", "km", F.col("sito_comune.url").alias("sito"), F.col("sito_comune.attivi").alias("sito_attivi"), F.col("sito_comune.totale").alias("sito_totale"), F.col("sito_comune.ultimo_aggiornamento").alias("sito_aggiornato"), F.col("facebook_comune.url").alias("fb"), F.col("facebook_comune.attivi").alias("fb_attivi"), F.col("facebook_comune.totale").alias("fb_totale"), F.col("facebook_comune.ultimo_aggiornamento").alias("fb_aggiornato"), F.col("instagram_proloco.url").alias("ig"), F.col("instagram_proloco.ultimo_aggiornamento").alias("ig_aggiornato"), F.size("altro").cast("long").alias("altri"), F.aggregate("altro", F.lit(0).cast("long"), lambda acc, x: acc + x["totale"]).alias("altri_totale"))


@query("""$ , s AS (SELECT count(*) AS t, count(*) FILTER (consecutive_errors > 0) AS e, max(last_run) AS r FROM sources WHERE tier IS NOT NULL), b AS (SELECT count(*) AS b FROM sources WHERE stato = 'rotta'),
u AS (SELECT count(*) AS u FROM events_raw WHERE CAST(ts AS DATE) = DATE '2024-01-10'), q AS (SELECT count(*) AS n FROM events WHERE stato = 'quarantena' AND archiviato = 'no'),
w AS (SELECT count(*) FILTER (stato = 'da_seguire') AS x, count(*) FILTER (stato = 'candidato_da_feed') AS y, count(*) FILTER (stato = 'quarantena') AS z FROM queue)
SELECT 'Fonti in errore/rotte' AS nome, e || ' in errore, ' || b || ' rotte (su ' || t || ')' AS valore, CASE WHEN b > 0 OR e / t > 0.2 THEN 'rosso' WHEN e > 0 THEN 'giallo' ELSE 'verde' END AS semaforo FROM s, b
UNION ALL SELECT 'Quota LLM residua', u || '/400 (' || CAST(round(u / 400 * 100) AS INTEGER) || '%)', CASE WHEN u / 400 >= 0.85 THEN 'rosso' WHEN u / 400 >= 0.7 THEN 'giallo' ELSE 'verde' END FROM u
UNION ALL SELECT 'Ultimo run completato', r, CASE WHEN date_diff('minute', CAST(r AS TIMESTAMP), TIMESTAMP '1998-06-15 12:00:00') / 60 > 48 THEN 'rosso' WHEN date_diff('minute', CAST(r AS TIMESTAMP), TIMESTAMP '1998-06-15 12:00:00') / 60 > 36 THEN 'giallo' ELSE 'verde' END FROM s
UNION ALL SELECT 'Annunci in quarantena da rivedere', CAST(n AS VARCHAR), CASE WHEN n >= 30 THEN 'rosso' WHEN n >= 10 THEN 'giallo' ELSE 'verde' END FROM q
UNION ALL SELECT 'Coda follow in attesa', (x + y + z) || ' da lavorare (' || x || ' da seguire, ' || y || ' candidati da feed, ' || z || ' da verificare)', CASE WHEN x + y + z >= 200 THEN 'rosso' WHEN x + y + z >= 50 THEN 'giallo' ELSE 'verde' END FROM w""")
def health_indicators(spark, d):
    used = t(spark, d, "events").select(F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("created_at"))
    rows = views.indicators(sources(spark, d), used.where("created_at like '2024-01-10%'").select(F.regexp_replace("created_at", "^2024-01-10", AS_OF).alias("created_at")), events(spark, d), follow_queue(spark, d), 400, day(), F.lit(NOW).cast("timestamp"))
    return rows.select("nome", "valore", "semaforo")


ORACLE_SQL["health_indicators"] = ORACLE_SQL["health_indicators"].replace("WITH comuni", "WITH events_raw AS (SELECT * FROM main.events), comuni")


@query("""$ SELECT source_id, c.fascia, CAST(CASE coalesce(c.fascia, '') WHEN 'A' THEN 100 WHEN 'B' THEN 75 WHEN 'C' THEN 50 WHEN 'D' THEN 25 ELSE 0 END + 3 * coalesce(date_diff('day', CAST(CAST(last_run AS TIMESTAMP) AS DATE), DATE '1998-06-15'), 365) - 5 * consecutive_errors AS DOUBLE) AS priorita
FROM sources s LEFT JOIN comuni c ON s.source_id = 'comune-' || replace(lower(c.comune), ' ', '-') AND attivo = 'si' WHERE tier IS NOT NULL""")
def source_priority(spark, d):
    return queue.by_priority(sources(spark, d), comuni(spark, d), day()).select("source_id", "fascia", F.col("priorita").cast("double").alias("priorita"))


# -- lookup and matching ---------------------------------------------------------------------------------------------

_PLACE_TEXT = "CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN ' ' || upper(n_name) || ' ' WHEN c_custkey % 4 = 2 THEN lower(n_name) || ' Alta' ELSE 'nowhere' END"


@query(f"""$ , keys AS (SELECT lower(trim(comune)) AS k, 0 AS level, istat, comune FROM comuni WHERE attivo = 'si' UNION ALL SELECT lower(trim(a)), 1, istat, comune FROM (SELECT unnest(string_split(alias, ';')) AS a, istat, comune FROM comuni WHERE attivo = 'si' AND alias IS NOT NULL) WHERE trim(a) <> ''),
one AS (SELECT k, arg_min(comune, level || istat) AS comune FROM keys GROUP BY 1),
x AS (SELECT c_custkey, {_PLACE_TEXT} AS txt, n2.name2 AS src, CASE WHEN c_custkey % 3 = 0 THEN 'comune' WHEN c_custkey % 3 = 1 THEN 'aggregatore' END AS cat FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN (SELECT n_nationkey AS k2, n_name AS name2 FROM nation) n2 ON k2 = (c_nationkey + 1) % 25)
SELECT c_custkey, coalesce(a.comune, b.comune) AS comune, CAST(CASE WHEN a.comune IS NOT NULL THEN 0 WHEN b.comune IS NOT NULL THEN CASE WHEN coalesce(cat, '') IN ('comune', 'proloco') THEN -3 ELSE -10 END END AS INTEGER) AS penalty
FROM x LEFT JOIN one a ON a.k = lower(trim(txt)) LEFT JOIN one b ON b.k = lower(trim(src))""")
def resolve_cascade(spark, d):
    k, n = F.col("c_custkey"), t(spark, d, "nation")
    rows = t(spark, d, "customer").join(n.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")).join(n.select(F.col("n_nationkey").alias("k2"), F.col("n_name").alias("src")), F.col("k2") == (F.col("c_nationkey") + 1) % 25)
    said = F.when(k % 4 == 0, None).when(k % 4 == 1, F.concat(F.lit(" "), F.upper("n_name"), F.lit(" "))).when(k % 4 == 2, F.concat(F.lower("n_name"), F.lit(" Alta"))).otherwise("nowhere")
    category = F.when(k % 3 == 0, "comune").when(k % 3 == 1, "aggregatore")
    return places.resolve_places(rows.select("c_custkey", said.alias("txt"), "src", category.alias("cat")), places.place_keys(comuni(spark, d)), F.col("txt"), F.col("src"), F.col("cat")).select("c_custkey", "comune", "penalty")


@query("""$ SELECT s_suppkey, (SELECT c.comune FROM comuni c WHERE x.k = replace(lower(c.comune), ' ', '-') OR starts_with(x.k, replace(lower(c.comune), ' ', '-') || '-') ORDER BY x.k = replace(lower(c.comune), ' ', '-') DESC, length(c.comune) DESC LIMIT 1) AS comune
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'x' || s_suppkey WHEN s_suppkey % 4 = 1 THEN replace(lower(n_name), ' ', '-') ELSE replace(lower(n_name), ' ', '-') || '-' || s_suppkey END AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey) x""")
def longest_prefix_match(spark, d):
    k = F.col("s_suppkey")
    rows = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    slug = F.when(k % 4 == 0, F.concat(F.lit("x"), k.cast("string"))).when(k % 4 == 1, slugged("n_name")).otherwise(F.concat(slugged("n_name"), F.lit("-"), k.cast("string")))
    return places.place_of_slug(rows.select("s_suppkey", slug.alias("k")), "k", comuni(spark, d)).select("s_suppkey", "comune")


#: The first line of each document as a title. The sharp s is spelled out: SQL has no accent folding that agrees on word bounds.
_LINES = "lines AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, replace(string_split(coalesce(text, ''), chr(10))[1], 'ß', 'ss') AS line, substr(coalesce(text, ''), length(string_split(coalesce(text, ''), chr(10))[1]) + 2) AS rest FROM documents)"
_GENERIC = "['" + "','".join(T.GENERIC_WORDS) + "']"
_STOP = "['" + "','".join(T.STOPWORDS) + "']"
_KEY = rf"""list_aggregate(list_sort(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(strip_accents(lower(line)), '(?i)\b\d+[ªº°]|\bX{{0,3}}(IX|IV|V?I{{0,3}})\b', '', 'g'), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+'), lambda x: x <> '' AND NOT list_contains({_STOP}, x))), 'string_agg', ' ')"""


def first_lines(spark, d):
    line = F.replace(F.split(F.coalesce("text", F.lit("")), "\n")[0], F.lit("ß"), F.lit("ss"))
    return t(spark, d, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), line.alias("line"), F.substr(F.coalesce("text", F.lit("")), F.length(F.split(F.coalesce("text", F.lit("")), "\n")[0]) + 2).alias("rest"))


@query(f"WITH {_LINES} SELECT doc_id, coalesce({_KEY}, '') AS key FROM lines")
def title_key(spark, d):
    return first_lines(spark, d).select("doc_id", T.title_key(F.col("line")).alias("key"))


@query(r"""WITH a AS (SELECT p_partkey, '  ' || p_name || '!!  ' || p_type || '??' AS raw FROM part), b AS (SELECT p_partkey, regexp_replace(trim(regexp_replace(CASE WHEN p_partkey % 2 = 0 THEN upper(raw) ELSE raw END, '\s+', ' ', 'g')), '[!?.]+([!?.])', '\1', 'g') AS x FROM a)
SELECT p_partkey, CASE WHEN x = upper(x) AND x <> lower(x) THEN array_to_string(list_transform(string_split(lower(x), ' '), lambda w, i: CASE WHEN i > 1 AND list_contains(['di','della','dello','delle','dei','degli','e','a','in','per','del'], w) THEN w ELSE upper(w[1]) || w[2:] END), ' ') ELSE x END AS titolo FROM b""")
def title_display(spark, d):
    raw = F.concat(F.lit("  "), "p_name", F.lit("!!  "), "p_type", F.lit("??"))
    return t(spark, d, "part").select("p_partkey", T.title_display(F.when(F.col("p_partkey") % 2 == 0, F.upper(raw)).otherwise(raw)).alias("titolo"))


@query(f"""WITH {_LINES}, k AS (SELECT doc_id, source, lang, coalesce({_KEY}, '') AS key FROM lines), i AS (SELECT *, substr(sha1(concat_ws('|', substr(replace(key, ' ', '-'), 1, 20), lang, source)), 1, 12) AS event_id FROM k)
SELECT event_id, count(*) AS n, min(doc_id) AS first_doc FROM i GROUP BY 1""")
def dedup_exact(spark, d):
    rows = first_lines(spark, d).select("doc_id", T.title_key(F.col("line")).alias("titolo_normalizzato"), F.col("lang").alias("data_inizio"), F.col("source").alias("comune_normalizzato"))
    return dedup.keyed(rows).groupBy("event_id").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query(f"""WITH {_LINES}, k AS (SELECT doc_id AS id, source, lang, coalesce({_KEY}, '') AS key, lower(trim(rest, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS descr FROM lines),
w AS (SELECT *, list_filter(string_split(key, ' '), lambda x: x <> '') AS ws0, list_filter(regexp_split_to_array(descr, '\\s+'), lambda x: x <> '') AS ds0 FROM k), v AS (SELECT *, list_distinct(ws0) AS ws, list_distinct(ds0) AS ds FROM w),
p AS (SELECT a.id AS a, b.id AS b, a.ws AS x, b.ws AS y, a.descr AS dx, b.descr AS dy, a.ds AS s, b.ds AS t, a.id % 3 = b.id % 3 AS same FROM v a JOIN v b ON a.source = b.source AND a.lang = b.lang AND a.id < b.id),
o AS (SELECT *, least(len(x), len(y)) AS m, len(list_intersect(x, y)) AS c FROM p)
SELECT v.id, coalesce(min(o.a), v.id) AS canonical FROM v LEFT JOIN o ON o.b = v.id AND ((m > 0 AND c / m >= 0.8 AND CASE WHEN m = 1 THEN c = 1 AND NOT list_contains({_GENERIC}, CASE WHEN len(x) = 1 THEN x[1] ELSE y[1] END) ELSE c >= 3 END)
OR (dx <> '' AND dx = dy) OR (m > 0 AND c = m AND same AND ((dx = '' AND dy = '') OR (least(len(s), len(t)) > 0 AND len(list_intersect(s, t)) / least(len(s), len(t)) >= 0.7)))) GROUP BY v.id""")
def dedup_fuzzy(spark, d):
    rows = first_lines(spark, d).select(F.col("doc_id").alias("id"), "source", "lang", T.title_key(F.col("line")).alias("titolo_normalizzato"), F.col("rest").alias("descrizione"), F.array((F.col("doc_id") % 3).cast("string")).alias("fonti"))
    return dedup.canonical(rows, dedup.duplicate_pairs(rows, ["source", "lang"]))


_UB = lambda words: rf"(?i)(^|[^\p{{L}}\p{{N}}_])({words})($|[^\p{{L}}\p{{N}}_])"
_NUM = r"(^|[^\p{L}\p{N}_])\d{1,2}[/\-.]\d{1,2}([/\-.]\d{2,4})?($|[^\p{L}\p{N}_])"
_HASDATE = f"(regexp_matches(x, '{_NUM}') OR regexp_matches(x, '{_UB('|'.join(dates.MONTHS))}') OR regexp_matches(x, '{_UB(filters.WEEKDAY)}') OR regexp_matches(x, '{_UB(filters.RELATIVE.replace(chr(92) + 'w', '[' + chr(92) + 'p{L}' + chr(92) + 'p{N}_]'))}') OR regexp_matches(x, '{_UB('20[0-9]{2}')}'))"


@query(f"""WITH a AS (SELECT doc_id, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x, doc_id % 5 = 0 AS img FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(x, '{_UB(filters.NOT_EVENT)}') THEN 'schema_non_evento' WHEN NOT {_HASDATE} AND NOT regexp_matches(x, '{_UB(filters.EVENT_WORDS)}') AND NOT img THEN 'nessun_segnale_di_evento'
WHEN {_HASDATE} AND len(list_filter(regexp_extract_all(x, '(^|[^\\p{{L}}\\p{{N}}_])(20[0-9]{{2}})', 2), lambda y: CAST(y AS INTEGER) < 1997)) > 0 THEN 'solo_date_passate' WHEN length(x) < 40 AND NOT img THEN 'testo_troppo_corto_senza_immagine' END AS motivo FROM a""")
def text_prefilter_reasons(spark, d):
    return t(spark, d, "documents").select("doc_id", filters.text_reason(F.col("text"), F.col("doc_id") % 5 == 0, day()).alias("motivo"))


@query("""WITH a AS (SELECT d.doc_id, CAST(60 + d.doc_id % 45 AS INTEGER) AS conf, CASE WHEN d.doc_id % 3 = 0 THEN 0 WHEN d.doc_id % 3 = 1 THEN -3 ELSE -10 END AS pen, coalesce(quality, 0) = 1 AS anno, CASE WHEN d.doc_id % 19 = 0 THEN '' ELSE '1998-07-01' END AS ini FROM documents d LEFT JOIN (SELECT DISTINCT doc_id, quality FROM labels) l ON l.doc_id = d.doc_id)
SELECT doc_id, CASE WHEN ini = '' THEN 'scartato' WHEN conf + pen - CASE WHEN anno THEN 0 ELSE 5 END < 70 THEN 'quarantena' ELSE 'pubblicato' END AS esito, CAST(greatest(0, least(100, conf + pen - CASE WHEN anno THEN 0 ELSE 5 END)) AS INTEGER) AS confidenza,
'confidenza LLM: ' || conf || CASE WHEN pen <> 0 THEN '; comune inferito dalla fonte, non dal testo (' || pen || ')' ELSE '' END || CASE WHEN anno THEN '' ELSE '; anno non esplicito nel testo (-5)' END AS dettaglio FROM a""")
def confidence_gate(spark, d):
    k = F.col("doc_id")
    rows = t(spark, d, "documents").select("doc_id").join(t(spark, d, "labels").select("doc_id", "quality").distinct(), "doc_id", "left")
    conf, pen, year = (k % 45 + 60).cast("int"), F.when(k % 3 == 0, 0).when(k % 3 == 1, -3).otherwise(-10), F.coalesce("quality", F.lit(0)) == 1
    score = scores.final_confidence(conf, pen, year)
    return rows.select("doc_id", scores.gate(F.when(k % 19 == 0, "").otherwise("1998-07-01"), F.lit("x"), score).alias("esito"), F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("int").alias("confidenza"), T.confidence_note(conf, pen, year, 5).alias("dettaglio"))


# -- series ----------------------------------------------------------------------------------------------------------

_RULES = """rules AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'mensile' ELSE 'settimanale' END AS freq, CASE c_custkey % 7 WHEN 0 THEN 'MO' WHEN 1 THEN 'TU' WHEN 2 THEN 'WE' WHEN 3 THEN 'TH' WHEN 4 THEN 'FR' WHEN 5 THEN 'SA' ELSE 'SU' END AS day,
  CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 4 ELSE -1 END AS ord, c_custkey % 3 = 0 AS no_august, CASE WHEN c_custkey % 4 = 0 THEN '1998-08-20' END AS fine, DATE '1998-05-01' + to_days(CAST(c_custkey % 90 AS INTEGER)) AS dal FROM customer)"""


def rules(spark, d):
    k = F.col("c_custkey")
    day = F.element_at(F.array(*(F.lit(x) for x in ("MO", "TU", "WE", "TH", "FR", "SA", "SU"))), (k % 7 + 1).cast("int"))
    months = F.sequence(F.lit(1), F.lit(12))
    return t(spark, d, "customer").select("c_custkey", F.when(k % 2 == 0, "mensile").otherwise("settimanale").alias("freq"), F.array(day).alias("days"), F.when(k % 5 == 1, 1).when(k % 5 == 2, 2).when(k % 5 == 3, 4).when(k % 5 == 4, -1).alias("ord"), F.when(k % 3 == 0, F.array_remove(months, 8)).otherwise(months).alias("months"), F.when(k % 4 == 0, "1998-08-20").alias("fine"), F.date_add(F.lit("1998-05-01").cast("date"), (k % 90).cast("int")).alias("dal"))


@query(f"""WITH {_RULES} SELECT c_custkey, 'FREQ=' || CASE freq WHEN 'mensile' THEN 'MONTHLY' ELSE 'WEEKLY' END || ';BYDAY=' || CASE WHEN freq = 'mensile' AND ord IS NOT NULL THEN CAST(ord AS VARCHAR) ELSE '' END || day || CASE WHEN no_august THEN ';BYMONTH=1,2,3,4,5,6,7,9,10,11,12' ELSE '' END || CASE WHEN fine IS NOT NULL THEN ';UNTIL=19980820' ELSE '' END AS rrule,
CASE WHEN freq = 'mensile' AND ord IS NOT NULL THEN CASE ord WHEN 1 THEN 'prima' WHEN 2 THEN 'seconda' WHEN 4 THEN 'quarta' ELSE 'ultima' END || ' ' || g || ' del mese' WHEN freq = 'mensile' THEN 'mensile, ' || g ELSE 'ogni ' || g END || CASE WHEN no_august THEN ', escluso agosto' ELSE '' END AS regola
FROM (SELECT *, CASE day WHEN 'MO' THEN 'lunedì' WHEN 'TU' THEN 'martedì' WHEN 'WE' THEN 'mercoledì' WHEN 'TH' THEN 'giovedì' WHEN 'FR' THEN 'venerdì' WHEN 'SA' THEN 'sabato' ELSE 'domenica' END AS g FROM rules)""")
def series_rules(spark, d):
    return rules(spark, d).select("c_custkey", dates.rrule_text(F.col("freq"), F.col("days"), F.col("ord"), F.col("months"), F.col("fine")).alias("rrule"), dates.rule_words(F.col("freq"), F.col("days"), F.col("ord"), F.col("months")).alias("regola"))


@query(f"""WITH {_RULES}, x AS (SELECT *, CAST(unnest(generate_series(greatest(DATE '1998-06-15', dal), DATE '1998-10-13', INTERVAL 1 DAY)) AS DATE) AS g FROM rules),
y AS (SELECT c_custkey, g FROM x WHERE strftime(g, '%a') = CASE day WHEN 'MO' THEN 'Mon' WHEN 'TU' THEN 'Tue' WHEN 'WE' THEN 'Wed' WHEN 'TH' THEN 'Thu' WHEN 'FR' THEN 'Fri' WHEN 'SA' THEN 'Sat' ELSE 'Sun' END AND (NOT no_august OR month(g) <> 8) AND (fine IS NULL OR g <= CAST(fine AS DATE))
  AND (freq = 'settimanale' OR ord IS NULL OR (ord > 0 AND CAST(ceil(day(g) / 7) AS INTEGER) = ord) OR (ord = -1 AND month(g + INTERVAL 7 DAY) <> month(g)))),
n AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY g) || ' di ' || count(*) OVER (PARTITION BY c_custkey) AS occorrenza FROM y)
SELECT c_custkey, strftime(g, '%Y-%m-%d') AS data_inizio, occorrenza FROM n WHERE NOT (c_custkey % 10 = 0 AND day(g) < 8)""")
def series_expand(spark, d):
    r = rules(spark, d)
    made = dates.occurrences(dates.rrule_text(F.col("freq"), F.col("days"), F.col("ord"), F.col("months"), F.col("fine")), F.col("dal"), F.array().cast("array<string>"), day(), F.lit(120))
    rows = series.numbered(r.select("c_custkey", F.explode(made).alias("data_inizio")), "c_custkey", "data_inizio")
    suppressed = rows.where((F.col("c_custkey") % 10 == 0) & (F.dayofmonth("data_inizio") < 8)).select("c_custkey", "data_inizio")
    return rows.join(suppressed, ["c_custkey", "data_inizio"], "left_anti").select("c_custkey", "data_inizio", "occorrenza")


@query("""WITH a AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS c FROM orders GROUP BY 1) SELECT o_custkey, CASE WHEN date_diff('day', c, DATE '1999-06-15') < 120 THEN 'attiva' WHEN date_diff('day', c, DATE '1999-06-15') <= 400 THEN 'da_verificare' ELSE 'sospesa' END AS stato FROM a""")
def series_decay(spark, d):
    rows = t(spark, d, "orders").groupBy("o_custkey").agg(F.max(F.to_date("o_orderdate")).alias("c"))
    return rows.select("o_custkey", dates.decay_state(F.col("c"), F.lit("1999-06-15").cast("date")).alias("stato"))


# -- changes of state ------------------------------------------------------------------------------------------------


@query("""$ SELECT event_id, CASE WHEN data_fine < '1998-06-15' AND archiviato = 'no' THEN 'si' ELSE archiviato END AS archiviato FROM events""")
def archive_flag(spark, d):
    return lifecycle.archive_ended(events(spark, d), day()).select("event_id", "archiviato")


@query("""$ SELECT event_id, CASE WHEN CAST(event_id AS BIGINT) % 8 = 0 THEN 'ok' ELSE stato END AS stato, CASE WHEN CAST(event_id AS BIGINT) % 8 = 4 THEN 'rivista' ELSE note END AS note FROM events""")
def override_merge(spark, d):
    k = F.col("event_id").cast("long")
    sheet = events(spark, d).where(k % 4 == 0).select("event_id", F.when(k % 8 == 0, " ok ").otherwise(" ").alias("stato"), F.when(k % 8 == 4, "rivista").alias("note"))
    return lifecycle.with_overrides(events(spark, d), sheet, "event_id", ["stato", "note"]).select("event_id", "stato", "note")


_ACTIONS = "actions AS (SELECT event_id, CASE CAST(event_id AS BIGINT) % 12 WHEN 0 THEN 'promuovi' WHEN 1 THEN 'scarta' WHEN 2 THEN 'elimina' WHEN 3 THEN 'ignora_fonte' ELSE 'boh' END AS azione FROM events WHERE stato = 'quarantena')"


def actions(spark, d):
    k = F.col("event_id").cast("long") % 12
    return events(spark, d).where("stato = 'quarantena'").select("event_id", F.when(k == 0, "promuovi").when(k == 1, "scarta").when(k == 2, "elimina").when(k == 3, "ignora_fonte").otherwise("boh").alias("azione"))


@query(f"""$ , {_ACTIONS} SELECT e.event_id, CASE WHEN azione = 'promuovi' THEN 'ok' WHEN azione IN ('scarta', 'ignora_fonte') THEN 'scartato' ELSE stato END AS stato FROM events e LEFT JOIN actions a ON a.event_id = e.event_id WHERE coalesce(azione, '') <> 'elimina'""")
def quarantine_actions(spark, d):
    return lifecycle.apply_actions(events(spark, d), edges(spark, d), sources(spark, d), actions(spark, d))[0].select("event_id", "stato")


@query(f"""$ , {_ACTIONS} SELECT count(*) FILTER (azione = 'promuovi') AS promossi, count(*) FILTER (azione IN ('scarta', 'ignora_fonte')) AS scartati, count(*) FILTER (azione = 'elimina') AS eliminati, (SELECT count(*) FROM edges WHERE event_id IN (SELECT event_id FROM actions WHERE azione = 'ignora_fonte')) AS fonti_escluse FROM actions""")
def action_tally(spark, d):
    return lifecycle.action_tally(actions(spark, d), edges(spark, d))


@query(f"""$ , {_ACTIONS} SELECT source_id, CASE WHEN source_id IN (SELECT source_id FROM edges WHERE event_id IN (SELECT event_id FROM actions WHERE azione = 'ignora_fonte')) THEN 'esclusa' ELSE stato END AS stato FROM sources""")
def excluded_sources(spark, d):
    return lifecycle.apply_actions(events(spark, d), edges(spark, d), sources(spark, d), actions(spark, d))[2].select("source_id", "stato")


@query("""$ , r AS (SELECT e.event_id, source_id, CASE WHEN starts_with(source_id, 'feed-instagram-') THEN 'instagram' WHEN starts_with(source_id, 'feed-facebook-') THEN 'facebook_non_riprocessabile' ELSE 'html' END AS rotta FROM events e JOIN edges d ON d.event_id = e.event_id WHERE stato = 'quarantena')
SELECT rotta, CASE WHEN rotta = 'html' THEN source_id ELSE event_id END AS chiave, count(DISTINCT event_id) AS annunci FROM r GROUP BY 1, 2""")
def quarantine_routes(spark, d):
    return lifecycle.replay_routes(events(spark, d), edges(spark, d))


@query("""WITH l AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 'seguito' WHEN 'signup' THEN 'gia_seguito' WHEN 'error' THEN 'errore' WHEN 'view' THEN 'timeout' END AS esito FROM events WHERE event_type <> 'click'),
s AS (SELECT user_id, bool_or(esito IN ('seguito', 'gia_seguito')) AS fatto, count(*) FILTER (esito IN ('errore', 'timeout')) AS n FROM l GROUP BY 1), q AS (SELECT DISTINCT user_id FROM events)
SELECT q.user_id, CASE WHEN fatto THEN 'seguito' WHEN n >= 3 THEN 'fallito' ELSE 'da_seguire' END AS stato, CAST(coalesce(n, 0) AS INTEGER) AS tentativi FROM q LEFT JOIN s ON s.user_id = q.user_id""")
def follow_queue_state(spark, d):
    e = t(spark, d, "events")
    kind = F.col("event_type")
    log = e.where("event_type <> 'click'").select(F.col("user_id").alias("source_id"), F.lit("x").alias("piattaforma"), F.when(kind == "purchase", "seguito").when(kind == "signup", "gia_seguito").when(kind == "error", "errore").otherwise("timeout").alias("esito"), F.col("ts").cast("string").alias("data_follow"), kind.alias("dettaglio"))
    rows = e.select(F.col("user_id").alias("source_id"), F.lit("x").alias("piattaforma"), F.lit("da_seguire").alias("stato"), F.lit(0).alias("tentativi"), F.lit(None).cast("string").alias("data_follow"), F.lit(None).cast("string").alias("note")).distinct()
    return lifecycle.follow_outcomes(rows, log).select(F.col("source_id").alias("user_id"), "stato", "tentativi")


@query("""WITH u AS (SELECT CAST(ts AS DATE) AS giorno, count(*) AS usate FROM events GROUP BY 1), x AS (SELECT giorno, usate, usate / 400 AS q FROM u), b AS (SELECT unnest(['A', 'B', NULL]) AS fascia), i AS (SELECT unnest([true, false]) AS img)
SELECT strftime(giorno, '%Y-%m-%d') AS giorno, usate, fascia, img, CASE WHEN q >= 1 THEN 'quota_esaurita' WHEN q >= 0.85 AND coalesce(fascia, '') <> 'A' THEN 'quota_85' WHEN q >= 0.7 AND img AND coalesce(fascia, '') <> 'A' THEN 'quota_70_immagine' END AS rinvio FROM x, b, i""")
def quota_degradation(spark, d):
    from fairground.operators.extract import within_quota

    days = t(spark, d, "events").groupBy(F.to_date("ts").alias("g")).agg(F.count("*").alias("usate"))
    rows = days.select(F.col("g").cast("string").alias("giorno"), "usate", F.explode(F.array(F.lit("A"), F.lit("B"), F.lit(None))).alias("fascia")).select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("img"))
    return within_quota(rows, F.col("usate") / 400, "fascia", "img")


@query("""$ , o AS (SELECT o_custkey % 40 AS s, o_orderkey AS seq, CASE WHEN o_orderkey % 3 = 0 THEN 'timeout' || o_orderkey END AS errore, o_orderkey % 4 AS pub FROM orders), m AS (SELECT s, max(seq) FILTER (errore IS NULL) AS ok FROM o GROUP BY 1)
SELECT CAST(o.s AS VARCHAR) AS source_id, CAST(CASE WHEN ok IS NOT NULL THEN 0 ELSE 1 END + count(*) FILTER (errore IS NOT NULL AND (ok IS NULL OR seq > ok)) AS INTEGER) AS consecutive_errors, arg_max(CASE WHEN errore IS NULL THEN '' ELSE errore END, seq) AS ultimo_errore, CAST(10 + coalesce(sum(pub) FILTER (errore IS NULL), 0) AS BIGINT) AS esiti_utili FROM o JOIN m ON m.s = o.s GROUP BY o.s, ok""")
def source_outcomes(spark, d):
    k = F.col("o_orderkey")
    rows = t(spark, d, "orders").select((F.col("o_custkey") % 40).cast("string").alias("source_id"), k.alias("seq"), F.when(k % 3 == 0, F.concat(F.lit("timeout"), k.cast("string"))).alias("errore"), (k % 4).alias("pubblicati"), (k % 4).alias("totali"), F.col("o_orderdate").cast("string").alias("fine"))
    stored = rows.select("source_id").distinct().select("source_id", F.lit(1).alias("consecutive_errors"), F.lit(None).cast("string").alias("ultimo_errore"), F.lit(None).cast("string").alias("last_run"), F.lit(10).cast("long").alias("esiti_totali"), F.lit(10).cast("long").alias("esiti_utili"))
    return lifecycle.apply_outcomes(stored, rows).select("source_id", "consecutive_errors", F.coalesce("ultimo_errore", F.lit("")).alias("ultimo_errore"), "esiti_utili")


@query("""SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def anti_new_vs_old(spark, d):
    old = t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return lifecycle.new_ids(old, t(spark, d, "customer"), ["c_custkey"])


@query("""WITH a AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' AND turn % 3 = 1 THEN 'pubblicato' WHEN role = 'user' AND turn % 4 = 0 THEN 'quarantena' ELSE 'scartato' || turn END AS esito FROM conversations) SELECT conv_id, arg_min(esito, CASE esito WHEN 'pubblicato' THEN 0 WHEN 'quarantena' THEN 1 ELSE 2 END * 1000000 + turn) AS esito FROM a GROUP BY 1""")
def post_outcomes(spark, d):
    rows = t(spark, d, "conversations").select("conv_id", F.col("turn").alias("seq"), F.when((F.col("role") == "assistant") & (F.col("turn") % 3 == 1), "pubblicato").when((F.col("role") == "user") & (F.col("turn") % 4 == 0), "quarantena").otherwise(F.concat(F.lit("scartato"), F.col("turn").cast("string"))).alias("esito"))
    return lifecycle.outcome_of_post(rows, "conv_id")


# -- pages, links, posts ---------------------------------------------------------------------------------------------


@query(r"""SELECT page_id, CASE WHEN contains(html, 'wp-content') THEN 'wordpress' WHEN regexp_matches(html, '(?i)<meta[^>]+name=["'']generator["''][^>]+content=["'']Drupal') THEN 'drupal' WHEN contains(html, 'bootstrap-italia') AND contains(lower(html), 'agid') THEN 'pa_design_system' ELSE 'sconosciuta' END AS piattaforma,
regexp_matches(html, '(?is)<script[^>]+type=["'']application/ld\+json["''][^>]*>.*?</script>') AS ha_jsonld FROM pages""")
def cms_fingerprint(spark, d):
    return links.fingerprints(t(spark, d, "pages")).select("page_id", "piattaforma", "ha_jsonld")


_LINKS = r"""raw AS (SELECT url AS page_url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href=["'']([^"'']*)["'']', 1)) AS href FROM pages),
abs AS (SELECT page_url, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href WHEN starts_with(href, '//') THEN regexp_extract(page_url, '^([a-zA-Z]+:)', 1) || href WHEN starts_with(href, '/') THEN regexp_extract(page_url, '^([a-zA-Z]+://[^/?#]+)', 1) || href ELSE '#' END AS link FROM (SELECT page_url, trim(href) AS href FROM raw)),
parts AS (SELECT page_url, link, regexp_extract(link, '^[a-zA-Z]+://([^/?#]+)', 1) AS host, regexp_extract(link, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(link, '\?([^#]*)', 1) AS query, regexp_extract(link, '#(.*)', 1) AS frag FROM abs),
links AS (SELECT page_url, link, path, query FROM parts WHERE host = regexp_extract(page_url, '^[a-zA-Z]+://([^/?#]+)', 1) AND frag = '' AND path NOT IN ('/', '') AND path <> regexp_extract(page_url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) AND NOT contains(path, '/feed') AND NOT starts_with(path, '/wp-json') AND (query <> '' OR NOT regexp_matches(regexp_extract(path, '([^/]*)/*\z', 1), '^\d{1,4}[-_]\d{1,2}[-_]\d{1,4}\z')))"""


@query(f"WITH {_LINKS} SELECT page_url, link, count(*) AS n FROM links GROUP BY 1, 2")
def page_links(spark, d):
    return links.page_links(t(spark, d, "pages")).groupBy("page_url", "link").agg(F.count("*").alias("n"))


@query()
def detail_links(spark, d):
    return links.detail_links(t(spark, d, "pages"))


@query(r"""SELECT page_id, CASE WHEN regexp_matches(url, '^https?://[^/]+/feed/*\z') THEN true ELSE false END AS feed, regexp_replace(lower(url), '[^a-z]+', '', 'g') AS letters, CASE WHEN regexp_matches(lower(url), '^https?://') THEN url ELSE 'https://' || url END AS further FROM pages""")
def url_canonical(spark, d):
    return t(spark, d, "pages").select("page_id", urls.generic_feed(F.col("url")).alias("feed"), F.regexp_replace(F.lower("url"), "[^a-z]+", "").alias("letters"), urls.further_url(F.col("url")).alias("further"))


@query(r"""WITH a AS (SELECT conv_id, turn, array_to_string(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(Facebook|·|Segui|Altro\.{3}|\d+\s*(min|h|ago|gg)?)\z')), chr(10)) AS testo FROM conversations)
SELECT conv_id, turn, testo, substr(sha1(trim(testo, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), 1, 16) AS post_id FROM a""")
def social_clean(spark, d):
    rows = t(spark, d, "conversations").select("conv_id", "turn", T.clean_post(F.col("text")).alias("testo"))
    return rows.select("conv_id", "turn", "testo", F.coalesce(urls.post_id(F.lit(""), F.col("testo")), F.lit("")).alias("post_id"))


_BITS = "bits AS (SELECT vec_id, list_reduce(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 THEN (1::UBIGINT << (64 - i)::UBIGINT) ELSE 0::UBIGINT END), lambda a, b: a + b) AS h FROM embeddings)"


@query(f"""WITH {_BITS} SELECT a.vec_id AS image, arg_min(b.vec_id, b.vec_id) AS first_near FROM bits a JOIN bits b ON bit_count(xor(a.h, b.h)) <= 8 GROUP BY 1""")
def hamming_near_dups(spark, d):
    sign = F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0")), "")
    half = lambda at: F.lpad(F.lower(F.conv(F.substring(sign, at, 32), 2, 16)), 8, "0")
    hashes = t(spark, d, "embeddings").select(F.col("vec_id"), F.concat(half(1), half(33)).alias("phash"))
    cache = hashes.select("phash", F.lpad(F.col("vec_id").cast("string"), 12, "0").alias("first_seen"))
    found = dedup.similar_images(cache, hashes.withColumnRenamed("vec_id", "image"))
    first = hashes.groupBy("phash").agg(F.min("vec_id").alias("first_near"))
    return found.join(first, "phash").select("image", "first_near")


# -- streams, parsers, extraction --------------------------------------------------------------------------------------


def _stream(spark, d):
    """The events folder as a stream of one file."""
    from fairground.streaming import jobs

    schema = t(spark, d, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return jobs, raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _drain(spark, stream, mode="append", keys=None):
    from fairground.storage import fresh_path
    from fairground.streaming import jobs

    path = fresh_path(spark, "stream")
    return jobs.into_files(stream, f"{path}/rows", f"{path}/state", mode, keys)


@query("SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS giorno, count(*) AS usate, CASE WHEN count(*) / 400 >= 0.85 THEN 'rosso' WHEN count(*) / 400 >= 0.7 THEN 'giallo' ELSE 'verde' END AS semaforo FROM events GROUP BY 1")
def stream_daily_window(spark, d):
    jobs, stream = _stream(spark, d)
    return _drain(spark, jobs.daily_usage(stream, "ts", 400), "complete").select(F.col("giorno").cast("string").alias("giorno"), "usate", "semaforo")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, d):
    jobs, stream = _stream(spark, d)
    return _drain(spark, jobs.deduplicated(stream.select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "60 days")).select("user_id", "event_type")


@query("""WITH a AS (SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM a)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS inizio, count(*) AS n FROM s GROUP BY user_id, k""")
def stream_sessions(spark, d):
    jobs, stream = _stream(spark, d)
    rows = _drain(spark, jobs.sessions(stream, "user_id", "ts", "6 hours"), "complete")
    return rows.select("user_id", F.date_format("inizio", "yyyy-MM-dd HH:mm:ss").alias("inizio"), "n")


@query("""WITH o AS (SELECT user_id, ts, event_id, event_type = 'error' AS bad FROM events), m AS (SELECT user_id, max(ts) FILTER (NOT bad) AS ok FROM o GROUP BY 1) SELECT o.user_id, count(*) FILTER (bad AND (ok IS NULL OR ts > ok)) AS errori FROM o JOIN m ON m.user_id = o.user_id GROUP BY 1""")
def stream_error_counts(spark, d):
    jobs, stream = _stream(spark, d)
    rows = _drain(spark, jobs.error_counts(stream.select("user_id", "ts", (F.col("event_type") == "error").alias("fallita")), "user_id"), "update", ["user_id"])
    return rows.select("user_id", "errori")


@query("""WITH a AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS g, 'Grande fiera ' || o_orderpriority || ' in piazza, ' || day(o_orderdate) || ' ' || ['gennaio','febbraio','marzo','aprile','maggio','giugno','luglio','agosto','settembre','ottobre','novembre','dicembre'][month(o_orderdate)] || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ' ' || year(o_orderdate) END AS testo FROM orders),
b AS (SELECT o_orderkey, testo, CASE WHEN o_orderkey % 3 = 0 THEN '1998' || strftime(g, '-%m-%d') ELSE strftime(g, '%Y-%m-%d') END AS ini, o_orderkey % 3 <> 0 AS anno FROM a WHERE o_orderkey % 3 = 0 OR year(g) >= 1997)
SELECT CAST(o_orderkey AS VARCHAR) AS artifact_id, testo AS titolo, ini AS data_inizio, 'fiera' AS tipologia, CASE WHEN anno THEN 85 ELSE 75 END AS confidenza FROM b WHERE ini BETWEEN '1998-06-14' AND '2000-06-15' AND length(testo) >= 40""")
def llm_extract_rules(spark, d):
    """Announcements that the pre-filter keeps, put to the rule provider and checked."""
    from fairground.operators import extract

    month = F.element_at(F.array(*map(F.lit, dates.MONTHS)), F.month("o_orderdate"))
    said = F.concat(F.lit("Grande fiera "), "o_orderpriority", F.lit(" in piazza, "), F.dayofmonth("o_orderdate").cast("string"), F.lit(" "), month, F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit(" "), F.year("o_orderdate").cast("string"))))
    docs = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("artifact_id"), said.alias("text"))
    kept = docs.where(filters.text_reason(F.col("text"), F.lit(False), day()).isNull())
    asked = kept.select("artifact_id", extract.prompt(day(), F.lit(None), F.lit(None), F.lit(None), F.lit(None), F.col("text")).alias("prompt"), F.array().cast("array<string>").alias("images"))
    return extract.sane(extract.parse(extract.ask(asked, extract.RuleProvider)), day()).select("artifact_id", "titolo", "data_inizio", "tipologia", "confidenza")


@query()
def upsert_fold(spark, d):
    """Sightings from all orders merged into a stored third of the events."""
    from fairground.plans.publish import migrate
    from fairground import schemas

    e = events(spark, d).withColumn("comune_normalizzato", T.title_key(F.col("comune"))).withColumn("titolo_normalizzato", T.title_key(F.col("titolo"), F.col("comune")))
    stored = migrate(dedup.keyed(e.where(F.col("event_id").cast("long") % 3 == 0)).dropDuplicates(["event_id"]).fillna({"stato": "nuovo"}), schemas.EVENTS).withColumns({"bloccato": F.lit("no"), "soppressa": F.lit("no")})
    incoming = e.where(F.col("event_id").cast("long") % 3 != 0).withColumns({"seq": F.col("event_id").cast("long"), "source_id": F.concat(F.lit("s"), (F.col("event_id").cast("long") % 7).cast("string"))}).drop("event_id")
    none = spark.createDataFrame([], schemas.EVENT_SOURCES)
    after, _ = dedup.upsert_events(stored, none, incoming, AS_OF)
    return after.select("event_id", "titolo", "data_inizio", "comune", "primo_visto", "ultimo_visto")
