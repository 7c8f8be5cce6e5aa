"""Registered queries of graded matching, field-wise merging, admission under a quota, mentions of places and neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairground import schemas
from fairground.functions import text as T
from fairground.operators import attention, backlog, geo, groups, matching, mentions, merging, queue
from fairground.plans import publish
from fairground.queries import _BITS, _KEY, _LINES, _RULES, _drain, _stream, comuni, day, edges, events, first_lines, query, rules, sources, t
from fairground.sources import updates
from fairground.storage import fresh_path
from fairground.streaming import timers

_WORDS = "list_sort(list_distinct(list_filter(regexp_split_to_array(lower({0}), '\\s+'), lambda x: x <> '')))"
_GRAMS = "list_distinct(flatten(list_transform({0}, lambda w: list_transform(range(1, length(w) + 1), lambda i: substr('^' || w || '$', i, 3)))))"
_DICE = "CASE WHEN len({0}) > 0 AND len({1}) > 0 THEN 2.0 * len(list_intersect({0}, {1})) / (len({0}) + len({1})) ELSE 0 END"


@query(f"""WITH {_LINES}, k AS (SELECT doc_id AS id, lang, {_WORDS.format(f"coalesce({_KEY}, '')")} AS w, {_WORDS.format("array_to_string(string_split(rest, ' ')[1:3], ' ')")} AS pw, {_WORDS.format("CASE WHEN doc_id % 7 = 0 THEN '' ELSE source END")} AS ow FROM lines),
g AS (SELECT *, {_GRAMS.format("w")} AS g, {_GRAMS.format("pw")} AS p, {_GRAMS.format("ow")} AS o, min(id) OVER (PARTITION BY lang, w, pw, ow) AS head FROM k WHERE len(w) > 0), h AS (SELECT * FROM g WHERE id = head),
q AS (SELECT a.id AS a, b.id AS b, a.g AS ga, b.g AS gb, {_GRAMS.format("list_intersect(a.w, b.w)")} AS gs, a.p AS pa, b.p AS pb, a.o AS oa, b.o AS ob FROM h a JOIN h b ON a.lang = b.lang AND a.id < b.id),
s AS (SELECT a, b, greatest({_DICE.format("ga", "gb")}, CASE WHEN len(gs) > 0 THEN 2.0 * len(gs) / (len(gs) + least(len(ga), len(gb))) ELSE 0 END) AS t, {_DICE.format("pa", "pb")} AS p, {_DICE.format("oa", "ob")} AS o,
  CASE WHEN len(pa) > 0 AND len(pb) > 0 THEN 0.2 ELSE 0 END AS wp, CASE WHEN len(oa) > 0 AND len(ob) > 0 THEN 0.2 ELSE 0 END AS wo FROM q),
r AS (SELECT a, b, round(CAST((0.6 * t + wp * p + wo * o) / (0.6 + wp + wo) AS DOUBLE), 6) AS punteggio FROM s UNION ALL SELECT head, id, 1.0 FROM g WHERE id <> head)
SELECT *, CASE WHEN punteggio >= 0.85 THEN 'duplicato' ELSE 'possibile_duplicato' END AS esito FROM r WHERE punteggio >= 0.7""")
def fuzzy_scored(spark, d):
    """First lines as titles, the next three words as places, sources as organisers, within a language."""
    place = F.array_join(F.slice(F.split("rest", " "), 1, 3), " ")
    rows = first_lines(spark, d).select(F.col("doc_id").alias("id"), "lang", T.title_key(F.col("line")).alias("titolo_normalizzato"), place.alias("luogo"), F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("source")).alias("organizzatore"))
    return matching.scored_pairs(rows, ["lang"])


_SEEN = """v AS (SELECT l_orderkey AS k, 'S' || l_suppkey AS src, CASE WHEN l_suppkey % 5 <> 4 THEN 'T' || (l_suppkey % 4) END AS tier, CASE WHEN l_linenumber % 6 <> 5 THEN l_quantity END AS conf, l_shipdate AS at_, 'https://e.example/' || l_partkey AS url,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'p' || l_partkey END AS titolo, CASE WHEN l_suppkey % 3 = 0 THEN ' ' ELSE 'sala ' || (l_suppkey % 10) END AS luogo, CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice END AS prezzo, CASE WHEN l_partkey % 11 = 0 THEN 'img' || l_partkey END AS url_immagine FROM lineitem)"""
_BEST = "ORDER BY coalesce(tier, '~'), coalesce(conf, -1) DESC, at_ DESC NULLS LAST, src"


@query(f"""WITH {_SEEN} SELECT k, {', '.join(f"first({f} {_BEST}, {f}) FILTER ({f} IS NOT NULL AND trim(CAST({f} AS VARCHAR)) <> '') AS {f}, first(src {_BEST}, {f}) FILTER ({f} IS NOT NULL AND trim(CAST({f} AS VARCHAR)) <> '') AS {f}_fonte" for f in ("titolo", "luogo", "prezzo", "url_immagine"))},
first(url {_BEST}, url) AS url, first(src {_BEST}, url) AS fonte, array_to_string(list_sort(list_distinct(list(src))), ', ') AS fonti FROM v GROUP BY k""")
def field_merge(spark, d):
    """Sightings of an order's lines, merged field by field by tier, confidence and time."""
    s, p = F.col("l_suppkey"), F.col("l_partkey")
    text = lambda a, c: F.concat(F.lit(a), c.cast("string"))
    rows = t(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("k"), text("S", s).alias("source_id"), F.when(s % 5 != 4, text("T", s % 4)).alias("tier"), F.when(F.col("l_linenumber") % 6 != 5, F.col("l_quantity")).alias("confidenza"), F.col("l_shipdate").alias("visto"), text("https://e.example/", p).alias("url"),
        F.when(p % 5 != 0, text("p", p)).alias("titolo"), F.when(s % 3 == 0, " ").otherwise(text("sala ", s % 10)).alias("luogo"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_extendedprice")).alias("prezzo"), F.when(p % 11 == 0, text("img", p)).alias("url_immagine"),
    )
    return merging.merged(rows, ["k"], ["titolo", "luogo", "prezzo", "url_immagine"]).withColumn("fonti", F.array_join("fonti", ", "))


_END = "z AS (SELECT epoch_us(max(ts)) // 1000 - {0} AS fine FROM events)"
_AT = "strftime(make_timestamp({0} * 1000), '%Y-%m-%d %H:%M:%S.%g')"


def _changes(rows):
    return rows.select("user_id", "stato", F.date_format("dal", "yyyy-MM-dd HH:mm:ss.SSS").alias("dal"))


@query(f"""WITH {_END.format(86400000)}, e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events, z WHERE epoch_us(ts) // 1000 <= fine),
w AS (SELECT *, lag(ms) OVER (PARTITION BY user_id ORDER BY ms) AS prima, coalesce(lead(ms) OVER (PARTITION BY user_id ORDER BY ms), fine + 1) AS poi FROM e, z)
SELECT user_id, 'attiva' AS stato, {_AT.format("ms")} AS dal FROM w WHERE prima IS NULL OR ms - prima > 86400000
UNION ALL SELECT user_id, 'da_verificare', {_AT.format("(ms + 86400000)")} FROM w WHERE ms + 86400000 < poi UNION ALL SELECT user_id, 'sospesa', {_AT.format("(ms + 172800000)")} FROM w WHERE ms + 172800000 < poi""")
def stream_decay(spark, d):
    """What ages between confirmations, as a stream with event-time timers; the SQL is the batch form."""
    _, stream = _stream(spark, d)
    with timers.rocksdb(spark):
        return _changes(_drain(spark, timers.ageing(stream, "user_id", "ts", "attiva", [(1, "da_verificare"), (2, "sospesa")], "1 day")))


@query(f"""WITH RECURSIVE {_END.format(3600000)}, e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_type <> 'error') AS n FROM events, z WHERE epoch_us(ts) // 1000 <= fine),
r AS (SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS n, 0 AS errori, CAST(NULL AS BIGINT) AS fino, CAST(NULL AS BIGINT) AS aperto FROM e
  UNION ALL SELECT e.user_id, e.n, CASE WHEN fino >= ms THEN errori WHEN ok OR errori + 1 >= 2 THEN 0 ELSE errori + 1 END, CASE WHEN fino >= ms THEN fino WHEN NOT ok AND errori + 1 >= 2 THEN ms + 36000000 END, CASE WHEN coalesce(fino < ms, true) AND NOT ok AND errori + 1 >= 2 THEN ms END
  FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1)
SELECT user_id, 'aperto' AS stato, {_AT.format("aperto")} AS dal FROM r WHERE aperto IS NOT NULL UNION ALL SELECT user_id, 'chiuso', {_AT.format("(aperto + 36000000)")} FROM r, z WHERE aperto + 36000000 <= fine""")
def stream_circuit(spark, d):
    """Circuits opened by two errors in a row, as a stream with event-time timers; the SQL goes row by row."""
    _, stream = _stream(spark, d)
    with timers.rocksdb(spark):
        return _changes(_drain(spark, timers.breaker(stream.withColumn("fallita", F.col("event_type") == "error"), "user_id", "ts", "fallita", 2, 600, "1 hour")))


_PLACED = """p AS (SELECT lower(replace(n_name, '_', ' ')) AS nome, n_name AS comune FROM nation UNION ALL SELECT lower(replace(n_name, '_', ' ')) || ' alta', 'alta di ' || n_name FROM nation WHERE n_nationkey % 3 = 0
  UNION ALL SELECT 'Valle Comune', n_name FROM nation WHERE n_nationkey < 2 UNION ALL SELECT replace(r_name, '_', ' '), r_name FROM region),
names AS (SELECT lower(nome) AS nome, array_to_string(list_sort(list_distinct(list(comune))), ', ') AS comuni FROM p GROUP BY 1)"""


@query(rf"""WITH {_PLACED}, pat AS (SELECT ' (' || string_agg(replace(nome, ' ', '  '), '|' ORDER BY length(nome) DESC) || ') ' AS pattern FROM names),
x AS (SELECT doc_id, ' ' || regexp_replace(strip_accents(lower(coalesce(text, '') || '; Nàtion ' || (doc_id % 30) || ' Alta, nation_1 nation ' || (doc_id % 7) || '(nation ' || (doc_id % 4) || ')' || CASE WHEN doc_id % 3 = 0 THEN ' valle   comune REGION 2' ELSE '' END)), '[^\p{{L}}\p{{N}}_]+', '  ', 'g') || ' ' AS t FROM documents),
m AS (SELECT doc_id, replace(unnest(regexp_extract_all(t, (SELECT pattern FROM pat), 1)), '  ', ' ') AS nome FROM x)
SELECT doc_id, m.nome, comuni, comuni LIKE '%,%' AS ambiguo, count(*) AS n FROM m JOIN names USING (nome) GROUP BY ALL""")
def place_mentions(spark, d):
    """Names of nations and regions in whole texts, to whose ends some are put."""
    n, k = t(spark, d, "nation"), F.col("doc_id")
    plain = F.replace("n_name", F.lit("_"), F.lit(" "))
    named = n.select(plain.alias("nome"), F.col("n_name").alias("comune"))
    named = named.unionByName(n.where("n_nationkey % 3 = 0").select(F.concat(plain, F.lit(" alta")), F.concat(F.lit("alta di "), "n_name")).toDF("nome", "comune"))
    named = named.unionByName(n.where("n_nationkey < 2").select(F.lit("Valle Comune"), "n_name").toDF("nome", "comune")).unionByName(t(spark, d, "region").select(F.replace("r_name", F.lit("_"), F.lit(" ")), "r_name").toDF("nome", "comune"))
    text = F.concat(F.coalesce("text", F.lit("")), F.lit("; Nàtion "), (k % 30).cast("string"), F.lit(" Alta, nation_1 nation "), (k % 7).cast("string"), F.lit("(nation "), (k % 4).cast("string"), F.lit(")"), F.when(k % 3 == 0, " valle   comune REGION 2").otherwise(""))
    found = mentions.mentions(t(spark, d, "documents").select("doc_id", text.alias("testo")), ["doc_id"], "testo", mentions.dictionary(named))
    return found.groupBy("doc_id", "nome", F.array_join("comuni", ", ").alias("comuni"), "ambiguo").agg(F.count("*").alias("n"))


@query("""WITH RECURSIVE e AS (SELECT event_id, CAST(ts AS DATE) AS giorno, CAST(value AS BIGINT) % 7 AS p FROM (SELECT event_id, ts, floor(value) AS value FROM events)),
q AS (SELECT min(giorno) - 1 AS oggi, NULL::BIGINT AS event_id, NULL::DATE AS giorno, NULL::BIGINT AS p, true AS dentro FROM e
  UNION ALL SELECT oggi, event_id, giorno, p, row_number() OVER (ORDER BY p - 2 * date_diff('day', DATE '1970-01-01', giorno) DESC, giorno, event_id) <= 300 FROM (
    SELECT CAST(oggi + 1 AS DATE) AS oggi, event_id, giorno, p FROM q WHERE NOT dentro
    UNION ALL SELECT e.giorno, e.event_id, e.giorno, e.p FROM e JOIN (SELECT DISTINCT CAST(oggi + 1 AS DATE) AS oggi FROM q) n ON n.oggi = e.giorno) WHERE oggi <= DATE '2024-01-30')
SELECT e.event_id, strftime(a.oggi, '%Y-%m-%d') AS ammesso_il FROM e LEFT JOIN (SELECT event_id, oggi FROM q WHERE dentro AND event_id IS NOT NULL) a ON a.event_id = e.event_id""")
def quota_backlog(spark, d):
    """Three hundred admissions a day by a priority that rises while waiting; the SQL carries the backlog from day to day."""
    rows = t(spark, d, "events").select("event_id", F.to_date(F.col("ts").cast("timestamp")).alias("giorno"), (F.floor("value") % 7).alias("priorita"))
    return backlog.schedule(rows, 300, "2024-01-30", id="event_id", rise=2).select("event_id", F.col("ammesso_il").cast("string").alias("ammesso_il"))


@query(f"""WITH {_RULES}, x AS (SELECT *, CAST(unnest(generate_series(DATE '1998-06-15', DATE '1998-10-13', INTERVAL 1 DAY)) AS DATE) AS g FROM rules WHERE c_custkey % 4 <> 3),
y AS (SELECT c_custkey, g FROM x WHERE strftime(g, '%a') = CASE day WHEN 'MO' THEN 'Mon' WHEN 'TU' THEN 'Tue' WHEN 'WE' THEN 'Wed' WHEN 'TH' THEN 'Thu' WHEN 'FR' THEN 'Fri' WHEN 'SA' THEN 'Sat' ELSE 'Sun' END AND (NOT no_august OR month(g) <> 8) AND (fine IS NULL OR g <= CAST(fine AS DATE))
  AND (freq = 'settimanale' OR ord IS NULL OR (ord > 0 AND CAST(ceil(day(g) / 7) AS INTEGER) = ord) OR (ord = -1 AND month(g + INTERVAL 7 DAY) <> month(g)))),
n AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY g) || ' di ' || count(*) OVER (PARTITION BY c_custkey) AS occorrenza FROM y),
s AS (SELECT c_custkey, 's' || (c_custkey % 5) AS source_id FROM rules UNION ALL SELECT c_custkey, 'bis' FROM rules WHERE c_custkey % 6 = 0),
o AS (SELECT c_custkey AS arrivo, source_id, strftime(g, '%Y-%m-%d') AS data_inizio, occorrenza FROM n JOIN s USING (c_custkey) WHERE NOT (c_custkey % 10 = 0 AND day(g) < 8)
  UNION ALL SELECT c_custkey, source_id, '1998-07-01', NULL FROM s WHERE c_custkey % 4 = 3)
SELECT o.*, 'Mercato ' || arrivo AS titolo, n_name AS comune FROM o JOIN customer ON c_custkey = arrivo JOIN nation ON n_nationkey = c_nationkey""")
def recurring_routed(spark, d):
    """Announcements of which three in four recur, some told by two sources: their dates by way of series, the others as they are."""
    k = F.col("c_custkey")
    who = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("comune"))
    told = rules(spark, d).join(who, "c_custkey").withColumn("titolo", F.concat(F.lit("Mercato "), k.cast("string")))
    rule = F.struct((k % 4 != 3).alias("e_ricorrente"), F.col("freq").alias("frequenza"), F.col("days").alias("giorni_settimana"), F.col("ord").cast("int").alias("ordinale"), F.col("months").alias("mesi_inclusi"), F.col("fine").alias("fine_dichiarata"), F.lit("").alias("testo_originale"))
    one = lambda rows, pos, source: rows.select((k * publish.PER_ARTIFACT + pos).alias("seq"), k.alias("arrivo"), source.alias("source_id"), "titolo", F.lit("fiera").alias("tipologia"), "comune", F.lit(None).cast("string").alias("luogo_testuale"), F.lit("u").alias("url"), rule.alias("ricorrenza"))
    read = one(told, 0, F.concat(F.lit("s"), (k % 5).cast("string"))).unionByName(one(told.where(k % 6 == 0), 1, F.lit("bis")))
    key = T.title_key(F.col("titolo"), F.col("comune"))
    plain = publish.event_columns(read.where(~publish.recurs()).withColumns({"titolo_normalizzato": key, "comune_normalizzato": T.title_key(F.col("comune")), "esito": F.lit("pubblicato"), "data_inizio": F.lit("1998-07-01")}))
    days = F.explode(F.transform(F.filter(F.sequence(day(), F.date_add(day(), 120)), lambda g: F.dayofmonth(g) < 8), lambda g: g.cast("string")))
    none = told.where(k % 10 == 0).select(T.series_id(key, F.col("comune"), F.lit(None).cast("string")).alias("serie_id"), days.alias("data_inizio"), F.lit("si").alias("soppressa"))
    rows, _, _ = publish.with_occurrences(plain, read, spark.createDataFrame([], schemas.SERIES), publish.migrate(none, schemas.EVENTS), comuni(spark, d), day())
    return rows.select("arrivo", "source_id", "data_inizio", "occorrenza", "titolo", "comune")


@query("""WITH c AS (SELECT n_name AS comune, CASE WHEN n_nationkey % 9 <> 5 THEN 35.0 + (n_nationkey * 7) % 25 END AS b, -5.0 + (n_nationkey * 11) % 50 AS l FROM nation UNION ALL SELECT r_name, -80.0 + r_regionkey * 40, 179.5 - r_regionkey * 0.25 FROM region),
p AS (SELECT c_custkey, CASE WHEN c_custkey % 40 = 0 THEN NULL WHEN c_custkey % 40 = 1 THEN 89.0 ELSE 35.0 + (c_custkey * 37 % 1000) / 40.0 END AS lat, CASE WHEN c_custkey % 40 = 2 THEN -179.9 ELSE -5.0 + (c_custkey * 61 % 1000) / 20.0 END AS lon FROM customer),
d AS (SELECT c_custkey, comune, 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(b - lat) / 2), 2) + cos(radians(lat)) * cos(radians(b)) * pow(sin(radians(l - lon) / 2), 2)))) AS aria FROM p, c WHERE b IS NOT NULL AND lat IS NOT NULL),
n AS (SELECT c_custkey, first(comune ORDER BY round(aria, 6), comune) AS comune, round(min(aria), 3) AS aria FROM d GROUP BY 1)
SELECT p.c_custkey, comune, aria, round(aria * 1.3, 1) AS km, CASE WHEN aria * 1.3 <= 50 THEN 'A' WHEN aria * 1.3 <= 75 THEN 'B' WHEN aria * 1.3 <= 100 THEN 'C' END AS fascia FROM p LEFT JOIN n ON n.c_custkey = p.c_custkey""")
def nearest_place(spark, d):
    """The nearest of the nations and regions to each customer, at coordinates made from keys, poles and date line among them."""
    n, r, k = F.col("n_nationkey"), F.col("r_regionkey"), F.col("c_custkey")
    places = t(spark, d, "nation").select(F.col("n_name").alias("comune"), F.when(n % 9 != 5, 35.0 + (n * 7) % 25).alias("lat"), (-5.0 + (n * 11) % 50).alias("lon")).unionByName(t(spark, d, "region").select(F.col("r_name").alias("comune"), (-80.0 + r * 40).alias("lat"), (179.5 - r * 0.25).alias("lon")))
    points = t(spark, d, "customer").select(k, F.when(k % 40 == 0, None).when(k % 40 == 1, 89.0).otherwise(35.0 + (k * 37 % 1000) / 40.0).alias("lat"), F.when(k % 40 == 2, -179.9).otherwise(-5.0 + (k * 61 % 1000) / 20.0).alias("lon"))
    found = geo.nearest(points, places)
    air = F.round("aria", 3)
    road = geo.by_road(air)
    return found.select("c_custkey", "comune", air.alias("aria"), F.round(road["km"], 1).alias("km"), road["fascia"].alias("fascia"))


_SEASON = """h AS (SELECT DISTINCT source_id, CAST(data_inizio AS DATE) AS g FROM edges JOIN events USING (event_id) WHERE CAST(event_id AS BIGINT) % 61 = 0 AND data_inizio < '1998-06-15' AND CAST(data_inizio AS DATE) >= DATE '1995-06-15'),
k AS (SELECT source_id FROM h GROUP BY 1 HAVING date_diff('day', min(g), DATE '1998-06-15') >= 300), w AS (SELECT source_id, g + to_months(CAST(12 * y AS INTEGER)) AS at_ FROM h JOIN k USING (source_id), range(1, 6) r(y)),
s AS (SELECT DISTINCT giorno, source_id FROM w, (SELECT CAST(unnest(generate_series(DATE '1998-06-15', DATE '1999-06-15', INTERVAL 7 DAY)) AS DATE) AS giorno) WHERE giorno BETWEEN at_ - INTERVAL 60 DAY AND at_ + INTERVAL 5 DAY)"""


def _seasons(spark, d):
    history = edges(spark, d).join(events(spark, d).where(F.col("event_id").cast("long") % 61 == 0).select("event_id", "data_inizio"), "event_id")
    return attention.seasons(history, day(), F.date_add(day(), 365))


@query(f"""$ , {_SEASON} SELECT strftime(giorno, '%Y-%m-%d') AS giorno, count(*) AS fonti, min(source_id) AS prima FROM s GROUP BY 1""")
def seasonal_calendar(spark, d):
    """How many sources are in season each week of the year to come, and the first of them."""
    weeks = spark.range(53).select(F.date_add(day(), (F.col("id") * 7).cast("int")).alias("giorno"))
    found = attention.in_season(weeks, _seasons(spark, d))
    return found.groupBy(F.col("giorno").cast("string").alias("giorno")).agg(F.count("*").alias("fonti"), F.min("source_id").alias("prima"))


@query(f"""$ , {_SEASON} SELECT x.source_id, CAST(CASE coalesce(c.fascia, '') WHEN 'A' THEN 100 WHEN 'B' THEN 75 WHEN 'C' THEN 50 WHEN 'D' THEN 25 ELSE 0 END + 3 * coalesce(date_diff('day', CAST(CAST(last_run AS TIMESTAMP) AS DATE), DATE '1998-06-15'), 365) - 5 * consecutive_errors + CASE WHEN s.source_id IS NOT NULL THEN 25 ELSE 0 END AS DOUBLE) AS priorita
FROM sources x LEFT JOIN comuni c ON x.source_id = 'comune-' || replace(lower(c.comune), ' ', '-') AND attivo = 'si' LEFT JOIN s ON s.source_id = x.source_id AND s.giorno = DATE '1998-06-15' WHERE tier IS NOT NULL""")
def seasonal_priority(spark, d):
    """Priorities of sources, higher in the season that their past events give them."""
    now = attention.in_season(spark.range(1).select(day().alias("giorno")), _seasons(spark, d))
    return queue.by_priority(sources(spark, d), comuni(spark, d), day(), season=now).select("source_id", F.col("priorita").cast("double").alias("priorita"))


_MESSAGES = ["HTTP 404", "timeout", "HTTP 429 Too Many Requests", "nessun annuncio estratto", "dominio scaduto", "503"]


@query(f"""WITH o AS (SELECT 'u' || user_id AS source_id, ts, CASE WHEN event_type = 'purchase' AND user_id % 3 = 0 THEN 'riuscita' ELSE ['permanente', 'transitorio', 'blocco', 'struttura', 'permanente', 'transitorio'][CASE WHEN event_id % 97 = 0 THEN 2 ELSE user_id % 6 + 1 END] END AS classe FROM events),
g AS (SELECT *, CASE WHEN classe = lag(classe) OVER (PARTITION BY source_id ORDER BY ts, classe) THEN 0 ELSE 1 END AS nuovo FROM o), i AS (SELECT *, sum(nuovo) OVER (PARTITION BY source_id ORDER BY ts, classe) AS k FROM g),
r AS (SELECT source_id, classe, min(ts) AS dal, max(ts) AS al, count(*) AS n FROM i GROUP BY source_id, classe, k QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY k DESC) = 1)
SELECT source_id, classe, date_diff('day', CAST(dal AS DATE), CAST(al AS DATE)) AS giorni, n, CASE WHEN classe = 'permanente' AND date_diff('day', CAST(dal AS DATE), CAST(al AS DATE)) >= 14 THEN 'rotta' ELSE 'attiva' END AS stato,
strftime(CAST(al AS DATE) + to_days(CAST(CASE WHEN classe = 'permanente' AND date_diff('day', CAST(dal AS DATE), CAST(al AS DATE)) >= 14 THEN 30 WHEN classe = 'blocco' THEN [7, 14, 30][least(n, 3)] ELSE 0 END AS INTEGER)), '%Y-%m-%d') AS riprova_dal FROM r""")
def broken_sources(spark, d):
    """What the errors of each user's visits say, from two batches one after the other; the SQL sees all at once."""
    e, u = t(spark, d, "events"), F.col("user_id")
    said = F.element_at(F.array(*map(F.lit, _MESSAGES)), F.when(F.col("event_id") % 97 == 0, 2).otherwise(u % 6 + 1).cast("int"))
    rows = e.select(F.concat(F.lit("u"), u.cast("string")).alias("source_id"), F.col("ts").cast("timestamp").alias("ts"), F.when(~((F.col("event_type") == "purchase") & (u % 3 == 0)), said).alias("errore"))
    half = F.lit("2024-01-12 07:00:00").cast("timestamp")
    after = attention.continued(attention.last_stretch(rows.where(F.col("ts") < half)), attention.last_stretch(rows.where(F.col("ts") >= half)))
    return attention.verdicts(after).join(after.select("source_id", "n"), "source_id").select("source_id", "classe", "giorni", "n", "stato", F.col("riprova_dal").cast("string").alias("riprova_dal"))


@query(f"""WITH RECURSIVE {_BITS}, n AS (SELECT vec_id AS id, h, vec_id % 3 AS giorno, vec_id % 2 AS comune, vec_id // 40 AS titolo FROM bits),
e AS (SELECT a.id AS x, b.id AS y FROM n a JOIN n b ON a.giorno = b.giorno AND a.comune = b.comune AND a.id <> b.id AND (bit_count(xor(a.h, b.h)) <= 8 OR (a.titolo = b.titolo AND a.titolo % 2 = 0))),
r AS (SELECT id, id AS altro FROM n UNION SELECT r.id, e.y FROM r JOIN e ON e.x = r.altro)
SELECT id, min(altro) AS gruppo FROM r GROUP BY 1""")
def image_event_groups(spark, d):
    """Groups of a day and place by near pictures (the signs of vectors) and, for every other title, by titles."""
    sign = F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0")), "")
    half = lambda at: F.lpad(F.lower(F.conv(F.substring(sign, at, 32), 2, 16)), 8, "0")
    k = F.col("vec_id")
    rows = t(spark, d, "embeddings").select(k.alias("id"), (k % 3).alias("giorno"), (k % 2).alias("comune"), F.concat(half(1), half(33)).alias("phash"), F.floor(k / 40).alias("titolo"))
    named = rows.where("titolo % 2 = 0")
    first = named.groupBy("titolo", "giorno", "comune").agg(F.min("id").alias("a"))
    pairs = named.join(first, ["titolo", "giorno", "comune"]).select("a", F.col("id").alias("b")).where("a <> b")
    return groups.event_groups(rows, ["giorno", "comune"], pairs)


@query("""WITH p AS (SELECT DISTINCT ['facebook', 'instagram', 'telegram'][conv_id % 3 + 1] AS piattaforma, conv_id * 1000 + turn AS post_id, text AS testo FROM conversations)
SELECT piattaforma, count(DISTINCT post_id) AS post, max(post_id) AS ultimo, CAST(sum(length(testo)) AS BIGINT) AS lettere FROM p GROUP BY 1""")
def stream_updates(spark, d):
    """Turns as posts that land in lots of three platforms, some of them twice, read by a cursor each and counted once."""
    k = F.col("conv_id")
    posts = t(spark, d, "conversations").select(F.element_at(F.array(*map(F.lit, ["facebook", "instagram", "telegram"])), (k % 3 + 1).cast("int")).alias("piattaforma"), (k % 4).alias("lotto"), (k * 1000 + F.col("turn")).alias("post_id"), F.col("text").alias("testo"))
    path = fresh_path(spark, "landed")
    updates.land(posts.unionByName(posts.where("post_id % 5 = 0").withColumn("lotto", F.lit(7))), path)
    rows = _drain(spark, updates.read_updates(spark, path, "piattaforma string, lotto bigint, post_id bigint, testo string"))
    return rows.select("piattaforma", "post_id", "testo").distinct().groupBy("piattaforma").agg(F.countDistinct("post_id").alias("post"), F.max("post_id").alias("ultimo"), F.sum(F.length("testo")).alias("lettere"))
