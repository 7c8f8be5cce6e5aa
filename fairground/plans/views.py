"""Published views, one function each: tables in, one DataFrame out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairground import schemas
from fairground.functions import scores
from fairground.functions import text as T
from fairground.operators import backlog
from fairground.operators.lifecycle import with_overrides
from fairground.operators.places import place_of_slug


def sources_of(edges: DataFrame) -> DataFrame:
    """``event_id, fonti``: the sources of each event in order, as one text."""
    return edges.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("source_id")), ", ").alias("fonti"))


def _shown(events: DataFrame) -> DataFrame:
    return events.where("archiviato = 'no' and stato <> 'scartato'")


def by_start(rows: DataFrame) -> DataFrame:
    """Events by start and distance, as the sheets show them."""
    return rows.orderBy(F.asc_nulls_first("data_inizio"), F.asc_nulls_first("km"), "id")


def active_events(events: DataFrame, comuni: DataFrame, edges: DataFrame) -> DataFrame:
    """Open events that are not dropped, with band and sources; ``by_start`` puts what is written in order."""
    band = comuni.where("attivo = 'si'").select("comune", "fascia")
    rows = _shown(events).join(band, "comune", "left").join(sources_of(edges), "event_id", "left")
    rows = rows.withColumn("fonti", F.coalesce("fonti", F.lit(""))).withColumnRenamed("event_id", "id")
    return rows.drop("dedup_key", "archiviato")


def quarantine(active: DataFrame) -> DataFrame:
    return active.where("stato = 'quarantena'")


def archive(events: DataFrame, edges: DataFrame) -> DataFrame:
    """Archived events, dropped ones too, the last to end first."""
    rows = events.where("archiviato = 'si'").join(sources_of(edges), "event_id", "left").withColumn("fonti", F.coalesce("fonti", F.lit("")))
    return rows.withColumnRenamed("event_id", "id").select(*schemas.COLONNE_ARCHIVIO).orderBy(F.desc_nulls_last("data_fine"), "id")


def map_events(events: DataFrame, comuni: DataFrame, edges: DataFrame) -> DataFrame:
    """Open events of places with coordinates, as the map reads them."""
    place = comuni.where("attivo = 'si' and lat is not null and lon is not null").select("comune", "lat", "lon", F.col("km").alias("_km"), F.col("minuti").alias("_min"))
    rows = _shown(events).join(place, "comune").join(sources_of(edges), "event_id", "left")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return rows.select(F.col("event_id").alias("id"), "titolo", blank("descrizione"), "comune", "lat", "lon", F.col("_km").alias("km"), F.col("_min").alias("minuti"), "data_inizio", F.coalesce(F.nullif("data_fine", F.lit("")), "data_inizio").alias("data_fine"), "tipologia", blank("url"), blank("url_approfondimento"), blank("fonti"), blank("data_post"), blank("ora_post"), (F.coalesce("stato", F.lit("")) == "quarantena").alias("quarantena")).orderBy("data_inizio", "id")


def event_counts(edges: DataFrame, events: DataFrame, as_of: Column) -> DataFrame:
    """``source_id, attivi, totale``: events of each source, and those still to end."""
    live = (F.col("archiviato") == "no") & (F.col("data_fine") >= as_of.cast("string"))
    return edges.join(events.select("event_id", "archiviato", "data_fine"), "event_id").groupBy("source_id").agg(F.count_if(live).alias("attivi"), F.count("*").alias("totale"))


def _slot(url: Column, active: Column, total: Column, updated: Column) -> Column:
    zero = F.lit(0).cast("long")
    return F.struct(F.coalesce(url, F.lit("")).alias("url"), F.coalesce(active, zero).alias("attivi"), F.coalesce(total, zero).alias("totale"), updated.alias("ultimo_aggiornamento"))


def perimeter(comuni: DataFrame, sources: DataFrame, queue: DataFrame, edges: DataFrame, events: DataFrame, state: DataFrame, as_of: Column) -> DataFrame:
    """One row an active municipality: its sites, its pages and those of its association, and all others it has."""
    counts = event_counts(edges, events, as_of)
    own = comuni.where("attivo = 'si'").select("istat", "comune", F.coalesce("provincia", F.lit("")).alias("provincia"), "km", "minuti", T.slug(F.col("comune")).alias("_slug"))
    sites = sources.where(F.col("categoria").isin("comune", "proloco")).join(counts, "source_id", "left").groupBy("source_id").agg(F.first(F.struct("endpoint", "last_run", "attivi", "totale")).alias("s"))
    rounds = state.where(F.col("chiave").startswith("ultimo_giro_feed_")).select(F.substring("chiave", 18, 50).alias("piattaforma"), F.col("valore").alias("_round"))
    feed = F.when(F.coalesce("handle", F.lit("")) != "", F.concat(F.lit("feed-"), "piattaforma", F.lit("-"), "handle"))
    pages = queue.where("coalesce(comune, '') <> ''").withColumn("_feed", feed).join(counts.withColumnRenamed("source_id", "_feed"), "_feed", "left").join(rounds, "piattaforma", "left")
    followed = F.coalesce(F.col("stato") == "seguito", F.lit(False))
    slot = _slot(F.col("url"), F.col("attivi"), F.col("totale"), F.when(followed, F.col("_round")).otherwise("non_seguita"))
    first = lambda cat, plat: F.min_by(F.when((F.col("categoria") == cat) & (F.col("piattaforma") == plat), slot), F.when((F.col("categoria") == cat) & (F.col("piattaforma") == plat), F.col("source_id"))).alias(f"{plat}_{cat}")
    slots = pages.groupBy("comune").agg(*(first(c, p) for c in ("comune", "proloco") for p in ("facebook", "instagram")))
    other = pages.where(~F.coalesce(F.col("categoria"), F.lit("")).isin("comune", "proloco"))
    url_of = lambda p: F.coalesce(F.max(F.when(F.col("piattaforma") == p, F.col("url"))), F.lit("")).alias(p)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    subjects = other.groupBy("comune", "soggetto").agg(url_of("facebook"), url_of("instagram"), total("attivi"), total("totale"), F.coalesce(F.max(F.when(followed, F.col("_round"))), F.lit("non_seguita")).alias("ultimo_aggiornamento"))
    others = subjects.groupBy("comune").agg(F.array_sort(F.collect_list(F.struct("soggetto", "facebook", "instagram", "attivi", "totale", "ultimo_aggiornamento"))).alias("altro"))
    rows = own.join(slots, "comune", "left").join(others, "comune", "left")
    for name, prefix, suffix in (("sito_comune", "comune-", ""), ("sito_proloco", "proloco-", "-sito")):
        site = sites.select(F.col("source_id").alias("_sid"), F.col("s").alias("_s"))
        rows = rows.join(site, F.concat(F.lit(prefix), "_slug", F.lit(suffix)) == F.col("_sid"), "left")
        has = F.coalesce("_s.endpoint", F.lit("")) != ""
        rows = rows.withColumn(name, _slot(F.col("_s.endpoint"), F.col("_s.attivi"), F.col("_s.totale"), F.when(has, F.col("_s.last_run")))).drop("_sid", "_s")
    none = _slot(F.lit(""), F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("string"))
    names = [f"{p}_{c}" for c in ("comune", "proloco") for p in ("facebook", "instagram")]
    rows = rows.withColumns({n: F.coalesce(n, none) for n in names} | {"altro": F.coalesce("altro", F.array().cast(others.schema["altro"].dataType))})
    return rows.select("istat", "comune", "provincia", "km", "minuti", "sito_comune", "facebook_comune", "instagram_comune", "sito_proloco", "facebook_proloco", "instagram_proloco", "altro").orderBy("km", "istat")


def all_sources(sources: DataFrame, queue: DataFrame, comuni: DataFrame, edges: DataFrame, events: DataFrame, as_of: Column) -> DataFrame:
    """Sites and followed pages in one numbered list, by municipality (none last), kind, channel and address."""
    counts = event_counts(edges, events, as_of)
    site = sources.where("coalesce(endpoint, '') <> '' and source_id not like 'feed-%' and stato <> 'esclusa'")
    base = F.when(F.col("categoria") == "comune", F.regexp_replace("source_id", "^comune-", "")).when(F.col("categoria") == "proloco", F.regexp_replace(F.regexp_replace("source_id", "^proloco-", ""), "-sito$", ""))
    placed = place_of_slug(site.drop("comune").withColumn("_base", base), "_base", comuni).drop("_base")
    twins = queue.where("coalesce(comune, '') <> ''").where(F.col("source_id").rlike("-(facebook|instagram)$")).groupBy(F.regexp_replace("source_id", "-(facebook|instagram)$", "").alias("source_id")).agg(F.max("comune").alias("_twin"))
    direct = F.col("categoria").isin("comune", "proloco")
    web = placed.join(twins, "source_id", "left").join(counts, "source_id", "left").select(F.lit("web").alias("fonte"), T.category_label(F.col("categoria")).alias("tipo"), F.coalesce(F.when(F.coalesce(direct, F.lit(False)), F.col("comune")).otherwise(F.col("_twin")), F.lit("")).alias("comune"), F.col("endpoint").alias("url"), "attivi", "totale")
    feed = F.when(F.coalesce("handle", F.lit("")) != "", F.concat(F.lit("feed-"), "piattaforma", F.lit("-"), "handle"))
    social = queue.where("coalesce(url, '') <> '' and stato = 'seguito'").withColumn("_feed", feed).join(counts.withColumnRenamed("source_id", "_feed"), "_feed", "left").select(F.col("piattaforma").alias("fonte"), T.category_label(F.col("categoria")).alias("tipo"), F.coalesce("comune", F.lit("")).alias("comune"), "url", "attivi", "totale")
    rows = web.unionByName(social).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("attivi", "totale")})
    order = [F.coalesce(F.nullif("comune", F.lit("")), F.lit("￿")), F.col("tipo"), F.col("fonte"), F.col("url")]
    return numbered(rows, order, "numero")


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows numbered from 1 in a whole order, by ranges of it, so that no task sees all rows, however many share a value."""
    keys = [f"_o{i}" for i in range(len(order))]
    keyed = rows.select(*rows.columns, *(c.alias(k) for c, k in zip(order, keys)))
    return backlog.running(keyed, keys).select(*rows.columns, F.col("_upto").cast("int").alias(name))


def sources_sheet(sources: DataFrame, comuni: DataFrame) -> DataFrame:
    """Sources with derived subject, channel, municipality and band; nulls as blanks."""
    towns = comuni.where("attivo = 'si'").select(F.concat(F.lit("comune-"), T.slug(F.trim("comune"))).alias("source_id"), F.col("comune").alias("comune_riferimento"), "fascia").dropDuplicates(["source_id"])
    subject, channel = T.subject_and_channel(F.col("source_id"), F.col("categoria"))
    rows = sources.join(towns, "source_id", "left").withColumns({"soggetto": subject, "canale": channel, "url": F.col("endpoint"), "metodo": F.col("tier"), "ultimo_run": F.col("last_run"), "giorni_in_errore": F.col("consecutive_errors")})
    return rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in schemas.COLONNE_FONTI)).orderBy("source_id")


def to_check(queue: DataFrame) -> DataFrame:
    return queue.where("stato = 'quarantena'").select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in schemas.COLONNE_DA_VERIFICARE)).orderBy("comune", "source_id")


def coverage(comuni: DataFrame, sources: DataFrame, queue: DataFrame) -> DataFrame:
    """Symbols of four channels of each active municipality; an association searched for in vain is marked as such."""
    own = comuni.where("attivo = 'si'").select("fascia", "comune", T.slug(F.trim("comune")).alias("_slug"))
    pages = queue.select(F.col("source_id").alias("_sid"), T.queue_symbol(F.col("stato")).alias("_y")).groupBy("_sid").agg(F.max("_y").alias("_y"))
    kinds = {"comune-facebook": "fb_comune", "proloco-facebook": "fb_proloco", "proloco-instagram": "ig_proloco"}
    parts = F.regexp_extract("_sid", "^(comune|proloco)-(.*)-(facebook|instagram)$", 2)
    kind = F.regexp_replace("_sid", "^(comune|proloco)-(.*)-(facebook|instagram)$", "$1-$3")
    social = pages.where(kind.isin(list(kinds))).withColumns({"_slug": parts, "_kind": kind}).groupBy("_slug").pivot("_kind", list(kinds)).agg(F.first("_y"))
    site = sources.where(F.col("source_id").startswith("comune-")).select(F.substring("source_id", 8, 500).alias("_slug"), T.site_symbol(F.col("endpoint"), F.col("consecutive_errors")).alias("sito_istituzionale"))
    absent = queue.where("stato = 'nessuna_fonte_trovata'").select("comune").distinct().withColumn("_none", F.lit(T.SYMBOLS["absent"]))
    rows = own.join(social, "_slug", "left").join(site, "_slug", "left").join(absent, "comune", "left")
    mark = lambda c: F.coalesce(F.nullif(F.col(f"`{c}`"), F.lit("")), F.col("_none"), F.lit(""))
    return rows.select("fascia", "comune", F.coalesce("sito_istituzionale", F.lit("")).alias("sito_istituzionale"), F.coalesce("`comune-facebook`", F.lit("")).alias("fb_comune"), mark("proloco-facebook").alias("fb_proloco"), mark("proloco-instagram").alias("ig_proloco")).orderBy("fascia", "comune")


def other_entities(comuni: DataFrame, sources: DataFrame, queue: DataFrame) -> DataFrame:
    """Entities beyond the municipalities and their associations, from sources before the queue, with their channels."""
    inside = comuni.where("attivo = 'si'").select(F.concat(F.lit("proloco-"), T.slug(F.trim("comune"))).alias("nome"))
    keep = lambda df, no, at: df.where(" and ".join(f"source_id not like '{p}%'" for p in no)).select(T.entity_name(F.col("source_id")).alias("nome"), F.coalesce("categoria", F.lit("")).alias("tipologia"), F.lit(at).alias("_at"), "source_id")
    both = keep(sources, ("comune-", "feed-"), 0).unionByName(keep(queue.where("stato <> 'nessuna_fonte_trovata'"), ("comune-", "sconosciuto-"), 1))
    names = both.join(inside, "nome", "left_anti").groupBy("nome").agg(F.min_by("tipologia", F.struct("_at", "source_id")).alias("tipologia"))
    site = sources.select(F.regexp_replace("source_id", "-sito$", "").alias("nome"), F.struct(F.col("source_id").endswith("-sito"), T.site_symbol(F.col("endpoint"), F.col("consecutive_errors")).alias("y")).alias("s")).where("s.y <> ''").groupBy("nome").agg(F.min("s").alias("s")).select("nome", F.col("s.y").alias("sito"))
    social = queue.where(F.col("source_id").rlike("-(facebook|instagram)$")).groupBy(T.entity_name(F.col("source_id")).alias("nome")).pivot("piattaforma", ["facebook", "instagram"]).agg(F.max(T.queue_symbol(F.col("stato"))))
    rows = names.join(site, "nome", "left").join(social, "nome", "left")
    return rows.select("tipologia", "nome", *(F.coalesce(c, F.lit("")).alias(c) for c in ("sito", "facebook", "instagram"))).orderBy("nome")


def run_log(runs: DataFrame, limit: int = 200) -> DataFrame:
    return runs.orderBy(F.desc_nulls_last("inizio"), "run_id").limit(limit).select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in schemas.COLONNE_LOG))


def series_sheet(series: DataFrame, sheet: DataFrame) -> DataFrame:
    return with_overrides(series, sheet, "serie_id", ["bloccata"]).select(*schemas.COLONNE_SERIE).orderBy("titolo", "serie_id")


def events_sheet(active: DataFrame, sheet: DataFrame) -> DataFrame:
    return by_start(with_overrides(active, sheet, "id", schemas.COLONNE_UTENTE).select(*schemas.EVENT_COLUMNS))


def quarantine_sheet(active: DataFrame, sheet: DataFrame) -> DataFrame:
    return by_start(with_overrides(quarantine(active), sheet, "id", [*schemas.COLONNE_UTENTE, "azione"]).select(*schemas.COLONNE_QUARANTENA))


def source_detail(source_id: str, edges: DataFrame, events: DataFrame, extractions: DataFrame, artifacts: DataFrame) -> DataFrame:
    """What one source gave: its artifacts, the events read from them, the events it is an edge of."""
    from fairground.operators.extract import parse

    mine = artifacts.where(F.col("source_id") == source_id)
    read = parse(extractions.join(mine.select("artifact_id"), "artifact_id", "left_semi")).groupBy("artifact_id").agg(F.count("*").alias("estratti"))
    a = mine.join(read, "artifact_id", "left").select(F.lit("artefatto").alias("cosa"), F.col("artifact_id").alias("id"), F.col("url").alias("testo"), F.coalesce("estratti", F.lit(0)).alias("n"))
    e = edges.where(F.col("source_id") == source_id).join(events, "event_id").select(F.lit("evento").alias("cosa"), F.col("event_id").alias("id"), F.col("titolo").alias("testo"), F.lit(1).cast("long").alias("n"))
    return a.unionByName(e).orderBy("cosa", "id")


def status(events: DataFrame, sources: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of counters."""
    e = events.agg(F.count("*").alias("annunci"), F.count_if(F.col("archiviato") == "no").alias("aperti"), F.count_if((F.col("archiviato") == "no") & (F.col("stato") == "quarantena")).alias("in_quarantena"))
    s = sources.agg(F.count("*").alias("fonti"), F.count_if(F.coalesce("consecutive_errors", F.lit(0)) > 0).alias("fonti_in_errore"))
    return e.join(F.broadcast(s)).join(F.broadcast(edges.agg(F.countDistinct("source_id").alias("fonti_attive"))))


def on_date(rows: DataFrame, day: Column, comune: str | None = None, tipologia: str | None = None) -> DataFrame:
    """Events under way on a day, in a municipality and of a kind if asked."""
    hit = rows.where((F.col("data_inizio") <= day.cast("string")) & (F.coalesce("data_fine", "data_inizio") >= day.cast("string")))
    hit = hit.where(F.col("comune") == comune) if comune else hit
    return hit.where(F.col("tipologia") == tipologia) if tipologia else hit


def _sort_key(rows: DataFrame, column: str) -> Column:
    """A column with nulls as blanks."""
    text = rows.schema[column].dataType.simpleString() == "string"
    return F.coalesce(F.col(column), F.lit("") if text else F.lit(float("-inf")))


def sorted_by(rows: DataFrame, column: str, down: bool = False, tie: str = "id") -> DataFrame:
    """Rows by any column, nulls as blanks."""
    c = _sort_key(rows, column)
    return rows.orderBy(c.desc() if down else c.asc(), tie)


def placed_by(rows: DataFrame, column: str, down: bool = False, tie: str = "id", name: str = "posto") -> DataFrame:
    """Rows with their place, from 1, in the order of ``sorted_by``; ``tie`` is unlike for all rows."""
    c = _sort_key(rows, column)
    keyed = rows.withColumn("_key", c)
    return backlog.running(keyed, [F.desc("_key") if down else F.asc("_key"), F.asc(tie)]).withColumnRenamed("_upto", name).drop("_key")


def shown_of(rows: DataFrame, hit: Column, what: str = "annunci") -> DataFrame:
    """One row: how many of the rows a filter shows, how many there are, and the line that says so of ``what`` is listed."""
    counts = rows.agg(F.count_if(F.coalesce(hit, F.lit(False))).alias("mostrati"), F.count("*").alias("totale"))
    text = F.when(F.col("mostrati") == F.col("totale"), F.format_string(f"%d {what}", "totale")).otherwise(F.format_string(f"%d su %d {what}", "mostrati", "totale"))
    return counts.withColumn("testo", text)


def period(start: Column, end: Column) -> Column:
    """The days of an event in words: one, or from one to another; a start that is no date stays as it is."""
    short = lambda c: F.coalesce(F.date_format(F.try_to_date(F.left(c, F.lit(10)), "yyyy-MM-dd"), "dd/MM/yyyy"), c)
    several = (F.coalesce(end, F.lit("")) != "") & (end != start)
    return F.when(several, F.concat(F.lit("dal "), short(start), F.lit(" al "), short(end))).otherwise(F.coalesce(short(start), F.lit("")))


def sources_matching(rows: DataFrame, words: str = "", channel: str = "", kind: str = "") -> DataFrame:
    """The list of sources by channel, kind and words in municipality or address; what is blank asks for nothing."""
    hit = rows.where(F.col("fonte") == channel) if channel else rows
    hit = hit.where(F.col("tipo") == kind) if kind else hit
    return containing(hit, words.strip(), "comune", "url") if words.strip() else hit


def perimeter_matching(rows: DataFrame, words: str = "", province: str = "") -> DataFrame:
    """Municipalities whose name holds the words, in a province."""
    hit = containing(rows, words.strip(), "comune") if words.strip() else rows
    return hit.where(F.col("provincia") == province) if province else hit


def facets(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.col(column).alias("valore")).where("coalesce(valore, '') <> ''").distinct().orderBy("valore")


def markers(rows: DataFrame, day: Column) -> DataFrame:
    """One marker a municipality with events on a day: how many, and their titles in order."""
    return on_date(rows, day).groupBy("comune", "lat", "lon").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("titolo")).alias("titoli"))


def containing(rows: DataFrame, words: str, *columns: str) -> DataFrame:
    """Rows of which any of the columns holds the words, in any case."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(words.lower()))
    return rows.where(hit)


def freshness(updated: Column) -> Column:
    return F.when(updated == "non_seguita", "non seguita").when(updated.isNull(), "mai verificata").otherwise(F.date_format(F.try_to_timestamp(updated), "dd/MM/yyyy HH:mm"))


def indicators(sources: DataFrame, extractions: DataFrame, events: DataFrame, queue: DataFrame, budget: int, today: Column, now: Column) -> DataFrame:
    """The five lights: failing sources, quota, last run, quarantine, follow queue."""
    light = scores.light
    one = sources.where("tier is not null").agg(F.count("*").alias("t"), F.count_if(F.col("consecutive_errors") > 0).alias("e"), F.max("last_run").alias("r"))
    broken = sources.agg(F.count_if(F.col("stato") == "rotta").alias("b"))
    text = lambda *xs: F.concat(*(x.cast("string") for x in xs))
    c, s = F.col, F.lit
    row = lambda df, order, name, value, colour: df.select(s(order).alias("ordine"), s(name).alias("nome"), value.alias("valore"), colour.alias("semaforo"))
    share = F.when(c("t") > 0, c("e") / c("t")).otherwise(0.0)
    a = row(one.join(F.broadcast(broken)), 1, "Fonti in errore/rotte", text(c("e"), s(" in errore, "), c("b"), s(" rotte (su "), c("t"), s(")")), light((c("b") > 0) | (share > 0.2), c("e") > 0))
    used = extractions.agg(F.count_if(F.left("created_at", s(10)) == today.cast("string")).alias("u"))
    part = c("u") / max(budget, 1) if budget > 0 else s(0.0)
    b = row(used, 2, "Quota LLM residua", text(c("u"), s(f"/{budget} ("), F.round(part * 100).cast("int"), s("%)")), light(part >= 0.85, part >= 0.7))
    age = (F.unix_timestamp(now) - F.unix_timestamp(F.try_to_timestamp("r"))) / 3600
    d = row(one, 3, "Ultimo run completato", F.coalesce("r", s("mai eseguito")), light(c("r").isNull() | (age > 48), age > 36))
    q = row(events.agg(F.count_if((c("stato") == "quarantena") & (c("archiviato") == "no")).alias("n")), 4, "Annunci in quarantena da rivedere", text(c("n")), light(c("n") >= 30, c("n") >= 10))
    n = lambda x: F.count_if(c("stato") == x)
    waiting = queue.agg(n("da_seguire").alias("x"), n("candidato_da_feed").alias("y"), n("quarantena").alias("z")).withColumn("n", c("x") + c("y") + c("z"))
    f = row(waiting, 5, "Coda follow in attesa", text(c("n"), s(" da lavorare ("), c("x"), s(" da seguire, "), c("y"), s(" candidati da feed, "), c("z"), s(" da verificare)")), light(c("n") >= 200, c("n") >= 50))
    return a.unionByName(b).unionByName(d).unionByName(q).unionByName(f).orderBy("ordine")

