"""Building and ordering of work: runnable sources by priority, the follow queue from cleaned link lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairground.functions import scores, urls
from fairground.functions import text as T
from fairground.operators.places import wrong_entity


def by_priority(sources: DataFrame, comuni: DataFrame, as_of: Column, only_failing: bool = False, limit: int | None = None, season: DataFrame | None = None, bonus: float = 25.0) -> DataFrame:
    """Runnable sources with their ``priorita``, the most urgent first; ties in order of the id.

    Those of ``season`` (``source_id``, as ``attention.in_season`` finds them) have ``bonus`` points more, as much as a band.
    """
    band = comuni.where("attivo = 'si'").select(F.concat(F.lit("comune-"), T.slug(F.trim("comune"))).alias("source_id"), "fascia").groupBy("source_id").agg(F.min("fascia").alias("fascia"))
    rows = sources.where("tier is not null").join(band, "source_id", "left")
    if only_failing:
        rows = rows.where("consecutive_errors > 0")
    rows = rows.withColumn("priorita", scores.source_priority(F.col("fascia"), F.coalesce("esiti_utili", F.lit(0)), F.lit(0.0), F.col("last_run"), F.col("consecutive_errors"), as_of))
    if season is not None:
        rows = rows.join(season.select("source_id").distinct().withColumn("_in", F.lit(True)), "source_id", "left")
        rows = rows.withColumn("priorita", F.col("priorita") + F.when(F.col("_in"), bonus).otherwise(0.0)).drop("_in")
    rows = rows.orderBy(F.desc("priorita"), "source_id")
    return rows.limit(limit) if limit else rows


def clean_links(links: DataFrame, comuni: DataFrame) -> DataFrame:
    """``links(soggetto, categoria, comune, url)`` with ``piattaforma, url, handle, verdetto``: ``ok``, ``scarto``, or why a
    person should look."""
    rows = links.withColumn("verdetto", urls.social_verdict(F.col("url")))
    rows = rows.withColumns({"piattaforma": urls.platform(F.col("url")), "url": F.when(F.col("verdetto") == "ok", urls.social_url(F.col("url"))).otherwise(F.col("url"))})
    rows = rows.withColumn("handle", F.when(F.col("verdetto") == "ok", urls.social_handle(F.col("url"))))
    rows = wrong_entity(rows, comuni)
    return rows.withColumn("verdetto", F.when((F.col("verdetto") == "ok") & F.col("wrong_comune").isNotNull(), F.concat(F.lit("possibile_entita_sbagliata: handle contiene '"), "wrong_comune", F.lit("'"))).otherwise(F.col("verdetto"))).drop("wrong_comune")


def queue_rows(cleaned: DataFrame) -> DataFrame:
    """Queue rows of the links that are fine, the most urgent first."""
    own = F.when(F.col("categoria") == "aggregatore", F.col("soggetto")).otherwise(F.col("comune"))
    rows = cleaned.where("verdetto = 'ok'").select(F.concat("categoria", F.lit("-"), F.replace(T.fold(own), F.lit(" "), F.lit("-")), F.lit("-"), "piattaforma").alias("source_id"), "piattaforma", "handle", "url", "soggetto", "comune", "fascia", "categoria", F.lit("da_seguire").alias("stato"))
    return rows.withColumn("priorita", scores.queue_priority(F.col("fascia"), F.col("categoria"))).orderBy(F.desc("priorita"), "source_id")


def import_links(comuni_list: DataFrame, proloco_list: DataFrame, social_list: DataFrame, comuni: DataFrame, keys: DataFrame) -> DataFrame:
    """The follow queue from the three lists: municipalities, local associations, aggregators."""
    town = keys.select(F.col("place_key").alias("_k"), F.col("comune").alias("_c"), F.col("fascia").alias("_f"))
    near = lambda df: df.join(town, T.name_key(F.col("Comune")) == F.col("_k"))
    a = near(comuni_list).select(F.concat(F.lit("Comune di "), "_c").alias("soggetto"), F.lit("comune").alias("categoria"), F.col("_c").alias("comune"), F.col("_f").alias("fascia"), F.col("Facebook").alias("url"))
    name = F.coalesce(F.nullif(F.trim("Denominazione"), F.lit("")), F.lit("Pro Loco"))
    b = near(proloco_list).select(F.concat(name, F.lit(" "), "_c").alias("soggetto"), F.lit("proloco").alias("categoria"), F.col("_c").alias("comune"), F.col("_f").alias("fascia"), F.explode(F.array("Facebook", "Instagram")).alias("url"))
    c = social_list.select(F.trim("Nome").alias("soggetto"), F.lit("aggregatore").alias("categoria"), F.lit("").alias("comune"), F.lit("A").alias("fascia"), F.explode(F.array("Facebook", "Instagram")).alias("url"))
    towns = clean_links(a.unionByName(b), comuni)
    # Aggregators belong to no municipality: only the links of no use go.
    others = c.where(~F.coalesce(F.col("url").rlike(urls.MUTE), F.lit(True))).withColumn("url", urls.social_url(F.col("url"))).withColumns({"piattaforma": urls.platform(F.col("url")), "handle": urls.social_handle(F.col("url")), "verdetto": F.lit("ok")}).where("handle is not null and piattaforma is not null")
    return queue_rows(towns.unionByName(others))


def queue_sheet(queue: DataFrame) -> DataFrame:
    """The whole queue as its sheet shows it, by band and category; the priority is left to a formula of the sheet."""
    shown = "source_id piattaforma handle url soggetto comune fascia priorita stato tentativi data_follow note".split()
    rows = queue.withColumn("priorita", F.lit("")).withColumns({c: F.coalesce(c, F.lit("")) for c in ("data_follow", "note")})
    return rows.orderBy(F.asc_nulls_first("fascia"), F.asc_nulls_first("categoria"), "source_id").select(*shown)


def without_own(handles: DataFrame, own_page: Column) -> DataFrame:
    """Followed handles without that of one's own page, which its address names by number or by name."""
    number, name = F.regexp_extract(own_page, r"[?&]id=(\d+)", 1), F.regexp_extract(own_page, r"facebook\.com/([^/?#]+)", 1)
    own = F.lower(F.coalesce(F.nullif(number, F.lit("")), F.nullif(name, F.lit("")), F.lit("")))
    return handles.where(F.lower(F.trim("handle")) != own)
