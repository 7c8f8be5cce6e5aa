"""Municipalities: lookup by name and alias, the cascade from text to source, lookup by source id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairground.config import DEFAULT, Settings
from fairground.functions import scores
from fairground.functions.text import name_key, slug


def place_keys(comuni: DataFrame) -> DataFrame:
    """One row a key of the active municipalities: names before aliases, the smaller ``istat`` first."""
    active = comuni.where("attivo = 'si'")
    names = active.select(name_key(F.col("comune")).alias("place_key"), F.lit(0).alias("level"), "istat", "comune", "km", "minuti", "fascia")
    aliases = active.select(F.explode(F.split(F.coalesce("alias", F.lit("")), ";")).alias("a"), "istat", "comune", "km", "minuti", "fascia")
    aliases = aliases.select(name_key(F.col("a")).alias("place_key"), F.lit(1).alias("level"), "istat", "comune", "km", "minuti", "fascia")
    first = Window.partitionBy("place_key").orderBy("level", "istat")
    return names.unionByName(aliases).where("place_key is not null").withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "level")


def resolve_places(rows: DataFrame, keys: DataFrame, text: Column, source: Column, category: Column, settings: Settings = DEFAULT) -> DataFrame:
    """Add the place (``comune``, ``km``, ``minuti``, ``fascia``) and its ``penalty``: from the text if it names one, else from the source."""
    picked = ["comune", "km", "minuti", "fascia"]
    side = lambda p: keys.select(F.col("place_key").alias(f"_{p}"), *(F.col(c).alias(f"{p}_{c}") for c in picked))
    out = rows.withColumns({"_kt": name_key(text), "_ks": name_key(source), "_cat": category})
    out = out.join(side("t"), F.col("_kt") == F.col("_t"), "left").join(side("s"), F.col("_ks") == F.col("_s"), "left")
    penalty = scores.place_penalty(F.col("t_comune"), F.col("s_comune"), F.col("_cat"), settings)
    found = {c: F.when(F.col("t_comune").isNotNull(), F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")) for c in picked}
    return out.withColumns({**found, "penalty": penalty}).drop("_kt", "_ks", "_cat", "_t", "_s", *(f"{p}_{c}" for p in "ts" for c in picked))


def place_of_slug(rows: DataFrame, slug_column: str, comuni: DataFrame) -> DataFrame:
    """Add ``comune`` by slug: the whole, else the longest name that the slug begins with before a hyphen.

    The slug's own prefixes are looked up by equality, so nothing is compared with every name.
    """
    names = comuni.select(slug(F.col("comune")).alias("_slug"), F.col("comune").alias("_comune")).where("_slug is not null")
    keyed = rows.select(F.col(slug_column).alias("_key")).where("_key is not null").distinct()
    parts = F.split("_key", "-")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "-"))
    met = keyed.select("_key", F.explode(prefixes).alias("_slug")).join(names, "_slug")
    best = met.groupBy("_key").agg(F.max_by("_comune", F.struct((F.col("_slug") == F.col("_key")).alias("whole"), F.length("_comune"), "_comune")).alias("comune"))
    return rows.join(best, rows[slug_column] == best["_key"], "left").drop("_key")


def place_of_source(sources: DataFrame, comuni: DataFrame) -> DataFrame:
    """Add ``comune`` to sources whose id begins with ``comune-``."""
    own = sources.withColumn("_own", F.when(F.col("source_id").startswith("comune-"), F.substring("source_id", 8, 1000)))
    return place_of_slug(own, "_own", comuni).drop("_own")


def wrong_entity(links: DataFrame, comuni: DataFrame, handle: str = "handle", expected: str = "comune") -> DataFrame:
    """Add ``wrong_comune``: the first other municipality (by name) that a link's handle spells out, or null.

    With separators in the handle, all words of the name must be among its words; otherwise the joined name must open or
    close the joined handle. Names under six letters, names inside the expected one, and handles that hold the expected
    one are let pass. Names meet handles by equality, on a word of the name or on the handle's beginnings and endings.
    """
    from fairground.functions.text import fold

    compact = lambda c: F.regexp_replace(fold(c), "[ ']", "")
    names = comuni.where("attivo = 'si'").select(F.col("comune").alias("_name"), compact(F.col("comune")).alias("_compact"), F.filter(F.split(fold(F.col("comune")), r"\s+"), lambda t: t != "").alias("_words")).where(F.length("_compact") >= 6)
    rows = links.select(F.col(handle).alias("_handle"), F.col(expected).alias("_expected")).where("_handle is not null").distinct()
    rows = rows.withColumns({"_tokens": F.filter(F.split(fold(F.col("_handle")), r"[-_\s]+"), lambda t: t != ""), "_parted": F.col("_handle").rlike("[-_]"), "_want": compact(F.coalesce("_expected", F.lit("")))})
    rows = rows.withColumn("_joined", F.array_join("_tokens", "")).where((F.col("_want") == "") | ~F.contains(F.col("_joined"), F.col("_want")))
    by_word = rows.where("_parted").select("*", F.explode(F.array_distinct("_tokens")).alias("_k")).join(names.select("*", F.element_at("_words", 1).alias("_k")), "_k").where(F.size(F.array_except("_words", "_tokens")) == 0)
    cuts = F.when(F.length("_joined") >= 6, F.sequence(F.lit(6), F.length("_joined"))).otherwise(F.array().cast("array<int>"))
    ends = F.array_distinct(F.concat(F.transform(cuts, lambda n: F.left(F.col("_joined"), n)), F.transform(cuts, lambda n: F.right(F.col("_joined"), n))))
    by_affix = rows.select("*", F.explode(ends).alias("_k")).join(names.select("*", F.col("_compact").alias("_k")), "_k")
    met = by_word.unionByName(by_affix).where((F.col("_compact") != F.col("_want")) & ~F.contains(F.col("_want"), F.col("_compact")))
    first = met.groupBy("_handle", "_expected").agg(F.min("_name").alias("wrong_comune"))
    return links.join(first, links[handle].eqNullSafe(first["_handle"]) & links[expected].eqNullSafe(first["_expected"]), "left").drop("_handle", "_expected")


def link_venues(queue: DataFrame, keys: DataFrame, categories: list[str]) -> DataFrame:
    """Queue rows with ``comune`` filled in from "Municipality - Name" where it was missing."""
    from fairground.functions.text import comune_of_subject

    key = F.when(F.col("category" if "category" in queue.columns else "categoria").isin(categories) & (F.coalesce("comune", F.lit("")) == ""), name_key(comune_of_subject(F.col("soggetto"))))
    side = keys.select(F.col("place_key").alias("_k"), F.col("comune").alias("_found"))
    return queue.withColumn("_key", key).join(side, F.col("_key") == F.col("_k"), "left").withColumn("comune", F.coalesce("_found", "comune")).drop("_key", "_k", "_found")
