"""Field-wise merge of sightings: for each field the value of the best source that has one, and which source that was.

The best source is of the lowest tier, then the surest, then the latest, then the one with the smallest id. A merge is kept
as a state that can be merged again: states of parts of the sightings, in any order and however often, give what one pass
over all of them gives, so a state is as good in a partial aggregate as in a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fairground import storage

#: Stands behind every tier.
NO_TIER = "~"


def said(df: DataFrame, field: str) -> Column:
    """Whether a row states a field: not null, and no blank text."""
    column = F.col(field)
    return column.isNotNull() & (F.trim(column) != "") if isinstance(df.schema[field].dataType, StringType) else column.isNotNull()


def rank(tier: str, confidence: str, seen: str, source: str) -> list[Column]:
    """What orders sightings, the best first; an unknown tier, confidence or time stands behind the known ones."""
    at = F.unix_micros(F.col(seen).cast("timestamp"))
    return [
        F.coalesce(F.col(tier).cast("string"), F.lit(NO_TIER)).alias("tier"),
        (-F.coalesce(F.col(confidence).cast("double"), F.lit(-1.0))).alias("dubbio"),
        (-F.coalesce(at, F.lit(-(2**62)))).alias("eta"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("fonte"),
    ]


def states(sightings: DataFrame, keys: list[str], fields: list[str], tier: str = "tier", confidence: str = "confidenza", seen: str = "visto", source: str = "source_id", url: str | None = "url") -> DataFrame:
    """One state a key: for each field its winner with rank and source, ``fonti`` of all sources, ``_primario`` with the
    best source and its ``url``. A field that no sighting states is null.

    It is one aggregate with a partial step, so a key with very many sightings shuffles one row a task; it works on a
    stream as well. Fields may be of any type that can be ordered; equal ranks go by the smaller value.
    """
    order = rank(tier, confidence, seen, source)
    winner = lambda f: F.min(F.when(said(sightings, f), F.struct(*order, F.col(f).alias("valore")))).alias(f)
    address = F.col(url).cast("string") if url else F.lit(None).cast("string")
    return sightings.groupBy(*keys).agg(*(winner(f) for f in fields), F.min(F.struct(*order, address.alias("url"))).alias("_primario"), F.array_sort(F.collect_set(F.col(source).cast("string"))).alias("fonti"))


def combine(parts: DataFrame, keys: list[str]) -> DataFrame:
    """States of one key merged into one."""
    fields = [c for c in parts.columns if c not in (*keys, "fonti")]
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("fonti")))).alias("fonti")
    return parts.groupBy(*keys).agg(*(F.min(f).alias(f) for f in fields), every)


def finish(state: DataFrame, keys: list[str]) -> DataFrame:
    """The merged rows: each field with ``<field>_fonte``, the source it comes from, the best source's ``url``, and ``fonti``."""
    fields = [c for c in state.columns if c not in (*keys, "fonti", "_primario")]
    each = [x for f in fields for x in (F.col(f"{f}.valore").alias(f), F.col(f"{f}.fonte").alias(f"{f}_fonte"))]
    return state.select(*keys, *each, F.col("_primario.url").alias("url"), F.col("_primario.fonte").alias("fonte"), "fonti")


def merged(sightings: DataFrame, keys: list[str], fields: list[str], **names) -> DataFrame:
    """Sightings of each key as one row, field by field."""
    return finish(states(sightings, keys, fields, **names), keys)


def into_state(path: str, keys: list[str], fields: list[str], **names):
    """A merge for ``streaming.jobs.into_table``: each batch's states are written by epoch, and folded when they are read.

    A batch that is done again replaces what it wrote, and a state counts once however often it is merged.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        states(batch, keys, fields, **names).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return merge


def read_state(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The state after all batches so far."""
    return combine(spark.read.parquet(path).drop("epoch"), keys)


def compact(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The state of many batches as one table, to go on from."""
    return storage.stored(read_state(spark, path, keys), "state")
