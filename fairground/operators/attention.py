"""When a source deserves a visit: seasons from its past events, and what its errors say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days before and after a past event's date in which its source is watched, years of history, the age of the
#: oldest event that makes a history, and days between visits inside and outside a season.
BEFORE, AFTER, YEARS, OLD_ENOUGH = 60, 5, 3, 300
OFTEN, SELDOM = 3, 18
#: Days of a bucket: a window lies in two of them at most.
BUCKET = 128

#: What the message of a failed visit says of its kind, in the order in which they are tried.
KINDS = {
    "blocco": r"(?i)\b(403|429)\b|captcha|forbidden|too many requests",
    "permanente": r"(?i)\b(404|410)\b|not found|domain expired|dominio scaduto|sito dismesso",
    "struttura": r"(?i)struttura cambiata|nessun annuncio estratto",
}
#: Days without another outcome after which a lasting error breaks a source, days until a broken one is tried
#: again, and days to hold off after the first, second and any further block in a row.
BROKEN_DAYS, RETRY_BROKEN, HOLD = 14, 30, (7, 14, 30)


def seasons(history: DataFrame, since: Column, until: Column) -> DataFrame:
    """``source_id, inizio, fine``: the stretches of days from ``since`` to ``until`` in which a source is in season.

    ``history``: ``source_id, data_inizio``. Each event of the three years before ``since`` opens a window around its date in
    later years; windows that touch are one, over the turn of the year as well. A source whose oldest event is younger than
    300 days has no season yet. Events without a date, or yet to come, count for nothing.
    """
    day = F.to_date("data_inizio")
    past = history.select("source_id", day.alias("_d")).where((F.col("_d") < since) & (F.col("_d") >= F.add_months(since, -12 * YEARS)) & F.col("source_id").isNotNull()).distinct()
    known = past.groupBy("source_id").agg(F.min("_d").alias("_first")).where(F.datediff(since, F.col("_first")) >= OLD_ENOUGH).select("source_id")
    years = F.sequence(F.lit(1), F.lit(YEARS + 1) + F.year(until) - F.year(since))
    again = past.join(known, "source_id", "left_semi").select("source_id", F.explode(F.transform(years, lambda k: F.add_months(F.col("_d"), k * 12))).alias("_at"))
    windows = again.select("source_id", F.date_sub("_at", BEFORE).alias("inizio"), F.date_add("_at", AFTER).alias("fine")).where((F.col("fine") >= since) & (F.col("inizio") <= until))
    # Gaps and islands: a window that begins behind all before it, and a day more, opens a stretch.
    order = Window.partitionBy("source_id").orderBy("inizio", "fine")
    reach = F.max("fine").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = windows.withColumn("_new", F.coalesce((F.col("inizio") > F.date_add(reach, 1)).cast("int"), F.lit(1)))
    numbered = marked.withColumn("_n", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("source_id", "_n").agg(F.min("inizio").alias("inizio"), F.max("fine").alias("fine")).drop("_n")


def in_season(days: DataFrame, stretches: DataFrame, day: str = "giorno") -> DataFrame:
    """``giorno, source_id``: the sources in season on each of ``days``, by buckets that a day and a stretch share."""
    at = lambda c: F.floor(F.unix_date(c) / BUCKET)
    spread = stretches.select("*", F.explode(F.sequence(at(F.col("inizio")), at(F.col("fine")))).alias("_b"))
    asked = days.select(F.to_date(day).alias(day)).where(F.col(day).isNotNull()).distinct().withColumn("_b", at(F.col(day)))
    return asked.join(spread, "_b").where(F.col(day).between(F.col("inizio"), F.col("fine"))).select(day, "source_id")


def next_visits(sources: DataFrame, stretches: DataFrame, as_of: Column) -> DataFrame:
    """``source_id, in_stagione, prossima_visita``: often in season, seldom outside it, but never not at all; now if never."""
    now = stretches.where(as_of.between(F.col("inizio"), F.col("fine"))).select("source_id").distinct().withColumn("_in", F.lit(True))
    rows = sources.select("source_id", F.to_date(F.left("last_run", F.lit(10))).alias("_last")).join(now, "source_id", "left")
    inside = F.coalesce("_in", F.lit(False))
    return rows.select("source_id", inside.alias("in_stagione"), F.coalesce(F.date_add("_last", F.when(inside, OFTEN).otherwise(SELDOM)), as_of).alias("prossima_visita"))


def error_kind(message: Column) -> Column:
    """``blocco``, ``permanente``, ``struttura``, else ``transitorio``; null for a visit that did not fail."""
    out = F.lit("transitorio")
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(message.rlike(pattern), kind).otherwise(out)
    return F.when(message.isNotNull(), out)


def last_stretch(outcomes: DataFrame) -> DataFrame:
    """``source_id, classe, dal, al, n, intera``: of ``outcomes(source_id, ts, errore)`` the last stretch of outcomes of one
    kind of each source, and whether there is nothing before it. A success is of kind ``riuscita``.

    Outcomes of one time go by their kind. The stretch is found by what came last of another kind, in two aggregates, so no
    source's outcomes are put in order in one task.
    """
    rows = outcomes.select("source_id", F.col("ts").cast("timestamp").alias("ts"), F.coalesce(error_kind(F.col("errore")), F.lit("riuscita")).alias("classe")).where("source_id is not null and ts is not null")
    kinds = rows.groupBy("source_id", "classe").agg(F.max("ts").alias("_last"))
    last = kinds.groupBy("source_id").agg(F.max(F.struct("_last", "classe")).alias("_l"))
    # The latest of any other kind: what is after it is the stretch.
    other = kinds.join(last, "source_id").where(F.col("classe") != F.col("_l.classe")).groupBy("source_id").agg(F.max(F.struct("_last", "classe")).alias("_o"))
    ends = last.join(other, "source_id", "left").select("source_id", F.col("_l.classe").alias("_kind"), F.col("_o._last").alias("_before"), F.col("_o.classe").alias("_other"))
    after = F.col("_before").isNull() | (F.col("ts") > F.col("_before")) | ((F.col("ts") == F.col("_before")) & (F.col("classe") > F.col("_other")))
    mine = rows.join(ends, "source_id").where((F.col("classe") == F.col("_kind")) & after)
    return mine.groupBy("source_id", "classe").agg(F.min("ts").alias("dal"), F.max("ts").alias("al"), F.count("*").alias("n"), F.bool_and(F.col("_before").isNull()).alias("intera"))


def continued(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The last stretches after a later batch: one that fills its whole batch and is of the stored kind goes on with it."""
    old = stored.select("source_id", *(F.col(c).alias(f"_{c}") for c in ("classe", "dal", "al", "n", "intera")))
    both = old.join(batch, "source_id", "full_outer")
    on = F.col("intera") & (F.col("classe") == F.col("_classe"))
    pick = lambda c, going: F.when(F.col("classe").isNull(), F.col(f"_{c}")).when(on, going).otherwise(F.col(c)).alias(c)
    whole = F.when(F.col("_classe").isNull(), F.col("intera")).otherwise(F.lit(False))
    return both.select("source_id", pick("classe", F.col("classe")), pick("dal", F.col("_dal")), pick("al", F.col("al")), pick("n", F.col("n") + F.col("_n")), F.when(F.col("classe").isNull(), F.col("_intera")).when(on, F.col("_intera")).otherwise(whole).alias("intera"))


def verdicts(stretches: DataFrame) -> DataFrame:
    """``source_id, classe, giorni, stato, segnalata, riprova_dal`` of each source's last stretch.

    Days count, not visits. A lasting error of 14 days breaks a source, which is still tried once a month; a block is waited
    out, longer each time, and never breaks; a page that gives nothing any more is told, without a pause; the first success
    makes a source active again.
    """
    days = F.datediff("al", "dal")
    broken = (F.col("classe") == "permanente") & (days >= BROKEN_DAYS)
    hold = F.element_at(F.array(*map(F.lit, HOLD)), F.least(F.col("n"), F.lit(len(HOLD))).cast("int"))
    pause = F.when(broken, RETRY_BROKEN).when(F.col("classe") == "blocco", hold).otherwise(F.lit(0))
    told = broken | (F.col("classe") == "struttura")
    return stretches.select("source_id", "classe", days.alias("giorni"), F.when(broken, "rotta").otherwise("attiva").alias("stato"), told.alias("segnalata"), F.date_add(F.to_date("al"), pause).alias("riprova_dal"))


def mark_broken(sources: DataFrame, judged: DataFrame) -> DataFrame:
    """Sources with the state that ``verdicts`` give them; what an operator has excluded stays, and so do those not visited."""
    own = judged.select("source_id", F.col("stato").alias("_s"))
    rows = sources.join(own, "source_id", "left")
    return rows.withColumn("stato", F.when(F.col("_s").isNull() | ~F.coalesce("stato", F.lit("attiva")).isin("attiva", "rotta"), F.col("stato")).otherwise(F.col("_s"))).drop("_s")
