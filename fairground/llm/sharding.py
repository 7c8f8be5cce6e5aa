"""Hilbert-curve sharding with DataFrame functions alone.

Each dimension is quantised into ``2**bits`` steps of near equal depth; the cell of a row is placed on a Hilbert curve;
rows in curve order are cut into shards whose row counts differ by one at most. Neighbouring cells share a shard, so a
file's minimum and maximum of every dimension stay narrow and readers can skip files by any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairground.llm.common import Scratch

#: Rows of one file of the stored table: the most that one task ever orders of a single cell.
FILE_ROWS = 500_000


def number_marks(rows: DataFrame, names: list[str], steps: int) -> dict[str, list]:
    """The ``steps - 1`` quantiles of each column over all rows, without repeats; nulls do not count."""
    if not names:
        return {}
    at = [i / steps for i in range(1, steps)]
    cuts = rows.agg(*(F.percentile_approx(n, at, 10_000).alias(n) for n in names)).first()
    return {n: sorted(set(cuts[n] or ())) for n in names}


def text_marks(rows: DataFrame, name: str, steps: int, scratch: Scratch) -> list[str]:
    """The quantiles of a string column in the order of whole strings, without repeats; nulls do not count.

    Values are counted first, so a value with a third of all rows is one row. The counts are sorted into files by
    ranges of the value; files are summed, and within a file a running sum says where each quantile falls.
    """
    counts = scratch.table(f"values-{name}", rows.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n")).orderBy("value"))
    located = counts.withColumn("file", F.col("_metadata.file_path"))
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = located.groupBy("file").agg(F.min("value").alias("first"), F.sum("n").alias("m"))
    bases = files.select("file", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"), F.sum("m").over(Window.partitionBy(F.lit(0))).alias("total"))
    upto = F.col("base") + F.sum("n").over(Window.partitionBy("file").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    step = lambda rank: F.least(F.floor(rank * steps / F.col("total")), F.lit(steps - 1))
    # A value holds a quantile if its rows reach over the border of a step.
    placed = located.join(bases, "file").withColumn("upto", upto).where(step(F.col("upto")) > step(F.col("upto") - F.col("n")))
    return sorted(r["value"] for r in placed.select("value").collect())  # at most ``steps`` of them


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """The place of a cell on the Hilbert curve through ``2**bits`` steps of each axis.

    Follows Skilling's transposed form: from the highest bit down, an axis with the bit set flips the lower bits of the
    first axis, one without swaps them with it; a Gray code over the axes and interleaving of bits finish. The steps
    fold over a sequence with ``aggregate``, which suits the few distinct cells it is meant for.
    """
    n = len(axes)

    def step(x: Column, s: Column) -> Column:
        bit, axis = F.element_at(F.array(*(F.lit(1 << b) for b in range(bits - 1, -1, -1))), F.floor(s / n).cast("int") + 1), s % n
        low = bit - 1
        mine, first = F.element_at(x, axis + 1), F.element_at(x, 1)
        flip = mine.bitwiseAND(bit) != 0
        swap = first.bitwiseXOR(mine).bitwiseAND(low)
        new_first = F.when(flip, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap))
        return F.transform(x, lambda v, i: F.when(i == 0, new_first).when((i == axis) & ~flip, v.bitwiseXOR(swap)).otherwise(v))

    start = F.array(*(a.cast("int") for a in axes))
    turned = F.aggregate(F.sequence(F.lit(0), F.lit(n * bits - 1)), start, step) if bits > 1 or n > 1 else start
    gray = F.aggregate(F.sequence(F.lit(1), F.lit(n - 1)), turned, lambda x, i: F.transform(x, lambda v, j: F.when(j == i, v.bitwiseXOR(F.element_at(x, i))).otherwise(v))) if n > 1 else turned

    def parity(x: Column) -> Column:
        last, t = F.element_at(x, n), F.lit(0)
        for b in range(bits - 1, 0, -1):
            t = F.when(last.bitwiseAND(1 << b) != 0, t.bitwiseXOR((1 << b) - 1)).otherwise(t)
        return t

    done = F.transform(F.array(F.struct(gray.alias("x"), parity(gray).alias("t"))), lambda p: F.transform(p["x"], lambda v: v.bitwiseXOR(p["t"])))[0]
    index = F.lit(0).cast("long")
    return F.transform(F.array(done), lambda x: sum(
        (F.shiftleft(F.shiftright(F.element_at(x, i + 1), b).bitwiseAND(1).cast("long"), b * n + n - 1 - i) for b in range(bits) for i in range(n)), index))[0]


def hilbert_shards(spark: SparkSession, rows: DataFrame, dims: dict[str, Column], shards: int, bits: int = 4) -> DataFrame:
    """Add ``curve`` (long), ``shard`` and ``slot``: rows in curve order, cut into ``shards`` even runs.

    Row counts of shards differ by one at most; ``slot`` numbers a shard's rows from 0. A dimension is a number or a
    string; strings are ranked whole. Null is the lowest step, equal values share one. Rows of one cell, equal ones
    too, follow the order in which they are stored: the table is written once with its dimensions, and ranks are
    counted within each file of at most ``FILE_ROWS`` rows and over the files, so a cell with a third of all rows is
    never ordered in one task. There are at most ``2**(bits * len(dims))`` cells, which bounds what is broadcast. An
    empty table gives no rows. Columns named as those added are replaced by them.
    """
    scratch = Scratch(spark, "sharding")
    kept = [c for c in rows.columns if c.lower() not in ("curve", "shard", "slot")]
    names = [f"d{i}" for i in range(len(dims))]
    made = rows.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("r"), *(d.alias(n) for n, d in zip(names, dims.values())))
    stored = scratch.table("rows", made, maxRecordsPerFile=FILE_ROWS)
    kinds = dict(stored.dtypes)
    texts = [n for n in names if kinds[n] == "string"]
    marks = number_marks(stored, [n for n in names if n not in texts], 2**bits) | {n: text_marks(stored, n, 2**bits, scratch) for n in texts}
    above = lambda n: sum((F.when(F.col(n) > F.lit(m), 1).otherwise(0) for m in marks[n]), F.lit(0)).cast("int").alias(f"q{n}")
    axes = [f"q{n}" for n in names]
    coded = stored.select("r", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), *map(above, names))

    counts = scratch.table("counts", coded.groupBy(*axes, "file").agg(F.count("*").alias("n")))
    cells = counts.groupBy(*axes).agg(F.sum("n").alias("m")).withColumn("curve", hilbert_index([F.col(a) for a in axes], bits))
    upto = F.sum("m").over(Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1))  # one row a cell
    cells = scratch.table("cells", cells.select(*axes, "curve", F.coalesce(upto, F.lit(0)).alias("cell_base"), F.sum("m").over(Window.partitionBy(F.lit(0))).alias("total")))
    earlier = F.sum("n").over(Window.partitionBy(*axes).orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.withColumn("in_cell", F.coalesce(earlier, F.lit(0))).join(F.broadcast(cells), axes).select(*axes, "file", "curve", (F.col("cell_base") + F.col("in_cell")).alias("base"), "total")
    local = F.row_number().over(Window.partitionBy("file", *axes).orderBy("row")) - 1
    ranked = coded.withColumn("local", local).join(bases, ["file", *axes]).withColumn("rank", F.col("base") + F.col("local"))
    # The first total % shards shards hold one row more than the rest.
    small, extra = F.floor(F.col("total") / shards), F.col("total") % shards
    wide = extra * (small + 1)
    shard = F.when(F.col("rank") < wide, F.floor(F.col("rank") / (small + 1))).otherwise(extra + F.floor((F.col("rank") - wide) / F.greatest(small, F.lit(1)))).cast("int")
    slot = F.col("rank") - F.col("shard") * small - F.least(F.col("shard"), extra)
    return ranked.withColumn("shard", shard).select("r.*", "curve", "shard", slot.cast("long").alias("slot"))


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shard documents by language, source and size; one row a document, without its text.

    Null language, source or text take the lowest step; null and empty text have size 1 and checksum 0. Repeated rows
    are placed once each; ties follow the order of the stored rows. Other columns are ignored. ``grown_shard`` is null:
    the law is ``rows``, not ``key``.
    """
    size = F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long") + 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    placed = hilbert_shards(spark, rows, {"lang": F.col("lang"), "source": F.col("source"), "size": F.col("size")}, shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
