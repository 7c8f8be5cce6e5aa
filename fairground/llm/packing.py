"""Sequence packing: shortest-pack-first over the histogram of piece lengths.

The histogram has at most ``max_len`` rows whatever the corpus, so the plan of packs is made from it alone; the pieces
then find their places by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairground.llm.common import Scratch, concat, slices, text_column
from fairground.llm.tokens import encoder, with_end

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def plan_packs(histogram: dict[int, int], max_len: int) -> list[tuple[tuple[int, ...], int]]:
    """Packs as ``(lengths, how many)``: lengths go longest first, each onto the shortest packs that have room.

    Packs with the same lengths are one pattern with a count; placing a length splits a pattern's count at most once.
    A length that finds no pack with room opens new ones, as many of it in each as fit. Lengths of 0 go nowhere.
    """
    by_total: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    full: list[tuple[tuple[int, ...], int]] = []

    def keep(lengths: tuple[int, ...], count: int) -> None:
        (full if sum(lengths) == max_len else by_total[sum(lengths)]).append((lengths, count))

    for length in sorted((n for n in histogram if n > 0), reverse=True):
        left = histogram[length]
        while left:
            total = min(by_total, default=max_len)
            if total + length > max_len:
                fit = max_len // length
                for n, packs in ((fit, left // fit), (left % fit, 1)):
                    if n and packs:
                        keep((length,) * n, packs)
                break
            lengths, count = by_total[total].pop()
            used = min(left, count)
            if count > used:
                by_total[total].append((lengths, count - used))
            elif not by_total[total]:
                del by_total[total]
            keep((*lengths, length), used)
            left -= used
    merged = Counter()
    for lengths, count in [*full, *(p for packs in by_total.values() for p in packs)]:
        merged[lengths] += count
    return sorted(merged.items(), reverse=True)


def seats(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows ``length, first_rank, per_pack, first_sequence, offset`` in order of length and rank.

    Of a length's pieces in order of rank, those from ``first_rank`` on fill the packs from ``first_sequence`` on, with
    ``per_pack`` pieces in each, the first of them at ``offset``.
    """
    rows, taken, sequence = [], Counter(), 0
    for lengths, count in plan:
        offset = 0
        for length, per_pack in sorted(Counter(lengths).items(), reverse=True):
            rows.append((length, taken[length], per_pack, sequence, offset))
            taken[length] += per_pack * count
            offset += length * per_pack
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, max_len: int) -> DataFrame:
    """Each document's ids with the end id, cut every ``max_len`` ids."""

    def cut(batches):
        for batch in slices(batches):
            ids, cuts = with_end(*encoder(tokenizer).encode(concat(batch.column("text"))), end_id)
            n = np.diff(cuts)
            pieces = -(-n // max_len)
            doc = np.repeat(np.arange(len(n)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * max_len
            length = np.minimum(max_len, n[doc] - start)
            raw, at = memoryview(ids.astype("<u4").tobytes()), (cuts[doc] + start) * 4
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at, at + 4 * length)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[doc])], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs)).mapInArrow(cut, PIECES)


def place_pieces(spark: SparkSession, pieces: DataFrame, scratch: Scratch, max_len: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (``length`` from 1 to ``max_len``).

    Ranks are counted in two steps, within a file of the stored table and over the files, so that a very common length
    is never ordered in one task.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most max_len rows
    table = seats(plan_packs(histogram, max_len))
    keys = table[:, 0] * (1 << 40) + table[:, 1]
    located = pieces.withColumns({"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})
    before = Window.partitionBy("length").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = located.groupBy("length", "file").agg(F.count("*").alias("n")).select("length", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    local = F.row_number().over(Window.partitionBy("length", "file").orderBy("row")) - 1
    ranked = located.withColumn("local", local).join(bases, ["length", "file"]).withColumn("rank", F.col("base") + F.col("local")).drop("base", "local", "file", "row")
    kept = [c for c in ranked.columns if c != "rank"]

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            seat = table[np.searchsorted(keys, length * (1 << 40) + rank, side="right") - 1]
            nth = rank - seat[:, 1]
            columns = [pa.array(seat[:, 3] + nth // seat[:, 2]), pa.array(seat[:, 4] + nth % seat[:, 2] * length)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, max_len: int = 2048) -> DataFrame:
    """Pack every document into sequences of at most ``max_len`` ids; one row a piece.

    Null and empty text are the end id alone; long texts are cut into as many pieces as they need. Pieces of one length
    are placed in the order in which they are stored; repeated rows are packed once each, whatever their ids. Other
    columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(spark, "packing")
    pieces = scratch.table("pieces", cut_documents(docs, tokenizer, end_id, max_len))
    return place_pieces(spark, pieces, scratch, max_len)
