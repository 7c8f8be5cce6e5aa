"""Helpers shared by the operators: scratch tables in the shared folder, and word hashing in Arrow batches."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_ROOT: list[str] = []
#: Bytes of an Arrow batch between Spark and a worker, where the session names none: both sides hold a batch whole.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``); a temporary one only where all run on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir names no shared folder for the tables between steps")
    if not _OWN_ROOT:
        _OWN_ROOT.append("file://" + tempfile.mkdtemp(prefix="fairground-"))
    return _OWN_ROOT[0]


class Scratch:
    """Tables written once to the shared folder and read again: they cut lineage and survive the loss of executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        if spark.conf.get(_BATCH_SETTING, None) is None:
            spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
        self.base = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def table(self, name: str, df: DataFrame, **options) -> DataFrame:
        df.write.options(**options).parquet(self.path(name))
        return self.read(name, df.schema)

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Empty tables that no later step reads: an overwrite with no rows deletes their files."""
        for name in names:
            self.spark.createDataFrame([], "gone int").write.mode("overwrite").parquet(self.path(name))


def text_column(df: DataFrame, name: str = "text"):
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def concat(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # only the GNU C library has it
    _trim = None


def give_back() -> None:
    """Freed memory back to the system: a worker lives through many stages, and what one leaves lies beside the next."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batches, max_bytes: int = 8 << 20):
    """Record batches cut into runs of whole rows of about ``max_bytes``, so that working memory stays bounded."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, int(n * max_bytes / max(batch.nbytes, 1)))
        for at in range(0, n, step):
            yield batch.slice(at, step)
        give_back()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of each text, split at ASCII white space, as one array, and each text's bounds in it."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    bounds = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = bounds - bounds[0]
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False).astype(bool)
    if not full.all():
        kept = np.concatenate([[0], np.cumsum(full)])
        words, bounds = words.filter(pa.array(full)), kept[bounds]
    return words, bounds


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process; each distinct word is hashed once."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    hashes = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    return hashes[coded.indices.to_numpy()]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each run of ``k`` words; fewer words make one shingle of all, none make none."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for j in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[j : n - width + 1 + j])
    return out


def free_name(wanted: str, *taken: str) -> str:
    """``wanted``, with underscores behind it until it is none of the names taken, in any case."""
    names = {t.lower() for t in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def drawn(share: float, *of, salt: int = 0):
    """Whether a row is among ``share`` of all rows, by 62 bits of a hash: fine enough for one row in 10**18."""
    return F.xxhash64(*of, F.lit(salt)).bitwiseAND((1 << 62) - 1) < F.lit(int(min(1.0, share) * (1 << 62)))


def runs(batches, keys: list[str]):
    """Batches of a sorted stream, cut so that rows with equal keys are never in two of them."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in keys]
        at = batch.num_rows
        while at and all(batch.column(k)[at - 1].equals(v) for k, v in zip(keys, last)):
            at -= 1
        if at:
            yield pa.Table.from_batches([*rest, batch.slice(0, at)]).combine_chunks()
            rest = [batch.slice(at)]
        elif rest and not all(rest[-1].column(k)[rest[-1].num_rows - 1].equals(v) for k, v in zip(keys, last)):
            yield pa.Table.from_batches(rest).combine_chunks()
            rest = [batch]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()
