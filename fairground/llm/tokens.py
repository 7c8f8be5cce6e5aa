"""Token-id files: whole texts as ids of a public tokenizer, in Parquet list columns, written in document order.

Ids are dictionary-encoded, document ids and counts delta-encoded; row groups and pages have set sizes, and the page
indexes on the ascending document id let a reader fetch a few documents' tokens, or no tokens at all, without a scan.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairground.llm.common import Scratch, concat, slices, text_column

#: Parquet settings of the files. The dictionary holds a whole vocabulary of 64k ids.
FILE_OPTIONS = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#tokens.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "5000",
}


#: A run of letters that the normaliser leaves as it is and the splitter keeps whole, and punctuation after it. The
#: apostrophe is left out as it starts contractions.
RUN = r"^(?P<letters>[a-zß-öø-ÿ]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"


def gather(flat: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` named by ``codes``, in turn, and the bounds between them."""
    starts = np.cumsum(lengths) - lengths
    own = lengths[codes]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts[codes] - (ends - own), own)
    at += np.arange(total)
    return flat[at], np.concatenate([[0], ends])


class Encoder:
    """Encodes texts of an Arrow column, each distinct stretch between ASCII white space once.

    The tokenizer's normaliser and splitter never join across white space, so a text's ids are the ids of its
    stretches in turn; a run of letters and the punctuation after it are split as well, so their ids are taken apart.
    Runs of letters go to the tokenizer many at a time without its normaliser and splitter, which leave them alone;
    the mark of a word's last piece tells them apart again. All other stretches, and texts that hold one of the
    tokenizer's own added tokens, are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok, self.runs = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.runs.normalizer = None
        self.runs.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocabulary = self.tok.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True

    def _letters(self, words: list[str], many: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of letters and the number of each."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        joined = [" ".join(words[i : i + many]) for i in range(0, len(words), many)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.runs.encode_batch_fast(joined, add_special_tokens=False)])
        return ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1)

    def _whole(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tok.encode_batch_fast(stretches, add_special_tokens=False)]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(lengths.sum())), lengths

    def _stretches(self, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct stretches and the number of each."""
        parts = pc.extract_regex(stretches, RUN)
        simple = pc.is_valid(parts)
        runs = pc.struct_field(parts, "letters").filter(simple).dictionary_encode()
        rest = pa.concat_arrays([pc.struct_field(parts, "tail").filter(simple), stretches.filter(pc.invert(simple))]).dictionary_encode()
        (a, a_len), (b, b_len) = self._letters(runs.dictionary.to_pylist()), self._whole(rest.dictionary.to_pylist())
        # Each stretch is a run of letters and a tail, or nothing and a stretch that was encoded whole.
        lengths = np.concatenate([a_len, b_len, [0]])
        simple = simple.to_numpy(zero_copy_only=False).astype(bool)
        pair = np.full((len(stretches), 2), len(lengths) - 1)
        pair[simple, 0] = runs.indices.to_numpy()
        others = len(a_len) + rest.indices.to_numpy()
        n = int(simple.sum())
        pair[simple, 1], pair[~simple, 1] = others[:n], others[n:]
        flat, cuts = gather(np.concatenate([a, b]), lengths, pair.ravel())
        return flat, np.diff(cuts[::2])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as one uint32 array, and each text's bounds in it."""
        texts = pc.fill_null(texts, "")
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False).astype(bool)
        plain = pc.if_else(pa.array(whole), "", texts) if whole.any() else texts
        lists = pc.ascii_split_whitespace(plain)
        bounds = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        # Lower-casing ASCII stretches early merges more of them; others are left to the tokenizer, which composes first.
        seen = coded.dictionary
        seen = pc.if_else(pc.string_is_ascii(seen), pc.ascii_lower(seen), seen).dictionary_encode()
        codes = seen.indices.to_numpy()[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        ids, ends = gather(*self._stretches(seen.dictionary), codes)
        cuts = ends[bounds - bounds[0]]
        if not whole.any():
            return ids, cuts
        parts = [self.tok.encode(texts[i].as_py(), add_special_tokens=False).ids if whole[i] else ids[cuts[i] : cuts[i + 1]] for i in range(len(texts))]
        parts = [np.asarray(p, np.uint32) for p in parts]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder a Python worker, kept from task to task."""
    return Encoder(path)


def with_end(ids: np.ndarray, cuts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text."""
    return np.insert(ids, cuts[1:], end_id).astype(np.uint32), cuts + np.arange(len(cuts))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write ``doc_id``, ``n_tokens`` and ``tokens`` of every document to Parquet files in ascending ``doc_id`` order.

    Null text counts as empty (the end id alone); a null id comes first; rows that share an id are ordered by text.
    Other columns are ignored. The rows are range-partitioned once, before encoding, so a long or common source is
    spread by id like any other.
    """

    def encode(batches):
        for batch in slices(batches):
            ids, cuts = with_end(*encoder(tokenizer).encode(concat(batch.column("text"))), end_id)
            tokens = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(cuts).astype(np.int32)), tokens], ["doc_id", "n_tokens", "tokens"])

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs)).repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, "doc_id long, n_tokens int, tokens array<int>").write.options(**FILE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``file`` and ``row``, which order them within the whole."""
    rows = spark.read.schema("doc_id long, n_tokens int, tokens array<int>").parquet(path)
    return rows.select("doc_id", "n_tokens", "tokens", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def token_spans(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids before it), ``n_tokens`` and ``ids_crc32``.

    Counts and checksums come from the ids as read. Files are summed first, so that only one row a file is ordered as
    a whole; within a file a running sum follows the rows.
    """

    def sums(batches):
        for batch in slices(batches):
            lists = batch.column("tokens")
            cuts = lists.offsets.to_numpy().astype(np.int64)
            ids = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False)).astype("<u4").tobytes())
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("file"), batch.column("row"), pa.array(np.diff(cuts)), pa.array(crc, pa.int64())], ["doc_id", "file", "row", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).select("doc_id", "file", "row", "tokens").mapInArrow(sums, "doc_id long, file string, row long, n_tokens long, ids_crc32 long")
    files = spark.read.schema("doc_id long, n_tokens int, tokens array<int>").parquet(path).select("doc_id", "n_tokens", F.col("_metadata.file_path").alias("file"))
    before = Window.orderBy(F.col("first").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("first")).select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return ranked.join(bases, "file").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the token files to the shared folder and describe each document from what is read back."""
    path = Scratch(spark, "tokens").path("files")
    write_tokens(docs, path, tokenizer, end_id)
    return token_spans(spark, path)
