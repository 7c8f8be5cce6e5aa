"""A corpus pipeline of five stages over ``documents``, from quality filtering to packed sequences.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``docs`` as they are. Null and empty texts pass through every stage but the first,
which may reject them like any text; rows without an id or with a shared one count each; texts are read whole; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairground.llm import decontamination, ngram_join, packing, pii, quality
from fairground.llm.common import Scratch
from fairground.llm.queries import END_ID, PII_KEY, table, tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject; all of them where the labels do not tell two classes.

    Repeated rows, and rows that share an id and a text, are kept or rejected alike.
    """
    return quality.keep_good(spark, docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more.

    The row with the smallest id stays, one without an id only where none has one, among equals the first stored. Rows
    without words stay, but for those that repeat another's id and text.
    """
    return ngram_join.keep_one_of_each(spark, docs, k=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no test item is covered by half; rows with equal texts stay or go together."""
    return decontamination.without_contaminated(spark, docs, table(spark, sf_dir, "benchmark"), seed=5, threshold=0.5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and ``n_chars`` of the new text (null where the text is null)."""
    out = pii.replace_personal_data(spark, docs, PII_KEY)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 ids.

    Null text is the end id alone; pieces of one length are placed in the order in which they are stored.
    """
    return packing.pack_documents(spark, docs, tokenizer_path(), END_ID, max_len=2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("sequence_packing", sequence_packing),
]

#: A fitted classifier and a tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
