import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """Documents from texts: ids from 0, with a column whose name an operator uses inside."""

    def build(*texts, **columns):
        rows = [(i, t, columns.get("lang", ["en"] * len(texts))[i], columns.get("source", ["src0"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)]
        from pyspark.sql import functions as F

        return spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit(1), "curve": F.lit("x")})

    return build


@pytest.fixture
def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")
