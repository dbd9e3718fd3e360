import pytest
from pyspark.sql import functions as F

import brute

SCHEMA = "doc_id long, text string, lang string, source string"
# names that the operators use inside
CLASHES = ["row", "key", "s", "size", "item", "draw", "id", "hash", "class", "spans", "lang_pred", "shard", "n_words", "n", "weight"]


@pytest.fixture(scope="session")
def awkward(spark):
    """(rows, DataFrame): nulls in every column, empty and long texts, copies,
    rows that repeat as a whole, null and repeated ids, clashing columns."""
    texts = brute.corpus()
    langs, sources = ["en", "de", "fr", None], ["web", "books", "code", None, "a"]
    rows = [(i, t, langs[i % 4], sources[i % 5]) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[9], (None, texts[4], None, None), (None, None, None, "web"), (5, texts[8], "en", "web")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return rows, df.withColumns({c: F.lit(7) for c in CLASHES})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
