import public_tokenizers
import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text, source) as a documents table."""

    def made(rows, partitions=3):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, DOCUMENT).repartition(partitions)

    return made


@pytest.fixture
def awkward(documents):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} item{i}." for i in range(20_000))
    rows = [(1, None, "a"), (2, "", "a"), (3, "   \n\t ", None), (None, "no id here", "b"), (None, None, None)]
    rows += [(4, "twice the same row", "b")] * 3 + [(5, "same text", "a"), (6, "same text", "b"), (7, long, "a"), (8, "漢字かな交じり文", "c")]
    return documents(rows).selectExpr("*", "1 AS size", "'x' AS kept", "2 AS shard", "3 AS copies", "'y' AS fp")


@pytest.fixture
def bpe():
    return public_tokenizers.path("byte_bpe_50k.json")
