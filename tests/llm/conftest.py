import pytest

ODD = [(1, "All rights reserved.  CC BY 4.0\nAll rights reserved"), (2, None), (3, ""), (4, "  \n\t "), (5, "one"),
       (5, "one"), (None, "a text without id"), (7, "é日本🙂 <|endoftext|> <b> x" * 3), (8, "word " * 3000), (9, "ab" * 4000)]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty and long texts, repeated rows, and columns called like results."""
    rows = [(*row, 1, "x", 2.5) for row in ODD]
    return spark.createDataFrame(rows, SCHEMA + ", n_words int, labels string, shard double")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
