"""The corpus pipeline: quality rules, one document per group of similar ones, repeated passages out, packing.

``run`` applies ``STAGES`` to the documents table.  Each stage gets what its predecessor kept, written to the folder
all executors share and read again, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import jaccard, packing, quality, repeats
from wattlake.session import stored


def carried(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``carried``, one column with all other ones, so that their names cannot clash with a stage's."""
    others = [F.col(f"`{name}`").alias(f"c{place}") for place, name in enumerate(docs.columns) if name not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(True).alias("is_row"), *others).alias("carried"))


def restored(rows: DataFrame, docs: DataFrame, measured: bool = False) -> DataFrame:
    """The columns of ``docs`` from rows with doc_id, text and ``carried``; if ``measured``, n_chars follows the text."""
    columns = []
    for place, name in enumerate(docs.columns):
        value = F.col(name) if name in ("doc_id", "text") else F.col(f"carried.c{place}")
        if measured and name == "n_chars":
            value = F.length("text").cast(docs.schema[name].dataType)
        columns.append(value.alias(name))
    return rows.select(*columns)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the others go."""
    return restored(quality.quality(carried(docs), keep=["doc_id", "text", "carried"]).where("kept"), docs)


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest id; a row without words stays.

    Of rows with the same id and text one stays; null ids come last.  Rows are told apart by a hash of 128 bits of id
    and text.
    """
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
             F.when(F.col("text").isNull(), "null").otherwise(F.concat(F.lit("text"), F.col("text")))]
    rows = carried(docs).withColumn("row", F.unhex(F.md5(F.concat_ws("/", *parts))))
    groups = jaccard.similar_groups(rows.select("doc_id", "text", "row"), keep=("row",))
    chosen = groups.where("n_shingles > 0").groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("of")).select("of.row")
    chosen = stored(chosen.unionByName(groups.where("n_shingles = 0").select("row")).distinct(), "chosen")
    return restored(rows.join(chosen, "row", "left_semi").dropDuplicates(["row"]), docs)


def new_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have; whole characters go, and n_chars follows the text."""
    kept = repeats.remove_repeats(carried(docs), keep=("carried",), characters=True)
    return restored(kept.withColumn("text", F.col("kept").cast("string")), docs, measured=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed along the curve."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", good_documents), ("n-gram Jaccard join", different_documents),
          ("suffix-array dedup", new_passages), ("packing", packed)]
ORACLE_SQL = None         # compression ratios and tokenizers are beyond SQL; the tests hold a small run against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
