"""Helpers that several operators share: reading tables, walking Arrow batches, ragged arrays, caches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20        # text handled at once inside a task
CACHE_WORDS = 400_000        # entries a worker's word cache may hold; later words are computed each time


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``limit`` bytes in ``column``; a longer row stands alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start, n = 0, batch.num_rows
        while start < n:
            base = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column, null as empty."""
    return [value or "" for value in batch.column(column).to_pylist()]


def binaries(items: list[bytes | None]) -> pa.Array:
    return pa.array(items, pa.binary())


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[0].., starts[1].., … of runs with the given lengths, one after another."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - before, lengths)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64).copy()
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class WordCache(dict):
    """Computes a word's value at its first use and keeps it while there is room."""

    def __init__(self, compute: Callable, room: int = CACHE_WORDS):
        super().__init__()
        self.compute, self.room = compute, room

    def __missing__(self, word):
        value = self.compute(word)
        if len(self) < self.room:
            self[word] = value
        return value


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions the session is set to; bucket counts follow it, as it follows the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


MERGE_PARTS = 32


def best_rows(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key with their ``rank``, in two steps: a key's rows are first dealt over several tasks.

    For partial results, whose number grows with the tasks that made them.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(MERGE_PARTS))
    first = Window.partitionBy(*keys, "part_of_key").orderBy(*order)
    last = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("part_of_key", part).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k) \
        .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).drop("part_of_key")
