"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

1. Rows fall into buckets by a hash of their identifying columns, and the rows of each bucket are counted.
2. The matrix "rows from bucket b to shard s" is drawn on the driver, as if all rows had been dealt at random:
   bucket after bucket takes a multivariate hypergeometric draw of the places still open.  It has buckets times
   shards numbers; buckets follow the session's partitions, not the rows.
3. Each bucket is put in random order (by a seeded hash), and its first rows go to shard 0, the next to 1, ….
4. Each shard is put in random order again, by a second seeded hash.  The order is taken within slices of the
   hash range, so that a shard is sorted by many tasks; counts per slice, shards times slices numbers, give
   each slice's first slot.  The dealt rows are written once before, in the folder all executors share.

All randomness comes from hashes of the rows and a seeded generator, so a task that runs again deals the same.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import parallelism, read
from wattlake.session import stored

BUCKET, SHARD, SLOT = "__bucket", "shard", "slot"


def communication_matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows from each bucket to each shard; columns sum to sizes at most one apart, rows to ``rows``."""
    generator = np.random.Generator(np.random.PCG64(seed))
    total = sum(rows)
    open_places = np.array([total // shards + (shard < total % shards) for shard in range(shards)], dtype=np.int64)
    matrix = np.zeros((len(rows), shards), dtype=np.int64)
    for bucket, count in enumerate(rows):
        left, places = count, int(open_places.sum())
        for shard in range(shards):
            places -= int(open_places[shard])
            taken = hypergeometric(generator, int(open_places[shard]), places, left)
            matrix[bucket, shard] = taken
            left -= taken
        open_places -= matrix[bucket]
    return matrix


def hypergeometric(generator: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` places are good.

    Numpy's generator stops at 1e9 places; beyond, the same law is drawn by inversion: probabilities relative to the
    mode's, by the ratios of neighbours, over all counts that a draw of 53 bits can reach.
    """
    if not drawn or not good:
        return 0
    if not bad:
        return drawn
    if good + bad < 1_000_000_000:
        return int(generator.hypergeometric(good, bad, drawn))
    share = drawn * good / (good + bad)
    spread = (share * (1 - good / (good + bad)) * (good + bad - drawn) / (good + bad - 1)) ** 0.5
    mode, reach = (drawn + 1) * (good + 1) // (good + bad + 2), 60 + int(12 * spread)
    low, high = max(0, drawn - bad, mode - reach), min(good, drawn, mode + reach)
    x = np.arange(low, high, dtype=np.float64)
    ratio = (good - x) * (drawn - x) / ((x + 1) * (bad - drawn + x + 1))       # of the probabilities of x + 1 and x
    below = np.cumprod(1 / ratio[:mode - low][::-1])[::-1]
    sums = np.cumsum(np.concatenate([below, [1.0], np.cumprod(ratio[mode - low:])]))
    return low + min(int(np.searchsorted(sums, generator.random() * sums[-1], side="right")), high - low)



def shuffle_into_shards(df: DataFrame, shards: int = 16, keys: list[str] | None = None, seed: int = 1) -> DataFrame:
    """Adds ``shard`` (0 to shards - 1, counts at most one apart) and ``slot`` (gapless from 0) to every row.

    ``keys`` names the columns that tell rows apart (default: all).  Rows equal in them are dealt like others,
    one place each, but are ordered by one task.  Nulls are values like others.  Columns already called shard or
    slot are replaced; an empty table stays empty.
    """
    spark = df.sparkSession
    df = df.drop(SHARD, SLOT, BUCKET)
    keys = keys or df.columns
    n_buckets = parallelism(spark)
    names = [F.col(f"`{key}`") for key in keys]
    bucketed = df.withColumn(BUCKET, F.pmod(F.xxhash64(F.lit(seed), *names), F.lit(n_buckets)).cast("int"))
    counted = {row[0]: row[1] for row in bucketed.groupBy(BUCKET).count().collect()}     # one number per bucket
    matrix = communication_matrix([counted.get(bucket, 0) for bucket in range(n_buckets)], shards, seed)

    ends = spark.createDataFrame([(bucket, np.cumsum(line).tolist()) for bucket, line in enumerate(matrix)],
                                 f"{BUCKET} int, __ends array<bigint>")
    order = Window.partitionBy(BUCKET).orderBy(F.xxhash64(F.lit(seed + 1), *names), *names)
    dealt = bucketed.withColumn("__place", F.row_number().over(order)).join(F.broadcast(ends), BUCKET)
    dealt = dealt.withColumn(SHARD, F.size(F.filter("__ends", lambda end: end < F.col("__place")))) \
        .drop("__ends", "__place", BUCKET)

    n_slices = max(1, 4 * n_buckets // shards)
    second = F.xxhash64(F.lit(seed + 2), *names)
    sliced = stored(dealt.withColumn("__slice", F.pmod(F.shiftright(second, 16), F.lit(n_slices)).cast("int")), "dealt")
    per_slice = {(row[0], row[1]): row[2] for row in sliced.groupBy(SHARD, "__slice").count().collect()}
    starts = []
    for shard in range(shards):
        sizes = [per_slice.get((shard, piece), 0) for piece in range(n_slices)]
        line = np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist()
        starts += [(shard, piece, int(start)) for piece, start in enumerate(line)]
    first = spark.createDataFrame(starts, f"{SHARD} int, __slice int, __first bigint")
    within = Window.partitionBy(SHARD, "__slice").orderBy(second, *names)
    placed = sliced.withColumn("__row", F.row_number().over(within)).join(F.broadcast(first), [SHARD, "__slice"])
    return placed.withColumn(SLOT, F.col("__first") + F.col("__row") - 1) \
        .select(*[F.col(f"`{name}`") for name in df.columns], SHARD, SLOT)


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents dealt to 16 shards with row counts at most one apart."""
    rows = read(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    return shuffle_into_shards(rows, 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
