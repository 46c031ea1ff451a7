"""Approximate nearest neighbours by inner product: inverted lists scanned by adaptive dimensions.

Inner products become distances by one more component (the rest of the largest norm), so the largest product is
the smallest distance.  Vectors are then turned by a random rotation, so that any leading components are a random
sample of a distance.  Centres of the lists are fitted on a bounded sample; every vector is put in its list.  A
query scans the lists with the largest product with the centre, plus what the list's radius may add (a tight list
of equal vectors adds nothing, a wide one much): distances grow by blocks of columns, and after each block a pair
is abandoned if its partial distance, scaled up, exceeds the query's current bound by more than ``EPSILON``
standard errors would explain.  Survivors get the exact inner product of the original vectors in doubles.

Lists are split into blocks of ``BLOCK_ROWS`` rows and queries into groups, so that neither a crowded list (many
equal vectors, say) nor many queries make a task large; each task returns its best k per query, and these are
merged per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import read
from wattlake.session import stored

SAMPLE_ROWS = 8192        # rows the centres are fitted on: a bounded sample, the smallest hashes of the ids
PROBE_SHARE = 0.7         # share of the lists a query scans, the most promising first; recall is measured in the tests
LEAST_ROWS = 16384        # rows that the scanned lists have at least: smaller tables are scanned whole
REACH = 2.5
BLOCK_ROWS, GROUP_QUERIES = 4096, 2048
COLUMN_BLOCKS = (16, 32, 48)
EPSILON = 2.1
SLACK = 1e-9              # relative; keeps ties from being lost to rounding


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part: an id, no null, no non-finite and not only zero components."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & fine
                      & F.exists("vector", lambda x: x != 0.0))


def fit_centres(points: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Centres by Lloyd's rounds from evenly spaced points of the sample."""
    centres = points[np.linspace(0, len(points) - 1, lists).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.argmin((centres * centres).sum(1) - 2 * points @ centres.T, axis=1)
        for number in range(lists):
            members = points[nearest == number]
            if len(members):
                centres[number] = members.mean(0)
    return centres


def rotation(dimensions: int, seed: int = 5) -> np.ndarray:
    turned, scale = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return turned * np.sign(np.diag(scale))


def lifted(vectors: np.ndarray, norm2: float | None) -> np.ndarray:
    """With the component that turns products into distances: the rest of the norm, or 0 for a query."""
    last = np.zeros(len(vectors)) if norm2 is None else np.sqrt(np.maximum(0, norm2 - (vectors * vectors).sum(1)))
    return np.column_stack([vectors, last])


def scan(queries: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) not abandoned: turned and lifted vectors, distances grown block by block of columns."""
    width = queries.shape[1]
    first = min(len(rows), max(64, 2 * k))
    start = (queries * queries).sum(1)[:, None] + (rows[:first] ** 2).sum(1) - 2 * queries @ rows[:first].T
    bound = np.partition(start, min(k, first) - 1, axis=1)[:, min(k, first) - 1] * (1 + SLACK) + SLACK
    if first < k + 1:
        bound[:] = np.inf
    partial = np.zeros((len(queries), len(rows)))
    alive, done = np.ones(partial.shape, bool), 0
    pairs = None
    for stop in [*(block for block in COLUMN_BLOCKS if block < width), width]:
        q, r = queries[:, done:stop], rows[:, done:stop]
        if pairs is None:
            partial += (q * q).sum(1)[:, None] + (r * r).sum(1) - 2 * q @ r.T
        else:
            value += ((q[pairs[0]] - r[pairs[1]]) ** 2).sum(1)
        done = stop
        stretch = 1.0 if done == width else done / width * (1 + EPSILON / math.sqrt(done)) ** 2
        if pairs is None:
            alive &= partial <= (bound * stretch)[:, None] * (1 + SLACK) + SLACK
            if alive.mean() < 0.1 or done == width:
                pairs = np.nonzero(alive)
                value = partial[pairs]
        else:
            kept = value <= (bound * stretch)[pairs[0]] * (1 + SLACK) + SLACK
            pairs, value = (pairs[0][kept], pairs[1][kept]), value[kept]
    return pairs


def search(df: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding",
           probe_share: float = PROBE_SHARE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k rows of largest inner product found, ties by id.

    Rows and queries with null, zero or non-finite vectors, a null id or another number of components than most
    of the sample take no part; a row with the query's own id is not its neighbour; queries repeated in full are
    one.  With fewer than k rows, all are returned.  An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = usable(df, key, vector)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("vector").toArrow().column(0).to_pylist()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    width = max({len(x) for x in sample}, key=[len(x) for x in sample].count)
    rows, asked = [x.where(F.size("vector") == width) for x in (rows, usable(queries, key, vector).distinct())]
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    total, norm2 = rows.agg(F.count("*"), F.max(squares)).first()
    n_asked = asked.count()
    points = np.array([x for x in sample if len(x) == width])
    norm2 = max(norm2, float((points * points).sum(1).max()))
    lists = max(1, min(len(points), int(math.sqrt(total) / 8)))
    centres = fit_centres(lifted(points, norm2), lists)
    # what a list's best row may exceed its centre by: a few standard errors of its radius (all lifted norms are equal)
    spread = REACH * np.sqrt(np.maximum(0, norm2 - (centres * centres).sum(1)) / (width + 1))
    turned = rotation(width + 1)
    groups = max(1, -(-n_asked // GROUP_QUERIES))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 4096) for at in range(0, batch.num_rows, 4096)):
                vectors = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                nearest = np.argmin((centres * centres).sum(1) - 2 * lifted(vectors, norm2) @ centres.T, axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(nearest, pa.int32())],
                                                 ["id", "vector", "list"])

    member_schema = "id long, vector array<double>, list int"
    members = stored(rows.mapInArrow(assign, member_schema), "lists")
    sizes = {row[0]: row[1] for row in members.groupBy("list").count().collect()}      # one number per list
    parts = np.array([max(1, -(-sizes.get(number, 0) // BLOCK_ROWS)) for number in range(lists)])
    counts = np.array([sizes.get(number, 0) for number in range(lists)])
    probes = max(1, math.ceil(lists * probe_share))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                vectors = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                hoped = vectors @ centres[:, :-1].T + np.sqrt((vectors * vectors).sum(1))[:, None] * spread
                order = np.argsort(-hoped, axis=1, kind="stable")
                found = counts[order].cumsum(1)
                wanted = np.maximum(probes, 1 + (found < max(k + 1, LEAST_ROWS)).sum(1))
                owners, numbers = np.nonzero(np.arange(lists) < wanted[:, None])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owners)), part.column(1).take(pa.array(owners)),
                     pa.array(order[owners, numbers], pa.int32())], ["id", "vector", "list"])

    n_parts = F.get(F.array(*[F.lit(int(x)) for x in parts]), F.col("list"))
    salt = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    stored_rows = members.withColumn("part", F.pmod(salt, n_parts).cast("int")) \
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("asked", F.lit(False))
    asked_rows = asked.mapInArrow(probe, member_schema) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1))) \
        .withColumn("group", F.pmod(salt, F.lit(groups)).cast("int")).withColumn("asked", F.lit(True))

    def best(table: pa.Table) -> pa.Table:
        asked_flag = table.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        ids = table.column("id").to_numpy(zero_copy_only=False)
        vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        order = np.argsort(ids[~asked_flag], kind="stable")
        row_ids, row_vectors = ids[~asked_flag][order], vectors[~asked_flag][order]
        q_ids, q_vectors = ids[asked_flag], vectors[asked_flag]
        out: list[np.ndarray] = []
        rows_turned = lifted(row_vectors, norm2) @ turned
        for at in range(0, len(q_ids) if len(row_ids) else 0, 256):
            some = q_vectors[at:at + 256]
            q, r = scan(lifted(some, None) @ turned, rows_turned, k + 1)
            keep = q_ids[at:at + 256][q] != row_ids[r]
            q, r = q[keep], r[keep]
            score = np.einsum("ij,ij->i", some[q], row_vectors[r])
            rank = np.lexsort((row_ids[r], -score, q))
            q, r, score = q[rank], r[rank], score[rank]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            top = place < k
            out.append((q_ids[at:at + 256][q[top]], row_ids[r[top]], score[top]))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    found = stored_rows.unionByName(asked_rows).groupBy("list", "part", "group") \
        .applyInArrow(best, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op5_nearest(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every embedding whose id is divisible by 20."""
    rows = read(spark, sf_dir, "embeddings")
    return search(rows, rows.where("vec_id % 20 = 0"), 20)
