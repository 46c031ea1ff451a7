"""Hard negatives by segment summaries: bounds on inner products from each vector segment's mean and deviation.

Vectors become whole numbers, so all products are exact.  For a segment of length l with means m, n and deviations
s, t the product lies between l (m n - s t) and l (m n + s t); the sums over segments bound the whole product.  The
table written first holds, for each vector, the sum and the difference of every two neighbouring components, from
which means and deviations of the segments of two components and of all longer ones follow.  A pair of rows is held
against its anchor's limits with the longest segments first; what they cannot decide is refined with segments a
quarter as long, and only what the shortest leave open is multiplied out.

Anchors are a stated query set.  Rows are dealt into parts, anchors into groups, by a hash of the row's number, so no
label or id can crowd one; a task holds one part against one group in tiles.  Each row is copied once for each
``GROUP_ANCHORS`` anchors and each anchor once for each ``PART_ROWS`` rows (at least once for each shuffle partition):
the exchange per pair of row and anchor falls with these sizes, and the work itself is one look at each such pair.
Tasks return their best rows for each anchor, which are merged.  The first pass finds the positives, the second the
negatives within the limits that the positives' scores set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from wattlake.llm.common import best_rows, parallelism, read
from wattlake.session import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95                     # a negative's score in hundredths of the positive's
PART_ROWS, GROUP_ANCHORS = 65536, 65536
TILE_ROWS, TILE_ANCHORS = 4096, 256
SPARSE = 0.05                          # share of a tile below which pairs are refined one by one
SLACK = 1e-9
NOTHING = np.iinfo(np.int64).min


def usable(df: DataFrame, anchors: Column, key: str, label: str, vector: str) -> DataFrame:
    """(id, label, vector, anchor) of the rows that take part, the vector as whole numbers; text labels by their hash."""
    number = F.xxhash64(label) if isinstance(df.schema[label].dataType, (StringType, BinaryType)) else F.col(label).cast("long")
    rows = df.select(F.col(key).cast("long").alias("id"), F.when(F.col(label).isNotNull(), number).alias("label"),
                     F.col(vector).cast("array<double>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(SCALE * x) < 2.0 ** 31))
    whole = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine) \
        .withColumn("vector", F.transform("vector", lambda x: F.floor(SCALE * x).cast("double")))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    return whole.where(square < 2.0 ** 62)


def padded(width: int) -> int:
    """The least power of two that is at least the width, and at least 2."""
    return max(2, 1 << max(0, width - 1).bit_length())


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and absolute difference of each two neighbouring components; the width is filled up with zeros."""
    wide = np.zeros((len(vectors), padded(vectors.shape[1])), vectors.dtype)
    wide[:, :vectors.shape[1]] = vectors
    return wide[:, ::2] + wide[:, 1::2], np.abs(wide[:, ::2] - wide[:, 1::2])


def segment_levels(sums: np.ndarray, gaps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Means and deviations, each times the root of the length, of segments from the longest level to the shortest."""
    sums, energy = sums.astype(np.float64), (sums.astype(np.float64) ** 2 + gaps.astype(np.float64) ** 2) / 2
    levels, length = [], 2
    while True:
        levels.append((sums / np.sqrt(length), np.sqrt(np.maximum(0, energy - sums * sums / length))))
        if sums.shape[1] < 4:
            return levels[::-1]
        fours = (len(sums), sums.shape[1] // 4, 4)
        sums, energy, length = sums.reshape(fours).sum(2), energy.reshape(fours).sum(2), 4 * length


class Side:
    """Vectors of a block with their levels, as doubles where these hold every product exactly."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, sums: np.ndarray, gaps: np.ndarray):
        self.ids, self.labels, self.levels = ids, labels, segment_levels(sums, gaps)
        self.vectors = vectors.astype(np.int64)
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, where: slice) -> Side:
        part = object.__new__(Side)
        part.ids, part.labels, part.vectors, part.norms = (x[where] for x in (self.ids, self.labels, self.vectors, self.norms))
        part.levels = [(mean[where], spread[where]) for mean, spread in self.levels]
        return part


def within(anchors: Side, rows: Side, open_pairs: np.ndarray, least: np.ndarray, most: np.ndarray | None,
           counts: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, product) of all open pairs with a product of at least ``least`` and, if given, at most ``most``.

    Both limits are one number for each anchor.  Pairs are dropped by the bounds of ever shorter segments.
    """
    slack = SLACK * np.outer(anchors.norms, rows.norms) + 1e-6
    pairs = None
    for (mean_a, spread_a), (mean_r, spread_r) in zip(anchors.levels, rows.levels):
        if pairs is None:
            middle, reach = mean_a @ mean_r.T, spread_a @ spread_r.T + slack
            open_pairs = open_pairs & (middle + reach >= least[:, None])
            if most is not None:
                open_pairs &= middle - reach <= most[:, None]
            if open_pairs.mean() < SPARSE:
                pairs = np.nonzero(open_pairs)
        else:
            a, r = pairs
            middle = np.einsum("ij,ij->i", mean_a[a], mean_r[r])
            reach = np.einsum("ij,ij->i", spread_a[a], spread_r[r]) + slack[a, r]
            kept = middle + reach >= least[a]
            if most is not None:
                kept &= middle - reach <= most[a]
            pairs = a[kept], r[kept]
    whole = float(anchors.norms.max(initial=0)) * float(rows.norms.max(initial=0)) < 2.0 ** 52
    if pairs is None:
        product = (anchors.vectors.astype(np.float64) @ rows.vectors.T.astype(np.float64)).astype(np.int64) if whole \
            else anchors.vectors @ rows.vectors.T
        a, r = np.nonzero(open_pairs)
        product = product[a, r]
    else:
        a, r = pairs
        product = np.einsum("ij,ij->i", anchors.vectors[a], rows.vectors[r])
    if counts is not None:
        counts["pairs"] = counts.get("pairs", 0) + open_pairs.size
        counts["exact"] = counts.get("exact", 0) + len(a)
    kept = product >= least[a]
    if most is not None:
        kept &= product <= most[a]
    return a[kept], r[kept], product[kept]


class Best:
    """The k best (score, id) of each of n targets: higher scores first, ties by smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score, self.ids = np.full((n, k), NOTHING), np.zeros((n, k), np.int64)

    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, target: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        fits = score >= self.score[target, -1]
        target, score, ids = target[fits], score[fits], ids[fits]
        if not len(target):
            return
        touched = np.unique(target)
        owner = np.concatenate([target, np.repeat(touched, self.k)])
        score = np.concatenate([score, self.score[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        # an empty place has the least possible score and goes behind everything
        order = np.lexsort((ids, -score.astype(np.float64), owner)) if np.abs(score[score != NOTHING]).max(initial=0) < 2 ** 52 \
            else np.lexsort((ids, ~score, owner))
        owner, score, ids = owner[order], score[order], ids[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        kept = place < self.k
        self.score[owner[kept], place[kept]], self.ids[owner[kept], place[kept]] = score[kept], ids[kept]

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(self.score != NOTHING)


def hundredths(score: np.ndarray, share: int) -> np.ndarray:
    """floor(share * score / 100) without overflow."""
    return share * (score // 100) + share * (score % 100) // 100


def sides(table: pa.Table, width: int, kind: np.dtype) -> tuple[Side, Side, pa.Table]:
    """Anchors and rows of a task's group, and the anchors' table; rows by id."""
    asked = table.column("asked").to_numpy(zero_copy_only=False).astype(bool)

    def side(part: pa.Table) -> Side:
        def matrix(name: str, columns: int) -> np.ndarray:
            return np.frombuffer(b"".join(part.column(name).to_pylist()), kind).reshape(part.num_rows, columns)
        half = padded(width) // 2
        return Side(part.column("id").to_numpy(), part.column("label").to_numpy(), matrix("vector", width),
                    matrix("sums", half), matrix("gaps", half))

    anchors, rows = table.filter(pa.array(asked)), table.filter(pa.array(~asked)).sort_by("id")
    return side(anchors), side(rows), anchors


def tiles(anchors: Side, rows: Side):
    """(first anchor, anchors, rows) of each tile; all tiles of some anchors follow one another."""
    for at in range(0, len(anchors) if len(rows) else 0, TILE_ANCHORS):
        some = anchors.take(slice(at, at + TILE_ANCHORS))
        for start in range(0, len(rows), TILE_ROWS):
            yield at, some, rows.take(slice(start, start + TILE_ROWS))


def find_positives(anchors: Side, rows: Side, k: int) -> Best:
    best = Best(len(anchors), k)
    for at, some, part in tiles(anchors, rows):
        alike = (some.labels[:, None] == part.labels) & (some.ids[:, None] != part.ids)
        a, r, score = within(some, part, alike, best.least()[at:at + TILE_ANCHORS], None)
        best.add(a + at, score, part.ids[r])
    return best


def find_negatives(anchors: Side, rows: Side, targets: list[list[int]], low: int, high: int, k: int) -> tuple[Best, np.ndarray, np.ndarray]:
    """The k best of each target (an anchor's positive), with the targets' anchors and their places."""
    owner = np.repeat(np.arange(len(anchors)), [len(x) for x in targets])
    first = np.cumsum([0, *(len(x) for x in targets)])
    place = np.arange(len(owner)) - first[owner]
    score = np.array([s for x in targets for s in x], np.int64)
    floor, cap = -hundredths(-score, low), hundredths(score, high)
    best = Best(len(owner), k)
    for at, some, part in tiles(anchors, rows):
        mine = slice(first[at], first[min(at + TILE_ANCHORS, len(anchors))])
        needed = np.maximum(best.least()[mine], floor[mine])
        least, most = np.full(len(some), np.iinfo(np.int64).max), np.full(len(some), NOTHING)
        possible = needed <= cap[mine]
        np.minimum.at(least, owner[mine][possible] - at, needed[possible])
        np.maximum.at(most, owner[mine][possible] - at, cap[mine][possible])
        unlike = (some.labels[:, None] != part.labels) & (some.ids[:, None] != part.ids)
        a, r, product = within(some, part, unlike, least, most)
        for number in range(place[mine].max(initial=-1) + 1):
            has = first[a + at] + number < first[a + at + 1]
            target = first[a[has] + at] + number
            fits = (product[has] >= floor[target]) & (product[has] <= cap[target])
            best.add(target[fits], product[has][fits], part.ids[r[has][fits]])
    return best, owner, place


def mine(df: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``anchors`` is a condition on the table.

    Rows with a null id, label or vector, or with null or non-finite components take no part, nor do rows with numbers
    so large that a product may not fit a long (a square of 2**62 or more, or a component beyond 2**31).  Rows are
    compared with rows of as many components only; vectors without components have the product 0.  A row with the
    anchor's own id is neither its positive nor its negative.  Rows that repeat are rows of their own: a repeated
    anchor gives its results again, a repeated positive too.  Anchors without positives, and positives without
    negatives in the limits, give no rows; an empty table gives none.
    """
    spark = df.sparkSession
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = usable(df, anchors, key, label, vector)
    largest = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))
    total, asked, top = rows.agg(F.count("*"), F.count_if("anchor"), largest).first()
    if not total or not asked:
        return spark.createDataFrame([], shape)
    kind = np.dtype("<i2" if (top or 0) < 2 ** 14 else "<i4" if top < 2 ** 30 else "<i8")

    def summarise(batches):
        for batch in batches:
            for part in (batch.slice(at, 4096) for at in range(0, batch.num_rows, 4096)):
                lists = part.column("vector")
                lengths, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy().astype(kind)
                starts = np.cumsum(lengths) - lengths
                columns = [[None] * part.num_rows for _ in range(3)]
                for width in np.unique(lengths):
                    places = np.nonzero(lengths == width)[0]
                    vectors = flat[starts[places][:, None] + np.arange(width)].reshape(len(places), width)
                    for column, values in zip(columns, (vectors, *summaries(vectors))):
                        for place, value in zip(places, np.ascontiguousarray(values)):
                            column[place] = value.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), part.column("anchor"), pa.array(lengths, pa.int32()),
                     *[pa.array(column, pa.binary()) for column in columns]],
                    ["id", "label", "anchor", "width", "vector", "sums", "gaps"])

    table = stored(rows.mapInArrow(summarise, "id long, label long, anchor boolean, width int, vector binary, "
                                                 "sums binary, gaps binary")
                   .withColumn("row", F.monotonically_increasing_id()), "summaries")
    parts = max(parallelism(spark), -(-total // PART_ROWS))
    groups = max(1, -(-asked // GROUP_ANCHORS))
    dealt = F.xxhash64("row")
    part_rows = table.drop("anchor").withColumn("part", F.pmod(dealt, F.lit(parts))) \
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("asked", F.lit(False))
    questions = table.where("anchor").drop("anchor")

    def against(asked_rows: DataFrame, task, schema: str) -> DataFrame:
        spread = asked_rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))) \
            .withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).withColumn("asked", F.lit(True))
        return part_rows.unionByName(spread, allowMissingColumns=True).groupBy("width", "part", "group") \
            .applyInArrow(task, schema)

    def positives_task(group: tuple, data: pa.Table) -> pa.Table:
        some, others, asked_table = sides(data, group[0].as_py(), kind)
        best = find_positives(some, others, positives)
        owner, place = best.entries()
        return pa.table({"row": asked_table.column("row").take(pa.array(owner)),
                         "positive_id": best.ids[owner, place], "positive_score": best.score[owner, place]})

    by_score = [F.desc("score"), F.asc("id")]
    found = against(questions, positives_task, "row long, positive_id long, positive_score long") \
        .withColumnsRenamed({"positive_score": "score", "positive_id": "id"})
    targets = best_rows(found, ["row"], by_score, positives).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("targets"))       # at most ``positives`` each
    wanted = stored(questions.join(targets, "row").withColumn("scores", F.col("targets.score"))
                    .withColumn("positives", F.col("targets.id")).drop("targets"), "targets")

    def negatives_task(group: tuple, data: pa.Table) -> pa.Table:
        some, others, asked_table = sides(data, group[0].as_py(), kind)
        scores = asked_table.column("scores").to_pylist()
        best, owner, place = find_negatives(some, others, scores, low, high, negatives)
        target, rank = best.entries()
        mine_of = pa.array(owner[target])
        names = asked_table.column("positives").to_pylist()
        return pa.table({
            "row": asked_table.column("row").take(mine_of), "anchor_id": pa.array(some.ids[owner[target]], pa.int64()),
            "place": pa.array(place[target], pa.int32()),
            "positive_id": pa.array([names[o][p] for o, p in zip(owner[target], place[target])], pa.int64()),
            "positive_score": pa.array([scores[o][p] for o, p in zip(owner[target], place[target])], pa.int64()),
            "id": best.ids[target, rank], "score": best.score[target, rank]})

    hard = against(wanted, negatives_task, "row long, anchor_id long, place int, positive_id long, positive_score long, "
                                           "id long, score long")
    return best_rows(hard, ["row", "place"], by_score, negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op13_negatives(spark, sf_dir: str) -> DataFrame:
    """Up to three hard negatives for each of the five positives of every row whose id is divisible by 50."""
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
