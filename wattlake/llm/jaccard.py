"""Groups of documents with similar shingle sets: a join by partition signatures, then connected components.

Two sets link when their Jaccard similarity is at least 3/4.  Then |x|, |y| differ by a third at most, and they
differ in at most (|x| + |y|) / 7 shingles.

* Size bands.  A set sends signatures to its own band of sizes and to the larger ones a partner may lie in.
  All pairs that meet in a band differ in at most ``k`` shingles, ``k`` following from the band.
* Parts.  In a band the domain of shingles is split by hash into n parts of 3 cells.  If two sets differ in at
  most k shingles, fewer than n parts hold two differences or more; in any other part at least two of the three
  cells agree.  So for each part and each 2 of its 3 cells the set sends one signature, the hash of its shingles
  there, and similar sets share one.  Sets of up to 11 shingles send their subsets instead (each shingle is a cell).
* Empty cells tell nothing and are not sent, as long as the set has more parts with two filled cells than can be
  spoilt: then one of these must agree.  Sets of up to 63 shingles are split twice over; a set for which all
  splits fail sends its empty cells, too, so no link is lost.
* Which sets take part.  At least three quarters of a linked set's shingles are in its partner, so a set with more
  than a quarter of shingles that no other set has can be left out.  This is tested first on a fixed two fifths of
  the domain of shingles for all sets (a set of its own fails by far), then on the whole domain for those left.
  Documents that only have a passage in common with thousands of others are gone before any pair is formed.
* How large a partner may be.  What two linked sets share is at least 3/7 of both sizes together, so a set of n
  shingles, c of them its own, can only link with sets of up to 7 (n - c) / 3 - n.  Heavily edited copies of one
  text are thus left out of lists of sets of equal size, where they could not link.
* Pairs.  First the set of each list with the fewest shingles of its own is held against the others, then, for lists whose sets have
  not ended in one component, those of the smaller components against the rest.  Each pair is verified on the
  sets themselves.  No list is capped; a list of many copies is linked by a star, not by all its pairs.
* Sketches.  A signature may be a single shingle of a line that very many documents have, so lists grow with the
  corpus although their sets are strangers.  Before sets are compared, their sketches are: each shingle flips one of
  2 bits per shingle or more.  Two sketches differ in no more bits than the sets in shingles, so pairs whose sketches
  differ in over a seventh of both sizes cannot link, and the texts of sets without any other pair stay where they are.

Equal sets are one vertex throughout, so exact copies cost nothing beyond their row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import binaries, blocks, mix, parallelism, ragged, raw_texts, read
from wattlake.llm.repeats import packed, unpacked
from wattlake.llm.shingles import set_numbers, shingle_sets
from wattlake.session import stored

BLOCK = 2 << 20
SMALL = 11                       # sizes up to this send subsets
TILE = (1 << 21, 1 << 23)        # shingles of the sets held against sets in one task, after the first links
PIECE = (1 << 19, 1 << 21)       # and of those whose shingles are looked at together
LOOK = 1 << 17                   # words of sketches looked at together
COLUMNS = 256                    # sets of a tile looked at together
FIFTHS = 2                       # of the domain of shingles, for the first test
FILTER_BITS = 1 << 26            # of the bitmap that finds the texts still needed
U64 = np.uint64


@cache
def bands(most: int) -> list[tuple[int, int, int, int, int]]:
    """(smallest size, largest size, k, parts, splits) of the bands up to a size."""
    found, low = [(1, SMALL, 0, 0, 0)], SMALL + 1
    while not found or found[-1][1] < most:
        high = max(low, int(low * 1.155) if low < 128 else low * 4 // 3)
        k = 2 * high // 7
        share = 0.3 if low < 1024 else 0.25
        found.append((low, high, k, max(k // 2 + 2, round(share * low)), 2 if low < 64 else 1))
        low = high + 1
    return found


def band_of(sizes: np.ndarray, table: list) -> np.ndarray:
    return np.searchsorted(np.array([row[1] for row in table]), sizes)


def subset_signatures(values: np.ndarray) -> np.ndarray:
    """Hashes of a small set's subsets that a similar set may share: up to a quarter of it left out."""
    mixed = mix(values)
    with np.errstate(over="ignore"):
        whole = mixed.sum(dtype=U64)
        return mix(np.array([whole - mixed[list(out)].sum(dtype=U64) for n in range(len(values) // 4 + 1)
                             for out in combinations(range(len(values)), n)], U64))


def signatures(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and whose they are (by place), for the sets laid end to end."""
    starts = np.cumsum(counts) - counts
    table = bands(int(counts.max(initial=0)) * 4 // 3 + 1)
    own, last = band_of(counts, table), band_of(counts * 4 // 3, table)
    out: list[tuple] = []
    for place in np.nonzero((counts > 0) & (own == 0))[0]:
        found = subset_signatures(values[starts[place]:starts[place] + counts[place]])
        out.append((found, np.full(len(found), place)))
    for number in range(1, len(table)):
        members = np.nonzero((counts > 0) & (own <= number) & (number <= last))[0]
        if not len(members):
            continue
        _, _, k, parts, splits = table[number]
        at = ragged(starts[members], counts[members])
        holder = np.repeat(np.arange(len(members)), counts[members])
        thin = np.ones(len(members), bool)
        made = []
        for split in range(splits):
            with np.errstate(over="ignore"):
                value = mix(values[at] + U64(number * 8 + split) * U64(0xA0761D6478BD642F))
            cell = (value >> U64(24)) % U64(3 * parts)
            place = holder * (3 * parts) + cell.astype(np.int64)
            filled = np.bincount(place, minlength=len(members) * 3 * parts).reshape(-1, parts, 3) > 0
            sums = np.zeros(len(members) * 3 * parts, U64)
            np.add.at(sums, place, mix(value))
            thin &= (filled.sum(2) >= 2).sum(1) <= k // 2
            made.append((filled, sums.reshape(-1, parts, 3)))
        for split, (filled, sums) in enumerate(made):
            for a, b in ((0, 1), (0, 2), (1, 2)):
                send = filled[:, :, a] | filled[:, :, b]
                if not split:
                    send |= thin[:, None]
                row, part = np.nonzero(send)
                salt = ((part * 3 + a + b) * 8 + split).astype(U64) + U64(number << 40)
                with np.errstate(over="ignore"):
                    found = mix(sums[row, part, a] + mix(sums[row, part, b] + mix(salt)))
                out.append((found, members[row]))
    if not out:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def sketches(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The parities of each set's shingles, over 2 to 4 bits for each: 64 bits at least, a power of two."""
    words = 1 << np.ceil(np.log2(np.maximum(counts, 32) / 32)).astype(np.int64)
    ends = np.cumsum(words)
    value = mix(values + U64(7777))
    width = np.repeat(words, counts)
    place = np.repeat(ends - words, counts) + ((value >> U64(6)).astype(np.int64) & (width - 1))
    out = np.zeros(int(words.sum()), U64)
    np.bitwise_xor.at(out, place, U64(1) << (value & U64(63)))
    return [part.astype("<u8").tobytes() for part in np.split(out, ends[:-1])] if len(counts) else []


def sampled(values: np.ndarray) -> np.ndarray:
    """Whether a shingle is in the part of the domain that the first test looks at."""
    return mix(values + U64(99)) % U64(5) < U64(FIFTHS)


def sets_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The shingle sets of a batch of texts, plain or packed."""
    if "packed" in batch.schema.names:
        unpack = zstandard.ZstdDecompressor()
        return shingle_sets([unpack.decompress(item) for item in batch.column("packed").to_pylist()])
    return shingle_sets(raw_texts(batch, "text"))


def describe(batches) -> Iterator[pa.RecordBatch]:
    """The set number, size and size within the first test's domain of each row."""
    for batch in blocks(batches, "text", BLOCK):
        values, counts = sets_of(batch)
        inside = np.bincount(np.repeat(np.arange(len(counts)), counts)[sampled(values)], minlength=len(counts))
        others = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [*map(batch.column, others), pa.array(set_numbers(values, counts)), pa.array(counts.astype(np.int64)),
             pa.array(inside.astype(np.int64))], [*others, "vertex", "n_shingles", "n_sampled"])


def send(batches, column: str, buckets: int, what) -> Iterator[pa.RecordBatch]:
    """Hashes of each block's different sets, as ``what`` makes them, with the sets' numbers, by bucket.

    A hash is kept to 32 bits besides its bucket.  Buckets follow the input, so chance meetings stay as rare at any
    size; they let a set through a test or cost a comparison, no more.  Hashes of one set that are the same in these
    bits are in ``again``, once less than there are, so that none is missing from a count.
    """
    for batch in blocks(batches, column, BLOCK):
        values, counts = sets_of(batch)
        vertex = set_numbers(values, counts)
        _, once = np.unique(vertex, return_index=True)
        once = once[counts[once] > 0]
        starts = np.cumsum(counts) - counts
        found, place = what(values[ragged(starts[once], counts[once])], counts[once])
        bucket = (found >> U64(32)) % U64(buckets)
        short = found.astype("<u4")
        order = np.lexsort((short, place, bucket))
        same = np.zeros(len(order), bool)
        if len(order):
            same[1:] = (short[order][1:] == short[order][:-1]) & (place[order][1:] == place[order][:-1]) \
                & (bucket[order][1:] == bucket[order][:-1])
        present, first = np.unique(bucket[order], return_index=True)
        if len(present):
            parts = np.split(order, first[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(present.astype(np.int32)), binaries([short[some].tobytes() for some in parts]),
                 binaries([packed(vertex[once][place[some]]) for some in parts]),
                 binaries([vertex[once][place[some[twice]]].tobytes() for some, twice in zip(parts, np.split(same, first[1:]))])],
                ["bucket", "hashes", "vertices", "again"])


HASH_SCHEMA = "bucket int, hashes binary, vertices binary, again binary"


def received(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (hash, vertex) of one bucket, sorted, of hashes that more than one vertex sent."""
    value = np.frombuffer(b"".join(table.column("hashes").to_pylist()), "<u4")
    vertex = np.concatenate([unpacked(x) for x in table.column("vertices").to_pylist()])
    order = np.argsort(value, kind="stable")
    head = np.append(True, value[order][1:] != value[order][:-1])
    order = order[~(head & np.append(head[1:], True))]                # alone with its hash: most are
    order = order[np.lexsort((vertex[order], value[order]))]
    value, vertex = value[order], vertex[order]
    new = np.append(True, (value[1:] != value[:-1]) | (vertex[1:] != vertex[:-1]))[:len(value)]
    value, vertex = value[new], vertex[new]
    head = np.append(True, value[1:] != value[:-1])[:len(value)]
    several = ~(head & np.append(head[1:], True)[:len(value)])
    return value[several], vertex[several]


def tally(table: pa.Table, homes: int) -> pa.Table:
    """Of one bucket: how many of each set's shingles another set has, to the homes of the sets.

    Shingles that a set's hashes do not tell apart count by their number, whether shared or not: a count may be too
    large by them, never too small.
    """
    vertex, shared = np.unique(received(table)[1], return_counts=True)
    again: dict[int, int] = {}                                       # the same from each block that has the set
    for blob in table.column("again").to_pylist():
        for number, times in zip(*np.unique(np.frombuffer(blob, np.int64), return_counts=True)):
            again[int(number)] = max(int(times), again.get(int(number), 0))
    if again:
        more = np.array(sorted(again.items()), np.int64)
        vertex, place = np.unique(np.append(vertex, more[:, 0]), return_inverse=True)
        shared = np.bincount(place, np.append(shared, more[:, 1]), len(vertex)).astype(np.int64)
    home = vertex % homes
    order = np.lexsort((vertex, home))
    present, first = np.unique(home[order], return_index=True)
    parts = np.split(order, first[1:]) if len(present) else []
    return pa.table({"home": pa.array(present.astype(np.int32)), "vertices": binaries([packed(vertex[some]) for some in parts]),
                     "shared": binaries([shared[some].astype("<u4").tobytes() for some in parts])})


def count_shared(rows: DataFrame, column: str, part: bool) -> DataFrame:
    """(vertex, shared): how many of a set's shingles (of the first test's domain) another set has, if any."""
    buckets = max(4, parallelism(rows.sparkSession) // 2)   # few: a set's number is sent once to each
    homes = max(8, buckets // 4)                     # tallies are small; a row goes from each bucket to each home

    def tokens(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.repeat(np.arange(len(counts)), counts)
        return (values[sampled(values)], place[sampled(values)]) if part else (values, place)

    def total(table: pa.Table) -> pa.Table:
        vertex = np.concatenate([unpacked(x) for x in table.column("vertices").to_pylist()])
        vertex, place = np.unique(vertex, return_inverse=True)
        shared = np.bincount(place, np.frombuffer(b"".join(table.column("shared").to_pylist()), "<u4"), len(vertex))
        return pa.table({"vertex": pa.array(vertex), "shared": pa.array(shared.astype(np.int64))})

    return rows.select(column).mapInArrow(lambda batches: send(batches, column, buckets, tokens), HASH_SCHEMA) \
        .groupBy("bucket").applyInArrow(lambda table: tally(table, homes), "home int, vertices binary, shared binary") \
        .groupBy("home").applyInArrow(total, "vertex long, shared long")


def shared_lists(sets: DataFrame) -> DataFrame:
    """(list, vertex): which sets share a signature; signatures shared by the same sets are one list."""
    buckets = 2 * parallelism(sets.sparkSession)

    def meet(table: pa.Table) -> pa.Table:
        value, vertex = received(table)
        head = np.nonzero(np.append(True, value[1:] != value[:-1])[:len(value)])[0]
        size = np.diff(np.append(head, len(value)))
        with np.errstate(over="ignore"):
            name = mix(np.add.reduceat(mix(vertex.astype(U64)), head) + size.astype(U64)) if len(head) else np.zeros(0, U64)
        name, first = np.unique(name, return_index=True)
        offsets = pa.array(np.append(0, np.cumsum(size[first])).astype(np.int32))
        return pa.table({"list": pa.array(name.astype(np.int64)), "vertices": pa.ListArray.from_arrays(
            offsets, pa.array(vertex[ragged(head[first], size[first])]))})

    return sets.select("packed").mapInArrow(lambda batches: send(batches, "packed", buckets, signatures), HASH_SCHEMA) \
        .groupBy("bucket").applyInArrow(meet, "list long, vertices array<bigint>") \
        .select("list", F.explode("vertices").alias("vertex")).distinct()


def likely(rows: DataFrame, column: str, some: DataFrame) -> DataFrame:
    """The rows whose ``column`` has a value (or null) that ``some`` has, and few others, without an exchange of the rows.

    ``some`` marks a bitmap of ``FILTER_BITS`` bits by hash: 8 MB at most are broadcast, whatever there is to mark.  The more
    is marked the more others pass; none of its own is lost.
    """
    place = (F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1).alias("place")
    marks = some.select(place).groupBy(F.bitmap_bucket_number("place").alias("part")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    bit = F.bitmap_bit_position("place").cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.select("*", place).withColumn("part", F.bitmap_bucket_number("place")).join(F.broadcast(marks), "part") \
        .where(F.getbit(byte, bit % 8) == 1).select(*rows.columns)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar.  Each text is unpacked once per batch it occurs in."""
    one = sets.select(F.col("vertex").alias("a"), F.col("packed").alias("packed_a"))
    two = sets.select(F.col("vertex").alias("b"), F.col("packed").alias("packed_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in blocks(batches, "packed_a", BLOCK // 2):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found: dict[int, np.ndarray] = {}
            for names, blobs in ((a, batch.column(2)), (b, batch.column(3))):
                todo = {name: i for i, name in enumerate(names) if name not in found}
                values, counts = shingle_sets([unpack.decompress(blobs[i].as_py()) for i in todo.values()])
                found.update(zip(todo, np.split(values, np.cumsum(counts)[:-1])))
            similar = []
            for x, y in zip(a, b):
                x, y = found[x], found[y]
                both = len(np.intersect1d(x, y, assume_unique=True))
                similar.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(similar))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "packed_a", "packed_b").mapInArrow(run, "a long, b long")


def hopeful(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches leave it open whether the sets are similar."""
    one = sets.select(F.col("vertex").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    two = sets.select(F.col("vertex").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))

    def differ(x: bytes, y: bytes) -> int:
        small, large = sorted((x, y), key=len)
        bits = 8 * len(large)
        large = int.from_bytes(large, "little")
        while bits > 8 * len(small):                                  # halves laid over each other: as if half as wide
            bits //= 2
            large = (large ^ large >> bits) & (1 << bits) - 1
        return (int.from_bytes(small, "little") ^ large).bit_count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b, x, y = (column.to_pylist() for column in batch.columns)
            open_ = [7 * differ(*both) <= n + m for n, m, *both in zip(n_a, n_b, x, y)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(open_, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def compared(lists: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between sets that share a list and have not ended in one component.

    Of two such sets at least one is not in the component of the list's hub.  So for each component, the sets
    outside it of the lists whose hubs it has are held against all sets of these lists, in tiles of about ``TILE`` shingles
    that Spark deals out, so that a tile's memory has a bound and short texts are copied to few tiles; a pair that shares many lists is looked at once, and no pair becomes a row.  Sketches go to the tiles first, and texts only of
    sets that have a pair there which the sketches leave open.  For each set, one link to each other component is returned.
    """
    placed = lists.join(labels, "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))
    several = placed.groupBy("list").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    members = placed.join(several, "list", "left_semi").select("hub", "vertex", "label", "n", "most").distinct()
    hubs = members.where("vertex = hub").select("hub", F.col("label").alias("hub_label"))
    members = stored(members.join(hubs, "hub").select(F.col("hub_label").alias("hub"), "vertex", "label", "n", "most").distinct()
                     .withColumn("outside", F.col("label") != F.col("hub")), "members")
    weight = F.greatest("n", F.lit(TILE[0] >> 13))                     # a tile has a bounded number of tiny sets, too
    tiles = members.groupBy("hub").agg(F.ceil(F.sum(F.when(F.col("outside"), weight)) / TILE[0]).cast("int").alias("n_x"),
                                       F.ceil(F.sum(weight) / TILE[1]).cast("int").alias("n_y")).where("n_x > 0")
    dealt = members.join(tiles, "hub").join(sets.select("vertex", "sketch"), "vertex")
    salt = F.pmod(F.xxhash64("vertex"), F.lit(1 << 30))
    first = dealt.where("outside").withColumn("x", F.pmod(salt, F.col("n_x")).cast("int")) \
        .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("n_y") - 1))).withColumn("asked", F.lit(True))
    second = dealt.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("n_x") - 1))) \
        .withColumn("y", F.pmod(salt, F.col("n_y")).cast("int")).withColumn("asked", F.lit(False))
    columns = ["hub", "x", "y", "asked", "vertex", "label", "n", "most"]
    rows = stored(first.unionByName(second).select(*columns, "sketch").groupBy("hub", "x", "y")
                  .applyInArrow(left_open, "hub long, x int, y int, asked boolean, vertex long, label long, n long, most long"), "tiles")
    return rows.join(sets.select("vertex", "packed"), "vertex").groupBy("hub", "x", "y").applyInArrow(compare, "a long, b long")


def left_open(table: pa.Table) -> pa.Table:
    """Of one tile: the sets that have a pair there, one of them asked, whose sketches may be those of similar sets."""
    asked = table.column("asked").to_numpy(zero_copy_only=False).astype(bool)
    label, n, most = (table.column(name).to_numpy() for name in ("label", "n", "most"))
    blobs = table.column("sketch").to_pylist()
    words = np.array([len(blob) // 8 for blob in blobs])
    order = np.lexsort((n, words))                                     # a larger sketch has a larger set
    right, keep = order[~asked[order]], np.zeros(len(n), bool)
    size = n[right]

    def laid(some: np.ndarray, width: int) -> np.ndarray:
        """The sketches of sets with the same number of words, folded to ``width`` words: a column for each."""
        all_ = np.frombuffer(b"".join(blobs[i] for i in some), "<u8").reshape(len(some), -1).T
        while len(all_) > width:
            all_ = all_[:len(all_) // 2] ^ all_[len(all_) // 2:]
        return np.ascontiguousarray(all_)

    for width in np.unique(words[asked]):
        left = order[asked[order] & (words[order] == width)]
        for other in (width // 2, width, 2 * width):                  # sizes of similar sets differ by a third at most
            of = np.nonzero(words[right] == other)[0]
            if not other or not len(of):
                continue
            narrow = int(min(width, other))
            columns, mine = laid(right[of], narrow), laid(left, narrow)
            first = max(1, 3 * narrow // 8)                           # words that most strangers already differ in
            least = np.searchsorted(size[of], -(-3 * n[left] // 4))
            last = np.searchsorted(size[of], 4 * n[left] // 3, side="right")
            at = 0
            while at < len(left):
                begin = least[at]
                stop = at + max(1, LOOK // (first * max(1, int(last[at] - begin))))
                i, j = left[at:stop], right[of[begin:last[min(stop, len(left)) - 1]]]
                differ = np.bitwise_count(columns[:first, None, begin:begin + len(j)] ^ mine[:first, at:stop, None]).sum(0, dtype=np.int32)
                x, y = np.nonzero(7 * differ <= n[i][:, None] + n[j])
                some = (label[i[x]] != label[j[y]]) & (n[i[x]] <= most[j[y]]) & (n[j[y]] <= most[i[x]])
                x, y = x[some], y[some]
                more = np.bitwise_count(columns[first:, begin + y] ^ mine[first:, at + x]).sum(0, dtype=np.int32)
                some = 7 * (differ[x, y] + more) <= n[i[x]] + n[j[y]]
                keep[i[x[some]]] = keep[j[y[some]]] = True
                at = stop
    return table.select(["hub", "x", "y", "asked", "vertex", "label", "n", "most"]).filter(pa.array(keep))


def pieces(rows: np.ndarray, n: np.ndarray, most: int) -> list[np.ndarray]:
    """The rows in runs of about ``most`` shingles."""
    return [part for part in np.split(rows, np.nonzero(np.diff((np.cumsum(n[rows]) - n[rows]) // most))[0] + 1) if len(part)]


def compare(table: pa.Table) -> pa.Table:
    """Of one tile: for each asked set and other component, a similar set of it."""
    unpack = zstandard.ZstdDecompressor()
    asked = table.column("asked").to_numpy(zero_copy_only=False).astype(bool)
    vertex, label, n, most = (table.column(name).to_numpy() for name in ("vertex", "label", "n", "most"))
    packed_ = table.column("packed").to_pylist()
    found: set[tuple[int, int]] = set()
    for lefts in pieces(np.nonzero(asked)[0], n, PIECE[0]):
        for rights in pieces(np.nonzero(~asked)[0], n, PIECE[1]):
            both_ = np.append(lefts, rights)
            values, counts = shingle_sets([unpack.decompress(packed_[i]) for i in both_])
            names, place = np.unique(values, return_inverse=True)
            parts = dict(zip(both_.tolist(), np.split(place, np.cumsum(counts)[:-1])))
            width = int(np.clip((1 << 26) // max(1, len(names)), 8, COLUMNS))   # a table of at most 64 MB, unless sets are huge
            for start in range(0, len(lefts), width):
                some = lefts[start:start + width]
                has = np.zeros((len(names), len(some)), np.uint8)
                for column, i in enumerate(some):
                    has[parts[int(i)], column] = 1
                done: set[tuple[int, int]] = set()
                for j in rights:
                    fits = (label[some] != label[j]) & (n[some] <= most[j]) & (n[j] <= most[some])
                    if not fits.any():
                        continue
                    both = np.add.reduce(has[parts[int(j)]], axis=0, dtype=np.uint32).astype(np.int64)
                    for column in np.nonzero(fits & (100 * both >= 75 * (n[some] + n[j] - both)))[0]:
                        if (int(some[column]), int(label[j])) not in done:
                            done.add((int(some[column]), int(label[j])))
                            found.add((int(vertex[some[column]]), int(vertex[j])))
    pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def components(edges: DataFrame) -> DataFrame:
    """(vertex, label) for every vertex of an edge: label is the smallest vertex it is connected with.

    Alternates large and small stars until the edges stay the same; each round is written to the shared folder.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")) \
            .where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("b", "least"), F.struct(F.col("a").alias("b"), "least")))
                                              .alias("edge")).select(F.col("edge.b").alias("a"), F.col("edge.least").alias("b"))
        edges = stored(small.where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    labels = edges.select(F.col("a").alias("vertex"), F.col("b").alias("label"))
    return labels.unionByName(edges.select(F.col("b").alias("vertex"), F.col("b").alias("label")).distinct())


def similar_groups(df: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, the columns ``keep``, n_shingles, component_id and group of every row.

    ``component_id`` is the smallest key among the rows connected by links, the row's own included; null keys are
    not the smallest of anything but themselves.  Texts without words (or null) have an empty set and no links.
    ``group`` tells groups apart (rows without words share one number).  Rows that repeat are one vertex and are all
    returned.  An empty table gives no rows.
    """
    keep = [name for name in keep if name not in (key, "n_shingles", "component_id", "group")]
    rows = df.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    carried = df.select(F.col(key).alias("__key"), F.col(key).cast("long").alias("doc"), *[F.col(f"`{name}`").alias(f"__{name}") for name in keep],
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = carried.drop("text").schema.add("vertex", "long").add("n_shingles", "long").add("n_sampled", "long")
    members = stored(carried.mapInArrow(describe, schema), "members")
    n_least = F.floor(F.col("n_shingles") / 4)                     # what a partner may lack
    mixed = members.where("n_shingles > 0").join(count_shared(rows, "text", True), "vertex", "left") \
        .where(F.col("n_sampled") - F.coalesce("shared", F.lit(0)) <= n_least).groupBy("vertex").agg(F.min("doc").alias("doc"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in blocks(batches, "text", BLOCK):
            items = raw_texts(batch, "text")
            values, counts = shingle_sets(items)
            yield pa.RecordBatch.from_arrays(
                [pa.array(set_numbers(values, counts)), pa.array(counts.astype(np.int64)), binaries(sketches(values, counts)),
                 binaries(list(map(packer.compress, items)))], ["vertex", "n_shingles", "sketch", "packed"])

    mixed = stored(mixed, "mixed")
    some = stored(likely(rows, "doc", mixed).select("text").mapInArrow(pack, "vertex long, n_shingles long, sketch binary, packed binary")
                  .join(mixed.select("vertex"), "vertex", "left_semi").dropDuplicates(["vertex"]), "sets")
    sets = stored(some.join(count_shared(some, "packed", False), "vertex")
                  .where(F.col("n_shingles") - F.col("shared") <= n_least)
                  .select("vertex", F.col("n_shingles").alias("n"), (F.col("n_shingles") - F.col("shared")).alias("own"), "sketch", "packed"), "sets")
    one_list = Window.partitionBy("list")
    lists = stored(shared_lists(sets).join(sets.select("vertex", "n", "own"), "vertex")
                   .withColumn("most", F.floor(7 * (F.col("n") - F.col("own")) / 3) - F.col("n"))
                   .withColumn("least", F.min("n").over(one_list)).where("most >= least")
                   .withColumn("members", F.count("*").over(one_list)).where("members > 1")
                   .withColumn("first", F.first(F.struct("vertex", "n", "most")).over(one_list.orderBy("own", "vertex")))
                   .select("list", "vertex", "n", "most", F.col("first.vertex").alias("hub"), F.col("first.n").alias("hub_n"),
                           F.col("first.most").alias("hub_most")), "lists")

    stars = lists.where("vertex <> hub AND n <= hub_most AND hub_n <= most").select(F.least("hub", "vertex").alias("a"), F.greatest("hub", "vertex").alias("b")).distinct()
    edges = stored(verified(stored(hopeful(stars, sets), "pairs"), sets), "links")
    labels = components(edges)

    more = stored(compared(lists, labels, sets), "links")
    if not more.isEmpty():
        labels = components(edges.unionByName(more))

    grouped = members.join(labels, "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))
    smallest = grouped.where("n_shingles > 0").groupBy("label").agg(F.min("doc").alias("component_id"))
    return grouped.join(smallest, "label", "left").select(
        F.col("__key").alias(key), *[F.col(f"__{name}").alias(name) for name in keep], "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"),
        F.col("label").alias("group"))


def op8_jaccard(spark, sf_dir: str) -> DataFrame:
    """The group of similar documents that each document belongs to."""
    return similar_groups(read(spark, sf_dir, "documents")).drop("group")
