"""Packing along a space-filling curve: similar documents share sequences, and almost nothing is padded.

1. Each document is tokenized and its tokens, hashed to a fixed number of slots, are projected to three numbers.
   They are its place on a grid, and the place's number along a Hilbert curve is its key.
2. The tokenized documents are written once, in the folder all executors share: the range sort reads its input
   twice (bounds, then rows), and a lost executor then costs a read, not the tokenizing.
3. They are range-sorted by (key, hash of id and content), so that equal documents do not all meet in one task,
   and each range is cut into sequences of ``size`` tokens.  Only the last sequence of a range can be short.  The
   number of ranges follows the tokens, not the session: a range has some 128 sequences at least and 64 million
   tokens at most, so short sequences are under one in a hundred from 128 sequences on, and memory is bounded.

Ids are those of the tokenizers library for the byte-level vocabulary, computed with tiktoken from the same
vocabulary as ranks, which is several times faster; the tests hold the two against each other.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import binaries, blocks, mix, parallelism, raw_texts, read
from wattlake.session import stored

SLOTS, AXES, BITS = 512, 3, 10         # hashed token slots, dimensions and bits per dimension of the grid
END_OF_TEXT, END_ID = "<|endoftext|>", 50256
LEAST_SEQUENCES, MOST_TOKENS = 128, 1 << 26            # of a range, on average
LONG_TEXT = 1 << 16                    # white-space characters from which on a run is encoded on its own
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}")     # what \\s is in the pattern


def projection(seed: int = 7) -> np.ndarray:
    """A fixed random matrix of signs, from hashed token slots to the grid's axes."""
    return (mix(np.arange(SLOTS * AXES, dtype=np.uint64) + np.uint64(seed << 32)) & np.uint64(1)) \
        .astype(np.float64).reshape(SLOTS, AXES) * 2 - 1


def hilbert(points: np.ndarray) -> np.ndarray:
    """The number along the Hilbert curve of points on a grid of 2**BITS per axis (rows: points).

    From the highest bit down, an axis whose bit is set flips the first axis' lower bits and one whose bit is
    clear swaps them with its own; the bits, interleaved and Gray-decoded, are the number.
    """
    x = [points[:, axis].astype(np.int64) for axis in range(points.shape[1])]
    for bit in range(BITS - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in range(len(x)):
            is_set = (x[axis] >> bit) & 1 == 1
            swapped = np.where(is_set, 0, (x[0] ^ x[axis]) & low)
            first = np.where(is_set, x[0] ^ low, x[0] ^ swapped)
            if axis:
                x[axis] = x[axis] ^ swapped
            x[0] = first
    for axis in range(1, len(x)):
        x[axis] = x[axis] ^ x[axis - 1]
    turned = np.zeros_like(x[0])
    for bit in range(BITS - 1, 0, -1):
        turned ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    key = np.zeros_like(x[0])
    for bit in range(BITS - 1, -1, -1):
        for axis in x:
            key = key << 1 | ((axis ^ turned) >> bit & 1)
    return key


def place(ids: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """A document's place on the grid: its hashed token counts, damped, centred, projected and squashed."""
    counts = np.sqrt(np.bincount(ids % SLOTS, minlength=SLOTS))
    counts -= counts.mean()
    size = np.sqrt((counts * counts).sum()) or 1.0
    return np.minimum((1 << BITS) - 1, (1 << BITS) / (1 + np.exp(-2 * (counts @ signs) / size))).astype(np.int64)


class Encoder:
    def __init__(self, ranks: bytes, pattern: str):
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                                       mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs})

    def ordinary(self, text: str) -> list[int]:
        """The ids of a text without special tokens.

        On a white-space run of a million characters the pattern's search would run out of stack.  All of a run but
        its last character (at the text's end: all) is one match of the pattern, so long runs are taken out.
        """
        if len(text) < LONG_TEXT:
            return self.coder.encode_ordinary(text)
        ids: list[int] = []
        done = 0
        for run in WHITE.finditer(text):
            begin, end = run.span()
            if end - begin < LONG_TEXT:
                continue
            stop = end if end == len(text) else end - 1
            ids += self.coder.encode_ordinary(text[done:begin])
            ids += self.coder._encode_single_piece(text[begin:stop])
            done = stop
        return ids + self.coder.encode_ordinary(text[done:])

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, then id 1."""
        ids: list[int] = []
        for i, part in enumerate(text.split(END_OF_TEXT)):
            if i:
                ids.append(END_ID)
            ids += self.ordinary(part)
        ids.append(1)
        return np.array(ids, "<u4")


def _worker(ranks: bytes, pattern: str, made: dict = {}) -> Encoder:  # noqa: B006  one per worker process
    key = hash((ranks, pattern))
    if key not in made:
        made.clear()
        made[key] = Encoder(ranks, pattern)
    return made[key]


def id_type(ranks: bytes) -> str:
    """How ids are written between the steps: 16 bits each if the vocabulary fits, else 32."""
    most = max((int(line.split()[1]) for line in ranks.splitlines() if line), default=0)
    return "<u2" if max(most, END_ID) < 1 << 16 else "<u4"


def n_ranges(tokens: int, size: int, tasks: int) -> int:
    """Ranges for so many tokens in all: as many as tasks, unless they got too few or too many tokens."""
    return max(1, -(-tokens // MOST_TOKENS), min(tasks, tokens // (LEAST_SEQUENCES * size)))


def tokenize(df: DataFrame, ranks: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids, n_ids, curve (Hilbert number), tie (a hash) of each row; ids have ``id_type``'s bits each."""
    kind_of_id = id_type(ranks)
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern))
    signs = projection()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker(*shared.value)
        for batch in blocks(batches, "text"):
            ids = [encoder.encode(value.decode("utf-8", "replace")) for value in raw_texts(batch, "text")]
            points = np.array([place(x, signs) for x in ids]).reshape(-1, AXES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), binaries([x.astype(kind_of_id).tobytes() for x in ids]),
                 pa.array([len(x) for x in ids], pa.int64()), pa.array(hilbert(points), pa.int64())],
                ["key", "tie", "ids", "n_ids", "curve"])

    rows = df.select(F.col(key).alias("key"), F.xxhash64(F.col(key), F.col(text)).alias("tie"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, tie long, ids binary, n_ids long, curve long")


def pack(df: DataFrame, ranks: bytes, pattern: str, size: int = 2048, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Packs every row's tokens into sequences of at most ``size``: one row per piece.

    ``key``, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, curve.
    A null or empty text is its closing id alone.  Rows with the same key are documents of their own; equal rows
    are packed once each.  An empty table gives no rows.  Other columns are not carried.
    """
    ready = stored(tokenize(df, ranks, pattern, key, text), "tokens")
    tokens = ready.agg(F.sum("n_ids")).first()[0] or 0
    kind_of_id = id_type(ranks)
    kind = ready.schema["key"].dataType.simpleString()
    schema = (f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
              "`offset` long, curve long")
    names = ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "curve"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, filled = TaskContext.get().partitionId() << 40, 0
        for batch in blocks(batches, "ids", 1 << 20):
            rows: list[list] = [[] for _ in names]
            keys = batch.column(0)
            owners = []
            for i, (packed, curve) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                ids = np.frombuffer(packed, kind_of_id).astype("<u4")
                start = 0
                while start < len(ids):
                    length = min(size - filled % size, len(ids) - start)
                    owners.append(i)
                    for column, value in zip(rows[1:], (start, length, ids[start:start + length].tobytes(), len(ids),
                                                        base + filled // size, filled % size, curve)):
                        column.append(value)
                    start, filled = start + length, filled + length
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(owners, pa.int64())),
                 *(pa.array(column, pa.binary() if name == "ids" else pa.int64())
                   for name, column in zip(names[1:], rows[1:]))], names)

    ordered = ready.repartitionByRange(n_ranges(tokens, size, parallelism(df.sparkSession)), "curve", "tie") \
        .sortWithinPartitions("curve", "tie", "key", "ids").select("key", "ids", "curve")
    return ordered.mapInArrow(run, schema).withColumnRenamed("key", key)


def ranks_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def pack_documents(df: DataFrame, path: str | None = None, **options) -> DataFrame:
    """``pack`` with the byte-level vocabulary that the queries use."""
    import public_tokenizers
    return pack(df, ranks_file(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN,
                **options)


def op9_packing(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents packed; each piece with the checksum of its ids."""
    rows = pack_documents(read(spark, sf_dir, "documents"), path)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                       "offset", "curve")
