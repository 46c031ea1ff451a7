"""Document quality by a convolutional network over bytes, in numpy: fitted here, scored over every whole text.

A text is its UTF-8 bytes.  Each byte is looked up in a learned table of ``EMBED`` numbers; learned filters of
``2 * UNIT`` bytes step over the text by ``UNIT`` bytes.  Chunks of ``CHUNK_BLOCKS`` blocks of 64 bytes overlap by one
block and together cover the text; a chunk's features are its filters' largest answers (max-pooling).  The largest
and the mean answer over all chunks go through one hidden layer into one probability.  Nothing but the bytes enters.

Fitting is on the driver, on a bounded sample of labelled rows: at most ``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES`` of
text, the smallest hashes of their ids.  Scoring is one pass without a shuffle; a long text is scored piece by piece,
all pieces of it, in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import blocks, raw_texts, read

UNIT, BLOCK_UNITS, CHUNK_BLOCKS = 4, 16, 4
BLOCK = UNIT * BLOCK_UNITS                  # 64 bytes; a chunk has 256, the next one starts 192 further
STEP = CHUNK_BLOCKS - 1
EMBED, FILTERS, HIDDEN = 8, 24, 16
PIECE = 1024 * STEP * BLOCK                 # bytes of a text convolved at once, a whole number of chunk steps
SAMPLE_ROWS, SAMPLE_BYTES = 4096, 16 << 20
EPOCHS, LEAST_STEPS, BATCH_ROWS, RATE = 6, 600, 32, 0.004
THRESHOLD = 0.3
HELD_OUT_FOLDS = 5


class Pieces:
    """Bytes of some texts laid out for the filters, with the chunks' blocks and each chunk's text."""

    def __init__(self, texts: list[bytes], owners: list[int]):
        padded = [-(-(len(text) + UNIT) // BLOCK) for text in texts]       # blocks; at least one empty unit at the end
        self.raw = np.frombuffer(b"".join(text.ljust(n * BLOCK, b"\0") for text, n in zip(texts, padded)), np.uint8)
        ends = np.cumsum(padded)
        self.last_units = ends * BLOCK_UNITS - 1                           # their filters would reach into the next text
        chunks = [max(1, -(-(n - 1) // STEP)) for n in padded]
        self.chunk_blocks, owner = [], []
        first = np.repeat(ends - padded, chunks) + STEP * (np.arange(sum(chunks)) - np.repeat(np.cumsum(chunks) - chunks, chunks))
        last = np.repeat(ends, chunks) - 1
        # four blocks for each chunk; a chunk that meets the end of its text names its last block again
        self.chunk_blocks = np.minimum(first[:, None] + np.arange(CHUNK_BLOCKS), last[:, None])
        self.owner = np.repeat(np.asarray(owners), chunks)


def answers(model: dict, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedded units, each chunk's largest answer of every filter (not below 0), and the unit it was given at."""
    units = model["embed"][pieces.raw].reshape(-1, UNIT * EMBED)
    given = units @ model["near"]
    given[:-1] += (units @ model["far"])[1:]
    given += model["bias"]
    given[pieces.last_units] = -np.inf
    by_block = given.reshape(-1, BLOCK_UNITS, FILTERS)
    at = by_block.argmax(1)
    best = np.take_along_axis(by_block, at[:, None], 1)[:, 0]
    of_chunk = best[pieces.chunk_blocks]
    which = of_chunk.argmax(1)
    block = np.take_along_axis(pieces.chunk_blocks, which, 1)
    unit = block * BLOCK_UNITS + at[block, np.arange(FILTERS)]
    return units, np.maximum(0, np.take_along_axis(of_chunk, which[:, None], 1)[:, 0]), unit


def combined(model: dict, top: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs of the hidden layer, its answers, and the probability."""
    features = np.concatenate([top, mean], axis=1)
    hidden = np.maximum(0, features @ model["w1"] + model["b1"])
    return features, hidden, 1 / (1 + np.exp(-np.clip(hidden @ model["w2"] + model["b2"], -30, 30)))


def start_model(seed: int) -> dict:
    draw = np.random.default_rng(seed)

    def layer(*shape: int, fan: int) -> np.ndarray:
        return (draw.standard_normal(shape) * np.sqrt(2 / fan)).astype(np.float32)

    wide = 2 * UNIT * EMBED
    return {"embed": layer(256, EMBED, fan=2), "near": layer(UNIT * EMBED, FILTERS, fan=wide),
            "far": layer(UNIT * EMBED, FILTERS, fan=wide), "bias": np.zeros(FILTERS, np.float32),
            "w1": layer(2 * FILTERS, HIDDEN, fan=2 * FILTERS), "b1": np.zeros(HIDDEN, np.float32),
            "w2": layer(HIDDEN, fan=HIDDEN), "b2": np.zeros((), np.float32)}


def gradients(model: dict, texts: list[bytes], labels: np.ndarray) -> dict:
    """Gradients of the mean log loss over some texts."""
    pieces = Pieces(texts, list(range(len(texts))))
    units, best, unit = answers(model, pieces)
    counts = np.bincount(pieces.owner, minlength=len(texts))
    starts = np.cumsum(counts) - counts
    top = np.maximum.reduceat(best, starts)
    features, hidden, score = combined(model, top, np.add.reduceat(best, starts) / counts[:, None])
    d_out = ((score - labels) / len(texts)).astype(np.float32)
    d_hidden = np.outer(d_out, model["w2"]) * (hidden > 0)
    d_features = d_hidden @ model["w1"].T
    # a chunk passes on its share of the mean, and all of the maximum where it is the text's first largest
    d_best = d_features[pieces.owner, FILTERS:] / counts[pieces.owner, None]
    largest = best == top[pieces.owner]
    before = np.cumsum(largest, axis=0) - largest
    d_best += d_features[pieces.owner, :FILTERS] * (largest & (before == before[starts][pieces.owner]))
    d_best *= best > 0
    following = np.minimum(unit + 1, len(units) - 1)
    d_near, d_far = np.einsum("cfu,cf->uf", units[unit], d_best), np.einsum("cfu,cf->uf", units[following], d_best)
    d_embed = np.zeros_like(model["embed"])
    letters = pieces.raw.reshape(-1, UNIT)
    for places, weights in ((unit, model["near"]), (following, model["far"])):
        spread = (d_best[:, :, None] * weights.T[None]).reshape(-1, EMBED)
        letter = letters[places].ravel()
        for column in range(EMBED):
            d_embed[:, column] += np.bincount(letter, weights=spread[:, column], minlength=256)
    return {"embed": d_embed, "near": d_near, "far": d_far, "bias": d_best.sum(0),
            "w1": features.T @ d_hidden, "b1": d_hidden.sum(0), "w2": hidden.T @ d_out, "b2": d_out.sum()}


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> dict:
    """The network after ``EPOCHS`` rounds of Adam, more where the sample is small; the same for the same sample."""
    model, draw = start_model(seed), np.random.default_rng(seed)
    if not len(texts):
        return model
    share = float(np.clip(np.mean(labels), 0.01, 0.99))
    model["b2"] = np.float32(np.log(share / (1 - share)))
    first = {name: np.zeros_like(value) for name, value in model.items()}
    second = {name: np.zeros_like(value) for name, value in model.items()}
    rounds = max(EPOCHS, -(-LEAST_STEPS * BATCH_ROWS // len(texts)))
    steps, done = rounds * -(-len(texts) // BATCH_ROWS), 0
    for _ in range(rounds):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH_ROWS):
            some = order[at:at + BATCH_ROWS]
            done += 1
            rate = RATE * (1 - done / (steps + 1)) * np.sqrt(1 - 0.999 ** done) / (1 - 0.9 ** done)
            for name, change in gradients(model, [texts[i] for i in some], labels[some]).items():
                first[name] = (0.9 * first[name] + 0.1 * change).astype(np.float32)
                second[name] = (0.999 * second[name] + 0.001 * change * change).astype(np.float32)
                model[name] = (model[name] - rate * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    return model


def fold(key: str) -> Column:
    """crc32 of the id as text, modulo the folds; null for a null id."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(HELD_OUT_FOLDS))


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                  rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> DataFrame:
    """(text, label): documents of the labels outside the held-out fold with the smallest hashes, bounded in rows and bytes.

    The labels are chosen first, so that the documents are joined with ``rows`` ids at most and not exchanged.  Texts
    that alone take more than a sixteenth of the bytes are left out of the sample.  An id with several labels or texts
    gives a row for each pair.
    """
    hashed = F.xxhash64("key").alias("hash")
    known = labels.select(F.col(key).cast("long").alias("key"), F.col(label).cast("int").alias("label")) \
        .where("key IS NOT NULL AND label IN (0, 1)").where(fold("key") != 0).distinct()
    known = known.select("*", hashed).orderBy("hash", "key", "label").limit(rows)
    length = F.octet_length("text")
    chosen = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")) \
        .where(F.col("text").isNotNull() & (length <= size // 16)).join(F.broadcast(known), "key") \
        .orderBy("hash", "key", "label", "text").limit(rows)
    before = F.sum(length).over(Window.orderBy("hash", "key", "label", "text").rowsBetween(Window.unboundedPreceding, 0))
    return chosen.withColumn("upto", before).where(F.col("upto") <= size).select("text", "label")


def score_texts(docs: DataFrame, model: dict, key: str, text: str) -> DataFrame:
    """(doc_id, score) of every row, over its whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "text", PIECE * 4):
            texts = raw_texts(part, "text")
            top, total = np.zeros((len(texts), FILTERS), np.float32), np.zeros((len(texts), FILTERS))
            counts = np.zeros(len(texts), np.int64)

            def take(waiting: list[bytes], owners: list[int]) -> None:
                pieces = Pieces(waiting, owners)
                best = answers(model, pieces)[1]
                starts = np.nonzero(np.diff(pieces.owner, prepend=-1))[0]
                present = pieces.owner[starts]
                top[present] = np.maximum(top[present], np.maximum.reduceat(best, starts))
                total[present] += np.add.reduceat(best.astype(np.float64), starts)
                counts[present] += np.diff(np.append(starts, len(best)))

            waiting, owners, held = [], [], 0
            for row, raw in enumerate(texts):
                # a piece but the last reads one block of the next, which its last chunk ends with
                for start in range(0, max(1, len(raw)), PIECE):
                    waiting.append(raw[start:start + PIECE + BLOCK] if len(raw) - start > PIECE + BLOCK else raw[start:])
                    owners.append(row)
                    held += len(waiting[-1])
                    if len(raw) - start <= PIECE + BLOCK:
                        break
                if held >= PIECE:
                    take(waiting, owners)
                    waiting, owners, held = [], [], 0
            if waiting:
                take(waiting, owners)
            score = combined(model, top, total / counts[:, None])[2]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score.astype(np.float64), pa.float64())],
                                             ["doc_id", "score"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: a row for every document.

    ``held_out`` is true where crc32 of the id as text is divisible by five; such rows' labels are never read.  A
    null text counts as empty and an empty text has a score; a null id is neither held out nor learned from.  Rows
    that repeat are scored alike.  Without labels the network is as drawn.  Additional columns are not looked at.
    """
    sample = training_rows(docs, labels, key, text).toArrow()
    texts = [value.encode("utf-8", "surrogatepass") for value in sample.column("text").to_pylist()]
    model = fit(texts, sample.column("label").to_numpy().astype(np.float32))
    return score_texts(docs, model, key, text).select(
        "doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op12_convnet(spark, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
