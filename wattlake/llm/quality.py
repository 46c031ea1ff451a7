"""Quality rules: word counts, repetition, and bands of compression ratios.

A text is compressed with zstandard as a whole and in fixed chunks.  Ratios (bytes before / bytes after) above a
limit mean repetition or templates, ratios below one mean noise.  Longer texts compress better, so the limits of
the whole text depend on its length: ``BANDS`` gives them at some lengths, with straight lines in the logarithm
of the length between.  Chunks all have the same length and so one pair of limits; a text is rejected if more
than ``BAD_CHUNKS`` of its chunks lie outside.  The last chunk ends with the text, reaching back into the one before,
so that every byte is in a chunk.  Texts shorter than the first length of ``BANDS`` are not
judged by compression, because a short text's ratio says little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import blocks, raw_texts, read

LEVEL, CHUNK = 3, 4096
BANDS = [(256, 1.10, 1.95), (512, 1.20, 1.98), (1024, 1.30, 2.08), (2048, 1.40, 2.20), (4096, 1.50, 2.30),
         (8192, 1.55, 2.40), (16384, 1.60, 2.48), (32768, 1.65, 2.54), (65536, 1.70, 2.62), (131072, 1.70, 2.72),
         (1048576, 1.70, 3.20)]                                            # bytes, lowest and highest ratio
CHUNK_BAND, BAD_CHUNKS = (1.45, 2.35), 0.5
SYMBOLS, SPACES = b"#*$%&|<>", b"\t\n\x0b\x0c\r "
MIN_WORDS, MAX_REPEATED = 50, 50                                           # words; hundredths of the words

COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, zstd_ratio double, bad_chunk_share double")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in some 3-word window found at least twice."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    _, inverse, counts = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    starts = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:len(words) - 2 + shift] |= starts
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def ratio(text: bytes, compressor: zstandard.ZstdCompressor) -> float:
    return len(text) / len(compressor.compress(text))


def verdict(text: bytes, compressor: zstandard.ZstdCompressor) -> tuple[bool, float | None, float | None]:
    """Whether the ratios lie in their bands; the whole text's ratio; the share of chunks outside."""
    if len(text) < BANDS[0][0]:
        return True, None, None
    sizes, low, high = np.array(BANDS).T
    whole, place = ratio(text, compressor), np.log2(len(text))
    kept = np.interp(place, np.log2(sizes), low) <= whole <= np.interp(place, np.log2(sizes), high)
    share = None
    if len(text) >= CHUNK:
        starts = [*range(0, len(text) - CHUNK, CHUNK), len(text) - CHUNK]
        found = [ratio(text[at:at + CHUNK], compressor) for at in starts]
        share = float(np.mean([not CHUNK_BAND[0] <= value <= CHUNK_BAND[1] for value in found]))
        kept = kept and share <= BAD_CHUNKS
    return bool(kept), whole, share


def judge(text: bytes, compressor: zstandard.ZstdCompressor) -> tuple:
    """The values of ``COLUMNS`` for one text."""
    words = text.split()
    chars = len(text.decode("utf-8", "replace")) - (len(text) - len(text.translate(None, SPACES)))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    repeated = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED * len(words)
    fits, whole, share = verdict(text, compressor)
    return len(words), chars, symbols, repeated_lines(text), repeated, failed, fits and not failed, whole, share


def quality(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: doc_id) and ``COLUMNS`` of every row.

    Every text is read whole.  A null or empty text has no words and fails.  Columns in ``keep`` that are called
    like one of ``COLUMNS`` are replaced; rows that repeat get the same answer each.
    """
    names = [field.split()[0] for field in COLUMNS.split(", ")]
    keep = [name for name in (["doc_id"] if keep is None else keep) if name not in names]
    rows = df.select(F.col(text).cast("string").alias("__text"), *[F.col(f"`{name}`") for name in keep])
    schema = rows.drop("__text").schema
    for field in COLUMNS.split(", "):
        schema = schema.add(*field.split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
        for batch in blocks(batches, "__text"):
            found = list(zip(*[judge(value, compressor) for value in raw_texts(batch, "__text")]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array(values, kind) for values, kind in zip(found, kinds))],
                [*keep, *names])

    return rows.mapInArrow(run, schema)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """The quality rules on every document."""
    return quality(read(spark, sf_dir, "documents"))
