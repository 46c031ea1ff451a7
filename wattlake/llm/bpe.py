"""BPE encoding by longest matches with backtracking, and decoding from an offset table.

A word is encoded left to right.  An Aho-Corasick automaton gives the longest token at each position; it is
taken if BPE would not merge across the border to the token before it, which a pair-compatibility table tells,
and shortened to its longest proper prefix token, or the token before it undone, otherwise.  A border found
impossible once is not tried again, so the work is linear in the word and the tokens are those of the merges.

The vocabulary file's normaliser (NFC, lower case), pattern and byte alphabet are applied to runs without white
space, since no token spans white space, and runs seen before come from a cache of bounded size.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import WordCache, binaries, blocks, ragged, raw_texts, read

WORD_END = "</w>"
FINAL = 0x1000               # added to a word's last character, which is an atom of its own
PAIRS = 1_000_000            # entries of the compatibility table that a worker keeps
# How the vocabulary's file splits a text into words (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
DECODE_TOKENS = 1 << 16      # tokens decoded at once


def byte_alphabet() -> list[str]:
    """The printable character of each byte in byte-level vocabularies: itself, or the next one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (byte for byte in range(256) if byte not in shown)
    return [table[byte] for table in [{**{byte: chr(byte) for byte in shown},
                                       **{byte: chr(256 + i) for i, byte in enumerate(hidden)}}] for byte in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, definition: str):
        loaded = json.loads(definition)
        self.ids: dict[str, int] = loaded["model"]["vocab"]
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in loaded["model"]["merges"]]
        self.special = {token["content"]: token["id"] for token in loaded["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                           + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)
        self.alphabet = dict(enumerate(byte_alphabet()))

        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.length = [0] * size
        self.rank, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.merge_rank: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            made, one, two = self.ids[a + b], self.ids[a], self.ids[b]
            self.merge_rank[one, two] = rank
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = rank, one, two
        self.atoms = {self.folded(token): number for token, number in self.ids.items()}
        self.shorter = [-1] * size
        self.automaton = ahocorasick.Automaton()
        for token, number in self.atoms.items():
            self.length[number] = len(token)
            self.automaton.add_word(token, (len(token), number))
            self.shorter[number] = next((self.atoms[token[:n]] for n in range(len(token) - 1, 0, -1)
                                         if token[:n] in self.atoms), -1)
        self.automaton.make_automaton()
        self.pairs = WordCache(self.compatible, PAIRS)
        self.pieces = WordCache(self.encode_piece)
        self.cache = WordCache(self.encode_run)

        names = {number: token for token, number in [*self.ids.items(), *self.special.items()]}
        shown = [(names.get(number, "") + " ").encode() for number in range(size)]
        self.offsets = np.concatenate([[0], np.cumsum([len(text) for text in shown])])
        self.letters = np.frombuffer(b"".join(shown), np.uint8)

    @staticmethod
    def folded(token: str) -> str:
        if not token.endswith(WORD_END) or token == WORD_END:
            return token
        body = token[:-len(WORD_END)]
        return body[:-1] + chr(ord(body[-1]) + FINAL)

    def compatible(self, pair: tuple[int, int]) -> bool:
        """Whether BPE leaves the border between two tokens alone.

        The merges that made both are undone, the latest first.  At each moment the two tokens at the border
        would have merged if their rank came before the merge undone last; of equal ranks the left one is first.
        """
        a, b = pair
        limit = 1 << 60
        while True:
            if self.merge_rank.get((a, b), 1 << 60) < limit:
                return False
            if self.rank[a] > self.rank[b]:
                limit, a = self.rank[a], self.right[a]
            elif self.rank[b] >= 0:
                limit, b = self.rank[b] + 1, self.left[b]
            else:
                return True

    def encode_piece(self, piece: str) -> list[int]:
        """The tokens of one match of the pattern."""
        shown = piece.encode().decode("latin-1").translate(self.alphabet)
        word = shown[:-1] + chr(ord(shown[-1]) + FINAL)
        whole = self.atoms.get(word)
        size = len(word)
        longest: list[int] = [-1] * size
        reach = [0] * size
        for end, (length, number) in self.automaton.iter(word):
            if length > reach[end - length + 1]:
                reach[end - length + 1], longest[end - length + 1] = length, number
        taken: list[int] = []
        possible = [True] * (size + 1)
        at, token = 0, whole if whole is not None else longest[0]
        while at < size:
            while token >= 0:
                end = at + self.length[token]
                if possible[end] and (not taken or self.pairs[taken[-1], token]):
                    break
                token = self.shorter[token]
            if token >= 0:
                taken.append(token)
                at = end
                token = longest[at] if at < size else -1
            else:
                possible[at] = False
                token = taken.pop()
                at -= self.length[token]
        return taken

    def encode_run(self, run: bytes) -> bytes:
        """The ids of a run without ASCII white space, as little-endian unsigned 32-bit integers."""
        parts = [run.decode("utf-8", "replace")]
        if self.special_split and "<" in parts[0]:
            parts = self.special_split.split(parts[0])
        ids: list[int] = []
        for part in parts:
            if part in self.special:
                ids.append(self.special[part])
                continue
            lowered = "".join(map(str.lower, unicodedata.normalize("NFC", part))) if not part.isascii() else part.lower()
            for piece in self.pattern.findall(lowered):
                ids += self.pieces[piece]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.cache.__getitem__, text.split()))

    def decode(self, ids: bytes) -> bytes:
        """The tokens joined by spaces, gathered from the offset table."""
        numbers = np.frombuffer(ids, "<u4")
        parts = []
        for start in range(0, len(numbers), DECODE_TOKENS):
            some = numbers[start:start + DECODE_TOKENS]
            begins = self.offsets[some]
            parts.append(self.letters[ragged(begins, self.offsets[some + 1] - begins)].tobytes())
        return b"".join(parts)[:-1]


def _worker(definition: str, made: dict = {}) -> WordBpe:  # noqa: B006  one per worker process
    key = hash(definition)
    if key not in made:
        made.clear()
        made[key] = WordBpe(definition)
    return made[key]


def encode(df: DataFrame, definition: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes each row's text: ``key``, n_tokens, ids (little-endian unsigned 32-bit integers, one after another).

    ``definition`` is the content of the vocabulary file.  One row per input row; a null or empty text has no
    tokens; other columns are not carried, so their names cannot clash.
    """
    shared = df.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _worker(shared.value)
        for batch in blocks(batches, "text"):
            ids = [coder.encode(value) for value in raw_texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), binaries(ids)],
                ["key", "n_tokens", "ids"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_tokens long, ids binary").withColumnRenamed("key", key)


def decode(df: DataFrame, definition: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the decoded text (special tokens included) of an ids column to each row of ``encode``'s result."""
    shared = df.sparkSession.sparkContext.broadcast(definition)
    schema = df.drop(out).select("*", F.lit("").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _worker(shared.value)
        for batch in blocks(batches, ids, 1 << 20):
            made = pa.array([coder.decode(value or b"").decode() for value in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, out])

    return df.drop(out).mapInArrow(run, schema)


def vocabulary(path: str) -> str:
    """A vocabulary file's content, read where the job starts and sent to the tasks (about 2 MB)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def op2_bpe(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    definition = vocabulary(path)
    rows = decode(encode(read(spark, sf_dir, "documents"), definition), definition)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
