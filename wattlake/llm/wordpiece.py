"""Word-piece lengths by a longest-match automaton in one pass over each word.

The vocabulary's tries (pieces that begin a word, pieces that continue one) form one automaton.  When a node has
no edge for the next byte, its failure link leads to the node that the rest of the word has reached after the
longest pieces were cut off, and a number kept at the node says how many pieces those were.  So a word's greedy
longest-match length is a sum of such numbers; no piece is built and no byte is read twice.

Vocabulary: the tokens of a byte-level vocabulary file.  A token with the mark of a space before it begins a
word, any other continues one.  Every single byte may do both, so no word is unknown; with other vocabularies
an unknown word counts as one piece, as usual for word pieces.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.bpe import byte_alphabet, vocabulary
from wattlake.llm.common import WordCache, blocks, raw_texts, read

SPACE_MARK = byte_alphabet()[32]


class PieceCounter:
    """Counts the word pieces of words, given the pieces that begin and continue words (as bytes)."""

    def __init__(self, begin: set[bytes], continued: set[bytes]):
        self.edges: dict[int, int] = {}              # node * 256 + byte -> node
        self.nodes = 2                               # 0: start of a word, 1: after a piece
        whole: dict[int, bool] = {}
        for root, pieces in ((0, begin), (1, continued)):
            for piece in pieces:
                node = root
                for byte in piece:
                    node = self.edges.setdefault(node << 8 | byte, self.nodes)
                    if node == self.nodes:
                        self.nodes += 1
                if piece:
                    whole[node] = True
        self.failure = [-1] * self.nodes
        self.popped = [0] * self.nodes               # pieces cut off on the way over the failure link
        children: dict[int, list[tuple[int, int]]] = {}
        for key, child in self.edges.items():
            children.setdefault(key >> 8, []).append((key & 255, child))
        queue = deque([0, 1])
        while queue:                                 # nearer nodes first: links lead to shallower nodes
            parent = queue.popleft()
            for byte, child in children.get(parent, ()):
                queue.append(child)
                if whole.get(child):
                    self.failure[child], self.popped[child] = 1, 1
                    continue
                node, pieces = self.failure[parent], self.popped[parent]
                while node >= 0 and (node << 8 | byte) not in self.edges:
                    pieces += self.popped[node]
                    node = self.failure[node]
                if node >= 0:
                    self.failure[child], self.popped[child] = self.edges[node << 8 | byte], pieces
        self.cache = WordCache(self.count)

    def count(self, word: bytes) -> int:
        """The number of greedy longest pieces of a word; 1 if some part of it matches none."""
        if not word:
            return 0
        node, pieces, edges = 0, 0, self.edges
        for byte in word:
            step = edges.get(node << 8 | byte)
            while step is None:
                pieces += self.popped[node]
                node = self.failure[node]
                if node < 0:
                    return 1
                step = edges.get(node << 8 | byte)
            node = step
        while node != 1:
            pieces += self.popped[node]
            node = self.failure[node]
            if node < 0:
                return 1
        return pieces


def piece_sets(definition: str) -> tuple[set[bytes], set[bytes]]:
    """The pieces that begin and that continue words, from a byte-level vocabulary file's content."""
    back = {char: byte for byte, char in enumerate(byte_alphabet())}
    single = {bytes([byte]) for byte in range(256)}
    begin, continued = set(single), set(single)
    for token in json.loads(definition)["model"]["vocab"]:
        if token.startswith(SPACE_MARK):
            begin.add(bytes(back[char] for char in token[1:]))
        else:
            continued.add(bytes(back[char] for char in token))
    return begin - {b""}, continued - {b""}


def _worker(definition: str, made: dict = {}) -> PieceCounter:  # noqa: B006  one per worker process
    key = hash(definition)
    if key not in made:
        made.clear()
        made[key] = PieceCounter(*piece_sets(definition))
    return made[key]


def count_pieces(df: DataFrame, definition: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_words (runs without ASCII white space), n_tokens and max_word_tokens of each row's text.

    One row per input row; a null or empty text has 0 words, 0 tokens and a largest word of 0 tokens.  Other
    columns are not carried, so their names cannot clash.
    """
    shared = df.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _worker(shared.value).cache
        for batch in blocks(batches, "text"):
            counts = [list(map(pieces.__getitem__, value.split())) for value in raw_texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(map(f, counts), pa.int64())
                                    for f in (len, sum, lambda x: max(x, default=0)))],
                ["key", "n_words", "n_tokens", "max_word_tokens"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_words long, n_tokens long, max_word_tokens long") \
        .withColumnRenamed("key", key)


def op10_wordpiece(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Words and greedy word pieces of every document."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    return count_pieces(read(spark, sf_dir, "documents"), vocabulary(path))
