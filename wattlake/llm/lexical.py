"""Ranked lexical search by the Best Position Algorithm over impact lists.

One pass over the documents counts the occurrences of the queries' terms and writes, for each document, its number
of terms and its postings; the texts are not read again.  A second, small pass sums document frequencies.  The third
ranks: a task takes the postings in blocks of bounded size, sorts each term's postings of the block by falling impact
(the impact list), and for each query reads all its lists downwards together.  A document met for the first time is
scored at once by direct access to its other postings, and every posting so touched is marked as seen.  A list's best
position is the last one up to which all positions have been seen, by either kind of access; the query's threshold is
the sum of the impacts at the best positions, which no unseen document can exceed.  Reading stops as soon as the
threshold is strictly below the k-th score, so that equal scores with smaller ids are not lost.  The k-th score is kept
from block to block of a task.

Documents are dealt by their place in the written postings, never by term, so that a frequent word is spread like any
other; what is exchanged is k rows for each query and task, merged in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import best_rows, blocks, ragged, raw_texts, read
from wattlake.session import stored

K = 20
QUERY_BLOCK, QUERY_BYTES = 4096, 4 << 20      # queries that share a pass over the documents: their number, their text
BLOCK_POSTINGS, BLOCK_DOCUMENTS = 1 << 21, 1 << 16
PIECE_BYTES = 4 << 20                         # of a long text split into terms at once
FIRST_DEPTH = 32

# Letters A to Z fall to a to z; other ASCII characters than letters and digits separate terms; all else belongs to them.
TERM_BYTES = bytes(32 if c < 48 or 57 < c < 65 or 90 < c < 97 or 122 < c < 128 else c + 32 if 65 <= c <= 90 else c
                   for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, a piece at a time; pieces end at separators."""
    lowered, start = text.translate(TERM_BYTES), 0
    while start < len(lowered):
        stop = len(lowered)
        if stop - start > PIECE_BYTES:
            stop = lowered.rfind(b" ", start, start + PIECE_BYTES)
            if stop <= start:                     # a term longer than a piece is taken whole
                stop = lowered.find(b" ", start + PIECE_BYTES)
            stop = len(lowered) if stop < 0 else stop
        yield lowered[start:stop].split()
        start = stop


def postings(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(doc, n, terms, counts) of each document with a term: how many terms, which of the vocabulary, how often."""
    size = max(1, len(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for part in blocks(batches, "text"):
            lengths, keys, tallies = [], [], []
            for row, raw in enumerate(raw_texts(part, "text")):
                length, found = 0, Counter()
                for words in terms(raw):
                    length += len(words)
                    found.update(words)
                lengths.append(length)
                held = [(row * size + place, n) for word, n in found.items() if (place := number(word)) is not None]
                keys.extend(k for k, _ in held)
                tallies.extend(n for _, n in held)
            keys, tallies = np.array(keys, np.int64), np.array(tallies, np.int64)
            order = np.argsort(keys)
            keys, tallies = keys[order], tallies[order]
            offsets = pa.array(np.searchsorted(keys, np.arange(part.num_rows + 1) * size), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(keys % size, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tallies, pa.int32()))], ["doc", "n", "terms", "counts"])

    return docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(count, "doc long, n long, terms array<int>, counts array<int>").where("n > 0")


def statistics(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms of all documents, and the documents that hold each term of the vocabulary."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
            documents += batch.num_rows
            length += sum(batch.column("n").to_pylist())
        places = np.concatenate([np.nonzero(held)[0], [size, size + 1]])
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()),
                                          pa.array(np.concatenate([held, [documents, length]])[places], pa.int64())],
                                         ["term", "held"])

    sums = np.zeros(size + 2, np.int64)
    rows = found.mapInArrow(tally, "term long, held long").groupBy("term").agg(F.sum("held").alias("held")).toArrow()
    sums[rows.column("term").to_numpy()] = rows.column("held").to_numpy()       # one number for each term of the queries
    return int(sums[size]), int(sums[size + 1]), sums[:size]


def term_weight(documents: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))


def impacts(counts: np.ndarray, lengths: list[int], owner: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a posting adds for a weight of one; the length part in Python's integers, which do not overflow."""
    m = np.array([75 + 25 * n * documents // total for n in lengths], np.int64)[owner]
    return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


class ImpactLists:
    """The postings of a block of documents: a list by falling impact for each term, and direct access by document."""

    def __init__(self, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        order = np.lexsort((owner, -impact, term))
        self.owner, self.term, self.impact = owner[order], term[order], impact[order]
        self.start = np.searchsorted(self.term, np.arange(n_terms + 1))
        self.places = np.argsort(self.owner, kind="stable")
        self.first = np.searchsorted(self.owner[self.places], np.arange(n_docs + 1))
        self.n_docs = n_docs
        self.read = 0                    # documents scored so far, for tests and tuning

    def search(self, numbers: np.ndarray, weights: np.ndarray, weight_of: np.ndarray, k: int,
               known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places in the block) and scores above 0 that hold every one of the k best.

        ``weight_of`` has the query's weight at each term and 0 elsewhere; ``known`` are scores that earlier blocks
        reached, the best k at most.
        """
        low, high = self.start[numbers], self.start[numbers + 1]
        used = (high > low) & (weights > 0)
        low, high, weights = low[used], high[used], weights[used]
        best, marked = low.copy(), np.zeros(len(self.owner), bool)
        met = np.zeros(self.n_docs, bool)
        top = np.sort(known)[-k:]
        docs, scores = [], []
        depth, step = 0, FIRST_DEPTH
        while True:
            starts = np.minimum(low + depth, high)
            read = np.unique(self.owner[ragged(starts, np.minimum(low + depth + step, high) - starts)])
            fresh = read[~met[read]]
            if len(fresh):
                met[fresh] = True
                lengths = self.first[fresh + 1] - self.first[fresh]
                places = self.places[ragged(self.first[fresh], lengths)]
                marked[places] = True
                parts = weight_of[self.term[places]] * self.impact[places]
                total = np.add.reduceat(parts, np.cumsum(lengths) - lengths)
                self.read += len(fresh)
                docs.append(fresh[total > 0])
                scores.append(total[total > 0])
                top = np.sort(np.concatenate([top, scores[-1]]))[-k:]
            for i in range(len(low)):
                while best[i] < high[i]:
                    ahead = marked[best[i]:min(best[i] + 4 * step, high[i])]
                    unseen = int(np.argmin(ahead))
                    if not ahead[unseen]:
                        best[i] += unseen
                        break
                    best[i] += len(ahead)
            # position 0 has no impact of its own: before any is seen, the list's first one bounds it
            bound = np.where(best < high, self.impact[np.maximum(best - 1, low).clip(max=max(0, len(self.impact) - 1))], 0) \
                if len(low) else np.zeros(0, np.int64)
            threshold = int((weights * bound).sum())
            if threshold <= 0 or (len(top) >= k and threshold < top[0]):
                break
            depth, step = depth + step, 2 * step
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        kept = scores >= top[0] if len(top) >= k else np.ones(len(docs), bool)
        return docs[kept], scores[kept]


def _query_blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[int, Counter]]]:
    """The queries in blocks of bounded number and text; the driver holds one block."""
    block, held = [], 0
    rows = items.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")) \
        .where("id IS NOT NULL AND text IS NOT NULL").distinct()
    for row in rows.toLocalIterator():
        raw = row["text"].encode("utf-8", "surrogatepass")
        if block and (len(block) >= QUERY_BLOCK or held + len(raw) > QUERY_BYTES):
            yield block
            block, held = [], 0
        block.append((row["id"], Counter(word for words in terms(raw) for word in words)))
        held += len(raw)
    if block:
        yield block


def _rank_block(docs: DataFrame, block: list[tuple[int, Counter]], k: int, key: str, text: str) -> DataFrame:
    vocabulary = {word: place for place, word in enumerate(sorted({word for _, found in block for word in found}))}
    size = len(vocabulary)
    found = stored(postings(docs, vocabulary, key, text), "postings")
    documents, total, held = statistics(found, size)
    weight = np.array([max(0, term_weight(documents, int(n))) for n in held], np.int64)
    asked = []
    for _, words in block:
        numbers = np.array([vocabulary[word] for word in words], np.int64)
        asked.append((numbers, weight[numbers] * np.array(list(words.values()), np.int64)))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in asked]
        weight_of = np.zeros(size, np.int64)
        for table in _gathered(batches):
            terms_column, counts_column = table.column("terms").combine_chunks(), table.column("counts").combine_chunks()
            term = terms_column.flatten().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(table.num_rows), terms_column.value_lengths().to_numpy())
            impact = impacts(counts_column.flatten().to_numpy().astype(np.int64), table.column("n").to_pylist(), owner,
                             documents, total)
            lists = ImpactLists(owner, term, impact, table.num_rows, size)
            nameless = table.column("doc").is_null().to_numpy()
            names = table.column("doc").fill_null(0).to_numpy()
            for place, (numbers, weights) in enumerate(asked):
                weight_of[numbers] = weights
                ids, none, scores = top[place]
                docs_found, scores_found = lists.search(numbers, weights, weight_of, k, scores)
                weight_of[numbers] = 0
                ids, none = np.concatenate([ids, names[docs_found]]), np.concatenate([none, nameless[docs_found]])
                scores = np.concatenate([scores, scores_found])
                first = np.lexsort((ids, none, -scores))[:k]
                top[place] = ids[first], none[first], scores[first]
        ids, none, scores = (np.concatenate(column) for column in zip(*top))
        query = np.repeat(np.arange(len(asked)), [len(x[0]) for x in top])
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int32()), pa.array(np.array([item for item, _ in block], np.int64)[query], pa.int64()),
             pa.array(ids, pa.int64(), mask=none), pa.array(scores, pa.int64())], ["query", "item_id", "doc_id", "score"])

    return best_rows(found.mapInArrow(rank, "query int, item_id long, doc_id long, score long"), ["query"],
                     [F.desc("score"), F.asc_nulls_last("doc_id")], k).select("item_id", "rank", "doc_id", "score")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together into blocks of bounded documents and postings."""
    waiting, rows, entries = [], 0, 0
    for batch in batches:
        for part in (batch.slice(at, 1024) for at in range(0, batch.num_rows, 1024)):
            n = len(part.column("terms").flatten())
            if waiting and (rows + part.num_rows > BLOCK_DOCUMENTS or entries + n > BLOCK_POSTINGS):
                yield pa.Table.from_batches(waiting)
                waiting, rows, entries = [], 0, 0
            waiting.append(part)
            rows, entries = rows + part.num_rows, entries + n
    if waiting:
        yield pa.Table.from_batches(waiting)


def search(docs: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents with the highest score above 0 for each item.

    The score is the integer BM25 of the module's weights; equal scores by smaller id.  A null or empty text has no
    terms: such a document is never found and not counted, such an item has no rows.  Items with a null id take no
    part; items repeated in full are one, and two texts under one id are ranked each for itself.  Every row of the
    documents is a document of its own, also with a repeated id; a null id comes last among equal scores.  Fewer than k
    documents are returned where fewer score above 0.  Empty tables give no rows.
    """
    parts = [_rank_block(docs, block, k, key, text) for block in _query_blocks(items, item_key, item_text)]
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    ranked = parts[0]
    for part in parts[1:]:
        ranked = ranked.unionAll(part)
    return ranked


def op11_lexical(spark, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
