"""Removal of long passages that an earlier document already has, by sorting hashed suffixes.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller id.  So each
start of such a string is a suffix to be sorted, to depth ``LENGTH``, with the suffixes of all other documents.

Sorting all suffixes of a corpus in one order would move each of them.  But equal strings have equal contents, so
they may be dealt by anything computed from the contents: every string of ``LENGTH`` bytes is dealt by the
smallest hash of the ``GRAM``-byte strings in it.  Neighbouring strings mostly share that key, so a document is a
few runs of strings per hundred bytes, each with one key.

1. keys     Each home of documents (a hash of their ids) sends its distinct keys to the keys' buckets, with the number
            of different runs it has of each; a bucket tells the homes which keys are in more than one document.
2. slices   Each home sends, for every run with such a key, the run's bytes once, with the smallest id of the
            home's documents that have it: many copies in one home are one slice.  A key that too many slices carry
            is split: its runs are cut into their strings, which are dealt each by its own hash.
3. sorting  A bucket sorts the suffixes of its slices, in ``SUBS`` parts of its keys one after another, equal slices
            once.  Suffixes are put in order by their first 8 bytes, then merged: lists of suffixes with the same 8
            bytes, two by two.  Each comparison finds the common extension of two suffixes by binary search over
            prefix polynomial hashes, and is checked byte for byte, so a collision cannot remove anything.
            Suffixes with an extension of ``LENGTH`` are one class from then on; its smallest id decides.  The spans
            of strings that a smaller id has go back to the homes that sent the slices.
4. marking  Each home marks what is covered, document by document.

The text is shuffled once, by home; steps 1, 2 and 4 share that exchange.  A home takes its documents in the order of
id and text, so that places sent in step 2 mean the same in step 4, also if a task runs again.  Buckets and homes follow
the session's shuffle partitions, as those follow the input.  A key that very many documents have (a passage in a third
of them) reaches its bucket once per home.  So do its slices where they are equal; but the runs at the passage's two
edges take in each document's own neighbouring bytes and differ, one slice per document.  Such keys have more than
``SPLIT`` slices, more than one in ``SHARE`` of their bucket's, and more than ``PER_HOME`` per home: only their strings within the passage are equal, once per home and
string, and the others are spread over all buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import binaries, mix, parallelism, ragged, raw_texts, read

LENGTH, GRAM = 50, 16
STRETCH = 1 << 18                     # bytes hashed at once
MESSAGES = 1 << 20                    # bytes of messages to buckets made up at once
SUBS = 16                             # parts of a bucket, sorted one after another
SPLIT, PER_HOME = 4096, 4             # slices of a key, in all and per home that has it, from which on it is split
LAST_ID = (1 << 63) - 1               # stands for a null id: after all others
PLACES = 1 << 33                      # more than places in a home's text, so that spans of two homes never touch
SHARE = 16                            # a key is not split unless it has more than one in so many of its bucket's slices
BASE = 0x9E3779B97F4A7C15 | 1
CODES = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
UNDO = pow(BASE, -1, 1 << 64)
U64 = np.uint64
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base**0 … base**(n-1), modulo 2**64, by doubling; short tables are kept."""
    kept = _POWERS.get(base)
    if kept is not None and len(kept) >= n:
        return kept[:n]
    size = 1 << max(STRETCH, n - 1).bit_length() if n <= 8 * STRETCH else n
    out = np.ones(max(size, 1), U64)
    done = 1
    with np.errstate(over="ignore"):
        while done < size:
            step = U64(pow(base, done, 1 << 64))
            more = min(done, size - done)
            out[done:done + more] = out[:more] * step
            done += more
    if n <= 8 * STRETCH:
        _POWERS[base] = out
    return out[:n]


class Prefixes:
    """Prefix polynomial hashes of a byte string: the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray):
        self.data = data
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(CODES[data] * powers(len(data), BASE), dtype=U64)])
        self.undo = powers(len(data) + 1, UNDO)

    def of(self, starts: np.ndarray, lengths) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[starts + lengths] - self.sums[starts]) * self.undo[starts]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The lengths of the common extensions from positions a and b, up to ``most``, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.asarray(most, np.int64).copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.of(a, middle) == self.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def words_at(data: np.ndarray, order: str = "<u8") -> np.ndarray:
    """The 8 bytes from each position on as one integer, zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data), order, padded, 0, (1,)).astype(U64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring strings of ``LENGTH`` bytes with one key, in texts laid end to end.

    Returns owner (text number), first start, number of strings and key of each run.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, np.zeros(0, U64)
    n = len(data) - GRAM + 1
    word = words_at(data)
    with np.errstate(over="ignore"):
        grams = word[:n] * U64(BASE) + word[8:8 + n] * U64(UNDO)
        grams ^= grams >> U64(32)
        grams *= U64(0x94D049BB133111EB)
        grams ^= grams >> U64(29)
    keys = sliding_min(grams, LENGTH - GRAM + 1)
    stops = starts + np.maximum(0, lengths - LENGTH + 1)
    edge = np.ones(len(keys), bool)
    edge[1:] = keys[1:] != keys[:-1]
    edge[starts[stops > starts]] = True
    edge[stops[stops < len(keys)]] = True
    first = np.nonzero(edge)[0]
    owner = np.searchsorted(starts, first, side="right") - 1
    count = np.diff(np.append(first, len(keys)))
    real = first < stops[owner]
    return owner[real], first[real], count[real], keys[first[real]]


class Texts:
    """Texts laid end to end, hashed stretch by stretch; a text may reach over several stretches."""

    def __init__(self, items: list[bytes]):
        self.data = np.frombuffer(b"".join(items), np.uint8)
        self.lengths = np.array([len(item) for item in items], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def runs(self) -> tuple[np.ndarray, ...]:
        pieces = []
        number, done = 0, 0                                   # next text, and what of it is done
        while number < len(self.lengths):
            begin = stop = self.starts[number] + done
            owners, starts, lengths = [], [], []
            while number < len(self.lengths) and stop - begin < STRETCH:
                left = self.lengths[number] - done
                take = min(left, STRETCH + LENGTH - 1)
                owners.append(number)
                starts.append(self.starts[number] + done - begin)
                lengths.append(take)
                stop = self.starts[number] + done + take
                if take < left:
                    done += take - LENGTH + 1
                    break
                number, done = number + 1, 0
            owner, first, count, key = runs(self.data[begin:stop], np.array(starts), np.array(lengths))
            pieces.append((np.array(owners)[owner], first + begin, count, key))
        if not pieces:
            return runs(self.data, self.starts, self.lengths)
        return tuple(np.concatenate(x) for x in zip(*pieces))


def differences(values: np.ndarray) -> np.ndarray:
    """Each value less the one before it (np.diff with a zero before, at less cost for the many small messages)."""
    out = values.copy()
    out[1:] -= values[:-1]
    return out


def packed(values: np.ndarray) -> bytes:
    """Integers as differences, which the shuffle's compression shortens."""
    return differences(np.asarray(values).astype(np.int64)).tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, np.int64))


def small(values: np.ndarray) -> bytes:
    """Places in a home's text as 32-bit differences (a home is less than 4 GB: Arrow holds it in one array)."""
    return differences(np.asarray(values).astype("<u4")).tobytes()


def large(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, "<u4"), dtype=np.uint32).astype(np.int64)


def unrolled(blobs: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The integers of many messages of differences, one message after another, and how many each has."""
    counts = np.array([len(x) for x in blobs], np.int64) // np.dtype(kind).itemsize
    steps = np.frombuffer(b"".join(blobs), kind)
    sums = np.cumsum(steps, dtype=steps.dtype)                         # may wrap around, as what is taken off does
    before = (np.cumsum(counts) - counts)[counts > 0]
    return sums - np.repeat(sums[before] - steps[before], counts[counts > 0]), counts


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys >> U64(33)) % U64(buckets)


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order of the keys by bucket, the buckets that have some, and where each begins."""
    number = bucket_of(keys, buckets)
    order = np.argsort(number, kind="stable")
    present, first = np.unique(number[order], return_index=True)
    return order, present, np.append(first, len(order))


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.fill_null(LAST_ID).to_numpy()


def _first_of(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by the columns (the last counts most), and where a new value of the last column begins."""
    order = np.lexsort(columns)
    last = columns[-1][order]
    return order, np.nonzero(np.append(True, last[1:] != last[:-1]))[0] if len(last) else np.zeros(0, np.int64)


def home_texts(documents: pa.Table) -> tuple[np.ndarray, Texts, np.ndarray]:
    """A home's documents by id and text: their order, the texts and the ids.  Rows equal in both are interchangeable."""
    if not documents.num_rows:
        return np.zeros(0, np.int64), Texts([]), np.zeros(0, np.int64)
    items = raw_texts(documents.combine_chunks().to_batches()[0], "text")
    ids = _ids(documents.column("doc"))
    order = np.array(sorted(range(len(items)), key=lambda i: (ids[i], items[i])), np.int64)
    return order, Texts([items[i] for i in order]), ids[order]


def equal_slices(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the bytes from a and from b on are the same, 8 at a time (lengths are 8 at least)."""
    word = np.ndarray(max(0, len(data) - 7), "<u8", np.ascontiguousarray(data), 0, (1,))
    out = np.ones(len(a), bool)
    for at in range(0, len(a), 1 << 15):
        part = length[at:at + (1 << 15)]
        steps = (part + 7) // 8
        offset = np.minimum(8 * ragged(np.zeros(len(part), np.int64), steps), np.repeat(part - 8, steps))
        differ = word[np.repeat(a[at:at + (1 << 15)], steps) + offset] != word[np.repeat(b[at:at + (1 << 15)], steps) + offset]
        out[at:at + (1 << 15)] = np.add.reduceat(differ, np.cumsum(steps) - steps) == 0
    return out


def hashes(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of each slice (by ascending place), stretch by stretch."""
    out, at = np.zeros(len(first), U64), 0
    while at < len(first):
        begin = int(first[at])
        stop = int(np.searchsorted(first, begin + STRETCH))
        end = int((first[at:stop] + length[at:stop]).max())
        out[at:stop] = mix(Prefixes(data[begin:end]).of(first[at:stop] - begin, length[at:stop]) + length[at:stop].astype(U64))
        at = stop
    return out


def leaders(data: np.ndarray, first: np.ndarray, length: np.ndarray, content: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each slice the one of the smallest id with the same bytes: found by hash, checked; after a collision itself."""
    order, heads = _first_of(ids, content)
    leader = np.empty(len(first), np.int64)
    leader[order] = np.repeat(order[heads], np.diff(np.append(heads, len(order))))
    others = np.nonzero(leader != np.arange(len(first)))[0]
    same = length[others] == length[leader[others]]
    same[same] = equal_slices(data, first[others[same]], first[leader[others[same]]], length[others[same]])
    leader[others[~same]] = others[~same]
    return leader


def different_runs(texts: Texts, first: np.ndarray, count: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """How many different runs each key has (ordered by key, ``heads`` where one begins); up to ``PER_HOME`` are not compared."""
    span = np.diff(np.append(heads, len(first)))
    some = np.nonzero(np.repeat(span > PER_HOME, span))[0]
    number = np.repeat(np.arange(len(heads)), span)[some]
    length = count[some] + LENGTH - 1
    content = np.zeros(len(some), U64)
    for at in range(0, len(some), 1 << 16):
        part = length[at:at + (1 << 16)]
        data = texts.data[ragged(first[some[at:at + (1 << 16)]], part)]
        content[at:at + (1 << 16)] = mix(Prefixes(data).of(np.cumsum(part) - part, part) + part.astype(U64))
    order = np.lexsort((content, number))
    number, content = number[order], content[order]
    new = np.append(True, (number[1:] != number[:-1]) | (content[1:] != content[:-1]))[:len(number)]
    return np.where(span > PER_HOME, np.bincount(number[new], minlength=len(heads)), span)


def send_keys(documents: pa.Table, buckets: int) -> pa.Table:
    """Of one home: its keys and the number of different runs of each, to the keys' buckets.

    Of ids it only tells whether a key has several in this home (the last bit); a key in two homes counts as shared.
    """
    _, texts, ids = home_texts(documents)
    owner, first, count, key = texts.runs()
    order, heads = _first_of(ids[owner], key)
    key, holder, several = key[order][heads], ids[owner][order], np.zeros(0, bool)
    if len(heads):
        several = np.minimum.reduceat(holder, heads) != np.maximum.reduceat(holder, heads)
    slices = (different_runs(texts, first[order], count[order], heads) * 2 + several).astype("<u4")
    order, present, edges = by_bucket(key, buckets)
    key, slices = key[order], slices[order]
    cuts = [*zip(edges[:-1], edges[1:])]
    columns = [present.astype(np.int32), [key[x:y].tobytes() for x, y in cuts], [slices[x:y].tobytes() for x, y in cuts]]
    return pa.table({"bucket": pa.array(columns[0], pa.int32()),
                     "home": pa.array([documents.column("home")[0].as_py()] * len(columns[0]), pa.int32()),
                     **{name: binaries(column) for name, column in zip(("keys", "slices"), columns[1:])}})


KEY_SCHEMA = "bucket int, home int, keys binary, slices binary"


def shared_keys(table: pa.Table, split: int) -> pa.Table:
    """Of one bucket: for each home the keys that it has and that are in more than one document, and which to split."""
    blobs = table.column("keys").to_pylist()
    keys = np.frombuffer(b"".join(blobs), U64)
    homes = np.repeat(table.column("home").to_numpy(), [len(x) // 8 for x in blobs])
    slices = np.frombuffer(b"".join(table.column("slices").to_pylist()), "<u4").astype(np.int64)
    order, heads = _first_of(keys)
    out: list[list] = [[], [], []]
    if len(heads):
        span = np.diff(np.append(heads, len(order)))
        many = (span > 1) | (slices[order][heads] & 1 == 1)
        carried = np.add.reduceat(slices[order] >> 1, heads)
        large = np.empty(len(order), bool)
        split = max(split, int(carried.sum()) // SHARE)
        large[order] = np.repeat((carried > split) & (carried > PER_HOME * span), span)
        chosen = order[np.repeat(many, span)]
        pairs = np.lexsort((keys[chosen], homes[chosen]))
        chosen = chosen[pairs]
        found, first = np.unique(homes[chosen], return_index=True)
        own, hot = keys[chosen], keys[chosen[large[chosen]]]
        cuts = [*zip(first, np.append(first[1:], len(chosen)))]
        hot_cuts = [*zip(*(np.append(0, np.cumsum(large[chosen]))[edge] for edge in (first, np.append(first[1:], len(chosen)))))]
        out = [found, [own[x:y].tobytes() for x, y in cuts], [hot[x:y].tobytes() for x, y in hot_cuts]]
    return pa.table({"home": pa.array(out[0], pa.int32()), "keys": binaries(out[1]), "split": binaries(out[2])})


SHARED_SCHEMA = "home int, keys binary, split binary"


def among(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which keys are among some sorted ones."""
    if not len(some):
        return np.zeros(len(keys), bool)
    return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys


def cut(texts: Texts, found: tuple[np.ndarray, ...], split: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs, those with a split key cut into their strings; a string's key is a hash of its own bytes."""
    owner, first, count, key = found
    hot = among(key, split)
    if not hot.any():
        return found
    strings = ragged(first[hot], count[hot])
    own = hashes(texts.data, strings, np.full(len(strings), LENGTH))
    place = np.argsort(np.append(first[~hot], strings), kind="stable")
    return tuple(np.append(whole[~hot], part)[place] for whole, part in (
        (owner, np.repeat(owner[hot], count[hot])), (first, strings), (count, np.ones(len(strings), count.dtype)), (key, own)))


def joined_spans(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of strings by place, those that touch as one."""
    order = np.argsort(first, kind="stable")
    first, count = first[order], count[order]
    new = np.append(True, first[1:] > first[:-1] + count[:-1])[:len(first)]
    heads = np.nonzero(new)[0]
    return first[heads], np.maximum.reduceat(first + count, heads) - first[heads] if len(heads) else count


def send_slices(documents: pa.Table, replies: pa.Table, buckets: int) -> pa.Table:
    """Of one home: its runs with shared keys, those with split keys as strings, each content once, to the keys' buckets.

    With each slice go the places that have it in documents of its smallest id.  Elsewhere in the home the whole run
    is covered; these spans need no bucket and only travel along to step 4.
    """
    shared = np.unique(np.frombuffer(b"".join(replies.column("keys").to_pylist()), U64))
    split = np.unique(np.frombuffer(b"".join(replies.column("split").to_pylist()), U64))
    names = ["low", "lengths", "bytes", "times", "places", "parts", "local_first", "local_count"]
    columns: list[list] = [[] for _ in range(2 + len(names))]
    if len(shared) and documents.num_rows:
        _, texts, ids = home_texts(documents)
        found = texts.runs()
        wanted = among(found[3], shared)
        owner, first, count, key = cut(texts, tuple(x[wanted] for x in found), split)
        length, mine = count + LENGTH - 1, ids[owner]
        leader = leaders(texts.data, first, length, hashes(texts.data, first, length), mine)
        low = mine[leader]
        local = joined_spans(first[low < mine], count[low < mine])
        single = np.nonzero(leader == np.arange(len(leader)))[0]
        part = bucket_of(key[single], buckets * SUBS).astype(np.int64)
        order = np.argsort(part, kind="stable")
        single, part = single[order], part[order]
        rank = np.empty(len(leader), np.int64)
        rank[single] = np.arange(len(single))
        own = np.nonzero(low == mine)[0]
        own = own[np.argsort(rank[leader[own]], kind="stable")]
        times = np.bincount(rank[leader[own]], minlength=len(single))
        before = np.append(0, np.cumsum(times))
        home = documents.column("home")[0].as_py()
        edges = np.searchsorted(part, np.arange(buckets * SUBS + 1))
        parts = np.diff(edges).astype("<u4").reshape(buckets, SUBS)
        edges = edges[::SUBS]
        present = np.nonzero(np.diff(edges))[0]
        ends = np.append(0, np.cumsum(length[single]))
        group = ends[edges[present]] // MESSAGES                       # messages made up at once
        for numbers in np.split(present, np.nonzero(np.diff(group))[0] + 1 if len(present) else []):
            if not len(numbers):
                continue
            begin, end = edges[numbers[0]], edges[numbers[-1] + 1]
            some = single[begin:end]
            bytes_, place = texts.data[ragged(first[some], length[some])], first[own[before[begin]:before[end]]]
            sizes, uses = length[some].astype("<u4"), times[begin:end].astype("<u4")
            for bucket in numbers:
                x, y = edges[bucket] - begin, edges[bucket + 1] - begin
                whole = local if not columns[0] else (np.zeros(0, np.int64),) * 2
                for column, value in zip(columns, (
                        int(bucket), home, packed(low[some[x:y]]), sizes[x:y].tobytes(),
                        bytes_[ends[begin + x] - ends[begin]:ends[begin + y] - ends[begin]].tobytes(), uses[x:y].tobytes(),
                        small(place[before[begin + x] - before[begin]:before[begin + y] - before[begin]]), parts[bucket].tobytes(),
                        small(whole[0]), whole[1].astype("<u4").tobytes())):
                    column.append(value)
    return pa.table({"bucket": pa.array(columns[0], pa.int32()), "home": pa.array(columns[1], pa.int32()),
                     **{name: binaries(column) for name, column in zip(names, columns[2:])}})


SLICE_SCHEMA = ("bucket int, home int, low binary, lengths binary, bytes binary, times binary, places binary, parts binary, "
                "local_first binary, local_count binary")


class Suffixes:
    """Comparison of suffixes to depth ``LENGTH``, by their common extension."""

    def __init__(self, prefixes: Prefixes, starts: np.ndarray):
        self.prefixes, self.starts = prefixes, starts
        self.whole = prefixes.of(starts, LENGTH)
        self.word = words_at(prefixes.data)

    def agree(self, a: np.ndarray, b: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Whether the first ``reach`` bytes from places a and b on are the same."""
        differ = np.zeros(len(a), bool)
        last = len(self.word) - 1
        for step in range(0, LENGTH, 8):
            bits = (8 * np.clip(reach - step, 0, 8)).astype(U64)
            mask = np.where(bits == 0, U64(0), U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - np.maximum(bits, U64(1))))
            differ |= (self.word[np.minimum(a + step, last)] ^ self.word[np.minimum(b + step, last)]) & mask != 0
        return ~differ

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for the suffixes numbered a and b: by the first byte after their common extension."""
        x, y = self.starts[a], self.starts[b]
        reach = np.full(len(a), LENGTH, np.int64)
        other = np.nonzero(self.whole[a] != self.whole[b])[0]
        reach[other] = self.prefixes.common(x[other], y[other], np.full(len(other), LENGTH - 1))
        data = self.prefixes.data
        at = np.minimum(reach, LENGTH - 1)
        out = np.where(reach == LENGTH, 0, np.sign(data[x + at].astype(np.int16) - data[y + at]))
        wrong = ~self.agree(x, y, reach)
        wrong[other] |= out[other] == 0
        for i in np.nonzero(wrong)[0]:                                # a collision: byte for byte
            one, two = (data[z[i]:z[i] + LENGTH].tobytes() for z in (x, y))
            out[i] = (one > two) - (one < two)
        return out


def sort_suffixes(prefixes: Prefixes, starts: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For suffixes at ``starts``: the smallest id of those with the same first ``LENGTH`` bytes.

    A merge sort from lists of one suffix up, all lists of a round at once.  Only suffixes with the same first 8
    bytes are in one group of lists; a suffix equal to one of the other list leaves for that one's class.
    """
    if not len(starts):
        return low
    suffixes = Suffixes(prefixes, starts)
    least, parent = low.copy(), np.arange(len(starts))
    begins = words_at(prefixes.data, ">u8")[starts]
    node = np.argsort(begins, kind="stable")
    new = np.append(True, begins[node[1:]] != begins[node[:-1]])
    group = np.cumsum(new)
    number = np.arange(len(node)) - np.nonzero(new)[0][group - 1]      # of the list within its group
    while True:
        lists = np.append(True, (group[1:] != group[:-1]) | (number[1:] != number[:-1]))
        first = np.nonzero(lists)[0]                                   # of each list
        size = np.diff(np.append(first, len(node)))
        of = np.cumsum(lists) - 1
        alone = np.append(True, group[first[1:]] != group[first[:-1]]) & np.append(group[first[1:]] != group[first[:-1]], True)
        if alone.all():
            break
        going = ~alone[of]                                             # groups of one list are in order
        if not going.all():
            node, group, number = node[going], group[going], number[going]
            continue
        odd = np.nonzero(number % 2 == 1)[0]                           # to be placed in the list before theirs
        start = first[of[odd] - 1]
        bottom, top = np.zeros(len(odd), np.int64), size[of[odd] - 1].copy()
        into = np.full(len(odd), -1)
        open_ = np.arange(len(odd))
        while len(open_):
            middle = (bottom[open_] + top[open_]) // 2
            against = node[start[open_] + middle]
            side = suffixes.compare(against, node[odd[open_]])
            into[open_[side == 0]] = against[side == 0]
            bottom[open_] = np.where(side < 0, middle + 1, bottom[open_])
            top[open_] = np.where(side > 0, middle, top[open_])
            open_ = open_[(side != 0) & (bottom[open_] < top[open_])]
        equal = into >= 0
        gone = node[odd[equal]]
        parent[gone] = into[equal]
        np.minimum.at(least, into[equal], least[gone])
        place = 2 * np.arange(len(node)) + 1
        place[odd] = 2 * (start + bottom)
        stay = np.ones(len(node), bool)
        stay[odd[equal]] = False
        order = np.argsort(place[stay], kind="stable")
        node, group, number = node[stay][order], group[stay][order], number[stay][order] // 2
    while True:
        above = parent[parent]
        if (above == parent).all():
            return least[parent]
        parent = above


def covered_spans(data: np.ndarray, low: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    """The spans of strings in slices (laid end to end) that a smaller id has: number of the slice, first string, strings."""
    begin, strings = np.cumsum(length) - length, length - LENGTH + 1
    prefixes = Prefixes(data)
    content = mix(prefixes.of(begin, length) + length.astype(U64))
    leader = leaders(data, begin, length, content, low)
    single = np.nonzero(leader == np.arange(len(leader)))[0]
    least = sort_suffixes(prefixes, ragged(begin[single], strings[single]), np.repeat(low[single], strings[single]))
    edges = np.cumsum(strings[single]) - strings[single]
    rank = np.empty(len(leader), np.int64)
    rank[single] = np.arange(len(single))
    told = np.nonzero(np.minimum.reduceat(least, edges)[rank[leader]] < low)[0]
    place = edges[rank[leader[told]]]
    hit = least[ragged(place, strings[told])] < np.repeat(low[told], strings[told])
    slice_ = np.repeat(told, strings[told])
    offset = ragged(np.zeros(len(told), np.int64), strings[told])
    inner = np.append(False, hit[1:] & hit[:-1] & (slice_[1:] == slice_[:-1]))[:len(hit)]
    first = np.nonzero(hit & ~inner)[0]
    span = np.add.reduceat(hit, first).astype(np.int64) if len(first) else np.zeros(0, np.int64)
    return slice_[first], offset[first], span


def first_holders(table: pa.Table) -> pa.Table:
    """Of one bucket: the places of strings that a smaller id has, to the slices' homes; local spans go along.

    A bucket has a message from each home, so what is done for each message and each part would grow with the square of
    the corpus: the slices of all messages are numbered through, and only what is sent back is made up home by home.
    """
    sent_ = {name: table.column(name).to_pylist() for name in table.column_names}
    low, counts = unrolled(sent_["low"], "<i8")
    length, times = (np.frombuffer(b"".join(sent_[name]), "<u4").astype(np.int64) for name in ("lengths", "times"))
    places = unrolled(sent_["places"], "<u4")[0].astype(np.int64)
    data = np.frombuffer(b"".join(sent_.pop("bytes")), np.uint8)
    begin, uses = np.cumsum(length) - length, np.cumsum(times) - times
    sender = np.repeat(np.arange(len(counts)), counts)
    parts = np.frombuffer(b"".join(sent_["parts"]), "<u4")
    part = np.repeat(np.tile(np.arange(SUBS, dtype=np.int8), len(counts)), parts)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(SUBS + 1))
    local, number = unrolled(sent_["local_first"], "<u4")
    found = [(np.repeat(np.arange(len(number)), number) * PLACES + local.astype(np.int64),
              np.frombuffer(b"".join(sent_["local_count"]), "<u4").astype(np.int64))]
    for at, end in zip(edges[:-1], edges[1:]):
        if at == end:
            continue
        some = order[at:end]
        which, offset, span = covered_spans(data[ragged(begin[some], length[some])], low[some], length[some])
        own = some[which]
        repeat = times[own]
        found.append((np.repeat(sender[own] * PLACES + offset, repeat) + places[ragged(uses[own], repeat)], np.repeat(span, repeat)))
    first, count = joined_spans(np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]))
    present, heads = np.unique(first // PLACES, return_index=True)
    cuts = [*zip(heads, np.append(heads[1:], len(first)))]
    first, count = first % PLACES, count.astype("<u4")
    return pa.table({"home": pa.array([sent_["home"][x] for x in present], pa.int32()),
                     "first": binaries([small(first[x:y]) for x, y in cuts]),
                     "strings": binaries([count[x:y].tobytes() for x, y in cuts])})


HOLDER_SCHEMA = "home int, first binary, strings binary"


def covered_bytes(texts: Texts, replies: pa.Table) -> np.ndarray:
    """Which bytes of a home's texts lie in a string that a smaller id has."""
    change = np.zeros(len(texts.data) + 1, np.int32)
    first = unrolled(replies.column("first").to_pylist(), "<u4")[0].astype(np.int64)
    strings = np.frombuffer(b"".join(replies.column("strings").to_pylist()), "<u4").astype(np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + strings + (LENGTH - 1), -1)
    return np.cumsum(change)[:len(texts.data)] > 0


def whole_characters(data: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """Covered bytes whose whole UTF-8 character is covered."""
    if not len(data):
        return covered
    starts = np.nonzero((data & 0xC0) != 0x80)[0]
    if not len(starts) or starts[0]:
        starts = np.append(0, starts)
    return np.repeat(np.logical_and.reduceat(covered, starts), np.diff(np.append(starts, len(data))))


def sent(rows: DataFrame, buckets: int, split: int) -> DataFrame:
    """The slices of all homes' documents (home, doc, text), by bucket."""
    homes = rows.groupBy("home")
    keys = homes.applyInArrow(lambda documents: send_keys(documents, buckets), KEY_SCHEMA)
    shared = keys.groupBy("bucket").applyInArrow(lambda table: shared_keys(table, split), SHARED_SCHEMA)
    return homes.cogroup(shared.groupBy("home")).applyInArrow(
        lambda documents, replies: send_slices(documents, replies, buckets), SLICE_SCHEMA)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
                   characters: bool = False, split: int = SPLIT) -> DataFrame:
    """key, the columns ``keep``, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every row.

    Texts are taken whole, as UTF-8; null is empty.  Rows with the same id are never held against each other; null
    ids come after all others.  With ``characters``, a character goes only if all its bytes do, so that what is
    kept is text.  Columns in ``keep`` called like a result are replaced; an empty table gives no rows.  A key with more than ``split`` slices is split.
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept"]
    keep = [name for name in keep if name not in (key, *results)]
    buckets = 2 * parallelism(df.sparkSession)
    rows = df.select(F.pmod(F.xxhash64(key, text), F.lit(buckets)).cast("int").alias("home"), F.col(key).cast("long").alias("doc"),
                     F.col(text).cast("string").alias("text"), F.col(key).alias("__key"),
                     *[F.col(f"`{name}`").alias(f"__{name}") for name in keep])
    holders = sent(rows, buckets, split).groupBy("bucket").applyInArrow(first_holders, HOLDER_SCHEMA)

    schema = rows.select(F.col("__key").alias(key), *[F.col(f"__{name}").alias(name) for name in keep]).schema
    for name, kind in zip(results, ("long", "long", "long", "binary")):
        schema = schema.add(name, kind)

    def finish(documents: pa.Table, replies: pa.Table) -> pa.Table:
        order, texts, _ = home_texts(documents)
        documents = documents.take(pa.array(order)).combine_chunks()
        covered = covered_bytes(texts, replies)
        if characters:
            covered = whole_characters(texts.data, covered)
        removed, spans, kept = [], [], []
        for start, length in zip(texts.starts, texts.lengths):
            gone = covered[start:start + length]
            removed.append(int(gone.sum()))
            spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            kept.append(texts.data[start:start + length][~gone].tobytes())
        return pa.Table.from_arrays(
            [documents.column("__key"), *(documents.column(f"__{name}") for name in keep), pa.array(texts.lengths, pa.int64()),
             pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), binaries(kept)], names=[key, *keep, *results])

    return rows.groupBy("home").cogroup(holders.groupBy("home")).applyInArrow(finish, schema)


def op6_repeats(spark, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages that earlier documents have."""
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
