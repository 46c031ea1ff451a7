"""Licences, quality, repeats, similar groups and shards against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from wattlake.llm import jaccard, licences, quality, repeats, sharding


def lowered(text):
    return (text or "").translate({code: code + 32 for code in range(65, 91)})


def test_licences_base(spark, sf_dir, documents):
    rows = {row["doc_id"]: row for row in licences.op1_licences(spark, sf_dir).collect()}
    assert set(rows) == set(documents)
    for key, text in documents.items():
        words = re.findall(licences.WORD, lowered(text))
        places, labels = [], set()
        for phrase, label in licences.PHRASES.items():
            phrase = phrase.split()
            found = [i for i in range(len(words)) if words[i:i + len(phrase)] == phrase]
            places += found
            labels |= {label} if found else set()
        row = rows[key]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == \
            (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert 0 <= row["score"] <= 1 and labels <= set(row["labels"].split(","))


def test_licences_diagonals(spark):
    notice = "Redistribution and use in source and binary forms, with or without modification, are permitted provided " \
             "that the following conditions are met"
    edited = notice.replace("or without modification", "a b")
    rows = spark.createDataFrame([(1, "x y " + notice), (2, edited), (3, "redistribution and use in source"), (4, "cc cc by by cc by")],
                                 "doc_id long, text string")
    found = {row["doc_id"]: row for row in licences.scan(rows).collect()}
    assert found[1]["labels"] == found[2]["labels"] == "bsd" and found[1]["score"] == 1.0
    assert 0.7 <= found[2]["score"] < 1 and found[3]["labels"] == "" and 0 < found[3]["score"] < 0.7
    assert (found[4]["n_base"], found[4]["first_word"], found[4]["last_word"]) == (2, 1, 4)
    assert [tuple(span)[:3] for span in found[1]["spans"]] == [("bsd", 2, 23)]


def test_licences_odd_rows(odd, none):
    rows = licences.scan(odd).collect()
    assert Counter(row["doc_id"] for row in rows) == Counter(row["doc_id"] for row in odd.collect())
    first = next(row for row in rows if row["doc_id"] == 1)
    assert (first["n_base"], first["base_labels"]) == (3, "cc-by,reserved")
    assert licences.scan(none).count() == 0


def repeated(words):
    found = Counter(zip(words, words[1:], words[2:]))
    inside = {i + j for i in range(len(words) - 2) if found[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return len(inside)


def test_quality_base(spark, sf_dir, documents):
    rows = {row["doc_id"]: row for row in quality.op3_quality(spark, sf_dir).collect()}
    labels = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for key, text in documents.items():
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        n = repeated(words)
        row = rows[key]
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"], row["base_failed"]) == \
            (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), n,
             len(words) < 50 or 100 * n > 50 * len(words))
        assert not (row["base_failed"] and row["kept"])
    good = [rows[key]["kept"] for key, label in labels.items() if label and not rows[key]["base_failed"]]
    bad = [rows[key]["kept"] for key, label in labels.items() if not label and not rows[key]["base_failed"]]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.6


def test_quality_bands():
    press = zstandard.ZstdCompressor(level=quality.LEVEL)
    noise = random.Random(3).randbytes(20_000).hex().encode()
    assert quality.verdict(b"short", press) == (True, None, None)
    assert not quality.verdict(b"the same words again " * 500, press)[0]
    assert not quality.verdict(random.Random(4).randbytes(5000), press)[0]
    half = noise[:20_000] + b"again and again " * 2000
    assert quality.verdict(half, press)[2] > 0.5
    words = " ".join(f"{random.Random(i).choice('abcdefg')}{i * 7919 % 1000}" for i in range(3000)).encode()[:8192]
    tail = quality.verdict(words + b"again " * 682, press)[2] - quality.verdict(words, press)[2]
    assert tail > 0                                                  # the bytes after the last full chunk count


def test_quality_odd_rows(odd, none):
    rows = quality.quality(odd, keep=odd.columns).collect()
    assert len(rows) == odd.count() and not any(row["kept"] for row in rows) and rows[0].asDict().keys() >= {"labels", "shard"}
    assert quality.quality(none).count() == 0


def without_repeats(docs):
    first = {}
    for key, text in docs:
        text = (text or "").encode()
        key = repeats.LAST_ID if key is None else key
        for at in range(len(text) - 49):
            first[text[at:at + 50]] = min(key, first.get(text[at:at + 50], key))
    out = []
    for key, text in docs:
        text = (text or "").encode()
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - 49):
            if first[text[at:at + 50]] < (repeats.LAST_ID if key is None else key):
                gone[at:at + 50] = True
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((key, len(text), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def by_key(rows):
    return sorted(map(tuple, rows), key=lambda row: (row[0] is None, *[(x is None, x) for x in row]))


def test_repeats_query(spark, sf_dir, documents):
    assert by_key(repeats.op6_repeats(spark, sf_dir).collect()) == by_key(without_repeats(documents.items()))


def test_repeats_by_hand(spark, monkeypatch):
    base = "The quick brown fox jumps over the lazy dog while the éèê 日本 cat sleeps on the mat near it. " * 3
    docs = [(3, base), (1, base[40:260] + "zz"), (None, base), (2, "a" * 500), (5, "a" * 120), (5, "a" * 300 + base), (7, None),
            (8, ""), (9, "short"), (4, "ab" * 200), (6, "ba" * 100), (11, base), (11, base), (None, "q" * 60), (None, "q" * 60)]
    rows = repeats.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")) \
        .selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)").collect()
    assert by_key(rows) == by_key(without_repeats(docs))


def test_repeats_stretches_and_collisions():
    text = bytes(random.Random(2).choices(b"abc", k=3000))
    whole = repeats.Texts([text, b"x" * 10, text[100:900]])
    keep, repeats.STRETCH = repeats.STRETCH, 128
    try:
        cut = whole.runs()
    finally:
        repeats.STRETCH = keep
    def spread(found):
        return {(int(o), int(s) + i, int(k)) for o, s, n, k in zip(*found) for i in range(n)}
    assert spread(cut) == spread(whole.runs())
    data = np.frombuffer(b"a" * 60 + b"b" * 60, np.uint8)
    assert repeats.Prefixes(data).common(np.array([0, 0]), np.array([5, 60]), np.array([50, 50])).tolist() == [50, 0]


def least_by_bytes(data, starts, low):
    found = {}
    for at, key in zip(starts, low):
        found[data[at:at + 50]] = min(key, found.get(data[at:at + 50], key))
    return [found[data[at:at + 50]] for at in starts]


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abcdefgh"])
def test_suffixes_are_merged_by_common_extensions(letters, monkeypatch):
    dice, compared, extended = random.Random(3), [], []
    compare, common = repeats.Suffixes.compare, repeats.Prefixes.common
    monkeypatch.setattr(repeats.Suffixes, "compare", lambda self, a, b: (compared.append(len(a)), compare(self, a, b))[1])
    monkeypatch.setattr(repeats.Prefixes, "common", lambda self, a, b, most: (extended.append(len(a)), common(self, a, b, most))[1])
    text = bytes(dice.choices(letters, k=400))
    items = [text[at:at + dice.randint(50, 100)] for at in dice.choices(range(300), k=30)]
    items += [item[:40] + b"#" + item[41:] for item in items[:9]]                   # common extensions short of 50
    length = np.array([len(item) for item in items])
    starts, low = repeats.ragged(np.cumsum(length) - length, length - 49), np.repeat(np.array(dice.choices(range(9), k=39)), length - 49)
    data = b"".join(items)
    wanted = least_by_bytes(data, starts, low)
    prefixes = repeats.Prefixes(np.frombuffer(data, np.uint8))
    assert repeats.sort_suffixes(prefixes, starts, low).tolist() == wanted
    assert sum(compared) > 0 and sum(extended) > 0
    monkeypatch.setattr(repeats.Suffixes, "compare", lambda self, a, b: np.ones(len(a), int))
    assert repeats.sort_suffixes(prefixes, starts, low).tolist() == low.tolist()    # classes come from the comparisons alone


def test_suffixes_with_colliding_hashes(monkeypatch):
    monkeypatch.setattr(repeats.Prefixes, "of", lambda self, starts, lengths: np.zeros(len(starts), np.uint64))
    dice = random.Random(4)
    data = bytes(dice.choices(b"ab", k=300)) * 2 + b"c" * 60
    starts = np.arange(len(data) - 49)
    low = np.array(dice.choices(range(50), k=len(starts)))
    got = repeats.sort_suffixes(repeats.Prefixes(np.frombuffer(data, np.uint8)), starts, low)
    assert got.tolist() == least_by_bytes(data, starts, low)


def test_repeats_keep_whole_characters():
    data = np.frombuffer("é日x".encode(), np.uint8)
    covered = np.array([True, True, True, True, False, True])
    assert repeats.whole_characters(data, covered).tolist() == [True, True, False, False, False, True]


def test_repeats_of_a_common_passage_are_spread(spark):
    from pyspark.sql import functions as F
    dice = random.Random(6)
    word = lambda: "".join(dice.choices("abcdefghijklmnopqrstuvwxyz", k=dice.randint(2, 9)))
    passage = " ".join(word() for _ in range(60))
    docs = [(n, " ".join([*(word() for _ in range(12)), passage, *(word() for _ in range(12))])) for n in range(2000)]
    docs += [(n + 2000, docs[n][1][20:]) for n in range(0, 2000, 50)]           # edges that others have, too
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = df.select(F.pmod(F.xxhash64("doc_id"), F.lit(8)).cast("int").alias("home"), F.col("doc_id").alias("doc"), "text")

    def held(split):                                                             # the most bytes one bucket gets
        found = Counter()
        for row in repeats.sent(rows, 8, split).select("bucket", F.length("bytes").alias("n")).collect():
            found[row["bucket"]] += row["n"]
        return max(found.values()) / (sum(found.values()) / 8)
    assert held(256) < 1.5 < 2 < held(1 << 40)
    found = repeats.remove_repeats(df, split=256).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)")
    assert by_key(found.collect()) == by_key(without_repeats(docs))


def test_repeats_bucket_looks_at_all_messages_together(monkeypatch):
    dice, looked, rows = random.Random(7), [], []
    spans = repeats.covered_spans
    monkeypatch.setattr(repeats, "covered_spans", lambda *args: (looked.append(len(args[2])), spans(*args))[1])
    joined = repeats.joined_spans
    monkeypatch.setattr(repeats, "joined_spans", lambda *args: (looked.append(0), joined(*args))[1])
    text = bytes(dice.choices(b"abcdefgh", k=60))
    for home in range(40):                                         # all have one slice, and one of their own
        own = bytes(dice.choices(b"abcdefgh", k=55))
        rows.append((0, home, repeats.packed(np.array([home + 5, -1 if home == 3 else repeats.LAST_ID])),
                     np.array([60, 55], "<u4").tobytes(), text + own, np.array([2, 1], "<u4").tobytes(),
                     repeats.small(np.array([7, (1 << 32) - 500, 9])), np.array([2] + [0] * (repeats.SUBS - 1), "<u4").tobytes(),
                     repeats.small(np.array([1000])), np.array([3], "<u4").tobytes()))
    names = [column.split()[0] for column in repeats.SLICE_SCHEMA.split(", ")]
    found = repeats.first_holders(pa.table(dict(zip(names, map(list, zip(*rows))))))
    for home, first, strings in zip(*(found.column(name).to_pylist() for name in ("home", "first", "strings"))):
        covered = [] if home == 0 else [7, (1 << 32) - 500]
        assert sorted(zip(repeats.large(first).tolist(), np.frombuffer(strings, "<u4").tolist())) == sorted(
            [(1000, 3), *((at, 11) for at in covered)])
    assert found.num_rows == 40 and looked == [80, 0]              # not once for each message


def test_repeats_odd_rows(odd, none):
    assert repeats.remove_repeats(odd, keep=("labels",)).count() == odd.count()
    assert repeats.remove_repeats(none).count() == 0


def groups(docs):
    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group, index = list(range(len(docs))), {}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for n, own in enumerate(sets):
        met = Counter(other for shingle in own for other in index.get(shingle, ()))
        for other, both in met.items():
            if 100 * both >= 75 * (len(own) + len(sets[other]) - both):
                group[find(n)] = find(other)
        for shingle in own:
            index.setdefault(shingle, []).append(n)
    least = {}
    for n, (key, _) in enumerate(docs):
        if key is not None:
            least[find(n)] = min(key, least.get(find(n), key))
    return [(key, len(sets[n]), least.get(find(n)) if sets[n] else key) for n, (key, _) in enumerate(docs)]


def test_similar_query(spark, sf_dir, documents):
    rows = jaccard.op8_jaccard(spark, sf_dir).select("doc_id", "n_shingles", "component_id").collect()
    assert by_key(rows) == by_key(groups(list(documents.items())))


def test_similar_by_hand(spark):
    dice, docs = random.Random(5), []
    vocabulary = [f"w{n}" for n in range(400)]
    for _ in range(60):
        base = dice.choices(vocabulary, k=dice.choice([1, 3, 4, 5, 7, 9, 12, 14, 15, 16, 18, 20, 25, 40, 80, 200]))
        for _ in range(dice.randint(1, 12)):
            words = list(base)
            for _ in range(dice.choice([0, 0, 1, 1, 2, 3])):
                if words and dice.random() < .5:
                    words.pop(dice.choice([0, -1]))
                else:
                    words.insert(dice.choice([0, len(words)]), dice.choice(vocabulary))
            docs.append((len(docs) * 3 + 1, " ".join(words)))
    docs += [(None, None), (5000, ""), (5000, "  \n"), (None, docs[0][1]), (1, docs[3][1]), (7777, docs[3][1].upper())]
    dice.shuffle(docs)
    rows = jaccard.similar_groups(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id")
    assert by_key(rows.collect()) == by_key(groups(docs))


def test_similar_sets_share_a_signature():
    dice = np.random.default_rng(8)
    for size in [*range(1, 40), 64, 100, 127, 128, 300, 1000]:
        x = dice.integers(0, 1 << 62, size).astype(np.uint64)
        for gone in {0, size // 8, size // 7}:
            new = dice.integers(0, 1 << 62, gone).astype(np.uint64)
            y = np.concatenate([x[gone:], new])
            both = size - gone
            if 100 * both < 75 * (2 * size - both):
                continue
            a, b = (set(jaccard.signatures(np.sort(s), np.array([len(s)]))[0].tolist()) for s in (x, y))
            assert a & b, (size, gone)


def test_similar_links_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", (100, 300))                 # shingles: tiles of a few sets
    monkeypatch.setattr(jaccard, "COLUMNS", 2)
    base, docs = [f"w{n}" for n in range(60)], []
    for n in range(40):                                              # a chain: only neighbours are similar
        words = base[n // 2:] + [f"x{i}" for i in range(n // 2)]
        docs.append((n, " ".join(words + ["y"] * (n % 2))))
    docs += [(100 + n, " ".join(base[:40] + [f"z{n} z{n + 1}"])) for n in range(30)]
    monkeypatch.setattr(jaccard, "verified", lambda pairs, sets: pairs.where("a IS NULL"))     # all links come from tiles
    rows = jaccard.similar_groups(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id")
    assert by_key(rows.collect()) == by_key(groups(docs))
    assert len({row[2] for row in groups(docs)}) < len(docs)


def test_similar_sets_have_similar_sketches():
    dice = np.random.default_rng(4)
    for size, gone in [(1, 0), (14, 2), (32, 4), (33, 4), (60, 8), (65, 8), (300, 41), (1024, 140)]:
        x = dice.integers(0, 1 << 62, size).astype(np.uint64)
        new = dice.integers(0, 1 << 62, gone).astype(np.uint64)
        for y in (np.append(x[gone:], new), x[size // 4:], dice.integers(0, 1 << 62, size).astype(np.uint64)):
            n, both = np.array([len(x), len(y)]), len(np.intersect1d(x, y))
            values = np.append(x, y)
            one, two = (np.frombuffer(blob, "<u8") for blob in jaccard.sketches(values, n))
            assert 2 * n[0] <= 64 * len(one) < max(65, 4 * n[0] + 1)
            table = pa.table({"hub": pa.array([1, 1]), "x": pa.array([0, 0], pa.int32()), "y": pa.array([0, 0], pa.int32()),
                              "asked": pa.array([True, False]), "vertex": pa.array([1, 2]), "label": pa.array([1, 2]),
                              "n": pa.array(n), "most": pa.array([9999, 9999]), "sketch": pa.array([one.tobytes(), two.tobytes()])})
            similar = 100 * both >= 75 * (n.sum() - both)
            assert jaccard.left_open(table).num_rows == (2 if similar else 0), (size, gone, len(y), both)


def test_similar_strangers_with_a_common_line_are_not_compared(spark, monkeypatch):
    dice = np.random.default_rng(6)
    line, docs = " ".join(f"c{n}" for n in range(8)), []
    for n in range(60):                                              # pairs of near copies; all have one line
        words = [f"w{x}" for x in dice.integers(0, 100000, 60)]
        docs += [(2 * n, " ".join([line, *words])), (2 * n + 1, " ".join([line, *words, "end"]))]
    given = []
    seen = jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, sets: (given.append(pairs.count()), seen(pairs, sets))[1])
    rows = jaccard.similar_groups(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id")
    assert by_key(rows.collect()) == by_key(groups(docs))
    assert given == [60]


def test_similar_counts_colliding_shingles(monkeypatch):
    one = np.array([7, 7 + (4 << 32), 7 + (8 << 32), 1 << 34], np.uint64)       # three are the same in bucket and 32 bits
    two = np.append(one[:3], np.uint64(3 << 34) + np.uint64(5))
    monkeypatch.setattr(jaccard, "sets_of", lambda batch: (np.concatenate([one, two]), np.array([4, 4])))
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b"])], ["text"])
    whole = lambda values, counts: (values, np.repeat(np.arange(len(counts)), counts))
    sent = [row for _ in range(2) for row in jaccard.send([batch], "text", 4, whole)]    # the sets are in two blocks
    found = jaccard.tally(pa.Table.from_batches(sent).filter(pc.field("bucket") == 0), 1)
    assert np.frombuffer(found.column("shared")[0].as_py(), "<u4").tolist() == [3, 3]
    assert sorted(jaccard.unpacked(found.column("vertices")[0].as_py())) == sorted(
        jaccard.set_numbers(np.concatenate([one, two]), np.array([4, 4])))


def test_similar_odd_rows(odd, none):
    rows = jaccard.similar_groups(odd, keep=("labels",)).collect()
    assert len(rows) == odd.count() and {row["component_id"] for row in rows if row["doc_id"] == 5} == {5}
    assert jaccard.similar_groups(none).count() == 0


def test_shards(spark, sf_dir, documents):
    rows = sharding.op7_sharding(spark, sf_dir).toPandas()
    counts = rows.groupby("shard")["slot"].agg(["count", "min", "max", "nunique"])
    assert len(counts) == 16 and counts["count"].max() - counts["count"].min() <= 1 and rows["doc_id"].nunique() == len(documents)
    assert (counts["min"] == 0).all() and (counts["max"] + 1 == counts["count"]).all() and (counts["nunique"] == counts["count"]).all()
    for row in rows.itertuples():
        text = (documents[row.doc_id] or "").encode()
        assert (row.size, row.text_crc32) == (len(text) + 1, zlib.crc32(text))


def test_shards_are_uniform():
    first = [sharding.communication_matrix([30, 70, 0, 50], 4, seed)[0, 0] for seed in range(2000)]
    assert abs(np.mean(first) - 30 * 38 / 150) < 0.15
    matrix = sharding.communication_matrix([30, 70, 0, 50], 4, 1)
    assert matrix.sum(1).tolist() == [30, 70, 0, 50] and sorted(matrix.sum(0)) == [37, 37, 38, 38]


def test_shards_of_many_rows_follow_the_law():
    dice = np.random.default_rng(2)
    few = [sharding.hypergeometric(dice, 500_000_000, 1_000_000_000, 3) for _ in range(20_000)]
    for count, share in enumerate((8 / 27, 12 / 27, 6 / 27, 1 / 27)):
        assert abs(np.mean(np.array(few) == count) - share) < 4 * (share * (1 - share) / 20_000) ** 0.5
    many = [sharding.hypergeometric(dice, 10 ** 9, 3 * 10 ** 9, 4 * 10 ** 8) for _ in range(400)]
    spread = (4e8 * .25 * .75 * .9) ** 0.5
    assert abs(np.mean(many) - 10 ** 8) < 4 * spread / 20 and 0.85 < np.std(many) / spread < 1.15
    assert sharding.hypergeometric(dice, 10 ** 9, 5, 10 ** 9 + 3) in range(10 ** 9 - 2, 10 ** 9 + 1)
    assert sharding.communication_matrix([3 * 10 ** 9, 1, 5], 2, 1).sum(0).tolist() == [1_500_000_003] * 2


def test_shards_odd_rows(odd, none):
    rows = sharding.shuffle_into_shards(odd, 4).toPandas()
    assert len(rows) == odd.count() and rows.groupby("shard").size().max() <= 3 and "labels" in rows
    assert sharding.shuffle_into_shards(none, 4).count() == 0
