"""Lexical search, the quality network and hard negatives against brute force and held-out labels."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from wattlake.llm import convnet, lexical, negatives

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def term_list(text):
    return re.findall(TERM, (text or "").translate({code: code + 32 for code in range(65, 91)}))


def ranked(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every document."""
    held = [(key, Counter(term_list(text))) for key, text in docs]
    held = [(key, found) for key, found in held if found]
    n, total = len(held), sum(sum(found.values()) for _, found in held)
    df = Counter(word for _, found in held for word in found)
    rows = []
    for item, text in items:
        scored = []
        for key, found in held:
            m = 75 + 25 * sum(found.values()) * n // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[word] + 1)))
                        * (10 ** 9 * found[word] // (1000 * found[word] + 12 * m))
                        for word, times in Counter(term_list(text)).items() if found[word])
            scored.append((-score, key is None, key))
        rows += [(item, rank + 1, key, -score) for rank, (score, _, key) in enumerate(sorted(x for x in scored if x[0] < 0)[:k])]
    return rows


def test_lexical_ranks_every_document(spark):
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)] + ["É", "straße", "日本"]
    share = 1 / np.arange(1, len(words) + 1)
    docs = [(i, " ".join(draw.choice(words, draw.integers(0, 40), p=share / share.sum()))) for i in range(400)]
    docs += [(1000 + i, "w1, W2. w3!") for i in range(30)] + [(None, "w1 w2 w3"), (77, None), (78, ""), (5, "w9 W9")]
    items = [(i, " ".join(draw.choice(words, 12))) for i in range(25)] + [(100, "w1 w2 w3"), (101, "absent"), (102, ""), (103, "w5 W5 w5 w1")]
    table = spark.createDataFrame([(*row, 1.5) for row in docs], "doc_id long, text string, score double").repartition(5)
    asked = spark.createDataFrame([*items, (100, "w1 w2 w3"), (None, "w1"), (104, None)], "item_id long, text string")
    found = sorted(tuple(row) for row in lexical.search(table, asked, 7).collect())
    assert found == sorted(ranked(docs, items, 7))


def test_lexical_stops_early_and_keeps_ties():
    n = 5000
    term = np.concatenate([np.zeros(n, np.int64), np.ones(n, np.int64)])
    owner = np.tile(np.arange(n), 2)
    impact = np.concatenate([n - np.arange(n), n - np.arange(n)]).astype(np.int64)
    lists = lexical.ImpactLists(owner, term, impact, n, 2)
    numbers, weights = np.array([0, 1]), np.array([1, 1])
    docs, scores = lists.search(numbers, weights, weights, 5, np.zeros(0, np.int64))
    assert lists.read < n / 20 and set(range(5)) <= set(docs) and max(scores) == 2 * n
    level = lexical.ImpactLists(owner, term, np.full(2 * n, 7), n, 2)
    docs, _ = level.search(numbers, weights, weights, 5, np.zeros(0, np.int64))
    assert set(range(5)) <= set(docs)                       # equal scores: nothing may be left out
    lists.read = 0
    assert len(lists.search(numbers, weights, weights, 5, np.full(5, 3 * n))[0]) == 0 and lists.read < n / 20


def test_lexical_pieces_and_blocks(spark, monkeypatch):
    text = ("alpha Beta-gamma " * 50 + "x" * 300 + " tail").encode()
    whole = [word for words in lexical.terms(text) for word in words]
    monkeypatch.setattr(lexical, "PIECE_BYTES", 64)
    assert [word for words in lexical.terms(text) for word in words] == whole == [w.encode() for w in term_list(text.decode())]
    monkeypatch.setattr(lexical, "QUERY_BLOCK", 2)
    docs, items = [(1, "a b"), (2, "b c"), (3, "c a a")], [(1, "a"), (2, "b"), (3, "c"), (4, "a c"), (5, "z")]
    found = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(row) for row in found.collect()) == sorted(ranked(docs, items, 20))


def test_lexical_empty(none, spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(none, items).count() == 0 and lexical.search(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).count() == 0


def chunk_answers(model, texts):
    pieces = convnet.Pieces(texts, list(range(len(texts))))
    return pieces, convnet.answers(model, pieces)[1]


def loss(model, texts, labels):
    pieces, best = chunk_answers(model, texts)
    of = [best[pieces.owner == i] for i in range(len(texts))]
    score = convnet.combined(model, np.array([x.max(0) for x in of]), np.array([x.mean(0) for x in of]))[2]
    return -np.mean(labels * np.log(score) + (1 - labels) * np.log(1 - score))


def test_network_gradients():
    model = {name: value.astype(np.float64) for name, value in convnet.start_model(1).items()}
    texts = [bytes(np.random.default_rng(i).integers(0, 256, 50 + 333 * i, dtype=np.uint8)) for i in range(5)]
    labels = np.array([1.0, 0, 1, 0, 1])
    for name, gradient in convnet.gradients(model, texts, labels).items():
        at = np.unravel_index(np.argmax(np.abs(gradient)), np.shape(gradient)) if np.shape(gradient) else ()
        values, step = model[name], 1e-6
        sides = []
        for sign in (1, -1):
            model[name] = values.copy()
            model[name][at] += sign * step
            sides.append(loss(model, texts, labels))
        model[name] = values
        assert (sides[0] - sides[1]) / (2 * step) == pytest.approx(float(np.asarray(gradient)[at]), rel=1e-4)


def test_network_held_out(spark, sf_dir):
    rows = {row["doc_id"]: row for row in convnet.op12_convnet(spark, sf_dir).collect()}
    labels = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert set(rows) == {row["doc_id"] for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()}
    for key, row in rows.items():
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3)
    judged = [(rows[key]["score"], label) for key, label in labels.items() if rows[key]["held_out"]]
    good, bad = ([score for score, label in judged if label == value] for value in (1, 0))
    assert len(bad) >= 5 and np.mean([a > b for a in good for b in bad]) > 0.9
    assert np.mean(np.array(good) >= convnet.THRESHOLD) > 0.95


def test_network_reads_whole_texts(spark, monkeypatch):
    model = convnet.start_model(2)
    start, end = b"plain words in a row " * 3000, b"#$%&" * 200
    rows = spark.createDataFrame([(1, (start + end).decode()), (2, start.decode()), (3, None), (4, ""), (None, "x"), (5, "é" * 500)],
                                 "doc_id long, text string")
    scores = {row["doc_id"]: row["score"] for row in convnet.score_texts(rows, model, "doc_id", "text").collect()}
    for key, text in ((1, start + end), (2, start), (4, b""), (5, "é".encode() * 500)):
        _, best = chunk_answers(model, [text])
        assert scores[key] == pytest.approx(float(convnet.combined(model, best.max(0)[None], best.mean(0)[None])[2][0]), rel=1e-4)
    assert scores[3] == scores[4] and scores[1] != scores[2] and len(scores) == 6
    pieces, best = chunk_answers(model, [start + end])
    covered = np.unique(pieces.chunk_blocks)
    assert covered.tolist() == list(range(len(pieces.raw) // convnet.BLOCK)) and len(best) == len(pieces.chunk_blocks)
    long = (b"plain words in a row " * 40000 + end).decode()                 # several pieces
    some = spark.createDataFrame([(1, long), (2, long[:-800])], "doc_id long, text string")
    first, second = convnet.score_texts(some, model, "doc_id", "text").orderBy("doc_id").collect()
    assert first["score"] != second["score"]


def test_network_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([(1, 1, "a"), (8, 0, "b"), (8, None, "c"), (None, 1, "d"), (2, 1, "e")],
                                   "doc_id long, quality int, score string")
    rows = convnet.classify(odd, labels).collect()
    assert Counter(row["doc_id"] for row in rows) == Counter(row["doc_id"] for row in odd.collect())
    assert len({row["score"] for row in rows if row["doc_id"] in (2, 3)}) == 1
    assert not next(row for row in rows if row["doc_id"] is None)["held_out"]
    assert convnet.classify(none, labels).count() == 0 and convnet.classify(odd, labels.limit(0)).count() == 10


def test_training_sample_is_bounded(spark):
    docs = spark.range(200).selectExpr("id AS doc_id", "repeat('ab ', CAST(id AS INT)) AS text")
    labels = spark.range(200).selectExpr("id AS doc_id", "1 AS quality")
    rows = convnet.training_rows(docs, labels, rows=50, size=3200).collect()
    held = {str(i) for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert 0 < len(rows) <= 50 and sum(len(row["text"]) for row in rows) <= 3200
    assert all(str(len(row["text"]) // 3) not in held and len(row["text"]) <= 200 for row in rows)


def hard(rows, anchors, positives=5, take=3):
    """(anchor, positive, rank, negative, scores) by multiplying every pair."""
    out = []
    usable = [(key, label, [math.floor(256 * x) for x in v]) for key, label, v in rows
              if key is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for a, label, q in usable:
        if not anchors(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), key, other) for key, other, v in usable if key != a and len(v) == len(q))
        for minus, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [(n, s) for s, n, other in scored if other != label and 50 * -minus <= 100 * -s <= 95 * -minus]
            out += [(a, p, rank + 1, n, -minus, -s) for rank, (n, s) in enumerate(fits[:take])]
    return sorted(out)


def vectors(n, width, seed=1):
    draw = np.random.default_rng(seed)
    found = draw.standard_normal((n, width)) * 0.2 + draw.integers(0, 3, (n, 1)) * 0.1
    return [(i, int(draw.integers(0, 4)), [float(np.float32(x)) for x in row]) for i, row in enumerate(found)]


def mined(spark, rows, **more):
    table = spark.createDataFrame([(*row, 1, "x") for row in rows], "vec_id long, label int, embedding array<float>, rank int, row string")
    return sorted(tuple(row) for row in negatives.mine(table, negatives.F.col("vec_id") % 5 == 0, **more).collect())


@pytest.mark.parametrize("width", [1, 7, 64])
def test_negatives_against_all_pairs(spark, width):
    rows = vectors(150, width)
    assert mined(spark, rows) == hard(rows, lambda key: key % 5 == 0)


def test_negatives_odd_rows(spark, monkeypatch):
    rows = vectors(60, 8) + [(100, None, [1.0] * 8), (105, 1, None), (None, 1, [1.0] * 8), (110, 1, [math.nan] + [1.0] * 7),
                             (115, 1, [None] + [1.0] * 7), (120, 1, [0.0] * 8), (125, 2, []), (126, 2, []), (130, 1, [1.0] * 5),
                             (131, 1, [0.9] * 5), (132, 2, [0.8] * 5), (135, 3, [math.inf] * 8)]
    rows += [(200 + i, 0, [0.5] * 8) for i in range(40)] + [(300 + i, 1, [0.3] * 8) for i in range(40)]     # ties, a hot label
    for name, value in (("PART_ROWS", 16), ("GROUP_ANCHORS", 8), ("TILE_ROWS", 4), ("TILE_ANCHORS", 3)):
        monkeypatch.setattr(negatives, name, value)
    assert mined(spark, rows) == hard(rows, lambda key: key % 5 == 0)
    again = rows[:60] + [rows[0]]
    assert mined(spark, again) == hard(again, lambda key: key % 5 == 0)
    assert mined(spark, []) == []
    huge = [(i, i % 2, [3e38, 1.0]) for i in range(20)]
    assert mined(spark, huge) == []


def test_segment_bounds_hold_and_decide():
    draw = np.random.default_rng(4)
    smooth = np.cumsum(draw.integers(-9, 10, (300, 64)), axis=1)
    sides = [negatives.Side(np.arange(len(x)), np.zeros(len(x)), x, *negatives.summaries(x)) for x in (smooth[:40], smooth)]
    product = smooth[:40] @ smooth.T
    for (mean_a, spread_a), (mean_r, spread_r) in zip(sides[0].levels, sides[1].levels):
        middle, reach = mean_a @ mean_r.T, spread_a @ spread_r.T + 1e-6
        assert (middle - reach <= product).all() and (product <= middle + reach).all()
    least, counts = np.partition(product, -5, axis=1)[:, -5], {}
    a, r, found = negatives.within(*sides, np.ones(product.shape, bool), least, None, counts)
    assert counts["exact"] < 0.2 * counts["pairs"]
    assert sorted(zip(a, r, found)) == sorted((i, j, product[i, j]) for i, j in zip(*np.nonzero(product >= least[:, None])))
