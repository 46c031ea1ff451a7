"""Pages on held-out layouts, nearest neighbours against brute force, and the pipeline."""

import html
import re
import time

import numpy as np
import pytest

import corpus_pipeline
from wattlake.llm import nearest, packing, pages, quality
from wattlake.llm.htmltree import features, parse, text_of


@pytest.fixture(scope="module")
def model():
    return pages.fit()


def test_held_out_layouts(model):
    layout, right = pages.Layout(99), 0
    for _ in range(150):
        root = parse(layout.page())
        nodes, table = features(root)
        truth = {id(node) for node, kept in zip(nodes, pages.labels(nodes)) if not kept}
        gone = pages.decode(nodes, model.log_odds(table))
        assert all(id(node) in gone for node in nodes if node.parent is not None and id(node.parent) in gone)
        right += text_of(root, gone) == text_of(root, truth)
    assert right >= 140


def test_pages_query(spark, sf_dir):
    found = {row["page_id"]: row for row in pages.op4_pages(spark, sf_dir).collect()}
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", row["html"] or "", re.S)
        text = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article[1])) if article else ""
        text = re.sub(r"\s+", " ", html.unescape(text)).strip()
        assert (found[row["page_id"]]["text"], found[row["page_id"]]["n_chars"]) == (text, len(text))


def test_pages_by_hand(model):
    page = "<body><nav><a href=1>Menu</a></nav><div class=cookie-notice>We use cookies, accept them all now.</div>" \
           "<article><h1>Title &amp; more</h1><p>First <b>bold</b>\n part of a long sentence that goes on, and on.<p>Second&nbsp;one " \
           "with enough words to look like prose, really.</p><script>var x='<p>no</p>'</script></article>" \
           "<section class=comments><div class=comment><p>Nice post, thank you!</p></div></section><footer>&copy; me</footer>"
    assert pages.main_texts([page, "", " ", "<p"], model) == [
        "Title & more First bold part of a long sentence that goes on, and on. Second one with enough words to look like prose, really.",
        "", "", ""]


def test_deep_pages_take_linear_time(model):
    article = "<article><h1>A title of some words</h1><p>" + "A sentence of prose, which goes on. " * 20 + "</p></article>"
    for deep in ("<i>" * 170_000 + "<p>" * 170_000, "<p><table>" + "<i>" * 50_000 + "</p>" * 50_000, "<li>" * 50_000):
        start = time.process_time()
        assert isinstance(pages.main_texts([article + deep], model)[0], str)
        assert time.process_time() - start < 120                     # quadratic steps would take hours


def test_misplaced_tags():
    def outline(node):
        return [node.tag, *(child if isinstance(child, str) else outline(child) for child in node.children)]
    assert outline(parse("<p>a<i>b<p>c</i>d<div>e</p>f</div></span>g")) == [
        "html", ["p", "a", ["i", "b"]], ["p", "c", "d"], ["div", "e", "f"], "g"]
    assert outline(parse("<ul><li>a<ul><li>b</ul><li>c</ul><table><tr><td>x</div></i><td>y</table>z")) == [
        "html", ["ul", ["li", "a", ["ul", ["li", "b"]]], ["li", "c"]], ["table", ["tr", ["td", "x"], ["td", "y"]]], "z"]


def test_pages_odd_rows(spark, model):
    rows = spark.createDataFrame([(1, "u", None, "t"), (1, "u", "", "t"), (None, None, "<p>" + "word " * 20_000, "t"), (3, "u", "</div>", "t")],
                                 "page_id long, url string, html string, text string")
    assert pages.extract(rows, model).count() == 4 and pages.extract(rows.limit(0), model).count() == 0


def truth(ids, vectors, k):
    out = {}
    for i, key in enumerate(ids):
        score = np.einsum("ij,j->i", vectors, vectors[i])           # equal rows get equal sums
        other = np.nonzero(ids != key)[0]
        out[key] = ids[other[np.lexsort((ids[other], -score[other]))][:k]].tolist()
    return out


def test_nearest_recall(spark):
    dice = np.random.default_rng(4)
    vectors = dice.standard_normal((6000, 32)) * dice.uniform(.5, 2, (6000, 1))
    vectors[100:1500] = vectors[0]                                # one vector very often
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = nearest.search(rows, rows.where("vec_id % 60 = 0"), 20).toPandas()
    expected = truth(np.arange(6000), vectors, 20)
    hits = [len(set(own["vec_id"]) & set(expected[key])) for key, own in found.groupby("query_id")]
    assert len(hits) == 100 and np.mean(hits) / 20 >= 0.9
    assert found[found["query_id"] == 600].sort_values("rank")["vec_id"].tolist() == expected[600]
    for row in found.sample(200, random_state=1).itertuples():
        assert row.score == pytest.approx(vectors[row.query_id] @ vectors[row.vec_id], rel=1e-12)


def test_nearest_recall_on_small_tables(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    for n in (1100, 2000):
        rows = given.where(f"vec_id < {n}")
        table = rows.select("vec_id", "embedding").toPandas()
        ids = table["vec_id"].to_numpy()
        expected = truth(ids, np.array(table["embedding"].tolist(), float), 20)
        found = nearest.op5_nearest(spark, "/root/testdata/sf0.1") if n >= given.count() else \
            nearest.search(rows, rows.where("vec_id % 20 = 0"), 20)
        hits = [len(set(own["vec_id"]) & set(expected[key])) for key, own in found.toPandas().groupby("query_id")]
        assert len(hits) == (ids % 20 == 0).sum() and np.mean(hits) / 20 >= 0.99


def test_nearest_query_and_odd_rows(spark, sf_dir):
    found = nearest.op5_nearest(spark, sf_dir).toPandas()
    assert (found.groupby("query_id")["rank"].max() == 20).all() and (found["query_id"] != found["vec_id"]).all()
    odd = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, None]), (80, [float("nan"), 1.0]), (None, [1.0, 1.0]),
                                 (1, [2.0, 1.0]), (2, [2.0, 1.0]), (3, [1.0]), (0, [1.0, 0.0])], "vec_id long, embedding array<float>")
    rows = [tuple(row) for row in nearest.search(odd, odd.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect()]
    assert rows == [(0, 1, 1, 2.0), (0, 2, 2, 2.0)]
    assert nearest.search(odd.limit(0), odd.limit(0), 20).count() == 0


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test")
        assert docs.columns == columns
        kept[name] = {row["doc_id"]: row for row in docs.collect()}
    good = {row["doc_id"] for row in quality.op3_quality(spark, sf_dir).where("kept").collect()}
    from tests.llm.test_texts import groups
    first = kept["quality rules"]
    assert set(first) == good
    chosen = {least for _, _, least in groups([(key, row["text"]) for key, row in first.items()])}
    assert set(kept["n-gram Jaccard join"]) == chosen
    last = kept["suffix-array dedup"]
    assert set(last) == chosen and all(row["n_chars"] == len(row["text"]) for row in last.values())
    seen = set()
    for key in sorted(last):                                       # what is left starts no passage of an earlier input
        text = first[key]["text"].encode()
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - 49):
            if text[at:at + 50] in seen:
                gone[at:at + 50] = True
        seen |= {text[at:at + 50] for at in range(len(text) - 49)}
        starts = [i for i in range(len(text)) if text[i] & 0xC0 != 0x80] + [len(text)]
        assert last[key]["text"] == b"".join(text[a:b] for a, b in zip(starts, starts[1:]) if not gone[a:b].all()).decode()
    pieces = packing.pack_documents(docs).toPandas()
    assert set(pieces["doc_id"]) == chosen and corpus_pipeline.run(spark, sf_dir).count() == len(pieces)


def test_pipeline_odd_rows(spark, odd):
    from pyspark.sql import functions as F
    docs = odd.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, docs.limit(0), "").count() == 0
    left = corpus_pipeline.different_documents(spark, docs, "").collect()
    assert sum(row["doc_id"] == 5 for row in left) == 1


def test_pipeline_carries_other_columns(spark, odd):
    from pyspark.sql import functions as F
    names = ["row", "kept", "n_words", "carried", "n_bytes", "group", "a.b", "home", "bucket"]
    docs = odd.select("doc_id", "text", F.lit(1).cast("long").alias("n_chars"),
                      *[F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")).alias(name) for name in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for row in stage(spark, docs, "").collect():
            assert row["doc_id"] is None or all(row[name] == f"{name} of {row['doc_id']}" for name in names)
    assert corpus_pipeline.new_passages(spark, docs, "").columns == docs.columns
    same_hash_once = docs.where("doc_id = 5").unionByName(docs.where("doc_id = 5"))
    assert corpus_pipeline.different_documents(spark, same_hash_once, "").count() == 1
