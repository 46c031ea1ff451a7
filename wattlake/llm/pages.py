"""Main text of HTML pages: boosted trees over DOM nodes, decoded over the tree.

Each element gets the probability that it belongs to the article, from features of its subtree (text density,
links, lists, controls), its attribute words, depth, siblings and what stands above it.  The verdicts are then
chosen together: an element that is dropped takes all below it along, so no kept element can lie in a dropped
one, and among the choices left that with the largest sum of log-probabilities is taken (one pass up, one down).

The trees are fitted where the job starts, on ``TRAINING_PAGES`` pages made by a seeded generator of page
layouts (a documented bound, the tables hold no labels for nodes), and sent to the tasks.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.boosting import BoostedTrees
from wattlake.llm.common import blocks, read
from wattlake.llm.htmltree import HINTS, Node, features, parse, text_of

TRAINING_PAGES = 400
PAGE_BYTES = 1 << 20         # pages whose nodes are scored together
MARK = "data-part"           # attribute that says, in training pages, what an element is
SYLLABLES = "ka lo mi re tu san der en ba vo li qui no per zu tal em is or ap".split()


class Layout:
    """Makes labelled pages: an article among menus, notices, adverts, forms, sidebars, comments and footers."""

    def __init__(self, seed: int):
        self.dice = random.Random(seed)

    def words(self, low: int, high: int, stops: bool = True) -> str:
        said = ["".join(self.dice.choices(SYLLABLES, k=self.dice.randint(1, 4))) + ("." if stops and self.dice.random() < .1 else "")
                for _ in range(self.dice.randint(low, high))]
        return " ".join(said).capitalize()

    def named(self, group: str, sure: float = 0.7) -> str:
        if self.dice.random() > sure:
            return self.dice.choice(["", ' class="c12"', ' class="box wide"', ' id="x3"'])
        word = self.dice.choice(HINTS[group].split())
        return f' {self.dice.choice(["class", "id"])}="{self.dice.choice([word, word + "-box", "page-" + word])}"'

    def element(self, part: str, tag: str, attrs: str, inside: str) -> str:
        return f'<{tag}{attrs} {MARK}="{part}">{inside}</{tag}>'

    def links(self, n: int) -> str:
        one = [f'<a href="/{i}">{self.words(1, 3, False)}</a>' for i in range(n)]
        kind = self.dice.random()
        return "<ul>" + "".join(f"<li>{x}</li>" for x in one) + "</ul>" if kind < .6 else " | ".join(one) if kind < .8 else \
            "".join(f"<div>{x}</div>" for x in one)

    def plain(self, kind: str) -> str:
        dice = self.dice
        tag, inside = {
            "menu": (["nav", "div", "ul"], lambda: self.links(dice.randint(3, 12))),
            "head": (["header", "div"], lambda: f"<a href='/'>{self.words(1, 3)}</a>" + dice.choice(["", f"<p>{self.words(2, 9)}</p>"])),
            "side": (["aside", "div", "section"], lambda: f"<h3>{self.words(1, 3)}</h3>" + (self.links(dice.randint(2, 8)) if dice.random() < .6 else f"<p>{self.words(5, 40)}</p>")),
            "advert": (["div", "aside", "section"], lambda: self.words(3, 30)),
            "notice": (["div", "section", "p"], lambda: self.words(6, 40) + dice.choice(["", " <button>Ok</button>", " <a href='#'>Ok</a>"])),
            "form": (["form", "div"], lambda: f"<label>{self.words(1, 3)}</label><input type='text'>" + dice.choice(["", f"<p>{self.words(3, 12)}</p>"])),
            "share": (["div", "ul"], lambda: self.links(dice.randint(2, 5))),
            "comment": (["section", "div", "ol"], lambda: "".join(f"<div{self.named('comment', .5)}><b>{self.words(1, 2)}</b><p>{self.words(4, 60)}</p></div>" for _ in range(dice.randint(1, 5)))),
            "foot": (["footer", "div"], lambda: dice.choice(["&copy; 2024 ", ""]) + self.words(3, 30) + dice.choice(["", self.links(3)])),
        }[kind]
        chosen = dice.choice(tag)
        semantic = chosen in ("nav", "header", "footer", "aside", "form")
        return self.element("drop", chosen, self.named(kind, .3 if semantic else .93), inside())

    def article(self) -> str:
        dice = self.dice
        body = [f"<h1>{self.words(3, 12)}</h1>"] if dice.random() < .8 else []
        for _ in range(dice.randint(1, 14)):
            kind = dice.random()
            body.append(f"<p>{self.words(2, 160)}</p>" if kind < .6 else f"<p><b>{self.words(3, 60)}<br><p>{self.words(4, 90)}</p>" if kind < .7
                        else f"<h2>{self.words(1, 6)}</h2>" if kind < .78 else f"<div>{self.words(5, 90)}</div>" if kind < .84
                        else "<ul>" + "".join(f"<li>{self.words(2, 20)}</li>" for _ in range(dice.randint(2, 6))) + "</ul>" if kind < .9
                        else f"<blockquote>{self.words(5, 50)}</blockquote>" if kind < .94 else f"<pre>{self.words(4, 30)}</pre>" if kind < .96
                        else f"<table><tr><td>{self.words(1, 5)}</td><td>{self.words(1, 5)}</td></tr></table>")
            if dice.random() < .08:
                body.append(self.plain(dice.choice(["advert", "share", "form", "side"])))
        inside = "".join(body)
        kind = dice.random()
        if kind < .5:
            return self.element("keep", "article", self.named("content", .4), inside)
        if kind < .65:
            return self.element("keep", "main", self.named("content", .3), inside)
        return self.element("keep", dice.choice(["div", "section"]), self.named("content", .85), inside)

    def page(self) -> str:
        dice = self.dice
        before = [kind for kind, chance in (("notice", .3), ("head", .5), ("menu", .8), ("form", .15), ("advert", .4), ("side", .15))
                  if dice.random() < chance]
        after = [kind for kind, chance in (("share", .3), ("advert", .3), ("comment", .4), ("side", .4), ("form", .2), ("menu", .2),
                                           ("notice", .2), ("foot", .8)) if dice.random() < chance]
        dice.shuffle(before)
        inside = "".join(map(self.plain, before)) + self.article() + "".join(map(self.plain, after))
        if dice.random() < .4:
            inside = f'<div{self.named("content", .2)}>{inside}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>{inside}</body></html>"


def labels(nodes: list[Node]) -> np.ndarray:
    """1 for elements of the article and those around it, 0 for the others, from the marks of training pages."""
    part: dict[int, str] = {}
    around: set[int] = set()
    for node in nodes:
        own = dict(node.attrs).get(MARK)
        part[id(node)] = own or part.get(id(node.parent), "")
        if own == "keep":
            while node is not None:
                around.add(id(node))
                node = node.parent
    return np.array([float(part[id(node)] == "keep" or id(node) in around) for node in nodes])


def fit(pages: int = TRAINING_PAGES, seed: int = 11) -> BoostedTrees:
    layout, xs, ys = Layout(seed), [], []
    for _ in range(pages):
        nodes, table = features(parse(layout.page()))
        xs.append(table)
        ys.append(labels(nodes))
    return BoostedTrees().fit(np.concatenate(xs), np.concatenate(ys))


def decode(nodes: list[Node], log_odds: np.ndarray) -> set[int]:
    """The elements to drop: the likeliest choice in which what lies in a dropped element is dropped as well."""
    keep, drop = {}, {}
    for node, odds in zip(reversed(nodes), log_odds[::-1]):
        inner = [child for child in node.children if isinstance(child, Node) and id(child) in keep]
        drop[id(node)] = -np.logaddexp(0, odds) + sum(drop[id(child)] for child in inner)
        keep[id(node)] = -np.logaddexp(0, -odds) + sum(max(keep[id(child)], drop[id(child)]) for child in inner)
    gone: set[int] = set()
    for node in nodes:
        if node.parent is not None and (id(node.parent) in gone or node.tag != "body" and drop[id(node)] > keep[id(node)]):
            gone.add(id(node))
    return gone


def main_texts(pages: list[str], model: BoostedTrees) -> list[str]:
    """The main text of each page; the nodes of all are scored together."""
    roots = [parse(html) for html in pages]
    tables = [features(root) for root in roots]
    if not tables:
        return []
    odds = np.split(model.log_odds(np.concatenate([table for _, table in tables])),
                    np.cumsum([len(nodes) for nodes, _ in tables])[:-1])
    return [text_of(root, decode(nodes, own)) for root, (nodes, _), own in zip(roots, tables, odds)]


def extract(df: DataFrame, model: BoostedTrees | None = None, html: str = "html",
            keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` and the main text of every row's whole page.

    A null or empty page has an empty text, and so has one without an article.  Rows that repeat are answered
    each; other columns are not carried, and one in ``keep`` that is called text is replaced.
    """
    keep = [name for name in keep if name != "text"]
    shared = df.sparkSession.sparkContext.broadcast(model or fit())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "__html", PAGE_BYTES):
            found = main_texts([value or "" for value in batch.column(0).to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.string())], [*keep, "text"])

    rows = df.select(F.col(html).cast("string").alias("__html"), *[F.col(f"`{name}`") for name in keep])
    return rows.mapInArrow(run, rows.drop("__html").schema.add("text", "string"))


def op4_pages(spark, sf_dir: str) -> DataFrame:
    """The main text of every page and its length."""
    return extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
