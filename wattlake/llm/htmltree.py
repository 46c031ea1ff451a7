"""A small DOM from whole HTML pages, and features of its nodes."""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np

# Element names of HTML by their role in layout.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section select summary table "
            "tbody td tfoot th thead title tr ul".split())
HIDDEN = set("script style noscript template head title iframe svg object canvas textarea select button".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
CLOSE_P = BLOCK - {"br", "body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "title",
                   "summary", "figcaption"}
SCOPE = set("article aside blockquote body div dl fieldset figure footer form header html main nav ol section table td "
            "th ul details".split())
LIST_SCOPE = {"ul", "ol", "dl", "table", "select", "body", "div", "section", "article", "nav"}
WALLS = SCOPE | {"table", "body"}      # what the end tag of an inline element does not reach beyond

# Words in class, id and role attributes, by the part of a page they hint at.
HINTS = {
    "content": "article post entry content story main text body prose markdown",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs tabs toolbar pager pagination",
    "side": "sidebar side aside rail widget related recommended trending popular tags toc",
    "head": "header masthead banner topbar logo",
    "foot": "footer bottom copyright legal colophon",
    "advert": "ad ads advert advertisement adverts sponsor sponsored promo promotion",
    "notice": "cookie cookies consent notice alert popup modal overlay gdpr privacy",
    "comment": "comment comments reply replies disqus discussion respond reactions",
    "form": "form search newsletter subscribe signup login",
    "share": "share social sharing follow",
}
HINT_OF = {word: group for group, words in HINTS.items() for word in words.split()}
TAGS = ("article main section div p a li ul nav header footer aside form table td h1 h2 h3 span blockquote pre figure "
        "address").split()
SPACE = re.compile(r"\s+")
UNFINISHED = re.compile(r"<[A-Za-z/!][^<>]*\Z")       # a tag that the page's end cuts off


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "words")

    def __init__(self, tag: str, attrs: list, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.words: set[str] = set()


class Builder(HTMLParser):
    """Builds the tree; unclosed and misplaced tags are repaired as browsers do in the common cases.

    The open elements are a path from the root; for each tag the places of its open elements on that path are kept, so
    that a tag finds what it closes without walking the path, however deep it is.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", [], None)
        self.path = [self.root]
        self.places: dict[str, list[int]] = {}
        self.has_body = False

    @property
    def at(self) -> Node:
        return self.path[-1]

    def close(self):
        super().close()
        return self.root

    def innermost(self, tags: set[str]) -> int:
        """The place of the innermost open element with one of the tags; 0, the root's, if there is none."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def shorten(self, place: int):
        """Closes the element at a place and all within it."""
        for node in self.path[place:]:
            self.places[node.tag].pop()
        del self.path[place:]

    def leave(self, tags: set[str], scope: set[str]):
        """Closes the innermost element with one of the tags, unless a scope's element lies between (or is it)."""
        place = self.innermost(tags)
        if place > self.innermost(scope):
            self.shorten(place)

    def handle_starttag(self, tag, attrs):
        if tag == "html" or tag == "body" and self.has_body:
            return
        if tag in CLOSE_P:
            self.leave({"p"}, SCOPE)
        if tag in CLOSES:
            for _ in CLOSES[tag]:
                self.leave(CLOSES[tag], LIST_SCOPE)
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        self.has_body |= tag == "body" and self.at is self.root
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.path))
            self.path.append(node)

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.at.children.append(Node(tag, attrs, self.at))
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        place = self.innermost({tag})
        if place and place >= self.innermost({"table", "body"} if tag in BLOCK else WALLS):
            self.shorten(place)

    def handle_data(self, data):
        if data:
            self.at.children.append(data)


def parse(html: str) -> Node:
    builder = Builder()
    builder.feed(UNFINISHED.sub("", html))
    return builder.close()


FEATURES = [f"tag_{tag}" for tag in TAGS] + [f"hint_{group}" for group in HINTS] + [f"above_{group}" for group in HINTS] + [
    "above_article", "above_boilerplate", "depth", "log_chars", "log_words", "log_tags", "chars_per_tag", "link_share",
    "list_share", "form_controls", "punctuation", "digits", "share_of_page", "text_before", "place", "siblings",
    "same_tag_siblings", "sibling_link_share", "longest_paragraph", "paragraphs", "parent_log_chars", "parent_link_share"]
BOILERPLATE = set("nav header footer aside form".split())
NO_TAG = [0.0] * len(TAGS)
TAG_ROW = {tag: [float(tag == other) for other in TAGS] for tag in TAGS}


def features(root: Node) -> tuple[list[Node], np.ndarray]:
    """The elements in page order, without hidden ones, and a row of ``FEATURES`` for each."""
    nodes: list[Node] = []
    depth: dict[int, int] = {}
    stack = [(root, 0)]
    while stack:
        node, level = stack.pop()
        if node.tag in HIDDEN:
            continue
        depth[id(node)] = level
        nodes.append(node)
        stack += [(child, level + 1) for child in reversed(node.children) if isinstance(child, Node)]
    sums = {id(node): np.zeros(9) for node in nodes}       # chars, words, tags, link, list, controls, punctuation, digits, paragraphs
    longest = dict.fromkeys(sums, 0.0)
    before: dict[int, float] = {}
    read = 0.0
    for node in nodes:
        before[id(node)] = read
        text = " ".join(x for x in node.children if isinstance(x, str)).strip()
        own = sums[id(node)]
        if text:
            read += len(text)
            own[:2] += len(text), text.count(" ") + 1
            own[6] += sum(map(text.count, ".,;:!?"))
            own[7] += sum(map(text.count, "0123456789"))
        own[2] += 1
        own[5] += node.tag in ("input", "label", "button", "select")
        own[8] += node.tag == "p"
    for node in reversed(nodes):
        own = sums[id(node)]
        if node.tag == "a":
            own[3] = own[0]
        if node.tag == "li":
            own[4] = own[0]
        if node.tag == "p":
            longest[id(node)] = max(longest[id(node)], own[0])
        if node.parent is not None and id(node.parent) in sums:
            sums[id(node.parent)] += own
            longest[id(node.parent)] = max(longest[id(node.parent)], longest[id(node)])
    flat = {key: own.tolist() for key, own in sums.items()}
    page = max(1.0, flat[id(root)][0])
    family: dict[int, tuple[int, float, float]] = {id(root): (1, 0.0, 1.0)}      # siblings, place, share of the same tag
    for node in nodes:
        inner = [child for child in node.children if isinstance(child, Node)]
        tags: dict[str, int] = {}
        for child in inner:
            tags[child.tag] = tags.get(child.tag, 0) + 1
        for i, child in enumerate(inner):
            family[id(child)] = len(inner), i / len(inner), tags[child.tag] / len(inner)
    nothing = ([0.0] * len(HINTS), 0.0, 0.0)
    above: dict[int, tuple] = {}
    rows: list[list[float]] = []
    for node in nodes:
        key, up_key = id(node), id(node.parent)
        own, up = flat[key], flat.get(up_key) or flat[key]
        hints = hints_of(node.attrs) if node.attrs else nothing[0]
        up_hints, up_article, up_plain = above.get(up_key, nothing)
        above[key] = (list(map(max, up_hints, hints)) if node.attrs else up_hints,
                      max(up_article, float(node.tag in ("article", "main"))), max(up_plain, float(node.tag in BOILERPLATE)))
        chars, first = max(1.0, own[0]), before[key]
        n_siblings, place, same = family[key]
        rows.append([*TAG_ROW.get(node.tag, NO_TAG), *hints, *up_hints, up_article, up_plain, depth[key], math.log1p(own[0]),
                     math.log1p(own[1]), math.log1p(own[2]), own[0] / own[2], own[3] / chars, own[4] / chars, own[5],
                     own[6] / chars, own[7] / chars, own[0] / page, first / page, place, n_siblings, same,
                     (up[3] - own[3]) / max(1.0, up[0] - own[0]), math.log1p(longest[key]), own[8],
                     math.log1p(up[0]), up[3] / max(1.0, up[0])])
    return nodes, np.array(rows)


def hints_of(attrs: list) -> list[float]:
    """Which groups of hints the class, id and role words of an element belong to."""
    found = {HINT_OF.get(word) for name, value in attrs if name in ("class", "id", "role") and value
             for word in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())}
    return [float(group in found) for group in HINTS]


def text_of(root: Node, dropped: set[int]) -> str:
    """The text outside dropped and hidden elements: blocks apart, white space as single spaces."""
    parts: list[str] = []
    stack: list[Node | str] = [root]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item.tag in HIDDEN or id(item) in dropped:
            parts.append(" ")
        else:
            edge = [" "] if item.tag in BLOCK else []
            stack += [*edge, *reversed(item.children), *edge]
    return SPACE.sub(" ", "".join(parts)).strip()
