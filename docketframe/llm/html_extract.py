"""Main text of pages by a tree-structured graphical model.

Every block element of a page is a node with a hidden label: does its part of the tree hold main content? A node's
potential comes from its tag, names, text and links; each parent and child share a potential by the kind of child.
Sum-product messages go up the tree and down again and give each node's marginal. A text block is main text if its node's
marginal is at least one half. All potentials are trained together, by gradient steps on the likelihood of labelled pages
(``labelled_pages``), with the same messages.

White space inside a block becomes one space; blocks are joined in page order by a line end. A null html counts as empty
and gives an empty text. An element whose text is no text of the page (script, head, button and the like) silences nothing
if it has no end tag, and is over where a block starts that it cannot hold. Unclosed and misplaced tags follow the usual rules for paragraphs, list items and cells; the tree
of a page of any length is kept whole. Every row is judged by itself, so empty tables, repeated rows and other columns
change nothing.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from math import exp

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe.llm.labelled_pages import labelled_pages

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: No text of a page.
SILENT = frozenset("script style noscript template head title iframe svg select button textarea".split())
#: Silent elements that a block ends.
BLOCKLESS = ("button", "select", "svg", "textarea", "title")
#: Inline elements whose blocks are apart from those around them.
SCOPES = frozenset({"object"})
BOUNDS, CLOSING = BLOCKS | SCOPES, BLOCKS | SILENT | SCOPES
#: Open elements that the start of an element ends, up to the nearest of its bounds.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
KINDS = {
    **dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), 1),
    **dict.fromkeys("p blockquote pre".split(), 2),
    **dict.fromkeys("ul ol li dl dt dd menu".split(), 3),
    **dict.fromkeys("article main".split(), 4),
    **dict.fromkeys("nav aside footer header form".split(), 5),
    **dict.fromkeys("table tbody thead tr td th".split(), 6),
}
N_KINDS = 7
_NAMES = re.compile(r"[a-z]+")
_SILENT_END = re.compile(rf"(?i)</({'|'.join(sorted(SILENT))})(?=[\s/>])")


@dataclass
class Node:
    tag: str
    parent: int
    names: tuple[str, ...]
    mark: str | None
    chars: int = 0
    link_chars: int = 0
    stops: int = 0
    copyright: bool = False
    children: list[int] = field(default_factory=list)


class Tree(HTMLParser):
    """The block elements of a page in page order, parents first, and its text blocks as (node, text)."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("html", -1, (), None)]
        self.blocks: list[tuple[int, str]] = []
        self.open: list[tuple[str, int]] = [("html", 0)]
        self.silent, self.links, self.buffer = 0, 0, []
        #: Depths of the open elements of a name, and of those whose blocks are apart from others.
        self.depths: dict[str, list[int]] = defaultdict(list)
        self.bounds: list[int] = []
        #: End tags to come: a silent element without one would silence all the rest.
        self.ends = Counter(tag.lower() for tag in _SILENT_END.findall(html))
        self.feed(html)
        self.close()
        self.end_block()

    def end_block(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer.clear()
            if text:
                at = self.open[-1][1]
                node = self.nodes[at]
                node.chars += len(text)
                node.stops += text.count(". ") + text.endswith((".", "!", "?"))
                node.copyright |= "©" in text[:200]
                self.blocks.append((at, text))

    def pop_to(self, depth: int) -> None:
        """Closes the elements at ``depth`` and above."""
        if any(tag in BLOCKS for tag, _ in self.open[depth:]):
            self.end_block()
        for tag, _ in self.open[depth:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
            self.depths[tag].pop()
        del self.open[depth:]
        while self.bounds and self.bounds[-1] >= depth:
            self.bounds.pop()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A marked section of any name is no text; it ends at its bracket, or at the next tag's end."""
        end = self.rawdata.find("]>", i + 3)
        end = end + 2 if end >= 0 else self.rawdata.find(">", i + 3) + 1
        return end if end > 0 else len(self.rawdata)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        block = tag in BLOCKS
        if block:
            for name in BLOCKLESS if self.silent else ():  # it cannot hold a block, so its end tag is another's
                if self.depths[name]:
                    self.ends[name] += len(self.depths[name])
                    self.pop_to(self.depths[name][0])
            if tag in ENDS:
                ended, bounds = ENDS[tag]
                for depth in reversed(self.bounds[:]):
                    if self.open[depth][0] in bounds:
                        break
                    if self.open[depth][0] in ended:
                        self.pop_to(depth)
            while self.bounds and self.open[self.bounds[-1]][0] == "p":  # a block ends an open paragraph, unless another block holds it
                self.pop_to(self.bounds[-1])
            self.end_block()
        elif tag == "br":
            self.buffer.append(" ")
        if tag in VOID:
            return
        if tag in SILENT:
            if not self.ends[tag]:
                return
            self.ends[tag] -= 1
        at = self.open[-1][1]
        if block and not self.silent:
            given = dict(attrs)
            named = " ".join(given.get(key) or "" for key in ("class", "id", "role", "itemprop", "aria-label"))
            hidden = ("hidden",) if "hidden" in given or "display:none" in (given.get("style") or "").replace(" ", "") else ()
            self.nodes.append(Node(tag, at, tuple(dict.fromkeys(_NAMES.findall(named.lower()))) + hidden, given.get("x")))
            self.nodes[at].children.append(len(self.nodes) - 1)
            at = len(self.nodes) - 1
        self.depths[tag].append(len(self.open))
        if tag in BOUNDS:
            self.bounds.append(len(self.open))
        self.open.append((tag, at))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if not self.depths[tag]:
            return
        depth = self.depths[tag][-1]
        if tag in CLOSING or not any(self.open[bound][0] in BLOCKS for bound in self.bounds[bisect_right(self.bounds, depth) :]):
            self.pop_to(depth)  # an inline end tag closes no block

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        self.buffer.append(data)
        if self.links:
            self.nodes[self.open[-1][1]].link_chars += len(data.strip())


def features(tree: Tree) -> list[list[str]]:
    """The features of each node."""
    nodes = tree.nodes
    chars, links, stops = ([getattr(node, name) for node in nodes] for name in ("chars", "link_chars", "stops"))
    for at in range(len(nodes) - 1, 0, -1):
        parent = nodes[at].parent
        chars[parent] += chars[at]
        links[parent] += links[at]
        stops[parent] += stops[at]
    out = []
    for at, node in enumerate(nodes):
        density = min(3, int(4 * links[at] / chars[at])) if chars[at] else 4
        found = [
            "bias",
            f"tag {node.tag}",
            f"{'named' if node.names else 'bare'} {node.tag} in {nodes[node.parent].tag if at else ''}",
            f"long {chars[at].bit_length() // 2}",
            f"links {density}",
            f"own {min(node.chars, 1) + min(node.chars // 100, 1)}",
            f"stops {min(stops[at], 3)}",
        ]
        found += [f"name {name}" for name in node.names]
        if node.copyright:
            found.append("copyright")
        out.append(found)
    return out


class Model:
    """Weights of the features, and a potential for each (kind of child, parent's label, child's label)."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.pairs = [[[1.0, 1.0], [1.0, 1.0]] for _ in range(N_KINDS)]

    def marginals(self, tree: Tree, found: list[list[str]]) -> tuple[list[float], list[tuple[float, float, float, float]]]:
        """P(content) of each node, and for each node the joint with its parent: (0,0), (0,1), (1,0), (1,1)."""
        nodes, weights = tree.nodes, self.weights
        own0, own1 = [1.0] * len(nodes), []
        for names in found:
            score = sum(weights.get(name, 0.0) for name in names)
            own1.append(exp(min(max(score, -30.0), 30.0)))
        up: list[tuple[float, float]] = [(1.0, 1.0)] * len(nodes)
        for at in range(len(nodes) - 1, 0, -1):  # upward: what a node's part of the tree says about its parent
            pair, a, b = self.pairs[KINDS.get(nodes[at].tag, 0)], own0[at], own1[at]
            m0, m1 = pair[0][0] * a + pair[0][1] * b, pair[1][0] * a + pair[1][1] * b
            total = m0 + m1
            up[at] = m0, m1 = m0 / total, m1 / total
            parent = nodes[at].parent
            a, b = own0[parent] * m0, own1[parent] * m1
            total = a + b
            own0[parent], own1[parent] = a / total, b / total
        joint: list[tuple[float, float, float, float]] = [(0.0, 0.0, 0.0, 0.0)] * len(nodes)
        total = own0[0] + own1[0]
        out = [own1[0] / total]
        for at in range(1, len(nodes)):  # downward: the parent's marginal without this child's own message
            p1 = out[nodes[at].parent]
            r0, r1 = (1 - p1) / max(up[at][0], 1e-300), p1 / max(up[at][1], 1e-300)
            pair, a, b = self.pairs[KINDS.get(nodes[at].tag, 0)], own0[at], own1[at]
            j00, j01, j10, j11 = r0 * pair[0][0] * a, r0 * pair[0][1] * b, r1 * pair[1][0] * a, r1 * pair[1][1] * b
            total = j00 + j01 + j10 + j11
            joint[at] = (j00 / total, j01 / total, j10 / total, j11 / total)
            out.append(joint[at][1] + joint[at][3])
        return out, joint

    def extract(self, html: str) -> str:
        tree = Tree(html)
        if not tree.blocks:
            return ""
        content, _ = self.marginals(tree, features(tree))
        return "\n".join(text for at, text in tree.blocks if content[at] >= 0.5)


def labels(tree: Tree) -> list[int]:
    """1 for nodes whose part of the tree holds content, by the marks of a labelled page."""
    marks: list[bool] = []
    for node in tree.nodes:
        marks.append(node.mark == "1" if node.mark is not None else node.parent >= 0 and marks[node.parent])
    out = [int(mark and node.chars > 0) for mark, node in zip(marks, tree.nodes, strict=True)]
    for at in range(len(out) - 1, 0, -1):
        out[tree.nodes[at].parent] |= out[at]
    return out


def trained(rounds: int = 60, step: float = 0.25, decay: float = 2e-3) -> Model:
    """A model fitted to the labelled pages by steps along the gradient of their likelihood, scaled feature by feature."""
    model = Model()
    pages = []
    for html in labelled_pages():
        tree = Tree(html)
        pages.append((tree, features(tree), labels(tree)))
    scores = [[[0.0, 0.0], [0.0, 0.0]] for _ in range(N_KINDS)]
    size: dict = {}
    for _ in range(rounds):
        slope: dict = {}
        for tree, found, wanted in pages:
            content, joint = model.marginals(tree, found)
            for at, names in enumerate(found):
                miss = wanted[at] - content[at]
                for name in names:
                    slope[name] = slope.get(name, 0.0) + miss
                if at:
                    kind, truth = KINDS.get(tree.nodes[at].tag, 0), 2 * wanted[tree.nodes[at].parent] + wanted[at]
                    for cell in range(4):
                        key = (kind, cell >> 1, cell & 1)
                        slope[key] = slope.get(key, 0.0) + (cell == truth) - joint[at][cell]
        for key, value in slope.items():
            held = model.weights.get(key, 0.0) if isinstance(key, str) else scores[key[0]][key[1]][key[2]]
            value = value - decay * len(pages) * held
            size[key] = size.get(key, 0.0) + value * value
            moved = held + step * value / (size[key] ** 0.5 + 1e-9)
            if isinstance(key, str):
                model.weights[key] = moved
            else:
                scores[key[0]][key[1]][key[2]] = moved
        model.pairs = [[[exp(value) for value in row] for row in kind] for kind in scores]
    return model


def extract_pages(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    model = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.extract(html.as_py() or "") for html in batch["html"]]
            lengths = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), lengths], names=["page_id", "url", "text", "n_chars"])

    schema = "page_id long, url string, text string, n_chars long"
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(run, schema)
