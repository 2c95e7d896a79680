"""Main text of web pages by a tree-structured graphical model.

A page's elements and text runs are the nodes of a tree; each is content or
not.  A node's emission is the likelihood of its features (tag, words of
class, id and role, length, links, sentence marks), a parent-child potential
says how likely a child of some kind is content given its parent.  Sum-product
messages go up from the leaves and down from the root; a text run whose
marginal is a half or more belongs to the text.

The potentials are counted on labelled pages: layouts labelled by hand below
(elements marked keep or drop), and a bounded sample of the given pages that
label themselves by article or main elements.

Blocks are what block elements bound; white space inside one becomes one
space, blocks are joined by a line end.  Scripts, styles, titles, drawings,
comments and markup are never text; formulas are, in their line.  Controls,
templates and embedded objects are elements like others, which the model keeps
or drops.

Defined results: null or empty html has an empty text, as has a page without
content; markup that is not closed is closed as browsers do for paragraphs,
items and cells; repeated rows are each extracted; other columns stay, those
named like an output are replaced; an empty table trains on the layouts."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.llm.common import bounded_batches, table

#: Pages of the training sample, at most.
SAMPLE_PAGES = 200
#: Longer pages are not trained on (all are extracted).
SAMPLE_CHARS = 200_000
#: How often each hand-labelled layout counts.
LAYOUT_WEIGHT = 10

# Element names of the markup language.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Content is not markup: skipped up to the end tag, or the page's end.
RAW = {"script", "style", "title", "textarea"}
#: Skipped up to the end tag; without one, or closed by "/>", only the tag is.
SKIPPED = {"iframe", "noframes", "xmp", "svg", "annotation", "annotation-xml"}
#: Formulas: their text stays in the line.
FORMULA = {"math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mprescripts", "mstyle", "mpadded", "mphantom", "menclose", "merror", "mtable", "mtr", "mtd"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "button", "svg", "iframe"} | FORMULA | {"annotation", "annotation-xml"}
ENDS_PARAGRAPH = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "ul"}
#: A start tag on the left closes an open element on the right, up to the bound.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(class|id|role|aria-label|data-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    words: tuple[str, ...] = ()
    mark: str = ""
    text: str = ""
    block: int = 0
    length: int = 0
    linked: int = 0
    stops: int = 0
    features: list[str] = field(default_factory=list)


def parse(page: str | None) -> list[Node]:
    """Nodes in page order, parents first; text runs have the tag #text."""
    nodes = [Node("#root", -1)]
    if not page:
        return nodes
    open_, block, at, size = [0], 0, 0, len(page)

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            nodes.append(Node("#text", open_[-1], text=html.unescape(raw) if "&" in raw else raw, block=block))
        elif raw and len(nodes) > 1:
            nodes.append(Node("#space", open_[-1], text=" ", block=block))

    def close(tags: set[str], bounds: set[str]) -> None:
        nonlocal block
        for k in range(len(open_) - 1, 0, -1):
            tag = nodes[open_[k]].tag
            if tag in tags:
                block += any(nodes[i].tag not in INLINE for i in open_[k:])
                del open_[k:]
                return
            if tag in bounds:
                return

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        m = _TOKEN.match(page, lt)
        if not m:
            nxt = page.find("<", lt + 1)
            text(page[at : nxt if nxt > 0 else size])
            at = nxt if nxt > 0 else size
            continue
        if lt > at:
            text(page[at:lt])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                text(" ")
            elif tag == "p" and all(nodes[i].tag != "p" for i in open_):
                block += 1
            else:
                close({tag}, set() if tag in ENDS_PARAGRAPH | {"body", "html"} else {"table", "td", "th"} if tag in INLINE else set())
            continue
        if tag == "br" or tag == "wbr":
            text(" " if tag == "br" else "")
            continue
        if tag in ENDS_PARAGRAPH:
            close({"select"}, {"form", "td", "th", "table", "div", "article", "section", "body"})
            close({"p"}, {"button", "td", "th", "table", "div", "article", "section", "body"} - {tag})
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag not in INLINE:
            block += 1
        if tag in VOID:
            continue
        words, mark = [], ""
        if m[3]:
            for name, value in _NAMES.findall(m[3]):
                if name.lower() == "data-label":
                    mark = value.strip("\"'")
                else:
                    words += _WORD.findall(re.sub("([a-z])([A-Z])", r"\1 \2", value).lower())
        if tag in RAW or tag in SKIPPED:
            closed = tag in SKIPPED and m[3].endswith("/")
            end = None if closed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size if tag in RAW else at
            continue
        nodes.append(Node(tag, open_[-1], tuple(dict.fromkeys(words)), mark, block=block))
        if not m[3].endswith("/") or (tag in INLINE and tag not in FORMULA) or tag in ENDS_PARAGRAPH:
            open_.append(len(nodes) - 1)
    return nodes


def _bin(n: float) -> int:
    return int(math.log2(n + 1))


def describe(nodes: list[Node]) -> None:
    """Fill in features; lengths, links and sentence ends are summed upwards."""
    for n in nodes:
        if n.tag == "#text":
            n.length, n.stops = len(n.text), len(re.findall(r"[.!?,;](?:\s|\Z)", n.text))
    for n in reversed(nodes):
        if n.parent >= 0:
            up = nodes[n.parent]
            up.length, up.stops = up.length + n.length, up.stops + n.stops
            up.linked += n.length if n.tag == "a" else n.linked
    for n in nodes:
        n.features = [f"tag {n.tag}", *(f"word {w}" for w in n.words)]
        # Text runs and inline elements follow the block that they are in.
        if n.tag != "#root" and kind(n) == "block":
            n.features += [f"length {min(_bin(n.length) // 3, 3)}", f"stops {min(_bin(n.stops), 2)}", f"links {round(4 * n.linked / n.length) if n.length else 0}"]


def kind(n: Node) -> str:
    return "text" if n.tag in ("#text", "#space") else "inline" if n.tag in INLINE else "block"


@dataclass
class Model:
    """Log ratios of emissions, and log potentials by kind, parent and child."""

    emission: dict[str, float]
    potential: dict[str, list[list[float]]]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content of each node, by sum-product in the tree."""
        own = [[0.0, sum(self.emission.get(f, 0.0) for f in n.features)] for n in nodes]
        up: list[tuple[float, float]] = [(0.0, 0.0)] * len(nodes)
        pots = [self.potential[kind(n)] for n in nodes]
        for i in range(len(nodes) - 1, 0, -1):
            (a, b), p = own[i], pots[i]
            up[i] = (_add(p[0][0] + a, p[0][1] + b), _add(p[1][0] + a, p[1][1] + b))
            above = own[nodes[i].parent]
            above[0] += up[i][0]
            above[1] += up[i][1]
        # own now has all that comes from below; add what comes from above.
        belief = own
        belief[0][1] += -20.0  # the root holds everything
        out = [0.0] * len(nodes)
        for i in range(1, len(nodes)):
            above, p = belief[nodes[i].parent], pots[i]
            x, y = above[0] - up[i][0], above[1] - up[i][1]
            belief[i][0] += _add(p[0][0] + x, p[1][0] + y)
            belief[i][1] += _add(p[0][1] + x, p[1][1] + y)
            d = belief[i][0] - belief[i][1]
            out[i] = 1 / (1 + math.exp(d)) if d < 700 else 0.0
        return out


def _add(x: float, y: float) -> float:
    """log(exp(x) + exp(y))"""
    if x < y:
        x, y = y, x
    d = y - x
    return x if d < -36 else x + math.log1p(math.exp(d))


def main_text(page: str | None, model: Model) -> str:
    nodes = parse(page)
    if len(nodes) == 1:
        return ""
    describe(nodes)
    p = model.marginals(nodes)
    blocks: list[list[str]] = []
    last = None
    for n, x in zip(nodes, p, strict=True):
        if n.tag == "#space" and last == n.block:
            blocks[-1].append(" ")
        elif n.tag == "#text" and x >= 0.5:
            if last != n.block:
                blocks.append([])
                last = n.block
            blocks[-1].append(n.text)
    return "\n".join(t for b in blocks if (t := " ".join("".join(b).split())))


# Labelled layouts.  data-label is read by the trainer only; an element
# without one has its parent's.  P stands for a paragraph, S for a few words.
LAYOUTS = [
    """<html><head><title>S</title></head><body><header class="site-header"><a href="/">S</a><nav class="main-nav menu"><ul><li><a>S</a></li><li><a>S</a></li><li><a>S</a></li></ul></nav></header><main id="content"><article data-label="keep"><h1>S</h1><p>P</p><p>P <a>S</a> P</p><aside class="sidebar related" data-label="drop"><h3>S</h3><ul><li><a>S</a></li><li><a>S</a></li></ul></aside><h2>S</h2><p>P</p><ul><li>P</li><li>P</li></ul></article></main><footer class="footer"><p>S</p><a>S</a></footer></body></html>""",
    """<body><div id="top" class="header banner"><span>S</span></div><div class="cookie notice"><p>P</p><button>S</button></div><div id="main" class="content"><div class="post entry article-body" data-label="keep"><h2>S</h2><p>P</p><div class="ad advert sponsor" data-label="drop"><p>P</p><a>S</a></div><p>P</p><ul><li>S</li><li>P</li><li>S</li></ul><blockquote><p>P</p></blockquote><p>S</p></div><div class="comments" id="comments"><h3>S</h3><div class="comment reply"><b>S</b><p>P</p></div><div class="comment"><p>P</p></div><form class="comment-form"><label>S</label><p>S</p></form></div></div><div class="footer copyright">S</div></body>""",
    """<body><nav class="breadcrumb"><a>S</a><a>S</a></nav><section class="article" data-label="keep"><h1>S</h1><p><b>S</b> P</p><p>P</p><p>S</p><ul><li>S</li><li>S</li></ul><table><tr><th>S</th><td>S</td></tr><tr><td>S</td><td>P</td></tr></table><pre>P</pre><div class="share social" data-label="drop"><a>S</a><a>S</a></div><section class="comments" data-label="drop"><p>P</p><p>P</p></section></section><aside id="sidebar" class="widget"><p>P</p><a>S</a></aside><div class="newsletter subscribe"><form><p>P</p><button>S</button></form></div><footer><p>P</p></footer></body>""",
    """<body><div class="ad">P</div><article data-label="keep"><h1>S</h1><p>P</p><p>S</p><p><i>P</i></p><ol><li>S</li><li>S</li><li>P</li></ol><dl><dt>S</dt><dd>P</dd></dl><figure><figcaption>S</figcaption></figure><div>P</div><div class="ads banner" data-label="drop">P</div><nav data-label="drop"><a>S</a></nav><form data-label="drop"><p>S</p><label>S</label><select><option>S</option><option>S</option></select></form><template data-label="drop"><p>S</p></template><footer data-label="drop"><p>S</p></footer></article><div id="related" class="promo"><h3>S</h3><p>P</p><a>S</a></div><div class="pagination"><a>S</a><a>S</a></div></body>""",
    """<body><div class="menu navbar"><ul><li>S</li><li>S</li></ul></div><div class="alert popup modal consent gdpr notice">P</div><div role="main" data-label="keep"><p>P</p><p>P</p><p>S</p><ol><li>P</li><li>S</li></ol></div><div role="complementary" class="side sidebar"><p>P</p></div><div role="contentinfo"><p>S</p></div><div class="login search"><form><p>S</p></form></div></body>""",
    """<body><header><h1>S</h1><p>S</p></header><div class="page wrapper container"><div class="text story body" data-label="keep"><p>P</p><p>P</p><h3>S</h3><ul><li><b>S</b></li><li>S</li><li>S</li><li>P</li></ul><p>P <em>S</em> P</p><p>P</p><div class="tags meta author byline" data-label="drop"><a>S</a></div></div><div class="disqus thread responses replies"><div class="user"><p>P</p></div><div class="user"><p>P</p></div></div></div><div class="legal disclaimer">P</div></body>""",
]
_SHORT = ("read more", "ten words or so", "home", "a note on this")
_LONG = "It was a long day, and the work had only begun. Nobody knew, of course, what would come next; they went on as before, one step at a time, until the light was gone and the road with it."


def labelled_layouts() -> list[tuple[list[Node], list[int]]]:
    out = []
    for k, layout in enumerate(LAYOUTS):
        for cut in (1, 3):
            page = re.sub(r"\bP\b", _LONG * cut, re.sub(r"\bS\b", _SHORT[k % 4], layout))
            nodes = parse(page)
            label = [0] * len(nodes)
            for i, n in enumerate(nodes[1:], 1):
                label[i] = {"keep": 1, "drop": 0}.get(n.mark, label[n.parent])
            out.append((nodes, label))
    return out


#: Elements by which a page labels itself.
_KEEP, _DROP = {"article", "main"}, {"nav", "aside", "header", "footer", "form", "menu"}


def self_labelled(page: str | None) -> tuple[list[Node], list[int]] | None:
    nodes = parse(page)
    if not any(n.tag in _KEEP for n in nodes):
        return None
    label = [0] * len(nodes)
    for i, n in enumerate(nodes[1:], 1):
        label[i] = 1 if n.tag in _KEEP else 0 if n.tag in _DROP else label[n.parent]
    return nodes, label


def train(pages: list[str | None]) -> Model:
    """Potentials counted on the layouts and on pages that label themselves."""
    emitted: list[Counter] = [Counter(), Counter()]
    total, moves = [0.0, 0.0], Counter()
    examples = [(x, LAYOUT_WEIGHT) for x in labelled_layouts()] + [(x, 1) for p in pages if (x := self_labelled(p))]
    for (nodes, label), weight in examples:
        describe(nodes)
        for i, n in enumerate(nodes[1:], 1):
            if n.tag == "#space":
                continue
            total[label[i]] += weight
            for f in n.features:
                emitted[label[i]][f] += weight
            moves[kind(n), label[n.parent], label[i]] += weight
    emission = {f: math.log((emitted[1][f] + 0.5) / (total[1] + 1)) - math.log((emitted[0][f] + 0.5) / (total[0] + 1)) for f in {*emitted[0], *emitted[1]}}
    potential = {}
    for k in ("text", "inline", "block"):
        potential[k] = []
        for s in (0, 1):
            n = [moves[k, s, 0] + 0.5, moves[k, s, 1] + 0.5]
            potential[k].append([math.log(x / sum(n)) for x in n])
    return Model(emission, potential)


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES, shorter_than: int = SAMPLE_CHARS) -> Model:
    """Train on at most ``sample`` pages (documented bounds): of those with
    fewer than ``shorter_than`` characters the ones whose hash is smallest."""
    source = pages.select(F.col(html_col).alias("html"), F.xxhash64(html_col).alias("hash")).where(F.length(html_col) < shorter_than)
    # Chosen by hash before pages move.
    chosen = source.select("hash").distinct().orderBy("hash").limit(sample)
    rows = source.join(F.broadcast(chosen), "hash").dropDuplicates(["hash"]).orderBy("hash").collect()
    return train([r.html for r in rows])


def extract(pages: DataFrame, model: Model, html_col: str = "html") -> DataFrame:
    """``pages`` with text and n_chars."""
    pages = pages.drop("text", "n_chars")
    shared, names = pages.sparkSession.sparkContext.broadcast(model), pages.columns
    at = names.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(x, shared.value) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], [*names, "text", "n_chars"])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    bounded_batches(spark)
    pages = table(spark, sf_dir, "pages")
    return extract(pages.select("page_id", "url", "html"), fit(pages)).drop("html")
