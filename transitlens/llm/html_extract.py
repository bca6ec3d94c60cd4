"""Main text of web pages by a tree-structured graphical model (operator 8).

The DOM's block elements and their runs of text are the nodes of a tree. A
node is *content* (1) if it belongs to the main text or holds some of it. Each
node has a unary potential (logistic weights over its tag, class words, text
and links), each parent-child edge a 2 x 2 potential. Sum-product messages,
upward then downward, give every node's exact marginal; the text runs whose
marginal is over one half are the main text.

The model is trained from labelled pages: the pages of ``html_pages`` and,
optionally, a bounded sample of pages labelled by their own ``article`` or
``main`` element. Class-word and tag lists enter as features with prior
weights, so words that no labelled page has still count.

Text rules: character references are decoded, white space inside a block
becomes one space, blocks are joined by ``\\n`` in page order. Defined
cases: null or empty html gives the empty text; a page without markup is
content; unclosed and stray tags are tolerated; repeated rows are handled one
by one; ids and urls may be null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .html_pages import PAGES
from .storage import read

SAMPLE = 200            # pages of the table that are labelled by their own markup, at most

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Formulas are text; noscript and object hold what stands in for a script or file, as part of what is around them.
FORMULA = frozenset("math mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup "
                    "mtable mtd mtext mtr munder munderover semantics merror".split())
INLINE = FORMULA | frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark noscript object q rp rt ruby s samp "
                             "small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style template svg iframe audio video canvas annotation annotation-xml".split())
HIDDEN = frozenset("head title meta link base".split())
#: A start tag of the first kind ends an open element of the second kinds.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
FURNITURE_TAGS = frozenset("nav header footer aside form button select option menu dialog label input fieldset textarea".split())
FURNITURE = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|sponsor\w*|banner|promo\w*|side-?bar|nav\w*|menu|footer\w*|(?:page|site)-?foot|header|masthead|"
                       r"comments?|respond|cookies?|consent|notice|popup|modal|share|sharing|social|related(?![-_ ]?works?)|recommend(?:ed)?|newsletter|subscribe|"
                       r"breadcrumbs?|widget|login|pagination|toolbar)(?:[^a-z]|$)")
WHOLE = 0.6             # a part with this share of the text that also has a title is the page's frame, whatever it is called
MAIN = 0.25             # share of the text outside of furniture that an article element needs to be the main one
CONTENT = re.compile(r"(?:^|[^a-z])(?:content|article\w*|post|entry|story|main|text|body)(?:[^a-z]|$)")
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*'|["'])*)>""", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

FEATURES = ["bias", "content_tag", "furniture_tag", "furniture_words", "content_words", "paragraph", "heading", "list", "table",
            "links", "length", "sentence", "textless", "role", "run", "outside", "root"]
PRIOR = {"content_tag": 6.0, "furniture_tag": -14.0, "furniture_words": -14.0, "content_words": 4.0, "role": -14.0, "links": -2.0,
         "outside": -20.0, "paragraph": 0.5}


class Node:
    __slots__ = ("tag", "attrs", "parent", "text", "linked", "y", "run")

    def __init__(self, tag, attrs, parent, run=False):
        self.tag, self.attrs, self.parent, self.run = tag, attrs, parent, run
        self.text, self.linked, self.y = "", 0, None


def dom(page: str) -> list[Node]:
    """Nodes in page order, parents first: block elements and runs of text."""
    nodes = [Node("#root", {}, -1)]
    stack: list[tuple[str, int]] = [("#root", 0)]        # open elements; inline ones have their block's node
    run: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            n = Node("#text", {}, stack[-1][1], True)
            n.text, n.linked = text, min(linked, len(text))
            nodes.append(n)
        linked = 0

    def take(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw)
            run.append(text)
            if links:
                linked += len(text)

    def close(i: int) -> None:
        """Closes the open elements from place i on."""
        nonlocal links
        flush() if any(t not in INLINE for t, _ in stack[i:]) else None
        links -= sum(t == "a" for t, _ in stack[i:])
        del stack[i:]

    while True:
        m = _TOKEN.search(page, at)
        take(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            i = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            # an inline end tag does not close blocks
            if i and (tag not in INLINE or all(t in INLINE for t, _ in stack[i:])):
                close(i)
            continue
        if tag in RAW or tag in ("title", "textarea"):
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at) if not m[3].endswith("/") else None
            body = page[at:end.start()] if end else ""
            if end:
                at = page.find(">", end.start()) + 1 or len(page)
            elif not m[3].endswith("/") and tag in ("script", "style", "title", "textarea"):
                at = len(page)
            if tag == "textarea":
                flush()
                nodes.append(Node(tag, {}, stack[-1][1]))
            continue
        if tag in INLINE:
            if tag in ("br", "wbr"):
                run.append(" " if tag == "br" else "")
            elif tag not in VOID:
                links += tag == "a"
                stack.append((tag, stack[-1][1]))
            continue
        attrs = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTR.findall(m[3])} if m[3].strip() else {}
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        # block elements end an open paragraph; list items and the like end their own kind
        for i in range(len(stack) - 1, 0, -1):
            t = stack[i][0]
            if t == "p":
                close(i)
                break
            if t not in INLINE:
                break
        if tag in ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in STOPS[tag]:
                    break
                if stack[i][0] in ENDS[tag]:
                    close(i)
                    break
        flush()
        nodes.append(Node(tag, attrs, stack[-1][1]))
        if not m[3].endswith("/"):
            stack.append((tag, len(nodes) - 1))
    flush()
    return nodes


def _named(n: Node) -> str:
    return f"{n.attrs.get('class') or ''} {n.attrs.get('id') or ''}".lower() if n.attrs else ""


def _heading(n: Node) -> bool:
    return len(n.tag) == 2 and n.tag[0] == "h" and n.tag[1].isdigit()


def _hidden(n: Node) -> bool:
    return (n.attrs.get("role") or "").lower() in ROLES or "hidden" in n.attrs or n.attrs.get("aria-hidden") == "true"


class Layout:
    """What a page's markup says: sizes, furniture by tag and by name, and its main elements.

    A part that has most of the text and a title (h1, article or main) is the frame of the page: a form around all,
    or a class that only mentions a sidebar, does not make it furniture. An article or main element is a main one if neither it nor
    what it is in is furniture, and it holds a good share of the other text: comments and teasers may be articles too.
    """

    def __init__(self, nodes: list[Node]):
        n = len(nodes)
        self.size, self.linked = [len(x.text) for x in nodes], [x.linked for x in nodes]
        titled = [x.tag in ("h1", "article", "main") for x in nodes]
        for i in range(n - 1, 0, -1):
            p = nodes[i].parent
            self.size[p] += self.size[i]
            self.linked[p] += self.linked[i]
            titled[p] = titled[p] or titled[i]
        self.by_tag, self.by_name, self.by_role, within = [False] * n, [False] * n, [False] * n, [False] * n
        for i, x in enumerate(nodes):
            if not x.run and not (titled[i] and self.size[i] > WHOLE * self.size[0]):
                names = "" if _heading(x) else _named(x)
                self.by_tag[i], self.by_name[i], self.by_role[i] = x.tag in FURNITURE_TAGS, bool(names) and bool(FURNITURE.search(names)), _hidden(x)
            within[i] = self.by_tag[i] or self.by_name[i] or self.by_role[i] or (x.parent >= 0 and within[x.parent])
        self.within = within
        rest = sum(len(x.text) for x, w in zip(nodes, within) if not w)
        self.main = [x.tag in ("article", "main") and not w and self.size[i] > 0 and self.size[i] >= MAIN * rest
                     for i, (x, w) in enumerate(zip(nodes, within))]


def features(nodes: list[Node]) -> np.ndarray:
    """A row of FEATURES for every node."""
    x = np.zeros((len(nodes), len(FEATURES)))
    col = {f: i for i, f in enumerate(FEATURES)}
    page = Layout(nodes)
    size, linked = page.size, page.linked
    inside = [False] * len(nodes)                        # in a main element
    holds = list(page.main)
    for i, n in enumerate(nodes):
        inside[i] = page.main[i] or (n.parent >= 0 and inside[n.parent])
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] = holds[nodes[i].parent] or holds[i]
    for i, n in enumerate(nodes):
        row = x[i]
        row[0] = 1
        row[col["links"]] = linked[i] / size[i] if size[i] else 0
        row[col["length"]] = math.log1p(size[i]) / 5
        row[col["textless"]] = size[i] == 0
        row[col["outside"]] = holds[0] and not holds[i] and not inside[i]
        if n.run:
            row[col["run"]] = 1
            row[col["sentence"]] = n.text[-1] in ".!?…。"
            continue
        names = _named(n)
        row[col["content_tag"]] = n.tag in ("article", "main")
        row[col["furniture_tag"]] = page.by_tag[i]
        row[col["furniture_words"]] = page.by_name[i]
        row[col["content_words"]] = bool(names) and bool(CONTENT.search(names))
        row[col["paragraph"]] = n.tag in ("p", "blockquote", "pre")
        row[col["heading"]] = _heading(n)
        row[col["list"]] = n.tag in ("ul", "ol", "li", "dl", "dt", "dd")
        row[col["table"]] = n.tag in ("table", "tbody", "thead", "tr", "td", "th")
        row[col["role"]] = page.by_role[i]
        row[col["root"]] = n.tag in ("#root", "html", "body")
    return x


def labelled(page: str, own: bool = False) -> tuple[list[Node], np.ndarray] | None:
    """(nodes, labels) of a labelled page. ``own``: by the page's own article or main element and furniture in it."""
    nodes = dom(page)
    y = np.zeros(len(nodes), np.int8)
    page_layout = Layout(nodes) if own else None
    for i, n in enumerate(nodes):
        up = nodes[n.parent] if n.parent >= 0 else None
        if own:
            y[i] = not page_layout.within[i] and (page_layout.main[i] or (up is not None and y[n.parent] == 1))
        else:
            y[i] = "data-y" in n.attrs or (up is not None and "data-y" in up.attrs)
    for i in range(len(nodes) - 1, 0, -1):
        y[nodes[i].parent] |= y[i]
    return (nodes, y) if y.any() else None


class Model:
    """Unary weights and the edge potential (log, parent label x child label)."""

    def __init__(self, weights: np.ndarray, edge: np.ndarray):
        self.weights, self.edge = weights, edge

    @classmethod
    def train(cls, pages: list[tuple[list[Node], np.ndarray]], penalty: float = 0.02, rounds: int = 400) -> "Model":
        x = np.concatenate([features(n) for n, _ in pages])
        y = np.concatenate([l for _, l in pages]).astype(float)
        weight = np.concatenate([np.full(len(l), 1 / len(l)) for _, l in pages]) / len(pages)     # pages count alike
        prior = np.array([PRIOR.get(f, 0.0) for f in FEATURES])
        w, step = prior.copy(), np.zeros(len(prior))
        for _ in range(rounds):                          # gradient with momentum; the prior pulls towards its weights
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = 0.9 * step - 0.5 * (x.T @ (weight * (p - y)) + penalty * (w - prior))
            w = w + step
        count = np.array([[20.0, 0.0002], [2.0, 4.0]])     # furniture holds no content
        for n, l in pages:
            for i in range(1, len(n)):
                count[l[n[i].parent], l[i]] += 1 / len(n)
        edge = np.log(count / count.sum(1, keepdims=True)) - np.log(count.sum(0) / count.sum())
        return cls(w, edge)

    def marginals(self, nodes: list[Node]) -> np.ndarray:
        """P(content) of every node, by messages upward and downward."""
        score = features(nodes) @ self.weights
        e = self.edge
        n = len(nodes)
        up = [(0.0, float(s)) for s in score]            # log belief of the subtree, by the node's label
        sent = [(0.0, 0.0)] * n
        lse = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
        e00, e01, e10, e11 = (float(v) for v in e.ravel())
        for i in range(n - 1, 0, -1):
            a, b = up[i]
            m = sent[i] = (lse(e00 + a, e01 + b), lse(e10 + a, e11 + b))
            p = nodes[i].parent
            up[p] = (up[p][0] + m[0], up[p][1] + m[1])
        full = list(up)
        for i in range(1, n):
            p = nodes[i].parent
            a, b = full[p][0] - sent[i][0], full[p][1] - sent[i][1]      # the parent without this child
            top = max(a, b)
            a, b = a - top, b - top
            full[i] = (up[i][0] + lse(e00 + a, e10 + b), up[i][1] + lse(e01 + a, e11 + b))
        return np.array([1 / (1 + math.exp(min(700.0, max(-700.0, a - b)))) for a, b in full])

    def text(self, page: str | None) -> str:
        nodes = dom(page or "")
        p = self.marginals(nodes)
        return "\n".join(n.text for n, q in zip(nodes, p) if n.run and q > 0.5)


def _least(pages: DataFrame, n: int, id_col: str, html_col: str) -> list[str]:
    """The n pages of least id hash. Only pages under a bound that some 4 * n of them are expected to meet are sorted, so
    that tasks send the driver few rows however many tasks there are; all pages, should the bound have kept too few."""
    rows, key = pages.filter(F.col(html_col).isNotNull()), F.xxhash64(id_col)
    share = 4 * n / max(1, pages.count())
    bounds = [F.lit(True)] if share >= 1 else [key < F.lit(int(-(1 << 63) + share * (1 << 64))), F.lit(True)]
    for bound in bounds:
        found = rows.filter(bound).orderBy(key, F.length(html_col)).limit(n).select(html_col).collect()
        if len(found) == n:
            break
    return [r[0] for r in found]


def trained(pages: DataFrame | None = None, sample: int = SAMPLE, id_col: str = "page_id", html_col: str = "html") -> Model:
    """The model from the labelled pages, and at most ``sample`` pages of the table (those of least id hash) with own labels."""
    given = [labelled(p) for p in PAGES]
    if pages is not None and sample:
        given += [labelled(t, own=True) for t in _least(pages, sample, id_col, html_col)]
    return Model.train([g for g in given if g])


def extracted(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """(page_id, url, text): every row's main text, in one pass without a shuffle."""
    model = model or trained(pages, id_col=id_col, html_col=html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                texts = [model.text(v.as_py()) for v in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 names=["page_id", "url", "text"])

    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return src.mapInArrow(run, "page_id bigint, url string, text string")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
