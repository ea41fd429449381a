"""Main text of web pages by belief propagation on the tree of elements.

Every element is content or boilerplate. The tree is a graphical model: each
element has a potential from what is seen of it (its tag, what its class, id
and role say, how much of its text is in links, how long its text is), and
each parent-child pair one that ties their labels, by the child's kind. One
sum-product pass from the leaves up and one from the root down give every
element's exact content marginal; the text directly inside elements with a
marginal of one half or more is the page's main text.

Potentials are log-ratios of counts over labelled pages, smoothed with
``PRIOR`` pseudo-counts that say what HTML itself says of an element; the
elements it reserves for boilerplate, and names such as ``sidebar``, count as
``CERTAIN``, whatever is inside. Without labels given, pages label themselves: where a page has one ``article`` (or
``main``) element, what is inside is content, but for navigation, asides,
forms and the like in it; ``TRAIN_PAGES`` such pages at most, taken by hash.
Half of them hide that element's tag, so that the other signs are learned for
pages that have no such element.

Parsing and inference see one page at a time, inside tasks.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.graph import saved

TRAIN_PAGES = 1000
#: Weight of what HTML says of an element against the counts, in elements.
PRIOR = 20.0
#: Log-ratio of what needs no learning; and the share of other evidence that counts, as signs of one element overlap.
CERTAIN, DAMPED = 60.0, 0.5

# The elements of HTML by their roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
NEVER = frozenset("script style head title noscript template iframe svg math canvas object audio video select option "
                  "button input textarea xmp noembed noframes".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset label".split())
CONTENT = frozenset("article main".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: An opening tag ends open elements of these names, up to the borders named.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
        "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
#: Words in class, id and role that name boilerplate or content.
BAD_WORDS = frozenset("ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
                      "navigation menu breadcrumb breadcrumbs sidebar side aside rail header masthead footer foot topbar toolbar "
                      "comment comments reply replies respond discussion disqus cookie cookies consent notice alert popup modal "
                      "overlay newsletter subscribe subscription signup login form search share sharing social related "
                      "recommended recommendation trending widget pagination pager copyright legal disclaimer gdpr "
                      "complementary contentinfo".split())
GOOD_WORDS = frozenset("article content entry post story main body text maincontent articlebody".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
    r"|<[a-zA-Z/][^>]*>|<[!?][^>]*(?:>|\Z)", re.DOTALL)
_OPEN_END = re.compile(r"<!--.*|<[!?][^>]*\Z", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?i)\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_HIDDEN = re.compile(r"(?i)(?:\s|^)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    tag: str
    parent: int
    rest: str = ""
    children: list[int] = field(default_factory=list)
    words: int = 0
    linked: int = 0
    holds: bool = False  # an element that is or is named content


def parse(page: str) -> tuple[list[Node], list[tuple[int, str | None]]]:
    """Elements in page order, the first one for the page itself, and (element, text) in page order.

    A text of None marks the border of a block. Missing and wrong end tags
    are handled as browsers do, in the main; nothing makes it fail.
    """
    nodes = [Node("#page", -1)]
    parts: list[tuple[int, str | None]] = []
    open_ = [0]
    places: dict[str, list[int]] = defaultdict(list)  # where in open_ the elements of a name are, ascending

    def end(upto: int) -> None:
        while len(open_) > upto:
            tag = nodes[open_.pop()].tag
            places[tag].pop()
            if tag not in INLINE:
                parts.append((open_[-1], None))

    def text(piece: str) -> None:
        if piece:
            parts.append((open_[-1], html.unescape(piece)))

    at, last = 0, page.rfind(">")
    while True:
        # beyond the last > there is no tag, only a comment or declaration that has no end
        m = _MARKUP.search(page, at) if at <= last else _OPEN_END.search(page, at)
        if m is None:
            break
        text(page[at:m.start()])
        at = m.end()
        name = m["name"] if m.re is _MARKUP else None
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            if places[name]:
                end(places[name][-1])
            elif name == "p":
                parts.append((open_[-1], None))
            continue
        if name in CLOSES_P and places["p"]:
            end(places["p"][-1])
        if name in ENDS:
            names, borders = ENDS[name]
            border = max((places[b][-1] for b in borders if places[b]), default=0)
            inside = [places[n][k] for n in names if (k := bisect_right(places[n], border)) < len(places[n])]
            if inside:
                end(min(inside))
        if name not in INLINE:
            parts.append((open_[-1], None))
        if name in VOID:
            continue
        nodes.append(Node(name, open_[-1], m["rest"] or ""))
        nodes[open_[-1]].children.append(len(nodes) - 1)
        places[name].append(len(open_))
        open_.append(len(nodes) - 1)
        if name in RAW:  # all up to its end tag is text
            stop = re.compile(rf"(?i)</{re.escape(name)}(?=[\s/>])[^>]*>").search(page, at)
            parts.append((open_[-1], html.unescape(page[at:stop.start() if stop else len(page)])))
            at = stop.end() if stop else len(page)
            end(len(open_) - 1)
    text(page[at:])
    end(1)
    return nodes, parts


def _named(rest: str) -> str:
    """What class, id and role say: good, bad, both or nothing."""
    if not rest:
        return "nothing"
    words = {w.lower() for value in _ATTRIBUTE.findall(rest) for w in _WORD.findall(value)}
    bad, good = bool(words & BAD_WORDS) or bool(_HIDDEN.search(rest)), bool(words & GOOD_WORDS)
    return "both" if bad and good else "bad" if bad else "good" if good else "nothing"


def _kind(tag: str) -> str:
    return ("never" if tag in NEVER else "boilerplate" if tag in BOILERPLATE else "content" if tag in CONTENT
            else "inline" if tag in INLINE else "block")


def measure(nodes: list[Node], parts: list[tuple[int, str | None]]) -> None:
    """Words in each element, and those in links, counting what is inside."""
    for node, piece in parts:
        if piece:
            nodes[node].words += len(piece.split())
    for n in range(len(nodes) - 1, 0, -1):
        node = nodes[n]
        if node.tag == "a":
            node.linked = node.words
        if node.tag not in NEVER:
            nodes[node.parent].words += node.words
            nodes[node.parent].linked += node.linked
            nodes[node.parent].holds |= node.holds or node.tag in CONTENT or _named(node.rest) == "good"


def _role(node: Node) -> str:
    """An element's kind, boilerplate if its names say so and it holds no content."""
    kind = _kind(node.tag)
    if kind in ("inline", "block") and node.tag not in ("html", "body") and _named(node.rest) == "bad" and not node.holds:
        return "boilerplate"
    return kind


def signs(node: Node) -> list[str]:
    """What is seen of an element: its tag, what its names say, its text. Inline ones go with their parents."""
    if _role(node) == "inline":
        return ["tag:inline"]
    share = "links" if 2 * node.linked > node.words else "text"
    size = min(4, int(math.log(node.words + 1, 4)))
    return [f"tag:{node.tag}", f"named:{_named(node.rest)}", f"text:{share}:{size}"]


def _suggested(sign: str) -> float:
    """The log-ratio, content to boilerplate, that HTML itself suggests."""
    if sign.startswith("tag:"):
        return 4.0 if _kind(sign[4:]) == "content" else 0.0
    return 2.0 if sign == "named:good" else 0.0


@dataclass
class Model:
    """``weights[sign]``: log-ratio of content; ``ties[kind]``: log p(child | parent), [parent][child]."""

    weights: dict[str, float]
    ties: dict[str, tuple[tuple[float, float], tuple[float, float]]]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Of content, for each element: sum-product up the tree, then down."""
        role = [_role(node) for node in nodes]
        own = [-CERTAIN if r in ("never", "boilerplate") else 0.0 if r == "inline" else DAMPED * sum(
            self.weights.get(s, _suggested(s)) for s in signs(node)) for r, node in zip(role, nodes, strict=True)]
        own[0] = 0.0
        # messages are log-ratios; up[n] is what n tells its parent
        inside = own[:]
        up = [0.0] * len(nodes)
        tie = [self.ties[_tied(role[node.parent], r)] for r, node in zip(role, nodes, strict=True)]

        def passed(t, x: float, down: bool) -> float:
            (a, b), (c, d) = t  # [label of the parent][label of the child]
            if down:
                b, c = c, b
            # log of sum over this end's labels, for the other end's label 1 over 0
            return _add(c, d + x) - _add(a, b + x)

        for n in range(len(nodes) - 1, 0, -1):  # children come after their parents
            up[n] = passed(tie[n], inside[n], False)
            inside[nodes[n].parent] += up[n]
        all_ = inside[:]
        for n in range(1, len(nodes)):
            rest = all_[nodes[n].parent] - up[n]
            all_[n] = inside[n] + passed(tie[n], rest, True)
        return [1 / (1 + math.exp(-max(-500.0, min(500.0, x)))) for x in all_]


_TIES = ("inside", "never", "boilerplate", "content", "inline", "block")


def _tied(parent: str, child: str) -> str:
    """Which potential ties a parent and a child: one for all inside boilerplate, else by the child's role."""
    return "inside" if parent in ("never", "boilerplate") else child


def _add(x: float, y: float) -> float:
    return max(x, y) + math.log1p(math.exp(-abs(x - y)))


def fit(counts: Counter) -> Model:
    """A model from counts of ("sign", sign, label), ("tie", kind, parent's label, child's label) and ("label", label)."""
    total = [counts[("label", y)] + 1.0 for y in (0, 1)]
    weights = {}
    for sign in {k[1] for k in counts if k[0] == "sign"}:
        ratio = math.exp(_suggested(sign))
        prior = (PRIOR / (1 + ratio), PRIOR * ratio / (1 + ratio))
        seen = [counts[("sign", sign, y)] + prior[y] * total[y] / sum(total) * 2 for y in (0, 1)]
        weights[sign] = math.log(seen[1] / total[1]) - math.log(seen[0] / total[0])
    ties = {}
    for kind in _TIES:
        if kind == "inside":  # nothing in boilerplate is content
            ties[kind] = ((0.0, -CERTAIN), (math.log(0.5), math.log(0.5)))
            continue
        rows = []
        for parent in (0, 1):
            same = {"inline": 0.99, "block": 0.9}.get(kind, 0.5)
            seen = [counts[("tie", kind, parent, child)] + PRIOR * (same if child == parent else 1 - same) for child in (0, 1)]
            rows.append((math.log(seen[0] / sum(seen)), math.log(seen[1] / sum(seen))))
        ties[kind] = (rows[0], rows[1])
    return Model(weights, ties)


def self_labelled(nodes: list[Node]) -> list[int] | None:
    """Labels from a page's one article (or main) element; None if it has none or several."""
    for tag in ("article", "main"):
        found = [n for n, node in enumerate(nodes) if node.tag == tag]
        if len(found) == 1:
            labels = [0] * len(nodes)
            for n, node in enumerate(nodes):
                inside = n == found[0] or (n > 0 and labels[node.parent] == 1)
                labels[n] = int(inside and _role(node) not in ("never", "boilerplate"))
            return labels
        if found:
            return None
    return None


def count_page(page: str, hide: bool) -> Counter:
    """What ``fit`` needs to know of one self-labelled page."""
    nodes, parts = parse(page)
    measure(nodes, parts)
    labels = self_labelled(nodes)
    out: Counter = Counter()
    if labels is None:
        return out
    for n, node in enumerate(nodes[1:], start=1):
        if hide and _kind(node.tag) == "content":
            node.tag = "div"
        out[("label", labels[n])] += 1
        for sign in signs(node):
            out[("sign", sign, labels[n])] += 1
        out[("tie", _tied(_role(nodes[node.parent]), _role(node)), labels[node.parent], labels[n])] += 1
    return out


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = TRAIN_PAGES) -> Model:
    """Potentials from ``train_pages`` pages at most, one by hash in each of so many strata."""
    h = F.xxhash64(F.col(id_col), F.lit("pages"))
    chosen = saved(pages.select(h.alias("h")).groupBy(F.pmod("h", F.lit(train_pages)).alias("s")).agg(F.min("h").alias("h")))
    rows = (pages.select(h.alias("h"), F.col(html_col).alias("html")).where(F.col("html").isNotNull())
            .join(F.broadcast(chosen.select("h")), "h"))  # ``train_pages`` rows

    @F.pandas_udf("array<struct<key:string,n:long>>")
    def count(hashes: pd.Series, htmls: pd.Series) -> pd.Series:
        return pd.Series([[{"key": "\t".join(map(str, k)), "n": n} for k, n in count_page(page, h % 2 == 0).items()]
                          for h, page in zip(hashes, htmls, strict=True)])

    total: Counter = Counter()
    counted = (rows.select(F.explode(count("h", "html")).alias("c")).groupBy("c.key").agg(F.sum("c.n").alias("n")).collect())
    for r in counted:  # one row a sign: tags and a few classes
        key = r["key"].split("\t")
        total[tuple([*key[:2], *map(int, key[2:])]) if key[0] != "label" else ("label", int(key[1]))] = r["n"]
    return fit(total)


def main_text(page: str | None, model: Model) -> str:
    """The main text of one page; blocks in page order with one space between."""
    if not page:
        return ""
    nodes, parts = parse(page)
    measure(nodes, parts)
    content = [m >= 0.5 for m in model.marginals(nodes)]
    out: list[str] = []
    for node, piece in parts:
        if piece is None:
            out.append(" ")
        elif content[node]:
            out.append(piece)
    return " ".join("".join(out).split())


def extract(pages: DataFrame, model: Model, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points.

    Null or empty html, and pages without content: empty text. Broken markup
    is read as far as it goes, whatever its length. Columns of ``pages``
    with one of the two names are replaced, all others kept. Repeated rows
    get equal results. An empty table gives an empty table.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, shared.value) for page in batch], dtype=object)

    names = [c for c in pages.columns if c not in ("text", "n_chars")]
    text: Column = run(F.col(html_col))
    return (pages.select(*names, text.alias("text")).withColumn("n_chars", F.length("text").cast("long")))


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages, train(pages)).select("page_id", "url", "text", "n_chars")
