"""Main text of web pages by a tree-structured graphical model.

The elements of a page form a tree; each is content or not. Potentials come from an element's features (tag, class words,
amount of text, share of link text) and from the labels of parent and child. Sum-product messages, once up and once down
the tree, give every element's exact marginal; the text of elements that are more likely content is kept, in page order.

The potentials are trained on labelled elements: hand-labelled layouts below, and a bounded sample of the table's own
pages whose semantic tags label them. Spark counts features by label; only the counts, whose number is bounded by the
sample, reach the driver.

Defined cases: null or empty pages have empty text; broken markup is read leniently and never fails; very long pages are
read whole; repeated rows give repeated results; an empty table gives an empty result, with a model of the layouts
alone; columns that are not named are neither read nor changed.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 400  # pages of the table that label themselves, at most
SMOOTHING = 0.5

RAW = "script|style|noscript|template|textarea|svg|iframe"
TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*+>.*?(?:</\1\s*+>|\Z)|<(/?)([a-z][a-z0-9-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-z][a-z0-9-]*+)([^>]*+)>|<[!?][^>]*+>",
    re.IGNORECASE | re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|data-content)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start tag on the left ends an open element on the right, if that is the innermost one.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
        "option": {"option"}, "body": {"head"}}
CONTENT = frozenset(("article", "main"))
# Elements that divide a page; the others hold text and rarely differ from what they stand in, so they have potentials of their own.
CONTAINERS = frozenset("html body head div section article main nav header footer aside form menu center details dialog".split())
BOILERPLATE = frozenset(("nav", "header", "footer", "aside", "form", "head", "menu", "button", "select"))


@dataclass
class Page:
    """Elements in page order (parents first) and the runs of text they hold."""

    tags: list[str] = field(default_factory=lambda: ["#root"])
    parents: list[int] = field(default_factory=lambda: [-1])
    words: list[list[str]] = field(default_factory=lambda: [[]])
    marks: list[str | None] = field(default_factory=lambda: [None])
    runs: list[tuple[int, str]] = field(default_factory=list)
    chars: list[int] = field(default_factory=lambda: [0])
    linked: list[int] = field(default_factory=lambda: [0])


def parsed(source: str) -> Page:
    page, stack, text, links, at = Page(), [0], [], 0, 0

    def flush() -> None:
        body = " ".join("".join(text).split())
        text.clear()
        if body:
            page.runs.append((stack[-1], body))

    def take(piece: str) -> None:
        decoded = html.unescape(piece) if "&" in piece else piece
        text.append(decoded)
        size = len(decoded.strip())
        page.chars[stack[-1]] += size
        page.linked[stack[-1]] += size if links else 0

    for m in TAG.finditer(source):
        if m.start() > at:
            take(source[at:m.start()])
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue  # a comment, a declaration or an element whose content is no text
        closing = bool(m[2] or m[5])
        if name == "a":
            links = 0 if closing else 1
        if name in INLINE:
            continue
        if name in VOID:
            text.append(" ")
            continue
        flush()
        if closing:
            if name in (page.tags[k] for k in stack[1:]):
                while page.tags[stack.pop()] != name:
                    pass
            links = 0
            continue
        while len(stack) > 1 and page.tags[stack[-1]] in ENDS.get(name, {"p"}):
            stack.pop()
        words, mark = [], None
        for a in ATTRIBUTE.finditer(m[4] or m[7] or ""):
            value = a[2] or a[3] or a[4] or ""
            if a[1].lower() == "data-content":
                mark = value
            else:
                words += re.findall("[a-z]+", re.sub("([a-z])([A-Z])", r"\1 \2", value).lower())
        page.tags.append(name)
        page.parents.append(stack[-1])
        page.words.append(words)
        page.marks.append(mark)
        page.chars.append(0)
        page.linked.append(0)
        stack.append(len(page.tags) - 1)
    if at < len(source):
        take(source[at:])
    flush()
    return page


def features(page: Page) -> list[list[str]]:
    out = []
    for k in range(len(page.tags)):
        chars = page.chars[k]
        share = page.linked[k] / chars if chars else 0
        out.append([f"tag={page.tags[k]}", *sorted({f"word={w}" for w in page.words[k]}),
                    f"chars={min(4, int(math.log(chars, 5)))}" if chars else "chars=none", f"links={'none' if not chars else 'few' if share < 0.3 else 'many'}"])
    return out


def labels(page: Page) -> list[int]:
    """Labels by the marks of a labelled layout, or else by semantic tags."""
    out = [0]
    for k in range(1, len(page.tags)):
        mark = page.marks[k]
        own = int(mark) if mark in ("0", "1") else 1 if page.tags[k] in CONTENT else 0 if page.tags[k] in BOILERPLATE else None
        out.append(out[page.parents[k]] if own is None else own)
    return out


@dataclass(frozen=True)
class Model:
    """Log potentials: of a feature in favour of content, of the root, and of (parent, child) labels for text elements and containers."""

    features: dict[str, float]
    root: float
    pairs: tuple[tuple[tuple[float, float], tuple[float, float]], ...]

    def marginals(self, page: Page) -> list[float]:
        """Probability of content for every element, by one upward and one downward pass."""
        n, parents = len(page.tags), page.parents
        between = [self.pairs[tag in CONTAINERS] for tag in page.tags]
        local = [[0.0, sum(self.features.get(f, 0.0) for f in fs)] for fs in features(page)]
        local[0][1] += self.root
        up: list[tuple[float, float]] = [(0.0, 0.0)] * n  # the message of an element to its parent
        for k in range(n - 1, 0, -1):
            (a, b), pairs = local[k], between[k]
            message = _log_sum(pairs[0][0] + a, pairs[0][1] + b), _log_sum(pairs[1][0] + a, pairs[1][1] + b)
            up[k] = message
            local[parents[k]][0] += message[0]
            local[parents[k]][1] += message[1]
        belief = local  # of the root now; below, the parent's message is added
        for k in range(1, n):
            a, b, pairs = belief[parents[k]][0] - up[k][0], belief[parents[k]][1] - up[k][1], between[k]
            belief[k][0] += _log_sum(a + pairs[0][0], b + pairs[1][0])
            belief[k][1] += _log_sum(a + pairs[0][1], b + pairs[1][1])
        return [1 / (1 + math.exp(min(700.0, a - b))) for a, b in belief]


def _log_sum(a: float, b: float) -> float:
    top = a if a > b else b
    return top + math.log1p(math.exp(-abs(a - b)))


def main_text(model: Model, source: str | None) -> str:
    if not source:
        return ""
    page = parsed(source)
    content = model.marginals(page)
    return "\n".join(text for k, text in page.runs if content[k] > 0.5)


# --- training ---------------------------------------------------------------------------------------

_PARA = "<p>A paragraph of the story that is long enough to be read as prose, with a few clauses and a full stop at its end.</p>"
_LINKS = "<ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/s'>Sport</a></li><li><a href='/c'>Contact</a></li></ul>"


def _layout(body: str) -> str:
    return f"<html><head><title>Title</title></head><body>{body}</body></html>"


def _plain(kind: str, inner: str) -> str:
    return f"<div class='{kind}' data-content='0'>{inner}</div>"


# Labelled layouts: data-content marks what is content and what is not; elements without a mark follow their parent.
_AROUND = "".join(_plain(kind, inner) for kind, inner in (
    ("menu navbar navigation", _LINKS), ("header top masthead", "<h2>Site name</h2>"), ("sidebar side widget", f"<h3>More</h3>{_LINKS}"),
    ("ad ads advert advertisement banner sponsor promo", "<p>Buy this fine product now, and save a lot of money today.</p>"), ("cookie notice consent popup", "<p>We use cookies to improve the site. Read more in our terms.</p><button>Accept</button>"),
    ("comments comment reply discussion respond", f"<h3>Comments</h3><p>A reader wrote this remark, and it is of some length.</p>{_PARA}"), ("share social related recommended newsletter subscribe", _LINKS),
    ("breadcrumb breadcrumbs pagination pager tags meta", "<a href='/'>Home</a> <a href='/x'>Topic</a>"), ("footer bottom copyright legal", "<p>Copyright of the site. All rights reserved.</p>")))
LAYOUTS = tuple(_layout(x) for x in (
    *(f"{_AROUND}<div class='{kind}' data-content='1'><h1>A headline</h1>{_PARA * 4}<ul><li>One point of a list.</li><li>Another point.</li></ul><blockquote>{_PARA}</blockquote></div>{_AROUND}"
      for kind in ("content", "post entry", "article story", "main text body", "page article")),
    *(f"<header>{_LINKS}</header><{tag}><h1>A headline</h1>{_PARA * 4}<h2>A part</h2>{_PARA}<figure><figcaption>A caption.</figcaption></figure><table><tr><td>A cell</td><td>7</td></tr></table>"
      f"<aside>{_LINKS}</aside><section class='comments' data-content='0'><h3>Comments</h3>{_PARA}</section></{tag}><aside>{_LINKS}<p>Some words at the side.</p></aside><form><label>Name</label><p>Write to us, please.</p></form>"
      f"<footer><p>Copyright of the site.</p></footer>" for tag in ("article", "main")),
    f"<nav>{_LINKS}</nav><div><div data-content='1'><h1>A headline</h1>{_PARA * 6}</div></div><footer>{_LINKS}</footer>",
))


def _counted(pages: DataFrame) -> DataFrame:
    """(kind, name, label, n): how often features, and parent labels, occur with a label in the pages (html)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, str, int]] = []
            for source in batch.column("html").to_pylist():
                page = parsed(source or "")
                label = labels(page)
                for k, names in enumerate(features(page)):
                    out += [("feature", name, label[k]) for name in names]
                    out.append((f"pair {page.tags[k] in CONTAINERS:d}", str(label[page.parents[k]]), label[k]) if k else ("root", "", label[k]))
            columns = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int32())], names=["kind", "name", "label"])

    return pages.mapInArrow(rows, "kind string, name string, label int").groupBy("kind", "name", "label").agg(F.count(F.lit(1)).alias("n"))


def trained(pages: DataFrame, html_column: str = "html", id_column: str = "page_id", sample: int = SAMPLE_PAGES) -> Model:
    """Potentials from the layouts and a sample of the pages that have semantic tags, taken by the hash of their id."""
    spark = pages.sparkSession
    semantic = pages.where(F.col(html_column).rlike("(?i)<(article|main)\\b")).select(F.xxhash64(id_column).alias("h"), F.col(html_column).alias("html"))
    layouts = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in LAYOUTS])).alias("html"))
    few = semantic.orderBy("h").limit(sample).select("html")
    weight = 20  # a layout stands for as many pages of its kind
    counts: dict[tuple[str, str], list[float]] = {}
    for frame, times in ((layouts, weight), (few, 1)):
        for kind, name, label, n in _counted(frame).collect():
            counts.setdefault((kind, name), [0.0, 0.0])[label] += times * n
    total = [sum(v[y] for (kind, _), v in counts.items() if kind == "feature") for y in (0, 1)]
    weights = {name: math.log((v[1] + SMOOTHING) / (total[1] + SMOOTHING)) - math.log((v[0] + SMOOTHING) / (total[0] + SMOOTHING))
               for (kind, name), v in counts.items() if kind == "feature"}
    seen = [[counts.get((f"pair {kind}", str(y)), [0.0, 0.0]) for y in (0, 1)] for kind in (0, 1)]
    pairs = tuple(tuple(tuple(math.log((p[y] + SMOOTHING) / (sum(p) + 2 * SMOOTHING)) for y in (0, 1)) for p in kind) for kind in seen)
    root = counts.get(("root", ""), [1.0, 0.0])
    return Model(weights, math.log((root[1] + SMOOTHING) / (root[0] + SMOOTHING)), pairs)


def extracted(pages: DataFrame, model: Model | None = None, id_column: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """Main text of every page and its length in code points."""
    model = model or trained(pages, html_column, id_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(model, source) for source in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    rows = pages.select(F.struct(F.col(id_column), F.col(url)).alias("row"), F.col(html_column).alias("html"))
    schema = f"row struct<{rows.schema['row'].dataType.simpleString()[7:-1]}>, text string"
    out = rows.mapInArrow(run, schema)
    return out.select("row.*", "text", F.length("text").cast("long").alias("n_chars"))
