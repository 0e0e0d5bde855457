"""Main text of web pages by site style trees.

The element trees of a host's pages are laid over each other: elements with the same chain
of labels (tag, class, id and role, without digits) are one *style node*. A style node is
judged by how it varies over the host's pages, as entropies to the base of their number:

* content: a feature is a phrase of its text. One that k of m pages show has an entropy of
  log k / log m, and the node's content importance is 1 less the mean over its features;
* presentation: the entropy of the styles (sequences of child labels) it occurs in.

Their mixture is the node's importance on that host. Few pages show few repetitions, so it is
drawn toward the importance of the same node in the tree of all hosts, as if BORROWED pages
had been seen, and is never above that: a notice of a hundred wordings repeats across hosts
sooner than on one. A branch all of whose nodes are below the threshold is removed; of a
branch with others among them, only those nodes.

Two passes read the pages. The first counts features, combined per task before they are
shuffled by feature; sums per host and node follow, so a host with a third of all pages is a
few rows per task, and a feature of all hosts (a copyright line) one row per host and task.
Only nodes below the threshold are handed to the second pass, with their host, which removes
them and writes out the rest. What HTML itself says comes first: scripts, navigation,
footers, asides, forms, and names such as "advert" or "comments", have importance 0, and text
in an ``article`` or ``main`` is not removed for being repeated: a copied article is one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm import urls
from lectern.llm.common import pick
from lectern.staging import stage

#: Nodes below this importance are removed.
THRESHOLD = 0.5
#: Weight of content against presentation.
CONTENT_SHARE = 0.9
#: Pages that the node of all hosts counts as.
BORROWED = 20
#: Counts that a task holds before it passes them on.
HELD = 300_000

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<[!?/](?![A-Za-z])[^>]*+>?"
    r"|<[!?][^>]*+>?"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[^>]*+)>?",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PHRASE = re.compile(r"(?<=[.!?;:。！？])\s+|\s+[-–—|·•»›/]\s+")
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[a-z]+")

# Fixed values of HTML: elements without a content, with a content that is no markup, that
# are blocks, and whose text is never part of an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
NO_TEXT = frozenset(
    "aside button canvas datalist dialog fieldset footer form label legend menu nav noscript object optgroup"
    " option search select svg template audio video".split()
)
#: Roles of the accessibility standard, and words of names, that mark such elements.
NO_ROLE = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
NO_NAME = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments"
    " cookie cookies consent disclaimer disqus footer gdpr menu nav navbar navigation newsletter notice notices"
    " pagination popup promo promoted promotion related sharing share sidebar social sponsor sponsored subscribe"
    " subscription toolbar widget widgets".split()
)
#: What ends an open element of the key, up to the named parent.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


@dataclass(slots=True)
class Element:
    tag: str
    label: str
    node: int
    up: int
    removed: bool
    in_article: bool
    children: list[str] = field(default_factory=list)


@dataclass(slots=True)
class Page:
    """A page's elements in page order and its blocks (place of the element, text)."""

    elements: list[Element] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)


def _label(tag: str, attributes: str) -> tuple[str, str]:
    """An element's label, and its role."""
    if not attributes or "=" not in attributes:
        return tag, ""
    found = {}
    for name, *values in _NAMES.findall(attributes):
        found.setdefault(name.lower(), html.unescape("".join(values)).lower())
    parts = [tag, *sorted(found.get("class", "").split())]
    if "id" in found:
        parts.append("#" + found["id"])
    if "role" in found:
        parts.append("@" + found["role"])
    return _DIGITS.sub("", ".".join(parts)), found.get("role", "")


def _no_text(tag: str, label: str, role: str, in_article: bool) -> bool:
    """Whether HTML or its names say that the element holds no main text. A header inside the
    article is the article's own; one outside is the page's."""
    if tag in NO_TEXT or role in NO_ROLE or (tag == "header" and not in_article):
        return True
    if label == tag or tag in ("body", "html", "article", "main"):
        return False
    return not NO_NAME.isdisjoint(_WORDS.findall(label[len(tag) :].split("@")[0]))


def parse(source: str) -> Page:
    """Elements and blocks of a page, by the rules of HTML for omitted end tags. Inline
    elements are part of their block. Anything is a page; the empty text has no block."""
    page = Page()
    stack: list[int] = []
    pieces: list[str] = []
    hidden = 0  # open inline elements whose text is left out
    hidden_tag = ""

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            page.blocks.append((stack[-1] if stack else -1, text))

    def close(tags: frozenset | set, bounds: frozenset | set) -> None:
        for i in range(len(stack) - 1, -1, -1):
            tag = page.elements[stack[i]].tag
            if tag in tags:
                flush()
                del stack[i:]
                return
            if tag in bounds:
                return

    at, end = 0, len(source)
    while at < end:
        match = _TAG.search(source, at)
        start = match.start() if match else end
        if start > at and not hidden:
            pieces.append(html.unescape(source[at:start]))
        if not match:
            break
        at = match.end()
        name = match.group(2)
        if name is None:
            continue
        tag, closing = name.lower(), match.group(1)
        if hidden:
            if tag == hidden_tag:
                hidden += -1 if closing else 1
            continue
        if closing:
            if tag in BLOCK:
                close({tag}, {"table"} if tag not in ("table", "body", "html") else frozenset())
            continue
        if tag in RAW:
            ended = re.compile(f"</{tag}(?![A-Za-z0-9])[^>]*>?", re.I).search(source, at)
            at = ended.end() if ended else end
            continue
        if tag in ("br", "hr"):
            pieces.append(" ")
            if tag == "hr":
                close({"p"}, _P_BOUNDS)
                flush()
            continue
        if tag in VOID:
            continue
        if tag not in BLOCK:
            if tag in NO_TEXT:
                hidden, hidden_tag = 1, tag
            continue
        flush()
        if tag in _ENDS:
            close(*_ENDS[tag])
        else:
            close({"p"}, _P_BOUNDS)
            if tag in _HEADINGS:
                close(_HEADINGS, _P_BOUNDS)
        label, role = _label(tag, match.group(3))
        up = stack[-1] if stack else -1
        above = page.elements[up] if stack else None
        in_article = bool(above and above.in_article)
        removed = bool(above and above.removed) or _no_text(tag, label, role, in_article)
        node = _hash(label, above.node + (1 << 63) if above else 0)
        if above is not None and (not above.children or above.children[-1] != label):
            above.children.append(label)
        page.elements.append(
            Element(tag, label, node, up, removed, in_article or tag in ("article", "main"))
        )
        stack.append(len(page.elements) - 1)
    flush()
    return page


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), seed) - (1 << 63)


_P_BOUNDS = frozenset(BLOCK - {"p"} - _HEADINGS)


def phrases(text: str, host: str) -> list[str]:
    """The features of a text: its phrases, the host's own name and digits made alike."""
    plain = text.lower()
    if host:
        plain = plain.replace(host, "@")
    return [p for p in _PHRASE.split(_DIGITS.sub("0", plain)) if p]


NODE, TEXT, STYLE = 0, 1, 2


def page_features(page: Page, host: str) -> Iterator[tuple[int, int, int]]:
    """What a page adds to its host's tree: (node, kind, feature), each once."""
    seen: set[tuple[int, int, int]] = set()
    # Only texts meet across hosts; the others are spread by host.
    own = _hash(host)
    for element in page.elements:
        seen.add((element.node, NODE, own))
        seen.add((element.node, STYLE, _hash("\x00".join((host, *element.children)))))
    for place, text in page.blocks:
        node = page.elements[place].node if place >= 0 else 0
        if place < 0:
            seen.add((0, NODE, own))
        for phrase in phrases(text, host):
            seen.add((node, TEXT, _hash(phrase)))
    return iter(seen)


_FEATURES = "host string, node long, kind int, feature long, pages long"


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html")):
            held.update((host, *f) for f in page_features(parse(source.as_py() or ""), host))
            if len(held) >= HELD:
                yield _features(held)
                held = Counter()
    if held:
        yield _features(held)


def _features(held: Counter) -> pa.RecordBatch:
    host, node, kind, feature = zip(*held)
    types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    columns = (host, node, kind, feature, list(held.values()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in _FEATURES.split(", ")]
    )


def style_tree(pages: DataFrame) -> DataFrame:
    """The style nodes with text of all hosts, from ``pages`` (host, html): (host, node, pages,
    own importance on that host, importance in the tree of all hosts, importance)."""
    feature = ["node", "kind", "feature"]
    counted = (
        pages.mapInArrow(_count_features, _FEATURES)
        .repartition(*feature)
        .groupBy("host", *feature)
        .agg(F.sum("pages").alias("k"))
    )
    # Shuffled by feature already: the sum over its hosts costs no second exchange.
    same = Window.partitionBy(*feature)
    counted = counted.withColumns(
        {"_all": F.sum("k").over(same), "_once": F.col("host") == F.min("host").over(same)}
    )
    k, every = F.col("k").cast("double"), F.col("_all").cast("double")
    is_text, is_style = F.col("kind") == TEXT, F.col("kind") == STYLE
    nodes = stage(
        counted.groupBy("host", "node")
        .agg(
            F.sum(F.when(F.col("kind") == NODE, F.col("k"))).alias("pages"),
            F.sum(F.when(is_text, F.log(k))).alias("_text"),
            F.count_if(is_text).alias("_features"),
            F.sum(F.when(is_text & F.col("_once"), F.log(every))).alias("_text_all"),
            F.count_if(is_text & F.col("_once")).alias("_features_all"),
            F.sum(F.when(is_style, k)).alias("_styles"),
            F.sum(F.when(is_style, k * F.log(k))).alias("_style"),
        )
        .filter("_features > 0")
    )

    def portion(value: Column) -> Column:
        return F.greatest(F.least(F.coalesce(value, F.lit(1.0)), F.lit(1.0)), F.lit(0.0))

    base = F.log(F.col("pages").cast("double"))
    content = portion(1 - F.try_divide(F.col("_text"), F.col("_features") * base))
    varied = portion(F.try_divide(F.log("_styles") - F.col("_style") / F.col("_styles"), base))
    # On one page nothing can vary: all of it counts as important.
    mixed = CONTENT_SHARE * content + (1 - CONTENT_SHARE) * varied
    nodes = nodes.withColumn("own", F.when(F.col("pages") > 1, mixed).otherwise(F.lit(1.0)))
    of_all = nodes.groupBy("node").agg(
        F.sum("pages").alias("_pages"),
        F.sum("_text_all").alias("_text"),
        F.sum("_features_all").alias("_features"),
        (F.sum(varied * F.col("pages")) / F.sum("pages")).alias("_varied"),
    )
    base = F.log(F.col("_pages").cast("double"))
    content = portion(1 - F.try_divide(F.col("_text"), F.col("_features") * base))
    mixed = CONTENT_SHARE * content + (1 - CONTENT_SHARE) * F.col("_varied")
    of_all = of_all.select("node", F.when(F.col("_pages") > 1, mixed).otherwise(F.lit(1.0)).alias("of_all"))
    drawn = (F.col("pages") * F.col("own") + BORROWED * F.col("of_all")) / (F.col("pages") + BORROWED)
    return nodes.join(of_all, "node").select(
        "host", "node", "pages", "own", "of_all", F.least(drawn, "of_all").alias("importance")
    )


def main_text(page: Page, weak: dict[int, float]) -> str:
    """Blocks of the branches that stay, in page order. ``weak``: importance of the style nodes
    below the threshold on the page's host; any other node counts as important."""
    def stays(place: int) -> bool:
        if place < 0:
            return weak.get(0, 1.0) >= THRESHOLD
        element = page.elements[place]
        if element.removed or element.in_article:
            return not element.removed
        return weak.get(element.node, 1.0) >= THRESHOLD

    return "\n\n".join(text for place, text in page.blocks if stays(place))


def _write_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, weak in zip(batch.column("html"), batch.column("weak")):
            nodes = {w["node"]: w["importance"] for w in weak.as_py() or ()}
            texts.append(main_text(parse(source.as_py() or ""), nodes))
        names = ["page_id", "url"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(texts, pa.string())], [*names, "text"]
        )


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Blocks have their character references decoded and white space made one space; they
    are joined by an empty line. A page without main text, an empty or a null html gives an
    empty text. A null url, or one without a host, belongs to the host of no name. Rows that
    repeat are pages of their own; no rows give no rows; extra columns are not read.
    """
    rows = pick(pages, page_id="page_id", url="url", html="html")
    named = rows.select(
        "page_id", "url", urls.host_of(F.col("url")).alias("host"), F.col("html")
    )
    weak = (
        style_tree(named.select("host", "html"))
        .filter(F.col("importance") < THRESHOLD)
        .groupBy("host")
        .agg(F.collect_list(F.struct("node", "importance")).alias("weak"))
    )
    # Weak nodes show on several pages; a host's are few. Joined by what their size allows.
    found = named.join(weak, "host", "left").mapInArrow(
        _write_out, "page_id long, url string, text string"
    )
    return found.withColumn("n_chars", F.length("text").cast("long"))
