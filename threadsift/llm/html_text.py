"""Main text of web pages by a site style tree.

Pages of one host are merged into one tree of style nodes: the path of tags and class
names that leads to a block of text. Two entropies, over the pages of the host, say what a
branch is worth: how much its presentation varies (the sequences of its children), and how
much the content of its blocks does. With m pages and shares p of the different values,

    importance(node) = (1 - GAMMA^l) * H(presentation) + GAMMA^l * mean importance of its blocks,
    H = -sum(p * log_m(p)), or 1 where m is 1, and l the number of its different presentations.

Blocks below a branch whose importance is under THRESHOLD go: menus and footers look alike
on every page. HTML also says outright what some branches are: menus, headers, footers,
sidebars, notices, adverts, forms and comments have importance 0. Names are whole class
names or ids. What covers an element that holds an article or main element depends:
forms, divs and sections do not (some frameworks put whole pages into a form or a dialog),
nor do most names, unless they stand inside an article. Names of comments, replies and
related texts do, since their entries are article elements too; they give way to a main
element and to the first heading of the page. Where the article and main elements that are
left hold at least a third of the page's text that is not settled, the page has no main
text outside them; where they hold less, the tree decides about the rest.

Inside articles, too, the tree decides. A block goes if its branch is under THRESHOLD, or if
its own content is: with c of the m pages that show the branch having the block (all counts
are exact),

    importance(content) = 1 - log_m(c).

Articles that are copies of each other inside a host count as one page, so text is not taken
for boilerplate because an article was copied. Near copies share most of their text: a page
that would lose more than half of its article keeps all of it.

Blocks end where block-level elements begin or end. Character references are decoded,
white space inside a block becomes one space, and blocks are joined by a line feed in page
order. A header inside an article belongs to it.

Edge cases: null or empty html gives an empty text, and so does a page without main text;
a null url is a host of its own; rows that repeat a page_id, or have none, are pages of
their own; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.common import batch, materialize

GAMMA = 0.9
THRESHOLD = 0.25
#: Pages that must show a branch before its entropies count.
LEAST_PAGES = 4
#: Entries of boilerplate, of all hosts, that are sent to the tasks.
SHIPPED = 200_000

# Names of HTML elements, roles and usual class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head script style noscript template iframe object svg math canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr li main menu nav ol p pre search section table ul".split()
)
#: An element that begins inside one of these closes it, up to the nearest element named after it.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CHROME = frozenset("nav footer aside form button select textarea dialog menu search".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr menu modal nav navbar navigation newsletter notice popup promo promoted related reply "
    "replies respond share sharing sidebar skip social sponsor sponsored subscribe toolbar topbar widget "
    "ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper adsbygoogle banner-ad comment-form comment-list comment-respond "
    "comments-area comments-section comment-section cookie-banner cookie-bar cookie-consent cookie-notice cookie-popup "
    "consent-banner gdpr-banner google-ad footer-widgets site-footer page-footer main-footer main-menu main-nav "
    "main-navigation nav-bar nav-links nav-menu navbar-nav newsletter-form newsletter-signup popup-overlay post-navigation "
    "post-share related-articles related-links related-posts share-buttons sharing-buttons side-bar site-nav "
    "site-navigation skip-link skip-to-content social-icons social-links social-share sponsored-content widget-area".split()
)
MAIN = frozenset(["article", "main"])
#: Elements that may wrap a whole page.
WRAPPERS = frozenset("div form section".split())
#: Names of parts whose entries may be article elements.
ENTRY_NAMES = frozenset(
    "comment comments comment-list comment-respond comments-area comments-section comment-section disqus replies reply respond "
    "related related-articles related-links related-posts promoted sponsored sponsored-content".split()
)
#: Names that say what the header tag says.
HEADER_NAMES = frozenset("header masthead page-header site-header main-header top-header".split())
_NAME = re.compile(r"[A-Za-z0-9]+")


class _Element:
    """An open element: what its tag and its names say, and what is below it.

    `holds`: an article or main element; `holds_body`: a main element or the page's first h1.
    """

    __slots__ = ("tag", "style", "above", "skipped", "chrome", "named", "entries", "header", "main", "holds", "holds_body", "in_article", "what")

    def __init__(self, tag: str, attributes: dict, above: _Element | None):
        self.tag, self.above = tag, above
        self.style = ".".join([tag, *sorted(set(_NAME.findall(attributes.get("class") or "")))])
        self.skipped = tag in SKIPPED or (above is not None and above.skipped)
        names = {n.lower() for a in ("class", "id") for n in (attributes.get(a) or "").split()}
        if tag in ("html", "body"):
            names = set()
        role = (attributes.get("role") or "").lower()
        style = (attributes.get("style") or "").replace(" ", "").lower()
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style
        self.chrome = tag in CHROME or role in CHROME_ROLES or hidden
        self.named, self.header, self.entries = bool(names & CHROME_NAMES), bool(names & HEADER_NAMES), bool(names & ENTRY_NAMES)
        self.main = tag in MAIN or role in MAIN
        self.in_article = above is not None and (above.in_article or above.tag == "article")
        self.holds = self.holds_body = False
        if self.main:
            up = above
            while up is not None and not up.holds:
                up.holds = True
                up = up.above
        if tag == "main" or role == "main":
            self.mark_body()

    def mark_body(self) -> None:
        up = self.above
        while up is not None and not up.holds_body:
            up.holds_body = True
            up = up.above

    def settle(self) -> None:
        """0 for chrome, 1 for main or None; elements above are settled before."""
        above = self.above.what if self.above is not None else None
        # Inside an article names count whatever they cover.
        named = self.named and (self.in_article or not self.holds or (self.entries and not self.holds_body))
        header = self.tag == "header" or (self.header and not self.holds)
        chrome = self.chrome and not (self.holds and self.tag in WRAPPERS)
        if above == 0 or chrome or named or (header and above != 1):
            self.what = 0
        else:
            self.what = 1 if self.main else above


class _Page(HTMLParser):
    """Blocks of a page: (path of styles, text, 0 for chrome, 1 for main or None)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Element] = []
        self.elements: list[_Element] = []
        self.found: list[tuple[str, str, _Element | None]] = []
        self.text: list[str] = []
        self.headed = False

    def _end_block(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                path = ">".join(e.style for e in self.open if e.tag not in INLINE)
                self.found.append((path, text, self.open[-1] if self.open else None))
            self.text = []

    def blocks(self) -> list[tuple[str, str, int | None]]:
        for element in self.elements:
            element.settle()
        return [(path, text, element.what if element is not None else None) for path, text, element in self.found]

    def _pop_to(self, names: set | frozenset, stop: set | frozenset) -> None:
        """Close the nearest open element of `names`, unless one of `stop` is nearer."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag in names:
                self._end_block()
                del self.open[i:]
                return
            if self.open[i].tag in stop:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body":
            self._pop_to({"head"}, set())
        if tag in CLOSES_PARAGRAPH:
            self._pop_to({"p"}, {"table", "button", "object", "article", "section", "div", "li", "td"})
        if tag in SIBLINGS:
            self._pop_to(*SIBLINGS[tag])
        if tag not in INLINE:
            self._end_block()
        if tag in VOID:
            if tag in ("br", "img", "wbr"):
                self.text.append(" " if tag == "br" else "")
            return
        self.open.append(_Element(tag, dict(attrs), self.open[-1] if self.open else None))
        self.elements.append(self.open[-1])
        if tag == "h1" and not self.headed:
            self.headed = True
            self.open[-1].mark_body()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math", "path", "circle", "rect", "use", "g"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if any(o.tag == tag for o in self.open):
            if tag not in INLINE:
                self._end_block()
            while self.open.pop().tag != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1].skipped):
            self.text.append(data)


def blocks_of(html: str | None) -> list[tuple[str, str, int | None]]:
    page = _Page()
    page.feed(html or "")
    page.close()
    page._end_block()
    blocks = page.blocks()
    inside = sum(len(text) for _, text, what in blocks if what == 1)
    outside = sum(len(text) for _, text, what in blocks if what is None)
    if inside and 2 * inside >= outside:
        return [(path, text, what or 0) for path, text, what in blocks]
    return blocks


def _number(text: str) -> int:
    """Spark's xxhash64 of a text."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return value - (1 << 64) if value >> 63 else value


def nodes_of(paths: list[str]) -> list[dict[str, int]]:
    """Every branch that a page shows, and the sequence of its children, as numbers."""
    children: dict[str, list[str]] = {}
    for path in paths:
        parts = path.split(">")
        for depth in range(1, len(parts) + 1):
            children.setdefault(">".join(parts[:depth]), []).append(parts[depth] if depth < len(parts) else "")
    return [{"branch": _number(branch), "children": _number(">".join(own))} for branch, own in children.items()]


_NODES = "array<struct<branch: long, children: long>>"
_BLOCKS = f"page long, seq int, page_id long, url string, path string, text string, what int, nodes {_NODES}, outer {_NODES}"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages -> one row for each page (seq -1) and one for each of its blocks.

    The page's row has its branches: `nodes` of all blocks, `outer` without those of its article.
    """
    node = pa.list_(pa.struct([("branch", pa.int64()), ("children", pa.int64())]))
    types = {
        "page": pa.int64(), "seq": pa.int32(), "page_id": pa.int64(), "url": pa.string(), "path": pa.string(), "text": pa.string(),
        "what": pa.int32(), "nodes": node, "outer": node,
    }
    for rows in batches:
        for first in range(0, rows.num_rows, 200):
            columns = {c: [] for c in types}
            for row in rows.slice(first, 200).to_pylist():
                found = [(None, None, None), *blocks_of(row["html"])]
                columns["page"] += [row["page"]] * len(found)
                columns["seq"] += range(-1, len(found) - 1)
                columns["page_id"] += [row["page_id"]] * len(found)
                columns["url"] += [row["url"]] * len(found)
                for name, values in zip(("path", "text", "what"), zip(*found)):
                    columns[name] += values
                blocks = found[1:]
                columns["nodes"] += [nodes_of([b[0] for b in blocks]), *[None] * len(blocks)]
                columns["outer"] += [nodes_of([b[0] for b in blocks if b[2] != 1]), *[None] * len(blocks)]
            yield batch({c: pa.array(columns[c], t) for c, t in types.items()})


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _entropy(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, m (occurrences), kinds and h: the normalised entropy of a value over a style node."""
    counts = values.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    sums = counts.groupBy(*keys).agg(
        F.sum("c").alias("m"), F.count(F.lit(1)).alias("kinds"), F.sum(F.col("c") * F.ln("c")).alias("clnc")
    )
    h = F.when(F.col("m") > 1, (F.ln("m") - F.col("clnc") / F.col("m")) / F.ln("m")).otherwise(1.0)
    return sums.select(*keys, "m", "kinds", h.alias("h"))


def _branches(path: Column) -> Column:
    """The numbers of all branches that lead to a block, its own the last."""
    parts = F.split(path, ">")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda depth: F.xxhash64(F.array_join(F.slice(parts, F.lit(1), depth), ">")))


def importance(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """host, branch, pages, value: the importance of every branch of every host's style tree.

    blocks: host, path, content. nodes: host, branch, children, a row for each page and
    branch of it. Counts are merged before they move, so one host may hold any share of
    the pages, and only different paths are spread over their branches.
    """
    leaves = _entropy(blocks, ["host", "path"], "content")
    over = leaves.select("host", "m", "h", F.explode(_branches(F.col("path"))).alias("branch"))
    content = over.groupBy("host", "branch").agg((F.sum(F.col("m") * F.col("h")) / F.sum("m")).alias("mean"))
    shown = _entropy(nodes, ["host", "branch"], "children").select("host", "branch", "kinds", F.col("m").alias("pages"), F.col("h").alias("presentation"))
    share = F.pow(F.lit(GAMMA), F.col("kinds"))
    return content.join(shown, ["host", "branch"]).select(
        "host", "branch", "pages", ((1 - share) * F.col("presentation") + share * F.col("mean")).alias("value")
    )


def _numbered(pages: DataFrame) -> DataFrame:
    return pages.select(F.monotonically_increasing_id().alias("page"), F.col("page_id").cast("long"), "url", "html")


def _parsed(pages: DataFrame, with_text: bool) -> DataFrame:
    """One row for each page and for each block, written; texts only of blocks that may stay, or none."""
    rows = _numbered(pages).mapInArrow(_parse, _BLOCKS)
    rows = rows.withColumns({"host": _host(F.col("url")), "content": F.xxhash64("text"), "size": F.length("text"), "branch": F.xxhash64("path")})
    if with_text:
        return materialize(rows.withColumn("text", F.when(F.coalesce("what", F.lit(-1)) != 0, F.col("text"))).drop("nodes", "outer"))
    return materialize(rows.drop("text", "page_id", "url"))


def boilerplate(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, branch) that go, and (host, branch, content) that go inside articles; both written."""
    parsed = _parsed(pages, with_text=False)
    blocks = parsed.filter("seq >= 0")
    inner = blocks.filter("what = 1")
    # One page stands for all copies of its article.
    articles = inner.groupBy("host", "page").agg(F.xxhash64(F.array_sort(F.collect_list(F.xxhash64("path", "content")))).alias("article"))
    stands = materialize(articles.groupBy("host", "article").agg(F.min("page").alias("page")).select("page"))
    ones = inner.join(stands, "page", "left_semi").select("host", "path", "content", "branch", "page")
    every = parsed.filter("seq = -1").join(stands.withColumn("stands", F.lit(True)), "page", "left")
    nodes = every.select("host", F.explode(F.when(F.col("stands"), F.col("nodes")).otherwise(F.col("outer"))).alias("n")).select("host", "n.branch", "n.children")
    columns = ["host", "path", "content"]
    tree = materialize(importance(blocks.filter("what IS NULL OR what = 0").select(*columns).unionByName(ones.select(*columns)), nodes))
    low = tree.filter((F.col("value") < THRESHOLD) & (F.col("pages") >= LEAST_PAGES)).select("host", "branch")
    shown = ones.select("host", "branch", "content", "page").distinct().groupBy("host", "branch", "content").agg(F.count(F.lit(1)).alias("c"))
    repeated = shown.filter("c > 1").join(tree.filter(F.col("pages") >= LEAST_PAGES).select("host", "branch", "pages"), ["host", "branch"])
    repeated = repeated.filter(1 - F.ln("c") / F.ln("pages") < THRESHOLD).select("host", "branch", "content")
    return materialize(low), materialize(repeated)


def _cut(gone) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pages -> their main texts, by the boilerplate of all hosts."""

    def text_of(html: str | None, host: str, low: set, repeated: set) -> str:
        blocks = blocks_of(html)
        numbers: dict[str, int] = {}

        def number(branch: str) -> int:
            if branch not in numbers:
                numbers[branch] = _number(branch)
            return numbers[branch]

        def leads(path: str) -> Iterator[int]:
            parts = path.split(">")
            return (number(">".join(parts[:depth])) for depth in range(1, len(parts) + 1))

        plain = {
            i for i, (path, text, what) in enumerate(blocks)
            if what == 1 and ((host, number(path)) in low or (host, number(path), _number(text)) in repeated)
        }
        if 2 * sum(len(blocks[i][1]) for i in plain) > sum(len(text) for _, text, what in blocks if what == 1):
            plain = set()
        return "\n".join(
            text for i, (path, text, what) in enumerate(blocks)
            if (what == 1 and i not in plain) or (what is None and not any((host, b) in low for b in leads(path)))
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, repeated = gone.value
        for rows in batches:
            for part in (rows.slice(i, 200) for i in range(0, rows.num_rows, 200)):
                texts = [text_of(h, host, low, repeated) for h, host in zip(part.column("html").to_pylist(), part.column("host").to_pylist())]
                yield batch({"page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array(texts, pa.string())})

    return run


def _joined(pages: DataFrame, low: DataFrame, repeated: DataFrame) -> DataFrame:
    """Main texts by joins with the boilerplate, whatever its size; blocks travel to their pages."""
    parsed = _parsed(pages, with_text=True)
    blocks = parsed.filter("seq >= 0")
    inner = blocks.filter("what = 1")
    sized = inner.select("host", "branch", "content", "page", "seq", "size")
    plain = sized.join(low, ["host", "branch"], "left_semi").unionByName(sized.join(repeated, ["host", "branch", "content"], "left_semi"))
    plain = materialize(plain.select("page", "seq", "size").distinct())
    lost = plain.groupBy("page").agg(F.sum("size").alias("lost"))
    lost = sized.join(lost, "page").groupBy("page").agg(F.sum("size").alias("all"), F.max("lost").alias("lost")).filter("2 * lost <= all")
    plain = plain.join(lost, "page", "left_semi").select("page", "seq")
    sure = inner.join(plain, ["page", "seq"], "left_anti").select("page", "seq", "text")
    # Other blocks go with any of their branches; that is found once for each different path.
    open_ = blocks.filter("what IS NULL")
    leads = open_.select("host", "path").distinct().withColumn("branch", F.explode(_branches(F.col("path"))))
    gone = leads.join(low, ["host", "branch"], "left_semi").select("host", "path").distinct()
    kept = sure.unionByName(open_.join(gone, ["host", "path"], "left_anti").select("page", "seq", "text"))
    texts = kept.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("b"))
    texts = texts.select("page", F.array_join(F.transform("b", lambda x: x["text"]), "\n").alias("text"))
    heads = parsed.filter("seq = -1").select("page", "page_id", "url")
    return heads.join(texts, "page", "left").select("page_id", "url", F.coalesce("text", F.lit("")).alias("text"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page.

    Boilerplate of up to SHIPPED entries, counted first, is sent to the tasks, which parse the
    pages once more and write their texts at once; more of it is joined.
    """
    low, repeated = boilerplate(pages)
    if low.count() + repeated.count() <= SHIPPED:
        spark = pages.sparkSession
        sets = tuple({tuple(r) for r in rows.collect()} for rows in (low, repeated))
        gone = spark.sparkContext.broadcast(sets)
        rows = pages.select(F.col("page_id").cast("long"), "url", "html", _host(F.col("url")).alias("host"))
        full = rows.mapInArrow(_cut(gone), "page_id long, url string, text string")
    else:
        full = _joined(pages, low, repeated)
    return full.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
