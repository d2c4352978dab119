"""Main text of web pages: element subtrees that recur across a host's pages are its template and go."""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import materialise, read_table

#: A subtree is of the template if it stands on so many pages of its host whose other running text differs.
LEAST_PAGES = 5
#: As above, for an element that a class or id marks: the words are only a hint.
LEAST_PAGES_MARKED = 2
#: Recurring subtrees that are sent to all tasks at most: some 40 MB there.
MOST_SENT = 500_000

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([A-Za-z:_-][\w:.-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_set = lambda words: frozenset(words.split())

# Fixed values of HTML: elements without content, with raw content, that begin a block, and what a start tag closes.
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style textarea title xmp noembed noframes iframe")
BLOCK = _set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul"
)
_CLOSES = {
    "li": (_set("li"), _set("ul ol menu dir")),
    "dt": (_set("dt dd"), _set("dl")),
    "dd": (_set("dt dd"), _set("dl")),
    "tr": (_set("tr td th"), _set("table")),
    "td": (_set("td th"), _set("tr table")),
    "th": (_set("td th"), _set("tr table")),
    "tbody": (_set("thead tbody tfoot tr td th"), _set("table")),
    "option": (_set("option"), _set("select")),
}
_P, _P_SCOPE, _NONE, _WHOLES = _set("p"), _set("div section article td th li blockquote table body main aside"), frozenset(), _set("article main body")
#: Elements whose content is no text to be read.
UNREAD = _set(
    "head script style noscript template iframe object embed applet svg math canvas audio video map button select option input textarea datalist progress meter "
    "noembed noframes"
)
#: Elements and roles that are no main text; they go by the counts of their host like all others, or else by these lists.
LISTED = _set("form fieldset label nav menu aside footer dialog")
ROLES = _set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist tooltip")
#: Words of a class or id that hint at what is no main text; the counts by host decide.
MARKS = _set(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidenav side aside footer foot header masthead banner cookie cookies consent gdpr notice "
    "notices notification alert ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion newsletter subscribe subscription "
    "popup modal overlay share sharing social comment comments commentlist respond reply replies disqus discussion related recommended recommendations widget widgets "
    "toolbar pagination pager login signup search skip hidden"
)
#: Running text, which never counts as a template on its own.
PROSE = _set("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr figcaption caption summary")
#: By these a page is told from others: the texts outside a subtree.
TELLING = _set("p h1 h2 h3 h4 h5 h6 blockquote pre")
#: An article is marked only by these; a name such as with-sidebar marks the element around a sidebar.
ARTICLE_MARKS = _set("ad advert advertisement comment comments promo related reply respond sponsored widget")
_MARK_WORDS = re.compile(r"(?<![A-Za-z])(?<!with[-_])(?<!has[-_])(?<!no[-_])[A-Za-z]+")


@dataclass
class Node:
    """An open element; what is inherited from the element around it comes first."""

    tag: str
    unread: bool = False
    listed: bool = False  # it or an element around it is of ``LISTED`` or ``ROLES``
    in_article: bool = False
    in_main: bool = False
    telling: bool = False  # it or an element around it is of ``TELLING``
    hinted: bool = False  # it or an element around it is marked
    parts: list = field(default_factory=list)  # hashes and texts of what is inside, in order; those of the block element around an inline one
    inner: list = field(default_factory=list)  # blocks (as numbers below 0) and subtrees inside that lie in no other subtree inside
    kind: str = ""
    heading: bool = False
    marked: bool = False
    names: bool = False  # its tag or role says that it is no main text
    attributes: str = ""


def _is_marked(tag: str, attributes: str) -> bool:
    if not attributes or tag in ("html", "body", "main"):
        return False
    words = ARTICLE_MARKS if tag == "article" else MARKS
    found = (value.strip("\"'").lower() for name, value in _ATTRIBUTE.findall(attributes) if name.lower() in ("class", "id"))
    return any(not words.isdisjoint(_MARK_WORDS.findall(value)) for value in found)


def _is_hidden(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether attributes hide an element, and whether its role is of ``ROLES``."""
    if not attributes or tag in ("html", "body", "main"):
        return False, False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role":
            if value in ROLES:
                return False, True
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, False
    return False, False


class Block(NamedTuple):
    """A text; ``level`` is 2 in an article, 1 in the main element, 0 outside, -1 in a marked element, -2 in a listed one."""

    text: str
    level: int
    inside: bool  # in the main element or an article
    telling: bool  # running text, by which the page is told from others


class Page:
    """One page, read once from start to end: its blocks of text, and the subtrees that each stands in.

    ``subtrees`` has hashes of tags and texts, whose last bit says whether the element is
    marked, ``above`` the number of the subtree around each, ``of_block`` that around each
    block; -1 is none. A subtree's number is above those of the subtrees in it. Each tag
    and text takes constant time, so a page of any depth is read in time linear in its length.
    """

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.subtrees: list[int] = []
        self.above: list[int] = []
        self.of_block: list[int] = []
        self.loose: list[int] = []  # those that count only outside the article or main element of a page that has one
        self.texts: list[str] = []
        self.open_tags: Counter = Counter()
        self.stack = [Node("")]
        self.in_main = False  # whether the main element has text
        self._read(source)
        if not any(b.inside and b.level > -2 for b in self.blocks):
            for n in self.loose:
                self.subtrees[n] = 0

    def _flush(self) -> None:
        if not self.texts:
            return
        text = " ".join(html.unescape("".join(self.texts)).split())
        self.texts.clear()
        if text:
            top = self.stack[-1]
            top.parts.append(text)
            level = -2 if top.listed else -1 if top.hinted else 2 if top.in_article else 1 if top.in_main else 0
            inside = top.in_article or top.in_main
            self.blocks.append(Block(text, level, inside, (inside or top.telling) and not top.listed))
            self.in_main = self.in_main or top.in_main and not top.listed
            self.of_block.append(-1)
            top.inner.append(-len(self.blocks))

    def _open(self, tag: str, attributes: str) -> None:
        top = self.stack[-1]
        kind = tag if tag in ("article", "main") else "main" if "role" in attributes and re.search(r"role\s*=\s*[\"']?main\b", attributes) else ""
        marked = _is_marked(tag, attributes)
        hidden, by_role = _is_hidden(tag, attributes)
        listed = by_role or tag in LISTED or tag == "header" and not (top.in_article or top.in_main)
        self.open_tags[tag] += 1
        self.stack.append(
            Node(
                tag,
                top.unread or hidden or tag in UNREAD,
                top.listed or listed,
                top.in_article or kind == "article",
                top.in_main or kind == "main",
                top.telling or tag in TELLING,
                top.hinted or marked,
                [] if tag in BLOCK else top.parts,
                kind=kind,
                marked=marked,
                names=listed,
                attributes=attributes,
            )
        )

    def _subtree(self, digest: int, inner: list[int]) -> list[int]:
        number = len(self.subtrees)
        self.subtrees.append(digest)
        self.above.append(-1)
        for n in inner:
            if n < 0:
                self.of_block[-n - 1] = number
            else:
                self.above[n] = number
        return [number]

    def _close(self) -> None:
        node = self.stack[-1]
        if node.tag in BLOCK:
            self._flush()
        self.stack.pop()
        self.open_tags[node.tag] -= 1
        above = self.stack[-1]
        above.heading = above.heading or node.heading or node.tag == "h1"
        if node.tag in BLOCK and (node.parts or node.unread):
            digest = xxhash.xxh64_intdigest("\0".join([node.tag, *map(str, node.parts)])) - (1 << 63)
            above.parts.append(digest)
            loose = node.tag in PROSE and not node.marked and not (node.in_article or node.in_main)
            counted = node.marked or loose or node.tag not in PROSE and not node.kind
            if node.inner and counted and not node.heading and node.tag not in ("html", "body", "h1"):
                node.inner = self._subtree(digest & ~1 | node.marked, node.inner)
                if loose:
                    self.loose += node.inner
                if (node.marked or node.names) and not (node.in_article or node.in_main):  # it recurs by its tag and attributes too
                    node.inner = self._subtree((xxhash.xxh64_intdigest(f"{node.tag}\1{node.attributes}") - (1 << 63)) & ~1, node.inner)
                    if not node.names:
                        self.loose += node.inner
        if len(above.inner) < len(node.inner):  # the shorter list goes into the longer one
            above.inner, node.inner = node.inner, above.inner
        above.inner += node.inner

    def others(self) -> dict[int, int]:
        """For each subtree, a sum of hashes of the page's running text outside it; of all texts not listed on a page without any."""
        every = not any(b.telling for b in self.blocks)
        total, inside, found = 0, [0] * len(self.subtrees), {}
        for block, n in zip(self.blocks, self.of_block):
            if block.telling or every and block.level > -2:
                digest = xxhash.xxh64_intdigest(block.text)
                total += digest
                if n >= 0:
                    inside[n] += digest
        for n, subtree in enumerate(self.subtrees):
            if self.above[n] >= 0:
                inside[self.above[n]] += inside[n]
            if subtree:
                found[subtree] = found.get(subtree, 0) + inside[n]
        return {k: ((total - v) & ((1 << 64) - 1)) - (1 << 63) for k, v in found.items()}

    def packed(self) -> str:
        """The blocks that may be main text, and the subtrees, as JSON."""
        kept = [(b.text, b.level == -2, n) for b, n in zip(self.blocks, self.of_block) if b.inside or not self.in_main]
        return json.dumps([kept, self.subtrees, self.above], ensure_ascii=False)

    def _close_to(self, tags: frozenset, scope: frozenset) -> None:
        """Close the lowest open element of ``tags`` and all in it, unless one of ``scope`` is lower."""
        if not any(self.open_tags[t] for t in tags):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in tags:
                while len(self.stack) > k:
                    self._close()
                return
            if self.stack[k].tag in scope:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            if tag in _CLOSES:
                self._close_to(*_CLOSES[tag])
            self._close_to(_P, _P_SCOPE)
            if tag[0] == "h" and tag[1:].isdigit() and self.stack[-1].tag[:1] == "h" and self.stack[-1].tag[1:].isdigit():
                self._close()
            self._flush()
        if tag in VOID:
            if tag == "br" or tag == "wbr":
                self.texts.append(" " if tag == "br" else "")
        else:
            self._open(tag, attributes)

    def _read(self, source: str) -> None:
        at, find = 0, _TAG.search
        while True:
            m = find(source, at)
            text = source[at : m.start() if m else len(source)]
            if text and not self.stack[-1].unread:
                self.texts.append(text)
            elif text and not text.isspace():
                self.stack[-1].parts.append(" ".join(text.split()))
            if not m:
                break
            at, closing, tag, attributes = m.end(), m[1] or m[4], (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
            if not tag:
                continue
            if closing:
                if tag in ("p", "br"):
                    self._flush()
                self._close_to(frozenset((tag,)), _NONE if tag in ("article", "main", "body", "html") else _WHOLES)
            else:
                self._start(tag, attributes)
                if tag in RAW and tag not in VOID:
                    end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                    at = end.end() if end else len(source)
                    self._close()
        while len(self.stack) > 1:
            self._close()
        self._flush()


def read_pages(pages: DataFrame, page: str = "html", url: str = "url", id_col: str = "page_id") -> DataFrame:
    """``page_id, url, host, subtrees, blocks`` for each row; null pages are empty, a null url has an empty host.

    ``blocks`` are packed: they are written and shuffled, and so take less disk than the pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                rows = batch.slice(k, 64)
                subtrees, blocks = [], []
                for value in rows.column(3):
                    found = Page(value.as_py() or "")
                    other = found.others()
                    subtrees.append([{"subtree": k, "other": other[k]} for k in sorted(other)])
                    blocks.append(pack(found.packed().encode("utf-8", "surrogatepass")))
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(subtrees, pair), pa.array(blocks, pa.binary())], names=names)

    pair = pa.list_(pa.struct([("subtree", pa.int64()), ("other", pa.int64())]))
    names = ["page_id", "url", "host", "subtrees", "blocks"]
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(page).alias("html"))
    kinds = f"page_id {source.schema['page_id'].dataType.simpleString()}, url string, host string"
    return source.mapInArrow(run, f"{kinds}, subtrees array<struct<subtree:long,other:long>>, blocks binary")


def _texts(by_lists: bool, of_host=None):
    """``page_id, url, text, n_template, n_listed`` of packed blocks and the subtrees that go, or the host whose subtrees go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                rows, found, counts = batch.slice(k, 64), [], [[], []]
                for packed, gone in zip(rows.column(2), rows.column(3).to_pylist()):
                    gone = of_host.value.get(gone, ()) if of_host else gone
                    blocks, subtrees, above = json.loads(unpack(packed.as_py()).decode("utf-8", "surrogatepass"))
                    gone = gone if isinstance(gone, frozenset) else set(gone or ())
                    goes = [x in gone for x in subtrees]
                    for n in range(len(above) - 1, -1, -1):  # the one around a subtree has a higher number
                        goes[n] = goes[n] or above[n] >= 0 and goes[above[n]]
                    template = [n >= 0 and goes[n] for _, _, n in blocks]
                    listed = [by_lists and x and not t for (_, x, _), t in zip(blocks, template)]
                    found.append("\n\n".join(b[0] for b, t, x in zip(blocks, template, listed) if not t and not x))
                    counts[0].append(sum(template))
                    counts[1].append(sum(listed))
                columns = [*rows.columns[:2], pa.array(found, pa.string()), *(pa.array(c, pa.int64()) for c in counts)]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_template", "n_listed"])

    return run


def recurring_subtrees(parsed: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host, subtree`` of those that stand on so many pages of their host whose other running text differs."""
    different = parsed.select("host", F.explode("subtrees").alias("x")).select("host", "x.*").distinct()
    counts = different.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.col("n") >= least_pages) | F.expr(f"(subtree & 1) = 1 AND n >= {LEAST_PAGES_MARKED}")).select("host", "subtree")


def extract_text(pages: DataFrame, page: str = "html", url: str = "url", id_col: str = "page_id", least_pages: int = LEAST_PAGES, by_lists: bool = True, most_sent: int = MOST_SENT) -> DataFrame:
    """``page_id, url, text, n_template, n_listed`` for each row.

    Blocks are those of the main element and of articles where the page has a main element
    with text, else those of the body, without what is no text (scripts, controls).
    A block goes if a subtree around it recurs on at least ``least_pages`` pages of its
    host that differ in their other running text, however many pages the host has: the
    copies of a page count once. All subtrees are counted over all pages, menus and
    footers like any other, with partial counts before each shuffle; running text,
    headings and what holds the main heading don't count as subtrees, so copied articles
    stay. Outside the article of a page that has one running text does count. Menus,
    footers and other elements whose tag or role says what they are, and which a host
    often fills anew for each page, are counted without their text as well, by tag and
    attributes. Elements marked by words of their class or id go if they recur on
    ``LEAST_PAGES_MARKED`` such pages; beside an article they also go, whatever their
    text, if their tag and attributes recur on ``least_pages``. Else they stay.

    What the counts leave, as on a host of few pages, goes by ``LISTED`` and ``ROLES``,
    elements that are never main text, unless ``by_lists`` is off. ``n_template`` and
    ``n_listed`` are the blocks that went either way.

    Up to ``most_sent`` recurring subtrees, which are counted first, are sent to all tasks,
    so that no text is shuffled; beyond that their table joins by host and hash. A null page is empty, a page
    without text has an empty one, a null or odd url has an empty host; rows come out as
    often as they go in; other columns are not read; an empty table gives no rows.
    """
    parsed = materialise(read_pages(pages, page, url, id_col).withColumn("row", F.monotonically_increasing_id()), "parsed")
    often = materialise(recurring_subtrees(parsed, least_pages), "templates")
    kind = parsed.schema["page_id"].dataType.simpleString()
    made = f"page_id {kind}, url string, text string, n_template long, n_listed long"
    if often.count() <= most_sent:
        by_host = {r.host: frozenset(r.gone) for r in often.groupBy("host").agg(F.collect_list("subtree").alias("gone")).collect()}
        shared = pages.sparkSession.sparkContext.broadcast(by_host)
        return parsed.select("page_id", "url", "blocks", "host").mapInArrow(_texts(by_lists, shared), made)
    around = parsed.select("row", "host", F.explode("subtrees.subtree").alias("subtree"))
    gone = around.join(often, ["host", "subtree"]).groupBy("row").agg(F.collect_set("subtree").alias("gone"))
    gone = materialise(gone, "gone")  # a row for each page with a template around a block, as many hashes as the page has
    joined = parsed.join(gone, "row", "left").select("page_id", "url", "blocks", "gone")
    return joined.mapInArrow(_texts(by_lists), made)


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_template", "n_listed")
