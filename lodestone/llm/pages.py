"""HTML extraction (operator 10): a style tree per site finds branches that all pages share; they are removed.

Every page is parsed leniently (implied end tags, raw text of scripts and styles, unclosed tags, references), in time and
memory linear in its length, however deep it is nested. The DOMs of one host are merged by path: a node is a block
element, its path the chain of block tags with first class and id. Over the pages that have it, the entropies of its
presentation (the styles of its children) and of its content (the text of the whole branch, so that variety in a
descendant counts for all nodes above it) are divided by the logarithm of their number, so 0 means always the same and 1
always different. Importance = GAMMA * content + (1 - GAMMA) * presentation. A path with text on at least PAGES different
pages of its host with an importance below LEAST is a low branch and is removed, inside an article or main element too.

So are, at any number of pages, elements (inline ones too) with a tag, whole class name, whole id or role that names menus,
headers, footers, sidebars, notices, adverts, forms and comments. Those that can stand for a part of the text too (related,
legal, notice, dialog ...) count outside an article or main element only, inside the style tree decides. A page whose only
article or main stands below an element with the name of a layout part (a sidebar, banner, form ...) keeps that article.
If nothing would be left, the low branches stay.

Blocks are the text between block-level tags, white space folded to one space; br counts as white space.

Defined cases: null and empty html give an empty text; text without tags is one block; a null or hostless url joins no
style tree; repeated rows give a row each and count once in the style tree; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm._shared import read, ship, slices, written

ship(__name__)

GAMMA = 0.9
PAGES = 5
LEAST = 0.25
BROADCAST_ROWS = 200_000
PAGES_PER_PART = 50_000

# fixed values: element kinds of the HTML standard, and names of noise
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td
    tfoot th thead title tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
NOISE_TAGS = frozenset("nav footer aside form script style noscript iframe svg button select template head title textarea noembed noframes canvas audio video map xmp input".split())
#: Noise outside an article or main element only; inside, the style tree decides.
OUTER_TAGS = frozenset("header menu search dialog object label".split())
#: Whole class names and ids, without hyphens and underscores.
NOISE_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense adbanner adbox adcontainer adslot adunit adwrapper banner banners bannerad
    breadcrumb breadcrumbs breadcrumbnav comments commentlist commentform commentsarea commentssection commentsection commentslist consent cookiebanner cookiebar
    cookieconsent cookienotice cookiepopup disqus disqusthread footer mainfooter pagefooter sitefooter gdpr masthead mainmenu mainnav mainnavigation menubar modal
    nav navbar navigation navmenu sitenav sitenavigation topmenu topnav newsletter newsletterbox newsletterform newslettersignup pager pagination popup promos
    promoted sharebar sharebox sharebuttons sharelinks sidebar sidebars leftsidebar rightsidebar signup skiplink socialbar socialbuttons socialicons sociallinks
    socialshare sponsored subscribe toolbar widget widgets relatedarticles relatedlinks relatedposts relatedstories recommendedarticles recommendedposts""".split()
)
#: Names that can stand for a part of the text as well, so outside an article or main element only.
OUTER_NAMES = frozenset(
    """alert comment cookie cookies copyright disclaimer head header legal login menu menus mainheader notice notices pageheader promo recommended related search
    searchbar searchbox searchform share sharing siteheader skip social sponsor sponsors subscription tags taglist teaser teasers""".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo menubar".split())
OUTER_ROLES = frozenset("complementary search dialog alert alertdialog menu form".split())
#: Parts of a layout that can hold the whole article: not readers' comments, menus or lists of other articles.
LAYOUT = frozenset("form sidebar sidebars leftsidebar rightsidebar navbar toolbar widget widgets modal popup banner masthead header head mainheader pageheader siteheader search notice notices promo".split())
HEAD_PARTS = frozenset("base link meta title script style noscript template".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
_FENCE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}
#: End tags and implied ends of p do not reach beyond these, but for parts of tables.
_SCOPE = frozenset("table caption td th object template button".split())
_TABLE = frozenset("table caption tbody thead tfoot tr td th".split())
_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][^\s=/>"']*+)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))|([a-zA-Z][^\s=/>"']*+)""")
#: Their ids are slugs of their words.
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_KEPT_IN = frozenset({"article", "main"})
_MASK = (1 << 64) - 1
CLEAN, NAMED, NOISE = 0, 1, 2


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _folded(state: int, value: int) -> int:
    """The state of a running hash after one more value."""
    x = ((state * 0x9E3779B97F4A7C15 + value) ^ (state >> 29)) & _MASK
    return ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _MASK


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault((m[1] or m[5]).lower(), m[2] or m[3] or m[4] or "")
    return out


def _noise(tag: str, attributes: dict[str, str], inside: bool) -> int:
    """NOISE, NAMED (noise, but a part of the layout that could hold the article) or CLEAN."""
    if tag in NOISE_TAGS or (not inside and tag in OUTER_TAGS):
        return NAMED if tag in LAYOUT else NOISE
    if not attributes:
        return CLEAN
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return NOISE
    role = attributes.get("role", "").strip().lower()
    if role in NOISE_ROLES or (not inside and role in OUTER_ROLES):
        return NAMED if role in LAYOUT else NOISE
    if tag in ("body", "html", "article", "main"):
        return CLEAN
    named = attributes.get("class", "") if tag in _HEADINGS else f"{attributes.get('class', '')} {attributes.get('id', '')}"
    names = {n.replace("-", "").replace("_", "") for n in named.lower().split()}
    names = (names & NOISE_NAMES) | (set() if inside else names & OUTER_NAMES)
    return CLEAN if not names else NAMED if names <= LAYOUT else NOISE


@dataclass(slots=True)
class _Element:
    tag: str
    path: int
    noise: int
    inside: bool  # of an article or main
    low: bool
    at: int  # of the nearest block element, itself included
    sign: str = ""
    look: int = 0
    content: int = 0
    last: str = ""
    told: bool = False


class Page:
    """blocks: (text without low branches, text with them, whether it is a rescued article's); styles: path -> [presentation, content] of nodes with text."""

    def __init__(self, html: str, low: frozenset[int] = frozenset(), stats: bool = False) -> None:
        self.blocks: list[tuple[str, str, bool]] = []
        self.styles: dict[int, list[int]] = {}
        self.has_article = False
        self._low = low
        self._stats = stats
        self._stack = [_Element("", 0, CLEAN, False, False, 0)]
        self._at: dict[str, list[int]] = {}
        self._text: list[tuple[str, bool, bool]] = []  # text, low, rescued
        self._parse(html)

    def _last(self, tags: frozenset[str] | set[str]) -> int:
        """Where in the stack the innermost of the tags is open; 0 if none is."""
        return max((places[-1] for t in tags if (places := self._at.get(t))), default=0)

    def _flush(self) -> None:
        if not self._text:
            return
        whole = " ".join("".join(t for t, _, _ in self._text).split())
        if whole:
            rescued = any(r for _, _, r in self._text)
            kept = " ".join("".join(t for t, low, _ in self._text if not low).split()) if any(low for _, low, _ in self._text) else whole
            self.blocks.append((kept, whole, rescued))
            node = self._stack[self._stack[-1].at]
            self.has_article |= node.inside and not rescued
            if self._stats:
                node.content, node.told = _folded(node.content, _hash(whole)), True
        self._text.clear()

    def _cut(self, size: int) -> None:
        """Closes what is open from `size` on."""
        stack = self._stack
        while len(stack) > size:
            e = stack.pop()
            self._at[e.tag].pop()
            if self._stats and e.at == len(stack) and e.told:
                above = stack[stack[-1].at]
                above.content, above.told = _folded(above.content, e.content), True
                both = self.styles.setdefault(e.path, [0, 0])
                both[0], both[1] = _folded(both[0], e.look), _folded(both[1], e.content)

    def _open(self, tag: str, attributes: dict[str, str]) -> None:
        stack = self._stack
        parent = stack[-1]
        inside = parent.inside or tag in _KEPT_IN
        own = _noise(tag, attributes, inside)
        noise = NOISE if parent.noise == NOISE or (own and parent.inside) or (own and parent.noise) else parent.noise or own
        if tag in BLOCKS:
            sign = f"{tag}.{attributes.get('class', '').split(' ')[0]}#{attributes.get('id', '')}" if attributes else tag
            path = _hash(f"{parent.path}>{sign}")
            if self._stats:
                above = stack[parent.at]
                if above.last != sign:
                    above.look, above.last = _folded(above.look, _hash(sign)), sign
            stack.append(_Element(tag, path, noise, inside, parent.low or path in self._low, len(stack), sign))
        else:
            stack.append(_Element(tag, parent.path, noise, inside, parent.low, parent.at))
        self._at.setdefault(tag, []).append(len(stack) - 1)

    def _close(self, tag: str) -> None:
        places = self._at.get(tag)
        if not places:
            return
        fence = self._stack[-1].at - 1 if tag not in BLOCKS else 0 if tag in _TABLE else self._last(_SCOPE - {tag})
        if places[-1] > fence:
            self._cut(places[-1])

    def _parse(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            m = _TAG.search(html, at)
            if m is None:
                self._add(html[at:])
                break
            if m.start() > at:
                self._add(html[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            closing, rest = (m[1] if m[2] else m[4]) == "/", m[3] or m[6] or ""
            if tag in BLOCKS:
                self._flush()
            elif tag == "br":
                self._add(" ")
            if closing:
                self._close(tag)
                continue
            if tag not in HEAD_PARTS and self._at.get("head"):
                self._cut(self._at["head"][-1])
            if tag in BLOCKS and (p := self._at.get("p")) and p[-1] > self._last(_SCOPE):
                self._cut(p[-1])
            if tag in CLOSES:
                fence = self._last(_FENCE[tag])
                open_ = [places[k] for t in CLOSES[tag] if (places := self._at.get(t)) for k in (-1,) if places[-1] > fence]
                if open_:
                    self._cut(min(open_))
            if tag in VOID:
                continue
            attributes = _attributes(rest) if rest and not rest.isspace() and rest != "/" else {}
            if tag in RAW:
                end = _raw_end(tag).search(html, at)
                at = end.end()
                continue
            self._open(tag, attributes)
        self._flush()
        self._cut(1)

    def _add(self, text: str) -> None:
        top = self._stack[-1]
        if top.noise == CLEAN or (top.noise == NAMED and top.inside):
            self._text.append((unescape(text) if "&" in text else text, top.low, top.noise == NAMED))

    def text(self) -> str:
        good = [b for b in self.blocks if not (b[2] and self.has_article)]
        kept = [b[0] for b in good if b[0]]
        return "\n\n".join(kept if kept else [b[1] for b in good])


@lru_cache(maxsize=32)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*+>|\Z", re.I)


def host_of(url: str) -> Column:
    return F.regexp_extract(F.lower(F.coalesce(F.col(url).cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def _styles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (some for whole in batches for some in slices(whole, "html", 4 << 20)):
        hosts, pages, paths, looks, contents = [], [], [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = _hash(html)
            for path, (look, content) in Page(html, stats=True).styles.items():
                hosts.append(host)
                pages.append(page)
                paths.append(path)
                looks.append(look - (1 << 63))
                contents.append(content - (1 << 63))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array(x, pa.int64()) for x in (pages, paths, looks, contents))], names=["host", "page", "path", "look", "content"])


def low_branches(rows: DataFrame, gamma: float = GAMMA, pages: int = PAGES, least: float = LEAST) -> DataFrame:
    """(host, path) of the element nodes of each host's style tree whose importance is low."""
    parsed = rows.filter("host <> ''").select("host", "html").mapInArrow(_styles, "host string, page long, path long, look long, content long")
    styles = written(parsed.dropDuplicates(["host", "page", "path"]), "styles")
    sizes = styles.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= pages)

    def entropy(column: str) -> DataFrame:
        counts = styles.groupBy("host", "path", column).agg(F.count(F.lit(1)).alias("c"))
        return counts.groupBy("host", "path").agg(F.sum(F.col("c") * F.log("c")).alias(f"_{column}"))

    both = sizes.join(entropy("look"), ["host", "path"]).join(entropy("content"), ["host", "path"])
    part = lambda c: 1 - F.col(c) / (F.col("n") * F.log("n"))
    return both.filter(gamma * part("_content") + (1 - gamma) * part("_look") < least).select("host", "path")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (some for whole in batches for some in slices(whole, "html", 4 << 20)):
        texts = [Page(html, frozenset(low or ())).text() for html, low in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host_of("url").alias("host"))
    low = written(low_branches(rows).groupBy("host").agg(F.collect_list("path").alias("low"), F.count(F.lit(1)).alias("n")), "low")
    size = low.agg(F.sum("n")).first()[0] or 0
    low = low.drop("n")
    if size <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(low), "host", "left")
    else:  # a host's pages are dealt over several keys, so that none gathers the pages of a large host
        parts = 1 + pages.count() // PAGES_PER_PART
        dealt = rows.withColumn("_part", F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(parts)))
        low = low.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        joined = dealt.join(low, ["host", "_part"], "left")
    return joined.select("page_id", "url", "html", "low").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
