"""Main text of web pages by deducing each host's template.

A page is read into tokens: its containers, each in its role (the containers
from the root, with their classes, as one number), and its text blocks, each in
the role it stands in.  Tokens of a host that occur equally often on every page -
that share an occurrence vector - form an equivalence class.  Classes that are
large and frequent are valid: nested by their roles they are the template, and
what stands between template tokens are the slots.

* Text blocks of a valid class that stand on nearly all pages are template text
  (menus, notices, repeated lines) and go, wherever they stand.
* The slot of the main text is the innermost template container that holds all
  the text that varies between the host's pages, but for that of other parts:
  elements that HTML itself gives to navigation, forms, asides and page footers,
  and template containers whose class or id names them as such.  It is neither
  inside an article or main element nor in a list, figure or quote.
* A name alone takes nothing out: a container named "notice" that is not part of
  the template is text of its page.  Only a host of too few pages to deduce a
  template from is judged by names.

Occurrence vectors are never put together: a vector is represented by the
number of its pages and sums of a hash of (page, count), which add up in any
order, so a host of any size is spread over all tasks.  What a host's pages are
read with, its template, is no longer than two of its pages.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filelens.llm import common as C
from filelens.operators.skew import skew_join

#: Share of a host's pages that hold a valid class's tokens; tokens of a class.
SUPPORT, CLASS_SIZE = 0.5, 2
#: Share of the pages that hold a template text, and pages from which on a host's template is trusted.
FIXED, MIN_PAGES = 0.9, 5

# HTML element classes, and the names that mark what is not main text.
CONTAINERS = frozenset("html body div article section main nav header footer aside form ul ol dl table figure details dialog "
                       "fieldset menu center blockquote".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption figcaption pre address hr summary option legend hgroup".split())
RAW = frozenset("script style noscript template textarea title svg iframe select button object math canvas audio video".split())
ASIDE_TAGS = frozenset("nav aside form menu dialog fieldset".split())
EDGE = frozenset("header footer masthead banner".split())
ASIDE_NAMES = frozenset(
    "nav menu menubar navbar navigation breadcrumb breadcrumbs sidebar aside widget ad ads advert adverts advertisement adsense sponsor "
    "sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe signup login search "
    "share sharing social related recommended comment comments disqus replies respond pagination pager toolbar skip hidden".split())
#: Names that mark also as the first of several words ("share-buttons"); words that say nothing at the end of a name; words before what is not there.
FIRST_NAMES = frozenset("ad ads advert cookie cookies gdpr nav newsletter sidebar share sharing related recommended comment comments".split())
LAST_WORDS = frozenset("left right top bottom wrapper wrap container box inner outer block section area list content body text".split())
OTHER_WORDS = frozenset("with has no is".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
NO_SLOT_BELOW = frozenset("article main ul ol dl menu figure blockquote".split())
NO_SLOT = frozenset("ul ol dl menu figure blockquote table".split())

_NEXT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_KEYS = frozenset(("class", "id", "role", "hidden", "aria-hidden"))
_NAME = re.compile(r"[a-z0-9]+")


class Container:
    """A container in the tree of the page: ``aside`` if it lies in an element
    that is no main text, ``named`` the roles of the containers around it, and
    its own, that are named so; ``no_slot`` if it is never the main slot, nor,
    with ``below``, what it holds."""

    __slots__ = ("aside", "below", "depth", "main", "named", "no_slot", "role", "tag", "up")

    def __init__(self, tag: str, role: int, up: Container | None, aside: bool, named: tuple[int, ...], main: bool):
        self.tag, self.role, self.up, self.aside, self.named, self.main = tag, role, up, aside, named, main
        self.depth = up.depth + 1 if up else 0
        self.below = up is not None and (up.below or up.tag in NO_SLOT_BELOW)
        self.no_slot = up is None or self.below or tag in NO_SLOT


class Block:
    """A block of text, the container it stands in, and its token."""

    __slots__ = ("at", "key", "text")

    def __init__(self, at: Container, text: str):
        self.at, self.text = at, text
        self.key = _number(f"{at.role} {text}")


def _number(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def _named(names: list[str], tag: str, inside_main: bool) -> bool:
    """Whether a class or id names a part of a page that is no main text: by the
    last word that says something, or the first of those that always do."""
    if tag in ("html", "body", "main"):
        return False
    for name in names:
        words = [w for w in _NAME.findall(name) if not w.isdigit()]
        if "of" in words[1:]:
            words = words[: words.index("of")]
        if not words or words[0] in OTHER_WORDS:
            continue
        first = words[0]
        while len(words) > 1 and words[-1] in LAST_WORDS:
            words.pop()
        if tag == "article":
            if words[-1] in ("comment", "comments"):
                return True
        elif words[-1] in ASIDE_NAMES or first in FIRST_NAMES or words[-1] in EDGE and not inside_main:
            return True
    return False


def _opened(tag: str, attributes: dict[str, str], up: Container) -> Container:
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
    aside = (up.aside or tag in ASIDE_TAGS or tag in EDGE and (tag == "footer" or not up.main) or "hidden" in attributes
             or attributes.get("aria-hidden", "").lower() == "true" or attributes.get("role", "").lower() in ASIDE_ROLES)
    words = sorted({w for name in names for w in _NAME.findall(name) if not any(map(str.isdigit, w))})
    role = _number(f"{up.role} {tag} {'.'.join(words)}")
    named = (*up.named, role) if names and _named(names, tag, up.main) else up.named
    return Container(tag, role, up, aside, named, up.main or tag in ("article", "main"))


def read_page(html: str) -> tuple[list[Block], list[Container]]:
    """Blocks of text and the containers, in page order, the first one the page itself."""
    blocks: list[Block] = []
    opened = [Container("", 0, None, False, (), False)]
    stack, buffer, at = opened[:], [], 0

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            blocks.append(Block(stack[-1], text))

    while m := _NEXT.search(html, at):
        if m.start() > at:
            buffer.append(unescape(html[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        attributes: dict[str, str] = {}
        if html[at : at + 1] != ">":
            while a := _ATTRIBUTE.match(html, at):
                at = a.end()
                if (key := a[1].lower()) in _KEYS:
                    attributes.setdefault(key, a[2] or a[3] or a[4] or "")
        end = html.find(">", at)
        if end < 0:  # the page ends within a tag
            at = len(html)
            break
        at, empty, tag, closes = end + 1, html[end - 1] == "/", m[2].lower(), bool(m[1])
        if tag in RAW:
            if not closes:
                over = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = over.end() if over else len(html)
        elif tag in CONTAINERS:
            flush()
            if closes:
                if any(c.tag == tag for c in stack):
                    while stack.pop().tag != tag:
                        pass
            elif not empty and not (tag in ("html", "body") and any(c.tag == tag for c in stack)):
                stack.append(_opened(tag, attributes, stack[-1]))
                opened.append(stack[-1])
        elif tag in BLOCKS:
            flush()
        elif tag == "br":
            buffer.append(" ")
    if at < len(html):
        buffer.append(unescape(html[at:]))
    flush()
    return blocks, opened


class Template:
    """What the pages of a host are read with: ``frame``, the roles of its
    template containers; ``common``, the text blocks on ``SUPPORT`` of its pages;
    ``fixed``, those of them that are template text; ``main``, the main slot."""

    def __init__(self, pages: int | None = None, frame=(), common=(), fixed=(), main: int | None = None):
        self.pages, self.frame, self.common, self.fixed, self.main = pages or 0, frozenset(frame or ()), frozenset(common or ()), frozenset(fixed or ()), main

    def left_out(self, block: Block) -> bool:
        """Whether a block belongs to the page around the main text: by its
        element, or by a name that the template confirms."""
        return block.at.aside or any(self.pages < MIN_PAGES or role in self.frame for role in block.at.named)


def _inside(containers: list[Container], role: int) -> set[int]:
    """The containers (by ``id``) of a role and all within them."""
    found: set[int] = set()
    for c in containers:  # parents come first
        if c.role == role or id(c.up) in found:
            found.add(id(c))
    return found


def main_text(html: str | None, template: Template) -> str:
    """The blocks of the main slot, without those of other parts and template
    text.  Where a page lacks the slot, or template text is the longer part of
    what stands in it (pages that copy each other), that is not used."""
    if not html:
        return ""
    blocks, containers = read_page(html)
    slot = _inside(containers, template.main) if template.main is not None else set()
    kept = [b for b in blocks if (not slot or id(b.at) in slot) and not template.left_out(b)]
    own = [b for b in kept if b.key not in template.fixed]
    if 2 * sum(len(b.text) for b in own) >= sum(len(b.text) for b in kept):
        kept = own
    return "\n\n".join(b.text for b in kept)


def slot_sums(html: str, template: Template) -> dict[int, tuple[int, bool, int, int]]:
    """Role of each template container of a page to its depth, whether it is
    never the main slot, and the text in it that may be main text: that which
    varies, and any.  Role 0 is the whole page."""
    blocks, containers = read_page(html)
    varying: Counter[int] = Counter()
    whole: Counter[int] = Counter()
    for b in blocks:
        if not template.left_out(b):
            whole[id(b.at)] += len(b.text)
            if b.key not in template.common:
                varying[id(b.at)] += len(b.text)
    out: dict[int, tuple[int, bool, int, int]] = {}
    for c in reversed(containers):  # children come before their parents
        if c.up is not None:
            whole[id(c.up)] += whole[id(c)]
            varying[id(c.up)] += varying[id(c)]
        if c.up is None or c.role in template.frame:
            _, _, v, w = out.get(c.role, (0, False, 0, 0))
            out[c.role] = (c.depth, c.no_slot, v + varying[id(c)], w + whole[id(c)])
    return out


def host_of(url: F.Column) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def page_tokens(pages: DataFrame) -> DataFrame:
    """``host, key, block, vector`` of each distinct token of each page of
    ``host, url, html``: a container's role or a text block's number, and the
    hash of page and count."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts: list[str] = []
        keys: list[int] = []
        block: list[bool] = []
        vectors: list[int] = []
        for host, url, html in zip(*(batch.column(c).to_pylist() for c in ("host", "url", "html")), strict=True):
            blocks, containers = read_page(html)
            tokens = Counter((b.key, True) for b in blocks)
            tokens.update((c.role, False) for c in containers)
            page = _number(f"{url}\n{html}")
            hosts += [host] * len(tokens)
            keys += [k for k, _ in tokens]
            block += [b for _, b in tokens]
            vectors += [_number(f"{page}:{n}") for n in tokens.values()]
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(block, pa.bool_()), pa.array(vectors, pa.int64())],
                                          names=["host", "key", "block", "vector"])

    return C.map_arrow(pages, fn, "host string, key bigint, block boolean, vector bigint", size_of="html")


def templates(pages: DataFrame) -> DataFrame:
    """``host, pages, frame, common, fixed`` of each host of ``host, url, html``.

    The lists are no longer than two pages: each of their tokens stands on
    ``SUPPORT`` of the host's pages.
    """
    tokens = page_tokens(pages).groupBy("host", "key", "block").agg(
        F.count(F.lit(1)).alias("n"), F.expr("bit_xor(vector)").alias("x"), F.sum(F.col("vector").bitwiseAND(0xFFFFFFFF)).alias("s"))
    sizes = C.stored(pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "hosts")
    often = C.stored(skew_join(C.stored(tokens, "tokens"), sizes, ["host"]).where(F.col("n") >= SUPPORT * F.col("pages")), "often")
    valid = F.count(F.lit(1)).over(Window.partitionBy("host", "n", "x", "s")) >= CLASS_SIZE
    fixed = F.col("valid") & (F.col("n") >= FIXED * F.col("pages")) & (F.col("pages") >= MIN_PAGES)
    return often.withColumn("valid", valid).groupBy("host").agg(
        F.max("pages").alias("pages"), F.collect_list(F.when(F.col("valid") & ~F.col("block"), F.col("key"))).alias("frame"),
        F.collect_list(F.when(F.col("block"), F.col("key"))).alias("common"), F.collect_list(F.when(fixed & F.col("block"), F.col("key"))).alias("fixed"))


_PARTS = ("pages", "frame", "common", "fixed")


def _read_with(batch: pa.RecordBatch, *names: str) -> list[Template]:
    """The template of each row; rows of one host that follow each other share it."""
    made: dict[str, Template] = {}
    out = []
    for at, host in enumerate(batch.column("host").to_pylist()):
        if host not in made:
            made[host] = Template(*(batch.column(c)[at].as_py() for c in (*_PARTS, *names)))
        out.append(made[host])
    return out


def main_slots(pages: DataFrame, found: DataFrame) -> DataFrame:
    """``host, main``: the role of the main slot of each host, given its template."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(host, role, *sums) for host, html, template in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), _read_with(batch), strict=True)
                for role, sums in slot_sums(html, template).items()]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "role", "depth", "no_slot", "varying", "any"])

    rows = skew_join(pages.select("host", "html"), found, ["host"], "left")
    sums = C.map_arrow(rows, fn, "host string, role bigint, depth int, no_slot boolean, varying bigint, any bigint", size_of="html")
    sums = C.stored(sums.groupBy("host", "role").agg(F.max("depth").alias("depth"), F.max("no_slot").alias("no_slot"), F.sum("varying").alias("varying"),
                                                      F.sum("any").alias("any")), "sums")
    whole = sums.where("role = 0").select("host", F.col("varying").alias("all_varying"), F.col("any").alias("all_any"))
    # what counts is the text that varies; on hosts where none does (one page, say) all text
    fit = sums.where("role <> 0 AND NOT no_slot").join(whole, "host").where(
        (F.col("varying") == F.col("all_varying")) & ((F.col("all_varying") > 0) | (F.col("any") == F.col("all_any"))))
    return fit.groupBy("host").agg(F.max_by("role", F.struct("depth", "any", "role")).alias("main"))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    Blocks of the main slot in page order, joined by an empty line; white
    space inside a block is one space, character references are decoded.  A
    null or empty page, or one without main text, gives the empty string; a
    null url is a host of its own name "".  Every input row gives one row;
    other columns are not read.
    """
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    plain = rows.select("host", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), "html")
    found = C.stored(templates(plain), "templates")
    found = C.stored(found.join(main_slots(plain, found), "host", "left"), "slots")
    joined = skew_join(rows, found, ["host"], "left").select("page_id", "url", "host", "html", *_PARTS, "main")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h, t) for h, t in zip(batch.column("html").to_pylist(), _read_with(batch, "main"), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])

    return C.map_arrow(joined, fn, "page_id bigint, url string, text string, n_chars bigint", size_of="html")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_text(C.table(spark, sf_dir, "pages"))
