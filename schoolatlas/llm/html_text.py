"""Main text of web pages by site template removal.

Each page is parsed once into blocks of text and the block-level elements they stand in.  Every
element gets two hashes of its subtree: of its tags and text, and of its skeleton (tags, classes, ids
and whether there is text, without the text, digits and the number of like neighbours), since menus,
adverts and footers keep their form while their words change from page to page.  Spark counts per
host on how many distinct pages each subtree stands, and the blocks inside a subtree that recurs are
deleted:

* inside ``article`` or ``main``, same text on ``MIN_PAGES`` pages and ``PAGE_SHARE`` of the host's;
* elsewhere, same text on ``MIN_PAGES`` pages and that share, or on ``MANY_PAGES`` pages of a large host;
* elsewhere, same skeleton on as many pages, if the page has an ``article`` or ``main`` (and the
  element doesn't hold it) or if most of the element's text is in links.

What the count cannot tell (hosts of few pages) is left to the markup: ``lists`` drops blocks by
tag, role and class, and of a page with an ``article`` or ``main`` keeps what stands in it.

Counting is pre-aggregated in the map tasks and keyed by (host, page, subtree), then by (host,
subtree), so a large host does not gather in a task; copies of a page count once.

Text: character references are decoded, white space in a block becomes one space, blocks are
trimmed and joined in page order by one space.

Defined cases: null or empty html gives an empty text; a page whose url has no host has no
template; unclosed elements end with their parent; elements nest to any depth; stray end tags and a
``<`` that opens no tag are ignored and text; an unclosed script or comment runs to the end; a very
long page is parsed whole in one task, in memory of some ten times its size; repeated rows get
the same text each; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schoolatlas.llm.common import ship, store

MIN_PAGES = 5
PAGE_SHARE = 0.5
#: Outside the main part so many pages of a host are enough, whatever share that is.
MANY_PAGES = 50
#: An element with at least this share of its characters in links is no content.
LINK_SHARE = 0.6
#: What a subtree's hash stands for.
MAIN_TEXT, OTHER_TEXT, SKELETON = 0, 1, 2

ship(__name__)

# Elements of HTML by the part they play.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head nav menu aside footer form dialog button select datalist fieldset label input audio video canvas object "
    "embed map applet frameset".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial adslot adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar sidenav widget widgets footer header masthead topbar "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended comment comments commentlist disqus respond reply replies discussion "
    "form search pagination pager skip".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the first closes an open element of the second, up to an element of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"})}
CLOSES |= {t: ({"dt", "dd"}, {"dl"}) for t in ("dt", "dd")} | {t: ({"td", "th"}, {"tr", "table"}) for t in ("td", "th")}

_TOKEN = re.compile(
    r"""<(?:
        !--(?:>|->|.*?(?:--!?>|\Z))
      | (?P<raw>script|style|noscript|template|title|textarea|iframe|svg|noembed|noframes|xmp)\b
            (?:[^>"']|"[^"]*"|'[^']*')*?(?:/>|>.*?(?:</(?P=raw)\b[^>]*>|\Z))
      | (?P<end>/)?(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>"']|"[^"]*"|'[^']*')*|[^>]*)(?:>|\Z)
      | [!?/][^>]*(?:>|\Z)
    )""",
    re.IGNORECASE | re.DOTALL | re.VERBOSE,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z]+|[0-9]+")
_HUMP = re.compile("([a-z])([A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _unwanted(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether an element goes by its tag, role, class or id."""
    if tag in DROPPED:
        return True
    if not attributes or attributes.isspace() or tag in ("html", "body", "article", "main"):
        return tag == "header" and not in_main
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")):
        return True
    if found.get("role", "").lower() in DROPPED_ROLES:
        return True
    if tag == "header" and not in_main:
        return True
    names = found.get("class", "") + " " + found.get("id", "")
    parts = _NAME.findall(names.lower()) + _NAME.findall(_HUMP.sub(r"\1 \2", names).lower())
    # An article's own header holds its title.
    return not DROPPED_NAMES.isdisjoint(p for p in parts if not (in_main and p == "header"))


class _Element:
    __slots__ = ("block", "digest", "first", "header", "is_block", "last", "links", "main", "skeleton", "tag", "unwanted", "with_main")

    def __init__(self, tag: str, unwanted: bool, main: bool, header: bool, parent: _Element | None, names: str, first: int):
        self.tag, self.unwanted, self.main, self.header = tag, unwanted, main, header
        self.is_block = tag in BLOCK or parent is None
        #: The nearest block-level element, itself included.
        self.block = self if self.is_block else parent.block
        self.digest = hashlib.blake2b(tag.encode(), digest_size=8)
        self.skeleton = hashlib.blake2b(f"{tag} {names}".encode("utf-8", "replace"), digest_size=8)
        #: Its first block, its characters within links, the last part of its skeleton, and whether the main part is in it.
        self.first, self.links, self.last, self.with_main = first, 0, b"", main

    def form(self, part: bytes) -> None:
        """Add a part of the skeleton; like neighbours count once."""
        if part != self.last:
            self.skeleton.update(part)
            self.last = part


def _names(attributes: str) -> str:
    """Classes, id and role without digits."""
    found = [m for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() in ("class", "id", "role")] if attributes else []
    return " ".join(re.sub(r"[0-9]+", "", (m[2] or m[3] or m[4] or "").lower()) for m in found)


class Page:
    """A page's blocks in order, whether the markup keeps each, and its elements (hash, first block, end).

    The last two bits of a hash are its kind.  Of elements around the same blocks the innermost stands
    for all, as it recurs at least as often; like neighbours are one run.
    """

    def __init__(self, html: str, lists: bool = True) -> None:
        self.texts: list[str] = []
        self.listed: list[bool] = []
        self.in_main: list[bool] = []
        self.elements: list[tuple[int, int, int]] = []
        self._forms: list[tuple[int, int, int, int]] = []
        self._last = [(-1, -1)] * 3
        self._parse(html)
        has_main = any(self.in_main)
        self.kept = [not lists or (kept and (main or not has_main)) for kept, main in zip(self.listed, self.in_main)]
        sizes = [0]
        for text in self.texts:
            sizes.append(sizes[-1] + len(text))
        for number, first, end, links in self._forms:
            if not (has_main or links >= LINK_SHARE * (sizes[end] - sizes[first])):
                continue
            before = self.elements[-1] if self.elements else (0, 0, 0)
            if before[0] == number and before[2] == first:
                self.elements[-1] = (number, before[1], end)
            else:
                self.elements.append((number, first, end))

    def _innermost(self, kind: int, first: int, end: int) -> bool:
        if self._last[kind] == (first, end):
            return False
        self._last[kind] = (first, end)
        return True

    def main_blocks(self) -> list[str]:
        return [text for text, kept in zip(self.texts, self.kept) if kept]

    def _parse(self, html: str) -> None:
        texts = self.texts
        stack, pending = [_Element("", False, False, False, None, "", 0)], []
        #: Open elements by tag, and open links.
        opened: dict[str, int] = {}
        linked = 0

        def flush() -> None:
            nonlocal linked
            text = " ".join(references.unescape("".join(pending)).split())
            pending.clear()
            if not text:
                linked = 0
                return
            top = stack[-1]
            in_heading = top.header and any(e.tag in HEADINGS for e in stack)
            self.listed.append(not top.unwanted and not (top.header and not in_heading))
            texts.append(text)
            self.in_main.append(top.main)
            block = top.block
            block.links += min(linked, len(text))
            linked = 0
            block.digest.update(b"=" + text.encode("utf-8", "replace"))
            block.form(b"=")

        def close() -> None:
            element = stack[-1]
            if element.is_block:
                flush()
            stack.pop()
            opened[element.tag] -= 1
            parent = stack[-1]
            parent.block.digest.update(b"<" + element.digest.digest())
            form = element.skeleton.digest()
            parent.block.form(b"<" + form)
            parent.with_main |= element.with_main
            if element.is_block:
                parent.block.links += element.links
                if element.first < len(texts):
                    kind = MAIN_TEXT if element.main else OTHER_TEXT
                    if self._innermost(kind, element.first, len(texts)):
                        self.elements.append((_number(element.digest.digest(), kind), element.first, len(texts)))
                    if not element.with_main and self._innermost(SKELETON, element.first, len(texts)):
                        self._forms.append((_number(form, SKELETON), element.first, len(texts), element.links))

        at = 0
        for token in _TOKEN.finditer(html):
            if token.start() > at:
                part = html[at : token.start()]
                pending.append(part)
                if opened.get("a"):
                    linked += len(part)
            at = token.end()
            tag = token["tag"]
            if not tag:
                continue
            tag = tag.lower()
            if tag == "br":
                pending.append(" ")
            elif token["end"]:
                if opened.get(tag):
                    while stack[-1].tag != tag:
                        close()
                    close()
                elif tag in BLOCK:
                    flush()
            elif tag in VOID:
                if tag in BLOCK:
                    flush()
            else:
                if tag in BLOCK:
                    flush()
                    shut, within = CLOSES.get(tag, (("p",), ("article", "main", "body", "div", "section", "td", "li", "blockquote", "details", "figure")))
                    if any(opened.get(t) for t in shut):
                        depth = len(stack) - 1
                        while depth and stack[depth].tag not in within and stack[depth].tag not in shut:
                            depth -= 1
                        if stack[depth].tag in shut:
                            while len(stack) > depth:
                                close()
                top = stack[-1]
                attributes = token["attributes"] or ""
                main = top.main or tag in ("article", "main") or "role" in attributes and bool(re.search(r"role\s*=\s*[\"']?main\b", attributes))
                unwanted = top.unwanted or _unwanted(tag, attributes, top.main)
                main, header = main and not unwanted, top.header or (tag == "header" and main)
                stack.append(_Element(tag, unwanted, main, header, top, _names(attributes), len(texts)))
                opened[tag] = opened.get(tag, 0) + 1
                if attributes.endswith("/") and tag not in BLOCK:
                    close()
        pending.append(html[at:])
        flush()
        while len(stack) > 1:
            close()


def _number(digest: bytes, kind: int) -> int:
    return int.from_bytes(digest, "big", signed=True) & ~3 | kind


def host_of(url: Column) -> Column:
    """The lower-case host of a url, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


_PARSED = (
    "texts array<string>, kept array<boolean>, elements array<struct<hash:bigint, first:int, end:int>>"
)


def blocks(pages: DataFrame, lists: bool = True) -> DataFrame:
    """(page_id, url, host, page, texts, kept, elements): the parsed pages; ``page`` stands for the html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("hash", pa.int64()), ("first", pa.int32()), ("end", pa.int32())]
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                parsed = [Page(h or "", lists) for h in part.column("html").to_pylist()]
                flat = [element for page in parsed for element in page.elements]
                offsets = [0]
                for page in parsed:
                    offsets.append(offsets[-1] + len(page.elements))
                columns = [pa.array([e[i] for e in flat], kind) for i, (_, kind) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("page_id", "url", "host", "page")),
                        # A block that the markup drops needs no text.
                        pa.array([[t if k else "" for t, k in zip(p.texts, p.kept)] for p in parsed], pa.list_(pa.string())),
                        pa.array([page.kept for page in parsed], pa.list_(pa.bool_())),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, [f for f, _ in fields])),
                    ],
                    names=["page_id", "url", "host", "page", "texts", "kept", "elements"],
                )

    keyed = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.xxhash64("html").alias("page"), "html")
    schema = T.StructType(keyed.schema.fields[:-1] + T._parse_datatype_string(_PARSED).fields)
    return keyed.mapInArrow(run, schema)


def templates(
    parsed: DataFrame, min_pages: int = MIN_PAGES, page_share: float = PAGE_SHARE, many_pages: int = MANY_PAGES
) -> DataFrame:
    """(host, template): per host the hashes of the subtrees that recur."""
    own = F.concat(F.array(F.lit(None).cast("bigint")), F.array_distinct("elements.hash"))
    seen = parsed.filter("host is not null").select("host", "page", F.explode(own).alias("hash")).distinct()
    counts = seen.groupBy("host", "hash").agg(F.count("*").alias("n"))
    # The row without a subtree counts the host's distinct pages.
    pages = counts.filter("hash is null").select("host", F.col("n").alias("pages"))
    recurring = counts.filter((F.col("n") >= min_pages) & F.col("hash").isNotNull()).join(pages, "host")
    enough = F.col("n") >= F.col("pages") * page_share
    in_main = F.col("hash").bitwiseAND(3) == MAIN_TEXT
    recurring = recurring.filter(enough | (~in_main & (F.col("n") >= many_pages)))
    return recurring.groupBy("host").agg(F.collect_list("hash").alias("template"))


def extract(
    pages: DataFrame,
    min_pages: int = MIN_PAGES,
    page_share: float = PAGE_SHARE,
    many_pages: int = MANY_PAGES,
    lists: bool = True,
) -> DataFrame:
    """(page_id, url, text, n_chars, n_template_blocks): the main text of every page.

    ``n_template_blocks`` are all blocks that stand in recurring subtrees, whatever
    the markup says of them.
    """
    parsed = store(blocks(pages, lists))
    with_template = parsed.join(store(templates(parsed, min_pages, page_share, many_pages)), "host", "left")
    # The host's hashes are looked up in a set, once a page.  What a lambda uses is its own argument or a
    # stored column: an expression would be evaluated anew for each element.
    recurring = F.array(F.array_intersect("elements.hash", "template"))
    gone = F.get(F.transform(recurring, lambda found: F.filter("elements", lambda e: F.array_contains(found, e["hash"]))), F.lit(0))
    places = F.flatten(F.transform(gone, lambda e: F.sequence(e["first"], e["end"] - 1)))
    judged = with_template.withColumn("deleted", F.coalesce(F.array_distinct(places), F.array().cast("array<int>")))
    kept = F.filter(F.transform("kept", lambda keep, i: F.when(keep, i)), lambda i: i.isNotNull())
    left = F.transform(F.array_except(kept, "deleted"), lambda i: F.get("texts", i))
    text = F.concat_ws(" ", left)
    return judged.select(
        "page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"),
        F.size("deleted").alias("n_template_blocks"),
    )
