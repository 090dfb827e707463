"""Main text of HTML pages by nearest-URL page differencing.

Pages of a host are ordered by URL path; each is paired with whichever of its two neighbours has
the path with the smaller edit distance. The text lines (blocks) of both are aligned by longest
common subsequence, and lines that both pages share are deleted: what a site repeats is not what
a page says. Where the two share four fifths of their lines or more, they may be near copies: then only lines go that the page shares with its
other neighbour, too, and none if it has no other.

Alone, this gives wrong results in two ways: a footer or advert that differs from page to page
stays, and an article that a site publishes twice goes. So the markup decides first: lines
inside menus, headers, footers, sidebars, notices, adverts, forms and reader comments go whether shared or
not, and lines inside an `article` (or, without one, `main`) element stay, shared or not. Lines that the
markup says nothing about are kept or deleted by the differencing: those of pages without
such an element, and those inside `main` but beside its article. Inside an article a class or id of SOFT_WORDS (reviews, related, share, ...) is only a first guess:
such lines go unless the differencing finds a page to compare with and they are not shared with it. If all lines of a page without such an element are shared, the two pages are
copies and none is deleted. Words in class and id count only where the whole name is made of them and of words of layout,
so `share-price` or `ad-hoc-query` mark nothing; `userComments` is read as `user-comments`.

Scale: pages travel as one 32-bit hash for each line; ordering is by ranges of (host, path), so one
host may hold most pages. Only the pages that lose lines get a list of them back, by broadcast below
a counted size and by a shuffled join above it.

Defined results: null html gives an empty text; a null url is a host of its own; rows that repeat
page_id, url and html get equal results; very long pages are parsed whole; other columns are not read and may have any name; an empty table gives no rows. White space is what Python's str.split() takes it to be.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hinted, neighbours, saved, table

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Elements whose content is not markup and not text of the page.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Elements that are never main text, with all they hold.
DROPPED = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "datalist", "head", "svg", "math", "object", "audio", "video", "canvas", "map", "fieldset"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar"}
#: Words in class and id that mark such parts of a page.
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising adbox adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer "
    "disqus footer form gdpr header login menu modal nav navbar navigation newsletter notice notices notification overlay pagination pager popup promo promoted "
    "related reader-comments respond reviews share sharing sidebar signup skip-link social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
#: Of these, words that can also name a part of an article.
SOFT_WORDS = set("reviews related share sharing subscribe subscription notice notices copyright disclaimer promoted pager pagination".split())
#: Words that mark an article element as one beside the page's own.
OTHER_ARTICLES = {"comment", "comments", "ad", "advert", "promo", "related", "teaser", "teasers", "recommended", "sponsored"}
#: Pages that share so much of their lines may be near copies.
NEAR_COPY = 0.8
#: Words that may stand beside these in a name.
LAYOUT_WORDS = set(
    "area articles article bar block body bottom box button buttons column container content count desktop entry fixed frame global group holder icons inner item items js large left link links list "
    "main message mobile module more outer page panel policy post posts primary reader region reply right row secondary section site slot small sticky stories strip text thread title top ui unit user view wrap wrapper zone".split()
)
#: Open elements that a new one of these ends.
ENDS = {"p": {"p"}, "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "tr", "td", "th"}, "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "nav", "aside", "form", "footer", "header"}


@dataclass
class Line:
    """A block's text, whether the markup drops it, whether it is in an article or main element, and whether a soft word stands above it."""

    text: str
    dropped: bool
    article: bool
    main: bool
    soft: bool = False


CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _names(token: str, words: set[str]) -> set[str]:
    """The words that the token names, if it is one of them or is made of some and of words of layout and numbers."""
    if token in words:
        return {token}
    parts = {p for p in re.split(r"[-_]+", token) if p and not p.isdigit()}
    return parts & words if parts <= words | DROPPED_WORDS | LAYOUT_WORDS else set()


def _marks(name: str, attrs: str, in_content: bool) -> tuple[bool, bool]:
    """Whether the element's name or attributes say that it is no main text, and whether words say so that can also name a part of it."""
    if name in DROPPED or (name == "header" and not in_content):
        return True, False
    soft = False
    for key, *values in ATTRIBUTE.findall(attrs) if attrs.strip() else ():
        key, plain = key.lower(), "".join(values)
        value = plain.lower()
        if key == "role" and value in DROPPED_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True, False
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, False
        if key in ("class", "id"):
            tokens = [CAMEL.sub("-", w).lower() for w in plain.split()]
            if name not in ("html", "body", "article", "main"):
                # An article's own heading is part of it, and has-sidebar or no-header say what is beside.
                words = DROPPED_WORDS - {"header"} if in_content else DROPPED_WORDS
                found = set().union(*[_names(w, words) for w in tokens])
                if found and (not in_content or found - SOFT_WORDS):
                    return True, False
                soft = soft or bool(found)
            if name == "article" and any(set(re.split(r"[-_]+", w)) & OTHER_ARTICLES for w in tokens):
                return True, False
    return False, soft


class Open:
    """The open elements, innermost last, with the places of each name; what is asked takes no walk over them."""

    def __init__(self):
        #: Of each element: name, dropped, in article, in main, soft.
        self.stack: list[tuple[str, bool, bool, bool, bool]] = []
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []

    def top(self) -> tuple[str, bool, bool, bool, bool]:
        return self.stack[-1] if self.stack else ("", False, False, False, False)

    def push(self, name: str, *flags: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in SCOPES:
            self.scopes.append(len(self.stack))
        self.stack.append((name, *flags))

    def cut(self, size: int) -> None:
        while len(self.stack) > size:
            name = self.stack.pop()[0]
            self.places[name].pop()
            if name in SCOPES:
                self.scopes.pop()

    def last(self, name: str) -> int:
        """The place of the innermost element of this name, -1 if there is none."""
        found = self.places.get(name)
        return found[-1] if found else -1

    def end(self, names: set[str]) -> None:
        """Ends what is inside the innermost scope from the innermost element of these names that no further scope is in, as often as there is one."""
        scope = self.scopes[-1] if self.scopes else -1
        while (at := max(map(self.last, names), default=-1)) > scope:
            self.cut(at)


def page_lines(html: str | None) -> list[Line]:
    """The text lines of a page, in order."""
    html = html or ""
    out: list[Line] = []
    parts: list[str] = []
    open_ = Open()

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                _, dropped, article, main, soft = open_.top()
                out.append(Line(text, dropped, article, main, soft))
            parts.clear()

    at = 0
    while at < len(html):
        if html.find(">", at) < 0:  # no more tags: an unclosed comment ends the page
            cut = html.find("<!", at)
            html = html[: cut if cut >= 0 else len(html)]
            break
        m = TOKEN.search(html, at)
        if not m:
            break
        if m.start() > at:
            parts.append(html[at : m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name, close, attrs = name.lower(), m["close"] or m["close2"], m["attrs"] or m["attrs2"] or ""
        if name in RAW and not close:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            flush() if name not in INLINE else None
            continue
        if name in VOID:
            if name not in INLINE:
                flush()
            continue
        _, dropped, article, main, soft = open_.top()
        marked, guessed = (False, False) if close else _marks(name, attrs, article or main)
        if name in INLINE and not marked and not guessed:
            if close and open_.last(name) >= 0:  # an inline element that was marked
                flush()
                open_.cut(open_.last(name))
            continue
        flush()
        if close:
            if open_.last(name) >= 0:
                open_.cut(open_.last(name))
            continue
        open_.end(ENDS.get(name, {"p"} if name not in INLINE else set()))
        _, dropped, article, main, soft = open_.top()
        own_main = name == "main" or bool(re.search(r"""role\s*=\s*["']?main\b""", attrs, re.I))
        if not attrs.rstrip().endswith("/") or name not in ("svg", "math"):
            open_.push(name, dropped or marked, article or name == "article", main or own_main, soft or guessed)
    if at < len(html) and not html.startswith("<", at):
        parts.append(html[at:])
    flush()
    return out


def candidates(lines: Sequence[Line]) -> tuple[list[int], set[int], set[int]]:
    """The lines that the markup lets stay, those of them that the differencing may delete, and those that it may bring back."""
    article = [i for i, x in enumerate(lines) if x.article and not x.dropped]
    main = [i for i, x in enumerate(lines) if x.main and not x.dropped]
    soft = {i for i in (article or main) if lines[i].soft}
    if len(soft) == len(article or main):  # then the words name the article itself
        soft = set()
    if article:
        beside = set(main) - set(article) - soft
        return sorted({*article, *beside} - soft), beside, soft
    if main:
        return [i for i in main if i not in soft], set(), soft
    stay = [i for i, x in enumerate(lines) if not x.dropped]
    return stay, set(stay), set()


def shared_lines(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Places in a of a longest common subsequence of a and b; linear memory, bits in parallel."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    ha, hb = len(a), len(b)
    while ha > lo and hb > lo and a[ha - 1] == b[hb - 1]:
        ha, hb = ha - 1, hb - 1
    return [*range(lo), *(lo + i for i in _middle(a[lo:ha], b[lo:hb])), *range(ha, len(a))]


def _rows(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    """After each line of a, the bits of b's places; a zero bit is where the length grows."""
    full = (1 << len(b)) - 1
    masks: dict[int, int] = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << j
    v = full
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(v: int, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(v.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.r_[0, np.cumsum(1 - bits.astype(np.int64))]


def _middle(a: Sequence[int], b: Sequence[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > 1 << 26 and len(a) > 1:  # halves of a, where the two lengths add up to most
        half, fore, back = len(a) // 2, (1 << len(b)) - 1, (1 << len(b)) - 1
        for fore in _rows(a[:half], b):
            pass
        for back in _rows(a[half:][::-1], b[::-1]):
            pass
        cut = int((_lengths(fore, len(b)) + _lengths(back, len(b))[::-1]).argmax())
        return _middle(a[:half], b[:cut]) + [half + i for i in _middle(a[half:], b[cut:])]
    rows, out = list(_rows(a, b)), []
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                out.append(i)
                j -= 1
    return out[::-1]


#: Of a line: the differencing may delete it, may delete all lines, may bring it back.
FREE, EVERY, SOFT, BITS = 1, 2, 4, 3


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page a hash for each line, with its bits behind it."""
    for batch in batches:
        rows = []
        for text in batch.column(2):
            lines = page_lines(text.as_py())
            stay, free, soft = candidates(lines)
            every = EVERY * (len(free) == len(stay))
            rows.append([zlib.crc32(x.text.encode("utf-8", "surrogatepass")) << BITS | every | FREE * (i in free) | SOFT * (i in soft) for i, x in enumerate(lines)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int64()))], names=["page_id", "h", "lines"])


def decided(own: Sequence[int], other: Sequence[int], second: Sequence[int] | None) -> list[int]:
    """What the differencing changes of a page: lines that it deletes, and, as -1 - line, those that it brings back."""
    free, soft = ({i for i, x in enumerate(own) if x & bit} for bit in (FREE, SOFT))
    mine, theirs = ([x >> BITS for x in page] for page in (own, other))
    shared = set(shared_lines(mine, theirs))
    if len(shared) >= NEAR_COPY * max(len(mine), len(theirs)):
        shared &= set(shared_lines(mine, [x >> BITS for x in second])) if second is not None else set()
    lost = free & shared
    lost = set() if lost == free and own[0] & EVERY else lost
    return sorted([*lost, *(-1 - i for i in soft - shared)])


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [decided(*pages) for pages in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], names=["page_id", "h", "changed"])


def main_text(html: str | None, changed: Sequence[int]) -> str:
    lines, gone = page_lines(html), set(changed)
    stay, _, soft = candidates(lines)
    kept = [i for i in stay if i not in gone] + [i for i in soft if -1 - i in gone]
    return " ".join(lines[i].text for i in sorted(kept))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html.as_py(), changed or ()) for html, changed in zip(batch.column(2), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def host(url: Column) -> Column:
    """The host in lower case, without user and port; empty for a null url."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumn("h", F.xxhash64("page_id", "url", "html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    lines = saved(rows.select("page_id", "h", "html").mapInArrow(_digests, f"page_id {kind}, h long, lines array<long>"))
    keys = rows.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("id"), "h").distinct()
    parts = max(1, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = neighbours(keys, ["host", "path", "id", "h"], parts)
    far = lambda c: F.when(F.col(f"{c}.host") == F.col("host"), F.levenshtein(F.col("path"), F.col(f"{c}.path")))
    near = near.withColumn("_n", far("next")).withColumn("_p", far("prev"))
    after = F.col("_n").isNotNull() & (F.col("_p").isNull() | (F.col("_n") <= F.col("_p")))
    partner = F.when(after, F.col("next.h")).when(F.col("_p").isNotNull(), F.col("prev.h"))
    other = F.when(after & F.col("_p").isNotNull(), F.col("prev.h")).when(~after & F.col("_n").isNotNull(), F.col("next.h"))
    pairs = near.select("h", partner.alias("other"), other.alias("second")).where("other IS NOT NULL")
    one = lines.groupBy("h").agg(F.first("page_id").alias("page_id"), F.first("lines").alias("lines"))
    some = one.where(F.exists("lines", lambda x: x.bitwiseAND(FREE | SOFT) != 0))
    both = pairs.join(some, "h").join(one.select(F.col("h").alias("other"), F.col("lines").alias("theirs")), "other")
    both = both.join(one.select(F.col("h").alias("second"), F.col("lines").alias("seconds")), "second", "left")
    changed = both.select("page_id", "h", "lines", "theirs", "seconds").mapInArrow(_decided, f"page_id {kind}, h long, changed array<int>")
    changed = saved(changed.where(F.size("changed") > 0)).select(F.col("h").alias("_h"), "changed")
    full = rows.join(hinted(changed, 100_000), F.col("h") == F.col("_h"), "left").select("page_id", "url", "html", "changed")
    return full.mapInArrow(_texts, f"page_id {kind}, url string, text string, n_chars long")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
