"""HTML extraction by site template removal: element subtrees that recur over a host's pages go."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, staged, table

_TAG = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
#: A tag's rest up to its >: quoted values may hold >, a quote mark that nothing closes is plain. No step is taken twice.
_TAG_END = re.compile(r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+>""")
#: What is inside these is no markup; an end tag or the end of the page ends it.
_RAW = frozenset("script style noscript template iframe svg textarea title math object".split())
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OUTSIDE = frozenset("nav footer aside form button select dialog menu head".split())
#: Words in class, id or role of elements that are not the article's own text.
_OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus"
    " footer masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted related replies reply respond share sharing"
    " sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: An element of the first kind ends where one of these begins beside it, up to the nearest of the stops.
_ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_STOPS = frozenset("ul ol dl table body article main section div nav select menu".split())
_ROOTS = frozenset("html body article main".split())
#: Within the article these hold its prose; that they recur does not make them template.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr b i em strong a span code".split())


def _host(url: str | None) -> str:
    rest = (url or "").partition("//")[2] or (url or "")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rpartition("@")[2].lower()


def _tokens(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """The page's markup in order: where it begins and ends, the tag ("" for none), whether it closes, and its attributes.

    One pass: a search that has come to the page's end in vain is not made again.
    """
    at, missing, plain = 0, set(), False

    def find(sign: str, i: int) -> int:
        k = -1 if sign in missing else html.find(sign, i)
        if k < 0:
            missing.add(sign)
        return k

    def tag_end(begin: int) -> int:
        nonlocal plain
        end = None if plain else _TAG_END.match(html, begin)
        if end:
            return end.end()
        plain = True  # from here on every > is in quotes, so quotes do not count
        return find(">", begin) + 1

    while (lt := html.find("<", at)) >= 0:
        first = html[lt + 1 : lt + 2]
        if first == "!" and html.startswith("--", lt + 2):
            at = find("-->", lt + 4) + 3
            at = at if at > 2 else len(html)
            yield lt, at, "", False, ""
            continue
        if first in ("!", "?"):
            at = find(">", lt) + 1 or len(html)
            yield lt, at, "", False, ""
            continue
        name = _TAG.match(html, lt + 2 if first == "/" else lt + 1)
        if not name:
            at = lt + 1
            continue
        at = tag_end(name.end()) or len(html)
        torn = html[at - 1] != ">"  # a tag without an end is no text
        tag, attrs = name[0].lower(), html[name.end() : at - 1]
        if not torn and first != "/" and tag in _RAW:
            end = None if tag in missing else _RAW_END[tag].search(html, at)
            if end is None:
                missing.add(tag)
            at, torn = (end.end() if end else len(html)), True
        yield (lt, at, "", False, "") if torn else (lt, at, tag, first == "/", attrs)


@dataclass(slots=True)
class _Element:
    tag: str
    outside: bool  # it is none of the article
    prose: bool
    holder: _Element | None  # the innermost block element around it, or itself, that is neither prose nor a root
    inner: _Element | None  # the innermost block element, or itself
    content: object  # a hash of its tag, its text, and its children's hashes
    mark: int = 0


def _without_article(page: list[tuple[str, bool, list[int]]]) -> list[tuple[str, bool, list[int]]]:
    """A page's blocks without the marks that hold more than half of the characters of its article or main element."""
    size: dict[int, int] = {}
    whole = 0
    for text, own, held in page:
        if own:
            whole += len(text)
            for m in held:
                size[m] = size.get(m, 0) + len(text)
    most = {m for m, n in size.items() if 2 * n > whole}
    return [(text, own, [m for m in held if m not in most]) for text, own, held in page] if most else page


def blocks(html: str) -> list[tuple[str, bool, list[int]]]:
    """A page's text blocks in order: text, whether it is the article's, and hashes of subtrees it is in.

    A subtree's hash is made of its tags and text, not of attributes, which vary from page to page in a menu. Of the
    subtrees around a block only the innermost prose element (an odd hash) and the innermost other one (an even
    hash) are given: outer ones recur on no more pages. A subtree with more than half of the characters of the
    page's article or main elements is the article itself, wherever else it recurs, and not given.
    """
    out: list[tuple] = []
    open_: list[_Element] = []
    count: dict[str, int] = {}
    text: list[str] = []
    at = outside = articles = 0
    any_article = False

    def say(piece: str) -> None:
        text.append(piece)
        if open_:
            open_[-1].content.update(" ".join(piece.split()).encode("utf-8", "replace"))

    def flush() -> None:
        joined = " ".join(unescape("".join(text)).split())
        text.clear()
        if joined:
            out.append((joined, outside == 0, articles > 0, open_[-1] if open_ else None))

    def close() -> None:
        nonlocal outside, articles
        if open_[-1].tag in _BLOCK:
            flush()
        e = open_.pop()
        count[e.tag] -= 1
        outside -= e.outside
        articles -= e.tag in ("article", "main")
        e.mark = int.from_bytes(e.content.digest(), "little", signed=True) & ~1 | e.prose
        if open_:
            open_[-1].content.update(e.content.digest())

    for begin, end, tag, closes, attrs in _tokens(html):
        if begin > at:
            say(html[at:begin])
        at = end
        if not tag:
            continue
        if closes:
            for depth in range(len(open_) - 1, -1, -1) if count.get(tag) else ():
                if open_[depth].tag == tag:
                    while len(open_) > depth:
                        close()
                    break
                if tag not in _BLOCK and open_[depth].tag in _BLOCK:
                    break
            continue
        if tag in _BLOCK:
            flush()
            ends = _ENDED_BY.get(tag, ())
            for depth in range(len(open_) - 1, -1, -1) if count.get("p") or any(count.get(x) for x in ends) else ():
                found = open_[depth].tag
                if found == "p" or found in ends:
                    while len(open_) > depth:
                        close()
                    break
                if found in _STOPS or (found in _BLOCK and not ends):
                    break
        elif tag == "br":
            text.append(" ")
        if tag in _VOID or attrs.endswith("/") and tag not in _BLOCK:
            continue
        out_of = tag in _OUTSIDE or (tag == "header" and not articles)
        if not out_of and attrs and tag not in ("html", "body"):
            names = " ".join(x.strip("\"'") for x in _NAMES.findall(attrs)).lower()
            out_of = not _OUTSIDE_NAMES.isdisjoint(re.split(r"[^a-z0-9]+", names))
        outside += out_of
        if tag in ("article", "main"):
            articles += 1
            any_article = True
        above = open_[-1] if open_ else None
        prose = articles > 0 and tag in _PROSE
        e = _Element(tag, out_of, prose, above and above.holder, above and above.inner, hashlib.blake2b(tag.encode(), digest_size=8))
        if tag in _BLOCK and tag not in _ROOTS:
            e.inner = e
            e.holder = e.holder if prose else e
        elif tag in _ROOTS:
            e.inner = e.holder = None
        open_.append(e)
        count[tag] = count.get(tag, 0) + 1
    if at < len(html):
        say(html[at:])
    while open_:
        close()
    flush()
    found = []
    for t, own, within, e in out:
        held = {x.mark for x in ((e.holder, e.inner) if e else ()) if x}
        found.append((t, own and (within or not any_article), sorted(held)))
    return _without_article(found) if any_article else found


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def page_blocks(pages: DataFrame) -> DataFrame:
    """`pages` (page_id, url, html, ...) to page_id, url, host and page (hashed), marks and blocks.

    marks are the hashes of all subtrees with text; blocks, array<struct<text, marks>>, are the
    article's, with the subtrees that each is in. Pages of the same
    blocks share `page`.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("marks", pa.list_(pa.int64()))]))
        for batch in sliced(batches, "html"):
            urls = batch.column("url")
            hosts, same, marks, found = [], [], [], []
            for url, html in zip(urls.to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = blocks(html or "")
                hosts.append(_number(_host(url)))
                same.append(_number("\n".join(f"{own}{t}" for t, own, _ in page)))
                marks.append(list({m for _, _, held in page for m in held}))
                found.append([{"text": t.encode("utf-8", "replace").decode(), "marks": held} for t, own, held in page if own])
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), urls, pa.array(hosts, pa.int64()), pa.array(same, pa.int64()), pa.array(marks, pa.list_(pa.int64())), pa.array(found, kind)], names=["page_id", "url", "host", "page", "marks", "blocks"])

    id_kind = dict(pages.dtypes)["page_id"]
    return pages.select("page_id", "url", "html").mapInArrow(emit, f"page_id {id_kind}, url string, host long, page long, marks array<long>, blocks array<struct<text:string,marks:array<long>>>")


#: Up to so many rows a table of template marks goes to every task; a larger one is joined by shuffle.
SMALL_ROWS = 100_000


def _sent(df: DataFrame) -> DataFrame:
    """A written table, broadcast if it is counted to be small."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def main_text(pages: DataFrame, min_pages: int = 3, min_share: float = 0.1, most_pages: int = 100, prose_share: float = 0.8) -> DataFrame:
    """The article's text of every row of `pages` (page_id, url, html, ...): page_id, url, text.

    Every element's subtree is hashed by its structure and text and counted for its host, once for all pages of
    the same blocks. Subtrees on at least `min_pages` pages and `min_share` of the host's pages, or on `most_pages` of
    them, are template and go with all their blocks. Prose elements inside an article count as template only on
    `prose_share` of a host's pages (five at least), as authors repeat themselves and copies of
    articles are common. Of the rest, the blocks inside article or main elements (the body, if
    a page has neither) that are in no menu, header, footer, sidebar, notice, advert, form
    or reader comments, by element or by words in class, id or role, make the text, joined
    by newlines. White space in a block becomes one space; <br> is white space.

    Null or empty html: empty text. A null url is a host of its own. Repeated pages count
    as one and come out each; a null page_id comes out as null. Other columns are left out.
    Empty input: empty output. Time grows with the length of a page, however it is nested or torn.
    """
    parsed = staged(page_blocks(pages).withColumn("row", F.monotonically_increasing_id()))
    marks = parsed.select("host", "page", F.explode("marks").alias("mark")).distinct()
    sizes = parsed.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("n_host"))
    often = marks.groupBy("host", "mark").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages).join(sizes, "host")
    prose = (F.col("mark") % 2 != 0) & (F.col("n") >= F.greatest(F.lit(5), F.col("n_host") * prose_share))
    other = (F.col("mark") % 2 == 0) & (F.col("n") >= F.least(F.lit(most_pages), F.col("n_host") * min_share))
    often = staged(often.where(prose | other).select("host", "mark"))
    own = parsed.select("row", "host", F.explode(F.array_distinct(F.flatten("blocks.marks"))).alias("mark"))
    per_page = staged(own.join(_sent(often), ["host", "mark"]).groupBy("row").agg(F.collect_set("mark").alias("template")))
    heard = parsed.join(_sent(per_page), "row", "left")
    kept = F.filter("blocks", lambda b: F.col("template").isNull() | ~F.arrays_overlap(b["marks"], "template"))
    return heard.select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text"))


def query(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
