"""Main text of web pages, with site templates removed.

Every element of a page that could be part of a template (a block with text, no article in it) is hashed with all below it.
Spark counts on how many different pages of a host each hash occurs; subtrees recurring on many of them are deleted from its
pages, along with what is never article text by its tag or role. What is left of the articles of a page, or of its main part
or body if it has none, is its text.

Paragraphs, headings and lists inside an article are never taken for a template: a site may print the same article, or the
same passage in several, and that is text. Copies of a page count once, so that they do not make templates of each other.

Pages are read in time proportional to their length, however broken: nothing is searched twice, and a tag that the end of the page
cuts off is dropped, as browsers do.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadloom.llm.graphs import written

#: A subtree is a template on a host from this many different pages on, however many the host has.
MIN_PAGES = 5
#: Up to so many templates are broadcast; more are joined to the pages.
BROADCAST = 200_000

# Fixed by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
#: What a start tag ends, and where the search for it stops.
ENDS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
    "tbody": ("thead tbody tr td th", "table"), "tfoot": ("tbody tr td th", "table"),
}
_ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}

#: Never article text, by tag, by role, and by class or id.
DROPPED = frozenset(
    "head nav footer aside form script style noscript template iframe svg canvas button select textarea input object embed "
    "dialog menu title audio video map noembed noframes xmp".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice newsletter subscribe subscription popup modal overlay sidebar comment comments commentlist reply "
    "replies respond disqus share sharing social related recommended breadcrumb breadcrumbs menu nav navbar navigation footer "
    "masthead pagination pager widget toolbar skip topbar".split()
)
#: With only these, or numbers, beside them, words of the list above still name what is no article text: ``site-footer``,
#: ``share_buttons``, ``comment-17``. Not so ``no-sidebar`` or ``related-work``.
BESIDE = frozenset(
    "site page main global top bottom left right primary secondary upper lower inner outer box bar bars list lists link links button "
    "buttons block blocks area wrapper wrap container content section group item items icon icons unit slot row header form panel "
    "holder region module body text author meta thread post posts article articles story stories media signup trail title message "
    "count counter sticky fixed floating mobile desktop tablet small large".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of running text, safe inside an article.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th figure figcaption caption".split())

#: What a ``<`` begins; a start tag whose quotes hold no angle bracket is taken whole. Nothing here is looked at twice.
_OPEN = re.compile(
    r"<(?:(!--)|[!?][^>]*+>|/([a-zA-Z][^\s/>]*+)[^>]*+>|([a-zA-Z][^\s/>]*+)(?:((?:[^>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>)?+)"
)
_PLAIN = re.compile(r"[^>\"']*+")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+")


def _names_no_text(value: str) -> bool:
    """Whether a class or id of it says that an element is no article text: one whole name, not a word of a longer one."""
    for name in value.split():
        parts = _WORD.findall(name)
        if any(p in WORDS for p in parts) and all(p in WORDS or p in BESIDE or p.isdigit() for p in parts):
            return True
    return False


#: Elements nested deeper lie side by side.
DEPTH = 256


_MAIN = frozenset(("article", "main"))
_KEEPERS = frozenset(("article", "main", "h1"))


@dataclass
class Element:
    tag: str
    role: str = ""
    dropped: bool = False
    #: Whether an article or main part lies below, and whether one or a first heading does.
    over_main: bool = False
    over_kept: bool = False
    mark: str = ""
    parent: Element | None = None
    children: list[Element | str] = field(default_factory=list)


def _tag_end(page: str, at: int, last: int, hopeless: set[int]) -> tuple[int, int]:
    """Where the attributes of a tag that reach up to ``at`` end, and where the tag does; ``last`` is the page's last ``>``.

    Quoted values may hold angle brackets. A quote that is never closed counts as nothing; ``hopeless`` has the quotes from which
    no end was found, so each is followed once a page.
    """
    begin, followed = at, []
    while True:
        at = _PLAIN.match(page, at).end()
        if at <= last and page[at] == ">":
            return at, at + 1
        if at > last or at in hopeless:
            break
        followed.append(at)
        close = page.find(page[at], at + 1, last + 1)
        if close < 0:
            break
        at = close + 1
    hopeless.update(followed)
    end = page.find(">", begin)
    return end, end + 1


def parse(page: str) -> Element:
    """The element tree of a page, tags closed as browsers do; comments and declarations left out."""
    root = Element("#root")
    stack, open_tags = [root], Counter()
    at, low, end, last = 0, None, len(page), page.rfind(">")
    flat: Counter[str] = Counter()
    hopeless: set[int] = set()
    text_from = 0

    def pop_to(size: int) -> None:
        while len(stack) > size:
            open_tags[stack.pop().tag] -= 1

    while True:
        at = page.find("<", at)
        if at < 0:
            at = end
            break
        m = _OPEN.match(page, at) if at < last else None
        if m is None:
            if at > last and at + 1 < end and (page[at + 1] in "/!?" or page[at + 1].isascii() and page[at + 1].isalpha()):
                break  # a tag or comment that the end cuts off
            at += 1
            continue
        if at > text_from:
            stack[-1].children.append(page[text_from:at])
        if m.group(1):
            close = page.find("-->", at + 2)
            at = text_from = end if close < 0 else close + 3
            continue
        if m.group(2):
            at = text_from = m.end()
            tag = m.group(2).lower()
            if flat[tag]:
                flat[tag] -= 1
            elif open_tags[tag]:
                up = len(stack) - 1
                while stack[up].tag != tag:
                    up -= 1
                pop_to(up)
            elif tag == "p":  # an empty paragraph, to browsers
                stack[-1].children.append(Element("p", parent=stack[-1]))
            continue
        if not m.group(3):
            at = text_from = m.end()
            continue
        tag, attributes = m.group(3).lower(), m.group(4)
        if attributes is None:
            begin = m.end(3)
            stop, at = _tag_end(page, begin, last, hopeless)
            attributes = page[begin:stop]
        else:
            at = m.end()
        text_from = at
        if tag in CLOSES_P:
            if open_tags["p"]:
                up = len(stack) - 1
                while up and stack[up].tag not in ("p", "button", "table", "td", "th"):
                    up -= 1
                if stack[up].tag == "p":
                    pop_to(up)
        elif tag in _ENDS:
            ended, stops = _ENDS[tag]
            if any(open_tags[t] for t in ended):
                up, found = len(stack) - 1, 0
                while up and stack[up].tag not in stops:
                    if stack[up].tag in ended:
                        found = up
                    up -= 1
                if found:
                    pop_to(found)
        new = Element(tag, parent=stack[-1])
        if "=" in attributes:
            for name, a, b, c in _ATTRIBUTE.findall(attributes):
                value, name = (a or b or c).lower(), name.lower()
                if name == "role":
                    new.role = value.strip()
                else:
                    # Headings have ids made of their words, and so may have what they stand over.
                    if tag not in HEADINGS and not (name == "id" and tag in PROSE) and tag not in INLINE:
                        new.dropped = new.dropped or _names_no_text(value)
                    new.mark += f"{name}={value};"
        stack[-1].children.append(new)
        if tag in _KEEPERS:
            main = tag in _MAIN
            for e in reversed(stack):
                if e.over_main or (e.over_kept and not main):
                    break
                e.over_kept, e.over_main = True, main
        if tag in RAW:
            if low is None:
                low = page.lower()
                low = low if len(low) == end else page  # lowering may change the length
            stop = low.find(f"</{tag}", at)
            stop = end if stop < 0 else stop
            if tag == "title" or tag == "textarea":
                new.children.append(page[at:stop])
            close = page.find(">", stop)
            at = text_from = end if close < 0 else close + 1
        elif tag not in VOID and (tag in CLOSES_P or not attributes.endswith("/")):
            if len(stack) < DEPTH:
                stack.append(new)
                open_tags[tag] += 1
            else:
                flat[tag] += 1
    if at > text_from:
        stack[-1].children.append(page[text_from:at])
    return root


def _inside(e: Element, tags: frozenset[str]) -> bool:
    while e.parent is not None:
        e = e.parent
        if e.tag in tags:
            return True
    return False


def _is_dropped(e: Element) -> bool:
    if e.tag in DROPPED:
        # Some sites wrap the whole page in a form.
        return e.tag != "form" or not e.over_main
    if e.role in ROLES or e.dropped:
        return e.tag not in ("html", "body", "main") and not e.over_kept
    return e.tag == "header" and not _inside(e, _MAIN)


def subtree_hashes(root: Element) -> dict[int, int]:
    """Hash of each element that could be part of a template, by ``id`` of the element."""
    out: dict[int, int] = {}

    def walk(e: Element, within: bool) -> tuple[str, bool, bool]:
        """Content below, whether there is text, whether there is an article."""
        parts, text, main = [e.tag, e.mark], False, e.tag in _MAIN
        within = within or e.tag == "article"
        for c in e.children:
            if isinstance(c, str):
                plain = " ".join(c.split())
                parts.append(plain)
                text = text or bool(plain)
            elif c.tag not in RAW and c.tag != "head":
                below, some, more = walk(c, within)
                parts.append(below)
                text, main = text or some, main or more
        digest = xxhash.xxh3_64_hexdigest("\x1f".join(parts))
        if text and not main and e.tag not in INLINE and e.tag not in ("html", "body", "#root") and not (within and e.tag in PROSE):
            value = int(digest, 16)
            out[id(e)] = value - (1 << 64) if value >> 63 else value
        return digest, text, main

    walk(root, False)
    return out


def main_text(page: str, templates: frozenset[int] = frozenset()) -> str:
    """Text of a page without the subtrees whose hash is in ``templates``."""
    root = parse(page)
    if templates:
        hashes = subtree_hashes(root)
        gone = {k for k, h in hashes.items() if h in templates}
    else:
        gone = set()
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = " ".join(entities.unescape("".join(run)).split())
        run.clear()
        if text:
            blocks.append(text)

    def emit(e: Element) -> None:
        for c in e.children:
            if isinstance(c, str):
                run.append(c)
            elif c.tag == "br":
                run.append(" ")
            elif c.tag in VOID:
                if c.tag == "hr":
                    close()
            elif id(c) not in gone and not _is_dropped(c):
                if c.tag in INLINE:
                    emit(c)
                else:
                    close()
                    emit(c)
                    close()

    def roots(e: Element, wanted) -> list[Element]:
        found = []
        for c in e.children:
            if isinstance(c, Element) and id(c) not in gone and not _is_dropped(c):
                found += [c] if wanted(c) else roots(c, wanted)
        return found

    tops = roots(root, lambda e: e.tag == "article") or roots(root, lambda e: e.tag == "main" or e.role == "main") or [root]
    for top in tops:
        emit(top)
        close()
    return " ".join(blocks)


def host(url: Column) -> Column:
    """Host of a URL in lower case, without port and user; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


_MARKS = pa.schema([("page_key", pa.int64()), ("host", pa.string()), ("digest", pa.int64()), ("subtree", pa.int64())])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, hosts, digests, pages = (c.to_pylist() for c in batch.columns)
        rows = [
            (k, h, d, s)
            for k, h, d, p in zip(keys, hosts, digests, pages)
            for s in set(subtree_hashes(parse(p)).values())
        ]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MARKS)], schema=_MARKS)


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _texts(sent=None):
    """Texts of pages (page_id, url, html, host, templates); with ``sent``, templates come from there by host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, pages, hosts = batch.columns[:4]
            if sent is None:
                gone = [frozenset(t.as_py() or ()) for t in batch.column(4)]
            else:
                gone = [sent.value.get(h, frozenset()) for h in hosts.to_pylist()]
            found = [main_text(p, t) for p, t in zip(pages.to_pylist(), gone)]
            yield pa.RecordBatch.from_arrays([ids, urls, pa.array(found, pa.string())], schema=_TEXTS)

    return run


def extract_pages(pages: DataFrame, min_pages: int = MIN_PAGES, broadcast: int = BROADCAST) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html); other columns are ignored.

    Null and empty pages give an empty text. Pages without a host form one group. Repeated rows give repeated results; ids
    need not be unique. An empty table gives an empty result.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumns({"host": host(F.col("url")), "digest": F.xxhash64("html")})
    rows = rows.withColumn("page_key", F.xxhash64("host", "digest"))
    marks = written(rows.select("page_key", "host", "digest", "html").mapInArrow(_marks, "page_key bigint, host string, digest bigint, subtree bigint"), "subtrees")
    counts = marks.select("host", "subtree", "digest").distinct().groupBy("host", "subtree").agg(F.count("*").alias("held"))
    templates = written(counts.where(F.col("held") >= min_pages).select("host", "subtree"), "templates")
    columns = ["page_id", "url", "html", "host"]
    if templates.count() <= broadcast:
        by_host: dict[str, set[int]] = {}
        for row in templates.toLocalIterator():
            by_host.setdefault(row["host"], set()).add(row["subtree"])
        sent = pages.sparkSession.sparkContext.broadcast({h: frozenset(s) for h, s in by_host.items()})
        out = rows.select(*columns).mapInArrow(_texts(sent), "page_id bigint, url string, text string")
    else:
        flagged = marks.distinct().join(templates, ["host", "subtree"])
        flagged = flagged.groupBy("page_key").agg(F.collect_set("subtree").alias("templates"))
        joined = rows.join(flagged, "page_key", "left").select(*columns, "templates")
        out = joined.mapInArrow(_texts(), "page_id bigint, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
