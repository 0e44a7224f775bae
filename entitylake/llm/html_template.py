"""Main text of web pages by equivalence-class template deduction.

A page's tokens are its element paths and its text nodes (with their path).  A token's
occurrence vector has its count on every page of the host; tokens with equal vectors form an
equivalence class.  Vectors are compared by fingerprint (sums of hashes of page and count), so
they are never built.  A class is valid when it occurs on at least half of the host's pages;
element tokens nest by their paths, which makes the valid classes a tree: the template.

A text is fixed when its class is that of its block element or of an element around it, so it
comes and goes with the template.  A block element all of whose texts, on all pages of the host, are
fixed has no slot: it is template and not printed, wherever it stands.  Blocks with any other
text are slots and printed whole.  Fixed text needs LEAST different pages; copies of a page count
as one, and a page of which nothing would be left is printed with its fixed text.

The article is the template element reached from the root by following, as long
as one does, the element that occurs once a page and whose subtree holds most slot text,
leaving out elements that are furniture by tag, role, class or id; a template's only
``article`` or ``main`` element (of several, the one that holds most of their text) is taken directly.  A page without that element is deduced from itself.

Scale: two passes over the pages, each a per-page function; between them token rows are summed by
host and token with partial aggregation, so a host with a third of all pages costs no task more
than its share.  What is solved per host are the tokens with enough support, as many as a page
has, not as a host has pages.  The result, one row per host, is written and joined back by size.

Defined results: null or empty html gives the empty text; a null url or one without a host is
grouped under the empty host; an unclosed element ends with its parent or the page; repeated
rows give equal rows; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylake.llm.bytetext import batch_column
from entitylake.llm.common import Spool
from entitylake.llm.url_filter import host_of

# Names of HTML elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg"
FURNITURE_TAGS = frozenset("head nav footer aside form script style noscript template iframe button select option textarea menu dialog svg input title".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header "
    "masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies respond share sharing "
    "sidebar social sponsor sponsored subscribe teaser toolbar widget".split()
)
#: Words that say nothing of a name's own: a class "cookie-bar" or "top-nav" is named by the other word.
PLAIN_NAMES = frozenset("area bar block bottom box container content group inner item left links list main outer page panel right row section site top wrap wrapper".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li "
    "main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An element of the first kind closes an open element of the second kinds (up to a boundary).
IMPLIED_END = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "thead": {"tr", "td", "th", "thead", "tbody"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"},
}
BOUNDARY = frozenset("html body table ul ol dl div section article main td th nav aside header footer form select blockquote".split())
P = frozenset({"p"})
CLOSES_P = BLOCK_TAGS - {"html", "body", "tbody", "thead", "tfoot", "tr", "td", "th", "li", "dd", "dt"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + RAW + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<text>[^<]++|<)",
    re.S | re.I,
)
#: One attribute after the other, so a name is never read inside a value or inside another name.
ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HALF = 2  # a valid class occurs on at least one in HALF of the host's pages
MOST = 0.8
LEAST = 3


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def furniture_name(name: str) -> bool:
    """Whether a whole class or id says furniture: every word of it does or is plain, and one does ("share-price" does not)."""
    words = set(re.split(r"[^a-z]+", name)) - {""}
    return bool(words & FURNITURE_NAMES) and words <= FURNITURE_NAMES | PLAIN_NAMES


class Element:
    __slots__ = ("tag", "path", "furniture", "parent", "inside", "block")

    def __init__(self, tag: str, attrs: str, parent: Element | None):
        found: dict[str, str] = {}
        for m in ATTR.finditer(attrs) if attrs else ():
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        names = set(f"{found.get('class', '')} {found.get('id', '')}".lower().split())
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        self.furniture = (
            (parent is not None and parent.furniture)
            or tag in FURNITURE_TAGS
            or (tag == "header" and not self.inside)
            or found.get("role", "").lower() in FURNITURE_ROLES
            or (any(map(furniture_name, names)) and tag not in ("html", "body", "article", "main"))
            or "hidden" in found
            or found.get("aria-hidden", "").strip().lower() == "true"
        )
        self.tag, self.parent = tag, parent
        # digits left out: "post-17" and "post-18" are one element of the template
        words = sorted({w for name in names for w in re.split(r"[^a-z]+", name)} - {""})
        self.path = _hash(f"{parent.path if parent else 0}/{tag}.{' '.join(words)}#{found.get('role', '')}")
        self.block = self.path if tag in BLOCK_TAGS or parent is None else parent.block


def events(page: str) -> Iterator[tuple[str, Element, str]]:
    """``(kind, element, text)`` in page order; kind is open, close or text.  Scripts, styles and comments are no events."""
    root = Element("#page", "", None)
    stack = [root]
    open_at: dict[str, list[int]] = {}  # tag -> places of its open elements in the stack, rising

    def close_to(k: int):
        while len(stack) > k:
            e = stack.pop()
            open_at[e.tag].pop()
            yield "close", e, ""

    def ended_by(tag: str) -> int:
        """Place of the outermost open element that a new ``tag`` ends: none beyond the nearest boundary."""
        ends = IMPLIED_END.get(tag, frozenset()) | (P if tag in CLOSES_P else frozenset())
        found = [places for t in ends if (places := open_at.get(t))]
        if not found:
            return len(stack)
        wall = max((places[-1] for t in BOUNDARY - ends if (places := open_at.get(t))), default=0)
        beyond = [places[i] for places in found if (i := bisect_right(places, wall)) < len(places)]
        return min(beyond, default=len(stack))

    for m in TOKEN.finditer(page):
        if m["text"]:
            yield "text", stack[-1], m["text"]
        elif m["open"]:
            tag = m["open"].lower()
            yield from close_to(ended_by(tag))
            e = Element(tag, m["attrs"], stack[-1])
            yield "open", e, ""
            if tag in VOID or m["attrs"].endswith("/"):
                yield "close", e, ""
            else:
                open_at.setdefault(tag, []).append(len(stack))
                stack.append(e)
        elif m["end"] and (places := open_at.get(m["end"].lower())):
            yield from close_to(places[-1])
    yield from close_to(1)


def page_tokens(page: str, fixed: frozenset[int] = frozenset()) -> dict[int, list]:
    """Token -> [parent, tag, furniture, is text, count, text length, block, texts]; a text node's length is also its
    element's.  ``block``: a text's block element; ``texts``: text nodes of a block element.  Texts of ``fixed`` blocks do not count."""
    out: dict[int, list] = {}
    for kind, e, text in events(page):
        if kind == "open":
            t = out.setdefault(e.path, [e.parent.path, e.tag, e.furniture, False, 0, 0, 0, 0])
            t[4] += 1
        elif kind == "text":
            text = " ".join(text.split())
            if text and not e.furniture and e.block not in fixed:
                if e.path in out:
                    out[e.path][5] += len(text)
                if e.block in out:
                    out[e.block][7] += 1
                t = out.setdefault(_hash(f"{e.path}\0{text}"), [e.path, "", False, True, 0, len(text), e.block, 0])
                t[4] += 1
    return out


def content_path(tokens: list[tuple], n_pages: int) -> int:
    """The article's element, 0 if there is none.  ``tokens``: (token, parent, tag, furniture, is text,
    pages, total, length); length of a text token: of one occurrence, else of all texts directly in it."""
    fixed: dict[int, int] = {}
    for token, parent, _, _, is_text, pages, total, length in tokens:
        if is_text and n_pages > 1 and pages * HALF >= n_pages:
            fixed[parent] = fixed.get(parent, 0) + length * total
    elements = {t[0]: t for t in tokens if not t[4]}
    children: dict[int, list[int]] = {}
    for t in elements.values():
        children.setdefault(t[1], []).append(t[0])
    slot: dict[int, int] = {}
    top = [t for t in elements if elements[t][1] not in elements]
    order, todo = [], list(top)
    while todo:
        t = todo.pop()
        order.append(t)
        todo += children.get(t, [])
    for t in reversed(order):
        own = 0 if elements[t][3] else max(0, elements[t][7] - fixed.get(t, 0))
        slot[t] = own + sum(slot[c] for c in children.get(t, []))

    def single(t: int) -> bool:
        _, _, _, furniture, _, pages, total, _ = elements[t]
        return not furniture and total == pages and pages * HALF >= n_pages

    for name in ("article", "main"):
        named = sorted((t for t in order if elements[t][2] == name and single(t) and slot[t]), key=lambda t: -slot[t])
        # teasers are articles as well: the one with most of their text is the page's own
        if named and (len(named) == 1 or slot[named[0]] >= MOST * sum(slot[t] for t in named)):
            return named[0]
    at, below = 0, top
    while below:
        best = max(below, key=lambda t: (slot[t], -t))
        if not single(best) or slot[best] < MOST * (slot[at] if at else sum(slot[t] for t in top)) or not slot[best]:
            break
        at, below = best, children.get(best, [])
    return at


def fixed_blocks(tokens: list[tuple]) -> list[int]:
    """Block elements without a slot.  ``tokens``: (token, parent, is text, class, total, block, texts, different pages),
    of all tokens on at least half of the pages; ``class``: what tokens of equal vectors share."""
    elements = {t[0]: t for t in tokens if not t[2]}
    inside: dict[int, list[tuple]] = {}
    for t in tokens:
        if t[2] and t[5] in elements:
            inside.setdefault(t[5], []).append(t)
    out = []
    for block, texts in inside.items():
        if sum(t[4] for t in texts) != elements[block][6] or min(t[7] for t in texts) < LEAST:
            continue
        missing, at = {t[3] for t in texts}, block
        while missing and at in elements:
            missing.discard(elements[at][3])
            at = elements[at][1]
        if not missing:
            out.append(block)
    return sorted(out)


def extract(page: str, path: int | None, fixed: frozenset[int] = frozenset()) -> str:
    """Text blocks below the element ``path`` (or the page's own deduction) without ``fixed`` ones, joined by two newlines."""
    seen = list(events(page))
    whole = path
    if path is None or not any(kind == "open" and e.path == path for kind, e, _ in seen):
        path = content_path([(k, *t[:4], 1, t[4], t[5]) for k, t in page_tokens(page, fixed).items()], 1)
    blocks, inline, depth = [], [], 0
    for kind, e, text in seen:
        if kind == "open" and e.path == path:
            depth += 1
        if depth or not path:
            if e.tag in BLOCK_TAGS and kind != "text":
                blocks.append("".join(inline))
                inline = []
            elif e.tag == "br" and kind == "open":
                inline.append(" ")
            elif kind == "text" and not e.furniture and e.block not in fixed:
                inline.append(text)
        if kind == "close" and e.path == path:
            depth -= 1
    blocks.append("".join(inline))
    out = "\n\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)
    return out if out or not fixed else extract(page, whole)


TOKENS = "host string, page long, token long, parent long, tag string, furniture boolean, is_text boolean, n long, length long, block long, texts long"


def page_token_rows(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("host", pa.string()), ("page", pa.int64()), ("token", pa.int64()), ("parent", pa.int64()), ("tag", pa.string()),
                            ("furniture", pa.bool_()), ("is_text", pa.bool_()), ("n", pa.int64()), ("length", pa.int64()), ("block", pa.int64()), ("texts", pa.int64())])
        for batch in batches:
            rows = []
            hosts, ids, texts = (batch_column(batch, c) for c in ("host", "page", "html"))
            for host, page, text in zip(hosts.to_pylist(), ids.to_pylist(), texts):
                rows += [(host, page, k, *t) for k, t in page_tokens(text.as_py() or "").items()]
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return pages.mapInArrow(run, TOKENS)


def deduce(pages: DataFrame) -> DataFrame:
    """``pages``: host, page (hash of the html), html.  Per host: ``path`` of the article, ``fixed`` block elements."""
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    vectors = page_token_rows(pages).groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("n").alias("total"),
        F.sum(F.expr("xxhash64(page, n) & 2147483647L")).alias("vector"),
        F.sum(F.expr("shiftrightunsigned(xxhash64(page, n), 33)")).alias("vector2"),
        # one bit a page: at least so many different pages
        F.greatest(*[F.bit_count(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(page, {m}) as int))"))) for m in (61, 63)]).alias("different"),
        F.min("parent").alias("parent"),
        F.min("tag").alias("tag"),
        F.min("furniture").alias("furniture"),
        F.min("is_text").alias("is_text"),
        F.when(F.min("is_text"), F.min("length")).otherwise(F.sum("length")).alias("length"),
        F.min("block").alias("block"),
        F.sum("texts").alias("texts"),
    )
    valid = vectors.join(sizes, "host").filter(F.col("pages") * HALF >= F.col("n_pages"))

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        rows = list(part[["token", "parent", "tag", "furniture", "is_text", "pages", "total", "length"]].itertuples(index=False, name=None))
        path = content_path(rows, int(part["n_pages"].iloc[0]))
        classes = zip(part["vector"], part["vector2"], part["pages"], part["total"])
        columns = (part[c] for c in ("total", "block", "texts", "different"))
        fixed = fixed_blocks(list(zip(part["token"], part["parent"], part["is_text"], classes, *columns)))
        return pd.DataFrame({"host": [part["host"].iloc[0]], "path": [path], "fixed": [fixed]})

    return valid.groupBy("host").applyInPandas(solve, "host string, path long, fixed array<long>")


def main_texts(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    spool = Spool(pages.sparkSession, "html")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), "html")
    keyed = base.select("host", F.xxhash64("html").alias("page"), "html")
    found = spool.put(deduce(keyed), "templates").select(F.col("host").alias("t_host"), "path", "fixed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch_column(batch, "path").to_pylist()
            fixed = batch_column(batch, "fixed").to_pylist()
            text = [extract(x.as_py() or "", p or None, frozenset(f or ())) for x, p, f in zip(batch_column(batch, "html"), paths, fixed)]
            yield pa.RecordBatch.from_arrays(
                [batch_column(batch, "page_id"), batch_column(batch, "url"), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    joined = base.join(found, F.col("host") == F.col("t_host"), "left").select("page_id", "url", "html", "path", "fixed")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
