"""Main text of web pages by nearest-URL page differencing.

Pages are put in the order of host and path; each is paired with the neighbour
in that order, on the same host, whose path shares the longer prefix.  The
text lines of the two pages (one per block element) are aligned by a longest
common subsequence, and lines that both have are template: they are deleted.

What markup says outright comes first.  Scripts, styles, menus, forms and the
like never become lines; a class or id says so by a whole name (``comments``) or
by a name's first or last word (``post-comments``, ``ad-slot``; not ``no-ads``), and not of an
element around the page's article or main element, nor of a heading in it.  Lines inside an ``article`` or ``main`` element are
never deleted, and where a page has one the lines outside go: differencing
alone keeps menus and adverts that change from page to page, and deletes text
that neighbouring pages quote or copy.  It decides for pages without one.

Scale: one shuffle of text lines.  Pages are dealt into buckets of the order,
one for each BUCKET_BYTES of html, with bounds from a sample of keys, so a host
with a third of all pages fills many buckets.  The first and last page of a bucket go to the next bucket on
either side too, as context, so every page meets its real neighbours.  A task
streams its sorted rows and holds three pages at a time.  A page is scanned in
time proportional to its length, however long or broken its markup.

Edge cases: null or empty html gives the empty text.  A null URL has the empty
host and path.  A neighbour with exactly the same lines is a copy and proves
nothing about templates; the other one is used, or none.  Equal URLs are
neighbours, ordered by page_id; repeated rows stay.
"""

from __future__ import annotations

import html as markup
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lcs
from .url_filter import host_of, path_of

BUCKET_BYTES, KEYS_A_BUCKET, KEY_CHARS = 16 << 20, 32, 256
_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][\w:-]*+)|/)")
_INNER = re.compile("[>\"']")
#: Elements whose content is no markup.
_RAW = frozenset("script style noscript template textarea select svg iframe object title head".split())
_RAW_END = {name: re.compile(rf"</{name}\s*+>", re.I) for name in _RAW}
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_SPACES = frozenset("br td th".split())
_FURNITURE = frozenset("nav aside footer form menu button dialog".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer header masthead menu nav navbar navigation newsletter notice notices popup promo promoted promotion related responses share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)


#: Names that an article's own heading may have.
_HEADINGS = frozenset("banner header masthead".split())
#: Elements that are furniture whatever they hold.
_NEVER = frozenset("nav aside footer menu button dialog".split())


#: Words that turn a name around.
_NOT = frozenset("has have hide hidden no non not with without".split())
_JOINT = re.compile("[-_]+")


def _says_furniture(name: str, in_article: bool) -> bool:
    """Whether a class or id is a furniture name, or begins or ends with one; names of headings count as wholes only, and outside articles."""
    if name in _NAMES:
        return not (in_article and name in _HEADINGS)
    words = [w for w in _JOINT.split(name) if w]
    return len(words) > 1 and _NOT.isdisjoint(words) and any(w in _NAMES and w not in _HEADINGS for w in (words[0], words[-1]))


def _is_furniture(name: str, attributes: str, in_article: bool) -> bool:
    if name in _FURNITURE or name == "header" and not in_article:
        return True
    if not attributes or name in ("html", "body", "article", "main") and "omment" not in attributes:
        return False
    for kind, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if kind.lower() == "role" and value in _ROLES:
            return True
        if kind.lower() in ("class", "id") and any(_says_furniture(n, in_article) for n in value.split()):
            return True
    return False


class Tag(NamedTuple):
    """A piece of markup: its place, and for elements the lower-case name, whether it ends one, and its attributes."""

    start: int
    stop: int
    name: str = ""
    ends: bool = False
    attributes: str = ""

    @property
    def single(self) -> bool:
        return self.attributes.endswith("/")


def tags(page: str) -> list[Tag]:
    """All markup of a page in one pass: no stretch is searched more than a fixed number of times, however broken.

    A ``>`` in quotes doesn't end a tag; from the first tag on that would
    never end so, quotes count for nothing.  A tag without any ``>`` after it
    is text.  Comments and raw elements left open run to the end.
    """
    out: list[Tag] = []
    at, quoting, last = 0, True, page.rfind(">")

    def end_of(start: int) -> int:
        nonlocal quoting
        place = start
        while quoting and (m := _INNER.search(page, place)):
            if m[0] == ">":
                return m.start()
            place = page.find(m[0], m.end()) + 1
            if not place:
                break
        quoting = False
        return page.find(">", start)

    while m := _OPEN.search(page, at):
        if m[0] == "<!--":
            stop = page.find("-->", m.end())
            at = len(page) if stop < 0 else stop + 3
            out.append(Tag(m.start(), at))
            continue
        if m.end() > last:
            break
        if not m[2]:
            at = page.find(">", m.end()) + 1
            out.append(Tag(m.start(), at))
            continue
        name, stop = m[2].lower(), end_of(m.end())
        at = stop + 1
        if name in _RAW and not m[1]:
            close = _RAW_END[name].search(page, at)
            at = close.end() if close else len(page)
            out.append(Tag(m.start(), at))
        else:
            out.append(Tag(m.start(), at, name, bool(m[1]), page[m.end() : stop]))
    return out


def _wrappers(found: list[Tag]) -> set[int]:
    """Places of the elements that hold a main element, or all articles of the page or its main element: never furniture by name."""
    ends: dict[int, int] = {}
    open_at: dict[str, list[int]] = {}
    spots: dict[str, list[int]] = {"article": [], "main": []}
    for i, tag in enumerate(found):
        name = tag.name
        if not name or name in _VOID or tag.single:
            continue
        if tag.ends:
            if open_at.get(name):
                ends[open_at[name].pop()] = i
            continue
        open_at.setdefault(name, []).append(i)
        ends[i] = len(found)
        if name in spots and not _is_furniture(name, tag.attributes, False):
            spots[name].append(i)
    mains, articles = spots["main"], spots["article"]
    if mains:
        articles = [i for i in articles if mains[0] < i < ends[mains[0]]]
    return {i for i, end in ends.items() if bisect_right(mains, i) < bisect_right(mains, end) or articles and i < articles[0] and articles[-1] < end}


def lines(page: str | None) -> list[tuple[bool, str]]:
    """(inside an article or main element, text) of each block with text that is not furniture."""
    out: list[tuple[bool, str]] = []
    text: list[str] = []
    page = page or ""
    inside = skip = 0
    skipped, within = "", False
    at = 0
    found = tags(page)
    wrappers = _wrappers(found)

    def close() -> None:
        if text:
            line = " ".join(markup.unescape("".join(text)).split())
            if line:
                out.append((inside > 0, line))
            text.clear()

    for place, tag in enumerate(found):
        if not skip and tag.start > at:
            text.append(page[at : tag.start])
        at = tag.stop
        name = tag.name
        if not name:
            continue
        if skip:
            if name == skipped:
                if not tag.single:
                    skip += -1 if tag.ends else 1
                continue
            # an element left open ends with what it stands in
            if not tag.ends or name not in ("body", "html") and not (name in ("article", "main") and within):
                continue
            skip = 0
        opens = not tag.ends and not tag.single and name not in _VOID
        if name in _BLOCKS:
            close()
        elif name in _SPACES:
            text.append(" ")
        if opens and _is_furniture(name, tag.attributes, inside > 0) and (name in _NEVER or place not in wrappers):
            skip, skipped, within = 1, name, inside > 0
        elif name in ("article", "main") and (opens or tag.ends):
            inside = max(0, inside + (-1 if tag.ends else 1))
    if not skip:
        text.append(page[at:])
    close()
    return out


def visible(page: str | None) -> str:
    """The article's lines, or all lines of a page without one."""
    found = lines(page)
    return "\n".join(t for kept, t in found if kept) or "\n".join(t for _, t in found)


def difference(own: list[str], other: list[str]) -> list[bool]:
    """Which of a page's lines its neighbour lacks."""
    new = [True] * len(own)
    for i, _ in lcs.common(own, other):
        new[i] = False
    return new


def _shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _text(page: dict, neighbours: list[dict]) -> str:
    own = page["lines"]
    if any(page["marked"]):
        return "\n".join(t for t, m in zip(own, page["marked"], strict=True) if m)
    near = [n for n in neighbours if n["host"] == page["host"] and n["lines"] != own]
    if not near:
        return "\n".join(own)
    best = max(near, key=lambda n: _shared_prefix(n["path"], page["path"]))
    return "\n".join(t for t, new in zip(own, difference(own, best["lines"]), strict=True) if new)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row."""
    url = F.col(url_col)
    # a high and fixed-width form of the id keeps one order for strings and numbers
    key = F.concat_ws("\x01", host_of(url), path_of(url), F.coalesce(F.lpad(F.col(id_col).cast("string"), 20, "0"), F.lit("")))
    keyed = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"), key.alias("key"), F.col(html_col).alias("html"))
    keys = keyed.select(F.substring("key", 1, KEY_CHARS).alias("key"))
    n, size = keyed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("html")), F.lit(0))).first()
    n_buckets = max(1, -(-size // BUCKET_BYTES))
    # bounds need not be keys, so that prefixes do; they decide the sizes of buckets only
    wanted = KEYS_A_BUCKET * n_buckets
    some = sorted(r[0].encode() for r in (keys if n <= 2 * wanted else keys.sample(min(1.0, wanted / n), 42)).collect()) if n_buckets > 1 else []
    bounds = sorted({some[len(some) * i // n_buckets] for i in range(1, n_buckets)}) if some else []
    keys = keyed.select("key")

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(bounds, k.encode()) for k in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column("key")], ["bucket", "key"])

    # one row per bucket
    ends = keys.mapInArrow(bucket, "bucket int, key string").groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("bucket").collect()
    low = {r["low"]: q["bucket"] for q, r in zip(ends, ends[1:], strict=False)}
    high = {q["high"]: r["bucket"] for q, r in zip(ends, ends[1:], strict=False)}
    fields = "page_id long, url string, host string, path string, key string, own boolean, bucket int, lines array<string>, marked array<boolean>"
    names = [f.split()[0] for f in fields.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                rows = []
                for r in whole.slice(lo, 500).to_pylist():
                    found = lines(r.pop("html"))
                    r |= {"lines": [t for _, t in found], "marked": [m for m, _ in found]}
                    k = r["key"]
                    rows.append(r | {"own": True, "bucket": bisect_right(bounds, k.encode())})
                    rows += [r | {"own": False, "bucket": side[k]} for side in (low, high) if k in side]
                yield pa.RecordBatch.from_pylist(rows, schema=out_schema)

    kinds = {"page_id": pa.int64(), "own": pa.bool_(), "bucket": pa.int32(), "lines": pa.list_(pa.string()), "marked": pa.list_(pa.bool_())}
    out_schema = pa.schema([(c, kinds.get(c, pa.string())) for c in names])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 200):
                    yield from batch.slice(lo, 200).to_pylist()
            yield {"bucket": None}

        done: list[tuple] = []
        before = here = None
        for after in rows():
            if here and here.get("own"):
                done.append((here["page_id"], here["url"], _text(here, [p for p in (before, after) if p and p["bucket"] == here["bucket"]])))
                if len(done) == 500:
                    yield batch_of(done)
                    done = []
            before, here = here, after
        if done:
            yield batch_of(done)

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        ids, urls, texts = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    dealt = keyed.mapInArrow(parse, fields).repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "key")
    return dealt.mapInArrow(pair, "page_id long, url string, text string")
