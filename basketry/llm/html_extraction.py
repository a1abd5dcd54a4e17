"""Main text of web pages, by template deduction from equivalence classes of tokens.

Tokens of a page are its tags, told apart by their place in the tree, and its text blocks, told apart by place and
wording. Over the pages of a host, a token's occurrence vector is its count on every page. Tokens with equal
vectors form an equivalence class. Vectors are never built: a token's vector is known by its number of pages, its
total, and the sum of a hash of (page, count), which combine on the map side and are equal for equal vectors.

Per host (`build_template`): a class is valid when it is large (two tokens, a tag among them) and frequent (three
pages and a tenth of the host's), and when it nests: the elements its tags and blocks stand in belong to valid
classes, up to the root class. Text blocks in valid classes are constants of the template; all other blocks are its slots. Of the
slots, the host's main one is the element whose direct blocks hold most varying text outside links.

Per page: what stands in an article or main element is taken, without one the main slot of the host with the
headings before it, without host or template the page's own largest. Left out in it are constants of the template (unless
they outweigh the rest: then the pages are copies and the constants are the text) and elements that by tag, role or
class name are menus, headers, footers, sidebars, notices, adverts, forms or reader comments. If class names would leave
nothing, only tags and roles count.

A host with most pages is not one task: its token rows combine on the map side, and pages are joined to the templates
by host and a salt, which splits the hosts (64 at most) that hold more than a 64th of all pages. A template has at most
ten times the tokens of an average page of its host, whatever its number of pages.

Defined cases: white space is what Python's `str.split` takes; blocks end at block elements, `<br>` is white space.
NULL or empty html gives an empty text. Equal pages of a host count once in its template, and each has its result.
A page without host in its url, or with a NULL url, is read by itself. Unclosed tags end with their parents or the page,
an unclosed comment, script or style takes the rest. Very long pages are read whole. An empty table gives
an empty result. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from .hot_join import join_spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

LEAST_PAGES = 3  # of a class
LEAST_SHARE = 0.1  # of a host's pages that a class is on
MEMO_KEYS = 1 << 14
_TAG, _TEXT, _MASS, _PAGE = 0, 1, 2, 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+[^>]*)>?",
    re.S,
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
_DIGITS = re.compile("[0-9]{2,}")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea xmp noembed noframes iframe".split())
_OUTSIDE = frozenset(
    "head title script style noscript template nav aside footer form button select textarea iframe object svg canvas audio video dialog menu"
    " xmp noembed noframes".split()
)
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_CLASSES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar topbar masthead"
    " sidebar sidenav aside widget widgets footer copyright legal"
    " cookie cookies consent gdpr notice notices alert disclaimer popup modal overlay newsletter subscribe subscription"
    " form login signup register search share sharing social related recommended recommendations trending popular"
    " comment comments disqus replies respond".split()
)
_CLOSES = {  # an opening tag ends these, if they are the nearest of their kind
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
_KEEPS_P = _INLINE | _VOID | frozenset("script style noscript template iframe textarea object svg math button select audio video canvas img map".split())


def _hash(parent: int, what: str) -> int:
    """Signed 64 bits."""
    value = xxhash.xxh64_intdigest(what.encode("utf-8", "surrogatepass"), parent & 0xFFFFFFFFFFFFFFFF)
    return value - (1 << 64) if value >> 63 else value


class Element:
    __slots__ = ("name", "place", "outside", "by_class", "scoped", "in_link", "mains")

    def __init__(self, name, place, outside, by_class, scoped, in_link, mains):
        self.name, self.place, self.outside, self.by_class = name, place, outside, by_class
        self.scoped, self.in_link, self.mains = scoped, in_link, mains


class Block:
    """Text between two block tags: where it stands, and what it is part of."""

    __slots__ = ("place", "up", "container", "outside", "by_class", "scoped", "in_main", "heading", "text", "linked")

    def __init__(self, element, up, container, in_main, heading, text, linked):
        self.place, self.up, self.container, self.in_main, self.heading = element.place, up, container, in_main, heading
        self.outside, self.by_class, self.scoped = element.outside, element.by_class, element.scoped
        self.text, self.linked = text, linked


def _says_boilerplate(value: str) -> bool:
    """Whether the first or last part of one of the names is a boilerplate word."""
    for name in value.split():
        parts = _PARTS.findall(name)
        if parts and (parts[0].lower() in _CLASSES or parts[-1].lower() in _CLASSES):
            return True
    return False


def _tag(name: str, attrs: str) -> tuple[str, bool, bool, bool]:
    """What an opening tag says: its label, whether it is outside the text by tag, role or style, or by class name, whether it holds the text."""
    label, outside, by_class, scoped = name, name in _OUTSIDE, False, name in ("article", "main")
    for key, *values, hidden in _ATTR.findall(attrs):
        key, value = key.lower(), "".join(values)
        if hidden or key == "style" and "display:none" in value.replace(" ", "").lower() or key == "aria-hidden" and value.lower() == "true":
            outside = True
        elif key == "role":
            outside |= value.lower() in _ROLES
            scoped |= value.lower() == "main"
        elif key in ("class", "id"):
            label += f" {key}={_DIGITS.sub('0', value)}"
            by_class |= name not in ("html", "body") and _says_boilerplate(value)
    return label, outside, by_class, scoped


class Memo(dict):
    """What `make` says of a key, kept for a bounded number of keys."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= MEMO_KEYS:
            self.clear()
        self[key] = value = self.make(*key)
        return value


def read_page(html: str, main: int | None = None, tag_of: Memo | None = None, place_of: Memo | None = None) -> tuple[dict[int, tuple[int, int]], list[Block]]:
    """(tags, blocks): of every tag place its count and the place it stands in, and the text blocks in order.

    `main` is the place of an element whose blocks are to be marked. The memos (of `_tag` and `_hash`) may be
    shared by the pages of a task.
    """
    tag_of, place_of = Memo(_tag) if tag_of is None else tag_of, Memo(_hash) if place_of is None else place_of
    root = Element("", 0, False, False, False, False, 0)
    stack, open_names, tags, blocks = [root], Counter(), {}, []
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        words = " ".join("".join(text).split())
        if words:
            at = len(stack) - 1
            while at and stack[at].name in _INLINE:
                at -= 1
            block = stack[at]
            up = stack[max(0, at - 1)]
            container = up if block.name in ("p", "li", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6") else block
            blocks.append(Block(block, up.place, container.place, bool(block.mains), block.name in ("h1", "h2"), words, min(linked, len(words))))
        text.clear()
        linked = 0

    def leave(name: str) -> None:
        while True:
            gone = stack.pop()
            open_names[gone.name] -= 1
            if gone.name == name:
                return

    def enter(name: str, attrs: str) -> None:
        up = stack[-1]
        label, more_outside, more_by_class, more_scoped = tag_of[name, attrs]
        outside = up.outside or more_outside or name == "header" and not up.scoped
        by_class = up.by_class or more_by_class
        scoped = up.scoped or more_scoped
        place = place_of[up.place, label]
        count = tags.get(place)
        tags[place] = (count[0] + 1 if count else 1, up.place)
        if name not in _VOID:
            stack.append(Element(name, place, outside, by_class, scoped, up.in_link or name == "a", up.mains + (place == main)))
            open_names[name] += 1

    at = 0
    while at < len(html):
        found = _TOKEN.search(html, at)
        plain = html[at : found.start() if found else len(html)]
        if plain:
            plain = unescape(plain)
            text.append(plain)
            if stack[-1].in_link:
                linked += len(plain)
        if not found:
            break
        at = max(found.end(), found.start() + 1)
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            text.append(" ")
            continue
        if name not in _INLINE:
            flush()
        if found["close"]:
            if open_names[name]:
                leave(name)
            continue
        if name == "body" and open_names["head"]:
            leave("head")
        if open_names["p"] and name not in _KEEPS_P:
            leave("p")
        for other in _CLOSES.get(name, ()):
            scope = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}.get(name, ("table",))
            top = next((e.name for e in reversed(stack) if e.name == other or e.name in scope), None)
            if top == other:
                leave(other)
        enter(name, found["attrs"])
        if name in _RAW and not found["attrs"].rstrip().endswith("/"):
            end = re.compile(rf"</{name}\b", re.I).search(html, at)
            at = end.start() if end else len(html)
    flush()
    return tags, blocks


def text_token(block: Block) -> int:
    return _hash(block.place, f"={block.text}")


def main_text(blocks: list[Block], constants: frozenset[int], known_main: bool) -> str:
    """The text of one page from its blocks; `constants` are the template's text tokens."""
    for by_class in (True, False):
        inside = [b for b in blocks if not b.outside and not (by_class and b.by_class)]
        chosen = [b for b in inside if b.scoped]
        if not chosen:
            slot = [b for b in inside if b.in_main] if known_main else []
            if not slot:  # no template: the page's own largest container
                mass = Counter()
                for b in inside:
                    mass[b.container] += len(b.text) - b.linked
                best = max(mass, key=lambda c: (mass[c], c)) if mass else None
                slot = [b for b in inside if b.container == best]
            first = next((i for i, b in enumerate(inside) if slot and b is slot[0]), 0)
            member = set(map(id, slot))
            chosen = [b for i, b in enumerate(inside) if id(b) in member or (b.heading and i < first)]
        if chosen:
            varying = [b for b in chosen if text_token(b) not in constants]
            if 2 * sum(len(b.text) for b in varying) >= sum(len(b.text) for b in chosen):
                chosen = varying
            return " ".join(b.text for b in chosen)
    return ""


_TOKEN_ROW = "host string, kind long, token long, parent long, page long, n long"


def token_rows(pages: DataFrame) -> DataFrame:
    """Of every page with a host: its tags, text blocks and the text that containers hold, each with its count."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = Memo(_tag), Memo(_hash)
        for batch in batches:
            rows = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                html = html.as_py() or ""
                page = _hash(0, html)
                tags, blocks = read_page(html, None, *memos)
                rows += [(host, _TAG, place, parent, page, n) for place, (n, parent) in tags.items()]
                rows.append((host, _PAGE, 0, 0, page, 1))
                texts, mass = Counter(), Counter()
                for b in blocks:
                    texts[text_token(b), b.up] += 1
                    if not (b.outside or b.by_class):
                        mass[b.container] += len(b.text) - b.linked
                rows += [(host, _TEXT, token, up, page, n) for (token, up), n in texts.items()]
                rows += [(host, _MASS, place, 0, page, n) for place, n in mass.items()]
            if rows:
                kinds = (pa.string(), *[pa.int64()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["host", "kind", "token", "parent", "page", "n"])

    return pages.select("host", "html").filter("host IS NOT NULL").mapInArrow(of_batches, _TOKEN_ROW)


def build_template(tokens: pd.DataFrame) -> tuple[int | None, list[int]]:
    """(place of the main slot, text constants) from a host's tokens with their vectors.

    Columns: kind, token, parent, pages, total, v1, v2, host_pages. A host's rows are bounded by ten average pages.
    """
    mass = tokens[tokens["kind"] == _MASS].sort_values(["total", "token"], ascending=[False, True])
    main = int(mass["token"].iloc[0]) if len(mass) else None
    frequent = tokens[(tokens["kind"] != _MASS) & (tokens["pages"] >= LEAST_PAGES)]
    tag_places, constants = {0}, []
    classes = []
    for _, of_class in frequent.groupby(["pages", "total", "v1", "v2"], sort=False):
        if len(of_class) > 1 and (of_class["kind"] == _TAG).any():
            classes.append(of_class)
    waiting = classes
    while waiting:  # outer classes first: a class nests when its places are in the template or in itself
        nested, rest = [], []
        for of_class in waiting:
            known = tag_places | set(of_class.loc[of_class["kind"] == _TAG, "token"])
            (nested if set(of_class["parent"]) <= known else rest).append(of_class)
        if not nested:
            break
        for of_class in nested:
            tag_places |= set(of_class.loc[of_class["kind"] == _TAG, "token"])
            constants += of_class.loc[of_class["kind"] == _TEXT, "token"].tolist()
        waiting = rest
    return main, sorted(constants)


def templates(pages: DataFrame) -> DataFrame:
    """(host, main, constants) of every host; `pages` has the columns host and html."""
    rows = token_rows(pages).distinct()  # equal pages of a host are one
    at = F.xxhash64("page", "n")
    vectors = rows.groupBy("host", "kind", "token").agg(
        F.min("parent").alias("parent"),
        F.count("*").alias("pages"),
        F.sum("n").alias("total"),
        F.sum(F.shiftrightunsigned(at, 32)).alias("v1"),
        F.sum(at.bitwiseAND(F.lit(0xFFFFFFFF))).alias("v2"),
    )
    vectors = stage(vectors.filter((F.col("kind") != _TEXT) | (F.col("pages") >= LEAST_PAGES)))  # without the texts of single pages
    hosts = vectors.filter(F.col("kind") == _PAGE).select("host", F.col("pages").alias("host_pages"))
    frequent = vectors.filter(F.col("kind") != _PAGE).join(hosts, "host").filter(F.col("pages") >= F.col("host_pages") * F.lit(LEAST_SHARE))

    def of_host(key: tuple, tokens: pd.DataFrame) -> pd.DataFrame:
        main, constants = build_template(tokens)
        return pd.DataFrame({"host": [key[0]], "main": pd.array([main], "Int64"), "constants": [constants]})

    found = frequent.groupBy("host").applyInPandas(of_host, "host string, main long, constants array<long>")
    return stage(found)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memos = Memo(_tag), Memo(_hash)
    for batch in batches:
        texts, known = [], {None: (None, frozenset())}
        for html, host, main, constants in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3), batch.column(4)):
            if host not in known:
                known[host] = main.as_py(), frozenset(constants.as_py() or ())
            main, constants = known[host]
            _, blocks = read_page(html.as_py() or "", main, *memos)
            texts.append(main_text(blocks, constants, main is not None))
        columns = [batch.column(0), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["_carried", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    host = F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    carried = F.struct(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = pages.select(carried.alias("_carried"), F.col(html_col).alias("html"), F.when(host != "", host).alias("host"))
    found = templates(rows)
    joined = join_spread(rows, found, "host").select("_carried", "html", "host", "main", "constants")
    kind = rows.schema["_carried"].dataType.simpleString()
    return joined.mapInArrow(_extract, f"_carried {kind}, text string, n_chars long").select("_carried.*", "text", "n_chars")


def op13_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return extract(spark.read.parquet(f"{d}/pages.parquet"))
