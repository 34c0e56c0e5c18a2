"""Main text of web pages: page structure, and a host suffix array that finds boilerplate by repetition.

A page is cut into blocks in page order. Blocks inside menus, headers, footers, sidebars, notices,
adverts, forms and reader comments (by element, role, class or id) are left out; if the page marks an article
(else a main part), only that is looked at.

What is left is a token stream for each page, and the streams of one host together make its suffix array. A host may hold
a third of all pages, so the array is not built in one place: suffixes are brought together by (host, first
MIN_TOKENS tokens). First only those at anchors are: block starts, and of every REACH consecutive places the one whose first
tokens hash lowest, so that a substring of MIN_TOKENS + REACH - 1 tokens that two streams share has an anchor at the same
token in both, wherever it starts. Around anchors that repeat, up to REACH tokens to either side, all suffixes are looked
up, so the ends of a repeated substring are found to the token. Covered tokens go, the others stay, in their blocks.

Pages of one host with the same stream count as one, so copies of a page keep their text. Outside a marked article a
substring on two pages is boilerplate; but what stands on fewer than FEW_PAGES stays if it covers over half of what is left
of the page, since such pages are versions of each other. Inside a marked article the substring must stand on more than
half of the host's pages, at least FEW_PAGES, since articles quote each other; if over half of it were boilerplate, the
pages are copies of one article and it is kept. A shared run shorter than MIN_TOKENS + REACH - 1 tokens that starts at no
block and near no longer one may stay.

Null and empty pages give the empty text; a null url is a host of its own name (the empty string); repeated rows
are kept, and do not count as distinct pages. Nothing is cut by length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from gritstone.llm.store import map_text, slices, stored

MIN_TOKENS, REACH = 8, 22
FEW_PAGES = 4

# HTML's element names, and the names sites give to what is not the article.
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section
summary table tbody td tfoot th thead title tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|select|iframe|svg|canvas|object|math|title"
LEFT_OUT = set("nav header footer aside form head menu search dialog button".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
NAMES = set("""ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion
cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing
social related recommended recommendations sidebar aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs
footer masthead topbar toolbar pager pagination comment comments commentlist disqus reply replies respond discussion reviews
form search skip""".split())
KEPT_NAMES = set("html body main".split())

#: A tag that is never closed reaches the end of the page, so no place is read twice; a quote counts after "=" only.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"'=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)(?P<close>>|\Z)", re.S | re.I)
PLAIN_TAG = re.compile("<[^<>]*>")
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def is_left_out(name: str, attrs: str, in_article: bool) -> bool:
    """Whether the element, by its name or attributes, holds something other than the article."""
    if name in LEFT_OUT and not (name == "header" and in_article):
        return True
    if not attrs or name in KEPT_NAMES:
        return False
    for attribute, value in ATTRIBUTE.findall(attrs):
        kind, value = attribute.lower(), value.strip("\"'")
        if kind == "hidden" or kind == "aria-hidden" and value.lower() == "true":
            return True
        if kind == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if kind == "role" and value.lower() in ROLES:
            return True
        if kind in ("class", "id"):
            words = set(WORDS.findall(CAMEL.sub(" ", value).lower()))
            if words & NAMES or "header" in words and not in_article:
                return True
    return False


def blocks(html: str) -> tuple[list[str], bool]:
    """The texts of the blocks that may be the article, in page order; whether the page marks one."""
    found: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]  # name, left out, article, main
    depths: dict[str, list[int]] = {}  # where each name is open; under "" the blocks
    pieces: list[str] = []

    def flush() -> None:
        text = "".join(pieces)
        pieces.clear()
        text = " ".join((unescape(text) if "&" in text else text).split())
        if text and not stack[-1][1]:
            found.append((text, stack[-1][2], stack[-1][3]))

    def close(depth: int) -> None:
        for at in range(len(stack) - 1, depth - 1, -1):
            name = stack.pop()[0]
            depths[name].pop()
            if name in BLOCKS:
                depths[""].pop()

    at = 0
    for tag in TAG.finditer(html):
        if tag.start() > at:
            pieces.append(html[at : tag.start()])
        at = tag.end()
        if not tag["name"]:
            continue
        if not tag["close"]:
            pieces.append(PLAIN_TAG.sub(" ", tag[0]))
            break
        name = tag["name"].lower()
        if name in BLOCKS:
            flush()
        elif name == "br":
            pieces.append(" ")
        if tag["end"]:
            if depths.get(name) and (name in BLOCKS or depths[name][-1] > (depths.get("") or [0])[-1]):
                flush()
                close(depths[name][-1])
            continue
        if name in VOID or tag["attrs"].endswith("/"):
            continue
        if name in BLOCKS and stack[-1][0] == "p":
            close(len(stack) - 1)
        _, out, article, main = stack[-1]
        leaves = is_left_out(name, tag["attrs"], article)
        if leaves and name not in BLOCKS:
            flush()
        if leaves or name in BLOCKS and name not in ("p", "li", "dt", "dd", "td", "th", "tr", "option"):
            for known in (name, "") if name in BLOCKS else (name,):
                depths.setdefault(known, []).append(len(stack))
            stack.append((name, out or leaves, article or name == "article", main or name == "main"))
    pieces.append(html[at:])
    flush()
    for marked in (1, 2):
        if any(block[marked] for block in found):
            return [block[0] for block in found if block[marked]], True
    return [block[0] for block in found], False


_LETTER = np.random.default_rng(3).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def windows(texts: list[str], host: int = 0) -> np.ndarray:
    """A hash of host and MIN_TOKENS consecutive tokens for every place of the page's stream that has as many."""
    letters = np.frombuffer(" ".join(texts).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(letters):
        return np.zeros(0, dtype=np.uint64)
    gaps = np.flatnonzero(letters == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(letters))
    starts, ends = starts[: max(0, len(starts) - MIN_TOKENS + 1)], ends[MIN_TOKENS - 1 :]
    # A polynomial in _BASE over the letters, so any stretch is a difference of two sums, moved back to its start.
    powers = np.full(len(letters), _BASE, dtype=np.uint64).cumprod()
    sums = np.append(np.uint64(0), (_LETTER[letters] * powers).cumsum())
    back = np.full(len(letters), _BACK, dtype=np.uint64).cumprod()
    return scrambled(scrambled((sums[ends] - sums[starts]) * back[starts]) ^ np.uint64(host & ((1 << 64) - 1)))


def scrambled(values: np.ndarray) -> np.ndarray:
    out = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def anchors(texts: list[str], keys: np.ndarray) -> np.ndarray:
    """The places of block starts, and of every REACH places (all, if there are fewer) those of least hash."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    starts = np.cumsum([0, *(text.count(" ") + 1 for text in texts)])
    reach = min(REACH, len(keys))
    order = scrambled(keys ^ np.uint64(REACH))
    least = running(np.minimum, order, reach)  # of the places from each on
    ends = np.zeros(reach - 1, dtype=np.uint64)
    most = running(np.maximum, np.concatenate([ends, least, ends]), reach)  # of the neighbourhoods that hold each place
    return np.unique(np.concatenate([starts[starts < len(keys)], np.flatnonzero(order == most)]))


def running(least: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """The least (or greatest) of every ``width`` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values, have = least(values[: len(values) - step], values[step:]), have + step
    return values


def around(keys: np.ndarray, repeated: set[int]) -> np.ndarray:
    """The places up to REACH before or after one whose key is repeated."""
    hits = np.isin(keys.view(np.int64), np.fromiter(repeated, dtype=np.int64, count=len(repeated)))
    edges = np.zeros(len(keys) + 1, dtype=np.int64)
    at = np.flatnonzero(hits)
    np.add.at(edges, np.maximum(at - REACH, 0), 1)
    np.add.at(edges, np.minimum(at + REACH + 1, len(keys)), -1)
    return np.flatnonzero(np.cumsum(edges[:-1]))


def covered(keys: np.ndarray, repeated: set[int], size: int) -> np.ndarray:
    """For each of ``size`` tokens, whether it lies in a window whose key is repeated."""
    hits = np.isin(keys.view(np.int64), np.fromiter(repeated, dtype=np.int64, count=len(repeated)))
    edges = np.zeros(size + 1, dtype=np.int64)
    edges[: len(keys)] += hits
    edges[MIN_TOKENS : MIN_TOKENS + len(keys)] -= hits
    return np.cumsum(edges[:-1]) > 0


def main_text(texts: list[str], marked: bool, host: int, often: set[int], seldom: set[int]) -> str:
    """The page's blocks (as ``blocks`` gives them) without the tokens that repeated windows cover, joined by blank lines.

    ``often`` has the keys of windows that are boilerplate on many pages, ``seldom`` of those on fewer than FEW_PAGES.
    """
    if not often and not seldom:
        return "\n\n".join(texts)
    keys, size = windows(texts, host), sum(text.count(" ") + 1 for text in texts)
    gone = covered(keys, often, size)
    if marked and 2 * gone.sum() > size:
        return "\n\n".join(texts)
    few = covered(keys, seldom, size) & ~gone
    if 2 * few.sum() <= size - gone.sum():
        gone |= few
    kept, at = [], 0
    for text in texts:
        tokens = text.split(" ")
        left = [token for token, out in zip(tokens, gone[at : at + len(tokens)]) if not out]
        at += len(tokens)
        if left:
            kept.append(" ".join(left))
    return "\n\n".join(kept)


def streams(pages: DataFrame) -> DataFrame:
    """rest (the columns of the page but html), host, marked, stream (equal for equal token streams), blocks, and keys at anchors, of every page."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))

    def run(rows: pa.RecordBatch) -> pa.RecordBatch:
        marks, same, texts, keys = [], [], [], []
        for html, at in zip(rows.column("html"), rows.column("host").to_pylist()):
            own, marked = blocks(html.as_py() or "")
            found = windows(own, at)
            marks.append(marked)
            same.append(xxh64_intdigest(" ".join(own).encode("utf-8", "surrogatepass")) - (1 << 63))
            texts.append(own)
            keys.append(np.unique(found[anchors(own, found)].view(np.int64)))
        return pa.RecordBatch.from_arrays(
            [rows.column("rest"), rows.column("host"), pa.array(marks, pa.bool_()), pa.array(same, pa.int64()),
             pa.array(texts, pa.list_(pa.string())), pa.array(keys, pa.list_(pa.int64()))], ["rest", "host", "marked", "same", "blocks", "keys"])

    rest = F.struct(*[c for c in pages.columns if c not in ("html", "text", "host")])
    wide = pages.select(rest.alias("rest"), F.xxhash64(host).alias("host"), "html")
    schema = f"rest {wide.schema['rest'].dataType.simpleString()}, host bigint, marked boolean, same bigint, blocks array<string>, keys array<bigint>"
    return map_text(wide, run, schema, "html").withColumn("stream", F.xxhash64("host", "same", "marked")).drop("same")


def suffixes_around(read: DataFrame) -> DataFrame:
    """(stream, keys): of every row (stream, host, blocks, near) the keys of all suffixes around those that ``near`` holds."""

    def run(rows: pa.RecordBatch) -> pa.RecordBatch:
        keys = []
        for texts, host, near in zip(*(rows.column(c).to_pylist() for c in ("blocks", "host", "near"))):
            found = windows(texts, host)
            keys.append(np.unique(found[around(found, set(near))].view(np.int64)))
        return pa.RecordBatch.from_arrays([rows.column("stream"), pa.array(keys, pa.list_(pa.int64()))], ["stream", "keys"])

    return map_text(read.select("stream", "host", "blocks", "near"), run, "stream bigint, keys array<bigint>", "blocks")


def repeats(found: DataFrame, known: DataFrame, hosts: DataFrame) -> DataFrame:
    """(stream, often, seldom): the repeated keys among ``found`` (stream, keys).

    ``known`` has stream, host and marked once for each stream, ``hosts`` the number of streams of each host.
    """
    each = found.select("stream", F.explode("keys").alias("key"))
    shared = each.groupBy("key").agg(F.min("stream").alias("a"), F.max("stream").alias("b")).where("a <> b").select("key")
    # Stored first, so that its size is known when the join is planned.
    hits = stored(each.join(stored(shared, "shared"), "key").distinct(), "hits")
    on = hits.groupBy("key").agg(F.count("*").alias("n"), F.min("stream").alias("stream")).join(known, "stream").join(hosts, "host")
    marked = hits.join(on.select("key", "n", "pages"), "key").join(known.select("stream", "marked"), "stream")
    many = (F.col("n") >= FEW_PAGES) & (~F.col("marked") | (2 * F.col("n") > F.col("pages")))
    few = (F.col("n") < FEW_PAGES) & ~F.col("marked")
    return marked.where(many | few).withColumn("many", many).groupBy("stream").agg(
        F.collect_list(F.when(F.col("many"), F.col("key"))).alias("often"), F.collect_list(F.when(~F.col("many"), F.col("key"))).alias("seldom"))


def extract(pages: DataFrame) -> DataFrame:
    """All columns of ``pages`` (page_id, url, html, ...) but html, and ``text``.

    Columns named text or host are dropped first.
    """
    read = stored(streams(pages), "streams", compression="zstd")
    known = stored(read.select("stream", "host", "marked").distinct(), "known")
    hosts = stored(known.groupBy("host").agg(F.count("*").alias("pages")), "hosts")
    anchored = stored(repeats(read.select("stream", "keys"), known, hosts), "anchored")
    near = read.select("stream", "host", "blocks").join(anchored.select("stream", F.concat("often", "seldom").alias("near")), "stream")
    covers = stored(repeats(stored(suffixes_around(near), "around"), known, hosts), "covers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "blocks"):
                texts = [
                    main_text(own, marked, host, set(often or ()), set(seldom or ()))
                    for own, marked, host, often, seldom in zip(*(rows.column(c).to_pylist() for c in ("blocks", "marked", "host", "often", "seldom")))
                ]
                yield pa.RecordBatch.from_arrays([rows.column("rest"), pa.array(texts, pa.string())], ["rest", "text"])

    joined = read.join(covers, "stream", "left").select("rest", "blocks", "marked", "host", "often", "seldom")
    return joined.mapInArrow(run, f"rest {read.schema['rest'].dataType.simpleString()}, text string").select("rest.*", "text")
