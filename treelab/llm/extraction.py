"""Main text of web pages: markup tells zones, a host suffix array tells what repeats.

A page is parsed into blocks, the runs of text between block-level tags. Menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are known by tag, role, class or id and never belong to the text (a headline in a page header
that stands inside an article does). If the page marks an article, a main part or a content part, its blocks are the text,
in that order of preference.

Pages that mark none are judged by their host. The token streams of a host's pages are concatenated and a suffix array is sorted
by prefix doubling to the depth of ``MIN_RUN`` tokens; every run of at least that many tokens that stands on two distinct pages
or more is a repeat. Blocks covered by repeats are boilerplate and go, unique runs stay; a page that is covered as a whole is a copy and keeps its
text. How many tokens of a page repeat on its host is returned for all pages.

Hosts of more than ``PAGES_PER_ARRAY`` pages are dealt to several arrays by hash, so no host is ever in one task. What repeats between
arrays is found in two rounds. In each, an array sends keys and is told which of them stand on two distinct pages of the host. The keys of the
first round are 32 bits of the least hash of ``PICK`` tokens in each run, which equal runs share; those of the second are the 64-bit hashes of the
runs whose pick is shared, so that only few are sent, and the answer is the same as from one array over the whole host.

Null or empty html gives an empty text; a null url is a host of its own; equal pages count as one page, repeated rows all get a row;
very long pages are parsed whole; unclosed and misnested markup never fails. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from treelab.llm import text as X
from treelab.llm.shared import settle

MIN_RUN = 12
PAGES_PER_ARRAY = 64
#: Tokens of the part by which runs are compared first.
PICK = 4
#: Arrays whose keys are compared in one group, up to ``MOST_PARTS`` groups a host; above that, ``MOST_LOTS`` of them.
FEW_LOTS, MOST_PARTS, MOST_LOTS = 16, 64, 1024
#: A block goes if this share of its tokens repeats; a page is a copy if this share of its open blocks' tokens does.
COVERED = 0.8

#: Fixed names of HTML: elements without content, with raw content, that separate blocks, and inline ones that close out of order.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object select xmp noembed noframes".split())
TEXT_ONLY = frozenset("script style title textarea xmp".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
                   "h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot "
                   "thead tr ul").split())
SPACE_TAGS = frozenset(["br", "td", "th"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Fixed names by which parts outside the article are known.
CHROME_TAGS = frozenset("nav footer aside form dialog menu button search".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
CHROME_NAMES = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                          "notices alert popup modal overlay newsletter subscribe subscription paywall share sharing social related recommended "
                          "recommendations trending sidebar aside nav navbar navigation navigations menu menus breadcrumb breadcrumbs footer foot "
                          "comment comments commentlist disqus reply replies respond discussion widget widgets toolbar pagination pager copyright "
                          "legal disclaimer login signin signup register search skip masthead topbar teaser teasers outbrain taboola").split())
HEADER_NAMES = frozenset(["header"])
CONTENT_NAMES = frozenset("content article post entry story main articlebody maincontent".split())
STATE_NAMES = frozenset("has no not with without is js".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

ARTICLE, MAIN, CONTENT, OPEN = 3, 2, 1, 0


def _names(attributes: dict[str, str]) -> list[list[str]]:
    """Classes and id, each split into its parts."""
    listed = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    return [p for p in (NAME_PARTS.findall(CAMEL.sub("-", n).lower()) for n in listed) if p]


def _named(parts: list[list[str]], names: frozenset[str]) -> bool:
    return any((p[0] in names or p[-1] in names) and p[0] not in STATE_NAMES for p in parts)


def _role(tag: str, raw: str) -> tuple[bool, bool, int]:
    """Of an opened element: whether it is no part of the article, whether it is a header, and the zone it marks."""
    if not raw or raw.isspace():
        return tag in CHROME_TAGS, tag == "header", ARTICLE if tag == "article" else MAIN if tag == "main" else OPEN
    attributes = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}
    parts, role = _names(attributes), attributes.get("role", "").lower()
    style = attributes.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in style
    if tag in ("body", "html"):
        return False, False, OPEN
    body = "articlebody" in attributes.get("itemprop", "").lower()
    if tag == "main" or role == "main":
        return hidden, False, MAIN
    if tag == "article" or body or role == "article":
        return hidden or any(p[0] in ("comment", "comments", "reply", "teaser", "related") for p in parts), False, ARTICLE
    chrome = hidden or tag in CHROME_TAGS or role in CHROME_ROLES or _named(parts, CHROME_NAMES)
    header = tag == "header" or _named(parts, HEADER_NAMES)
    return chrome, header, CONTENT if not chrome and tag in ("div", "section", "td") and _named(parts, CONTENT_NAMES) else OPEN


def blocks_of(page: str | None) -> list[tuple[str, int, bool]]:
    """(text, zone, whether it may belong to the article) of every block with text, in page order."""
    if not page:
        return []
    out: list[tuple[str, int, bool]] = []
    pieces: list[str] = []
    stack: list[tuple[str, bool, int, bool]] = [("", True, OPEN, False)]  # tag, article text may stand here, zone, in a header

    def flush(heading: bool) -> None:
        if pieces:
            body = "".join(pieces)
            pieces.clear()
            text = " ".join((html.unescape(body) if "&" in body else body).split())
            if text:
                _, ok, zone, header = stack[-1]
                out.append((text, zone, ok and (not header or (heading and zone != OPEN))))

    at, heading, end = 0, False, len(page)
    while at < end:
        m = TAG.search(page, at)
        if m is None:
            pieces.append(page[at:])
            break
        if m.start() > at:
            pieces.append(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, closes, raw = tag.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in SPACE_TAGS:
            pieces.append(" ")
        if tag in BLOCK:
            flush(heading)
            heading = False
        if closes:
            _close(stack, tag)
            continue
        if tag in RAW:
            found = re.compile(rf"</{tag}\s*[^>]*>", re.I).search(page, at) if not raw.endswith("/") else None
            at = found.end() if found else end if tag in TEXT_ONLY else at
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            _imply_ends(stack, tag)
            heading = tag in HEADINGS
        chrome, header, zone = _role(tag, raw)
        _, ok, around, in_header = stack[-1]
        stack.append((tag, ok and not chrome, max(zone, around), in_header or header))
    flush(heading)
    return out


def _close(stack: list, tag: str) -> None:
    """Ends the nearest open ``tag``: with all inside it if it is a block, alone if it is inline."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] == tag:
            if tag in BLOCK or tag in SPACE_TAGS:
                del stack[i:]
            else:
                del stack[i]
            return


def _imply_ends(stack: list, tag: str) -> None:
    """A block ends an open paragraph; a list item, row or term ends the one before."""
    for i in range(len(stack) - 1, 0, -1):
        name = stack[i][0]
        if name == "p" or (name == tag and tag in ("li", "tr", "option")) or (tag in ("dt", "dd") and name in ("dt", "dd")):
            del stack[i:]
            return
        if name in BLOCK:
            return


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def repeats(page: np.ndarray, token: np.ndarray, copy: np.ndarray, depth: int = MIN_RUN) -> np.ndarray:
    """Whether each token lies in a run of ``depth`` tokens that stands on two distinct pages. ``page`` ascending; pages with equal
    ``copy`` are one page. The suffixes are ranked by their first 1, 2, 4, ... tokens, then by ``depth``."""
    n = len(token)
    if n < depth:
        return np.zeros(n, bool)
    # a stop of its own after each page keeps runs inside it
    place = np.arange(n) + page
    size = n + int(page[-1]) + 1
    rank = np.arange(size, dtype=np.int64) + (1 << 40)
    rank[place] = np.unique(token, return_inverse=True)[1]
    owner = np.full(size, -1, np.int64)
    owner[place] = copy
    level = {1: np.unique(rank, return_inverse=True)[1]}
    length = 1
    while length < depth:
        step = min(length, depth - length)
        tail = level[max(k for k in level if k <= step)]
        step = max(k for k in level if k <= step)
        following = np.full(size, -1, np.int64)
        following[: size - length] = tail[length:]
        length += step
        level[length] = np.unique(level[length - step] * (size + 1) + following + 1, return_inverse=True)[1]
    order = np.lexsort((owner, level[depth]))
    suffix, of = level[depth][order], owner[order]
    group = np.cumsum(np.concatenate(([True], suffix[1:] != suffix[:-1]))) - 1
    lowest, highest = np.full(group[-1] + 1, np.iinfo(np.int64).max), np.full(group[-1] + 1, -1)
    np.minimum.at(lowest, group, of)
    np.maximum.at(highest, group, of)
    again = np.zeros(size, bool)
    again[order] = (lowest != highest)[group]
    again &= owner >= 0
    cover = np.zeros(size + depth + 1, np.int64)
    cover[np.flatnonzero(again)] += 1
    cover[np.flatnonzero(again) + depth] -= 1
    return (np.cumsum(cover)[:size] > 0)[place]


def packed_blocks(blocks: list[tuple[str, int, bool]]) -> bytes:
    """A line per block, which begins with its zone and whether it may belong to the article; blocks have no line breaks."""
    return "\n".join(f"{chr(48 + 2 * zone + ok)}{text}" for text, zone, ok in blocks).encode()


def unpacked_blocks(data: bytes) -> list[tuple[str, int, bool]]:
    return [(x[1:], (ord(x[0]) - 48) >> 1, bool((ord(x[0]) - 48) & 1)) for x in data.decode().split("\n")] if data else []


class Tokens:
    """The token streams of some pages of a host one after the other; a token of its own opens each block."""

    def __init__(self, pages: list[list[tuple[str, int, bool]]]):
        self.flat = [b for p in pages for b in p]
        of = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        w = X.words(pa.array([b[0] for b in self.flat], pa.string()))[2]
        self.size = np.diff(w.first)
        self.begin = w.first[:-1] + np.arange(len(self.flat))
        self.token = np.zeros(len(w.hash) + len(self.flat), np.uint64)
        self.is_word = np.ones(len(self.token), bool)
        self.is_word[self.begin] = False
        self.token[self.is_word] = w.hash
        self.page = np.repeat(of, self.size + 1)
        digests = [int.from_bytes(hashlib.blake2b(packed_blocks(p), digest_size=8).digest(), "big") >> 1 for p in pages]
        self.copy = np.array(digests, np.int64)[self.page]  # equal pages have equal numbers, in all arrays


def run_hashes(token: np.ndarray, depth: int) -> np.ndarray:
    """Hash of the ``depth`` tokens from each place on."""
    out = np.zeros(max(len(token) - depth + 1, 0), np.uint64)
    for k in range(depth):
        out += token[k : k + len(out)] * X.PLACE_KEY[k]
    return X.mix(out)


def runs_of(t: Tokens, depth: int = MIN_RUN, part: int = PICK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, hash and pick (least hash of ``part`` tokens in it) of every run inside a page."""
    whole, short = run_hashes(t.token, depth), run_hashes(t.token, part)
    n = len(whole)
    least = short[:n].copy()
    for k in range(1, depth - part + 1):
        np.minimum(least, short[k : k + n], out=least)
    at = np.flatnonzero(t.page[:n] == t.page[len(t.page) - n :])
    return at, whole[at], least[at]


def holders(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, and the lowest and the highest owner of each."""
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], owners[first], owners[np.append(first[1:], len(keys))[: len(first)] - 1]


def sent_keys(keys: np.ndarray, lots: int, whole: bool) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """What is sent of distinct keys, and the places of those that go to each part of the host, in the order sent."""
    parts = max(min(MOST_PARTS, -(-lots // FEW_LOTS)), -(-lots // MOST_LOTS))
    part = (keys >> np.uint64(32)) % np.uint64(parts)
    sent = keys.astype(">u8") if whole else (keys & np.uint64(0xFFFFFFFF)).astype(">u4")
    order = np.lexsort((sent, part))
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    return sent, [(i, order[a:b]) for i, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]


def planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second bytes, and so on: the first ones of sorted values compress well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplaned(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


KEYS = pa.schema([("host", pa.string()), ("lot", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary()), ("several", pa.binary())])
ANSWERS = pa.schema([("host", pa.string()), ("lot", pa.int64()), ("part", pa.int32()), ("hits", pa.binary())])


def keys_table(host: str, lot: int, lots: int, keys: np.ndarray, owners: np.ndarray, whole: bool) -> pa.Table:
    """A row per part of the host: the array's keys, whether each has several owners here and, for whole keys, one owner."""
    keys, low, high = holders(keys, owners)
    sent, places = sent_keys(keys, lots, whole)
    rows = [{"host": host, "lot": lot, "part": i, "keys": planes(sent[x]), "owners": planes(low[x].astype(">i8")) if whole else b"",
             "several": np.packbits(low[x] != high[x]).tobytes()} for i, x in places]
    return pa.Table.from_pylist(rows, schema=KEYS)


def answers(t: pa.Table) -> pa.Table:
    """For each array, which of its keys stand on two distinct pages; keys without owners need only be sent twice."""
    rows = t.to_pylist()
    whole = bool(rows[0]["owners"])
    keys = [unplaned(r["keys"], ">u8" if whole else ">u4") for r in rows]
    sizes = [len(k) for k in keys]
    several = np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8), count=n) for r, n in zip(rows, sizes, strict=True)]) > 0
    key = np.concatenate(keys).astype(np.uint64)
    owner = np.concatenate([unplaned(r["owners"], ">i8") for r in rows]).astype(np.int64) if whole else np.arange(len(key))
    known, low, high = holders(key, owner)
    place = np.searchsorted(known, key)
    hit = low != high
    hit[place[several]] = True
    out = np.split(hit[place], np.cumsum(sizes)[:-1])
    return pa.Table.from_pylist([{"host": r["host"], "lot": r["lot"], "part": r["part"], "hits": np.packbits(x).tobytes()} for r, x in zip(rows, out, strict=True)],
                                schema=ANSWERS)


def answered(keys: np.ndarray, lots: int, whole: bool, got: pa.Table) -> np.ndarray:
    """The answers to an array's keys, for each of ``keys`` (with repeats)."""
    known, place = np.unique(keys, return_inverse=True)
    hit, hits = np.zeros(len(known), bool), dict(zip(got["part"].to_pylist(), got["hits"].to_pylist(), strict=True))
    for i, x in sent_keys(known, lots, whole)[1]:
        hit[x] = np.unpackbits(np.frombuffer(hits[i], np.uint8), count=len(x)) > 0
    return hit[place]


def main_texts(pages: list[list[tuple[str, int, bool]]], elsewhere=None) -> list[tuple[str, int, int]]:
    """Text, tokens and repeated tokens of each page of a host, from the blocks of all of them. ``elsewhere`` gives, of the tokens, the
    begins of runs that repeat on pages of the host that are not here."""
    t = Tokens(pages)
    flat, size, begin, token = t.flat, t.size, t.begin, t.token
    again = repeats(t.page, token, t.copy)
    if elsewhere is not None:
        cover = np.zeros(len(token) + 1, np.int64)
        at = elsewhere(t)
        cover[at] += 1
        cover[at + MIN_RUN] -= 1
        again |= np.cumsum(cover)[:-1] > 0
    again &= t.is_word
    covered = X.per_text(again, np.append(begin, len(token))) if len(flat) else np.zeros(0, np.int64)
    out, at = [], 0
    for p in pages:
        mine = range(at, at + len(p))
        at += len(p)
        best = max((b[1] for b in p if b[2]), default=OPEN)
        kept = [i for i in mine if flat[i][2] and flat[i][1] == best]
        if best == OPEN:
            unique = [i for i in kept if covered[i] < COVERED * size[i]]
            total = int(size[kept].sum()) if kept else 0
            if total and int(covered[kept].sum()) < COVERED * total:
                kept = unique
        out.append(("\n\n".join(flat[i][0] for i in kept), int(size[mine.start : mine.stop].sum()), int(covered[mine.start : mine.stop].sum())))
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_tokens, n_repeated for every row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    hosts = settle(rows.groupBy("host").count().select("host", F.ceil(F.col("count") / PAGES_PER_ARRAY).cast("int").alias("lots")), "hosts")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for b in X.steps(batches, "html"):
            found = [packed_blocks(blocks_of(p)) for p in b["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], b["host"], pa.array([len(x) for x in found], pa.int32()),
                                              pa.array([codec.compress(x, asbytes=True) for x in found], pa.binary())],
                                             names=["page_id", "url", "host", "size", "blocks"])

    def parsed_pages(t: pa.Table) -> list:
        codec = pa.Codec("zstd")
        return [unpacked_blocks(codec.decompress(x, n, asbytes=True)) for x, n in zip(t["blocks"].to_pylist(), t["size"].to_pylist(), strict=True)]

    def lots_of(t: pa.Table) -> int:
        return t["lots"][0].as_py()

    def send_picks(t: pa.Table) -> pa.Table:
        if lots_of(t) == 1:
            return KEYS.empty_table()
        held = Tokens(parsed_pages(t))
        at, _, pick = runs_of(held)
        return keys_table(t["host"][0].as_py(), t["lot"][0].as_py(), lots_of(t), pick, held.copy[at], False)

    def send_runs(t: pa.Table, got: pa.Table) -> pa.Table:
        if lots_of(t) == 1:
            return KEYS.empty_table()
        held = Tokens(parsed_pages(t))
        at, run, pick = runs_of(held)
        shared = answered(pick, lots_of(t), False, got)
        return keys_table(t["host"][0].as_py(), t["lot"][0].as_py(), lots_of(t), run[shared], held.copy[at[shared]], True)

    def judge(t: pa.Table, picks: pa.Table | None = None, runs: pa.Table | None = None) -> pa.Table:
        def elsewhere(held: Tokens) -> np.ndarray:
            at, run, pick = runs_of(held)
            shared = answered(pick, lots_of(t), False, picks)
            return at[shared][answered(run[shared], lots_of(t), True, runs)]

        text, n, again = zip(*main_texts(parsed_pages(t), elsewhere if picks is not None and lots_of(t) > 1 else None), strict=True)
        return pa.table([t["page_id"], t["url"], pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64()), pa.array(n, pa.int64()),
                         pa.array(again, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_tokens", "n_repeated"])

    def judge_all(t: pa.Table, got: pa.Table) -> pa.Table:
        whole = pc.equal(got["round"], 2)
        return judge(t, got.filter(pc.invert(whole)), got.filter(whole))

    ids = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string"
    out = f"{ids}, text string, n_chars bigint, n_tokens bigint, n_repeated bigint"
    parsed = rows.mapInArrow(parse, f"{ids}, host string, size int, blocks binary")
    dealt = parsed.join(hosts, "host").withColumn("lot", F.pmod(F.xxhash64("page_id", "url"), F.col("lots")))
    arrays = dealt.groupBy("host", "lot")
    if (hosts.agg(F.max("lots")).first()[0] or 0) <= 1:
        return arrays.applyInArrow(lambda t: judge(t), out)
    keys, hits = "host string, lot bigint, part int, keys binary, owners binary, several binary", "host string, lot bigint, part int, hits binary"
    # all three read the same shuffle of the pages
    first = arrays.applyInArrow(send_picks, keys).groupBy("host", "part").applyInArrow(answers, hits)
    second = arrays.cogroup(first.groupBy("host", "lot")).applyInArrow(send_runs, keys).groupBy("host", "part").applyInArrow(answers, hits)
    both = first.withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2)))
    return arrays.cogroup(both.groupBy("host", "lot")).applyInArrow(judge_all, out)
