"""Main text of HTML pages: structure, and a host suffix array over the words of all blocks.

A page is cut into blocks, each with a zone. `body` blocks stand in an article or main element: kept, but for notices.
`chrome` blocks stand in navigation, headers, footers, sidebars, forms or elements whose class or id names
such a thing (advert, notice, comments ...): removed. All other blocks are `open`.

The words of the open and chrome blocks of a host's pages are one token stream. Its suffix array,
built by prefix doubling to a depth of RUN tokens, puts equal runs next to each other; a run that pages of
the host with distinct contents share (two of them, and SHARE of a large host's) is boilerplate, and since every longer
repeat is a union of runs of RUN tokens, this depth finds all of them. A block of fewer tokens is one run. Covered tokens
are removed from open blocks and unique runs are kept. Copies of a page under several URLs are one content, so they do not
erase each other.

The words of the body blocks are a stream of their own. Repeats inside an article are content as a rule (quotations,
copies), so a run is not enough here: a body block is a notice, and goes, if it has RUN words or more (a shorter one may be
a heading) and stands as a whole in the articles of more than MOST of a host's distinct contents and of NOTICE of them at least. Where such blocks make up half of an article's
words or more, the pages are near copies of each other and the article stays whole.

Distribution: pages are parsed once and their blocks stored. Every task builds the suffix arrays of its own pages and
emits one row for each distinct run and host (its hash, least and greatest content, number of contents). Rows of a run
are then combined by a partial aggregate, so a hot host or run is no large group. Of the articles, the suffixes that begin
a block give a row for each block and content; each content of a host counts once, however many copies it has. Only pages
with open blocks look their runs up again; articles are looked up again if any host has a notice.

Cases: null html is empty; pages without text give the empty string; null page ids are kept; repeated rows are
one content and cannot make each other boilerplate; a host with one content has no repeats; very long pages are
read whole; ties cannot occur; a quote that is not closed ends with its tag; null urls have the empty host; broken markup is read as far as it goes; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sliced, spans, stored
from .words import mix, word_hashes

RUN = 6
#: Least share of a host's distinct page contents that hold a run, beside two of them.
SHARE = 0.01
#: A notice inside articles stands in more than this share of a host's distinct page contents, and in so many of them.
MOST = 0.5
NOTICE = 5
BATCH_BYTES = 1 << 21

# Element names of HTML.
DROPPED = {"script", "style", "template", "noscript", "iframe", "svg", "object", "canvas", "audio", "video", "head", "title", "select", "textarea", "button"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: Within an article a name says what an element is only if it is one that holds blocks; a paragraph or a word is text.
CONTAINERS = {"aside", "center", "details", "dir", "div", "dl", "fieldset", "figure", "header", "ol", "section", "table", "ul"}
CLOSES_P = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "legend", "dd", "dt", "li"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Words of a class, id or role that name what is not main text.
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "pagination", "popup", "promo", "promotion", "related", "replies", "responses", "search", "share", "sharing", "sidebar", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)>", re.S)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PARTS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
HOST = re.compile(r"://([^/?#]*)")
SPACE = re.compile(r"\s+")


def _names_chrome(attributes: str, inside: bool) -> bool:
    """Whether a class, id or role names chrome; inside an article a header is its title."""
    for m in NAMED.finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        if any(p.lower() in NAMES and not (inside and p.lower() == "header") for p in PARTS.findall(value)):
            return True
    return False


def blocks(page: str | None) -> list[tuple[str, str]]:
    """(zone, text) of each block with text, in page order."""
    out: list[tuple[str, str]] = []
    said = "open"  # zone of the collected parts
    stack: list[tuple[str, str]] = []  # (element, zone inside it); zone "drop" yields no text
    zone, parts = "open", []
    page = page or ""

    def flush() -> None:
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                out.append((said, text))
            parts.clear()

    def pop_to(k: int) -> None:
        nonlocal zone
        # What is dropped within a line does not end the block around it.
        outer = stack[k - 1][1] if k else "open"
        if any((name in BLOCKS and before != "drop") or z not in (outer, "drop") for (name, z), before in zip(stack[k:], [outer, *(z for _, z in stack[k:])], strict=False)):
            flush()
        del stack[k:]
        zone = stack[-1][1] if stack else "open"

    at = 0
    while True:
        m = TAG.search(page, at)
        if zone != "drop":
            if said != zone and parts:
                flush()
            said = zone
            parts.append(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop_to(k)
                    break
            else:
                if name in BLOCKS:
                    flush()
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                parts.append(" ")
            continue
        # Elements whose end tag may be left out.
        closing = SIBLINGS.get(name) or ({"p"} if name in CLOSES_P else None)
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in closing:
                    pop_to(k)
                    break
                if stack[k][0] in BLOCKS and name != "tr":
                    break
        if name in RAW:
            end = re.compile(f"</{name}\\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        inner = zone
        if zone not in ("drop", "chrome"):
            if name in DROPPED:
                inner = "drop"
            elif name == "article" and any(z == "body" and n == "article" for n, z in stack):
                inner = "chrome" if _names_chrome(m[3], zone == "body") else zone
            elif name in CHROME or (name == "header" and zone != "body") or (name not in ("body", "html", "main", "article") and (zone != "body" or name in CONTAINERS) and _names_chrome(m[3], zone == "body")):
                inner = "chrome"
            elif name in MAIN:
                inner = "chrome" if _names_chrome(m[3], zone == "body") and name == "article" else "body"
        elif name in DROPPED:
            inner = "drop"
        if zone != "drop" and (name in BLOCKS or inner not in (zone, "drop")):
            flush()
        if m[3].rstrip().endswith("/") and name not in BLOCKS:
            continue
        stack.append((name, inner))
        zone = inner
    flush()
    return out


def host_of(url: str | None) -> str:
    m = HOST.search(url or "")
    return m[1].lower() if m else ""


def suffix_ranks(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank of each suffix) ordered by the first `depth` tokens at least, by prefix doubling."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    size = 1
    while size < depth:
        # The last doubling is cut so that exactly `depth` tokens are compared.
        shift = min(size, depth - size)
        after = np.zeros_like(rank)
        after[: len(rank) - shift] = rank[shift:]
        pair = rank * (rank.max(initial=0) + 1) + after
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64) + 1
        size += shift
    return np.argsort(rank, kind="stable"), rank


def _stream(pages: list[list[dict]], body: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hash, page, block) of the open and chrome blocks of some pages, or of their body blocks."""
    texts, where = [], []
    for p, page in enumerate(pages):
        for b, block in enumerate(page):
            if (block["zone"] == "body") == body:
                texts.append(block["text"].encode("utf-8", "surrogatepass"))
                where.append((p, b))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    words, counts = word_hashes(raw, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
    at = np.array(where, np.int64).reshape(-1, 2)
    return words, np.repeat(at[:, 0], counts), np.repeat(at[:, 1], counts)


def runs(words: np.ndarray, page: np.ndarray, host: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first token, hash) of every run of RUN tokens within a page; equal hashes share host and tokens."""
    n = len(words) - RUN + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    first = np.flatnonzero(page[:n] == page[RUN - 1 :])
    h = host[page[first]].copy()
    for j in range(RUN):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[first + j])
    return first, h


def short_blocks(words: np.ndarray, page: np.ndarray, block: np.ndarray, host: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first token, hash) of every block of fewer than RUN tokens: such a block is one run."""
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    first = np.flatnonzero(np.concatenate(([True], (page[1:] != page[:-1]) | (block[1:] != block[:-1]))))
    size = np.diff(np.append(first, len(words)))
    first, size = first[size < RUN], size[size < RUN]
    h = mix(host[page[first]] + size.astype(np.uint64))
    for j in range(RUN - 1):
        has = size > j
        h[has] = mix(h[has] * np.uint64(0x9E3779B97F4A7C15) + words[first[has] + j])
    return first, h


def whole_blocks(words: np.ndarray, page: np.ndarray, block: np.ndarray, host: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first token, hash) of every block with words; equal hashes share host and all tokens."""
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    first = np.flatnonzero(np.concatenate(([True], (page[1:] != page[:-1]) | (block[1:] != block[:-1]))))
    size = np.diff(np.append(first, len(words)))
    place = np.arange(len(words)) - np.repeat(first, size)
    placed = mix(words + mix(place.astype(np.uint64)))
    return first, mix(np.add.reduceat(placed, first) ^ mix(host[page[first]] + size.astype(np.uint64)))


_BLOCKS = pa.list_(pa.struct([("zone", pa.string()), ("text", pa.string())]))
PARSED_SCHEMA = "page_id long, url string, host long, content long, open boolean, blocks array<struct<zone:string,text:string>>"


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def parsed(pages: DataFrame) -> DataFrame:
    """The blocks of every page with hashes of its host and of all it says; stored, so that pages are parsed once."""

    def run(batches: Iterator[pa.RecordBatch]):
        for part in sliced(batches, "html", BATCH_BYTES):
            found = [blocks(x) for x in part.column(2).to_pylist()]
            host = [_hash(host_of(u)) for u in part.column(1).to_pylist()]
            content = [_hash("\0".join(t for _, t in page)) for page in found]
            listed = pa.array([[{"zone": z, "text": t} for z, t in page] for page in found], _BLOCKS)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(host, pa.int64()), pa.array(content, pa.int64()), pa.array([any(z == "open" for z, _ in page) for page in found]), listed], [c.split(" ")[0] for c in PARSED_SCHEMA.split(", ")])

    return stored(pages.select("page_id", "url", "html").mapInArrow(run, PARSED_SCHEMA), "blocks")


def _grouped(batches: Iterator[pa.RecordBatch], columns: tuple[int, ...], at: int) -> Iterator[list]:
    """Python lists of some columns, for rows whose blocks have about BATCH_BYTES of text."""
    for batch in batches:
        lists = batch.column(at).to_pylist()
        for lo, hi in spans([sum(len(b["text"]) for b in page) for page in lists], BATCH_BYTES):
            yield [lists[lo:hi], *(batch.column(c).slice(lo, hi - lo).to_pylist() for c in columns)]


def repeated_runs(made: DataFrame) -> DataFrame:
    """(run): hashes of the runs that pages of a host with distinct contents share.

    At least two contents, and on a large host SHARE of them: prose meets by chance on some of many pages.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for found, hosts, contents in _grouped(batches, (0, 1), 2):
            host, content = np.array(hosts, np.int64).view(np.uint64), np.array(contents, np.int64)
            words, page, block = _stream(found)
            if not len(words):
                continue
            # One stream for each host: stable order keeps pages and tokens in sequence. Every token
            # gets the host mixed in, so that no run crosses hosts.
            order = np.argsort(host[page], kind="stable")
            words, page, block = words[order], page[order], block[order]
            keyed = mix(words ^ mix(host[page]))
            sa, rank = suffix_ranks(keyed, RUN)
            first, h = runs(words, page, host)
            of = np.full(len(words), -1, np.int64)
            of[first] = np.arange(len(first))
            at = sa[of[sa] >= 0]  # suffixes that begin a whole run, equal ones side by side
            head = np.flatnonzero(np.concatenate(([True], rank[at][1:] != rank[at][:-1]))) if len(at) else np.empty(0, np.int64)
            name, on = h[of[at]], page[at]
            few, short = short_blocks(words, page, block, host)
            few = few[np.argsort(short, kind="stable")]
            short = np.sort(short)
            heads = np.concatenate((head, len(at) + np.flatnonzero(np.concatenate(([True], short[1:] != short[:-1]))) if len(short) else np.empty(0, np.int64))).astype(np.int64)
            if not len(heads):
                continue
            name, on = np.concatenate((name, short)), np.concatenate((on, page[few]))
            who = content[on]
            group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(on))))
            each = np.unique(np.stack([group, who], axis=1), axis=0)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[heads].view(np.int64)), pa.array(host[on[heads]].view(np.int64)), pa.array(np.minimum.reduceat(who, heads)), pa.array(np.maximum.reduceat(who, heads)), pa.array(np.bincount(each, minlength=len(heads)))],
                ["run", "host", "low", "high", "n"],
            )

    rows = made.select("host", "content", "blocks").mapInArrow(run, "run long, host long, low long, high long, n long")
    sizes = made.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("contents"))
    found = rows.groupBy("run", "host").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    return found.where("low <> high").join(sizes, "host").where(F.col("n") >= F.col("contents") * F.lit(SHARE)).select("run")


def repeated_blocks(made: DataFrame) -> DataFrame:
    """(run): hashes of the whole article blocks, of RUN words or more, that more than MOST of a host's distinct contents share."""

    def run(batches: Iterator[pa.RecordBatch]):
        for found, hosts, contents in _grouped(batches, (0, 1), 2):
            host, content = np.array(hosts, np.int64).view(np.uint64), np.array(contents, np.int64)
            words, page, block = _stream(found, body=True)
            if not len(words):
                continue
            first, h = whole_blocks(words, page, block, host)
            sa, _ = suffix_ranks(mix(words ^ mix(host[page])), RUN)
            of = np.full(len(words), -1, np.int64)
            of[first] = np.arange(len(first))
            at = of[sa]
            at = at[at >= 0]  # blocks by their first words, those that begin alike side by side
            at = at[np.diff(np.append(first, len(words)))[at] >= RUN]
            each = np.unique(np.stack([h[at].view(np.int64), content[page[first[at]]], host[page[first[at]]].view(np.int64)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(each[:, k]) for k in range(3)], ["run", "content", "host"])

    rows = made.select("host", "content", "blocks").mapInArrow(run, "run long, content long, host long")
    sizes = made.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("contents"))
    found = rows.distinct().groupBy("run", "host").agg(F.count("*").alias("n")).where(F.col("n") >= NOTICE)
    return found.join(sizes, "host").where(F.col("n") > F.col("contents") * F.lit(MOST)).select("run")


def _asked(made: DataFrame) -> DataFrame:
    """The pages and, in order, the hashes of their runs and then of their short blocks, and those of their article blocks."""

    def run(batches: Iterator[pa.RecordBatch]):
        for found, ids, urls, hosts in _grouped(batches, (0, 1, 2), 3):
            host = np.array(hosts, np.int64).view(np.uint64)
            looked, bodies = [], []
            for k, page in enumerate(found):
                bodies.append(whole_blocks(*_stream([page], body=True), host[k : k + 1])[1].view(np.int64).tolist())
                words, of, block = _stream([page])
                looked.append(np.concatenate((runs(words, of, host[k : k + 1])[1], short_blocks(words, of, block, host[k : k + 1])[1])).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(looked, pa.list_(pa.int64())), pa.array(bodies, pa.list_(pa.int64())), pa.array(found, _BLOCKS)], ["page_id", "url", "runs", "bodies", "blocks"])

    return made.select("page_id", "url", "host", "blocks").mapInArrow(run, "page_id long, url string, runs array<long>, bodies array<long>, blocks array<struct<zone:string,text:string>>")


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def without_notices(page: list[dict], notices: list[int]) -> list[dict]:
    """The page without the notices among its body blocks with words (by number), unless they are half of the article."""
    at, size = [], []
    for k, b in enumerate(page if notices else ()):
        if b["zone"] == "body" and (n := sum(1 for _ in WORD.finditer(_fold(b["text"])))):
            at.append(k)
            size.append(n)
    if 2 * sum(size[k] for k in notices) >= sum(size):
        return page
    gone = {at[k] for k in notices}
    return [b for k, b in enumerate(page) if k not in gone]


def without_runs(page: list[dict], covered: list[int]) -> str:
    """The page's text with the words of its covered runs (by number) removed from open blocks."""
    total, place = 0, []
    for b in page:
        n = 0 if b["zone"] == "body" else sum(1 for _ in WORD.finditer(_fold(b["text"])))
        place.append((total, n))
        total += n
    gone = np.zeros(total + RUN, bool)
    whole = max(0, total - RUN + 1)
    short = [(first, n) for b, (first, n) in zip(page, place, strict=True) if b["zone"] != "body" and 0 < n < RUN]
    for k in covered:
        first, n = (k, RUN) if k < whole else short[k - whole]
        gone[first : first + n] = True
    out = []
    for b, (first, n) in zip(page, place, strict=True):
        if b["zone"] == "body":
            out.append(b["text"])
        elif b["zone"] == "open":
            if not gone[first : first + n].any():
                out.append(b["text"])
                continue
            # Keep unique runs with the punctuation that follows their words.
            starts = [m.start() for m in WORD.finditer(_fold(b["text"]))]
            ends = [*starts[1:], len(b["text"])]
            kept = "".join(b["text"][s:e] for i, (s, e) in enumerate(zip(starts, ends, strict=True)) if not gone[first + i])
            if kept.strip():
                out.append(SPACE.sub(" ", kept).strip())
    return "\n".join(out)


_UPPER = {c: c + 32 for c in range(65, 91)}


def _fold(text: str) -> str:
    return text.translate(_UPPER)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    made = parsed(pages)
    body = F.transform(F.filter("blocks", lambda b: b["zone"] == "body"), lambda b: b["text"])
    decided = lambda rows: rows.select("page_id", "url", F.array_join(body, "\n").alias("text"))
    notices = stored(repeated_blocks(made), "notices")
    # With notices every page is looked up, else those with open blocks.
    if notices.isEmpty():
        if made.where("open").isEmpty():
            return decided(made).withColumn("n_chars", F.length("text").cast("long"))
        sure, unsure = made.where("NOT open"), made.where("open")
    else:
        sure, unsure = made.where("false"), made
    asked = _asked(unsure).withColumn("row", F.xxhash64("page_id", "url", "blocks"))

    def places(column: str, runs: DataFrame, name: str) -> DataFrame:
        return asked.select("row", F.posexplode(column).alias("k", "run")).join(runs, "run").groupBy("row").agg(F.collect_set("k").alias(name))

    joined = asked.join(places("runs", repeated_runs(made), "covered"), "row", "left").join(places("bodies", notices, "gone"), "row", "left").select("page_id", "url", "blocks", "covered", "gone")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = [without_runs(without_notices(b, g or []), c or []) for b, c, g in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    out = decided(sure).unionByName(joined.mapInArrow(run, "page_id long, url string, text string"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
