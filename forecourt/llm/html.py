"""Main text of web pages: markup says which blocks are text, repetition across a host's pages which of them are not.

A page becomes blocks of text in page order. Blocks inside menus, headers and footers outside the article, asides,
forms, dialogs, scripts, styles, templates, and inside elements whose class, id or role names such a part, an
advert, a notice or reader comments, are no text. If a page marks its article (``article``, ``main`` or role
``main``), only the blocks inside go on.

The blocks of every page are compared with the other texts of its pool: the marked articles of a host are one pool, its
other pages another. Boilerplate is what stands in at least ``TEXTS`` different texts of the pool and in ``SHARE`` of
them all, among articles in ``ARTICLES`` and ``ARTICLE_SHARE``, as what a few of them share is theirs (copies of a page
are one text):

* whole blocks, of any length; one of ``RUN`` tokens or more also where another block begins or ends with it;
* strings of ``LONG`` tokens or more inside blocks. Every such string holds, at the same place, a run of ``RUN`` tokens
  whose hash is the least around it; those anchors are counted first. Around anchors that repeat, the streams of a
  batch's pages of one pool are put one after the other, each stretch closed by a mark of its own, and sorted into a
  suffix array by their first ``LONG`` tokens; equal ones of all arrays meet in a count of distinct texts.

Covered tokens are removed, and all that is left is kept, single tokens too: what merely stands beside a repeat stays.
A marked article of which ``ARTICLE_REPEAT`` or more would go is a near copy of others and stays whole.

Blocks and anchors (one in about nine tokens) are first counted by eight bytes of their digests, per page; copies of
pages only raise that count, so all that may be boilerplate is found. Only pools that have such go on, and send digests
of their blocks, of those anchors and of repeated stretches, never texts, so a host of any size is counted in parts.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined by a
space.

Defined cases: a null or empty html has no text; a cut-off page is read to its end; a comment, script or style that
is not closed runs to the end; a null url is the empty host, whose pages are compared with one another; repeated
rows and copies of a page are one text, so they don't make each other boilerplate; an empty table gives no rows;
further columns are left alone. Nothing else is dropped or capped.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import query, table, together
from forecourt.llm.urls import host_of
from forecourt.session import materialize, setting

RUN = 8
LONG = 24
TEXTS = 2
SHARE = 0.25
ARTICLES = 3
ARTICLE_SHARE = 0.75
ARTICLE_REPEAT = 0.5
#: Characters of html or text that a task handles at a time, one page at least.
TOGETHER = 4_000_000

# Elements of the HTML standard by what they do to text.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea", "select", "button", "title", "noframes"}
APART = {"nav", "footer", "aside", "form", "dialog", "menu", "head", *RAW}
ARTICLE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    *("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form".split()),
    *("h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody".split()),
    *("td tfoot th thead title tr ul".split()),
}
OPEN_ENDED = {"p", "li", "dd", "dt", "tr", "td", "th", "thead", "tbody", "tfoot", "option"}
_PART = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert(?:s|isement|ising)?|sponsor(?:ed)?|promo|banner|cookies?|consent|notice|nav(?:bar|igation)?|menu|breadcrumbs?|sidebar|"
    r"footer|header|masthead|comments?|disqus|share|social|related|newsletter|subscribe|popup|modal|login|search|pagination|pager)(?:$|[\s_-])"
)
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_TOKEN = re.compile(r"<!--|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<")
_ATTRIBUTE = re.compile(r"(?i)\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _apart(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in APART or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id") and tag not in ARTICLE and _PART.search(value):
            return True
    return False


def blocks(html: str | None) -> tuple[list[str], bool]:
    """(blocks of text in page order, whether the page marks its article, in which case they are the article's)."""
    html = html or ""
    inside: list[str] = []
    outside: list[str] = []
    piece: list[str] = []
    path: list[tuple[str, bool, bool]] = []  # open elements: tag, apart, article
    apart = article = False
    marked = False

    def close() -> None:
        if piece:
            text = " ".join(unescape("".join(piece)).split())
            if text:
                (inside if article else outside).append(text)
            piece.clear()

    def settle() -> None:
        nonlocal apart, article
        apart, article = (path[-1][1], path[-1][2]) if path else (False, False)

    at = 0
    while at < len(html):
        found = _TOKEN.search(html, at)
        if not found:
            if not apart and not re.match(r"</?[a-zA-Z!]", html[at:]):
                piece.append(html[at:])
            break
        if found.start() > at and not apart:
            piece.append(html[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            if found[0] == "<!--":
                end = html.find("-->", at)
                at = len(html) if end < 0 else end + 3
            elif found[0] == "<":
                if re.match(r"[a-zA-Z/!?]", html[at : at + 1]):  # a tag that is cut off
                    break
                if not apart:
                    piece.append("<")
            continue
        tag = tag.lower()
        if tag in BLOCK:
            close()
        if found[1]:
            depth = next((k for k in range(len(path) - 1, -1, -1) if path[k][0] == tag), -1)
            if depth >= 0:
                if any(t in ARTICLE or t in APART for t, _, _ in path[depth + 1 :]):
                    close()
                del path[depth:]
                settle()
        elif tag not in VOID:
            if tag in OPEN_ENDED and path and path[-1][0] == tag:
                path.pop()
                settle()
            role = _ATTRIBUTE.findall(found[3]) if "role" in found[3] else ()
            main = not apart and (tag in ARTICLE or any(n.lower() == "role" and (a or b or c).lower() == "main" for n, a, b, c in role))
            if main and not article:
                close()
            marked = marked or main
            if not found[3].rstrip().endswith("/") or tag in BLOCK:
                path.append((tag, apart or _apart(tag, found[3], article), article or main))
                settle()
            if tag in RAW:
                end = re.compile(rf"(?i)</{re.escape(tag)}\b").search(html, at)
                at = end.start() if end else len(html)
    close()
    return (inside, True) if marked else (outside, False)


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, blocks, marked) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in together(batch.column(2), TOGETHER):
                found = [blocks(h) for h in texts]
                part = batch.slice(first, len(texts))
                of = pa.array([b for b, _ in found], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), of, pa.array([m for _, m in found])], names=["page_id", "url", "blocks", "marked"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, f"page_id {kind}, url string, blocks array<string>, marked boolean")


def suffix_groups(streams: list[list[list[str]]], run: int) -> list[tuple[str, int, list[int]]]:
    """(run of tokens, page index, places) for each run of ``run`` tokens of each page, by a suffix array.

    ``streams`` holds the blocks of each page. They are concatenated, every block closed by a token that occurs once,
    so no run goes over a block's end; suffixes are ranked by 1, 2, 4, ... of their first tokens, and those of equal
    rank at ``run`` tokens are neighbours in the array. A place counts a page's tokens without the closing ones.
    """
    number: dict[str, int] = {}
    ids, page, place, words = [], [], [], []
    closing = -1
    for k, of in enumerate(streams):
        at = 0
        for block in of:
            for token in block:
                ids.append(number.setdefault(token, len(number)))
                page.append(k)
                place.append(at)
                words.append(token)
                at += 1
            ids.append(closing)
            page.append(k)
            place.append(-1)
            words.append("")
            closing -= 1
    if not ids:
        return []
    rank = np.unique(np.array(ids), return_inverse=True)[1]
    whole = np.array(place) >= 0
    length = 1
    while length < run:
        step = min(length, run - length)
        later = np.full(len(rank), -1)
        later[: len(rank) - step] = rank[step:]
        order = np.lexsort((later, rank))
        new = np.concatenate(([True], (rank[order][1:] != rank[order][:-1]) | (later[order][1:] != later[order][:-1])))
        rank[order] = np.cumsum(new) - 1
        length += step
    left = np.concatenate((np.flatnonzero(~whole), [len(ids)]))
    room = left[np.searchsorted(left, np.arange(len(ids)))] - np.arange(len(ids))
    page, place = np.array(page), np.array(place)
    array = np.lexsort((place, page, rank))
    array = array[room[array] >= run]
    out: list[tuple[str, int, list[int]]] = []
    last = None
    for i in array.tolist():
        key = (rank[i], page[i])
        if key != last:
            out.append((" ".join(words[i : i + run]), int(page[i]), []))
            last = key
        out[-1][2].append(int(place[i]))
    return out


def digest(tokens: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(tokens).encode())


def name(of: bytes) -> int:
    return int.from_bytes(of[:8], "little", signed=True)


def anchors(tokens: list[str], run: int = RUN, long: int = LONG) -> list[tuple[int, bytes]]:
    """(place, digest) of the runs of ``run`` tokens whose digest is the least of those in some string of ``long`` tokens."""
    wide = long - run + 1
    if len(tokens) < long:
        return []
    of = [digest(tokens[i : i + run]) for i in range(len(tokens) - run + 1)]
    out, least = [], deque()
    for i, d in enumerate(of):
        while least and of[least[-1]] > d:
            least.pop()
        least.append(i)
        if least[0] <= i - wide:
            least.popleft()
        if i >= wide - 1 and (not out or out[-1][0] != least[0]):
            out.append((least[0], of[least[0]]))
    return out


def stretches(texts: list[str], repeated: set[bytes], run: int = RUN, long: int = LONG) -> list[tuple[int, int, list[str]]]:
    """(block, first token, tokens) of the parts of blocks in which strings of ``long`` tokens may hold a ``repeated`` anchor."""
    out = []
    for k, block in enumerate(texts):
        tokens = block.split(" ")
        part: list[int] | None = None
        for place, d in anchors(tokens, run, long):
            if d not in repeated:
                continue
            low, high = max(0, place - (long - run)), min(len(tokens), place + long)
            if part and low <= part[1]:
                part[1] = high
            else:
                part = [low, high]
                out.append((k, part, tokens))
    return [(k, low, tokens[low:high]) for k, (low, high), tokens in out]


def _names(of: DataFrame, run: int, long: int) -> DataFrame:
    """(pool, name): the pool's hash and the ``name`` of each different block and anchor, per page."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pools, held, size = [], [], 0
            for pool, texts in zip(*batch.columns):
                found = {name(d) for _, d, *_ in _marks(texts.as_py(), run, long)}
                pools.append(np.full(len(found), pool.as_py(), np.int64))
                held.append(np.fromiter(found, np.int64, len(found)))
                size += len(found)
                if size >= 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (pools, held)], names=["pool", "name"])
                    pools, held, size = [], [], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (pools, held)], names=["pool", "name"])

    return of.select(F.xxhash64("pool"), "blocks").mapInArrow(names, "pool long, name long")


def _often(of: DataFrame, many: DataFrame, least: int, run: int, long: int) -> DataFrame:
    """(pool, often): the names that as many pages of a pool hold as make boilerplate, if their texts differ.

    Without copies these are at most those of a mean page by the inverse of the share, whatever the size of the pool.
    """
    seen = _names(of, run, long).groupBy("pool", "name").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    pools = many.select(F.xxhash64("pool").alias("of"), F.col("pool").alias("whole"), "least")
    met = seen.join(pools, (F.col("pool") == F.col("of")) & (F.col("n") >= F.col("least")))
    return met.groupBy(F.col("whole").alias("pool")).agg(F.collect_set("name").alias("often"))


def _marked(of: DataFrame, run: int, long: int) -> DataFrame:
    """(pool, key, kind, digest, size, first, last) of the blocks of each page and of its anchors that are ``often``."""
    kinds = {"pool": pa.string(), "key": pa.int64(), "kind": pa.string(), "digest": pa.binary(), "size": pa.int32(), "first": pa.binary(), "last": pa.binary()}

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for pool, key, texts, often in zip(*batch.columns):
                pool, key, often = pool.as_py(), key.as_py(), set(often.as_py())
                held += [(pool, key, *row) for row in _marks(texts.as_py(), run, long) if row[0] == "b" or name(row[1]) in often]
                if len(held) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds.values())], names=list(kinds))
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds.values())], names=list(kinds))

    return of.select("pool", "key", "blocks", "often").mapInArrow(run_, "pool string, key long, kind string, digest binary, size int, first binary, last binary")


def _marks(texts: list[str], run: int, long: int) -> list[tuple]:
    """A page's blocks ("b"; long ones with the digests of their ends) and anchors ("a")."""
    out = set()
    for block in texts:
        tokens = block.split(" ")
        ends = (digest(tokens[:run]), digest(tokens[-run:])) if len(tokens) >= run else (None, None)
        out.add(("b", digest(tokens), len(tokens), *ends))
        out.update(("a", d, run, None, None) for _, d in anchors(tokens, run, long))
    return list(out)


def _strings(of: DataFrame, long: int) -> DataFrame:
    """(pool, key, digest) of the strings of ``long`` tokens in the pages' ``stretches``, by a suffix array per batch and pool."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays(held: dict[str, dict[int, list[list[str]]]]) -> Iterator[pa.RecordBatch]:
            for pool, by_key in held.items():
                keys = list(by_key)
                found = suffix_groups(list(by_key.values()), long)
                rows = [pa.array([pool] * len(found)), pa.array([keys[k] for _, k, _ in found], pa.int64()), pa.array([xxhash.xxh3_128_digest(t.encode()) for t, _, _ in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(rows, names=["pool", "key", "digest"])

        held: dict[str, dict[int, list[list[str]]]] = {}
        size = 0
        for batch in batches:
            for pool, key, parts in zip(*batch.columns):
                streams = [part.split(" ") for part in parts.as_py()]
                held.setdefault(pool.as_py(), {})[key.as_py()] = streams
                size += sum(map(len, streams))
                if size >= TOGETHER // 8:
                    yield from arrays(held)
                    held, size = {}, 0
        yield from arrays(held)

    return of.select("pool", "key", "stretches").mapInArrow(run, "pool string, key long, digest binary")


def boilerplate(of: DataFrame, run: int = RUN, long: int = LONG, texts: int = TEXTS, share: float = SHARE, articles: int = ARTICLES, article_share: float = ARTICLE_SHARE) -> DataFrame:
    """(pool, key, covers): per text what of it its pool repeats, as structs of kind, digest and size in tokens.

    Kinds: "b" a whole block, "p" and "s" a shorter one that a block begins or ends with, "a" an anchor, "l" a string
    of ``long`` tokens.
    """
    least = F.when(F.max("marked"), F.greatest(F.lit(articles), F.ceil(F.count("*") * article_share))).otherwise(F.greatest(F.lit(texts), F.ceil(F.count("*") * share)))
    many = of.select("pool", "key", "marked").distinct().groupBy("pool").agg(least.alias("least"))
    many = materialize(many, "html-pools")
    open_ = of.join(materialize(_often(of, many, min(texts, articles), run, long), "html-often"), "pool")

    def shared(rows: DataFrame, *by: str) -> DataFrame:
        each = rows.select("pool", *by, "key").distinct().groupBy("pool", *by).agg(F.count("*").alias("n")).where(F.col("n") >= min(texts, articles))
        return each.join(many, "pool").where(F.col("n") >= F.col("least")).select("pool", *by)

    marks = materialize(_marked(open_, run, long), "html-marks")
    both = materialize(shared(marks, "kind", "digest", "size", "first", "last"), "html-shared")
    marked = marks.join(both.select("pool", "kind", "digest"), ["pool", "kind", "digest"], "left_semi")
    found = marked.select("pool", "key", "kind", "digest", "size")
    long_ones = both.where(F.col("first").isNotNull())
    for kind, end in (("p", "first"), ("s", "last")):
        whole = long_ones.select(F.col("pool").alias("of"), F.col(end).alias("end"), F.col("digest").alias("part"), F.col("size").alias("part_size"))
        at = (F.col("pool") == F.col("of")) & (F.col(end) == F.col("end")) & (F.col("size") > F.col("part_size"))
        inside = marks.where(F.col(end).isNotNull()).join(whole, at)
        found = found.unionByName(inside.select("pool", "key", F.lit(kind).alias("kind"), F.col("part").alias("digest"), F.col("part_size").alias("size")))

    near = marked.where("kind = 'a'").groupBy("pool", "key").agg(F.collect_set("digest").alias("anchors"))
    parts = _stretched(open_.join(near, ["pool", "key"]), run, long)
    strings = materialize(_strings(parts, long).distinct(), "html-strings")
    same = strings.join(shared(strings, "digest"), ["pool", "digest"], "left_semi")
    found = found.unionByName(same.select("pool", "key", F.lit("l").alias("kind"), "digest", F.lit(long).alias("size")))
    return found.groupBy("pool", "key").agg(F.collect_set(F.struct("kind", "digest", "size")).alias("covers"))


def _stretched(of: DataFrame, run: int, long: int) -> DataFrame:
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                found = stretches(row.column(2)[0].as_py(), set(row.column(3)[0].as_py()), run, long)
                lists = pa.array([[" ".join(tokens) for _, _, tokens in found]], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([row.column(0), row.column(1), lists], names=["pool", "key", "stretches"])

    return of.dropDuplicates(["pool", "key"]).select("pool", "key", "blocks", "anchors").mapInArrow(parts, "pool string, key long, stretches array<string>")


def uncovered(texts: list[str], covers: list[dict] | None, run: int = RUN, long: int = LONG) -> list[str]:
    """Blocks without what ``covers`` names; blocks of which nothing is left go."""
    if not covers:
        return texts
    by: dict[str, dict[bytes, int]] = {}
    for c in covers:
        by.setdefault(c["kind"], {})[bytes(c["digest"])] = c["size"]
    gone: list[set[int]] = [set() for _ in texts]
    for k, block in enumerate(texts):
        tokens = block.split(" ")
        if digest(tokens) in by.get("b", ()):
            gone[k].update(range(len(tokens)))
            continue
        for d, size in by.get("p", {}).items():
            if size < len(tokens) and digest(tokens[:size]) == d:
                gone[k].update(range(size))
        for d, size in by.get("s", {}).items():
            if size < len(tokens) and digest(tokens[-size:]) == d:
                gone[k].update(range(len(tokens) - size, len(tokens)))
    if "l" in by:
        for k, low, tokens in stretches(texts, set(by.get("a", ())), run, long):
            for i in range(len(tokens) - long + 1):
                if digest(tokens[i : i + long]) in by["l"]:
                    gone[k].update(range(low + i, low + i + long))
    left = [" ".join(t for i, t in enumerate(block.split(" ")) if i not in g) if g else block for block, g in zip(texts, gone)]
    return [block for block in left if block]


def extract(pages: DataFrame, run: int = RUN, long: int = LONG, texts: int = TEXTS, share: float = SHARE, articles: int = ARTICLES, article_share: float = ARTICLE_SHARE) -> DataFrame:
    """(page_id, url, text) per row of ``pages``. Each page is parsed once; what comes of it is written."""
    with setting(pages.sparkSession, "spark.sql.parquet.compression.codec", "zstd"):
        found = materialize(parsed(pages), "html-parsed")
    pool = F.concat(F.when(F.col("marked"), "article ").otherwise("page "), host_of(F.col("url")))
    of = found.select("page_id", "url", "blocks", "marked", pool.alias("pool"), F.xxhash64("blocks").alias("key"))
    covers = materialize(boilerplate(of, run, long, texts, share, articles, article_share), "html-covers")
    met = of.join(covers.select(F.col("pool").alias("of"), F.col("key").alias("of_key"), "covers"), (F.col("pool") == F.col("of")) & (F.col("key") == F.col("of_key")), "left")

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pc.binary_join(batch.column(2), " ")
            if batch.column(4).null_count < len(batch):
                left = [_left(b.as_py(), m.as_py(), c.as_py(), run, long) if c.is_valid else t.as_py() for b, m, c, t in zip(*batch.columns[2:], text)]
                text = pa.array(left, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text], names=["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return met.select("page_id", "url", "blocks", "marked", "covers").mapInArrow(rest, f"page_id {kind}, url string, text string")


def _left(texts: list[str], marked: bool, covers: list[dict], run: int, long: int) -> str:
    whole, left = " ".join(texts), " ".join(uncovered(texts, covers, run, long))
    size = lambda text: len(text.split())
    return whole if marked and size(whole) - size(left) >= ARTICLE_REPEAT * size(whole) else left


@query("op10_html_text")
def op10(spark, folder):
    return extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))
