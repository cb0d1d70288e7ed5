"""Main text of web pages: markup roles and a suffix array over the pages of a host.

A page is cut into blocks. Roles of the markup (navigation, footers, forms, adverts, comments, ...) settle what a host
seen once cannot show by repetition. An article keeps all that no role drops: sentences that two articles share are
content. Of the other text, and of pages without an article, whatever the host's pages repeat is cut: long runs of
words, found by sorting the suffixes of all blocks, and whole blocks.
Copies and near copies of a page count as one page, so their own text is no repetition, and what counts as repeated
grows with the number of different pages.

``main_texts`` is this rule over the pages of one host in memory. ``extract`` gives the same texts for hosts of any size: suffix
arrays over some pages each count their runs, the counts are summed per host, and near copies are linked by joins.
Neither the size of a host nor the dealing of its pages decides a result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faresift.llm.common import materialise
from faresift.llm.graph import components

# Words of a short run (told apart in near copies) and of a run that is cut; different pages it must stand on, at least and as a share of the host's; covered share of a page from which it
# may be a near copy, and the share of short runs that near copies have in common.
RUN_WORDS = 4
LONG_WORDS = 10
RUN_PAGES = 2
PAGE_SHARE = 0.05
COVERED = 0.5
NEAR = 0.8
# Characters of text that one suffix array is built over: a bound on memory, of no effect on results.
HOST_BYTES = 2_000_000

# HTML elements by what they do.
RAW = frozenset("script style title textarea xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noscript ol option p pre section "
    "select summary table tbody tfoot thead tr ul".split()
)
SPACES = frozenset("br td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that end an open paragraph or item only within themselves.
SCOPES = frozenset("article aside blockquote body details dialog div dl fieldset figure footer form header main nav ol section table td th ul".split())
ENDS_ITEM = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
DROPPED = frozenset("aside button canvas dialog footer form head iframe menu nav noscript object option select svg template".split())
DROPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs consent cookie cookies disqus "
    "footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo "
    "promotion recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar topbar widget widgets".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus replies reply respond".split())
NEGATIONS = frozenset("no has with without".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Block:
    text: str
    dropped: bool
    heading: bool
    article: bool
    main: bool


def _names(values: list[str]) -> set[str]:
    """Words of class and id values, without those that say something is absent or elsewhere."""
    found = set()
    for value in values:
        for name in value.split():
            words = [w.lower() for w in _NAME.findall(name)]
            found.update(w for i, w in enumerate(words) if not i or words[i - 1] not in NEGATIONS)
    return found


def _role(tag: str, attributes: str) -> tuple[bool, bool, bool, bool]:
    """(dropped, header, article, main) of an element."""
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    role = given.get("role", "").lower()
    names = _names([given.get("class", ""), given.get("id", "")])
    article, main = tag == "article" or role == "article", tag == "main" or role == "main"
    hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "")
    dropped = tag in DROPPED or role in DROPPED_ROLES or hidden or not names.isdisjoint(COMMENT_NAMES)
    if not (article or main or tag in ("body", "html")):
        dropped = dropped or not names.isdisjoint(DROPPED_NAMES)
    return dropped, tag == "header" or "header" in names and not (article or main), article, main


def blocks_of(page: str | None) -> list[Block]:
    """Blocks with text, in page order. Unclosed and crossed elements end with what holds them."""
    page, found, parts = page or "", [], []
    # Per open element: tag, dropped, header, article, main, heading; each flag holds for what is inside.
    stack: list[tuple[str, bool, bool, bool, bool, bool]] = [("", False, False, False, False, False)]

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                _, dropped, header, article, main, heading = stack[-1]
                inside = article or main
                found.append(Block(text, dropped or header and not (inside and heading), heading, article, main))
            parts.clear()

    # How often each element is open, and how many blocks are: a tag that closes nothing costs no walk.
    open_: Counter[str] = Counter()
    blocks_open = 0

    def close(tags: set[str], scopes: frozenset[str]) -> None:
        nonlocal blocks_open
        if not any(open_[t] for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                for gone in stack[k:]:
                    open_[gone[0]] -= 1
                    blocks_open -= gone[0] in BLOCKS
                del stack[k:]
                return
            if stack[k][0] in scopes:
                return

    at, n = 0, len(page)
    while at < n:
        match = _MARKUP.search(page, at)
        if not match:
            parts.append(page[at:])
            break
        parts.append(page[at : match.start()])
        at = match.end()
        if match[0].startswith("<![CDATA["):
            parts.append(html.escape(match[0][9:].removesuffix("]]>")))
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        ending, attributes = match[1] or match[4], match[3] or match[6] or ""
        if tag in RAW and not ending:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
            continue
        if tag in BLOCKS:
            flush()
        elif tag in SPACES:
            parts.append(" ")
        if ending:
            if tag in BLOCKS or not blocks_open or stack[-1][0] == tag:
                close({tag}, frozenset())
            else:
                close({tag}, BLOCKS)
        elif tag not in VOID:
            if tag in BLOCKS and tag not in ("html", "head", "body"):
                close({"p"}, SCOPES)
                close(ENDS_ITEM.get(tag, set()), frozenset(("ul", "ol", "dl", "table", "select", "menu")))
            if tag == "body":
                close({"head"}, frozenset())
            _, dropped, header, article, main, heading = stack[-1]
            own = _role(tag, attributes)
            open_[tag] += 1
            blocks_open += tag in BLOCKS
            stack.append((tag, dropped or own[0], header or own[1], article or own[2], main or own[3], heading or tag in HEADINGS))
    flush()
    return found


def _starts(streams: list[list[str]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank, lengths): each word's rank by the ``size`` words from it on, and the streams' lengths with separators.

    The streams are concatenated and the suffixes sorted by prefix doubling until ``size`` words are told apart.
    One separator stands behind each stream; separators are unique, so no run crosses a stream.
    """
    sizes = np.array([len(s) for s in streams], np.int64)
    seen: dict[str, int] = {}
    is_end = np.zeros(sizes.sum() + len(sizes), bool)
    is_end[np.cumsum(sizes + 1) - 1] = True
    rank = np.empty(len(is_end), np.int64)
    rank[~is_end] = [seen.setdefault(w, len(seen)) for s in streams for w in s]
    rank[is_end] = len(seen) + np.arange(is_end.sum())
    known = 1
    while known < size:
        step = min(known, size - known)
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - step)] = rank[step:] + 1
        _, rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)
        known += step
    return rank, sizes + 1


def _marked(rank: np.ndarray, lengths: np.ndarray, owners: list[int], size: int, least: int) -> list[np.ndarray]:
    """Per stream and word: whether it lies in a run of ``size`` words that ``least`` owners have."""
    # Suffixes with the same first words: count their distinct owners.
    own = np.repeat(np.array(owners, np.int64), lengths)
    n_owners = own.max(initial=0) + 1
    runs = np.unique(rank * n_owners + own) // n_owners
    pages = np.bincount(runs, minlength=rank.max(initial=0) + 1)
    starts = np.flatnonzero(pages[rank] >= least)
    marks = np.zeros(len(rank) + size, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + size, -1)
    covered = np.cumsum(marks)[: len(rank)] > 0
    return [part[:-1] for part in np.split(covered, np.cumsum(lengths)[:-1])]


def repeated_words(streams: list[list[str]]) -> list[np.ndarray]:
    """Per page and word: whether it lies in a run of RUN_WORDS or more that other pages repeat."""
    if not any(streams):
        return [np.zeros(0, bool) for _ in streams]
    return _marked(*_starts(streams, RUN_WORDS), list(range(len(streams))), RUN_WORDS, RUN_PAGES)


class _Cover:
    """What different pages of a host repeat: their suffixes are sorted once, owners and least may then change."""

    def __init__(self, contents: list[list[tuple[list[str], bool]]]) -> None:
        self.contents = contents
        self.streams = [words for blocks in contents for words, _ in blocks]
        self.page = [k for k, blocks in enumerate(contents) for _ in blocks]
        self.suffixes = _starts(self.streams, LONG_WORDS)
        self.holders: dict[tuple[str, ...], set[int]] = {}
        for k, words in zip(self.page, self.streams, strict=True):
            self.holders.setdefault(tuple(words), set()).add(k)

    def by(self, owners: list[int], least: int) -> list[list[np.ndarray]]:
        """Per content, block and word: whether ``least`` owners repeat it, as a long run or as a whole block."""
        if not self.streams:
            return [[] for _ in self.contents]
        runs = iter(_marked(*self.suffixes, [owners[k] for k in self.page], LONG_WORDS, least))
        whole = {w for w, held in self.holders.items() if len(held) >= least and len({owners[k] for k in held}) >= least}
        found = []
        for blocks in self.contents:
            covers = []
            for words, article in blocks:
                cover = next(runs)
                if not article and tuple(words) in whole:
                    cover = np.ones(len(words), bool)
                covers.append(cover)
            found.append(covers)
        return found


def _near_copies(contents: list[list[tuple[list[str], bool]]], suspects: list[int]) -> list[int]:
    """Per content the least one of its near copies: those with NEAR of the larger one's short runs in common."""
    runs = {}
    for k in suspects:
        words = [w for own, _ in contents[k] for w in own]
        runs[k] = {tuple(words[i : i + RUN_WORDS]) for i in range(max(1, len(words) - RUN_WORDS + 1))}
    root = list(range(len(contents)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    # Such pairs share one of the rarest runs of each: one more than either may lack.
    often = Counter(r for own in runs.values() for r in own)
    holders: dict[tuple[str, ...], list[int]] = {}
    for k, own in runs.items():
        rare = sorted(own, key=lambda r: (often[r], r))[: len(own) - math.ceil(NEAR * len(own)) + 1]
        for other in {h for r in rare for h in holders.get(r, ())}:
            if find(other) != find(k) and len(own & runs[other]) >= NEAR * max(len(own), len(runs[other])):
                x, y = find(other), find(k)
                root[max(x, y)] = min(x, y)
        for r in rare:
            holders.setdefault(r, []).append(k)
    return [find(k) for k in range(len(contents))]


def boilerplate(contents: list[list[tuple[list[str], bool]]]) -> list[list[np.ndarray]]:
    """Per different page of a host, block and word: whether it is repeated text of the host.

    A content is the blocks of a page that no role drops: words, and whether they stand inside its article.
    """
    alone = list(range(len(contents)))
    cover = _Cover(contents)
    first = cover.by(alone, RUN_PAGES)
    sizes = [sum(map(len, own)) for own in first]
    suspects = [k for k in alone if sizes[k] and sum(c.sum() for c in first[k]) >= COVERED * sizes[k]]
    owners = _near_copies(contents, suspects)
    pages = len(set(owners))
    least = max(RUN_PAGES, math.ceil(PAGE_SHARE * pages))
    return first if pages == len(contents) and least == RUN_PAGES else cover.by(owners, least)


def _left(words: list[str], cover: np.ndarray) -> list[str]:
    return [words[i] for i in np.flatnonzero(~cover)] if cover.any() else words


def main_texts(pages: list[str | None]) -> list[str]:
    """Main text of each page of one host."""
    # Pages with the same blocks are one content.
    known: dict[tuple, int] = {}
    place = []
    for page in pages:
        body = tuple((b.text, b.article) for b in blocks_of(page) if not b.dropped)
        place.append(known.setdefault(body, len(known)))
    contents = [[(text.split(), inside) for text, inside in body] for body in known]
    texts = []
    for blocks, covers in zip(contents, boilerplate(contents), strict=True):
        left = [words if article else _left(words, cover) for (words, article), cover in zip(blocks, covers, strict=True)]
        texts.append("\n\n".join(" ".join(words) for words in left if words))
    return [texts[k] for k in place]


PARSED = "host string, content string, blocks array<struct<text string, article boolean>>, outside boolean"
PLACES = "array<struct<content string, start int, size int>>"


def _digest(kind: bytes, host: str, words: list[str], size: int) -> bytes:
    return blake2b(f"{len(host)} {host} {' '.join(words)}".encode(), digest_size=size, person=kind).digest()


def _key(kind: bytes, host: str, words: list[str]) -> int:
    """64 bits that tell the runs, or the blocks, of a host apart."""
    return int.from_bytes(_digest(kind, host, words, 8), "little", signed=True)


def _parse(pages: DataFrame) -> DataFrame:
    """Per row of pages: page_id, url, host, digest of its blocks that no role drops, these, whether one is outside articles."""
    from pyspark.sql.pandas.types import to_arrow_schema

    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))).alias("host")
    own = StructType([pages.schema["page_id"], pages.schema["url"]])
    schema = StructType([*own.fields, *StructType.fromDDL(PARSED).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, found = batch.column(2).to_pylist(), []
            for host, page in zip(hosts, batch.column(3), strict=True):
                blocks = [(b.text, b.article) for b in blocks_of(page.as_py()) if not b.dropped]
                content = _digest(b"page", host, [f"{len(text)} {article} {text}" for text, article in blocks], 16).hex()
                outside = not all(article for _, article in blocks)
                found.append((content, [{"text": t, "article": a} for t, a in blocks], outside))
            columns = [batch.column(0), batch.column(1), batch.column(2)]
            columns += [pa.array([f[i] for f in found], arrow.field(3 + i).type) for i in range(3)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return pages.select("page_id", "url", host, "html").mapInArrow(run, schema)


def _words(blocks: list[dict]) -> list[tuple[list[str], bool]]:
    return [(b["text"].split(), b["article"]) for b in blocks]


def _runs(host: str, ids: list[str], contents: list[list[tuple[list[str], bool]]]) -> pa.Table:
    """(run, pages, places): each run of LONG_WORDS words, by the suffix array of these contents, and each whole block.

    ``pages`` counts the contents that have it. A place is the first word in its content and the number of words that
    go if it is repeated: none for a whole block of an article, which only counts.
    """
    streams = [words for blocks in contents for words, _ in blocks]
    page = np.repeat(np.arange(len(contents)), [len(blocks) for blocks in contents])
    rank, lengths = _starts(streams, LONG_WORDS)
    begin = np.cumsum(lengths) - lengths
    sizes = lengths - 1
    words_of = np.bincount(page, sizes, len(contents)).astype(np.int64)
    first = np.cumsum(sizes) - sizes - (np.cumsum(words_of) - words_of)[page]
    inside = np.arange(len(rank)) - np.repeat(begin, lengths)
    full = np.flatnonzero(inside + LONG_WORDS <= np.repeat(sizes, lengths))
    full = full[np.argsort(rank[full], kind="stable")]
    owner, start = np.repeat(page, lengths)[full], (inside + np.repeat(first, lengths))[full]
    heads = np.flatnonzero(np.diff(rank[full], prepend=-1))
    stream = np.repeat(np.arange(len(streams)), lengths)[full[heads]]
    keys = [_key(b"run", host, streams[s][i : i + LONG_WORDS]) for s, i in zip(stream.tolist(), inside[full[heads]].tolist(), strict=True)]

    whole: dict[tuple[str, ...], list[int]] = {}
    for k, words in enumerate(streams):
        whole.setdefault(tuple(words), []).append(k)
    held = np.array([k for own in whole.values() for k in own], np.int64)
    article = np.array([a for blocks in contents for _, a in blocks], bool)
    keys += [_key(b"block", host, list(words)) for words in whole]
    ends = np.cumsum([len(own) for own in whole.values()]) + len(full)
    offsets = np.concatenate([heads, [len(full)], ends])
    owner = np.concatenate([owner, page[held]])
    start = np.concatenate([start, first[held]])
    size = np.concatenate([np.full(len(full), LONG_WORDS), np.where(article, 0, sizes)[held]])
    pages = [len(set(owner[x:y].tolist())) if y - x > 1 else 1 for x, y in zip(offsets, offsets[1:])]
    names = pa.array(ids, pa.string()).take(pa.array(owner))
    fields = [names, pa.array(start, pa.int32()), pa.array(size, pa.int32())]
    places = pa.StructArray.from_arrays(fields, ["content", "start", "size"])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), places)
    return pa.table([pa.array(keys, pa.int64()), pa.array(pages, pa.int64()), lists], ["run", "pages", "places"])


def _run_counts(contents: DataFrame) -> DataFrame:
    """(run, pages, places) of suffix arrays over up to HOST_BYTES of the contents of one host; see ``_runs``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = f"run long, pages long, places {PLACES}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, size, ids, held = "", 0, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["host"] != host or size > HOST_BYTES):
                    yield from _runs(host, ids, held).cast(arrow).to_batches()
                    size, ids, held = 0, [], []
                host = row["host"]
                ids.append(row["content"])
                held.append(_words(row["blocks"]))
                size += sum(len(b["text"]) for b in row["blocks"])
        if held:
            yield from _runs(host, ids, held).cast(arrow).to_batches()

    dealt = contents.filter(F.size("blocks") > 0).select("host", "content", "blocks").repartitionByRange("host", "content").sortWithinPartitions("host", "content")
    return dealt.mapInArrow(run, schema)


def _marks(places: list[dict], n: int) -> np.ndarray:
    """Per word of a content of n words whether a place covers it."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, [p["start"] for p in places], 1)
    np.add.at(steps, [p["start"] + p["size"] for p in places], -1)
    return np.cumsum(steps)[:n] > 0


def _suspects(contents: DataFrame, hits: DataFrame) -> DataFrame:
    """(content, shingles): contents that repeats cover to COVERED, with their different short runs."""
    schema = "content string, shingles array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                words = [w for own, _ in _words(row["blocks"]) for w in own]
                if _marks(row["places"], len(words)).sum() >= COVERED * len(words):
                    starts = range(max(1, len(words) - RUN_WORDS + 1))
                    found.append((row["content"], sorted({_key(b"near", row["host"], words[i : i + RUN_WORDS]) for i in starts})))
            columns = [pa.array([c for c, _ in found], pa.string()), pa.array([s for _, s in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["content", "shingles"])

    places = hits.filter("size > 0").groupBy("content").agg(F.collect_set(F.struct("start", "size")).alias("places"))
    return contents.join(places, "content").select("host", "content", "blocks", "places").mapInArrow(run, schema)


def _alike(pairs: DataFrame, suspects: DataFrame) -> DataFrame:
    """The pairs (x, y) of contents that have NEAR of the larger one's short runs in common."""
    x = suspects.select(F.col("content").alias("x"), F.col("shingles").alias("of_x"))
    y = suspects.select(F.col("content").alias("y"), F.col("shingles").alias("of_y"))
    larger = F.greatest(F.size("of_x"), F.size("of_y"))
    near = F.size(F.array_intersect("of_x", "of_y")) >= F.lit(NEAR) * larger
    return pairs.distinct().join(x, "x").join(y, "y").filter(near).select("x", "y")


def _near_roots(suspects: DataFrame) -> DataFrame:
    """(node, root): the components of near copies, as ``_near_copies`` finds them.

    Near copies share one of the rarest runs of each: one more than either may lack; runs of one content alone are
    no candidates. First the contents of such a run are compared with the least one of them alone, then those that this
    leaves in different components with each other. So a group of like pages costs no pairs; the number of
    pairs is quadratic only in contents that share their rarest runs and are no near copies.
    """
    each = suspects.select("content", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    rarest = F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("shared")
    shared = each.join(often, "shingle").groupBy("content").agg(rarest, F.first("n").alias("n"))
    enough = F.greatest(F.lit(0), F.size("shared") - F.ceil(F.lit(NEAR) * F.col("n")).cast("int") + 1)
    rare = shared.select("content", F.explode(F.slice("shared", F.lit(1), enough)).alias("rare"))
    rare = materialise(rare.select("content", F.col("rare.shingle").alias("shingle")), "page-rare-runs")
    least = rare.groupBy("shingle").agg(F.min("content").alias("y"))
    pairs = rare.join(least, "shingle").filter("content <> y").select(F.col("content").alias("x"), "y")
    links = materialise(_alike(pairs, suspects), "page-links")
    roots = components(links, "x", "y")
    rooted = rare.join(roots.withColumnRenamed("node", "content"), "content", "left")
    rooted = rooted.select("shingle", "content", F.coalesce("root", "content").alias("root"))
    mixed = rooted.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    rooted = rooted.join(mixed.select("shingle"), "shingle")
    x = rooted.select("shingle", F.col("content").alias("x"), F.col("root").alias("root_x"))
    y = rooted.select("shingle", F.col("content").alias("y"), F.col("root").alias("root_y"))
    more = materialise(_alike(x.join(y, "shingle").filter("root_x < root_y").select("x", "y"), suspects), "page-links")
    return roots if more.isEmpty() else components(links.union(more), "x", "y")


def _cuts(contents: DataFrame) -> DataFrame:
    """(content, places): what ``boilerplate`` finds, over contents of any number of hosts of any size."""
    counted = materialise(_run_counts(contents), "page-runs")
    repeated = counted.groupBy("run").agg(F.sum("pages").alias("pages")).filter(F.col("pages") >= RUN_PAGES).select("run")
    hits = materialise(counted.join(repeated, "run").select("run", F.inline("places")), "page-repeats")
    suspects = materialise(_suspects(contents, hits), "page-suspects")
    roots = _near_roots(suspects).withColumnRenamed("node", "content")
    owners = contents.select("host", "content").join(roots, "content", "left")
    owners = materialise(owners.select("host", "content", F.coalesce("root", "content").alias("owner")), "page-owners")
    share = F.ceil(F.lit(PAGE_SHARE) * F.count_distinct("owner"))
    least = owners.groupBy("host").agg(F.greatest(F.lit(RUN_PAGES), share).alias("least"))
    held = hits.join(owners, "content").groupBy("host", "run").agg(F.count_distinct("owner").alias("owners"))
    cut = held.join(least, "host").filter("owners >= least").select("run")
    places = F.collect_set(F.struct("start", "size")).alias("places")
    return hits.filter("size > 0").join(cut, "run").groupBy("content").agg(places)


def _main_text(blocks: list[dict], places: list[dict]) -> str:
    words = _words(blocks)
    cover = _marks(places, sum(len(own) for own, _ in words))
    covers = np.split(cover, np.cumsum([len(own) for own, _ in words])[:-1])
    left = [own if article else _left(own, c) for (own, article), c in zip(words, covers, strict=True)]
    return "\n\n".join(" ".join(own) for own in left if own)


def _left_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text of pages with their blocks and the places to cut, null for none."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([pages.schema["page_id"], pages.schema["url"]]).add("text", "string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_main_text(b, p or []) for b, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return pages.mapInArrow(run, schema)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    Null html has empty text; a null or odd url counts as one host of its own name. Repeated rows are kept,
    each with its text. Other columns are not read. Pages are parsed once; hosts whose pages have no text outside
    articles have nothing to cut and cost no more than that.
    """
    parsed = materialise(_parse(pages), "parsed-pages")
    text = F.array_join(F.transform("blocks", lambda b: b["text"]), "\n\n")
    texts = parsed.filter(~F.col("outside")).select("page_id", "url", text.alias("text"))
    hosts = parsed.filter("outside").select("host").distinct()
    if not hosts.isEmpty():
        contents = parsed.join(hosts, "host", "left_semi").select("host", "content", "blocks").dropDuplicates(["content"])
        cuts = _cuts(materialise(contents, "page-contents"))

        cut = parsed.filter("outside").join(cuts, "content", "left").select("page_id", "url", "blocks", "places")
        texts = texts.unionByName(_left_texts(cut))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
