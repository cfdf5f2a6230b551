"""Main text of web pages, by markup and by suffix arrays over the pages of a host.

A page is cut into blocks, each in one of three zones: the marked article, page furniture (menus,
forms, adverts and so on, by tag, role, class or id), or neither. Suffix arrays over all pages find
the token runs that pages of a host share, beside the articles and within them, and every page is
judged by these:

- Beside the articles the token streams are joined. A single class word drops a part of an article
  only if the host repeats it, and an article may be in a form or a named wrapper. On a page that
  does not mark its article, the runs shared with other pages go, and the unique runs are its text.
- A block of an article that more than half of the host's articles repeat is a notice without a
  mark and goes, unless such blocks are half of the article or more: then the pages are versions of
  one text. What fewer articles share, as a quotation or a licence, is text. These arrays are
  sparse: they hold the suffixes at every `RUN` tokens of a block and the last whole one, as a block
  that is repeated repeats these.

The zones are the check that follows: furniture goes, repeated or not.

A host may have any number of pages: each task builds arrays over the pages it holds and says of
every run how many of them have it; these counts are added up for the whole host. A run has `RUN`
tokens; the runs of a longer shared passage cover all of it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_pass, stage, texts
from .url_filter import host_and_path

OTHER, ARTICLE, FURNITURE = 0, 1, 2
#: Within an article: a class word hints at furniture. And a form or class-named element that an article may be in.
NAMED, WRAPPER = 3, 4
#: Tokens of a run (a power of two), and pages that share it from which it counts.
RUN, SHARED_BY = 8, 3
#: Articles of a host from which a block that most of them repeat counts as a notice.
NOTICE_ON = 10
#: Tokens that one suffix array covers, but for a page that alone has more. Only a matter of memory.
ARRAY_TOKENS = 2**19

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>"
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements whose content is no text at all.
_RAW = frozenset("script style noscript template svg iframe object canvas textarea select title annotation annotation-xml".split())
#: Elements of page furniture; a header only outside the article.
_FURNITURE = frozenset("nav footer aside form menu dialog button header".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo promotion banner sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent notice "
    "notices notification alert popup modal newsletter subscribe signup login share sharing social "
    "related recommended comments comment respond disqus widget toolbar pagination pager".split()
)
_ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsored".split())
_COMMENTS = frozenset("comment comments".split())
#: Names of elements in which an article is none of the page's own.
_FOREIGN = _ADVERTS | _COMMENTS | {"related", "recommended"}
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img "
    "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end tag may be missing; they carry no zone.
_LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option html body head".split())


def _zone(tag: str, attributes: str, inside: int) -> int:
    """The zone of an element within an element of zone `inside`."""
    if inside == FURNITURE:
        return FURNITURE
    said = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        said.setdefault(name.lower(), html.unescape("".join(values)).lower())
    named = f"{said.get('class', '')} {said.get('id', '')}"
    words = set() if tag in ("html", "body") else set(re.split(r"[\s_-]+", named))
    role = said.get("role", "")
    hidden = "hidden" in said or "display:none" in said.get("style", "").replace(" ", "")
    if hidden or said.get("aria-hidden") == "true" or role in _ROLES:
        return FURNITURE
    if tag in ("article", "main") or role == "main":
        return FURNITURE if words & _COMMENTS else ARTICLE
    if tag in _FURNITURE and not (tag == "header" and inside in (ARTICLE, NAMED)):
        return WRAPPER if tag == "form" and inside not in (ARTICLE, NAMED) else FURNITURE
    if tag in _INLINE:
        return FURNITURE if words & _ADVERTS else inside
    if inside in (ARTICLE, NAMED):
        # One word of a longer name says little of a part of an article: "related-work", "share-price".
        if words & (_ADVERTS | _COMMENTS) or len(words & _NAMES) > 1 or set(named.split()) & _NAMES:
            return FURNITURE
        return NAMED if words & _NAMES else inside
    if words & _NAMES:
        return FURNITURE if words & _FOREIGN else WRAPPER
    return inside


def blocks(page: str) -> list[tuple[str, int]]:
    """The blocks of text in page order with their zones, without markup."""
    found: list[tuple[str, int]] = []
    parts: list[str] = []
    open_: list[tuple[str, int]] = []
    unclosed: set[str] = set()  # without an end tag in the rest of the page
    zone = at = 0

    def close() -> None:
        block = " ".join("".join(parts).split())
        if block:
            found.append((block, FURNITURE if zone == WRAPPER else zone))
        parts.clear()

    while match := _MARKUP.search(page, at):
        if match.start() > at:
            parts.append(html.unescape(page[at : match.start()]))
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if not match[1] and tag in _RAW:
            if tag == "svg" and match[3].endswith("/"):
                continue
            end = None if tag in unclosed else re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            if end:
                at = end.end()
            elif tag in ("script", "style"):
                at = len(page)
            else:
                unclosed.add(tag)
            continue
        if tag in _VOID and tag not in ("br", "hr"):
            continue
        if tag in _INLINE and zone != FURNITURE:
            # Only a hidden or advertising one changes what is text.
            if match[1] or _zone(tag, match[3], zone) != FURNITURE:
                continue
        close()
        if tag in _VOID:
            continue
        if match[1]:
            if any(t == tag for t, _ in open_):
                while open_.pop()[0] != tag:
                    pass
        elif tag not in _LOOSE or "class" in match[3] or "role" in match[3] or "hidden" in match[3]:
            # An element with an optional end tag ends where its like begins.
            if tag in _LOOSE and open_ and open_[-1][0] == tag:
                open_.pop()
            open_.append((tag, _zone(tag, match[3], open_[-1][1] if open_ else OTHER)))
        elif open_ and open_[-1][0] == tag:
            open_.pop()
        zone = open_[-1][1] if open_ else OTHER
    if at < len(page):
        parts.append(html.unescape(page[at:]))
    close()
    return found


def suffix_ranks(tokens: np.ndarray, length: int = RUN) -> np.ndarray:
    """The place of each suffix among all, by its first `length` tokens (a power of two).

    Prefix doubling: ranks by one token give ranks by two, those by four, and so on.
    """
    ranks = np.unique(tokens, return_inverse=True)[1].astype("int64")
    step = 1
    while step < length:
        ahead = np.full(len(ranks), -1)
        ahead[:-step] = ranks[step:]
        ranks = np.unique(ranks * (len(ranks) + 1) + ahead + 1, return_inverse=True)[1].astype("int64")
        step *= 2
    return ranks


def sparse_ranks(tokens: np.ndarray, starts: np.ndarray, length: int = RUN) -> np.ndarray:
    """`suffix_ranks` of the suffixes at `starts` alone, by those ranks that they are made of."""
    ranks = tokens[starts[:, None] + np.arange(length)]
    while ranks.shape[1] > 1:
        pairs = ranks[:, ::2] * (ranks.max(initial=0) + 1) + ranks[:, 1::2]
        ranks = np.unique(pairs, return_inverse=True)[1].reshape(pairs.shape).astype("int64")
    return ranks[:, 0]


def _run_hashes(found: np.ndarray) -> np.ndarray:
    """A hash of the run that starts at each token but the last ones; they double in length as ranks do."""
    step, factor = 1, np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        while step < RUN:
            found = found[:-step] * factor + found[step:]
            factor *= factor
            step *= 2
    return found


def _named(hashes: np.ndarray, hosts: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        found = (hashes ^ hosts) * np.uint64(0xD6E8FEB86659FD93)
    return (found ^ found >> np.uint64(32)).view("int64")


def _hashed(words: Iterable[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], "uint64")


def run_names(tokens: list[str], host: str, known: dict[str, int]) -> np.ndarray:
    """A 64-bit name of the run that starts at each token but the last ones, for this host.

    `known` remembers the hashes of tokens.
    """
    found = np.array([known.get(t) or known.setdefault(t, xxhash.xxh3_64_intdigest(t)) for t in tokens], "uint64")
    return _named(_run_hashes(found), _hashed([host]))


def streams(blocks: list[str], zones: list[int]) -> list[tuple[list[str], list[int]]]:
    """The tokens between articles, with the number of the block of each."""
    made: list[tuple[list[str], list[int]]] = [([], [])]
    for number, (block, zone) in enumerate(zip(blocks, zones, strict=True)):
        if zone == ARTICLE:
            made.append(([], []))
            continue
        tokens = block.split(" ")
        made[-1][0].extend(tokens)
        made[-1][1].extend([number] * len(tokens))
    return [m for m in made if m[0]]


def article_blocks(blocks: list[str], zones: list[int]) -> list[tuple[list[str], int]]:
    """The tokens of each block of an article that has a run, with the number of the block."""
    found = ((block.split(" "), n) for n, (block, z) in enumerate(zip(blocks, zones, strict=True)) if z == ARTICLE)
    return [(tokens, number) for tokens, number in found if len(tokens) >= RUN]


def article_space(host: str) -> str:
    """What runs of a host's articles are named by: no host, as these hold no slash."""
    return "/" + host


def run_starts(sizes: np.ndarray, sparse: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where streams of these sizes, one after another, have runs, and the number of the stream of each.

    A sparse array has those at every `RUN` tokens of a stream, and its last one.
    """
    every = RUN if sparse else 1
    count = -(-(sizes - RUN) // every) + 1
    number = np.repeat(np.arange(len(sizes)), count)
    place = np.arange(len(number)) - np.repeat(np.cumsum(count) - count, count)
    return (np.cumsum(sizes) - sizes)[number] + np.minimum(place * every, (sizes - RUN)[number]), number


def sparse_starts(tokens: int) -> np.ndarray:
    """The starts of a single stream in a sparse array."""
    return run_starts(np.array([tokens]), sparse=True)[0]


@dataclass
class Runs:
    """The runs of some pages: start, name, number of the page and of the host of each."""

    tokens: np.ndarray
    starts: np.ndarray
    names: np.ndarray
    page: np.ndarray
    host: np.ndarray


def runs_of(pages: list[tuple[str, list[list[str]]]], sparse: bool = False) -> Runs:
    """The runs in the streams of some pages, each a host and its streams, in page order."""
    hosts: dict[str, int] = {}
    parts = [
        (page, hosts.setdefault(host, len(hosts)), tokens)
        for page, (host, streams) in enumerate(pages)
        for tokens in streams
        if len(tokens) >= RUN
    ]
    if not parts:
        return Runs(*(np.zeros(0, "int64") for _ in range(5)))
    page, home, streams = zip(*parts, strict=True)
    words = pa.array([t for tokens in streams for t in tokens], "string").dictionary_encode()
    tokens = words.indices.to_numpy().astype("int64")
    starts, number = run_starts(np.array([len(t) for t in streams]), sparse)
    home = np.array(home)[number]
    hashes = _run_hashes(_hashed(words.dictionary.to_pylist())[tokens])[starts]
    return Runs(tokens, starts, _named(hashes, _hashed(hosts)[home]), np.array(page)[number], home)


def counted_runs(pages: list[tuple[str, list[list[str]]]]) -> tuple[np.ndarray, np.ndarray]:
    """The runs of some pages, each a host and its streams, and how many of these pages have each."""
    names, counts, _ = owned_runs(pages)
    return names, counts


def owned_runs(
    pages: list[tuple[str, list[list[str]]]], sparse: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of some pages, how many of these pages have each, and the number of one that has it.

    One suffix array over all streams. Suffixes of equal rank and host are one run; within it the
    pages lie in order, as the sort is stable.
    """
    runs = runs_of(pages, sparse)
    if not len(runs.starts):
        return np.zeros(0, "int64"), np.zeros(0, "int32"), np.zeros(0, "int64")
    ranks = sparse_ranks(runs.tokens, runs.starts) if sparse else suffix_ranks(runs.tokens)[runs.starts]
    ranks = ranks * (runs.host.max() + 1) + runs.host
    array = np.argsort(ranks, kind="stable")
    by_rank, by_page = ranks[array], runs.page[array]
    first = np.ones(len(array), bool)
    first[1:] = by_rank[1:] != by_rank[:-1]
    new = first.copy()
    new[1:] |= by_page[1:] != by_page[:-1]
    at = np.flatnonzero(first)
    return runs.names[array[at]], np.add.reduceat(new, at, dtype="int32"), by_page[at]


def notices(host: str, blocks: list[str], zones: list[int], common: np.ndarray) -> set[int]:
    """The numbers of the article's blocks that are made of `common` runs; none if they are half of it."""
    parts = article_blocks(blocks, zones)
    if not parts or not len(common):
        return set()
    runs = runs_of([(article_space(host), [tokens for tokens, _ in parts])], sparse=True)
    sizes = [len(tokens) for tokens, _ in parts]
    gone = np.ones(len(parts), bool)
    gone[run_starts(np.array(sizes), sparse=True)[1][~np.isin(runs.names, common)]] = False
    whole = sum(block.count(" ") + 1 for block, zone in zip(blocks, zones, strict=True) if zone == ARTICLE)
    if 2 * np.dot(gone, sizes) >= whole:
        return set()
    return {number for (_, number), g in zip(parts, gone, strict=True) if g}


def unique_text(host: str, blocks: list[str], zones: list[int], shared: np.ndarray, common: np.ndarray) -> str:
    """The text of a page whose host shares the runs named in `shared`, and its articles those in `common`."""
    covered = [np.zeros(0, bool)] * len(blocks)
    for tokens, numbers in streams(blocks, zones):
        deltas = np.zeros(len(tokens) + 1, int)
        if len(tokens) >= RUN and len(shared):
            starts = np.flatnonzero(np.isin(run_names(tokens, host, {}), shared))
            np.add.at(deltas, starts, 1)
            np.add.at(deltas, starts + RUN, -1)
        flags, numbers = np.cumsum(deltas)[:-1] > 0, np.array(numbers)
        edges = np.flatnonzero(np.diff(numbers)) + 1
        for number, flag in zip(numbers[[0, *edges]], np.split(flags, edges), strict=True):
            covered[number] = flag
    marked = ARTICLE in zones or NAMED in zones
    gone = notices(host, blocks, zones, common)
    kept: list[str] = []
    for number, (block, zone, flag) in enumerate(zip(blocks, zones, covered, strict=True)):
        # What a class word hints at goes if most of it is repeated on the host as well.
        if zone == ARTICLE and number not in gone or zone == NAMED and 2 * flag.sum() <= len(flag):
            kept.append(block)
        elif zone == OTHER and not marked:
            kept += [t for t, s in zip(block.split(" "), flag, strict=True) if not s]
    return " ".join(kept)


def _rows(batch: pa.RecordBatch, *names: str) -> zip:
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _parsed(batch: pa.RecordBatch) -> dict:
    cut = [blocks(t) for t in texts(batch, "html")]
    return {n: batch.column(n) for n in ("host", "page_id", "url")} | {
        "blocks": [[b for b, _ in page] for page in cut],
        "zones": [[z for _, z in page] for page in cut],
    }


def _in_arrays(batch: pa.RecordBatch, *names: str) -> Iterator[tuple[list, list, list]]:
    """Pages for one array: their streams beside the articles, those within, and other columns."""
    beside, within, others, size = [], [], [], 0
    for host, found, zones, *other in _rows(batch, "host", "blocks", "zones", *names):
        beside.append((host, [tokens for tokens, _ in streams(found, zones)]))
        within.append((article_space(host), [tokens for tokens, _ in article_blocks(found, zones)]))
        others.append(other)
        size += sum(len(tokens) for page in (beside, within) for tokens in page[-1][1])
        if size >= ARRAY_TOKENS:
            yield beside, within, others
            beside, within, others, size = [], [], [], 0
    if others:
        yield beside, within, others


def _counted(batch: pa.RecordBatch) -> dict:
    found = [(np.zeros(0, "int64"), np.zeros(0, "int32"), np.zeros(0, "int64"))]
    for beside, within, homes in _in_arrays(batch, "home", "space"):
        for pages, sparse, home in zip((beside, within), (False, True), np.array(homes, "int64").T, strict=True):
            names, counts, owner = owned_runs(pages, sparse)
            found.append((names, counts, home[owner]))
    return dict(zip(("run", "pages", "home"), map(np.concatenate, zip(*found, strict=True)), strict=True))


def _asked(batch: pa.RecordBatch) -> dict:
    found = [(np.zeros(0, "int64"), np.zeros(0, "int64"))]
    for beside, _, rows in _in_arrays(batch, "row"):
        runs = runs_of(beside)
        found.append((np.array(rows, "int64")[:, 0][runs.page], runs.names))
    return dict(zip(("row", "run"), map(np.concatenate, zip(*found, strict=True)), strict=True))


def _judged(batch: pa.RecordBatch) -> dict:
    rows = _rows(batch, "host", "blocks", "zones", "shared", "common")
    return {n: batch.column(n) for n in ("page_id", "url")} | {
        "text": [unique_text(h, b, z, np.array(s or [], "int64"), np.array(c or [], "int64")) for h, b, z, s, c in rows]
    }


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Null or empty html gives an empty text; a null url counts to a host without name. Repeated
    rows are extracted each; pages of a host with the same blocks count as one page, whatever their
    page_id; an empty table gives no rows; other columns are not read.
    """
    host = host_and_path(F.col("url"))[0]
    source = pages.select(host.alias("host"), F.col("page_id").cast("long"), "url", "html")
    schema = "host string, page_id long, url string, blocks array<string>, zones array<tinyint>"
    # Of whatever markup leaves open beside the articles the host's repeats decide.
    marked = F.array_contains("zones", ARTICLE)
    opened = F.array_contains("zones", NAMED) | F.array_contains("zones", OTHER) & ~marked
    parsed = stage(
        arrow_pass(source, lambda: _parsed, schema).select(
            "*",
            F.monotonically_increasing_id().alias("row"),
            F.xxhash64("host", "blocks").alias("page"),
            marked.alias("marked"),
            opened.alias("open"),
        ),
        "parsed",
        compression="zstd",
    )
    repeated = parsed.groupBy("page").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = parsed.select("page", "row").join(repeated, "page").where("row <> first").select("row")
    # Small tables are written first, so that Spark knows their sizes before it moves pages or runs.
    once = parsed.join(stage(copies, "copies"), "row", "left_anti")
    # From how many pages a run counts, beside articles (as far as some page asks) and within them.
    home, space = F.xxhash64("host").alias("home"), F.xxhash64(F.concat(F.lit("/"), "host")).alias("home")
    most = F.greatest(F.lit(NOTICE_ON), F.floor(F.count("*") / 2) + 1)
    some = F.lit(SHARED_BY).cast("long")
    beside = parsed.where("open").select(home, some.alias("least"), F.lit(False).alias("within"))
    within = once.where("marked").groupBy(space).agg(most.alias("least"), F.lit(True).alias("within"))
    limits = stage(beside.distinct().union(within), "limits")
    counted = arrow_pass(
        once.select("host", home, space.alias("space"), "blocks", "zones"),
        lambda: _counted,
        "run long, home long, pages int",
    )
    often = counted.groupBy("run", "home").agg(F.sum("pages").alias("n")).where(F.col("n") >= SHARED_BY)
    shared = stage(often.join(limits, "home").where("n >= least").select("run", "home", "within"), "shared")
    # Runs beside articles may be many, so pages ask for theirs. Of runs that most articles of a host have there
    # are at most twice as many as one article has on average, so every page gets them all.
    asked = arrow_pass(
        parsed.where("open").select("row", "host", "blocks", "zones"), lambda: _asked, "row long, run long"
    )
    found = asked.join(shared.where("not within").select("run"), "run").groupBy("row")
    found = stage(found.agg(F.collect_set("run").alias("shared")), "found")
    common = shared.where("within").groupBy("home").agg(F.collect_set("run").alias("common"))
    judged = arrow_pass(
        parsed.select("*", space)
        .join(found, "row", "left")
        .join(stage(common, "common"), "home", "left")
        .select("page_id", "url", "host", "blocks", "zones", "shared", "common"),
        lambda: _judged,
        "page_id long, url string, text string",
    )
    return judged.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
