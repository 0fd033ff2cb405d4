"""Main text of web pages: what pages of a host repeat, with markup as the evidence.

Every page is parsed into blocks. What its marked article holds, or without a mark all that no
menu, form or the like holds, is the page's candidate text; the other blocks are known to be no
text. The words of both form streams, of all pages of all hosts, whose suffixes are brought
together by their first ``DEPTH`` words: a substring of at least so many words that several pages
repeat is covered by such starts, so longer common prefixes would add nothing. What ``MIN_PAGES``
pages of the host repeat is found for every page and counted. Of a marked article nothing goes:
articles are copied, and adverts and footers quote them, so repetition says nothing against the
mark. Text without a mark is boilerplate where ``MIN_PAGES`` pages repeat it outside of articles,
unless as many have it in their articles.

Pages of equal words count as one page, and so do near-equal ones, as copies of an article under
other menus and names: at least half of their runs of ``DEPTH`` words are the same, by the
estimate of a sketch. On a host of fewer different pages markup alone decides.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.blockwise import by_block, read_block, scanned, with_block, write_by_block
from tamis.llm.wording import mixed
from tamis.sources.staging import Scope, release, stage_scope, stage_table

#: Words of the shortest repeated substring, and different pages that must share it.
DEPTH, MIN_PAGES = 8, 3
#: Hosts are gone through in so many rounds, so that the suffixes of one round lie on disk.
ROUNDS = 8
#: Runs that sketch a page, and those of them by which its copies are looked for.
SKETCH, MARKS = 32, 8
#: Words that a task keeps the hashes of.
HELD_WORDS = 400_000
#: Where a suffix begins: in a marked article, in text without a mark, in blocks that are no text; the runs of a sketch.
ARTICLE, BARE, NO_TEXT, LOW = range(4)
#: Pages whose suffixes are cut, dealt out or looked up together; a page's number among them, or that with a run of its sketch.
PORTION = 256

# Elements of HTML by their part in a page.
RAW = frozenset("script style textarea title template noscript svg math iframe object".split())
CHROME = frozenset("head nav footer aside form button select label menu dialog".split())
CORE = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
HINTS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " footer masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted related"
    " reply share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
ROLES = frozenset("banner navigation complementary contentinfo search form dialog alert menu menubar".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_SPLIT = re.compile(r"[\s_-]+")


def is_chrome(tag: str, attributes: str, in_core: bool) -> bool:
    """Whether an element is a menu, advert, form, notice, comment section or the like."""
    if tag in CHROME or (tag == "header" and not in_core):
        return True
    if not attributes or tag in CORE - {"article"} or tag in ("body", "html"):
        return False
    for name, *values in _NAMES.findall(attributes):
        words = _SPLIT.split(max(values, key=len).lower())
        if any(w in (ROLES if name.lower() == "role" else HINTS) for w in words):
            return True
    return bool(_HIDDEN.search(attributes))


def blocks(page: str) -> tuple[list[str], list[str]]:
    """``(article, other)``: texts of the blocks inside and outside the marked article, in order."""
    return parsed(page)[:2]


def parsed(page: str) -> tuple[list[str], list[str], list[str]]:
    """``(article, other, chrome)``: the blocks inside and outside the marked article, and of menus and the like.

    Unclosed and unmatched tags, comments and a markup cut off at the end do no harm.
    """
    article: list[str] = []
    other: list[str] = []
    beside: list[str] = []
    said: list[str] = []
    unsaid: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, chrome, core
    chrome = core = 0
    at = 0

    def close_block() -> None:
        for heard, told in ((said, article if core else other), (unsaid, beside)):
            text = " ".join(html.unescape("".join(heard)).split())
            heard.clear()
            if text:
                told.append(text)

    while match := _MARKUP.search(page, at):
        (unsaid if chrome else said).append(page[at : match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        closing, attributes = match[1] or match[4], match[3] or match[6] or ""
        if tag in INLINE and not attributes:
            if tag == "br":
                said.append(" ")
            continue
        hidden = not closing and is_chrome(tag, attributes, core > 0)
        if tag in INLINE and not closing and not hidden:
            if tag == "br":
                said.append(" ")
            continue
        if tag not in INLINE or hidden:
            close_block()
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                for _, was_chrome, was_core in stack[depth:]:
                    chrome -= was_chrome
                    core -= was_core
                del stack[depth:]
        elif tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in ("p", "li") or (tag in CORE | CHROME | {"div"} and stack and stack[-1][0] == "p"):
                # a paragraph ends where the next block begins, an item where the next item does
                if stack and stack[-1][0] in ("p", tag) and stack[-1][0] != "div":
                    _, was_chrome, was_core = stack.pop()
                    chrome -= was_chrome
                    core -= was_core
            inside = tag in CORE and not hidden and not chrome
            hidden = is_chrome(tag, attributes, core > 0)
            stack.append((tag, hidden, inside))
            chrome += hidden
            core += inside
    (unsaid if chrome else said).append(page[at:])
    close_block()
    return article, other, beside


def streams(page: str) -> tuple[int, list[str], list[str]]:
    """Whether a page marks its article, the blocks of its candidate text, and those that are no text."""
    article, other, chrome = parsed(page)
    return (ARTICLE, article, other + chrome) if article else (BARE, other, chrome)


class Runs(dict):
    """Hashes of the runs of ``depth`` words; words are hashed when first met."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, depth: int):
        super().__init__()
        self.depth = depth

    def __missing__(self, word: str) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def of(self, hosts: list[str], streams: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(runs, at, counts)``: the runs at every word but the last of each stream, as numbers of its host.

        ``at`` is the place of a run's first word among the words of all streams, ``counts`` the runs of each.
        """
        if len(self) > HELD_WORDS:
            self.clear()
        sizes = np.array([len(words) for words in streams], np.int64)
        ids = np.fromiter(map(self.__getitem__, chain.from_iterable(streams)), np.uint64, int(sizes.sum()))
        counts = np.maximum(sizes - self.depth + 1, 0)
        at = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        found = np.repeat(np.array([self[f"\0{host}"] for host in hosts], np.uint64), counts)
        for i in range(self.depth):
            found = mixed(found * self.BASE + ids[at + i])
        return found.view(np.int64), at, counts


def distinct_pairs(owner: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of two columns, in order; owners below 2**16 are sorted fastest."""
    order = np.argsort(run)
    order = order[np.argsort(owner[order], kind="stable")]
    owner, run = owner[order], run[order]
    new = np.ones(len(run), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (run[1:] != run[:-1])
    return owner[new], run[new]


def page_number(host: str, text: str) -> int:
    """Pages of a host with equal words are one page."""
    return xxhash.xxh64_intdigest(f"{host}\0{text}") - (1 << 63)


def own_pages(places: np.ndarray, of: np.ndarray) -> tuple[bytes, bytes]:
    """The pages that a row names, and their numbers in it; what is added for runs of a sketch stays."""
    mine, its = np.unique(of % PORTION, return_inverse=True)
    return places[mine].tobytes(), (its + of // PORTION * PORTION).astype(np.uint16).tobytes()


#: Suffixes travel packed: a row has those of a portion's pages that fall into one bucket.
PACKED = "bucket int, block long, part int, pages binary, of binary, suffixes binary"
MET = "block long, part int, page array<long>, suffix array<long>"


def _suffixes(depth: int, buckets: int):
    """The distinct suffixes of each page's streams by their first words; the lowest ``SKETCH`` of its text are told."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(depth)
        for block, batch in ((k, b.slice(i, PORTION)) for k, b in by_block(batches) for i in range(0, b.num_rows, PORTION)):
            hosts, parts, pages, texts, asides = batch["host"].to_pylist(), [], [], [], []
            for host, page in zip(hosts, batch["html"], strict=True):
                part, text, no_text = streams(page.as_py() or "")
                text = " ".join(text)
                parts.append(part)
                texts.append(text.split())
                asides.append(" ".join(no_text).split())
                pages.append(page_number(host, text))
            places, of = np.unique(np.array(pages, np.int64), return_inverse=True)
            parts, of = np.array(parts), of.astype(np.uint16)
            rows = []
            for part, said in ((ARTICLE, texts), (BARE, texts), (NO_TEXT, asides)):
                mine = np.flatnonzero((parts == part) | (part == NO_TEXT)).tolist()
                found, _, counts = runs.of([hosts[i] for i in mine], [said[i] for i in mine])
                owner, run = distinct_pairs(np.repeat(of[mine], counts), found)
                if part != NO_TEXT:
                    low = np.arange(len(owner)) - np.searchsorted(owner, owner) < SKETCH
                    owner = owner + (low * PORTION).astype(np.uint16)
                bucket = (run.view(np.uint64) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint64)
                order = np.argsort(bucket, kind="stable")
                bucket, owner, run = bucket[order], owner[order], run[order]
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                for k, o, r in zip(np.split(bucket, cuts), np.split(owner, cuts), np.split(run, cuts), strict=True):
                    if len(r):
                        rows.append((int(k[0]), block, part, *own_pages(places, o), r.tobytes()))
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            names = ["bucket", "block", "part", "pages", "of", "suffixes"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    return cut


def _repeated(pages: int):
    """Of the suffixes of a bucket, those that at least so many pages have, and all runs of sketches."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                held.setdefault(row[0], []).append(row[1:])
        while held:
            _, rows = held.popitem()
            found = []
            for block, part, places, of, suffix in rows:
                of = np.frombuffer(of, np.uint16)
                page = np.frombuffer(places, np.int64)[of % PORTION]
                found.append((block, part, page, np.frombuffer(suffix, np.int64), of >= PORTION))
            suffix, page = (np.concatenate([x[i] for x in found]) for i in (3, 2))
            known, n = np.unique(suffix, return_counts=True)
            often = np.isin(suffix, known[n >= pages])
            suffix, _ = distinct_pairs(suffix[often], page[often])
            known, n = np.unique(suffix, return_counts=True)
            known = known[n >= pages]
            met = []
            for block, part, page, suffix, low in found:
                kept = np.isin(suffix, known)
                met += [(block, kind, page[k], suffix[k]) for kind, k in ((part, kept), (LOW, low)) if k.any()]
            columns = [pa.array([x[0] for x in met], pa.int64()), pa.array([x[1] for x in met], pa.int32())]
            columns += [pa.array([x[i] for x in met], pa.list_(pa.int64())) for i in (2, 3)]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "part", "page", "suffix"])

    return read


def families(low: DataFrame) -> DataFrame:
    """``(page, family)``: the first page that is near-equal to a page and found by a mark, where there is one before it.

    The share of common runs is estimated from the lowest ``SKETCH`` runs of two pages.
    """
    sketches = low.groupBy("page").agg(F.sort_array(F.collect_set("suffix")).alias("sketch"))
    sketches = stage_table(sketches, "sketches")
    marked = sketches.select("page", F.explode(F.slice("sketch", 1, MARKS)).alias("mark"))
    firsts = stage_table(marked.groupBy("mark").agg(F.min("page").alias("first")), "marks")
    found = marked.join(firsts, "mark").filter("first < page").select("page", "first").distinct()
    found = found.join(sketches, "page").join(sketches.select(F.col("page").alias("first"), F.col("sketch").alias("of_first")), "first")
    both = F.slice(F.sort_array(F.array_union("sketch", "of_first")), 1, SKETCH)
    common = F.size(F.array_intersect(both, F.array_intersect("sketch", "of_first")))
    return found.filter(2 * common >= F.size(both)).groupBy("page").agg(F.min("first").alias("family"))


def repeated(scope: Scope, met: DataFrame, min_pages: int) -> DataFrame:
    """``(block, page, suffix, boilerplate)``: the runs of each page's text that the host's pages repeat, kept in ``scope``."""
    spark = met.sparkSession
    entries = met.select("block", "part", F.inline(F.arrays_zip("page", "suffix")))
    family = stage_table(families(entries.filter(F.col("part") == LOW).select("page", "suffix")), "families")
    release(spark, [])
    entries = entries.filter(F.col("part") != LOW)
    known = entries.select("suffix", "part", "page").distinct().join(family, "page", "left")
    family = F.coalesce("family", "page").alias("family")
    in_article, outside = (F.bool_or(x).alias(n) for x, n in ((F.col("part") == ARTICLE, "in_article"), (F.col("part") != ARTICLE, "outside")))
    known = known.groupBy("suffix", family).agg(in_article, outside).groupBy("suffix")
    articles, others = F.count_if("in_article"), F.count_if("outside")
    known = known.agg(F.count(F.lit(1)).alias("pages"), articles.alias("articles"), others.alias("others"))
    boilerplate = (F.col("others") >= min_pages) & (F.col("others") > F.col("articles"))
    known = known.filter(F.col("pages") >= min_pages).select("suffix", boilerplate.alias("boilerplate"))
    known = stage_table(known, "known")
    release(spark, [])
    own = entries.filter(F.col("part") != NO_TEXT).select("block", "page", "suffix").distinct()
    return scope.keep(own.join(known, "suffix").select("block", "page", "suffix", "boilerplate"), "repeated")


def unique_runs(parts: list[str], starts: list[int], depth: int) -> str:
    """The blocks without the words that repeated substrings cover.

    A substring that runs over the border of a block takes the block as a whole or not at all.
    """
    covered = {w for start in starts for w in range(start, start + depth)}
    out, at = [], 0
    for part in parts:
        words = part.split(" ")
        end = at + len(words)
        if not covered.issuperset(range(at, end)):
            inside = {w for s in starts if at <= s <= end - depth for w in range(s, s + depth)}
            out.append(" ".join(w for i, w in enumerate(words, at) if i not in inside))
        at = end
    return "\n".join(out)


def _texts(answers: str, depth: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, runs = None, Runs(depth)
        for block, batch in ((k, b.slice(i, PORTION)) for k, b in by_block(batches) for i in range(0, b.num_rows, PORTION)):
            if block != at:
                at, found = block, read_block(answers, block)
                known, gone, asked = np.zeros(0, np.int64), np.zeros(0, bool), set()
                if found is not None:
                    asked = set(found["page"].to_pylist())
                    known, first = np.unique(found["suffix"].to_numpy(), return_index=True)
                    gone = found["boilerplate"].to_numpy(zero_copy_only=False)[first]
            hosts = batch["host"].to_pylist()
            parsed_pages = [streams(page.as_py() or "") for page in batch["html"]]
            # Runs are looked up on the pages that have some.
            joined = [" ".join(text) for _, text, _ in parsed_pages]
            words = [text.split() if asked and page_number(host, text) in asked else [] for host, text in zip(hosts, joined, strict=True)]
            ends = np.cumsum([0, *map(len, words)])
            covered, dropped = np.zeros(ends[-1] + 1, np.int64), ends[:0]
            if ends[-1]:
                run, starts, _ = runs.of(hosts, words)
                place = np.minimum(np.searchsorted(known, run), len(known) - 1)
                hit = known[place] == run
                starts, dropped = starts[hit], starts[hit & gone[place]]
                covered[starts] += 1
                covered[starts + depth] -= 1
            total = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
            texts = []
            for i, (part, text, _) in enumerate(parsed_pages):
                mine = dropped[np.searchsorted(dropped, ends[i]) : np.searchsorted(dropped, ends[i + 1])] - ends[i]
                texts.append(unique_runs(text, mine.tolist(), depth) if part == BARE and len(mine) else "\n".join(text))
            columns = [batch["key"], batch["url"], pa.array(texts, pa.string()), pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "url", "text", "n_repeated"])

    return read


def main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", depth: int = DEPTH, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``(key, url, text, n_repeated)`` for every page.

    Character references are decoded, white space in a block is one space, blocks are joined
    by a line break in page order. Null or empty html gives an empty text, pages of a null url
    are of one host; repeated rows keep a row each and, like all pages of equal words, count
    as one page of the host. ``n_repeated`` counts the words of the candidate text that lie in
    runs which ``min_pages`` pages of the host have anywhere; text without a mark loses those of
    them that are boilerplate. Other columns are ignored; no pages give no rows.
    """
    spark, pages = pages.sparkSession, scanned(pages)
    rows = with_block(pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(body).alias("html")))
    host = F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z]+://([^/?#]*)", 1), F.lit(""))
    rows = rows.withColumn("host", host)
    turn = F.pmod(F.xxhash64("host"), F.lit(ROUNDS))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with stage_scope(spark) as scope:
        covered = spark.createDataFrame([], "block long, page long, suffix long, boilerplate boolean")
        for mine in sorted(r[0] for r in rows.select(turn).distinct().collect()):  # at most ROUNDS numbers
            with stage_scope(spark):
                packed = rows.filter(turn == mine).select("block", "host", "html").mapInArrow(_suffixes(depth, buckets), PACKED)
                met = packed.repartition("bucket").mapInArrow(_repeated(max(2, min_pages)), MET)
                met = stage_table(met, "shared-suffixes")
                release(spark, [])
                covered = covered.unionByName(repeated(scope, met, min_pages))
        answers = write_by_block(covered, pages)
    release(spark, [])
    kind = dict(pages.dtypes)[key]
    texts = rows.select("key", "url", "html", "host", "block").mapInArrow(
        _texts(answers, depth), f"key {kind}, url string, text string, n_repeated long"
    )
    return texts.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_repeated")
