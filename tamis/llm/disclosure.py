"""Personal data: pattern finds, and terms that give a protected entity away.

Every find of a pattern is a protected entity. Words near an entity are weighed by how far
their presence gives the entity away over the whole corpus: pointwise mutual information of
word and entity over the entity's information content, which is 1 when the word occurs in
texts with the entity only. Words at or above the threshold are sanitised next to it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.blockwise import BLOCK, ROW, by_block, read_block, scanned, with_block, write_by_block
from tamis.sources.staging import stage_table

#: Words on either side of an entity that are weighed.
NEAR = 10
#: Share of an entity's information that a word may disclose.
DISCLOSURE = 0.9
#: Different contexts in which word and entity must meet.
SUPPORT = 3

KINDS = ("email", "ip", "card", "phone", "term")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
#: The same words as the pattern in ``_document_counts``.
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SPAN = "struct<start:long,rank:int,kind:string,end:long>"
FOUND = f"base array<{SPAN}>, near array<struct<entity:long,context:long,term:string,start:long,end:long>>"


def luhn(digits: str) -> bool:
    double = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(double)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost finds, from the @ outwards: linear also in texts of one endless word."""
    free = 0
    for match in _DOMAIN.finditer(text):
        start = match.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < match.start():
            yield start, match.end()
            free = match.end()


def ips(text: str) -> Iterator[tuple[int, int]]:
    for match in _IP.finditer(text):
        parts = (p.lstrip("0") for p in match[0].split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield match.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        if len(match[0]) >= 12 and 12 <= len(digits := _DIGITS.sub("", match[0])) <= 19 and luhn(digits):
            yield match.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", match[0])) <= 15:
            yield match.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, rank of kind, end)`` in order; kinds may overlap."""
    finders = enumerate((emails, ips, cards, phones))
    return sorted((a, rank, b) for rank, find in finders for a, b in find(text))


def near_terms(text: str, spans: list[tuple[int, int, int]], near: int) -> list[tuple]:
    """``(entity, context, term, start, end)`` of the words around each span, outside all spans."""
    words = [m.span() for m in _WORD.finditer(text)]
    inside = [False] * len(words)
    for a, _, b in spans:
        i = max(0, bisect_left(words, (a, 0)) - 1)
        while i < len(words) and words[i][0] < b:
            inside[i] |= words[i][1] > a
            i += 1
    free = [w for w, hit in zip(words, inside, strict=True) if not hit]
    out = []
    for a, rank, b in spans:
        value = f"{KINDS[rank]}:{text[a:b].translate(_LOWER)}"
        entity = xxhash.xxh64_intdigest(value.encode("utf-8", "replace")) - (1 << 63)
        at = bisect_left(free, (a, 0))
        window = [(text[s:e].translate(_LOWER), s, e) for s, e in free[max(0, at - near) : at + near]]
        said = " ".join(w for w, _, _ in window).encode("utf-8", "replace")
        context = xxhash.xxh64_intdigest(said) - (1 << 63)
        out.extend((entity, context, *w) for w in window)
    return out


def _finder(text: str, near: int):
    span = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int64())])
    term = pa.struct([("entity", pa.int64()), ("context", pa.int64()), ("term", pa.string()),
                      ("start", pa.int64()), ("end", pa.int64())])
    fields = [f.name for f in term]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, around = [], []
            for value in batch[text]:
                said = value.as_py() or ""
                spans = base_spans(said)
                base.append([{"start": a, "rank": r, "kind": KINDS[r], "end": b} for a, r, b in spans])
                terms = near_terms(said, spans, near) if spans else []
                around.append([dict(zip(fields, t, strict=True)) for t in terms])
            names = [n for n in batch.schema.names if n != text]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array(base, pa.list_(span)), pa.array(around, pa.list_(term))],
                names=[*names, "base", "near"],
            )

    return find


def _document_counts(docs: DataFrame, text: str) -> DataFrame:
    """``(term, n_docs)`` over all documents; counted in part before the shuffle."""
    lower = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_distinct(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    return docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))


def risky_terms(found: DataFrame, docs: DataFrame, text: str, threshold: float, support: int) -> DataFrame:
    """``(entity, term, disclosure)`` of the pairs at or above the threshold, stored."""
    total = docs.count()
    met = found.select("row", F.explode("near").alias("t")).select("row", "t.entity", "t.context", "t.term")
    contexts = met.select("entity", "term", "context").distinct().groupBy("entity", "term")
    pairs = contexts.agg(F.count(F.lit(1)).alias("n_contexts")).filter(F.col("n_contexts") >= support)
    together = met.select("entity", "term", "row").distinct().groupBy("entity", "term")
    together = together.agg(F.count(F.lit(1)).alias("n_both"))
    entities = met.select("entity", "row").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    pairs = stage_table(pairs.join(together, ["entity", "term"]).join(entities, "entity"), "disclosure-pairs")
    known = pairs.join(_document_counts(docs, text), "term")
    information = F.log(F.lit(float(total)) / F.col("n_entity"))
    mutual = F.log(F.col("n_both") * F.lit(float(total)) / (F.col("n_docs") * F.col("n_entity")))
    share = F.when(information > 0, mutual / information).otherwise(F.lit(0.0))
    risky = known.select("entity", "term", share.alias("disclosure")).filter(F.col("disclosure") >= threshold)
    return stage_table(risky, "disclosure-risky")


def find_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", near: int = NEAR, threshold: float = DISCLOSURE,
    support: int = SUPPORT,
) -> DataFrame:
    """``(key, row, block, base, terms)`` for every row of ``docs``.

    ``base`` holds the pattern finds, ``terms`` the disclosing words, both as spans of code
    points ``(start, rank, kind, end)`` in order. ``row`` is a hash of key and text: repeated
    rows share it, count once in the statistics and keep a row each. Documents are counted
    with their copies; contexts must differ to count as support, so that copies of one text
    do not make its words risky. Null text is empty; no documents give no rows.
    """
    docs = scanned(docs)
    keyed = docs.select(F.col(key).alias("key"), F.xxhash64(key, text).alias("row"), F.col(text).alias("text"))
    kind = dict(keyed.dtypes)["key"]
    schema = f"key {kind}, row long, block long, {FOUND}"
    found = stage_table(with_block(keyed).mapInArrow(_finder("text", near), schema), "entities")
    risky = risky_terms(found, docs, text, threshold, support)
    terms = found.select("row", F.explode("near").alias("t")).select("row", "t.entity", "t.term", "t.start", "t.end")
    span = F.struct("start", F.lit(4).alias("rank"), F.lit(KINDS[4]).alias("kind"), "end")
    terms = terms.join(risky, ["entity", "term"]).groupBy("row").agg(F.sort_array(F.collect_set(span)).alias("terms"))
    none = F.array().cast(f"array<{SPAN}>")
    known = found.select("key", "row", "block", "base").join(stage_table(terms, "disclosing-terms"), "row", "left")
    return known.withColumn("terms", F.coalesce("terms", none)).select("key", "row", "block", "base", "terms")


def _mask(path: str, text: str, columns: list[str]):
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, spans = None, {}
        for key, part in by_block(batches, BLOCK):
            if key != block:
                block, table = key, read_block(path, key)
                spans = {r["row"]: r["spans"] for r in table.to_pylist()} if table is not None else {}
            out = [_masked(t.as_py(), spans[r]) if r in spans else t for r, t in zip(part[ROW].to_pylist(), part[text], strict=True)]
            out = pa.array([t.as_py() if isinstance(t, pa.Scalar) else t for t in out], part[text].type)
            yield pa.RecordBatch.from_arrays([out if c == text else part[c] for c in columns], names=columns)

    return mask


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs``, a scan of files, with personal data and disclosing words generalised to their kind.

    Only ``text`` changes, and only where something was found. Overlapping finds are covered
    by the mark of the first. Spans go to the scan by block, so that texts are not shuffled.
    """
    docs = scanned(docs)
    found = find_spans(docs, key, text, **options)
    found = found.select("block", "row", F.sort_array(F.concat("base", "terms")).alias("spans"))
    path = write_by_block(found.filter(F.size("spans") > 0).dropDuplicates(["block", "row"]), docs)
    marked = with_block(docs.select("*", F.xxhash64(key, text).alias(ROW)), BLOCK)
    return marked.mapInArrow(_mask(path, text, docs.columns), docs.schema)


def _masked(text: str | None, spans) -> str | None:
    if text is None or spans is None:
        return text
    out, free = [], 0
    for s in spans:
        if s["start"] >= free:
            out += [text[free : s["start"]], f"[{s['kind'].upper()}]"]
        free = max(free, s["end"])
    return "".join([*out, text[free:]])
