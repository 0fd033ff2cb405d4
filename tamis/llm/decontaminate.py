"""Benchmark decontamination: one Aho-Corasick automaton over all test items.

Texts are normalised to words (A-Z lower-cased; a word is a run of ASCII digits, a-z and
non-ASCII characters). Every window of ``width`` words of an item is a pattern; an item
with fewer words is one pattern. Each text is scanned once and hits are mapped back to
code points of the original text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.wording import FOLD
from tamis.sources.staging import stage_table

WIDTH = 10
#: Characters of items per automaton. More items than that are scanned for in several passes.
PIECE_CHARS = 500_000

FOUND = "n_words long, items array<string>, word_spans array<struct<first:long,last:long>>"
SPANS = "array<struct<start:long,end:long>>"


def windows_of(text: bytes, width: int) -> list[tuple[str, int]]:
    """The patterns of one item, each with its number of words."""
    words = text.translate(FOLD).split()
    if not words:
        return []
    width = min(width, len(words))
    runs = (words[i : i + width] for i in range(len(words) - width + 1))
    return [(f" {b' '.join(run).decode('latin-1')} ", width) for run in runs]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans as disjoint spans in order."""
    merged: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return merged


def original_spans(text: bytes, words: list[tuple[int, int]]) -> list[dict]:
    """Spans of words as half-open spans of code points of the original text."""
    raw = np.frombuffer(text, np.uint8)
    inside = np.concatenate(([False], np.frombuffer(text.translate(FOLD), np.uint8) != 0x20, [False]))
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return [{"start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in words]


def _automaton(patterns: dict[str, tuple[int, list[str]]]):
    import ahocorasick

    tree = ahocorasick.Automaton()
    for pattern, (width, items) in patterns.items():
        tree.add_word(pattern, (len(pattern), width, items))
    tree.make_automaton()
    return tree


def _scanner(shared, text: str):
    """Adds to each row what one automaton finds in its text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _automaton(shared.value) if shared.value else None
        for batch in batches:
            names = batch.schema.names
            counts, items, spans = [], [], []
            before = zip(batch["items"].to_pylist(), batch["word_spans"].to_pylist(), strict=True)
            for raw, (old_items, old_spans) in zip(batch[text].cast(pa.binary()), before, strict=True):
                words = (raw.as_py() or b"").translate(FOLD).split()
                found, hits = set(old_items), [(x["first"], x["last"]) for x in old_spans]
                if words and tree:
                    line = f" {b' '.join(words).decode('latin-1')} "
                    matches = list(tree.iter(line))
                    if matches:
                        blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
                        at = np.searchsorted(blanks, [e - size + 1 for e, (size, _, _) in matches])
                        for first, (_, (_, width, ids)) in zip(at.tolist(), matches, strict=True):
                            hits.append((first, first + width))
                            found.update(ids)
                counts.append(len(words))
                items.append(sorted(found))
                spans.append([{"first": a, "last": b} for a, b in merge(hits)])
            new = {
                "n_words": pa.array(counts, pa.int64()),
                "items": pa.array(items, pa.list_(pa.string())),
                "word_spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
            }
            yield pa.RecordBatch.from_arrays([new.get(n, batch[n]) for n in names], names=names)

    return scan


def _patterns(benchmark: DataFrame, item: str, item_text: str, width: int) -> Iterator[dict]:
    """Pattern tables of bounded size, one after another; the items are read as a stream."""
    patterns: dict[str, tuple[int, list[str]]] = {}
    chars = 0
    rows = benchmark.select(F.col(item).cast("string"), F.col(item_text).cast("binary")).orderBy(item)
    for name, raw in rows.toLocalIterator():
        windows = windows_of(bytes(raw or b""), width)
        for pattern, size in windows:
            ids = patterns.setdefault(pattern, (size, []))[1]
            if name is not None and name not in ids:
                ids.append(name)
        chars += len(raw or b"")
        if chars >= PIECE_CHARS:
            yield patterns
            patterns, chars = defaultdict(), 0
    yield patterns


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items``, ``spans`` and ``contaminated``.

    ``items`` are the ids, as sorted strings, of the items that occur; ``spans`` the hit
    words as disjoint spans of code points. Narrow: texts are scanned where they are read.
    Items beyond ``PIECE_CHARS`` characters give further automata and passes, so what is
    broadcast stays bounded. A null or word-less text has no hits, a null or word-less item
    no patterns; a null item id contaminates without being listed. Repeated rows keep a row
    each. Columns of ``docs`` with the names above are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "spans", "contaminated", "word_spans")]
    found = docs.select(
        *kept,
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<first:long,last:long>>").alias("word_spans"),
    )
    for turn, patterns in enumerate(_patterns(benchmark, item, item_text, width)):
        if turn:
            found = stage_table(found, "contamination")
        shared = spark.sparkContext.broadcast(dict(patterns))
        found = found.mapInArrow(_scanner(shared, text), found.schema)
    sizes = F.transform("word_spans", lambda s: s["last"] - s["first"])
    n_hit = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b)

    @F.pandas_udf(SPANS)
    def to_original(texts, spans):
        import pandas as pd

        pairs = zip(texts, spans, strict=True)
        return pd.Series([original_spans((t or "").encode(), [(x["first"], x["last"]) for x in s]) for t, s in pairs])

    return (
        found.withColumn("n_hit", n_hit)
        .withColumn("contaminated", F.col("n_hit") > 0)
        .withColumn("spans", to_original(F.when(F.col("contaminated"), F.col(text)), "word_spans"))
        .drop("word_spans")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated rows; all its columns are kept, whatever their names."""
    whole = docs.select(F.struct(*docs.columns).alias("whole"), F.col(text).alias("said"))
    return find_items(whole, benchmark, "said", **options).filter("not contaminated").select("whole.*")
