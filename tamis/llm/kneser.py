"""Quality classifier: perplexity under a language model of trusted text.

The model is a bigram model per language with interpolated modified Kneser-Ney smoothing,
counted over all trusted documents. Every word of the corpus is in the vocabulary, known by
a 64-bit hash of language and word. Words that trusted text never has share the mass that
the continuations leave: by shape as words seen once do, then evenly among the types of that
shape. Counts, back-off weights and continuations are sharded tables: each block of documents
asks for its distinct bigrams and words, joins answer, and the block's scan sums the answers
per document, so what a task holds grows with its block only. A language's threshold lies a number of
interquartile ranges above the upper quartile of the scores of trusted documents that the
model was not trained on; quartiles hold also where few are held out or some are bad.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.blockwise import read_block, scanned, trim_memory, with_block, without_rows, write_by_block
from tamis.sources.staging import release, stage_scope, stage_table

#: Every ``FOLDS``-th text, by hash, is held out to set the thresholds, which lie ``FENCE``
#: interquartile ranges above the upper quartile.
FOLDS, FENCE = 5, 2.0
#: Average words that each document's score is mixed with, so that a few words do not decide.
PRIOR = 30
#: Labels up to this number of rows are broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_LABELS = 2_000_000
HELD_WORDS = 400_000
#: Blocks ask for their bigrams in so many rounds, so that the questions and answers of one round lie on disk.
ROUNDS = 4
#: The low bits of a word id say its shape; START is the shape of the start of a text.
SHAPE_BITS, START = 7, 7


def shape_of(word: str) -> int:
    """Lower, upper, title, mixed letters, digits, marks only, anything else: 0 to 6."""
    core = word if word[-1:].isalnum() else word.rstrip(".,;:!?\"')")
    if core.isalpha():
        if core.islower():
            return 0
        return 2 if len(core) == 1 or core[1:].islower() else 1 if core.isupper() else 3
    return 4 if core.isdigit() else 6 if core else 5


class _Ids(dict):
    """Word ids of one language, hashed when first met."""

    def __init__(self, lang: str):
        super().__init__()
        self.salt = f"{lang}\0"
        self.lang = xxhash.xxh64_intdigest(lang) - (1 << 63)
        self.start = self.of("", START)

    def of(self, word: str, shape: int) -> int:
        return (xxhash.xxh64_intdigest(self.salt + word) - (1 << 63)) & ~SHAPE_BITS | shape

    def __missing__(self, word: str) -> int:
        self[word] = found = self.of(word, shape_of(word))
        return found


class Words:
    """The word ids of texts; ids are the same in every task."""

    def __init__(self):
        self.ids: dict[str, _Ids] = {}

    def bigrams(self, langs: list[str], texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """``(language, previous, word)`` of all words of all texts, and the number per text."""
        if sum(map(len, self.ids.values())) > HELD_WORDS:
            self.ids.clear()
        parts, counts = [np.zeros((3, 0), np.int64)], []
        for lang, text in zip(langs, texts, strict=True):
            words = text.split() if text else []
            counts.append(len(words))
            if words:
                if lang not in self.ids:
                    self.ids[lang] = _Ids(lang)
                ids = self.ids[lang]
                part = np.empty((3, len(words)), np.int64)
                part[0], part[1, 0] = ids.lang, ids.start
                part[2] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
                part[1, 1:] = part[2, :-1]
                parts.append(part)
        return *np.concatenate(parts, axis=1), np.array(counts, np.int64)


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A 64-bit key of each bigram."""
    key = before.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word.view(np.uint64)
    key = (key ^ key >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (key ^ key >> np.uint64(32)).view(np.int64)


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    yield from (batch.slice(i, 512) for i in range(0, batch.num_rows, 512))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in batches:
        found = [words.bigrams(p["lang"].to_pylist(), p["text"].to_pylist())[:3] for p in _portions(batch)]
        if found:
            lang, before, word = np.concatenate(found, axis=1)
            _, at, counts = np.unique(pair_keys(before, word), return_index=True, return_counts=True)
            columns = (lang[at], before[at], word[at], counts)
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["lang", "u", "w", "c"])
    words.ids.clear()
    trim_memory()


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = pair_keys(batch["u"].to_numpy(), batch["w"].to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(key), batch["mass"]], names=["key", "mass"])


def _asker(told: str | None):
    """The distinct words of each block, or its distinct bigrams (a long block asks in several portions).

    Bigrams are asked for once the block was ``told`` about its words, and only where the first
    is a known context and the second a counted word: no other bigram can have been counted.
    """

    def questions(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for block, found in held.items():
            columns = [pa.array(np.full(found.shape[1], block)), *map(pa.array, found)]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "key"] if told else ["block", "lang", "key"])
        held.clear()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, answered, known = Words(), {}, None, None
        for batch in batches:
            for part in _portions(batch):
                lang, before, word, counts = words.bigrams(part["lang"].to_pylist(), part["text"].to_pylist())
                owner = np.repeat(part["block"].to_numpy(), counts)
                for block in np.unique(owner).tolist():
                    own = owner == block
                    if told:
                        if block != answered:
                            answered, known = block, None  # one block's answers at a time
                            known = _Answers(read_block(told, block), None)
                            trim_memory()
                        fresh = pair_keys(*known.possible(before[own], word[own]))[None]
                    else:
                        fresh = np.stack((np.tile(lang[own], 2), np.concatenate((before[own], word[own]))))
                    if block in held:
                        fresh = np.concatenate((held[block], fresh), axis=1)
                    held[block] = fresh[:, np.unique(fresh[-1], return_index=True)[1]]
            if len(held) > 1 or sum(x.shape[1] for x in held.values()) > 4 * HELD_WORDS:
                yield from questions(held)
        yield from questions(held)
        words.ids.clear()
        known = None
        trim_memory()

    return ask


NONE = {"key": pa.int64(), "mass": pa.float64(), "backoff": pa.float64(), "total": pa.float64(), "context": pa.bool_(), "counted": pa.bool_()}


class _Answers:
    """What a block was told: words as contexts and by themselves, and bigrams."""

    def __init__(self, words: pa.Table | None, pairs: pa.Table | None):
        none = pa.table({c: pa.array([], t) for c, t in NONE.items()})
        words, pairs = none if words is None else words, none if pairs is None else pairs
        self.pairs, at = np.unique(pairs["key"].to_numpy(), return_index=True)
        self.pair_mass = pairs["mass"].to_numpy()[at]
        self.words, at = np.unique(words["key"].to_numpy(), return_index=True)
        self.continuation, self.backoff, self.total, self.context, self.counted = (
            words[c].to_numpy()[at] for c in ("mass", "backoff", "total", "context", "counted")
        )

    def possible(self, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bigrams that may have been counted."""
        both = self.context[self.of_words(before)] & self.counted[self.of_words(word)]
        return before[both], word[both]

    def of_words(self, ids: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, ids)
        if len(ids) and (not len(self.words) or (self.words[np.minimum(at, len(self.words) - 1)] != ids).any()):
            raise RuntimeError("a word of the block was not answered")
        return at

    def log_probability(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        context = self.of_words(before)
        p = self.backoff[context] * self.continuation[self.of_words(word)]
        if len(self.pairs):
            keys = pair_keys(before, word)
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            p += np.where(self.pairs[at] == keys, self.pair_mass[at], 0.0) / self.total[context]
        return np.log(p)


def _scorer(of_words: str, of_pairs: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, block, known = Words(), None, _Answers(None, None)
        for batch in batches:
            total = np.zeros(batch.num_rows)
            numbers = np.zeros(batch.num_rows, np.int64)
            blocks = batch["block"].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(blocks)) + 1, [batch.num_rows]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a == b:
                    continue
                if blocks[a] != block:
                    block, known = blocks[a], None
                    known = _Answers(read_block(of_words, int(block)), read_block(of_pairs[int(block) % len(of_pairs)], int(block)))
                    trim_memory()
                for i in range(a, b, 512):
                    part = batch.slice(i, min(512, b - i))
                    _, before, word, counts = words.bigrams(part["lang"].to_pylist(), part["text"].to_pylist())
                    sums = np.concatenate(([0.0], np.cumsum(known.log_probability(before, word))))
                    ends = np.cumsum(counts)
                    total[i : i + len(counts)] = sums[ends - counts] - sums[ends]
                    numbers[i : i + len(counts)] = counts
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(numbers), pa.array(total)], names=[*kept, "n_tokens", "surprise"]
            )
        words.ids.clear()
        known = None
        trim_memory()

    return score


def _discounted(count: Column) -> tuple[list, Column]:
    """Counts of counts 1 to 4, and how a table with their columns discounts ``count``."""
    numbers = [F.count_if(count == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    d = [F.coalesce(i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")), F.lit(0.5)) for i in (1, 2, 3)]
    d = [F.least(F.greatest(x, F.lit(0.0)), F.lit(float(i))) for i, x in enumerate(d, 1)]
    return numbers, F.when(count == 1, d[0]).when(count == 2, d[1]).otherwise(d[2])


def train(counts: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``smooth`` for ``counts(key, c)`` of small ids, ``key`` being ``lang << 32 | u << 16 | w``.

    Returns the log probability of every counted bigram, the contexts and the continuations.
    ``sizes`` is ``(lang, size)``; the mass of unseen words is even over ``size`` words.
    """
    parted = counts.select(
        "key", "c", F.shiftright("key", 32).alias("lang"),
        F.shiftright("key", 16).bitwiseAND(F.lit(0xFFFF)).alias("u"), F.col("key").bitwiseAND(F.lit(0xFFFF)).alias("w"),
    )
    shapes = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SHAPE_BITS).cast("long"))).alias("shape")
    cut, contexts, words, _ = smooth(parted, lambda _: sizes.select("lang", shapes, (1 / F.col("size")).alias("base")))
    known = cut.join(contexts, ["lang", "u"]).join(words, ["lang", "w"])
    p = F.col("mass") / F.col("total") + F.col("backoff") * F.col("continuation")
    return known.select("key", F.log(p).alias("logp")), contexts, words


def even_by_shape(types: DataFrame):
    """How unseen words share their mass: shapes as words seen once do, types of a shape evenly.

    ``types`` is ``(lang, shape, n_types)`` of the whole corpus; gives ``(lang, shape, base)``.
    """

    def base(words: DataFrame) -> DataFrame:
        once = words.groupBy("lang", "shape").agg(F.count_if(F.col("before") == 1).alias("once"))
        shared = types.join(F.broadcast(once), ["lang", "shape"], "left")
        shared = shared.withColumn("m", F.coalesce("once", F.lit(0)) + F.lit(1.0))
        whole = shared.groupBy("lang").agg(F.sum("m").alias("whole"))
        return shared.join(F.broadcast(whole), "lang").select("lang", "shape", (F.col("m") / F.col("whole") / F.col("n_types")).alias("base"))

    return base


def smooth(parted: DataFrame, base) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Kneser-Ney tables of bigram counts ``(lang, u, w, c)``.

    Returns the discounted count (``mass``) of every bigram, the total and back-off weight of
    every context, the continuation probability of every word, and that of a word never counted, by language
    and shape. Only tables of a few rows per language are broadcast.
    """
    numbers, discount = _discounted(F.col("c"))
    language = F.broadcast(parted.groupBy("lang").agg(*numbers))
    cut = parted.join(language, "lang").withColumn("d", discount).drop("n1", "n2", "n3", "n4")
    contexts = cut.groupBy("lang", "u").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("backoff"))
    contexts = stage_table(contexts, "contexts")

    words = cut.groupBy("lang", "w").agg(F.count(F.lit(1)).alias("before"))
    words = stage_table(words.withColumn("shape", F.col("w").bitwiseAND(F.lit(SHAPE_BITS).cast("long"))), "befores")
    numbers, discount = _discounted(F.col("before"))
    language = words.groupBy("lang").agg(*numbers, F.sum("before").alias("all"))
    discounted = words.join(F.broadcast(language), "lang").withColumn("d", discount)
    rest = discounted.groupBy("lang").agg((F.sum("d") / F.first("all")).alias("rest"))
    unseen = base(words).join(F.broadcast(rest), "lang", "left")
    unseen = unseen.select("lang", "shape", (F.coalesce("rest", F.lit(1.0)) * F.col("base")).alias("continuation"))
    unseen = stage_table(unseen, "unseen")
    words = discounted.join(F.broadcast(unseen), ["lang", "shape"]).select(
        "lang", "w", ((F.col("before") - F.col("d")) / F.col("all") + F.col("continuation")).alias("continuation")
    )
    words = stage_table(words, "continuations")

    return cut.withColumn("mass", F.col("c") - F.col("d")).drop("c", "d"), contexts, words, unseen


def score(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    fence: float = FENCE,
) -> DataFrame:
    """``(key, row, block, lang, n_tokens, perplexity, threshold, rejected)`` for every row of ``docs``.

    ``docs`` is a scan of files; ``labels`` has the same key and ``quality``, ``toxic``: a
    document is trusted if all its labels say quality 1 and not toxic. Rejected are documents
    whose perplexity is above their language's threshold. Null text is empty and scores as
    average, null language is a language of its own. A language that has no held-out trusted
    documents has no threshold, and none of its documents is rejected.
    ``row`` is a hash of key and text; repeated rows keep a row each. Other columns are ignored;
    no documents, no rows.
    """
    spark, docs = docs.sparkSession, scanned(docs)
    kind = dict(docs.dtypes)[key]
    said = docs.select(
        F.col(key).alias("id"), F.xxhash64(key, text).alias("row"), F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.col(text).alias("text"), F.pmod(F.xxhash64(text), F.lit(FOLDS)).alias("fold"),
    )
    blocked = with_block(said)
    asked = blocked.select("block", "lang", "text")
    good = labels.groupBy(key).agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    good = stage_table(good.filter("q = 1 and t = 0").select(F.col(key).alias("id")), "trusted")
    if good.count() <= BROADCAST_LABELS:
        good = F.broadcast(good)
    with stage_scope(spark):
        with stage_scope(spark):
            with stage_scope(spark) as model:
                trusted = said.filter(F.col("fold") > 0).join(good, "id", "left_semi").select("lang", "text")
                counts = trusted.mapInArrow(_train, "lang long, u long, w long, c long")
                counts = stage_table(counts.groupBy("lang", "u", "w").agg(F.sum("c").alias("c")), "counts")
                release(spark, [])
                with stage_scope(spark):
                    words = stage_table(asked.mapInArrow(_asker(None), "block long, lang long, key long"), "asked-words")
                    kinds = words.select("lang", "key", F.col("key").bitwiseAND(F.lit(SHAPE_BITS).cast("long")).alias("shape")).distinct()
                    kinds = stage_table(kinds, "word-types")
                    types = kinds.filter(F.col("shape") < START).groupBy("lang", "shape").agg(F.count(F.lit(1)).alias("n_types"))
                    known, contexts, continuations, unseen = smooth(counts, even_by_shape(types))
                    release(spark, [])

                    # a context never seen backs off with weight 1; the start of a text is a context only
                    told = kinds.join(contexts.select(F.col("u").alias("key"), "backoff", "total"), "key", "left")
                    told = told.join(continuations.select(F.col("w").alias("key"), "continuation"), "key", "left")
                    told = told.join(F.broadcast(unseen.withColumnRenamed("continuation", "new")), ["lang", "shape"], "left").select(
                        "key", F.coalesce("continuation", "new", F.lit(1.0)).alias("mass"),
                        F.greatest(F.coalesce("backoff", F.lit(1.0)), F.lit(1e-12)).alias("backoff"),
                        F.coalesce("total", F.lit(1)).cast("double").alias("total"),
                        F.col("total").isNotNull().alias("context"), F.col("continuation").isNotNull().alias("counted"),
                    )
                    told = stage_table(told, "word-answers")
                    release(spark, [])
                    of_words = write_by_block(words.join(told, "key").select("block", *NONE), docs)
                keyed = model.keep(known.select("u", "w", "mass").mapInArrow(_keyed, "key long, mass double"), "bigrams")
            of_pairs = []
            for turn in range(ROUNDS):
                with stage_scope(spark):
                    mine = asked.filter(F.pmod("block", F.lit(ROUNDS)) == turn)
                    pairs = mine.mapInArrow(_asker(of_words), "block long, key long").join(keyed, "key")
                    pairs = stage_table(pairs.select("block", "key", "mass"), "bigram-answers")
                    release(spark, [])
                    of_pairs.append(write_by_block(pairs, docs))

    columns = f"id {kind}, row long, lang string, fold long, block long"
    scored = blocked.select("id", "row", "lang", "text", "fold", "block").mapInArrow(
        _scorer(of_words, of_pairs), f"{columns}, n_tokens long, surprise double"
    )
    scored = stage_table(scored, "scored")
    release(spark, [path + part for path in (of_words, *of_pairs) for part in ("", "-asked")])
    held = scored.filter("fold = 0").join(good, "id", "left_semi")
    mean = F.broadcast(held.groupBy("lang").agg((F.sum("surprise") / F.sum("n_tokens")).alias("mean")))
    mixed = (F.col("surprise") + PRIOR * F.col("mean")) / (F.col("n_tokens") + PRIOR)
    quartiles = held.join(mean, "lang").groupBy("lang").agg(F.percentile_approx(mixed, [0.25, 0.75], 10_000).alias("q"))
    cut = quartiles.select("lang", (F.col("q")[1] + fence * (F.col("q")[1] - F.col("q")[0])).alias("cut"))
    result = scored.join(mean, "lang", "left").join(F.broadcast(cut), "lang", "left")
    return result.select(
        F.col("id").alias(key), "row", "block", "lang", "n_tokens", F.exp(mixed).alias("perplexity"),
        F.exp("cut").alias("threshold"), F.coalesce(mixed > F.col("cut"), F.lit(False)).alias("rejected"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs``, a scan of files, without the rejected ones."""
    docs = scanned(docs)
    bad = score(docs, labels, key, text, **options).filter("rejected").select("block", "row").distinct()
    return without_rows(docs, key, text, bad.withColumn("once", F.lit(False)))
