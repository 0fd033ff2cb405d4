"""SentencePiece encoding and decoding over a relational lattice.

Texts become pieces of a given piece table by the path of the highest total score, as a
unigram model scores it. All in relations: distinct words of the corpus explode into their
substrings of bounded length, an equi-join with the piece table keeps the pieces, edges are
grouped by word, and a higher-order aggregate folds the Viterbi recursion over them. Each
block of documents reads the segmentation of its words and puts its texts together.

Spaces are written as the mark U+2581, one is put before a text, and what no piece covers is
spelled in byte pieces; decoding gives back every text exactly. A piece table trained by
merging pairs is used with its scores as they are, so the best path is the table's best by
score, which is not always the result of merging.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.blockwise import read_block, read_table, scanned, trim_memory, with_block, write_by_block
from tamis.sources.staging import Scope, owned_folder, release, session_setting, stage_scope, stage_table

MARK = "▁"
#: Longer words, which hardly recur, are folded in the task that holds their text.
LONGEST = 128
#: Segments that a task collects before it asks for their words, and keeps the ids of.
HELD_WORDS, HELD_SEGMENTS = 50_000, 200_000
#: Words whose edges a task groups at once, and rows of asked words.
WORDS, ASKED = 10_000, 100_000
FALLBACK = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"

# Runs in which all pieces of the table lie: letters, or anything else, after at most one mark.
SPLIT = rf"{MARK}?[\p{{L}}\p{{M}}]+|{MARK}?[^\p{{L}}\p{{M}}{MARK}\n]+|{MARK}|\n"


def read_pieces(path: str) -> tuple[list[tuple[str, int, float]], list[int]]:
    """``(piece, id, score)`` of a model's pieces, and the ids of its 256 byte pieces."""
    import regex
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        (model.id_to_piece(i), i, float(model.get_score(i)))
        for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    whole = regex.compile(SPLIT)
    crossing = [(p, s) for p, _, s in pieces if not whole.fullmatch(p) and p.strip(MARK)]
    if crossing:
        raise ValueError(f"pieces that cross the runs words are cut into: {crossing[:5]}")
    return pieces, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def bounds(pieces: list[tuple[str, int, float]]) -> tuple[int, float]:
    """Characters of the longest piece, and the score of a character that no piece covers."""
    return max((len(p) for p, _, _ in pieces), default=1), min((s for _, _, s in pieces if s > -1e8), default=0.0) - 10


class Cutter:
    """Texts as words; ``None`` stands for a literal mark, which is spelled in bytes.

    No word goes beyond the next space, so texts are cut at their spaces first; what stands
    between two of them mostly recurs and is cut into words once.
    """

    def __init__(self):
        import regex

        self.find = regex.compile(SPLIT).findall

    def segments(self, text: str) -> list[str]:
        return text.split(" ") if text else []

    def cut(self, segment: str) -> list[str | None]:
        """The words of a segment and the space before it."""
        if segment.isalpha():
            return [MARK + segment]
        if MARK not in segment:
            return self.find(MARK + segment)
        first, *rest = segment.split(MARK)
        words: list[str | None] = self.find(MARK + first)
        for part in rest:
            words += [None, *self.find(part)]
        return words

    def words(self, text: str) -> list[str | None]:
        return [word for segment in self.segments(text) for word in self.cut(segment)]


def _asker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each block, asked for in portions.

    What a block met before is known by hash, so a portion cuts its new segments only. A word that
    goes unasked because its hash was met is folded in the task that holds its text.
    """
    cutter, block, held, met = Cutter(), None, set(), (set(), set())

    def fresh(found: Iterable[str], before: set[int]) -> list[str]:
        new = [x for x in found if hash(x) not in before]
        before.update(map(hash, new))
        return new

    def rows() -> pa.RecordBatch:
        words = {word for segment in fresh(held, met[0]) for word in cutter.cut(segment)} - {None, "\n"}
        words = fresh((word for word in words if len(word) <= LONGEST), met[1])
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * len(words), pa.int64()), pa.array(words, pa.string())], names=["block", "word"]
        )

    for batch in batches:
        for own, text in zip(batch["block"].to_pylist(), batch["text"], strict=True):
            if own != block:
                if held:
                    yield rows()
                block = own
                for hashes in met:
                    hashes.clear()
            held.update(cutter.segments(text.as_py() or ""))
            if len(held) > HELD_WORDS:
                yield rows()
    if held:
        yield rows()
    for hashes in met:
        hashes.clear()
    trim_memory()


def best_path(edges: Column, length: Column) -> Column:
    """Ids of the best path over ``edges(end, start, score, id)``, sorted, that reach every position.

    The state holds, per position, the best score up to it, where its last piece starts and
    the piece's id. Of equal scores the longer last piece wins.
    """
    kind = "struct<score:double,start:int,id:int>"
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"), F.lit(0).alias("id"))).cast(f"array<{kind}>")

    def extend(best: Column, e: Column) -> Column:
        def put(total: Column) -> Column:
            new = F.struct(total.alias("score"), e["start"].alias("start"), e["id"].alias("id"))
            return (
                F.when(F.size(best) == e["end"], F.array_append(best, new))
                .when(total > F.element_at(best, -1)["score"], F.array_append(F.slice(best, F.lit(1), e["end"]), new))
                .otherwise(best)
            )

        return F.transform(F.array(F.get(best, e["start"])["score"] + e["score"]), put)[0]

    def back(best: Column) -> Column:
        start = F.struct(length.cast("int").alias("at"), F.array().cast("array<int>").alias("ids"))

        def step(state: Column, _: Column) -> Column:
            last = F.get(best, state["at"])
            longer = F.struct(last["start"].alias("at"), F.concat(F.array(last["id"]), state["ids"]).alias("ids"))
            return F.when(state["at"] > 0, longer).otherwise(state)

        return F.aggregate(F.sequence(F.lit(1), length), start, step, lambda s: s["ids"])

    return F.transform(F.array(F.aggregate(edges, first, extend)), back)[0]


def segment(words: DataFrame, pieces: DataFrame, longest: int, unknown: float) -> DataFrame:
    """``(word, ids)`` for distinct non-empty ``words(word)``.

    A character that no piece covers gives -1 less its code point, at score ``unknown``.
    """
    starts = words.select("word", F.explode(F.sequence(F.lit(0), F.char_length("word") - 1)).alias("start"))
    spans = starts.select(
        "word", "start",
        F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.char_length("word") - F.col("start")))).alias("n"),
    )
    parts = spans.withColumn("piece", F.substr("word", F.col("start") + 1, F.col("n")))
    found = parts.join(F.broadcast(pieces), "piece", "left").filter("id is not null or n = 1")
    edge = F.struct(
        (F.col("start") + F.col("n")).alias("end"), "start",
        F.coalesce("score", F.lit(unknown)).alias("score"), F.coalesce("id", -1 - F.ascii("piece")).alias("id"),
    )
    grouped = found.groupBy("word").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    return grouped.select("word", best_path(F.col("edges"), F.char_length("word")).alias("ids"))


class Assembler:
    """Words of texts to ids and ids to texts, within a task."""

    def __init__(self, pieces: list[tuple[str, int, float]], byte_ids: list[int]):
        self.byte_ids = byte_ids
        self.bytes_of: dict[int, bytes] = {i: p.replace(MARK, " ").encode() for p, i, _ in pieces}
        self.bytes_of |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.scores = {p: (score, i) for p, i, score in pieces}
        self.longest, self.unknown = bounds(pieces)
        self.cutter = Cutter()
        self.learn(None)

    def spelled(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode()]

    def learn(self, table: pa.Table | None) -> None:
        """Take over the segmentation ``(word, ids)`` of a block's words."""
        self.known: dict[str | None, bytes] = {}
        if table is not None and table.num_rows:
            ids = table["ids"].combine_chunks()
            ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
            offsets = ids.offsets.to_numpy().astype(np.int64)
            values, ends = ids.values.to_numpy()[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]
            if (values < 0).any():
                spelled = [self.spelled(chr(-1 - v)) if v < 0 else [v] for v in values.tolist()]
                lengths = np.concatenate(([0], np.cumsum([len(x) for x in spelled])))
                values = np.array([v for x in spelled for v in x], np.int32)
                ends = lengths[ends]
            coded, ends = values.astype("<i4").tobytes(), (4 * ends).tolist()
            words = table["word"].to_pylist()
            self.known = {w: coded[a:b] for w, a, b in zip(words, [0, *ends], ends, strict=False)}
        for word, said in (("\n", "\n"), (None, MARK)):
            self.known[word] = np.array(self.spelled(said), "<i4").tobytes()
        self.coded: dict[str, bytes] = {}

    def fold(self, word: str) -> list[int]:
        """The best path of a long word: the same recursion, over the word as a whole."""
        best, start, last = np.full(len(word) + 1, -np.inf), [0] * (len(word) + 1), [0] * (len(word) + 1)
        best[0] = 0.0
        for end in range(1, len(word) + 1):
            for begin in range(max(0, end - self.longest), end):
                piece = word[begin:end]
                found = self.scores.get(piece)
                if found is None:
                    if begin < end - 1:
                        continue
                    found = (self.unknown, -1 - ord(piece))
                if best[begin] + found[0] > best[end]:
                    best[end], start[end], last[end] = best[begin] + found[0], begin, found[1]
        path, end = [], len(word)
        while end:
            path.append(last[end])
            end = start[end]
        return [i for v in reversed(path) for i in (self.spelled(chr(-1 - v)) if v < 0 else [v])]

    def word_ids(self, word: str | None) -> bytes:
        found = self.known.get(word)
        # a word that was too long to be asked for, or that went unasked, is folded here
        return np.array(self.fold(word), "<i4").tobytes() if found is None else found

    def segment_ids(self, segment: str) -> bytes:
        coded = b"".join(map(self.word_ids, self.cutter.cut(segment)))
        if len(self.coded) >= HELD_SEGMENTS:
            self.coded.clear()
        self.coded[segment] = coded
        return coded

    def encode(self, text: str) -> np.ndarray:
        known = self.coded.get
        parts = (known(s) or self.segment_ids(s) for s in self.cutter.segments(text))
        return np.frombuffer(b"".join(parts), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


def _encoder(shared, answers: str, common: str, digest: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assembler, block = Assembler(*shared.value), None
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            out = []
            for key, text in zip(batch["block"].to_pylist(), batch["text"], strict=True):
                if key != block:
                    block, said = key, [read_block(answers, key), read_table(common)]
                    said = [x.select(["word", "ids"]) for x in said if x is not None]
                    assembler.learn(pa.concat_tables(said) if said else None)
                text = text.as_py() or ""
                ids = assembler.encode(text)
                kept = zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids
                out.append((len(ids), kept, assembler.decode(ids) == text))
            names = [n for n in batch.schema.names if n not in ("text", "block")]
            ids = pa.array([x[1] for x in out], pa.int64() if digest else pa.list_(pa.int32()))
            columns = [pa.array([x[0] for x in out], pa.int64()), ids, pa.array([x[2] for x in out], pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), *columns],
                names=[*names, "n_pieces", "ids_crc32" if digest else "ids", "exact"],
            )

    return encode


def encode(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", digest: bool = False
) -> DataFrame:
    """``(key, n_pieces, ids, exact)`` for every row of ``docs``, a scan of files.

    ``exact`` says that decoding ``ids`` gave back the text. With ``digest``, ``ids`` are given
    as ``ids_crc32``, the unsigned checksum of little-endian 32-bit ids. Null text is empty and
    has no ids; repeated rows keep a row each; other columns are ignored; no documents, no rows.
    The piece table is broadcast: its size is the model's vocabulary.
    """
    spark, docs = docs.sparkSession, scanned(docs)
    pieces, byte_ids = read_pieces(model)
    longest, unknown = bounds(pieces)
    table = piece_frame(spark, pieces)
    kind = dict(docs.dtypes)[key]
    blocked = with_block(docs.select(F.col(key).alias("key"), F.col(text).alias("text")))
    with stage_scope(spark):
        with stage_scope(spark) as scope:
            asked = blocked.select("block", "text").mapInArrow(_asker, "block long, word string")
            words = asked_words(scope, stage_table(asked, "asked-words"))
        release(spark, [])
        parts = -(-words.count() // WORDS) or 1
        # A task's words fit the hash table of the aggregate; by default Spark sorts all edges
        # from the 128th word on, and spills them.
        with session_setting(spark, FALLBACK, str(4 * WORDS)):
            segmented = segment(words.select("word").repartition(parts, "word"), table, longest, unknown)
            segmented = stage_table(segmented, "segmented")
        release(spark, [])
        known = stage_table(words.join(segmented, "word"), "word-ids")
        release(spark, [])
        common = owned_folder(spark, "common-words")
        known.filter("blocks is null").select("word", "ids").write.parquet(common)
        rare = known.filter("blocks is not null").select(F.explode("blocks").alias("block"), "word", "ids")
        answers = write_by_block(rare, docs)
    shared = spark.sparkContext.broadcast((pieces, byte_ids))
    out = "ids_crc32 long" if digest else "ids array<int>"
    encoded = blocked.mapInArrow(_encoder(shared, answers, common, digest), f"key {kind}, n_pieces long, {out}, exact boolean")
    return encoded.withColumnRenamed("key", key)


def asked_words(scope: Scope, asked: DataFrame) -> DataFrame:
    """``(word, blocks)`` of the distinct words of ``asked(block, word)``.

    A word that more than half of the blocks ask for is ``common``, and its ``blocks`` are null:
    every block reads it. These are at most twice as many as a block's words are on average.
    """
    spark = asked.sparkSession
    n_blocks, n_rows = asked.agg(F.count_distinct("block"), F.count(F.lit(1))).first()
    with session_setting(spark, FALLBACK, str(4 * ASKED)):
        words = asked.repartition(-(-n_rows // ASKED) or 1, "word").groupBy("word").agg(F.collect_set("block").alias("blocks"))
        own = F.when(2 * F.size("blocks") <= n_blocks, F.col("blocks")).alias("blocks")
        return scope.keep(words.select("word", own), "distinct-words")


def piece_frame(spark: SparkSession, pieces: list[tuple[str, int, float]]) -> DataFrame:
    """The piece table as ``(piece, id, score)``."""
    return spark.createDataFrame(pieces, "piece string, id int, score double")


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with the ``text`` of its piece ids; null ids give null."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_pieces(model))

    @F.pandas_udf("string")
    def text(lists):
        import pandas as pd

        assembler = Assembler(*shared.value)
        return pd.Series([None if x is None else assembler.decode(np.asarray(x, np.int64)) for x in lists])

    return encoded.withColumn("text", text(ids))
