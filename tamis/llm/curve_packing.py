"""Packing of documents into sequences along a space-filling curve.

Each document's tokens are hashed into a vector of fixed length, which a fixed random matrix
projects to a few dimensions. The place of that point on a Hilbert curve orders the documents:
neighbours on the curve have similar tokens. The order is a range sort, and sequences are cut
from the tokens in that order, so that a sequence holds neighbours.

Token positions along the whole curve come from one sum per range partition, so sequences run
on across partitions and nothing is padded: the rest at the end is cut into powers of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.records import Encoder, kept
from tamis.llm.wording import mixed
from tamis.sources.staging import stage_table

END_ID, LENGTH = 1, 2048
#: Parts of a hashed document vector, dimensions of its projection, and bits of each on the curve.
BUCKETS, DIMS, BITS = 512, 4, 15
#: Tokens and documents whose vectors are hashed at once.
PORTION, GROUP = 1 << 17, 256

POINT = [f"v{k}" for k in range(DIMS)]


def projection() -> np.ndarray:
    """The fixed matrix from hashed vectors to a few dimensions, normally distributed."""
    return np.random.default_rng(12).normal(size=(BUCKETS, DIMS))


def hashed_points(ids: list[np.ndarray], matrix: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The projections of documents, given as token ids.

    A token adds to one bucket with a sign, both by hash; a document's vector holds logarithms
    of the bucket sums' sizes, at unit length. No tokens give the zero vector. ``slots`` has the
    bucket of each id, or its complement where the sign is negative.
    """
    sizes = np.array([len(x) for x in ids])
    slot = slots[np.concatenate(ids)]
    negative = slot < 0
    place = np.repeat(np.arange(len(ids)) * 2 * BUCKETS, sizes) + np.where(negative, ~slot + BUCKETS, slot)
    counts = np.bincount(place, minlength=len(ids) * 2 * BUCKETS).reshape(len(ids), 2, BUCKETS)
    sums = counts[:, 0] - counts[:, 1]
    vectors = np.sign(sums) * np.log1p(np.abs(sums))
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return (vectors / np.where(norm > 0, norm, 1)) @ matrix


def token_slots(size: int) -> np.ndarray:
    codes = mixed(np.arange(1, size + 1, dtype=np.uint64))
    slot = (codes % np.uint64(BUCKETS)).astype(np.int32)
    return np.where(codes >> np.uint64(63), slot, ~slot)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The index along the Hilbert curve of rows of coordinates below ``2**bits``.

    By Skilling (2004): the coordinates are turned into the transposed index in place, from
    the highest bit down, then Gray-decoded and interleaved.
    """
    x = [cells[:, k].astype(np.int64) for k in range(cells.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for k in range(len(x)):
            flip = (x[k] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[k] = x[k] ^ swap if k else x[0]
        q >>= 1
    for k in range(1, len(x)):
        x[k] = x[k] ^ x[k - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where(x[-1] & q, turn ^ (q - 1), turn)
        q >>= 1
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for part in x:
            index = index << 1 | ((part ^ turn) >> b & 1)
    return index


def _encoded(tokenizer: str, end_id: int):
    """Documents as ids of two or four bytes with the end id, and their points."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(f"encoder {tokenizer}", lambda: Encoder(tokenizer))
        end = np.array([end_id], encoder.kind).tobytes()
        matrix, slots = projection(), token_slots(encoder.tokenizer.get_vocab_size())

        def points(held: list[bytes]) -> np.ndarray:
            return hashed_points([np.frombuffer(x, encoder.kind)[:-1] for x in held], matrix, slots)

        for batch in batches:
            done, size, held = 0, 0, []
            for i, ids in enumerate(encoder.encode_all(batch["text"])):
                held.append(ids + end)
                size += len(held[-1]) // encoder.width
                if size >= PORTION or len(held) == GROUP or i + 1 == batch.num_rows:
                    where = points(held)
                    columns = [batch["key"].slice(done, len(held)), pa.array(held, pa.binary())]
                    columns.append(pa.array([len(x) // encoder.width for x in held], pa.int64()))
                    columns += [pa.array(where[:, k]) for k in range(DIMS)]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "ids", "n", *POINT])
                    done, size, held = i + 1, 0, []

    return encode


def borders(total: int, length: int) -> tuple[int, list[int]]:
    """Tokens in whole sequences, and where the sequences of the rest end: at powers of two."""
    whole, ends = total - total % length, []
    at, rest = whole, total % length
    while rest:
        step = 1 << (rest.bit_length() - 1)
        at, rest = at + step, rest - step
        ends.append(at)
    return whole, ends


def sequences(length: int, whole: int, ends: list[int]):
    """The sequences that the tokens from ``begin`` on lie in, as structs ``(sequence, first, last)``."""
    begin, stop = F.col("begin"), F.col("begin") + F.col("n")
    entry = "array<struct<sequence:long,first:long,last:long>>"
    number = lambda at: F.floor(at / length)
    full = F.transform(
        F.sequence(number(begin), number(F.least(stop, F.lit(whole)) - 1)),
        lambda k: F.struct(k.alias("sequence"), (k * length).alias("first"), ((k + 1) * length).alias("last")),
    )
    rest = [
        F.struct(*(F.lit(x).cast("long").alias(c) for c, x in (("sequence", whole // length + i), ("first", a), ("last", b))))
        for i, (a, b) in enumerate(zip([whole, *ends], ends, strict=False))
    ]
    met = F.filter(F.array(*rest).cast(entry), lambda s: (s["first"] < stop) & (s["last"] > begin))
    return F.concat(F.when(begin < whole, full.cast(entry)).otherwise(F.array().cast(entry)), met)


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID, length: int = LENGTH
) -> DataFrame:
    """``(key, doc_tokens, sequence_id, offset, start, length, ids)`` of every piece.

    A document is its ids and ``end_id``; ``ids`` are those of the piece as little-endian
    integers of two bytes, or four where the vocabulary needs them. The pieces of a sequence lie
    side by side from offset 0; all sequences have ``length`` ids but for the last ones, whose
    lengths are falling powers of two, so no sequence needs padding.

    Documents are ordered by Hilbert key, then key and a hash of the text. A null text is
    empty and has the end id only; a null key stays null; repeated rows are packed each; texts
    of any length are cut as often as needed. No documents give no rows. Other columns are
    ignored. The point's mean and spread are those of all documents.
    """
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    floats = ", ".join(f"{v} double" for v in POINT)
    coded = stage_table(rows.mapInArrow(_encoded(tokenizer, end_id), f"key {kind}, ids binary, n long, {floats}"), "encoded")
    moments = [f(v).alias(f"{f.__name__}_{v}") for v in POINT for f in (F.avg, F.stddev_pop)]
    known = coded.agg(*moments).first()  # one row
    scale = [(known[f"avg_{v}"] or 0.0, known[f"stddev_pop_{v}"] or 1.0) for v in POINT]

    @F.pandas_udf("long")
    def on_curve(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for point in parts:
            cells = (np.stack(point, axis=1) - [m for m, _ in scale]) / [s for _, s in scale]
            # The logistic curve is near that of a normal distribution: cells get about equal shares.
            cells = np.floor((1 << BITS) / (1 + np.exp(-1.702 * cells))).clip(0, (1 << BITS) - 1)
            yield pd.Series(hilbert(cells, BITS))

    @F.pandas_udf("long")
    def before(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at = 0  # tokens of the rows before, in this task
        for n in parts:
            upto = at + n.cumsum()
            yield upto - n
            at = int(upto.iloc[-1]) if len(n) else at

    placed = coded.select("key", "ids", "n", on_curve(*POINT).alias("curve"))
    # Copies share a place on the curve; the hash divides them among partitions.
    order = ["curve", F.xxhash64("key"), "key", F.xxhash64("ids")]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stage_table(ordered.select("key", "ids", "n", F.spark_partition_id().alias("part"), before("n").alias("at")), "along-curve")

    sums = ordered.groupBy("part").agg(F.sum("n").alias("tokens"))  # a row per partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage_table(sums.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))), "tokens-before")
    whole, ends = borders(sums.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0], length)
    begun = ordered.join(F.broadcast(sums), "part").withColumn("begin", F.col("base") + F.col("at"))
    piece = begun.select("key", "ids", "n", "begin", F.explode(sequences(length, whole, ends)).alias("s"))
    first, last = F.greatest("begin", "s.first"), F.least(F.col("begin") + F.col("n"), F.col("s.last"))
    width = (F.length("ids") / F.col("n")).cast("int")
    start, size = first - F.col("begin"), last - first
    return piece.select(
        F.col("key").alias(key), F.col("n").alias("doc_tokens"), F.col("s.sequence").alias("sequence_id"),
        (first - F.col("s.first")).alias("offset"), start.alias("start"), size.alias("length"),
        F.substr("ids", (start * width + 1).cast("int"), (size * width).cast("int")).alias("ids"),
    )


def checksums(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``ids_crc32`` of their ids as four-byte integers instead of the ids."""
    kinds = dict(pieces.dtypes)
    others = [c for c in pieces.columns if c != "ids"]

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [
                zlib.crc32(np.frombuffer(data, f"<u{len(data) // n}").astype("<u4").tobytes())
                for data, n in zip(batch["ids"].to_pylist(), batch["length"].to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), pa.array(sums, pa.int64())], names=[*others, "ids_crc32"])

    return pieces.mapInArrow(sum_up, ", ".join(f"`{c}` {kinds[c]}" for c in others) + ", ids_crc32 long")
