"""Hard negatives: for anchor and positive, the best rows of other labels within a score band.

Scores are integer inner products, computed in the manner of the Four Russians. The dimensions
go in groups of eight. For an anchor, a table per group holds the sums of all 256 subsets of
its components there. A candidate's components are cut into bit planes, and the eight bits of
a plane and group, packed into a byte, are an index into that group's table. A score is then
shifts and additions of looked-up sums, with no multiplication: exact, in two's complement.

Anchors, a stated part of all rows, are compared with all rows in blocks: a task has one block
of anchors and one of candidates and returns the best few per anchor. A first round finds the
positives, whose scores set the bands of the second.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.sources.staging import stage_table

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: Least and greatest score of a negative, in percent of the positive's.
BAND = (50, 95)
#: Anchors and candidates of one task.
ANCHORS, CANDIDATES = 8192, 16384
#: Bound on the squared greatest component times the dimensions; scores below it fit 64 bits.
LARGEST = 1 << 60


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of 32-bit integers; rows that take no part are left out."""
    for batch in batches:
        out = []
        for value in batch["vector"]:  # null components come out as NaN
            array = value.values.to_numpy(zero_copy_only=False) if value.is_valid else np.zeros(0)
            array = np.floor(SCALE * array.astype(np.float64))
            fits = len(array) and np.isfinite(array).all() and np.abs(array).max() ** 2 * len(array) < LARGEST
            out.append(array.astype("<i4").tobytes() if fits else None)
        codes = pa.array(out, pa.binary())
        kept = codes.is_valid()
        columns = [batch[c].filter(kept) for c in ("id", "label", "anchor")]
        yield pa.RecordBatch.from_arrays([*columns, codes.filter(kept)], names=["id", "label", "anchor", "codes"])


def planes(codes: np.ndarray) -> np.ndarray:
    """Packed bit planes ``[plane, group, row]`` of integer rows; the last plane is the sign.

    The dimensions are filled up with zeros to a multiple of eight.
    """
    rows, dims = codes.shape
    codes = np.pad(codes.astype(np.int64), ((0, 0), (0, -dims % 8)))
    size = int(max(codes.max(initial=0), ~codes.min(initial=0)))
    bits = [(codes >> b) & 1 for b in range(size.bit_length() + 1)]
    packed = [np.packbits(bit.astype(np.uint8), axis=1, bitorder="little") for bit in bits]
    return np.ascontiguousarray(np.stack(packed).transpose(0, 2, 1))


def subset_sums(anchor: np.ndarray) -> np.ndarray:
    """``[group, 256]``: the sum of each subset of eight components, doubled up bit by bit."""
    parts = np.pad(anchor.astype(np.int64), (0, -len(anchor) % 8)).reshape(-1, 8)
    sums = np.zeros((len(parts), 1), np.int64)
    for k in range(8):
        sums = np.concatenate((sums, sums + parts[:, k : k + 1]), axis=1)
    return sums


def scores(sums: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """The exact inner product of one anchor with every candidate, from the sign plane down."""
    top = len(packed) - 1
    total = np.zeros(packed.shape[2], sums.dtype)
    for plane in range(top, -1, -1):
        total <<= 1
        for group in range(len(sums)):
            looked = sums[group].take(packed[plane, group])
            total = total - looked if plane == top else total + looked
    return total


def _best(score: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of ``among`` with the highest score; of equals the earlier."""
    own = score[among]
    if len(own) > k:
        least = np.partition(own, -k)[-k]
        among, own = among[own >= least], own[own >= least]
    return among[np.argsort(-own, kind="stable")[:k]]


FOUND = "anchor long, positive long, positive_score long, row long, id long, score long"


def _compare(k: int, band: tuple[int, int] | None):
    """One task: its anchors against its candidates.

    Without a band the best ``k`` of the anchor's label; with one, for each positive of the
    anchor the best ``k`` of other labels.
    """

    def compare(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        order = np.lexsort((table["row"].to_numpy(), table["id"].to_numpy(), side))
        table, side = table.take(pa.array(order)), side[order]
        first = table.slice(0, int((side == 0).sum()))
        second = table.slice(first.num_rows)
        if not first.num_rows or not second.num_rows:
            return pa.table([pa.array([], pa.int64())] * 6, names=[c.split()[0] for c in FOUND.split(", ")])
        matrix = lambda t: np.frombuffer(b"".join(t["codes"].to_pylist()), "<i4").reshape(t.num_rows, -1)
        anchors, codes = matrix(first), matrix(second)
        packed = planes(codes)
        row, ids, labels = (second[c].to_numpy() for c in ("row", "id", "label"))
        of_label = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
        none = np.zeros(0, np.int64)
        bound = int(np.abs(anchors.astype(np.int64)).sum(axis=1).max()) << len(packed)
        kind = np.int32 if bound < 1 << 31 else np.int64
        out: list[tuple] = []
        wanted = first["positives"].to_pylist()
        for i, (label, own) in enumerate(zip(first["label"].to_pylist(), first["row"].to_pylist(), strict=True)):
            score = scores(subset_sums(anchors[i]).astype(kind), packed)
            if band is None:
                alike = of_label.get(label, none)
                for j in _best(score, alike[row[alike] != own], k).tolist():
                    out.append((own, None, None, int(row[j]), int(ids[j]), int(score[j])))
                continue
            other = np.flatnonzero(labels != label)
            theirs = score[other].astype(np.int64) * 100
            for positive in wanted[i]:
                inside = (theirs >= band[0] * positive["score"]) & (theirs <= band[1] * positive["score"])
                for j in _best(score, other[inside], k).tolist():
                    out.append((own, positive["row"], positive["score"], int(row[j]), int(ids[j]), int(score[j])))
        columns = list(zip(*out, strict=True)) or [()] * 6
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in FOUND.split(", ")])

    return compare


def _blocks(n: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("int")


def _round(anchors: DataFrame, rows: DataFrame, sizes: DataFrame, compare, blocks: tuple[int, int]) -> DataFrame:
    """``compare`` over all pairs of a block of anchors and a block of rows of equal length."""
    sizes = F.broadcast(  # a row per vector length
        sizes.select(
            "dims", _blocks(F.col("n_anchors"), blocks[0]).alias("a"), _blocks(F.col("n_rows"), blocks[1]).alias("c")
        )
    )
    mine = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    none = F.array().cast("array<struct<row:long,score:long>>")
    columns = ["dims", "x", "y", "side", "row", "id", "label", "codes", "positives"]
    left = anchors.join(sizes, "dims").withColumns({"x": mine("a"), "side": F.lit(0)}).withColumn("y", every("c"))
    right = rows.join(sizes, "dims").withColumns({"y": mine("c"), "side": F.lit(1), "positives": none}).withColumn("x", every("a"))
    both = left.select(columns).unionByName(right.select(columns))
    return both.groupBy("dims", "x", "y").applyInArrow(compare, FOUND)


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"), F.asc("row"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine_negatives(
    vectors: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND,
    blocks: tuple[int, int] = (ANCHORS, CANDIDATES),
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Each component becomes ``floor(256 * component)``; scores are inner products, higher first,
    ties by the smaller key. An anchor's positives are its best other rows of the same label.
    For each, the negatives are the best rows of other labels whose score is within the band, in
    percent of the positive's. ``is_anchor`` is a condition on the columns of ``vectors``.

    Rows without key, label or vector take no part, nor do vectors with a null or non-finite
    component, empty ones, and ones so large that 64 bits might not hold a score (beyond 2**19
    for 64 components). Vectors are compared with those of their own length. Repeated rows count
    as further rows, also as anchors, each of which gives its own result. Columns other than
    the three, and those of the condition, are ignored. No vectors or no anchors give no rows.
    """
    chosen = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col(vector).alias("vector"),
    ).filter("id is not null and label is not null")
    coded = chosen.mapInArrow(_codes, "id long, label long, anchor boolean, codes binary")
    coded = coded.withColumns({"row": F.monotonically_increasing_id(), "dims": F.length("codes")})
    rows = stage_table(coded, "codes")
    sizes = rows.groupBy("dims").agg(F.count_if("anchor").alias("n_anchors"), F.count(F.lit(1)).alias("n_rows"))
    sizes = stage_table(sizes.filter("n_anchors > 0"), "code-sizes")

    anchors = rows.filter("anchor")
    nothing = F.array().cast("array<struct<row:long,score:long>>")
    found = _round(anchors.withColumn("positives", nothing), rows, sizes, _compare(positives, None), blocks)
    found = stage_table(_ranked(found, ["anchor"], positives).select("anchor", "row", "id", "score"), "positives")
    listed = found.groupBy("anchor").agg(F.collect_list(F.struct("row", "score")).alias("positives"))  # a few each
    armed = anchors.join(listed.withColumnRenamed("anchor", "row"), "row")

    hard = _round(armed, rows, sizes, _compare(negatives, band), blocks)
    hard = _ranked(hard, ["anchor", "positive"], negatives)
    named = found.select("anchor", F.col("row").alias("positive"), F.col("id").alias("positive_id"))
    anchored = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return hard.join(named, ["anchor", "positive"]).join(anchored, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
