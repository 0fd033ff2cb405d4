"""Near-duplicate vectors: an exact range join in a metric space.

Cosine at least ``threshold`` is a Euclidean distance of unit vectors of at most
``sqrt(2 - 2 threshold)``. Pivots divide the vectors into cells, by nearest pivot. A vector
is also compared in another cell when the triangle inequality cannot rule out partners
there: its distance to that pivot is within the radius of the cell plus the range, and the
cell's border plane is within the range. Cells then join independently.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.unions import Labels
from tamis.operators.clusters import connected_components
from tamis.sources.staging import stage_table

THRESHOLD = 0.9
#: Vectors per cell aimed at, most pivots, and vectors on one side of a task.
CELL, MAX_PIVOTS, CHUNK = 4096, 4096, 4096
#: Cosines this close to the threshold are computed again without blocking.
CLOSE = 1e-9


def _packed(id_column: str, vector: str):
    """Vectors as bytes of doubles; null for those that link with nothing."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch[vector]:
                row = value.as_py() if value.is_valid else None
                array = np.array(row, np.float64) if row and None not in row else np.zeros(0)
                norm = np.sqrt(np.sum(array * array)) if len(array) and np.isfinite(array).all() else 0.0
                out.append(array.tobytes() if norm > 0 and np.isfinite(norm) else None)
            yield pa.RecordBatch.from_arrays([batch[id_column], pa.array(out, pa.binary())], names=["id", "vec"])

    return pack


def unit(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    return raw, raw / np.sqrt(np.sum(raw * raw, axis=1))[:, None]


def choose_pivots(rows: list[bytes], n: int) -> np.ndarray:
    """``n`` rows that lie far apart, each the farthest from those chosen before."""
    _, units = unit(rows)
    chosen, far = [0], np.full(len(units), np.inf)
    while len(chosen) < min(n, len(units)):
        far = np.minimum(far, 2 - 2 * units @ units[chosen[-1]])
        chosen.append(int(far.argmax()))
    return units[chosen]


def _distances(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * units @ pivots.T))


def _homes(shared):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = _distances(unit(batch["vec"].to_pylist())[1], shared.value)
                home = away.argmin(axis=1)
                new = [pa.array(home, pa.int32()), pa.array(away[np.arange(len(home)), home])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "cell", "away"])

    return place


def _guests(shared, radii: dict[int, float], reach: float):
    """Each vector in its own cell and in the later cells where partners may be."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        between = _distances(pivots, pivots)
        radius = np.array([radii.get(k, -np.inf) for k in range(len(pivots))])
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                away = _distances(unit(part["vec"].to_pylist())[1], pivots)
                home = part["cell"].to_numpy()
                own = away[np.arange(len(home)), home][:, None]
                visits = away <= radius + reach + CLOSE
                visits &= away**2 - own**2 <= 2 * reach * between[home] + CLOSE
                visits &= np.arange(len(pivots)) > home[:, None]
                row, cell = np.nonzero(visits)
                row, cell = np.concatenate((np.arange(len(home)), row)), np.concatenate((home, cell))
                guest = np.arange(len(row)) >= len(home)
                picked = [part[c].take(pa.array(row)) for c in ("node", "vec", "copies")]
                yield pa.RecordBatch.from_arrays(
                    [*picked, pa.array(cell, pa.int32()), pa.array(guest)], names=["node", "vec", "copies", "cell", "guest"]
                )

    return spread


def linked(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of two raw matrices have cosine at least ``threshold``, in doubles."""
    norms = [np.sqrt(np.sum(x * x, axis=1)) for x in (left, right)]
    cosine = (left / norms[0][:, None]) @ (right / norms[1][:, None]).T
    hit = cosine >= threshold
    for a, b in np.argwhere(np.abs(cosine - threshold) < CLOSE):
        hit[a, b] = np.sum(left[a] * right[b]) / (norms[0][a] * norms[1][b]) >= threshold
    return hit


def _compare(threshold: float):
    """Links of one task: counts per vector and a spanning forest, not pairs."""

    def compare(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        nodes, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        raw, _ = unit(table["vec"].to_pylist())
        one = np.flatnonzero(side == 0)
        two = np.flatnonzero(side == 1) if (side == 1).any() else None
        other = one if two is None else two
        links, labels = np.zeros(len(nodes), np.int64), Labels(len(nodes))
        for i in range(0, len(one), 512):
            rows = one[i : i + 512]
            hit = linked(raw[rows], raw[other], threshold)
            if two is None:
                hit[np.arange(len(rows)), np.arange(i, i + len(rows))] = False
            else:
                links[other] += copies[rows] @ hit
            links[rows] += hit @ copies[other]
            for a in np.flatnonzero(hit.any(axis=1)):
                labels.merge(np.append(other[hit[a]], rows[a]))
        rows, heads = labels.edges()
        counted = np.flatnonzero(links)
        return pa.table({
            "node": pa.array(np.concatenate((nodes[counted], nodes[rows]))),
            "links": pa.array([*links[counted].tolist(), *[None] * len(rows)], pa.int64()),
            "other": pa.array([*[None] * len(counted), *nodes[heads].tolist()], pa.int64()),
        })

    return compare


def _tasks(placed: DataFrame, chunk: int) -> DataFrame:
    """Rows under the tasks that compare them: chunks of a cell's homes with each other and with guests."""
    sizes = placed.groupBy("cell").agg(
        F.count_if(~F.col("guest")).alias("homes"), F.count_if(F.col("guest")).alias("guests")
    )  # a row per pivot at most
    chunks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / chunk)).cast("int")
    known = placed.join(F.broadcast(sizes), "cell").withColumns({"h": chunks("homes"), "g": chunks("guests")})
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("guest"), F.col("g")).otherwise(F.col("h"))).cast("int")
    task = lambda kind, a, b: F.concat_ws("/", F.lit(kind), "cell", a.cast("string"), b.cast("string"))
    entry = lambda kind, a, b, side: F.struct(task(kind, a, b).alias("task"), side.alias("side"))
    zero = F.lit(0)
    to_homes = F.transform(
        F.sequence(zero, F.col("h") - 1),
        lambda j: entry("hh", F.least(j, F.col("mine")), F.greatest(j, F.col("mine")), F.when(j < F.col("mine"), 1).otherwise(0)),
    )
    to_guests = F.transform(F.sequence(zero, F.col("g") - 1), lambda j: entry("hg", F.col("mine"), j, zero))
    to_guests = F.when(F.col("guests") > 0, to_guests).otherwise(F.array().cast("array<struct<task:string,side:int>>"))
    visits = F.transform(F.sequence(zero, F.col("h") - 1), lambda j: entry("hg", j, F.col("mine"), F.lit(1)))
    entries = F.when(F.col("guest"), visits).otherwise(F.concat(to_homes, to_guests))
    return known.withColumn("mine", mine).select(
        "node", "vec", "copies", F.explode(entries).alias("e")
    ).select("node", "vec", "copies", "e.task", "e.side")


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, cell: int = CELL,
    chunk: int = CHUNK,
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for every row of ``vectors``.

    Exact for every input. Equal vectors are compared once and count with their copies. A
    vector that is null, empty, zero or holds null or non-finite parts links with nothing, and
    so do vectors of different lengths. Repeated rows count as further vectors. A component of
    null keys only has a null id. Columns other than the two are ignored; no vectors, no rows.

    Pivots are picked from a sample of bounded size; their number grows with the input up to
    ``MAX_PIVOTS``. Vectors without structure at this range make every cell visit every other
    one, and the work is then that of comparing all blocks. No task holds more than two chunks.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[key]
    packed = vectors.select(key, vector).mapInArrow(_packed(key, vector), f"id {kind}, vec binary")
    packed = stage_table(packed.withColumn("size", F.length("vec")), "vectors")
    valid = packed.filter("vec is not null")
    reps = valid.groupBy("vec").agg(F.count(F.lit(1)).alias("copies"))
    reps = stage_table(reps.select(F.xxhash64("vec").alias("node"), "vec", "copies", F.length("vec").alias("size")), "reps")

    found = None
    reach = float(np.sqrt(2 - 2 * threshold))
    for size, n in reps.groupBy("size").count().orderBy("size").collect():  # one row per vector length
        same = reps.filter(F.col("size") == size)
        wanted = max(1, min(MAX_PIVOTS, -(-n // cell)))
        sample = same.select("vec").orderBy(F.xxhash64("vec", F.lit(1))).limit(min(4 * wanted, MAX_PIVOTS)).collect()
        shared = spark.sparkContext.broadcast(choose_pivots([bytes(r[0]) for r in sample], wanted))
        columns = "node long, vec binary, copies long"
        homes = same.select("node", "vec", "copies").mapInArrow(_homes(shared), f"{columns}, cell int, away double")
        homes = stage_table(homes, "homes")
        radii = {r[0]: r[1] for r in homes.groupBy("cell").agg(F.max("away")).collect()}  # a row per pivot
        placed = homes.mapInArrow(_guests(shared, radii, reach), f"{columns}, cell int, guest boolean")
        tasks = _tasks(stage_table(placed, "placed"), chunk)
        links = tasks.groupBy("task").applyInArrow(_compare(threshold), "node long, links long, other long")
        links = stage_table(links, "vector-links")
        found = links if found is None else found.unionByName(links)

    if found is None:
        return packed.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"),
                             F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    edges = found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    roots = connected_components(edges).select("node", "root")
    counts = found.filter("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    known = reps.select("node", "vec", "copies").join(counts, "node", "left").join(roots, "node", "left")
    known = known.select("vec", "copies", "links", F.coalesce("root", "node").alias("root"))
    member = stage_table(packed.join(stage_table(known, "vector-classes"), "vec", "left"), "vector-members")
    least = member.filter("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    result = member.join(stage_table(least, "vector-heads"), "root", "left")
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least"))
    n_links = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return result.select(
        F.col("id").alias(key), n_links.cast("long").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
