"""Near-duplicate texts: a chosen-path join of sets of word shingles.

Every text is a set of shingles with a sketch of ``SKETCH`` min-hashes. In each of ``RUNS``
runs the sets descend a tree: a node samples coordinates of the sketch, on average
``CHILDREN`` of them, and sends a set to the child named by its min-hash there, so that sets
meet in proportion to their similarity. Nodes of up to ``SMALL`` sets, and all nodes at depth
``DEPTH``, are compared by brute force, on sketches; runs are repeated until the recall is
reached. What meets so is a candidate group. Within each group all sets are compared exactly,
in blocks, so every link is counted once however often its sets met.

A pair of Jaccard similarity 0.8 meets in a run with probability 0.8 at the first and 0.64 at
the second level; eight runs miss three in 10,000 at the second level.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.blockwise import by_block, read_block, scanned, with_block, without_rows, write_by_block
from tamis.llm.unions import Labels
from tamis.llm.wording import Shingler
from tamis.operators.clusters import connected_components
from tamis.sources.staging import stage_table

WORDS, THRESHOLD = 5, 0.8
RUNS, CHILDREN, DEPTH, SMALL = 8, 2, 2, 512
SKETCH = 64
#: Agreeing coordinates from which sketches count as candidates, and from which a set's
#: partners are sure to be candidates of the other as well (triangle inequality).
ALIKE, CLOSE = 38, 58
#: Rows on one side of a task.
CHUNK, EXACT_CHUNK = 8192, 2048

SIGNED = "key {kind}, row long, block long, set long, sketch array<int>, short binary"


class Sketcher:
    """One-permutation min-hashes, empty bins filled from full ones by fixed probes."""

    def __init__(self):
        self.edges = np.arange(SKETCH, dtype=np.uint64) << np.uint64(58)
        self.probes = np.random.default_rng(1).integers(0, SKETCH, (SKETCH, 256))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(hashes, self.edges), len(hashes) - 1)
        least = hashes[at]
        full = (least >> np.uint64(58)) == (self.edges >> np.uint64(58))
        values = (least & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        if not full.all():
            empty = np.flatnonzero(~full)
            found = full[self.probes[empty]]
            source = np.where(found.any(axis=1), self.probes[empty, found.argmax(axis=1)], np.flatnonzero(full)[0])
            values[empty] = values[source]
        return values


def _signer(words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sketcher = Shingler(words), Sketcher()
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            texts = [t.as_py() for t in batch["text"].cast(pa.binary())]
            sets, sketches, shorts = [], [], []
            for hashes in shingler.sets(texts):
                if len(hashes):
                    sketch = sketcher.of(hashes)
                    sets.append(xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63))
                    sketches.append(sketch.view(np.int32))
                    shorts.append((sketch & 0xFF).astype(np.uint8).tobytes())
                else:
                    sets.append(None)
                    sketches.append(None)
                    shorts.append(None)
            columns = [pa.array(sets, pa.int64()), pa.array(sketches, pa.list_(pa.int32())), pa.array(shorts, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["row"], batch["block"], *columns], names=["key", "row", "block", "set", "sketch", "short"]
            )

    return sign


def _roots(seed: int, runs: int) -> list[tuple[int, int]]:
    """The coordinates that each run's root samples."""
    rng = random.Random(seed)
    return [(run, i) for run in range(runs) for i in range(SKETCH) if rng.random() < CHILDREN / SKETCH]


def _sampled(path: Column) -> Column:
    """The coordinates that an inner node samples, by a hash of its path."""
    return F.filter(
        F.sequence(F.lit(0), F.lit(SKETCH - 1)),
        lambda i: F.pmod(F.xxhash64(path, i), F.lit(SKETCH // CHILDREN)) == 0,
    )


def meeting_nodes(reps: DataFrame, runs: int, seed: int) -> DataFrame:
    """``(path, n, set)``: the nodes that are compared by brute force, stored."""
    paths = [F.xxhash64(F.lit(run), F.lit(i), F.col("sketch")[i]) for run, i in _roots(seed, runs)]
    nodes = stage_table(reps.select("set", F.explode(F.array(*paths)).alias("path")), "tree-1")
    leaves = None
    for depth in range(1, DEPTH + 1):
        sizes = nodes.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        met = stage_table(nodes.join(stage_table(sizes, "tree-sizes"), "path"), f"tree-met-{depth}")
        last = met if depth == DEPTH else met.filter(F.col("n") <= SMALL)
        leaves = last if leaves is None else leaves.unionByName(last)
        if depth < DEPTH:
            inner = met.filter(F.col("n") > SMALL).join(reps.select("set", "sketch"), "set")
            child = F.transform(_sampled(F.col("path")), lambda i: F.xxhash64("path", i, F.get("sketch", i)))
            nodes = stage_table(inner.select("set", F.explode(child).alias("path")), f"tree-{depth + 1}")
    return leaves


def tasks_for(rows: DataFrame, group: str, size: str, member: str, chunk: int) -> DataFrame:
    """``rows`` under the ``task`` that compares them, with ``side`` 0 or 1.

    Groups of up to ``chunk`` rows share tasks of about that many rows. Larger groups are cut
    into chunks, and every two chunks make a task. No task holds more than about two chunks.
    """
    total = rows.filter(F.col(size) <= chunk).count()
    shared = F.concat_ws("/", F.lit("s"), F.pmod(F.xxhash64(group), F.lit(max(1, -(-total // chunk)))).cast("string"))
    n = F.greatest(F.lit(1), F.ceil(F.col(size) / chunk)).cast("int")
    mine = F.pmod(F.xxhash64(member), n).cast("int")

    def entry(j: Column) -> Column:
        pair = F.concat_ws("/", F.lit("p"), F.col(group).cast("string"), F.least(j, mine).cast("string"),
                           F.greatest(j, mine).cast("string"))
        return F.struct(pair.alias("task"), (j < mine).cast("int").alias("side"))

    paired = F.transform(F.sequence(F.lit(0), n - 1), entry)
    alone = F.array(F.struct(shared.alias("task"), F.lit(0).alias("side")))
    return rows.select("*", F.inline(F.when(n == 1, alone).otherwise(paired)))


def alike(shorts: np.ndarray) -> Labels:
    """Rows joined where their sketches agree in ``ALIKE`` coordinates or more.

    A row is settled once it, or a row close to it, was compared with all. It ends when all
    rows that are not settled are in one set already.
    """
    n = len(shorts)
    labels = Labels(n)
    if n <= 48:
        hit = (shorts[:, None, :] == shorts[None, :, :]).sum(axis=2) >= ALIKE
        for a in np.flatnonzero(hit.sum(axis=1) > 1):
            labels.merge(np.flatnonzero(hit[a]))
        return labels
    settled = np.zeros(n, bool)
    largest = -1
    while True:
        waiting = np.flatnonzero(~settled & (labels.of != largest))
        if not len(waiting):
            return labels
        agree = (shorts == shorts[waiting[0]]).sum(axis=1)
        settled[waiting[0]] = True
        settled |= agree >= CLOSE
        labels.merge(np.flatnonzero(agree >= ALIKE))
        if labels.members:
            largest = max(labels.members, key=lambda k: len(labels.members[k]))


def _edges(sets: np.ndarray, group: np.ndarray, labels_of) -> list[tuple[np.ndarray, np.ndarray]]:
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    out = []
    for rows in np.split(order, cuts):
        a, b = labels_of(rows).edges()
        out.append((sets[rows[a]], sets[rows[b]]))
    return out


def _meet(table: pa.Table) -> pa.Table:
    """Candidate edges of one task: a spanning forest of what is alike in each node."""
    sets, path = table["set"].to_numpy(), table["path"].to_numpy()
    shorts = np.frombuffer(b"".join(table["short"].to_pylist()), np.uint8).reshape(len(sets), -1)
    found = _edges(sets, path, lambda rows: alike(shorts[rows]))
    return pa.table({"a": np.concatenate([a for a, _ in found]), "b": np.concatenate([b for _, b in found])})


def similar(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets of two lists have a Jaccard similarity of at least ``threshold``; exact.

    Common elements are counted by products of membership matrices, a block of elements at
    a time; elements of one set only are left out.
    """
    sizes = [np.array([len(s) for s in side]) for side in (left, right)]
    elements = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    new = np.concatenate(([True], elements[1:] != elements[:-1]))
    column = np.cumsum(new) - 1
    common = np.bincount(column)[column] > 1
    owner, column = owner[common], column[common]
    column = np.cumsum(np.concatenate(([False], column[1:] != column[:-1]))) if len(column) else column
    both = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (start, start + width))
        block = np.zeros((len(left) + len(right), min(width, int(column[b - 1]) - start + 1)), np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        both += block[: len(left)] @ block[len(left) :].T
    either = sizes[0][:, None] + sizes[1][None, :] - both.astype(np.float64)
    return both / either >= threshold


def _compare(words: int, threshold: float):
    """Links of one task: counts per set and a spanning forest, not pairs."""

    def compare(table: pa.Table) -> pa.Table:
        shingles = Shingler(words).sets(table["text"].cast(pa.binary()).to_pylist())
        sets, copies, group = (table[c].to_numpy() for c in ("set", "copies", "comp"))
        side = table["side"].to_numpy()
        links = np.zeros(len(sets), np.int64)

        def labels_of(rows: np.ndarray) -> Labels:
            labels, one = Labels(len(rows)), np.flatnonzero(side[rows] == 0)
            two = np.flatnonzero(side[rows] == 1)
            other = two if len(two) else one
            if not len(one):
                return labels
            hit = similar([shingles[r] for r in rows[one]], [shingles[r] for r in rows[other]], threshold)
            if len(two):
                links[rows[two]] += copies[rows[one]] @ hit
            else:
                np.fill_diagonal(hit, False)
            links[rows[one]] += hit @ copies[rows[other]]
            for a in np.flatnonzero(hit.any(axis=1)):
                labels.merge(np.append(other[hit[a]], one[a]))
            return labels

        pairs = table["task"][0].as_py().startswith("p/")
        found = _edges(sets, np.zeros(len(sets), int) if pairs else group, labels_of)
        counted = np.flatnonzero(links)
        a, b = (np.concatenate([x[i] for x in found]) for i in (0, 1))
        return pa.table({
            "set": pa.array(np.concatenate((sets[counted], a))),
            "links": pa.array([*links[counted].tolist(), *[None] * len(a)], pa.int64()),
            "other": pa.array([*[None] * len(counted), *b.tolist()], pa.int64()),
        })

    return compare


def _picker(path: str):
    """The texts of the candidate sets, each once, from the block that is to give it."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["set", "comp", "n", "copies"]
        block, wanted = None, {}
        for key, part in by_block(batches):
            if key != block:
                block, table = key, read_block(path, key)
                rows = table.select(["row", *names]).to_pylist() if table is not None else []
                wanted = {r.pop("row"): r for r in rows}
            at = np.flatnonzero(np.isin(part["row"].to_numpy(), np.fromiter(wanted, np.int64, len(wanted))))
            found = [(i, wanted.pop(r)) for i in at.tolist() if (r := part["row"][i].as_py()) in wanted]
            if found:
                columns = [pa.array([f[n] for _, f in found], pa.int64()) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, part["text"].take(pa.array([i for i, _ in found]))], names=[*names, "text"])

    return pick


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
    runs: int = RUNS, seed: int = 1,
) -> DataFrame:
    """``(key, row, block, class_id, n_links)`` for every row of ``docs``, a scan of files.

    ``n_links`` counts the other rows whose texts have at least ``threshold`` of their shingles
    in common, ``class_id`` is the smallest key reachable by links. Rows of equal shingles are
    one set and compared once; they count with their copies. A null, empty or word-less text
    links with nothing and is its own class; a class of null keys has a null id. ``row`` is a
    hash of key and text, shared by repeated rows, ``block`` the part of a file it is from. Other columns are ignored; no documents, no
    rows. Links are exact where found; a pair of the threshold's similarity is missed with a
    small probability (see above), identical sets never.
    """
    docs = scanned(docs)
    rows = with_block(docs.select(F.col(key).alias("key"), F.xxhash64(key, text).alias("row"), F.col(text).alias("text")))
    kind = dict(rows.dtypes)["key"]
    signed = stage_table(rows.mapInArrow(_signer(words), SIGNED.format(kind=kind)), "signed")
    reps = signed.filter("set is not null").groupBy("set").agg(
        F.min(F.struct("row", "block", "sketch", "short")).alias("r"), F.count(F.lit(1)).alias("copies")
    )
    reps = stage_table(reps.select("set", "copies", "r.*"), "sets")

    met = meeting_nodes(reps, runs, seed).join(reps.select("set", "short"), "set")
    met = stage_table(tasks_for(met, "path", "n", "set", CHUNK).select("task", "path", "set", "short"), "nodes")
    candidates = stage_table(met.groupBy("task").applyInArrow(_meet, "a long, b long"), "candidates")
    groups = stage_table(connected_components(candidates.distinct()), "candidate-groups")

    sizes = stage_table(groups.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "candidate-sizes")
    members = groups.join(sizes, "root").select(F.col("node").alias("set"), F.col("root").alias("comp"), "n")
    path = write_by_block(members.join(reps.select("set", "row", "block", "copies"), "set"), docs)
    texts = rows.select("row", "block", "text").mapInArrow(_picker(path), "set long, comp long, n long, copies long, text string")
    tasks = tasks_for(stage_table(texts, "candidate-texts"), "comp", "n", "set", EXACT_CHUNK)
    links = tasks.select("task", "side", "comp", "set", "copies", "text").groupBy("task")
    links = stage_table(links.applyInArrow(_compare(words, threshold), "set long, links long, other long"), "links")

    edges = links.filter("other is not null").select(F.col("set").alias("a"), F.col("other").alias("b"))
    roots = connected_components(edges).withColumnRenamed("node", "set")
    counts = links.filter("links is not null").groupBy("set").agg(F.sum("links").alias("links"))
    known = reps.select("set", "copies").join(counts, "set", "left").join(roots, "set", "left")
    known = stage_table(known.select("set", "copies", "links", F.coalesce("root", "set").alias("root")), "classes")
    member = stage_table(signed.select("key", "row", "block", "set").join(known, "set", "left"), "class-members")
    heads = member.filter("root is not null").groupBy("root").agg(F.min("key").alias("head"))
    result = member.join(stage_table(heads, "class-heads"), "root", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return result.select(
        F.col("key").alias(key), "row", "block", F.when(F.col("root").isNull(), F.col("key")).otherwise(F.col("head")).alias("class_id"),
        n_links.cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest key; all columns kept.

    ``docs`` is a scan of files. Of rows that repeat that key within the class one stays,
    whichever text sorts first by hash.
    """
    docs = scanned(docs)
    found = stage_table(near_duplicates(docs, key, text, **options).filter("n_links > 0"), "linked")
    place = F.struct("row", "block")
    heads = found.filter(F.col(key).eqNullSafe(F.col("class_id"))).groupBy("class_id").agg(F.min(place).alias("head"))
    heads = stage_table(heads.select("head.*").withColumn("once", F.lit(True)), "heads")
    rows = found.select("block", "row").distinct().join(heads, ["row", "block"], "left")
    return without_rows(docs, key, text, rows.withColumn("once", F.coalesce("once", F.lit(False))))
