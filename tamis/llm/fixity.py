"""Merkle fixity audit of archived records.

A replica is a sequence of WARC records in key order. Trees are aligned by key: a leaf is all
records of one key, and a node above is a range of keys, so the trees of two replicas have the
same shape whatever either of them lost, gained or changed. A leaf's hash covers the hashes
and sizes of its records; a node's hash covers, in order, the offset ranges of its children
relative to its own start, and their hashes. Relative ranges leave untouched what lies behind
a lost record. Two replicas are compared from their roots, only branches that differ are
descended, and within differing keys records are compared by hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.sources.staging import stage_table

FANOUT = 256


def warc_records(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """``(key, record)``: each page as a WARC resource record. Null url, key and body are empty."""
    content = F.coalesce(F.col(body), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col(key).cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(F.col(url), F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(content).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return pages.select(F.col(key).alias("key"), F.concat(head, content, F.lit("\r\n\r\n")).alias("record"))


def placed_records(records: DataFrame) -> DataFrame:
    """``(code, key, hash, size, position, start, end)``: each record's place in its replica, stored.

    Records follow each other by key, null first, then hash. They are hashed once; then only
    keys, hashes and lengths are sorted. Places are prefix sums, within range partitions and
    over one row per partition. Equal rows fill one partition only if all are alike; they are
    divided by a number of their own. ``code`` is the key as a number: itself, or a hash of one
    that is no integer.
    """
    whole = dict(records.dtypes)["key"] in ("tinyint", "smallint", "int", "bigint")
    code = F.col("key").cast("long") if whole else F.xxhash64("key")
    hashed = records.select(
        F.when(F.col("key").isNotNull(), code).alias("code"), "key",
        F.octet_length("record").cast("long").alias("size"), F.sha2("record", 256).alias("hash"),
    ).withColumn("row", F.monotonically_increasing_id())
    hashed = stage_table(hashed, "fixity-hashed")
    order = ["key", "hash", "row"]
    placed = hashed.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    placed = stage_table(placed, "fixity-records")
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    local = placed.select("*", F.row_number().over(inside).alias("rank"), upto.alias("upto"))
    end = F.col("offset") + F.col("upto")
    return stage_table(
        local.join(F.broadcast(parts), "part").select(  # a row per partition
            "code", "key", "hash", "size", (F.col("first") + F.col("rank") - 1).alias("position"),
            (end - F.col("size")).alias("start"), end.alias("end"),
        ),
        "fixity-placed",
    )


def leaves(placed: DataFrame) -> DataFrame:
    """``(node, start, end, hash)`` of every key.

    The hash covers number and bytes of a key's records and the sums of the four quarters of
    their hashes, which are added up before the shuffle: a key may have any number of records.
    Null keys are one node.
    """
    quarter = lambda i: F.conv(F.substring("hash", 16 * i + 2, 15), 16, 10).cast("decimal(38,0)")
    sums = placed.groupBy("code").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"),
        *(F.sum(quarter(i)).alias(f"q{i}") for i in range(4)),
    )
    said = F.concat_ws(":", *(F.col(c).cast("string") for c in ("n", "bytes", "q0", "q1", "q2", "q3")))
    return stage_table(sums.select(F.col("code").alias("node"), "start", "end", F.sha2(said, 256).alias("hash")), "fixity-leaves")


def merkle_tree(leaf: DataFrame, height: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of ``(node, start, end, hash)`` from the keys up; the last has the root alone.

    ``height`` levels above the leaves each take ``fanout`` numbers together; the root takes
    what is left, null keys included. Null keys stay a node of their own below it.
    """
    levels = [leaf]
    for level in range(1, height + 2):
        above = F.floor(F.col("node") / F.lit(fanout)).alias("above") if level <= height else F.lit(0).cast("long").alias("above")
        child = F.struct("start", "end", "node", "hash")
        start = F.min("start")
        said = F.transform(
            F.sort_array(F.collect_list(child)),  # ``fanout`` at most, a few more at the root
            lambda c: F.struct(c["start"], c["end"], F.concat_ws(":", F.coalesce(c["node"].cast("string"), F.lit("")), c["hash"]).alias("said")),
        )
        known = levels[-1].groupBy(above).agg(start.alias("start"), F.max("end").alias("end"), said.alias("said"))
        relative = F.transform(
            "said",
            lambda c: F.concat_ws(":", (c["start"] - F.col("start")).cast("string"), (c["end"] - F.col("start")).cast("string"), c["said"]),
        )
        hashed = known.select(F.col("above").alias("node"), "start", "end", F.sha2(F.array_join(relative, ","), 256).alias("hash"))
        levels.append(stage_table(hashed, f"fixity-level-{level}"))
    return levels


def height_for(replicas: list[DataFrame], fanout: int) -> int:
    """Levels above the keys after which at most ``fanout`` nodes are left in any replica."""
    bounds = reduce(DataFrame.unionByName, [r.agg(F.min("code").alias("low"), F.max("code").alias("high")) for r in replicas])
    low, high = bounds.agg(F.min("low"), F.max("high")).first()
    height = 0
    while low is not None and high - low + 1 > fanout:
        low, high, height = low // fanout, high // fanout, height + 1
    return height


def damaged(left: list[DataFrame], right: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """``(node)`` of the keys whose leaves differ, or are in one replica only.

    From the root down, the two trees are compared below differing nodes only.
    """
    suspects = None
    for level in reversed(range(len(left))):
        one, two = left[level], right[level]
        if level + 2 == len(left) and suspects.isEmpty():
            return suspects.withColumnRenamed("above", "node")  # equal roots
        if level + 2 < len(left):  # all nodes below a differing root are suspect
            one, two = (
                t.join(suspects, F.floor(t["node"] / F.lit(fanout)).eqNullSafe(suspects["above"]), "left_semi") for t in (one, two)
            )
        said = F.struct((F.col("end") - F.col("start")).alias("size"), "hash")
        one, two = one.select("node", said.alias("one")), two.select(F.col("node").alias("other"), said.alias("two"))
        met = one.join(two, F.col("node").eqNullSafe(F.col("other")), "full").filter(~F.col("one").eqNullSafe(F.col("two")))
        node = F.when(F.col("one").isNull(), F.col("other")).otherwise(F.col("node"))
        differ = stage_table(met.select(node.alias("node")), f"fixity-differ-{level}")
        suspects = differ.select(F.col("node").alias("above"))
    return differ


def _joined(one: DataFrame, two: DataFrame, columns: list[str], how: str) -> DataFrame:
    """``one`` joined with the other columns of ``two`` where ``columns`` are equal, nulls included."""
    other = two.select(*(F.col(c).alias(f"_{c}") for c in columns), *(c for c in two.columns if c not in columns))
    met = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return one.join(other, met, how).drop(*(f"_{c}" for c in columns))


def unmatched(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """``mine`` with ``spare``: whether the other replica has no such record left for it, stored.

    Equal records of a replica are neighbours, so a record's number among them is its distance
    from the first; numbers come from aggregates, and a record may repeat any number of times.
    """
    same = ["code", "key", "hash"]
    first = mine.groupBy(*same).agg(F.min("position").alias("first"))
    there = theirs.groupBy(*same).agg(F.count(F.lit(1)).alias("there"))
    known = stage_table(_joined(first, there, same, "left"), "fixity-copies")
    spare = F.col("position") - F.col("first") >= F.coalesce("there", F.lit(0))
    return stage_table(_joined(mine, known, same, "inner").withColumn("spare", spare).drop("first", "there"), "fixity-matched")


def compare_records(one: DataFrame, two: DataFrame) -> DataFrame:
    """``(key, position, start, end, hash, state)`` of the records of differing keys.

    Records of equal hash are paired off. Of what is left of a key, in the order of hashes, as
    many as both replicas have are ``corrupt``, with the place and hash in the first; the rest
    is ``missing`` or ``extra``. Only keys that have more left here than there, and some there,
    need their records numbered.
    """
    ours, theirs = unmatched(one, two), unmatched(two, one)
    who = ["code", "key"]
    count = lambda t, name: t.filter("spare").groupBy(*who).agg(F.count(F.lit(1)).alias(name))
    left = stage_table(count(ours, "lost"), "fixity-lost")
    gone = stage_table(count(theirs, "gained"), "fixity-gained")
    order = Window.partitionBy(*who).orderBy("hash", "position")

    def judged(rows: DataFrame, mine: DataFrame, other: DataFrame, n: str, m: str, paired, alone) -> DataFrame:
        """The spare rows, ``paired`` up to the number of the other side's, then ``alone``."""
        known = _joined(mine, other, who, "left").withColumn(m, F.coalesce(m, F.lit(0)))
        known = stage_table(known, "fixity-balance")
        rows = _joined(rows.filter("spare"), known, who, "inner")
        some = (F.col(m) > 0) & (F.col(m) < F.col(n))
        counted = rows.filter(some).withColumn("turn", F.row_number().over(order))
        plain = rows.filter(~some).withColumn("turn", F.lit(1))
        return counted.unionByName(plain).withColumn("state", F.when(F.col("turn") <= F.col(m), paired).otherwise(alone))

    shown = ["key", "position", "start", "end", "hash", "state"]
    lost = judged(ours, left, gone, "lost", "gained", F.lit("corrupt"), F.lit("missing"))
    extra = judged(theirs, gone, left, "gained", "lost", F.lit(None), F.lit("extra")).filter("state is not null")
    intact = ours.filter("not spare").withColumn("state", F.lit("intact"))
    return reduce(DataFrame.unionByName, [t.select(*shown) for t in (intact, lost, extra)])


def audit(original: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``(key, position, start, end, hash, state)`` for every record of two replicas.

    Inputs are ``(key, record)``. ``state`` is intact, corrupt (the key's record in the replica
    has other bytes), missing (not in the replica) or extra (only in the replica, with its own
    place and hash). Intact records may lie elsewhere in the replica. Null keys are one key and
    come first; repeated records keep a row each; columns beside the two are ignored; empty
    replicas give the other side's rows or none.
    """
    ours, theirs = (placed_records(r.select("key", "record")) for r in (original, replica))
    height = height_for([ours, theirs], fanout)
    trees = [merkle_tree(leaves(placed), height, fanout) for placed in (ours, theirs)]
    differ = damaged(*trees, fanout)
    near = lambda t, how: t.join(differ, t["code"].eqNullSafe(differ["node"]), how)
    clear = near(ours, "left_anti").select("key", "position", "start", "end", "hash", F.lit("intact").alias("state"))
    suspect = [stage_table(near(t, "left_semi"), "fixity-suspects") for t in (ours, theirs)]
    return clear.unionByName(compare_records(*suspect))
