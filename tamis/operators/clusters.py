"""Clusters of near-duplicates and the deduplication they give."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.operators.similar import MAX_DISTANCE, leaders_of_sets, links_between, token_sets
from tamis.sources.catalogue import stored_once
from tamis.sources.staging import stage_scope, stage_table, stored_result


def _fingerprint(edges: DataFrame) -> tuple:
    """One row that changes when the edge set changes."""
    return tuple(
        edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u")))
        .first()
    )


@stored_result("components")
def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node.

    Alternating large-star and small-star steps (Kiveris et al., SoCC 2014):
    about log(n) rounds even for long chains. Minima are pre-aggregated and
    stored before they are joined back: both sides of these joins then come from
    plain shuffles, and adaptive execution can split the edges of a hub. Every
    round is stored, which also keeps the plan short, and removes what it staged
    on the way; the edges of the round before go with the last of all.
    """
    current = stage_table(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges-0",
    )
    before, turn = _fingerprint(current), 0
    while True:
        turn += 1
        with stage_scope(edges.sparkSession) as scope:
            both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
            low = stage_table(low, f"large-low-{turn}")
            large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = stage_table(large.distinct(), f"large-star-{turn}")

            low = stage_table(large.groupBy("u").agg(F.min("v").alias("m")), f"small-low-{turn}")
            hooked = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            small = hooked.unionByName(low.withColumnRenamed("m", "v"))
            current = scope.keep(small.distinct(), f"small-star-{turn}")

        after = _fingerprint(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def dedupe_clusters(docs: DataFrame, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """``(id, cluster_id)`` for every document ``(id, tokens)``, stored once.

    Clusters are the connected components of the near-duplicate relation, so
    chains are merged; ``cluster_id`` is the smallest id. A document without
    tokens is a cluster of its own.
    """
    grouped = token_sets(docs)

    def make() -> DataFrame:
        edges = leaders_of_sets(grouped, max_distance)
        reps = grouped.sets.select("rep", "set_key")
        # Leaders make groups; the similar sets that they left in unlike groups join these.
        groups = connected_components(edges.filter("a <> b").select("a", "b"))
        roots = reps.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        roots = stage_table(roots.select("rep", F.coalesce("root", "rep").alias("root")), "roots")
        links = links_between(grouped.sets, roots, max_distance)
        joined = groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)
        named = connected_components(joined).withColumnRenamed("node", "rep")
        named = reps.join(named, "rep", "left").select("set_key", F.coalesce("root", "rep").alias("cluster_id"))
        # Stored, so that the join can split a set that many documents have.
        joined = grouped.documents.join(stage_table(named, "set-clusters"), "set_key").select("id", "cluster_id")
        return joined.unionByName(grouped.bare.withColumn("cluster_id", F.col("id")))

    return stored_once(docs, f"clusters-{max_distance}", make)


def keep_cluster_heads(records: DataFrame, clusters: DataFrame) -> DataFrame:
    """One record per cluster: drop those that are not their cluster's smallest id."""
    dropped = clusters.filter(F.col("id") != F.col("cluster_id")).select("id")
    return records.join(dropped, "id", "left_anti")


def cluster_summary(clusters: DataFrame) -> DataFrame:
    """Documents, clusters of two or more, their members, and survivors."""
    sizes = clusters.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("n_docs"),
        F.count_if(F.col("n") > 1).alias("n_clusters"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_clustered"),
        F.count(F.lit(1)).alias("n_kept"),
    )
