"""Near-duplicate search: documents whose token sets have Jaccard distance <= 0.1.

Two steps. Banded MinHash finds leaders: a set has ``BANDS`` band values of ``ROWS`` minima each;
for every band value there is one edge per set, to the smallest id of that value, its leader, and
the exact Jaccard distance decides. So there are at most ``BANDS`` comparisons per set, whatever
the corpus looks like. Leaders bring groups together cheaply, but not all similar sets: a pair
below the leader of all its bands is found through the leader or not at all.

What leaders miss is found by parts of the sets, of which similar sets have one in common by the
pigeonhole principle, not by chance: ``all_pairs`` lists every similar pair, and clusters look for
links between the groups that leaders made. The exact Jaccard distance decides here too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.functions import minhash
from tamis.sources.catalogue import stored_once
from tamis.sources.rows import PLACE, pick_rows
from tamis.sources.staging import stage_scope, stage_table

# Fixed value: largest Jaccard distance of near-duplicates.
MAX_DISTANCE = 0.1

BANDS, ROWS = 20, 5
EPSILON = 1e-9


#: Of the band minima of two sets, so many agree in their last byte, or the sets are not compared.
#: A pair at the greatest distance, 0.1, misses that about once in 10**10 times.
AGREEING = 65


@dataclass(frozen=True)
class TokenSets:
    """Stored tables: ``documents(id, set_key)``, ``sets(rep, set_key, hashes, words)``, ``bare(id)``.

    ``sets`` has the place of its rows too, so those of a set are found without a shuffle.
    """

    documents: DataFrame
    sets: DataFrame
    bare: DataFrame


def token_sets(docs: DataFrame) -> TokenSets:
    """Collapse documents ``(id, tokens)`` to their distinct token sets.

    ``rep`` is the smallest id of a set, null only where no member has an id. Documents without tokens are similar to nothing; they
    are listed as ``bare``. Sets are compared by ``words``, 64-bit token hashes, and signed by
    ``hashes``, which any SQL engine can compute. The texts are read once, in a narrow pass;
    to find the sets, only keys, ids and places are shuffled, and the arrays of the
    representatives are picked where they lie.
    """
    words = docs.select("id", F.sort_array(F.array_distinct("tokens")).alias("words"))
    hashed = words.select(
        "id",
        F.md5(F.array_join("words", " ")).alias("set_key"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("words"),
        minhash.distinct_hashes(F.col("words")).alias("hashes"),
    )
    signed = stored_once(hashed, "token-sets", sharded=True)
    documents = signed.filter(F.size("words") > 0)
    bare = signed.filter(F.coalesce(F.size("words"), F.lit(0)) == 0).select("id")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", *PLACE)).alias("first")
    reps = stored_once(signed, "set-reps", lambda: documents.groupBy("set_key").agg(first).select("first.*"))
    sets = pick_rows(signed, reps).withColumnRenamed("id", "rep")
    return TokenSets(documents.select("id", "set_key"), sets, bare)


def band_minima(sets: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(rep, size, m0, m1, ...)``: the minima of each set, aggregated in the task that reads it.

    A set's rows are unfolded and folded again under its place, which the stored table is
    divided by: plain aggregates over a hash table, and no exchange.
    """
    pairs = minhash.coefficient_pairs(bands * rows)
    exploded = sets.select(*PLACE, "rep", F.size("words").alias("size"), F.explode("hashes").alias("h"))
    minima = [F.min(((F.col("h") + 1) * a + b) % minhash.PRIME).alias(f"m{i}") for i, (a, b) in enumerate(pairs)]
    return exploded.groupBy(*PLACE, "rep", "size").agg(*minima).drop(*PLACE)


def signed_sets(sets: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(rep, size, sketch, bands)``, stored: the last byte of each minimum, and the band values.

    A band value is a hash of the band's number and its minima.
    """
    names = [f"m{i}" for i in range(bands * rows)]
    values = [F.xxhash64(F.lit(k), *names[k * rows : (k + 1) * rows]) for k in range(bands)]
    sketch = F.array(*(F.col(m).bitwiseAND(255).cast("short") for m in names))
    signed = band_minima(sets, bands, rows).select("rep", "size", sketch.alias("sketch"), F.array(*values).alias("bands"))
    return stage_table(signed, "bands")


def leader_edges(signed: DataFrame) -> DataFrame:
    """``(a, b)``: each set ``b`` with the leaders ``a`` of its bands, itself where it leads.

    The leaders are stored before they are joined back, so that both sides of that join come
    from plain shuffles and adaptive execution can split a band held by many sets.
    """
    banded = signed.select("rep", F.explode("bands").alias("band"))
    leaders = stage_table(banded.groupBy("band").agg(F.min("rep").alias("a")), "band-leaders")
    return banded.join(leaders, "band").select("a", F.col("rep").alias("b")).distinct()


def likely_pairs(pairs: DataFrame, signed: DataFrame, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sizes and sketches allow the distance.

    Sets of distance d have sizes of a ratio of at least 1 - d, and about a share of 1 - d of
    their minima agree. Most pairs are ruled out by these few bytes per set.
    """
    side = lambda name, n, sketch: signed.select(F.col("rep").alias(name), F.col("size").alias(n), F.col("sketch").alias(sketch))
    both = pairs.join(side("a", "_n", "_x"), "a").join(side("b", "_m", "_y"), "b")
    sized = F.least("_n", "_m") >= F.greatest("_n", "_m") * (1 - max_distance) - EPSILON
    alike = F.size(F.filter(F.zip_with("_x", "_y", lambda x, y: x == y), lambda same: same))
    # The same odds for other distances, by standard deviations of the number that agree.
    n, p = BANDS * ROWS, 1 - max_distance
    spread = (n * 0.9 * 0.1) ** 0.5
    needed = n * p - (n * 0.9 - AGREEING) / spread * max((n * p * (1 - p)) ** 0.5, spread)
    return both.filter(sized & (alike >= needed)).select("a", "b")


def with_distance(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b, distance)``: the exact Jaccard distance of sets named by their representatives."""
    left = sets.select(F.col("rep").alias("a"), F.col("words").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("words").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    distance = 1 - common / (F.size("x") + F.size("y") - common)
    return pairs.join(left, "a").join(right, "b").select("a", "b", distance.alias("distance"))


def similar_sets(sets: DataFrame, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """Verified leader edges ``(a, b, distance)``, stored; a set that leads itself has distance 0."""
    with stage_scope(sets.sparkSession) as scope:
        signed = signed_sets(sets)
        edges = stage_table(leader_edges(signed), "leader-edges")
        own = edges.filter("a = b").withColumn("distance", F.lit(0.0))
        likely = stage_table(likely_pairs(edges.filter("a <> b"), signed, max_distance), "likely-pairs")
        measured = with_distance(likely, sets).filter(F.col("distance") <= max_distance + EPSILON)
        return scope.keep(own.unionByName(measured), "similar-sets")


def part_keys(sets: DataFrame, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """``(rep, size, side, keys)``, stored: similar sets have a key in common, without exception.

    The words of a set are dealt to parts by a hash of the word. Similar sets differ in so few
    words that with one part more than these, some part is the same in both; a key is the hash
    of a part and its words. The number of parts goes by a level of the size: the sizes of similar
    sets are on one level or on neighbours, so a set has keys for its level (side 0) and, to meet
    smaller sets, for the level below (side 1). Some parts are to spare, so that the parts which
    are the same cannot all be empty, unless the set has more empty ones than that; then it has a
    key for this too. All is aggregated in the task that reads the set, as the minima are.
    """
    least = max(1 - max_distance - 1e-6, 1e-6)  # a little less, so that rounding loses nothing
    step, share = 1 / least, (1 - least) / (1 + least)
    level = F.floor(F.log(F.size("words").cast("double")) / math.log(step))
    sides = F.array(*(F.struct(F.lit(side).alias("side"), (level - side).alias("level")) for side in (0, 1)))
    most = F.pow(F.lit(step), F.col("level") + 1) + F.pow(F.lit(step), F.col("level") + 2)
    split = sets.select(*PLACE, "rep", F.size("words").alias("size"), "words", F.inline(sides))
    split = split.withColumn("differing", F.floor(share * most + 1e-6)).filter("differing > 0")
    split = split.withColumn("spare", F.floor((F.col("differing") + 1) / 8))
    split = split.withColumn("parts", F.col("differing") + 1 + F.col("spare"))
    of_set = [*PLACE, "rep", "size", "side", "level", "spare", "parts"]
    dealt = split.select(*of_set, F.explode("words").alias("w")).withColumn("part", F.pmod(F.xxhash64("w"), F.col("parts")))
    hashed = dealt.groupBy(*of_set, "part").agg(F.bit_xor("w").alias("value"))
    keys = hashed.groupBy(*of_set).agg(F.collect_list(F.xxhash64("level", "part", "value")).alias("keys"))
    empty = F.array(F.xxhash64("level", F.lit("empty")))
    many = F.col("parts") - F.size("keys") > F.col("spare")
    keys = keys.withColumn("keys", F.when(many, F.concat("keys", empty)).otherwise(F.col("keys")))
    return stage_table(keys.select("rep", "size", "side", "keys"), "part-keys")


def candidates(keyed: DataFrame, roots: DataFrame | None = None, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """``(a, b)``, a before b: the sets with a common key whose sizes allow the distance, each pair once.

    With ``roots(rep, root)``, only sets of unlike roots are paired.
    """
    held = keyed.select("rep", "size", "side", F.explode("keys").alias("key"))
    held = held.withColumn("root", F.col("rep")) if roots is None else held.join(roots, "rep")
    kinds = F.min("root").alias("low"), F.max("root").alias("high"), F.min("side").alias("side")
    shared = held.groupBy("key").agg(*kinds).filter("low <> high and side = 0").select("key")
    # Stored, so that the joins below read plain tables and adaptive execution can split a key of many sets.
    held = stage_table(held.join(stage_table(shared, "shared-keys"), "key"), "key-holders")
    side = lambda a, n, root, s: held.select("key", F.col("rep").alias(a), F.col("size").alias(n), F.col("root").alias(root), F.col("side").alias(s))
    left, right = side("x", "_n", "_r", "_s").filter("_s = 0"), side("y", "_m", "_q", "_t")
    sized = F.least("_n", "_m") >= F.greatest("_n", "_m") * (1 - max_distance) - EPSILON
    once = F.expr("_t = 1 or x < y")
    if roots is None:
        met = left.join(right, "key").filter(sized & once)
    else:
        # The roots of a key are paired first: of a large group of one root no two sets meet.
        groups = stage_table(held.select("key", "root").distinct(), "key-roots")
        unlike = groups.withColumnRenamed("root", "_r").join(groups.withColumnRenamed("root", "_q"), "key").filter("_r <> _q")
        met = stage_table(unlike, "unlike-roots").join(left, ["key", "_r"]).join(right, ["key", "_q"]).filter(sized & once)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def with_close_distance(pairs: DataFrame, sets: DataFrame, homes: DataFrame) -> DataFrame:
    """``with_distance`` for sets of one home, ``homes(rep, home)``; of a set only its difference to the home moves.

    Words that neither set lacks of the home are common, and so are those that both have beside it.
    """
    words = sets.select("rep", "words")
    of_home = words.select(F.col("rep").alias("home"), F.col("words").alias("h"))
    differing = words.join(homes, "rep").join(of_home, "home").select(
        "rep", F.size("words").alias("n"), F.size("h").alias("of_home"),
        F.array_except("words", "h").alias("more"), F.array_except("h", "words").alias("less"),
    )
    differing = stage_table(differing, "differences")
    left = differing.select(F.col("rep").alias("a"), F.col("n").alias("x"), F.col("more").alias("p"), F.col("less").alias("q"), "of_home")
    right = differing.select(F.col("rep").alias("b"), F.col("n").alias("y"), F.col("more").alias("r"), F.col("less").alias("s"))
    common = F.col("of_home") - F.size(F.array_union("q", "s")) + F.size(F.array_intersect("p", "r"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    return both.select("a", "b", (1 - F.col("common") / (F.col("x") + F.col("y") - F.col("common"))).alias("distance"))


def all_similar_sets(sets: DataFrame, edges: DataFrame, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """``(a, b, distance)``, a before b: all pairs of sets within the distance, each once, stored.

    ``edges`` are the verified leader edges: a set's home is the first of its leaders, and members
    of a group are compared by their differences to it.
    """
    with stage_scope(sets.sparkSession) as scope:
        pairs = stage_table(candidates(part_keys(sets, max_distance), None, max_distance), "candidates")
        homes = stage_table(edges.groupBy(F.col("b").alias("rep")).agg(F.min("a").alias("home")), "homes")
        own = lambda name: homes.select(F.col("rep").alias(name), F.col("home").alias(f"home_{name}"))
        at_home = pairs.join(own("a"), "a", "left").join(own("b"), "b", "left")
        at_home = stage_table(at_home.withColumn("one", F.coalesce(F.expr("home_a = home_b"), F.lit(False))), "pairs-at-home")
        near = with_close_distance(at_home.filter("one").select("a", "b"), sets, homes)
        far = with_distance(at_home.filter("not one").select("a", "b"), sets)
        found = near.unionByName(far).filter(F.col("distance") <= max_distance + EPSILON)
        return scope.keep(found, "all-similar-sets")


def links_between(sets: DataFrame, roots: DataFrame, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """``(a, b)``: all similar sets of unlike ``roots(rep, root)``, stored."""
    with stage_scope(sets.sparkSession) as scope:
        pairs = stage_table(candidates(part_keys(sets, max_distance), roots, max_distance), "candidates")
        found = with_distance(pairs, sets).filter(F.col("distance") <= max_distance + EPSILON)
        return scope.keep(found.select("a", "b"), "links-between")


def near_dup_pairs(docs: DataFrame, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """``(id_a, id_b, distance)``: each document with those leaders of its bands that are similar.

    A short form of the relation, from which clusters start; ``all_pairs`` has every pair.
    """
    grouped = token_sets(docs)
    edges = leaders_of_sets(grouped, max_distance)
    pairs = grouped.documents.join(edges, "set_key").filter("a <> id")
    return pairs.select(F.col("a").alias("id_a"), F.col("id").alias("id_b"), "distance")


def all_pairs(docs: DataFrame, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """``(id_a, id_b, distance)``, ``id_a`` before ``id_b``: every pair of documents within the distance.

    Copies are paired as well, so the list grows with the square of a group of copies. The pairs of
    different sets are found and stored once; their documents come in by joins that are not stored.
    """
    grouped = token_sets(docs)
    sets, documents = grouped.sets, grouped.documents

    def make() -> DataFrame:
        found = all_similar_sets(sets, leaders_of_sets(grouped, max_distance), max_distance)
        key = lambda name: sets.select(F.col("rep").alias(name), F.col("set_key").alias(f"key_{name}"))
        return found.join(key("a"), "a").join(key("b"), "b").select("key_a", "key_b", "distance")

    pairs = stored_once(documents, f"all-pairs-{max_distance}", make)
    member = lambda key, name: documents.select(F.col("set_key").alias(key), F.col("id").alias(name))
    copies = member("set_key", "x").join(member("set_key", "y"), "set_key").filter("x < y")
    copies = copies.select(F.col("x").alias("id_a"), F.col("y").alias("id_b"), F.lit(0.0).alias("distance"))
    met = pairs.join(member("key_a", "x"), "key_a").join(member("key_b", "y"), "key_b").filter("x <> y")
    return copies.unionByName(met.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "distance"))


def leaders_of_sets(grouped: TokenSets, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """``(set_key, a, b, distance)``: the verified leader edges with the key of the led set, stored once."""

    def make() -> DataFrame:
        edges = similar_sets(grouped.sets, max_distance)
        return edges.join(grouped.sets.select(F.col("rep").alias("b"), "set_key"), "b")

    return stored_once(grouped.documents, f"similar-sets-{max_distance}", make)
