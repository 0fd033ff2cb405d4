"""Stage 2: one record per MinHash signature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions import minhash
from tamis.functions.tokens import tokenize
from tamis.sources.catalogue import stored_once
from tamis.sources.rows import PLACE, first_rows_of, pick_rows

SIGNATURE = [f"m{i}" for i in range(len(minhash.COEFFICIENTS))]

# Buckets of the hashed term frequencies and number of hash tables.
TERM_BUCKETS = 1 << 16
HASH_TABLES = 5


def with_signature(df: DataFrame, tokens: Column | None = None) -> DataFrame:
    """Append ``m0 .. m4``; all NULL for a record without tokens.

    Each minimum is taken inside the row, so signing a corpus needs no shuffle.
    """
    if tokens is None:
        tokens = tokenize(F.col("main_text"))
    hashed = df.withColumn("_hashes", minhash.distinct_hashes(tokens))
    named = dict(zip(SIGNATURE, minhash.minima(F.col("_hashes")), strict=True))
    return hashed.withColumns(named).drop("_hashes")


def minhash_signature(records: DataFrame) -> DataFrame:
    return with_signature(records).select("id", *SIGNATURE)


def keep_smallest(df: DataFrame, keys: list[str | Column], columns: list[str]) -> DataFrame:
    """One record per key: the one with the smallest leading column.

    Duplicates are dropped before the shuffle as well as after it, so a group
    of copies of any size sends at most one record per map task.
    """
    grouped = df.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_kept"))
    return grouped.select("_kept.*")


def keep_signed(signed: DataFrame, payload: list[str]) -> DataFrame:
    """``payload`` of the record with the smallest leading column of every signature.

    ``signed`` comes from ``with_signature``. Only the payload is shuffled, so it should not hold
    the text. A record without tokens has no signature and is always kept.
    """
    lone = F.when(F.col(SIGNATURE[0]).isNull(), F.col(payload[0]))
    return keep_smallest(signed, [*SIGNATURE, lone.alias("_lone")], payload)


def signed_rows(records: DataFrame) -> DataFrame:
    """``records`` with signature and lengths, stored in one narrow pass.

    All that asks for survivors, their lengths or their texts reads this table. Of a corpus
    that was signed before in this application, the stored rows are used again.
    """
    tokens = tokenize(F.col("main_text"))
    measured = with_signature(records, tokens).withColumns({
        "_text_length": F.length("main_text"),
        "_token_count": F.size(tokens),
    })
    return stored_once(measured, "signed", sharded=True)


def survivors(signed: DataFrame) -> DataFrame:
    """``id``, place and lengths of the record with the smallest ``id`` of every signature, stored."""
    narrow = ["id", *PLACE, "_text_length", "_token_count"]
    return stored_once(signed, "survivors", lambda: keep_signed(signed, narrow))


def dedupe_signature(records: DataFrame) -> DataFrame:
    """Keep the record with the smallest ``id`` of every five-value signature.

    Signatures and ids decide; the rows that stay are then filtered where they are read.
    """
    signed = signed_rows(records)
    return pick_rows(signed, survivors(signed)).select(*records.columns)


def first_survivors(records: DataFrame, n: int) -> DataFrame:
    """The ``n`` records with the smallest ids that ``dedupe_signature`` keeps."""
    signed = signed_rows(records)
    return first_rows_of(signed, survivors(signed), "id", n).select(*records.columns)


def dedupe_lengths(records: DataFrame) -> DataFrame:
    """``id, text_length, token_count`` of the records that ``dedupe_signature`` keeps."""
    kept = survivors(signed_rows(records))
    return kept.select("id", F.col("_text_length").alias("text_length"), F.col("_token_count").alias("token_count"))


def dedupe_ids(records: DataFrame) -> DataFrame:
    """``id`` of the records that ``dedupe_signature`` keeps."""
    return survivors(signed_rows(records)).select("id")


def hashing_tf(records: DataFrame, buckets: int = TERM_BUCKETS) -> DataFrame:
    """Spark ML's hashed term frequencies, as column ``features``."""
    from pyspark.ml.feature import HashingTF

    # Filtered by the text: a filter on the tokens would make them, and clean the text for each mention, again.
    words = records.filter("main_text IS NOT NULL").withColumn("words", tokenize(F.col("main_text")))
    return HashingTF(inputCol="words", outputCol="features", numFeatures=buckets).transform(words)


def hashing_tf_summary(records: DataFrame, buckets: int = TERM_BUCKETS) -> DataFrame:
    """Buckets in use and total term frequency of each document."""
    sparse = F.unwrap_udt("features")
    return hashing_tf(records, buckets).select(
        "id",
        F.size(sparse["indices"]).alias("n_buckets"),
        F.aggregate(sparse["values"], F.lit(0.0), lambda total, tf: total + tf)
        .cast("bigint")
        .alias("total_tf"),
    )


def minhash_ml(records: DataFrame, seed: int = 42, tables: int = HASH_TABLES) -> DataFrame:
    """Signatures of Spark ML's ``MinHashLSH``: ``id`` and one column per table.

    The seed is always given, because the default one changes from one Python
    process to the next. Documents without tokens, which ``MinHashLSH`` rejects, are signed in the
    same pass with a stand-in and get NULL signatures. Signatures depend on which buckets are in
    use, not on how often, so every token is hashed once a document.
    """
    from pyspark.ml.feature import HashingTF, MinHashLSH

    words = records.filter("main_text IS NOT NULL").select("id", tokenize(F.col("main_text")).alias("words"))
    known = F.size("words") > 0
    distinct = F.when(known, F.array_distinct("words")).otherwise(F.array(F.lit("")))
    words = words.select("id", known.alias("_known"), distinct.alias("words"))
    features = HashingTF(inputCol="words", outputCol="features", numFeatures=TERM_BUCKETS).transform(words)
    lsh = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=tables, seed=seed)
    hashed = lsh.fit(features).transform(features)
    minimum = lambda i: F.unwrap_udt(F.element_at("hashes", i + 1))["values"][0].cast("bigint")
    return hashed.select("id", *(F.when(F.col("_known"), minimum(i)).alias(f"m{i}") for i in range(tables)))


def dedupe_signature_ml(records: DataFrame, seed: int = 42) -> DataFrame:
    """Smallest ``id`` per Spark ML signature."""
    signed = minhash_ml(records, seed)
    keys = [c for c in signed.columns if c != "id"]
    lone = F.when(F.col(keys[0]).isNull(), F.col("id"))
    return keep_smallest(signed, [*keys, lone.alias("_lone")], ["id"])
