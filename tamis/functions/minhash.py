"""MinHash signatures as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The modulus that Spark ML's MinHash uses, and five (a, b) pairs
# of well-known linear congruential generators.
PRIME = 2038074743
COEFFICIENTS = (
    (1103515245, 12345),
    (69069, 907633385),
    (1664525, 1013904223),
    (22695477, 1),
    (134775813, 7),
)


def distinct_hashes(tokens: Column) -> Column:
    """One hash per distinct token: the first seven hex digits of its MD5.

    The value is below 2**28, and the same in any SQL engine. The digits are
    cast as a whole array, which is compiled code, unlike a cast in the lambda.
    """
    digits = F.transform(
        F.array_distinct(tokens), lambda t: F.conv(F.substring(F.md5(t), 1, 7), 16, 10)
    )
    return digits.cast("array<bigint>")


def minima(hashes: Column) -> list[Column]:
    """One minimum per hash function; NULL for a document without tokens.

    The products stay below 2**60, so they cannot overflow a bigint.
    """

    def minimum(a: int, b: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: ((h + 1) * a + b) % PRIME))

    return [minimum(a, b) for a, b in COEFFICIENTS]


def coefficient_pairs(n: int) -> list[tuple[int, int]]:
    """``n`` pairs (a, b) for further hash functions, from one congruential sequence."""
    pairs, x = [], 1
    for _ in range(n):
        a, b = x * 48271 % 2147483647, x * 48271 * 48271 % 2147483647
        x = b
        pairs.append((a % (PRIME - 1) + 1, b % PRIME))
    return pairs
