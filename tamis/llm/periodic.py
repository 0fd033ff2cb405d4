"""Periodic runs of words in documents, found by block convolution.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends. At
each dyadic scale ``b`` the words are cut into aligned blocks of ``b``. A run of period ``q``
in ``[b, 2b)`` and length ``3q`` holds a whole block that occurs again ``q`` words later, so
each block is looked for in the words that follow it, at all distances of its scale at once:
the sum of squared differences of word numbers is a convolution, computed by an exact number
theoretic transform, and is zero where the block occurs. Each zero seeds an extension.

The least scale has blocks of 8 words and takes all distances below 16; runs are of 24 words
at least, which the same argument covers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, POWER = 24, 3
BASE = 8
#: A prime 15 * 2**27 + 1 and a generator of its multiplicative group.
PRIME, GENERATOR = 2013265921, 31
#: Characters of the texts taken at once, and numbers transformed at once.
PORTION, CELLS = 1 << 20, 1 << 18
MODULUS = np.uint64(PRIME)


@cache
def _roots(size: int, inverse: bool) -> np.ndarray:
    """The first half of the powers of a root of unity of order ``size``."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    powers = [1]
    for _ in range(size // 2 - 1):
        powers.append(powers[-1] * root % PRIME)
    return np.array(powers, np.uint64)


def transform(rows: np.ndarray) -> np.ndarray:
    """The transform of every row, in bit-reversed order; a row's length is a power of two."""
    m, n = rows.shape
    half = n // 2
    while half:
        pairs = rows.reshape(m, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack(((low + high) % MODULUS, (low + MODULUS - high) * _roots(2 * half, False) % MODULUS), axis=2)
        half //= 2
    return rows.reshape(m, n)


def inverse(rows: np.ndarray) -> np.ndarray:
    """Rows whose transform, in bit-reversed order, is given."""
    m, n = rows.shape
    half = 1
    while half < n:
        pairs = rows.reshape(m, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1] * _roots(2 * half, True) % MODULUS
        rows = np.stack(((low + high) % MODULUS, (low + MODULUS - high) % MODULUS), axis=2)
        half *= 2
    return rows.reshape(m, n) * np.uint64(pow(n, -1, PRIME)) % MODULUS


def occurrences(words: np.ndarray, starts: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """``(start, distance)`` of each block of ``size`` words that occurs again ``distance`` later.

    ``words`` are numbers below 2**31, followed by ``3 * size`` others at least. Distances run from
    ``least`` up to ``2 * size - 1``. The sum of squared differences is taken modulo a prime; one
    that is a multiple of it without being zero passes for zero, so callers compare the words.
    """
    span = 2 * size - least
    n = 1 << (span + size - 2).bit_length()
    found: list[np.ndarray] = []
    for i in range(0, len(starts), max(1, CELLS // n)):
        x = starts[i : i + max(1, CELLS // n)]
        block = words[x[:, None] + np.arange(size)].astype(np.uint64)
        follow = words[x[:, None] + least + np.arange(span + size - 1)].astype(np.uint64)
        reversed_ = np.zeros((len(x), n), np.uint64)
        reversed_[:, -np.arange(size) % n] = block
        padded = np.zeros((len(x), n), np.uint64)
        padded[:, : follow.shape[1]] = follow
        product = inverse(transform(reversed_) * transform(padded) % MODULUS)[:, :span]
        squares = np.zeros((len(x), follow.shape[1] + 1), np.uint64)
        np.cumsum(follow * follow % MODULUS, axis=1, out=squares[:, 1:])
        own = (block * block % MODULUS).sum(axis=1)[:, None]
        theirs = squares[:, size:] - squares[:, :-size]
        row, at = np.nonzero((own + theirs) % MODULUS == 2 * product % MODULUS)
        found.append(np.stack((x[row], at + least)))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return pairs[0], pairs[1]


class Extender:
    """How far a stretch goes on repeating at a distance, for many places at once.

    Lengths come from polynomial prefix sums modulo a prime in two bases and a binary search.
    Equal stretches always agree; that others agree is possible, if unlikely, so the few
    stretches that are long enough for a run are compared word by word.
    """

    BASES = (1000003, 998244353)

    def __init__(self, words: np.ndarray):
        self.words, n = words, len(words)
        self.powers, self.sums = [], []
        for base in self.BASES:
            powers = np.ones(1, np.uint64)
            while len(powers) <= n:
                powers = np.concatenate((powers, powers * np.uint64(pow(base, len(powers), PRIME)) % MODULUS))
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((words.astype(np.uint64) + np.uint64(1)) * powers[:n] % MODULUS, out=sums[1:])
            self.powers.append(powers)
            self.sums.append(sums % MODULUS)

    def equal(self, at: np.ndarray, length: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Whether the words ``[at, at + length)`` equal those ``distance`` later, collisions aside."""
        alike = np.ones(len(at), bool)
        for powers, sums in zip(self.powers, self.sums, strict=True):
            here = (sums[at + length] + MODULUS - sums[at]) % MODULUS * powers[distance] % MODULUS
            alike &= here == (sums[at + distance + length] + MODULUS - sums[at + distance]) % MODULUS
        return alike

    def reach(self, at: np.ndarray, distance: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """Words from ``at`` on, or before it, up to ``limit``, that equal those ``distance`` later."""
        low, high = np.zeros(len(at), np.int64), limit.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            alike = self.equal(at - middle if back else at, middle, distance)
            low, high = np.where(alike, middle, low), np.where(alike, high, middle - 1)
        return low

    def exactly(self, at: int, distance: int) -> tuple[int, int]:
        """Begin and end of the stretch around ``at``, by comparing all words."""
        differ = np.flatnonzero(self.words[:-distance] != self.words[distance:])
        k = int(np.searchsorted(differ, at))
        begin = int(differ[k - 1]) + 1 if k else 0
        return begin, (int(differ[k]) if k < len(differ) else len(self.words) - distance) + distance

    def stretches(self, at: np.ndarray, distance: np.ndarray, size: int) -> list[tuple[int, int, int]]:
        """Distinct ``(distance, begin, end)``, long enough for a run, around blocks that occur again."""
        right = self.reach(at, distance, len(self.words) - distance - at, False)
        at, distance, right = (x[right >= size] for x in (at, distance, right))
        left = self.reach(at, distance, at, True)
        whole = left + right + distance
        long = whole >= np.maximum(LEAST, POWER * distance)
        found = np.stack((distance, at - left, at + right + distance))[:, long]
        found, first = np.unique(found, axis=1, return_index=True)
        out = set()
        for (d, begin, end), block in zip(found.T.tolist(), at[long][first].tolist(), strict=True):
            if not (self.words[begin : end - d] == self.words[begin + d : end]).all():
                begin, end = self.exactly(block, d)
            if end - begin >= max(LEAST, POWER * d):
                out.add((d, begin, end))
        return sorted(out)


def runs_of(words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of documents laid end to end in ``words``.

    Document ``k`` is ``words[bounds[k]:bounds[k + 1]]``; its last number occurs nowhere else.
    Two facts keep the work near linear. A word that does not occur again within the distances
    of a scale keeps its block from occurring. And in a known run of a lesser period a block
    occurs at multiples of that period only: there is no other run to find where the block and
    all words that follow lie in one, and none at a distance that such a period divides.
    """
    n = len(words)
    longest = int(np.diff(bounds).max(initial=0))
    order = np.argsort(words, kind="stable")
    again = np.full(n, n, np.int64)
    same = words[order[1:]] == words[order[:-1]]
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    top, size, extender = int(words.max(initial=0)) + 1, BASE, None
    known: dict[int, list[tuple[int, int, int]]] = {}  # period, begin and end, by document
    farthest = again[: n - n % size].reshape(-1, size).max(axis=1)
    while size == BASE or size <= longest // POWER:
        starts = np.flatnonzero(farthest < 2 * size) * size
        if known and len(starts):
            begins, ends = np.array(sorted((b, e) for own in known.values() for _, b, e in own)).T
            k = np.searchsorted(begins, starts, "right")
            covered = np.concatenate(([-1], np.maximum.accumulate(ends)))[k]
            starts = starts[covered < starts + 3 * size - 1]
        if len(starts):
            padded = np.concatenate((words, top + np.arange(3 * size)))
            x, d = occurrences(padded, starts, size, 1 if size == BASE else size)
            extender = extender or Extender(words)
            inside = x + d + size <= n
            for period, begin, end in extender.stretches(x[inside], d[inside], size):
                own = known.setdefault(int(np.searchsorted(bounds, begin, "right")), [])
                if not any(period % q == 0 and b <= begin and end <= e for q, b, e in own if q < period):
                    own.append((period, begin, end))
        farthest = farthest[: len(farthest) // 2 * 2].reshape(-1, 2).max(axis=1)
        size *= 2
    return sorted((begin, end - begin, period) for own in known.values() for period, begin, end in own)


def _portions(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text or b"")
        size += len(held[-1])
        if size >= PORTION:
            yield held
            held, size = [], 0
    if held:
        yield held


def document_runs(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The words of each text and its runs by start, then period."""
    split = [text.split() for text in texts]
    numbers: dict[bytes, int] = {}
    laid = [np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64) for words in split]
    ends = len(numbers) + np.arange(len(split))
    words = np.concatenate([part for k, own in enumerate(laid) for part in (own, ends[k : k + 1])])
    bounds = np.concatenate(([0], np.cumsum([len(own) + 1 for own in laid])))
    mine: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for start, length, period in runs_of(words, bounds):
        k = int(np.searchsorted(bounds, start, "right")) - 1
        mine[k].append((start - int(bounds[k]), length, period))
    return zip(split, mine, strict=True)


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]


RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        texts = (t.as_buffer().to_pybytes() if (t := value).is_valid else None for value in batch["text"])
        for held in _portions(texts):
            n_words, found, collapsed = [], [], []
            for words, runs in document_runs(held):
                n_words.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                collapsed.append(b" ".join(without_repeats(words, runs)))
            keys = batch["key"].slice(done, len(held))
            done += len(held)
            columns = [keys, pa.array(n_words, pa.int64()), pa.array(found, RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, runs, collapsed)`` of every row of ``docs``.

    Words are divided by spaces and the characters U+0009 to U+000D. ``runs`` lists
    ``(start, length, period)`` of every run of at least 24 words and three periods, by start,
    then period; ``collapsed`` has the words left when each run is cut to its first period,
    joined by one space. A null or empty text has no words; texts of any length are taken
    whole; repeated rows and equal keys each give their row, a null key stays null. No
    documents give no rows. Other columns are ignored.

    Narrow: texts stay in the task that reads them, a portion of about a million characters
    at a time or one longer text. The result does not depend on the portions, as documents
    are kept apart by numbers that occur once.
    """
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(_finder, out).withColumnRenamed("key", key)


def looped(key: str = "doc_id", text: str = "text"):
    """The text as words, of which a tenth of the documents repeat a stretch, chosen by their key.

    With ``h`` the checksum of the key, ``g = h div 10`` and ``n`` words: where ``h`` ends in
    zero, the words from ``g mod n`` on repeat the first ``1 + (n - a) div (3 + g mod 8)`` of
    them. All other texts are as they were.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        return F.struct(words.alias("words"), n.alias("n"), a.alias("a"), (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).alias("p"))

    def rendered(known):
        a, p, rest = known["a"].cast("int"), known["p"].cast("int"), (known["n"] - known["a"]).cast("int")
        unit = F.slice(known["words"], a + 1, p)
        copies = F.flatten(F.array_repeat(unit, F.ceil(rest / p).cast("int")))
        return F.array_join(F.concat(F.slice(known["words"], F.lit(1), a), F.slice(copies, F.lit(1), rest)), " ")

    # A transform of one element computes it once, however often its function names it.
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    chosen = (F.pmod(h, F.lit(10)) == 0) & F.col(text).rlike("[^\\x20\\x09-\\x0D]")
    return F.when(chosen, once(once(words, repeated), rendered)).otherwise(whole)
