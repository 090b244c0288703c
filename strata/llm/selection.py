"""The k smallest keys of a table, by weighted median-of-medians.

Keys are three integers in lexicographic order, none twice. Each partition reports how many keys it has left and their median. The median of
these medians, weighted by the numbers left, has at least a quarter of all remaining keys on either side: the side without the cutoff is
discarded, until the cutoff key itself is found. A pass reports both sides of its pivot, so that each round reads the keys once; the
remaining keys are written anew whenever seven eighths of them are gone.

At scale: rounds grow with the logarithm of the number of keys, and together they read a small multiple of them. What reaches the driver is one
row for each side and partition. A partition sorts its own remaining keys in memory, 24 bytes each. A lost executor costs its partitions' part
of a round.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import store

KEYS = ("k1", "k2", "k3")
SIDES = "upper boolean, n bigint, k1 bigint, k2 bigint, k3 bigint"


def below(key: tuple) -> Column:
    """Whether a row's key is smaller than `key`."""
    one, two, three = (F.col(k) for k in KEYS)
    return (one < key[0]) | ((one == key[0]) & ((two < key[1]) | ((two == key[1]) & (three < key[2]))))


def above(key: tuple) -> Column:
    one, two, three = (F.col(k) for k in KEYS)
    return (one > key[0]) | ((one == key[0]) & ((two > key[1]) | ((two == key[1]) & (three > key[2]))))


def medians(remaining: DataFrame, pivot: tuple | None) -> list[list[tuple]]:
    """(number, median key) of each partition that has keys below the pivot, and the same above it; without pivot all are below."""

    def report(batches):
        parts = [[], [], []]
        for batch in batches:
            for own, k in zip(parts, KEYS):
                own.append(batch[k].to_numpy())
        if not parts[0]:
            return
        keys = [np.concatenate(own) for own in parts]
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        n = len(order)
        cut, past = n, n
        if pivot is not None:
            less = (keys[0] < pivot[0]) | ((keys[0] == pivot[0]) & ((keys[1] < pivot[1]) | ((keys[1] == pivot[1]) & (keys[2] < pivot[2]))))
            cut = int(less.sum())
            past = cut + (cut < n and tuple(int(k[cut]) for k in keys) == tuple(pivot))
        rows = [(upper, b - a, *[int(k[(a + b - 1) // 2]) for k in keys]) for upper, a, b in ((False, 0, cut), (True, past, n)) if b > a]
        kinds = [pa.bool_(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(5)], ["upper", "n", *KEYS])

    sides: list[list[tuple]] = [[], []]
    for row in remaining.select(*KEYS).mapInArrow(report, SIDES).collect():
        sides[row["upper"]].append((row["n"], (row["k1"], row["k2"], row["k3"])))
    return sides


def weighted_median(side: list[tuple]) -> tuple:
    """The median of the medians, each counted as often as it has keys."""
    ordered, half, seen = sorted(side, key=lambda x: x[1]), sum(n for n, _ in side) / 2, 0
    for n, key in ordered:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int) -> tuple | None:
    """The k-th smallest key (from 1) of `keys` (k1, k2, k3: bigint, not null); None if k is 0. `keys` should be stored.

    k must not be more than there are keys.
    """
    if k <= 0:
        return None
    stored = keys.select(*KEYS)
    remaining = stored
    side = medians(remaining, None)[0]
    size = left = sum(n for n, _ in side)
    if k > left:
        raise ValueError(f"{k} keys wanted of {left}")
    low = high = None
    while True:
        pivot = weighted_median(side)
        lower, upper = medians(remaining, pivot)
        smaller = sum(n for n, _ in lower)
        if k == smaller + 1:
            return pivot
        if k <= smaller:
            side, high = lower, pivot
        else:
            side, low, k = upper, pivot, k - smaller - 1
        left = sum(n for n, _ in side)
        remaining = stored
        if low is not None:
            remaining = remaining.where(above(low))
        if high is not None:
            remaining = remaining.where(below(high))
        if left * 8 < size:
            remaining = stored = store(remaining, "selection-keys")
            size, low, high = left, None, None
