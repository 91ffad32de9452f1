"""Reproducible samples without replacement, independent of partitioning.

A sample is the ``n`` rows with the smallest keys, where a key is drawn from the row's id. A small
sample is a distributed top-n. A large one, say a tenth of the table, is a filter: histograms of the
keys narrow down where the ``n``-th lies until few rows are left around it; all below are in, and
only those few are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.plans.ordered import with_order_stats

MOST_SORTED = 10_000
_BINS = 4096


def _digest(key: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def _number(key: Sequence[str], seed: int) -> Column:
    """The first 52 bits of the digest, which a double holds exactly."""
    return F.conv(F.substring(_digest(key, seed), 1, 13), 16, 10).cast("double")


def sample_rows(
    df: DataFrame, n: int, key: Sequence[str], seed: int = 42, most_sorted: int = MOST_SORTED
) -> DataFrame:
    """``n`` rows: those with the smallest hash of seed and key.

    Beyond ``most_sorted`` rows jobs run while the plan is built: two or three counts of the keys.
    """
    return _smallest(df, n, _number(key, seed), [_digest(key, seed)], key, most_sorted)


def weighted_sample(
    df: DataFrame, n: int, weight: str, key: Sequence[str], seed: int = 42, most_sorted: int = MOST_SORTED
) -> DataFrame:
    """``n`` rows drawn with probability proportional to ``weight``.

    Each row draws an exponential arrival time -ln(u)/weight with u from its hash; the
    ``n`` earliest win. Rows without a positive weight are never drawn.
    """
    uniform = (_number(key, seed) + 1e0) / F.lit(float(2**52))
    w = F.col(weight).cast("double")
    arrival = -F.log(uniform) / w
    return _smallest(df.filter((w > 0) & ~F.isnan(w)), n, arrival, [arrival], key, most_sorted)


def _smallest(
    df: DataFrame, n: int, x: Column, order: Sequence[Column], key: Sequence[str], most_sorted: int
) -> DataFrame:
    """The ``n`` first rows by ``order``, then ``key``; ``x`` never falls along that order."""
    if n <= most_sorted:
        return df.orderBy(*order, *key).limit(n)
    keys = df.select(x.alias("x"))
    low, high, rows = keys.agg(F.min("x"), F.max("x"), F.count("x")).first()
    if rows <= n:
        return df
    inside, missing = keys, n
    while rows > most_sorted and low < high:
        # Bins follow the order of x, so the one that holds the n-th is a range of it.
        width = F.lit(high) - F.lit(low)
        at = F.least(F.floor((F.col("x") - F.lit(low)) / width * _BINS), F.lit(_BINS - 1))
        bins = inside.groupBy(at.alias("bin")).agg(F.count("x"), F.min("x"), F.max("x"))
        for _, count, least, largest in sorted(tuple(r) for r in bins.collect()):  # at most _BINS
            if count >= missing:
                low, high, rows = least, largest, count
                break
            missing -= count
        inside = keys.filter(F.col("x").between(low, high))
    below = df.filter(x < F.lit(low))
    edge = df.filter(x.between(F.lit(low), F.lit(high)))
    if rows <= most_sorted:
        return below.unionByName(edge.orderBy(*order, *key).limit(missing))
    # Very many rows with one key number: they are counted along sorted slices.
    names = [f"__order_{i}" for i in range(len(order))]
    numbered = with_order_stats(
        edge.withColumns(dict(zip(names, order))), names, list(key), row_number="__place"
    )
    return below.unionByName(numbered.filter(F.col("__place") <= missing).select(*df.columns))
