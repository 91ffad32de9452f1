"""Small relational helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MARKS = 1 << 25  # bits that mark repeated keys, 64 in a word


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row frames, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def null_safe_on(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality on all ``columns``, with NULL matching NULL."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def dealt(df: DataFrame, *key: str) -> DataFrame:
    """The rows dealt by ``key`` into as many partitions as ``spark.sql.shuffle.partitions`` says.

    Left to choose, adaptive execution merges partitions up to its advisory size, which counts
    compressed bytes; several times that must then be sorted or hashed in one task, which spills. With
    the number given it merges none. Joins, windows and aggregations by ``key`` need no other shuffle.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def rows_apart(
    df: DataFrame, key: Sequence[str], keep: Callable[[DataFrame, str], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """The rows that are alone under their key, and the rest: those that may share it.

    Only a hash of each key is dealt. Hashes met twice mark bits in words, half a million at most, that
    ``keep`` writes and every task reads, so rows found alone need not cross the network. A bit may be
    shared by another key, whose rows are then among the rest; a key's rows are never torn apart. ``df``
    is read three times and must give the same rows each time.
    """
    hashed = F.shiftrightunsigned(F.xxhash64(*key), 24)  # 40 bits
    met = dealt(df.select(hashed.alias("__hash")), "__hash").groupBy("__hash").agg(F.count(F.lit(1)).alias("__met"))
    place = F.col("__hash").bitwiseAND(F.lit(_MARKS - 1))
    bit = place.bitwiseAND(F.lit(63)).cast("int")
    words = (
        met.filter("__met > 1")
        .withColumn("__word", F.shiftright(place, 6))
        .repartition(16, "__word")  # few at most, and each task of the counting opens a file for every one
        .groupBy("__word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("__bits"))
    )
    words = F.broadcast(keep(words, "repeated_keys"))
    marked = df.withColumn("__hash", hashed).join(words, F.shiftright(place, 6) == F.col("__word"), "left")
    marked = marked.withColumn("__marked", F.coalesce(F.bit_get("__bits", bit) == 1, F.lit(False)))
    return marked.filter(~F.col("__marked")).select(*df.columns), marked.filter("__marked").select(*df.columns)


def rows_for(df: DataFrame, wanted: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose key occurs in ``wanted``.

    Only distinct keys meet ``df``: if it is bucketed by them it is not shuffled, and a key that
    occurs very often is one row.
    """
    return df.join(wanted.select(*key).distinct(), list(key), "left_semi")


def checked_lookup(
    df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Many-to-one join that fails at run time if the dimension repeats a key."""
    lookup = dim.groupBy(key).agg(
        F.count(F.lit(1)).alias("__copies"), *[F.min(c).alias(c) for c in columns]
    )
    sure = lookup.filter(
        F.when(F.col("__copies") == 1, True).otherwise(
            F.raise_error(F.concat(F.lit(f"duplicate {key} in lookup: "), F.col(key).cast("string")))
        )
    )
    return df.join(sure.drop("__copies"), key, how)
