"""Ranks and running sums over a whole table without putting it in one task.

A window with no PARTITION BY (or with one huge partition) runs in a single task. Here
the rows are range-partitioned into slices by (group, order, key), each slice is windowed
on its own, and the result is written once. The last row of each slice says how many rows
and which sums came before the next one; those offsets, one small row per slice, are
broadcast back. Because the unique key is part of the range, even a value shared by most
rows spreads over several slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.sources.staging import stage

_SLICE, _POS, _RANK, _LAST = "__slice", "__pos", "__rank", "__last"


def _sort(column: str) -> Column:
    """``"-revenue"`` sorts descending, ``"revenue"`` ascending; NULLs lowest."""
    return F.col(column[1:]).desc() if column.startswith("-") else F.col(column).asc()


def _name(column: str) -> str:
    return column.lstrip("-")


def with_order_stats(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str],
    within: Sequence[str] = (),
    rank: str | None = None,
    row_number: str | None = None,
    running: Mapping[str, str] | None = None,
    total: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add order statistics to ``df``.

    order       sort columns, a leading ``-`` meaning descending
    key         unique tiebreak columns
    within      restart per group of these columns
    rank        output name for RANK() by ``order`` (ties share a rank)
    row_number  output name for ROW_NUMBER() by ``order`` then ``key``
    running     {output: column} running sums, ROWS from the first to the current row
    total       {output: column} sums over the whole table

    Runs a job while the plan is built: the sorted slices are written to staged storage, from
    which the result is read (see README on when that storage goes).
    """
    running = dict(running or {})
    within = list(within)
    if not running:
        return _places(df, order, key, within, rank, row_number, total or {})
    values = [_name(c) for c in order]
    by_key = [_sort(c) for c in order] + [F.col(k).asc() for k in key]
    part = [_SLICE, *within]
    keyed = Window.partitionBy(*part).orderBy(*by_key)
    so_far = keyed.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {
        _POS: F.row_number().over(keyed),
        _LAST: F.lead(F.lit(True)).over(keyed).isNull(),
        **{out: F.sum(c).over(so_far) for out, c in running.items()},
    }
    if rank:
        valued = Window.partitionBy(*part).orderBy(*[_sort(c) for c in order])
        local[_RANK] = F.rank().over(valued)
    sliced = df.repartitionByRange(*[F.col(w).asc() for w in within], *by_key).withColumn(
        _SLICE, F.spark_partition_id()
    )
    staged = stage(sliced.withColumns(local), "ordered")

    # The last row of each (slice, group) carries its size, its sums and its last rank.
    earlier = (
        Window.partitionBy(*within)
        .orderBy(_SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    tails = staged.filter(F.col(_LAST)).withColumns(
        {
            "__before": F.coalesce(F.sum(_POS).over(earlier), F.lit(0)),
            **{f"__base_{out}": F.sum(out).over(earlier) for out in running},
        }
    )
    # Only the first group of a slice can have rows in earlier slices, so this holds at
    # most one row per slice: a bounded broadcast.
    carried = tails.filter(F.col("__before") > 0).select(
        F.col(_SLICE).alias("__c_slice"),
        *[F.col(w).alias(f"__c_{w}") for w in within],
        "__before",
        *[f"__base_{out}" for out in running],
    )
    if rank:
        carried = _with_tie_starts(carried, staged, tails, values, within)

    same_part = [F.col(_SLICE) == F.col("__c_slice")] + [
        F.col(w).eqNullSafe(F.col(f"__c_{w}")) for w in within
    ]
    joined = staged.join(F.broadcast(carried), _all(same_part), "left")
    before = F.coalesce(F.col("__before"), F.lit(0))
    out: dict[str, Column] = {}
    if rank:
        runs_in = F.col("__tie_start").isNotNull() & (F.col(_RANK) == 1)
        out[rank] = (
            F.when(runs_in, F.col("__tie_start")).otherwise(before + F.col(_RANK)).cast("long")
        )
    if row_number:
        out[row_number] = (before + F.col(_POS)).cast("long")
    for name in running:
        base = F.col(f"__base_{name}")
        out[name] = F.when(base.isNull(), F.col(name)).otherwise(
            F.coalesce(F.col(name), F.lit(0)) + base
        )
    return joined.select(
        *df.columns,
        *[c.alias(name) for name, c in out.items()],
        *[staged.agg(F.sum(c)).scalar().alias(name) for name, c in (total or {}).items()],
    )


def _places(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str],
    within: Sequence[str],
    rank: str | None,
    row_number: str | None,
    total: Mapping[str, str],
) -> DataFrame:
    """Ranks and row numbers need no window: places are counted along the sorted slices.

    A generated id holds the slice in its upper bits and the place in it in the lower 33. The rows
    cross the network once, by range. A rank is the place of the first row with its value, so only
    values that occur more than once are looked up; the ids and values alone are shuffled to find them.
    """
    by_key = [*[F.col(w).asc() for w in within], *[_sort(c) for c in order], *[F.col(k).asc() for k in key]]
    sliced = df.repartitionByRange(*by_key).sortWithinPartitions(*by_key)
    staged = stage(sliced.withColumn("__id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__id", 33)
    sizes = staged.groupBy(part.alias(_SLICE)).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(_SLICE, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))

    def placed(rows: DataFrame, first: str, out: str) -> DataFrame:
        """The ids in a column as places from 1."""
        found = rows.withColumn(_SLICE, F.shiftright(first, 33)).join(F.broadcast(before), _SLICE)  # one row per slice
        local = F.col(first).bitwiseAND(F.lit((1 << 33) - 1))
        return found.withColumn(out, F.col("__before") + local + 1).drop(_SLICE, "__before")

    out = placed(staged, "__id", "__place")
    first = F.col("__place")
    if rank:
        values = [_name(c) for c in order]
        ties = staged.groupBy(*within, *values).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
        # Written, so a value that most rows share can be split between tasks.
        ties = stage(ties.filter("__n > 1").drop("__n"), "ties")
        out = _look_up(out, placed(ties, "__first", "__tie").drop("__first"), [*within, *values])
        first = F.coalesce("__tie", "__place")
    group = F.lit(0)
    if within:
        groups = staged.groupBy(*within).agg(F.min("__id").alias("__first"))
        out = _look_up(out, placed(groups, "__first", "__group").drop("__first"), within)
        group = F.col("__group") - 1
    numbers = {rank: first, row_number: F.col("__place")}
    return out.select(
        *df.columns,
        *[(c - group).cast("long").alias(name) for name, c in numbers.items() if name],
        *[staged.agg(F.sum(c)).scalar().alias(name) for name, c in total.items()],
    )


def _look_up(df: DataFrame, found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A left join in which NULL matches NULL; the columns stay those of ``df``."""
    named = found.withColumnsRenamed({c: f"__f_{c}" for c in columns})
    same = _all([F.col(c).eqNullSafe(F.col(f"__f_{c}")) for c in columns])
    return df.join(named, same, "left").drop(*[f"__f_{c}" for c in columns])


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _with_tie_starts(
    carried: DataFrame,
    staged: DataFrame,
    tails: DataFrame,
    values: Sequence[str],
    within: Sequence[str],
) -> DataFrame:
    """Add the rank of a tie that runs into a slice from earlier ones.

    The tie starts where the first slice that ends in it says it does.
    """
    heads = staged.filter(F.col(_POS) == 1).select(
        F.col(_SLICE).alias("__h_slice"),
        *[F.col(w).alias(f"__h_{w}") for w in within],
        *[F.col(c).alias(f"__hv_{c}") for c in values],
    )
    ends = tails.select(
        *[F.col(w).alias(f"__t_{w}") for w in within],
        *[F.col(c).alias(f"__tv_{c}") for c in values],
        (F.col("__before") + F.col(_RANK)).alias("__start"),
    )
    keys = [*[f"__t_{w}" for w in within], *[f"__tv_{c}" for c in values]]
    starts = ends.groupBy(*keys).agg(F.min("__start").alias("__tie_start"))
    same_slice = [F.col("__c_slice") == F.col("__h_slice")] + [
        F.col(f"__c_{w}").eqNullSafe(F.col(f"__h_{w}")) for w in within
    ]
    same_tie = [F.col(f"__c_{w}").eqNullSafe(F.col(f"__t_{w}")) for w in within] + [
        F.col(f"__hv_{c}").eqNullSafe(F.col(f"__tv_{c}")) for c in values
    ]
    # A start beyond the rows before the slice belongs to a tie that begins in it.
    return (
        carried.join(heads, _all(same_slice))
        .join(starts, _all(same_tie), "left")
        .select(
            *carried.columns,
            F.when(F.col("__tie_start") <= F.col("__before"), F.col("__tie_start")).alias(
                "__tie_start"
            ),
        )
    )


def global_running_sum(
    df: DataFrame, order: Sequence[str], value: str, key: Sequence[str], out: str
) -> DataFrame:
    return with_order_stats(df, order, key, running={out: value})


def global_rank(
    df: DataFrame, order: Sequence[str], key: Sequence[str], out: str, within: Sequence[str] = ()
) -> DataFrame:
    return with_order_stats(df, order, key, within=within, rank=out)
