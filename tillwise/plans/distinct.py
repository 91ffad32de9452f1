"""Several exact distinct counts and sums in one scan, as mergeable bitmaps.

Spark's own ``COUNT(DISTINCT a), COUNT(DISTINCT b)`` sends every distinct value of either through
the shuffle. Ids are dense numbers in a fixed format, so here 64 neighbouring ids share one row: the
number's upper part says which word of a bitmap, the lower six bits which bit, and words merge by
``bit_or``, on the map side first. (The built-in bitmaps of 32,768 bits need a sort per task, and
4 KB for a single id.) An id in any other format is counted as the text it is, so the counts are
exact for every input.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise import model

_KIND, _WORD, _BITS, _ODD = "__kind", "__word", "__bits", "__odd"


def _format_of(name: str) -> tuple[str, int]:
    """Prefix and least number of digits of an id column."""
    found = re.fullmatch(r"([A-Z]+)\\d\{(\d+),?\}", model.ID_PATTERNS[name])
    return found[1], int(found[2])


def _number(df: DataFrame, column: str) -> Column:
    """The dense number of an id, NULL if it is not in the format of its column.

    The id is spelt from the number again and compared, so two ids never share a number.
    """
    c = F.col(column)
    if dict(df.dtypes)[column] in ("tinyint", "smallint", "int", "bigint"):
        return F.when(c >= 0, c.cast("long"))
    prefix, width = _format_of(column)
    number = F.substring(c, len(prefix) + 1, 18).try_cast("long")
    digits = number.cast("string")
    spelt = F.concat(F.lit(prefix), F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits))
    return F.when((number >= 0) & (spelt == c), number)


def distinct_and_sums(
    df: DataFrame,
    by: Sequence[str],
    counts: Mapping[str, tuple[str, Column]],
    sums: Mapping[str, Callable[[Callable[[Column], Column]], Column]] | None = None,
) -> DataFrame:
    """Per group of ``by`` the distinct ids of several columns, and sums; one row without ``by``.

    counts  {output: (id column, condition)}: distinct non-NULL ids of the rows where it holds
    sums    {output: total}: ``total(own)`` is an aggregate, in which ``own`` wraps each input column

    The scan, the expressions of ``by`` and a join before it are shared by all of them.
    """
    sums = dict(sums or {})
    kinds = [F.struct(F.lit(0).alias(_KIND), *[F.lit(None).cast(t).alias(n) for n, t in _FIELDS.items()])]
    for kind, (column, condition) in enumerate(counts.values(), 1):
        number = F.when(condition, _number(df, column))
        odd = F.when(condition & number.isNull(), F.col(column).cast("string"))
        kinds.append(
            F.struct(
                F.lit(kind).alias(_KIND),
                F.shiftright(number, 6).alias(_WORD),
                F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int")).alias(_BITS),
                odd.alias(_ODD),
            )
        )
    apart = df.select("*", F.inline(F.array(*(kinds if sums else kinds[1:]))))

    def own(c: Column) -> Column:
        return F.when(F.col(_KIND) == 0, c)

    words = apart.groupBy(*by, _KIND, _WORD, _ODD).agg(
        F.bit_or(_BITS).alias(_BITS), *[total(own).alias(out) for out, total in sums.items()]
    )
    found = F.when(F.col(_ODD).isNotNull(), 1).otherwise(F.coalesce(F.bit_count(_BITS), F.lit(0)))
    numbers = {
        out: F.coalesce(F.sum(F.when(F.col(_KIND) == kind, found)), F.lit(0)).cast("long")
        for kind, out in enumerate(counts, 1)
    }
    return words.groupBy(*by).agg(
        *[c.alias(out) for out, c in numbers.items()], *[F.sum(out).alias(out) for out in sums]
    )


_FIELDS = {_WORD: "bigint", _BITS: "bigint", _ODD: "string"}
