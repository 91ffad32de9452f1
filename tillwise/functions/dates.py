"""Calendar helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_key(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM")


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    """Add the ``yyyy-MM`` key, or keep the one the table is already partitioned by."""
    known = [f for f in df.schema if f.name == "month"]
    if not known:
        return df.withColumn("month", month_key(date_col))
    if known[0].dataType.typeName() != "string":
        raise ValueError(f"column month is {known[0].dataType.simpleString()}, not yyyy-MM text")
    return df


def month_number(month: Column | str) -> Column:
    """Months since year 0 of a ``yyyy-MM`` key: consecutive months differ by one."""
    year, of_year = F.substring(month, 1, 4), F.substring(month, 6, 2)
    return year.cast("int") * 12 + of_year.cast("int")


ISO = "yyyy-MM-dd"
_WITH_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.]\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"


def to_date(c: Column | str, formats: Sequence[str] = (ISO,)) -> Column:
    """Lenient date: the first format that parses the whole text; NULL if none does.

    An ISO date-time counts as the date written in it, whatever its offset.
    """
    text = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    day = F.when((F.length(text) > len("yyyy-MM-dd")) & text.rlike(_WITH_TIME), F.substring(text, 1, 10)).otherwise(text)
    return F.coalesce(
        *[
            F.when(F.length(day) == len(f), F.try_to_date(day, f)) if f == ISO else F.try_to_date(text, f)
            for f in formats
        ]
    )
