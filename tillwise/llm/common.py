"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six white-space characters that separate words, and ASCII letters.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(c: Column | str = "text") -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased and nothing else; plain ASCII text takes the fast built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER)
    )


def text_mark(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells rows with one doc_id but different texts apart; equal rows share it."""
    return F.xxhash64(F.lit(5), doc_id, F.coalesce(F.col(text), F.lit("")))


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % divisor


def passed_through(df: DataFrame, **internal: Column) -> DataFrame:
    """All columns packed into ``row``, so names made by an operator can't clash with them."""
    return df.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in internal.items()])


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for the jobs that run inside; long texts make
    the default batch large on both sides of the pipe."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
