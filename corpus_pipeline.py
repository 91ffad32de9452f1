"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import line_dedup, mixing, near_dup, quality_rules, queries, sentencepiece_codec
from tillwise.llm.common import table
from tillwise.sources.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that a rule rejects go."""
    judged = quality_rules.apply_rules(docs, table(spark, sf_dir, "labels"))
    return judged.filter("kept").select("row.*")


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: texts lose lines found in ten documents or more; ``n_chars`` follows the text."""
    lines = line_dedup.dedup_lines(docs)
    row = F.col("row").withField("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length("kept_text").cast(docs.schema["n_chars"].dataType))
    return lines.select(F.when(F.col("n_dropped") > 0, row).otherwise(F.col("row")).alias("row")).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each class stays."""
    return near_dup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: rows go in as often as their leaf's budget says."""
    return mixing.mixed(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: ids, byte spans and digests."""
    return queries.digest(sentencepiece_codec.encode(docs, queries.tokenizer(), add_eos=True))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_common_lines),
    ("near_dedup", keep_one_of_each),
    ("mixing", mix),
    ("sentencepiece", tokenise),
]
ORACLE_SQL = None  # risk-controlled cutoffs, ProbMinHash and the tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each result is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
