"""Line dedup: range-partitioned line hashes, first occurrences, per-document bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import SPACES, lower_ascii, text_mark, whole_text
from tillwise.sources.staging import stage

_DOC = ("doc_id", "mark")


def line_keys(text: Column) -> Column:
    """Per line of the text: stripped of ASCII white space, A-Z lower-cased."""
    return F.transform(
        F.split(lower_ascii(text), "\n", -1), lambda s: F.btrim(s, F.lit(SPACES))
    )


def line_occurrences(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(h1, h2, doc_id, mark, positions): where each line key of 128 hashed bits stands.

    Range-partitioned by hash, then document, so that a line which a third of all documents
    hold spreads over many partitions, and sorted by hash, document and position.
    """
    text = whole_text()
    lines = docs.select("doc_id", text_mark().alias("mark"), F.posexplode(line_keys(text))).filter(
        F.char_length("col") >= max(min_chars, 1)
    )
    hashed = lines.select(
        F.xxhash64("col").alias("h1"),
        F.xxhash64(F.lit(1), "col").alias("h2"),
        *_DOC,
        F.col("pos").alias("position"),
    )
    key = ["h1", "h2", *_DOC]
    ranged = hashed.repartitionByRange(*key).sortWithinPartitions(*key, "position")
    return ranged.groupBy(*key).agg(F.sort_array(F.collect_set("position")).alias("positions"))


def dropped_bitmaps(docs: DataFrame, min_docs: int, keep: str, min_chars: int = 1) -> DataFrame:
    """(doc_id, mark, words): for documents that lose lines, the bits of the lost ones.

    A word covers 64 lines; words without a lost line are left out, which keeps bitmaps of
    long documents small. ``keep="none"`` drops every occurrence of a key found in at least
    ``min_docs`` documents; ``keep="first"`` spares the first by document and position.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    found = stage(line_occurrences(docs, min_chars), "line-occurrences")
    # A slice of the range hands on one row per hash: its documents and the first of them.
    runs = found.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(F.struct(*_DOC)).alias("first")
    )
    # Written first, so that both sides of the join are plain scans and a hot key can be split.
    common = stage(runs.filter(F.col("n_docs") >= min_docs), "common-lines")
    hits = found.join(common, ["h1", "h2"])
    positions = F.col("positions")
    if keep == "first":
        is_first = F.struct(*_DOC).eqNullSafe(F.col("first"))
        positions = F.when(is_first, F.slice(positions, 2, F.greatest(F.size(positions) - 1, F.lit(0)))).otherwise(positions)
    lost = hits.select(*_DOC, F.explode(positions).alias("p")).select(
        *_DOC,
        F.floor(F.col("p") / 64).cast("int").alias("word"),
        F.expr("shiftleft(1L, p % 64)").alias("bit"),
    )
    words = lost.groupBy(*_DOC, "word").agg(F.bit_or("bit").alias("bits"))
    return words.groupBy(*_DOC).agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words")
    )


def _dense(words: Column) -> Column:
    """Sparse (word, bits) entries as an array indexed by word."""
    return F.flatten(
        F.transform(
            words,
            lambda e, i: F.concat(
                F.array_repeat(
                    F.lit(0).cast("long"),
                    e["word"] - F.coalesce(F.get(words, i - 1)["word"], F.lit(-1)) - 1,
                ),
                F.array(e["bits"]),
            ),
        )
    )


def dedup_lines(
    docs: DataFrame, min_docs: int = 10, keep: str = "none", min_chars: int = 1
) -> DataFrame:
    """(row, n_lines, n_dropped, kept_text) for every row of ``docs``.

    ``row`` holds the input columns. Lines end at ``\\n``; a NULL or empty text is one empty
    line, and lines without a key character are never dropped. Rows equal in doc_id and text
    are one document; equal ids with different texts are different documents; a NULL id is an
    id like any other. An empty table gives an empty result.
    """
    bitmaps = dropped_bitmaps(docs, min_docs, keep, min_chars).select(
        F.col("doc_id").alias("b_id"), F.col("mark").alias("b_mark"), "words"
    )
    packed = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("key"), text_mark().alias("mark")
    )
    joined = packed.join(
        bitmaps, F.col("key").eqNullSafe(F.col("b_id")) & (F.col("mark") == F.col("b_mark")), "left"
    )
    text = whole_text(F.col("row")["text"])
    dense = joined.select(
        "row", F.split(text, "\n", -1).alias("lines"), "words", _dense(F.col("words")).alias("dense")
    )
    kept = F.filter(
        "lines",
        lambda _, i: F.coalesce(
            F.get("dense", F.floor(i / 64).cast("int")).bitwiseAND(
                F.call_function("shiftleft", F.lit(1).cast("long"), i % 64)
            ),
            F.lit(0).cast("long"),
        )
        == 0,
    )
    lost = F.aggregate(
        F.coalesce(F.col("words"), F.array().cast("array<struct<word:int,bits:bigint>>")),
        F.lit(0).cast("long"),
        lambda total, e: total + F.bit_count(e["bits"]),
    )
    return dense.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        lost.alias("n_dropped"),
        F.when(F.col("words").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
