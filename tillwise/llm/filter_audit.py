"""Filter interaction audit: what each filter removes, for every order in which they could be applied.

A document fails some of the filters, and that says which subsets of them it survives: with five
filters 32 subsets, one bit each, so a document is a 32-bit word. How many documents survive each
subset is the positional popcount of their words, taken by carry-save adders: three words of one
weight become one of the same and one of twice the weight, until one is left of each. Those 32
numbers per part and label hold the result of any order, so no order is ever run.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Mapping
from itertools import permutations
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.sources.staging import stage


class Facts(NamedTuple):
    """What a filter sees of a whole text."""

    words: int
    distinct: int
    upper: int
    points: int
    special: int


_UPPER = bytes(range(65, 91))
_SPECIAL = b"#$%&*|"
# A document fails a filter if its condition holds.
CONDITIONS: dict[str, Callable[[Facts], bool]] = {
    "A": lambda f: f.words < 200,
    "B": lambda f: 100 * f.distinct < 50 * f.words,
    "C": lambda f: 100 * f.upper > 2 * f.points,
    "D": lambda f: f.special > 0,
}
REPEAT = "E"  # equal to the text of a smaller id


def facts(text: str) -> Facts:
    data = text.encode()
    words = data.split()  # at the six ASCII white-space bytes
    return Facts(
        len(words),
        len(set(words)),
        len(data) - len(data.translate(None, _UPPER)),
        len(text),
        len(data) - len(data.translate(None, _SPECIAL)),
    )


def survival_words(n_filters: int) -> np.ndarray:
    """Per failure mask the word of subsets survived: bit s is set if no filter of s fails."""
    masks = np.arange(1 << n_filters, dtype=np.uint64)
    bits = (masks[:, None] & masks[None, :]) == 0
    return (bits.astype(np.uint64) << masks[None, :]).sum(axis=1).astype(np.uint32)


def positional_counts(words: np.ndarray, width: int = 32) -> np.ndarray:
    """How many of the words have bit 0, 1, ... set, by carry-save adders over whole arrays."""
    out = np.zeros(width, np.int64)
    bits = np.arange(width, dtype=np.uint32)
    weight = 1
    while len(words):
        carried = []
        while len(words) > 1:
            if len(words) % 3:
                words = np.concatenate((words, np.zeros(3 - len(words) % 3, np.uint32)))
            a, b, c = words.reshape(3, -1)
            half = a ^ b
            carried.append((a & b) | (half & c))
            words = half ^ c
        out += weight * ((words[0] >> bits) & 1).astype(np.int64)
        words = np.concatenate(carried) if carried else words[:0]
        words = words[words != 0]
        weight *= 2
    return out


def _read(docs: DataFrame, part: str, conditions: Mapping[str, Callable[[Facts], bool]]) -> DataFrame:
    """(doc_id, part, digest, mask) per row; the digest stands for the whole text."""
    tests = list(conditions.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, masks = [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                digests.append(hashlib.blake2b(text.encode(), digest_size=16).digest())
                seen = facts(text)
                masks.append(sum(1 << i for i, fails in enumerate(tests) if fails(seen)))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                names=["doc_id", "part", "digest", "mask"],
            )

    slim = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, part string, digest binary, mask int")


def failures(
    docs: DataFrame, labels: DataFrame, part: str = "source",
    conditions: Mapping[str, Callable[[Facts], bool]] = CONDITIONS,
) -> DataFrame:
    """(doc_id, part, mask, good, toxic) per row: bit i of the mask is set if filter i fails.

    The last bit says that a smaller id has the same text. Both joins meet a written table of one
    row per text or id, so adaptive execution can split a text or id that holds many rows.
    """
    rows = stage(_read(docs, part, conditions), "audit-rows")
    held = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    repeated = stage(held.filter("first < last").select("digest", "first"), "audit-repeats")
    marked = labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marked = stage(marked, "audit-labels")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return (
        rows.join(repeated, "digest", "left")
        .join(marked, "doc_id", "left")
        .select(
            "doc_id",
            "part",
            (F.col("mask") + later.cast("int") * (1 << len(conditions))).alias("mask"),
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )


def survivors(failed: DataFrame, n_filters: int = len(CONDITIONS) + 1, most_parts: int = 4096) -> DataFrame:
    """(part, kept, good, toxic): how many documents survive each subset, as arrays by subset.

    Tasks add up the words of their own rows first, so a part that holds most rows arrives as one
    row of counts per task; a task hands on its counts once it holds ``most_parts`` parts.
    """
    if not 1 <= n_filters <= 5:
        raise ValueError("a word of 32 bits holds the subsets of at most five filters")
    table, width = survival_words(n_filters), 1 << n_filters
    names = ["kept", "good", "toxic"]

    def handed(counts: dict[str, np.ndarray]) -> pa.RecordBatch:
        parts = list(counts)
        numbers = np.concatenate([counts[p] for p in parts], axis=1) if parts else np.zeros((3, 0), np.int64)
        return pa.record_batch(
            [
                pa.array(np.repeat(np.array(parts, object), width), pa.string()),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(parts))),
                *[pa.array(column) for column in numbers],
            ],
            names=["part", "subset", *names],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = pc.dictionary_encode(batch.column("part"))
            code = coded.indices.to_numpy(zero_copy_only=False)
            words = table[batch.column("mask").to_numpy(zero_copy_only=False)]
            order = np.argsort(code, kind="stable")
            flags = [batch.column(n).to_numpy(zero_copy_only=False)[order] for n in names[1:]]
            code, words = code[order], words[order]
            cuts = np.flatnonzero(np.diff(code)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(code)]):
                if low == high:
                    continue
                some = words[low:high]
                part = coded.dictionary[int(code[low])].as_py()
                found = np.stack([positional_counts(w, width) for w in (some, *[some[f[low:high]] for f in flags])])
                counts[part] = counts[part] + found if part in counts else found
            if len(counts) >= most_parts:
                yield handed(counts)
                counts = {}
        yield handed(counts)

    summed = (
        failed.select("part", "mask", "good", "toxic")
        .mapInArrow(run, "part string, subset int, kept long, good long, toxic long")
        .groupBy("part", "subset")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    row = F.struct("subset", *names)
    by_part = summed.groupBy("part").agg(F.sort_array(F.collect_list(row)).alias("by"))  # one entry per subset
    return by_part.select("part", *[F.col(f"by.{n}").alias(n) for n in names])


def _steps(filters: str) -> list[dict]:
    """Every order and step: the subset before the step and its filter's bit."""
    out = []
    for order in permutations(filters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << filters.index(letter)
            out.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return out


def audit(
    docs: DataFrame, labels: DataFrame, part: str = "source",
    conditions: Mapping[str, Callable[[Facts], bool]] = CONDITIONS,
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row per part, order of the filters and step. NULL and empty texts have no words; a NULL part
    is the empty string; a row without an id has no label, fails no repeat and makes none; an id that
    is labelled twice counts as good or toxic if any of its labels says so; repeated rows count each,
    and rows of one id are no repeats of each other. An empty table gives an empty result.
    """
    filters = "".join(conditions) + REPEAT
    n = len(filters)
    full = (1 << n) - 1
    counted = survivors(failures(docs, labels, part, conditions), n)
    steps = F.from_json(
        F.lit(json.dumps(_steps(filters))), "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    )
    rows = counted.select("part", "kept", "good", "toxic", F.inline(steps))

    def at(name: str, subset: Column) -> Column:
        return F.get(name, subset)

    after, others = F.col("before") + F.col("bit"), F.lit(full) - F.col("bit")

    def lost(name: str) -> Column:
        return at(name, F.col("before")) - at(name, after)

    # All orders in which one subset of the others goes before: its size's permutations times the rest's.
    shapley = F.lit(0).cast("long")
    for subset in range(full + 1):
        ways = factorial(subset.bit_count()) * factorial(max(n - 1 - subset.bit_count(), 0))
        free = F.lit(subset).bitwiseAND(F.col("bit")) == 0
        gone = at("kept", F.lit(subset)) - at("kept", F.lit(subset).bitwiseOR(F.col("bit")))
        shapley = shapley + F.when(free, gone * ways).otherwise(0)
    fails = at("kept", F.lit(0)) - at("kept", F.col("bit"))
    return rows.select(
        "part",
        "filter_order",
        "step",
        at("kept", after).alias("kept"),
        lost("kept").alias("removed"),
        (fails - lost("kept")).alias("redundant"),
        (at("kept", others) - at("kept", F.lit(full))).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
