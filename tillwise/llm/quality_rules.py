"""Quality rules with risk-controlled thresholds.

Every rule compares one measure with a cutoff. The cutoffs are chosen on labelled clean
documents: a cutoff is certified if an exact (Clopper-Pearson) upper bound on the share of
clean documents it rejects stays under the allowed risk, and the confidence is divided among
all rules and strata (Bonferroni). Inside one rule and stratum cutoffs are tested from the
mildest on and testing stops at the first that fails, so the chain needs no further division.

A stratum with too few clean documents to certify even a cutoff that rejects none of them is
pooled with the others of its kind. The pool is one stratum more, counted in the division; its
cutoffs bound the share over the pool, not that of each stratum in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.blocks import Block, blocks, byte_set, mix, span_hashes
from tillwise.llm.common import passed_through
from tillwise.sources.staging import stage

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper")
WINDOW = 8
_SYMBOLS = byte_set("#*$%&|<>")
_UPPER = byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")

# A rule is a share of the text; the cutoffs are the same fixed grid for all of them.
RULES: dict[str, str] = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "symbols_per_char": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
}
N_CUTOFFS = 200


def repeated_words(block: Block, hashes: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Per text: words that lie in a window of ``size`` words found twice or more in it."""
    first, found = block.windows(hashes, size)
    out = np.zeros(block.n, np.int64)
    if not len(first):
        return out
    keys = mix(found ^ mix(block.doc[first].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    repeated = np.zeros(len(first), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, first[repeated], 1)
    np.add.at(cover, first[repeated] + size, -1)
    covered = np.cumsum(cover[:-1]) > 0
    return np.bincount(block.doc[covered], minlength=block.n)


def duplicate_lines(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word that equal an earlier line of it, and all lines."""
    starts, ends, doc = block.lines()
    words = np.concatenate(([0], np.cumsum(block.inside)))
    worded = words[ends] > words[starts]
    n_lines = np.bincount(doc, minlength=block.n)
    keys = span_hashes(block.data, starts[worded], ends[worded])
    keys = mix(keys ^ mix(doc[worded].astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(keys, return_index=True)
    distinct = np.bincount(doc[worded][first], minlength=block.n)
    return np.bincount(doc[worded], minlength=block.n) - distinct, n_lines


def measures(block: Block) -> dict[str, np.ndarray]:
    inside = block.inside
    points = (block.data & 0xC0) != 0x80
    dup, n_lines = duplicate_lines(block)
    return {
        "n_words": block.n_words,
        "word_chars": block.per_doc(inside & points),
        "n_symbols": block.per_doc(_SYMBOLS[block.data]),
        "n_dup_lines": dup,
        "n_repeat_words": repeated_words(block, block.word_hashes()),
        "n_lines": n_lines,
        "n_upper": block.per_doc(_UPPER[block.data]),
    }


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, m): every row of ``docs`` with the counts of its whole text; NULL has no words."""
    packed = passed_through(docs)
    names = [*COUNTS, *EXTRA]
    kind = T.StructType([T.StructField(n, T.LongType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # taken out of the row, so a text crosses into Python once
            for low, block in blocks(pc.struct_field(batch.column("row"), text)):
                found = measures(block)
                m = pa.StructArray.from_arrays([pa.array(found[n], pa.int64()) for n in names], names)
                rows = batch.column("row").slice(low, block.n)
                yield pa.record_batch([rows, m], names=["row", "m"])

    return packed.mapInArrow(run, T.StructType([packed.schema["row"], T.StructField("m", kind)]))


def base_failed(m: Column) -> Column:
    """Fewer than 20 words, or over 30 % of the words in repeated windows."""
    return (m["n_words"] < 20) | (m["n_repeat_words"] * 100 > m["n_words"] * 30)


def rejection_bound(rejected: int, n: int, alpha: float) -> float:
    """Exact upper confidence bound of a binomial share: P(X <= rejected | bound) = alpha."""
    if rejected >= n:
        return 1.0
    low, high = rejected / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if _at_most(rejected, n, middle) > alpha else (low, middle)
    return high


def _at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for n trials with share p."""
    if p <= 0 or p >= 1:
        return float(p <= 0 or k >= n)
    i = np.arange(k + 1)
    steps = np.log(np.maximum(n - i[1:] + 1, 1)) - np.log(np.maximum(i[1:], 1))
    logs = np.concatenate(([0.0], np.cumsum(steps))) + i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return float(np.exp(logs - top).sum() * math.exp(top))


def least_clean(risk: float, delta: float, strata: int) -> int:
    """Clean documents that a stratum needs for any cutoff at all: one that rejects none of them."""
    alpha, each = _shares(risk, delta, strata)
    return math.ceil(math.log(alpha) / math.log1p(-each))


def _shares(risk: float, delta: float, strata: int) -> tuple[float, float]:
    """The parts of ``delta`` and ``risk`` of one rule in one stratum."""
    return delta / (len(RULES) * max(strata, 1)), risk / len(RULES)


def _pooling(
    histogram: Mapping[tuple[str, str], Mapping[int, int]], risk: float, delta: float
) -> tuple[set[str], set[str], int]:
    """(all strata, those too small to certify alone, number of strata tested)."""
    sizes: dict[str, int] = {}
    for (s, _), counts in histogram.items():
        sizes[s] = max(sizes.get(s, 0), sum(counts.values()))
    need = least_clean(risk, delta, len(sizes))
    if all(n >= need for n in sizes.values()):
        return set(sizes), set(), len(sizes)
    tests = len(sizes) + 1
    need = least_clean(risk, delta, tests)
    return set(sizes), {s for s, n in sizes.items() if n < need}, tests


def bounds(
    histogram: Mapping[tuple[str, str], Mapping[int, int]], cutoffs: Mapping[tuple[str, str], float],
    risk: float, delta: float,
) -> dict[str, str]:
    """Per stratum whose bound its cutoffs keep: its ``own``, or that of the ``pool`` it is part of."""
    strata, small, _ = _pooling(histogram, risk, delta)
    held = {s for s, _ in cutoffs}
    return {s: "pool" if s in small else "own" for s in strata if s in held}


def pooled_cutoffs(
    histogram: Mapping[tuple[str, str], Mapping[int, int]], risk: float, delta: float
) -> dict[tuple[str, str], float]:
    """Cutoff per (stratum, rule), where strata too small to certify alone share those of their pool.

    Only the numbers of clean documents decide which strata are pooled, never their measures.
    """
    _, small, tests = _pooling(histogram, risk, delta)
    if not small:
        return certified_cutoffs(histogram, risk, delta, tests)
    pool: dict[tuple[str | None, str], dict[int, int]] = {}
    for (s, rule), counts in histogram.items():
        own = pool.setdefault((None if s in small else s, rule), {})
        for step, n in counts.items():
            own[step] = own.get(step, 0) + n
    cut = certified_cutoffs(pool, risk, delta, tests)
    found = {(s, rule): cut.get((None if s in small else s, rule)) for s, rule in histogram}
    return {key: c for key, c in found.items() if c is not None}


def certified_cutoffs(
    histogram: Mapping[tuple[str | None, str], Mapping[int, int]], risk: float, delta: float, strata: int
) -> dict[tuple[str | None, str], float]:
    """Cutoff per (stratum, rule) from counts of clean documents per step of the grid.

    ``risk`` is shared by the rules, so that all rules together reject at most that share.
    """
    alpha, each = _shares(risk, delta, strata)
    out = {}
    for key, counts in histogram.items():
        n, above = sum(counts.values()), 0
        for step in range(N_CUTOFFS, -1, -1):  # cutoff step / N_CUTOFFS rejects what lies above
            above += counts.get(step + 1, 0)
            if rejection_bound(above, n, alpha) > each:
                break
            out[key] = step / N_CUTOFFS
    return out


def _stratum(row: Column, by: str) -> Column:
    return F.coalesce(row[by].cast("string"), F.lit(""))


def _share(rule: str) -> Column:
    return F.expr(RULES[rule].replace("n_", "m.n_").replace("word_chars", "m.word_chars"))


def learn_cutoffs(
    counted: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, delta: float = 0.05
) -> dict[tuple[str, str], float]:
    """The cutoffs of :func:`learn`."""
    return learn(counted, labels, stratum, risk, delta)[0]


def learn(
    counted: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, delta: float = 0.05
) -> tuple[dict[tuple[str, str], float], dict[str, str]]:
    """Certified cutoffs from all documents labelled clean (quality 1) that pass the base rules.

    The second result says per stratum whose bound they keep.

    A document labelled twice is clean if any label says so. What returns to the driver is one
    count per stratum, rule and step of the grid.
    """
    clean = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("l_id")).distinct()
    held = counted.filter(~base_failed(F.col("m"))).join(clean, F.col("row")["doc_id"] == F.col("l_id"))
    steps = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.least(F.ceil(_share(name) * N_CUTOFFS), F.lit(N_CUTOFFS + 1)).cast("int").alias("step"),
            )
            for name in RULES
        ]
    )
    rows = (
        held.select(_stratum(F.col("row"), stratum).alias("stratum"), F.inline(steps))
        .groupBy("stratum", "rule", "step")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    histogram: dict[tuple[str, str], dict[int, int]] = {}
    for r in rows:
        histogram.setdefault((r.stratum, r.rule), {})[r.step] = r.n
    cutoffs = pooled_cutoffs(histogram, risk, delta)
    return cutoffs, bounds(histogram, cutoffs, risk, delta)


def verdict(cutoffs: Mapping[tuple[str, str], float], stratum: str = "lang") -> Column:
    """True unless a base rule fails or a measure exceeds the cutoff of its stratum."""
    fails = base_failed(F.col("m"))
    for name in RULES:
        known = {s: c for (s, r), c in cutoffs.items() if r == name}
        if known:
            table = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
            cutoff = F.try_element_at(table, _stratum(F.col("row"), stratum))
            above = F.ceil(_share(name) * N_CUTOFFS) > F.round(cutoff * N_CUTOFFS)
            fails = fails | F.coalesce(above, F.lit(False))
    return ~fails


def bound_of(held: Mapping[str, str], stratum: str = "lang") -> Column:
    """Whose bound holds for a row's stratum: ``own``, ``pool``, or ``none`` without any cutoff."""
    if not held:
        return F.lit("none")
    table = F.create_map(*[F.lit(x) for pair in sorted(held.items()) for x in pair])
    return F.coalesce(F.try_element_at(table, _stratum(F.col("row"), stratum)), F.lit("none"))


def _slim(docs: DataFrame, stratum: str) -> DataFrame:
    """The measures of every row beside its id and stratum, written once."""
    row = F.col("row")
    counted = measured(docs.select("doc_id", stratum, "text"))
    return stage(
        counted.select(F.struct(row["doc_id"].alias("doc_id"), row[stratum].alias(stratum)).alias("row"), "m"),
        "rule-measures",
    )


def judge(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, delta: float = 0.05
) -> DataFrame:
    """As :func:`apply_rules`, with ids and strata alone in ``row``; every text is measured once."""
    slim = _slim(docs, stratum)
    return _judged(slim, *learn(slim, labels, stratum, risk, delta), stratum)


def _judged(
    counted: DataFrame, cutoffs: Mapping[tuple[str, str], float], held: Mapping[str, str], stratum: str
) -> DataFrame:
    return counted.select(
        "row", "m", base_failed(F.col("m")).alias("base_failed"), verdict(cutoffs, stratum).alias("kept"),
        bound_of(held, stratum).alias("bound"),
    )


def apply_rules(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, delta: float = 0.05
) -> DataFrame:
    """(row, m, base_failed, kept, bound) for every row of ``docs``; ``row`` holds the input columns.

    NULL and empty texts have no words and fail the base rules. Strata without enough clean
    documents to certify any cutoff share those of their pool; one without any, or with a pool that
    is too small as well, keeps everything that passes the base rules. ``bound`` says which of these
    holds for the row: ``own``, ``pool`` or ``none``. A NULL stratum is a stratum. Repeated rows are
    judged alike. An empty table gives an empty result.

    The texts are measured twice, for the cutoffs and beside their rows, as that is less than to join
    them; :func:`judge` measures them once and leaves them out.
    """
    learnt = learn(_slim(docs, stratum), labels, stratum, risk, delta)
    return _judged(measured(docs), *learnt, stratum)
