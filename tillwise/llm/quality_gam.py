"""Quality classifier: a generalised additive model with pairwise interactions.

Features are binned; one lookup table per feature, and one per chosen pair, is learnt by
boosting shallow trees in turn over the features. A score is the sum of the table entries a
document's bins point to. The fit sees at most ``max_rows`` labelled rows; scoring runs over
every whole text in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.blocks import IS_SPACE, Block, blocks, byte_set
from tillwise.llm.common import passed_through, remainder
from tillwise.llm.quality_rules import duplicate_lines, repeated_words
from tillwise.sources.staging import stage

MAX_ROWS = 20_000
_CLASSES = {
    "symbols": byte_set("#*$%&<>@^~=+_\\"),
    "bars": byte_set("|"),
    "shouts": byte_set("!?"),
    "stops": byte_set(".,;:"),
    "digits": byte_set("0123456789"),
    "upper": byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "quotes": byte_set("\"'`()[]{}"),
    "vowels": byte_set("aeiouAEIOU"),
    "wide": np.arange(256) >= 128,
    "breaks": byte_set("\n"),
}
FEATURES = (
    *_CLASSES, "log_words", "word_length", "long_words", "distinct_share", "top_share",
    "adjacent_share", "repeat_share", "dup_lines",
)


def _sorted_runs(block: Block, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct words, and how often the most frequent one occurs."""
    order = np.lexsort((hashes, block.doc))
    doc, ordered = block.doc[order], hashes[order]
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]) | (doc[1:] != doc[:-1])
    begins = np.flatnonzero(fresh)
    lengths = np.diff(np.append(begins, len(ordered)))
    top = np.zeros(block.n, np.int64)
    np.maximum.at(top, doc[begins], lengths)
    return np.bincount(doc[begins], minlength=block.n), top


def features(block: Block) -> np.ndarray:
    """One row per text, one column per entry of ``FEATURES``; empty texts are all zero."""
    hashes = block.word_hashes()
    words = np.maximum(block.n_words, 1)
    chars = np.maximum(block.per_doc(~IS_SPACE[block.data]), 1)
    columns = [block.per_doc(flags[block.data]) / chars for flags in _CLASSES.values()]
    lengths = block.ends - block.starts
    adjacent = np.zeros(len(hashes), bool)
    adjacent[1:] = (hashes[1:] == hashes[:-1]) & (block.doc[1:] == block.doc[:-1])
    distinct, top = _sorted_runs(block, hashes)
    dup, n_lines = duplicate_lines(block)
    columns += [
        np.log1p(block.n_words),
        np.bincount(block.doc, weights=lengths, minlength=block.n) / words,
        np.bincount(block.doc[lengths > 20], minlength=block.n) / words,
        distinct / words,
        top / words,
        np.bincount(block.doc[adjacent], minlength=block.n) / words,
        repeated_words(block, hashes) / words,
        dup / np.maximum(n_lines, 1),
    ]
    return np.column_stack(columns)


def featured(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, x): the input columns and the feature vector of every row."""
    packed = passed_through(docs, text=F.col(text))
    schema = T.StructType([packed.schema["row"], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, block in blocks(batch.column("text")):
                x = features(block)
                flat = pa.array(x.ravel())
                at = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
                yield pa.record_batch(
                    [batch.column("row").slice(low, block.n), pa.ListArray.from_arrays(at, flat)],
                    names=["row", "x"],
                )

    return packed.mapInArrow(run, schema)


@dataclass
class Model:
    """Bin edges per feature, a table per feature, and a table per pair over coarser bins."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        total = np.full(len(x), self.intercept)
        for j, (edge, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edge, x[:, j], "right")]
        coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.coarse)]
        for (a, b), values in zip(self.pairs, self.pair_tables):
            total += values[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: float, h: float) -> float:
    return g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, place) of the best split of a run of bins."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl * gl / (hl + 1) + gr * gr / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
    gain[(hl < 0.5) | (hr < 0.5)] = 0
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of depth two over ordered bins, as a value per bin."""
    out = np.zeros(len(g))

    def grow(low: int, high: int, depth: int) -> None:
        gain, at = _cut(g[low:high], h[low:high]) if depth else (0.0, 0)
        if gain > 1e-9:
            grow(low, low + at, depth - 1)
            grow(low + at, high, depth - 1)
        else:
            out[low:high] = _leaf(g[low:high].sum(), h[low:high].sum())

    grow(0, len(g), 2)
    return out


def _cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut on one axis, then one on the other in each half; (gain, value per cell)."""
    best, values = 0.0, np.zeros(g.shape)
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        _, at = _cut(a.sum(1), b.sum(1))
        if not at:
            continue
        gain, out = -(g.sum() ** 2) / (h.sum() + 1), np.zeros(a.shape)
        for rows in (slice(0, at), slice(at, None)):
            gs, hs = a[rows].sum(0), b[rows].sum(0)
            _, col = _cut(gs, hs)
            for cols in (slice(0, col), slice(col, None)) if col else (slice(None),):
                cell_g, cell_h = gs[cols].sum(), hs[cols].sum()
                out[rows, cols] = _leaf(cell_g, cell_h)
                gain += cell_g**2 / (cell_h + 1)
        if gain > best:
            best, values = gain, out if axis == 0 else out.T
    return best, values


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.2, bins: int = 32, n_pairs: int = 6
) -> Model:
    """Boost one shallow tree per feature in every round, then the same for the best pairs.

    With labels of one kind only, the model is that share smoothed, for every text.
    """
    n, d = x.shape if len(x) else (0, len(FEATURES))
    mean = (y.sum() + 1.0) / (n + 2.0)
    model = Model(float(np.log(mean / (1 - mean))), [], [], [], [], [])
    model.edges = [_edges(x[:, j], bins) if n else np.zeros(0) for j in range(d)]
    model.coarse = [_edges(x[:, j], 8) if n else np.zeros(0) for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if n == 0 or y.min() == y.max():
        return model
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    total = np.full(n, model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(d):
            size = len(model.tables[j])
            if size < 2:
                continue
            g, h = slopes()
            step = rate * _shallow_tree(
                np.bincount(at[j], g, minlength=size), np.bincount(at[j], h, minlength=size)
            )
            model.tables[j] += step
            total += step[at[j]]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]

    def cells(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        where = coarse[a] * shape[1] + coarse[b]
        g, h = slopes()
        size = shape[0] * shape[1]
        return (
            np.bincount(where, g, minlength=size).reshape(shape),
            np.bincount(where, h, minlength=size).reshape(shape),
            where,
        )

    ranked = sorted(
        ((_cross_tree(*cells(a, b)[:2])[0], a, b) for a in range(d) for b in range(a + 1, d)),
        key=lambda r: (-r[0], r[1:]),
    )
    model.pairs = [(a, b) for gain, a, b in ranked[:n_pairs] if gain > 0]
    model.pair_tables = [np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(rounds // 4):
        for i, (a, b) in enumerate(model.pairs):
            g, h, where = cells(a, b)
            step = rate * _cross_tree(g, h)[1]
            model.pair_tables[i] += step
            total += step.ravel()[where]
    return model


def learn(vectors: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on the labelled rows of ``vectors`` (row.doc_id, x) that are not held out.

    At most ``max_rows`` rows are used, those with the smallest hashed ids. NULL ids and
    labels other than 0 and 1 are no training rows; of contradicting labels the smaller counts.
    """
    marked = (
        labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL")
        .filter(remainder("doc_id", 4) != 2)
        .groupBy(F.col("doc_id").alias("l_id"))
        .agg(F.min("quality").alias("y"))
        .orderBy(F.xxhash64("l_id"), "l_id")
        .limit(max_rows)
    )
    rows = (
        vectors.join(marked, F.col("row")["doc_id"] == F.col("l_id"))
        .select("l_id", "x", "y")
        .orderBy(F.xxhash64("l_id"), "l_id", "x")
        .limit(max_rows)
        .collect()
    )
    x = np.array([r.x for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r.y for r in rows], float))


def score_vectors(vectors: DataFrame, model: Model) -> DataFrame:
    """Adds ``score`` to (row, x)."""
    schema = T.StructType([*vectors.schema, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.record_batch(
                [*batch.columns, pa.array(model.scores(x), pa.float64())],
                names=[*batch.schema.names, "score"],
            )

    return vectors.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(row, x, score) for every row of ``docs`` (doc_id and text are read).

    NULL and empty texts have the all-zero vector and are scored like any other; repeated rows
    get one score; without labels every score is one half; empty tables give empty results.
    Labels, language, source and id are never inputs of a score.
    """
    vectors = stage(featured(docs.select("doc_id", "text")).select(
        F.struct(F.col("row")["doc_id"].alias("doc_id")).alias("row"), "x"
    ), "quality-features")
    return score_vectors(vectors, learn(vectors, labels, max_rows))
