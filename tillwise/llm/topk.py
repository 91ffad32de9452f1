"""Exact top-k search by the three-phase uniform threshold.

A score is the sum of partial inner products over ``LISTS`` runs of components; each run is a
list that ranks the candidates on its own. Candidates lie in blocks of one direction and one
range of distances from it, which are split into cells of bounded size.

1. The cells of the blocks nearest to a query take the head of each of their local lists and add
   up the whole scores of what they find there. A cell's k-th best of these is its own cutoff,
   and the k-th best entry of all these cells is a lower bound of the k-th best score.
2. That bound goes out as the cutoff. No candidate of a block scores more than the query's product
   with the direction plus its length times the block's radius, nor than its length times the
   block's greatest length: blocks below the cutoff are skipped, their vectors do not move. In
   the others, a candidate whose partial scores all lie below the cutoff divided by the number
   of lists cannot reach it, whatever the signs, so each cell collects the entries at or above it
   in any list.
3. The scores of the collected candidates are added up exactly, and those that reach the cutoff
   are ranked, first in the cell, then over all cells.

A query meets every candidate at most once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwise.sources.staging import stage

LISTS = 2
DIRECTIONS, RINGS = 256, 8  # at most so many blocks: their table goes to every task
CELL_ROWS, CELL_BYTES = (2048, 16384), 64 << 20
QUERY_ROWS = 4096
_STEP = 1 << 22  # products held at once


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as a double; NULL unless all are finite numbers."""
    wide = vector.cast("array<double>")
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(wide, lambda x: F.floor(x * F.lit(float(scale))).cast("double")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _cell(queries: pd.DataFrame, rows: pd.DataFrame):
    """Yields (query positions, partial scores by list) in steps that bound the memory."""
    width = max(int(queries["vector"].map(len).max()), int(rows["vector"].map(len).max()), 1)
    q, c = _matrix(queries["vector"], width), _matrix(rows["vector"], width)
    cuts = [i * width // LISTS for i in range(LISTS + 1)]
    step = max(1, _STEP // len(c))
    for low in range(0, len(q), step):
        part = slice(low, low + step)
        yield np.arange(len(q))[part], [q[part, a:b] @ c[:, a:b].T for a, b in zip(cuts, cuts[1:])]


def _split(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    asks = pdf["asks"].to_numpy(bool)
    return pdf[asks].sort_values(["id", "rid"]), pdf[~asks].sort_values(["id", "rid"])


def _own_cutoffs(lists: list[np.ndarray], ids: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Per query the k-th best whole score among the heads of the cell's lists, else -inf."""
    same = np.searchsorted(own, ids, "right") - np.searchsorted(own, ids, "left")
    head = min(k + int(same.max()), len(own))  # a query's own rows take no place of the others
    heads = [np.argpartition(-p, head - 1, axis=1)[:, :head] for p in lists]
    out = np.full(len(ids), -np.inf)
    for i in range(len(ids)):
        there = np.unique(np.concatenate([h[i] for h in heads]))
        there = there[own[there] != ids[i]]
        if len(there) >= k:
            score = sum(p[i, there] for p in lists)
            out[i] = np.partition(score, len(score) - k)[len(score) - k]
    return out


def _entries(k: int):
    """Per query of a cell its best k entries that reach the cutoff, the cell's own if none is given."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        queries, rows = _split(pdf)
        found = []
        if len(queries) and len(rows):
            ids, own, rid = queries["id"].to_numpy(), rows["id"].to_numpy(), queries["rid"].to_numpy()
            given = queries["cutoff"].to_numpy(float)
            for at, lists in _cell(queries, rows):
                bound = given[at]
                if np.isnan(bound).any():
                    bound = _own_cutoffs(lists, ids[at], own, k)
                share = bound[:, None] / LISTS
                reach = lists[0] >= share
                for p in lists[1:]:
                    reach |= p >= share
                i, j = np.nonzero(reach)
                score = sum(p[i, j] for p in lists)
                good = (score >= bound[i]) & (ids[at][i] != own[j])
                i, j, score = i[good], j[good], score[good]
                order = np.lexsort((own[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                best = place < k
                found.append((rid[at][i[best]], ids[at][i[best]], own[j[best]], score[best]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], [], []]
        return pd.DataFrame(dict(zip(("rid", "id", "vec_id", "score"), columns)))

    return run


def _block_of(pivots: np.ndarray):
    """A vector's (block, distance, length): its nearest pivot, and its ring of distances around it."""

    def run(vectors: pd.Series) -> pd.DataFrame:
        x = _matrix(vectors, pivots.shape[1])
        nearest = np.empty(len(x), int)
        for low in range(0, len(x), 4096):
            part = x[low : low + 4096]
            nearest[low : low + 4096] = np.argmin((pivots**2).sum(1) - 2 * part @ pivots.T, axis=1)
        far = np.linalg.norm(x - pivots[nearest], axis=1)
        scale = np.linalg.norm(pivots[nearest], axis=1)
        ring = np.minimum((RINGS * far / (far + scale + 1)).astype(int), RINGS - 1)
        return pd.DataFrame({"block": nearest * RINGS + ring, "far": far, "length": np.linalg.norm(x, axis=1)})

    return F.pandas_udf(run, "block int, far double, length double")


class _Bounds:
    """What every task knows of the blocks: pivots, sizes, radii and greatest lengths."""

    def __init__(self, pivots: np.ndarray, blocks: list) -> None:
        blocks = sorted(blocks, key=lambda b: b.block)
        self.pivots = pivots
        self.block = np.array([b.block for b in blocks], int)
        self.rows = np.array([b.n for b in blocks], int)
        self.far = np.array([b.far for b in blocks], float)
        self.length = np.array([b.length for b in blocks], float)

    def _steps(self, vectors: pd.Series):
        for low in range(0, len(vectors), 512):
            q = _matrix(vectors.iloc[low : low + 512], self.pivots.shape[1])
            yield low, q, (q @ self.pivots.T)[:, self.block // RINGS]

    def nearest(self, least: int):
        """The blocks of the best directions, from the inside, that hold at least so many rows."""

        def run(vectors: pd.Series) -> pd.Series:
            out = []
            for _, _, product in self._steps(vectors):
                order = np.argsort(-product, axis=1, kind="stable")
                held = self.rows[order]
                take = held.cumsum(1) - held < least
                out += [self.block[o[t]] for o, t in zip(order, take)]
            return pd.Series(out, dtype=object)

        return F.pandas_udf(run, "array<int>")

    def reaching(self):
        """The blocks not yet met whose upper bound reaches the cutoff."""

        def run(vectors: pd.Series, cutoffs: pd.Series, met: pd.Series) -> pd.Series:
            out = []
            for low, q, product in self._steps(vectors):
                size = np.linalg.norm(q, axis=1)[:, None]
                bound = np.minimum(product + size * self.far, size * self.length)
                slack = 1e-9 * size * (self.length + 2 * self.far) + 1e-6  # rounding never skips a block
                reach = bound + slack >= cutoffs.to_numpy(float)[low : low + len(q), None]
                for i, mask in enumerate(reach):
                    out.append(np.setdiff1d(self.block[mask], np.asarray(met.iloc[low + i], int)))
            return pd.Series(out, dtype=object)

        return F.pandas_udf(run, "array<int>")


def cell_rows(n: int, width: int) -> int:
    """Rows of a cell: they grow with the root of the table, as each query goes to each cell that it
    meets, within what a task can hold."""
    return max(1, min(max(CELL_ROWS[0], 8 * math.isqrt(n)), CELL_ROWS[1], CELL_BYTES // (8 * width)))


def search(rows: DataFrame, k: int, every: int) -> tuple[DataFrame, DataFrame]:
    """(entries, visits) for stored rows (rid, id, vector).

    Entries (rid, id, vec_id, score) hold the k best of every query; visits (rid, block, n) say
    which blocks a query met and how many candidates they hold.
    """
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    width = max(size.width or 1, 1)
    per_cell = cell_rows(size.n, width)
    n_pivots = min(DIRECTIONS, math.ceil(size.n / per_cell))
    drawn = rows.orderBy(F.xxhash64(F.lit(3), "rid")).limit(n_pivots).select("vector").toPandas()["vector"]
    pivots = np.unique(_matrix(drawn, width), axis=0)
    placed = stage(
        rows.withColumn("at", _block_of(pivots)("vector")).select(
            "rid", "id", "vector", F.col("at.block").alias("block"), "at.far", "at.length"
        ),
        "placed",
    )
    blocks = placed.groupBy("block").agg(
        F.count(F.lit(1)).alias("n"), F.max("far").alias("far"), F.max("length").alias("length")
    )
    blocks = stage(blocks, "blocks")  # at most DIRECTIONS * RINGS rows
    bounds = _Bounds(pivots, blocks.collect())
    cells = F.ceil(F.col("n") / per_cell).cast("int").alias("cells")
    bucket = lambda count, salt: F.pmod(F.xxhash64(F.lit(salt), "rid"), F.col(count)).cast("int")
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def visited(asking: DataFrame) -> DataFrame:
        return asking.select("rid", "id", "vector", "cutoff", F.explode("blocks").alias("block"))

    def entries(asking: DataFrame) -> DataFrame:
        visits = visited(asking)
        parts = F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("parts")
        load = F.broadcast(visits.groupBy("block").agg(parts).join(blocks.select("block", cells), "block"))
        there = visits.join(load, "block").select(
            "block", spread("cells").alias("cell"), bucket("parts", 2).alias("part"), "rid", "id", "vector",
            "cutoff", F.lit(True).alias("asks"),
        )
        candidates = placed.join(load, "block").select(
            "block", bucket("cells", 1).alias("cell"), spread("parts").alias("part"), "rid", "id", "vector",
            F.lit(None).cast("double").alias("cutoff"), F.lit(False).alias("asks"),
        )
        met = candidates.unionByName(there).groupBy("block", "cell", "part")
        return met.applyInPandas(_entries(k), "rid long, id long, vec_id long, score double")

    asking = placed.filter(F.col("id") % every == 0).select("rid", "id", "vector")
    first = asking.withColumn("cutoff", F.lit(None).cast("double"))
    first = stage(first.withColumn("blocks", bounds.nearest(per_cell)("vector")), "first-blocks")
    near = stage(entries(first), "near-entries")
    order = Window.partitionBy("rid").orderBy(F.desc("score"))
    kth = near.withColumn("at", F.row_number().over(order)).filter(F.col("at") == k).select("rid", F.col("score").alias("kth"))
    cut = first.join(kth, "rid", "left").withColumn("cutoff", F.coalesce("kth", F.lit(float("-inf")))).drop("kth")
    rest = cut.withColumn("blocks", bounds.reaching()("vector", "cutoff", "blocks"))
    rest = stage(rest, "other-blocks")
    visits = visited(first).union(visited(rest)).select("rid", "block").join(blocks.select("block", "n"), "block")
    return near.unionByName(entries(rest)), visits


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id",
    vector_col: str = "embedding", each_row: bool = False,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query, ties by smaller id.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows with another
    id. Rows with a NULL id, a NULL vector, or a NULL or non-finite component take no part. Of
    rows with one id the least vector counts; with ``each_row`` all of them do, each as a candidate of
    its own, and the queries of one id share one ranking. A shorter vector ends in zeros. Scores are exact
    as long as partial sums stay below 2**53. A query with fewer candidates than k gets them
    all; an empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("vector"))
    rows = rows.filter("id IS NOT NULL AND vector IS NOT NULL")
    if not each_row:
        rows = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    # the row numbers are fixed once written
    rows = stage(rows.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    final, _ = search(rows, k, every)
    order = Window.partitionBy("id").orderBy(F.desc("score"), "vec_id")
    return final.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        F.col("id").alias("query_id"), "rank", "vec_id", F.col("score").cast("long").alias("score")
    )
