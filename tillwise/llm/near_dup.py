"""MinHash near-dedup: ProbMinHash over weighted shingles, banding and exact verification.

The similarity is the probability Jaccard index of two weight vectors: the chance that an
exponential race, run with the same random arrivals for both, is won by the same shingle. A
shingle of five words weighs as often as it occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tillwise.llm.blocks import Block, blocks, mix
from tillwise.llm.common import batches_of, text_mark, whole_text
from tillwise.llm.components import connected
from tillwise.sources.staging import stage

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 40, 6  # a pair at 0.8 shares no band with probability (1 - 0.8**6)**40 = 5e-6
MORE_HUBS = 1  # rounds of random hubs after the first; they only spare the exact pass work
PAIR_TURNS = 2  # rounds of one pair a node in the exact pass; they only spare it pairs inside a component
HUB_PAIRS = 256  # pairs for which a text is sent once
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(block: Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of the distinct shingles of every text, by text.

    A text with fewer words than a shingle is one shingle; a text without words has none.
    """
    hashes = block.word_hashes()
    first, found = block.windows(hashes, size)
    doc = block.doc[first]
    short = np.flatnonzero((block.n_words > 0) & (block.n_words < size))
    if len(short):
        begins = np.searchsorted(block.doc, short)
        whole = np.zeros(len(short), np.uint64)
        for i in range(size - 1):
            there = block.n_words[short] > i
            word = hashes[np.where(there, begins + i, 0)]
            whole = np.where(there, mix(whole + word + _STEP), whole)
        doc, found = np.concatenate((doc, short)), np.concatenate((found, whole))
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    begins = np.flatnonzero(fresh)
    weights = np.diff(np.append(begins, len(doc)))
    return doc[begins], found[begins], weights.astype(np.float64)


def prob_minhash(
    doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int
) -> np.ndarray:
    """Signatures of ``m`` winning elements per text.

    Every element sends arrivals of a Poisson process whose rate is its weight; each arrival
    falls on a random component, which keeps the earliest. An element stops as soon as its next
    arrival comes after the latest component of its text, as nothing can change any more.
    """
    best = np.full(n_docs * m, np.inf)
    winner = np.zeros(n_docs * m, np.uint64)
    latest = np.full(n_docs, np.inf)
    at = np.zeros(len(element))
    salt = np.array([0], np.uint64)
    turn = 0
    while len(element):
        salt = salt + _STEP
        draw = mix(element + salt)
        at = at - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        on = at < latest[doc]
        if not on.all():
            doc, element, weight, at, draw = doc[on], element[on], weight[on], at[on], draw[on]
        slot = ((mix(draw + _STEP) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        slot += doc * m
        early = at < best[slot]
        where, when, who = slot[early], at[early], element[early]
        np.minimum.at(best, where, when)
        won = best[where] == when
        winner[where[won]] = who[won]
        turn += 1
        if turn < 8 or turn % 8 == 0:
            live = doc[np.concatenate(([True], doc[1:] != doc[:-1]))] if len(doc) else doc
            latest[live] = best.reshape(n_docs, m)[live].max(1)
    return winner.reshape(n_docs, m)


def probability_jaccard(
    a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray
) -> float:
    """Exact similarity of two weighted sets with distinct elements."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    x, y = wa[ia], wb[ib]
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    low = np.searchsorted(ratio, ratio, "left")
    x_from = np.concatenate((np.cumsum(x[::-1])[::-1], [0.0]))[low]
    y_below = np.concatenate(([0.0], np.cumsum(y)))[low]
    only_x, only_y = wa.sum() - x.sum(), wb.sum() - y.sum()
    return float((1 / ((x_from + only_x) / x + (y_below + only_y) / y)).sum())


def _content(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell word sequences apart; texts without words share one value."""
    hashes = block.word_hashes()
    begins = np.concatenate(([0], np.cumsum(block.n_words)))[:-1]
    place = (np.arange(len(hashes)) - begins[block.doc]).astype(np.uint64)
    out = []
    for salt in (np.uint64(17), np.uint64(71)):
        values = mix(mix(hashes + salt) + place * _STEP)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
        total = sums[begins + block.n_words] - sums[begins]
        out.append(mix(total + block.n_words.astype(np.uint64) + salt).view(np.int64))
    return out[0], out[1]


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, c1, c2, bands): content key and band hashes of every whole text."""
    packed = docs.select("doc_id", text_mark().alias("mark"), whole_text().alias("text"))
    schema = T.StructType(
        [
            packed.schema["doc_id"],
            packed.schema["mark"],
            T.StructField("c1", T.LongType()),
            T.StructField("c2", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, block in blocks(batch.column("text"), 2 << 20):
                c1, c2 = _content(block)
                signature = prob_minhash(*shingles(block), block.n, BANDS * ROWS)
                rows = signature.reshape(block.n, BANDS, ROWS)
                key = np.zeros((block.n, BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for i in range(ROWS):
                    key = mix(key * _STEP + rows[:, :, i])
                width = np.where(block.n_words > 0, BANDS, 0)
                ends = np.concatenate(([0], np.cumsum(width))).astype(np.int32)
                flat = key[block.n_words > 0].view(np.int64).ravel()
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(low, block.n),
                        batch.column("mark").slice(low, block.n),
                        pa.array(c1),
                        pa.array(c2),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    names=["doc_id", "mark", "c1", "c2", "bands"],
                )

    return packed.mapInArrow(run, schema)


def _weighted(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, block in blocks(texts):
        doc, element, weight = shingles(block)
        cuts = np.searchsorted(doc, np.arange(block.n + 1))
        yield from ((element[a:b], weight[a:b]) for a, b in zip(cuts, cuts[1:]))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Those (x, y) pairs of nodes whose similarity reaches the threshold, computed exactly.

    The end of a pair that is in more pairs is its hub. A hub's pairs are dealt into runs of about
    ``HUB_PAIRS``; in front of each run its text comes once and the others stream past it.
    """
    ends = pairs.select(F.explode(F.array("x", "y")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    left = ends.select(F.col("node").alias("x"), F.col("n").alias("n_x"))
    right = ends.select(F.col("node").alias("y"), F.col("n").alias("n_y"))
    flip = F.col("n_x") > F.col("n_y")
    dealt = (
        pairs.join(left, "x").join(right, "y")
        .select(
            F.when(flip, F.col("x")).otherwise(F.col("y")).alias("hub"),
            F.when(flip, F.col("y")).otherwise(F.col("x")).alias("member"),
            F.ceil(F.greatest("n_x", "n_y") / HUB_PAIRS).alias("runs"),
        )
        .select("hub", F.pmod(F.xxhash64("member"), F.col("runs")).alias("run"), "member")
    )
    members = dealt.join(texts.select(F.col("node").alias("member"), "text"), "member")
    hubs = dealt.select("hub", "run").distinct().join(texts.select(F.col("node").alias("hub"), "text"), "hub")
    lined = members.select("hub", "run", "member", "text").unionByName(
        hubs.select("hub", "run", F.lit(None).cast("long").alias("member"), "text")
    )
    lined = lined.repartition("hub", "run").sortWithinPartitions("hub", "run", F.asc_nulls_first("member"))
    schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = None
        for batch in batches:
            near = []
            for first, own in zip(batch.column("member").is_null().to_pylist(), _weighted(batch.column("text"))):
                if first:
                    hub = own
                near.append(not first and probability_jaccard(*hub, *own) >= threshold - 1e-12)
            met = pa.record_batch([batch.column("hub"), batch.column("member")], names=["x", "y"])
            yield met.filter(pa.array(near, pa.bool_()))

    return lined.mapInArrow(run, schema)


def _shingle_rows(nodes: DataFrame) -> DataFrame:
    """(node, comp, shingle, weight) of the texts of some nodes."""
    schema = T.StructType(
        [
            nodes.schema["node"],
            nodes.schema["comp"],
            T.StructField("shingle", T.LongType()),
            T.StructField("weight", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, block in blocks(batch.column("text")):
                doc, element, weight = shingles(block)
                rows = batch.select(["node", "comp"]).take(pa.array(doc + low))
                yield pa.record_batch(
                    [*rows.columns, pa.array(element.view(np.int64)), pa.array(weight)],
                    names=["node", "comp", "shingle", "weight"],
                )

    return nodes.select("node", "comp", "text").mapInArrow(run, schema)


def unsettled_pairs(mixed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Candidate pairs (x, y, met) between components among the nodes of mixed buckets.

    If texts of weights m and x meet in shingles that weigh M in one and X in the other, their
    similarity is at most 1 / (m / M + x / X - 1). Under any common order of shingles nothing
    before the first shared one is met, which bounds M and X; and a shared shingle weighs at
    most as much more in one text as that text repeats shingles, which bounds M by X and X by M.
    The order is by rarity, and a pair is formed only on a shingle at which the bound still
    allows the threshold: a passage that many documents share makes no pairs, and texts with
    much of their own drop out. Within a shingle, pairs are formed against its largest
    component, never inside one. ``met`` counts the shingles at which a pair was formed.
    """
    rows = stage(_shingle_rows(mixed), "shingles")
    spread = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("df"), F.min("comp").alias("lo"), F.max("comp").alias("hi")
    )
    ranked = rows.join(spread, "shingle")
    by_node = Window.partitionBy("node")
    before = F.sum("weight").over(
        by_node.orderBy("df", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    )
    most = 1 / threshold + 1 + 1e-9
    total = F.sum("weight").over(by_node)
    prefix = (
        ranked.withColumn("rest", total - F.coalesce(before, F.lit(0.0)))  # can still be met
        .withColumn("total", total)
        .withColumn("extra", F.col("total") - F.count(F.lit(1)).over(by_node))  # by repeats
        .filter((F.col("total") / F.col("rest") + 1 <= most) & (F.col("lo") != F.col("hi")))
        .select("shingle", "node", "comp", "total", "rest", "extra")
    )
    prefix = stage(prefix, "prefixes")
    largest = (
        prefix.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("shingle").agg(F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
        .filter("comps > 1")
        .select("shingle", F.col("top.comp").alias("major"))
    )
    minor = prefix.join(largest, "shingle").filter(F.col("comp") != F.col("major")).drop("major")
    other = prefix.select("shingle", *[F.col(c).alias(f"{c}2") for c in prefix.columns if c != "shingle"])
    met_here = F.least("rest", F.col("rest2") + F.col("extra"))
    met_there = F.least("rest2", F.col("rest") + F.col("extra2"))
    near = F.col("total") / met_here + F.col("total2") / met_there <= most
    met = minor.join(other, (minor["shingle"] == other["shingle"]) & (F.col("comp") != F.col("comp2")) & near)
    ends = F.least("node", "node2").alias("x"), F.greatest("node", "node2").alias("y")
    return met.groupBy(*ends).agg(F.count(F.lit(1)).alias("met"))


def _first_hubs(shared: DataFrame) -> DataFrame:
    """Pairs (x, y) of each node with the least hub of its buckets, one per node."""
    met = shared.filter("node != hub").groupBy("node").agg(F.min("hub").alias("hub"))
    return met.select(F.col("hub").alias("x"), F.col("node").alias("y"))


def _parted(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(key, node, hub, comp) of the buckets that hold several components."""
    roots = found.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labelled = shared.join(roots, "node", "left")
    labelled = labelled.select("key", "node", "hub", F.coalesce("root", "node").alias("comp"))
    spread = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return labelled.join(spread.filter("lo != hi").select("key"), "key", "left_semi")


def _own_hubs(parted: DataFrame) -> DataFrame:
    """Pairs (x, y) of each node with the hub of its bucket, if their components differ."""
    hubs = parted.filter("node = hub").select("key", F.col("comp").alias("hub_comp"))
    met = parted.join(hubs, "key").filter("comp != hub_comp")
    return met.select(F.col("hub").alias("x"), F.col("node").alias("y")).distinct()


def _other_hubs(parted: DataFrame, turn: int) -> DataFrame:
    """Pairs (x, y) of each member with a random one of its bucket, if their components differ."""
    draw = F.struct(F.xxhash64(F.lit(turn), "key", "node").alias("draw"), "node", "comp")
    drawn = parted.groupBy("key").agg(F.min(draw).alias("other"))
    met = parted.join(drawn, "key").filter(F.col("comp") != F.col("other.comp"))
    other = F.col("other.node")
    return met.select(F.least("node", other).alias("x"), F.greatest("node", other).alias("y")).distinct()


def _linked(pairs: DataFrame, found: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Components ``found`` with the links among ``pairs``, which need no look inside a component.

    In the first turns a node meets only the partner with which it shares most: in a dense group
    that joins most of it, and what then lies in one component is not compared. All the rest follows.
    """
    draw = F.struct("met", F.xxhash64("x", "y"))
    for _ in range(PAIR_TURNS):
        best = [
            pairs.groupBy(n).agg(F.max_by(o, draw).alias(o)).select("x", "y") for n, o in (("x", "y"), ("y", "x"))
        ]
        some = stage(best[0].union(best[1]).distinct(), "pairs")
        found = connected(found.union(verified(some, texts, threshold)))
        left, right = (found.select(F.col("a").alias(n), F.col("b").alias(f"{n}_comp")) for n in ("x", "y"))
        apart = F.coalesce("x_comp", "x") != F.coalesce("y_comp", "y")
        labelled = pairs.join(some, ["x", "y"], "left_anti").join(left, "x", "left").join(right, "y", "left")
        pairs = stage(labelled.filter(apart).select("x", "y", "met"), "pairs")
    return connected(found.union(verified(pairs.select("x", "y"), texts, threshold)))


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, mark, class_id, class_size, is_first) per row of ``docs``.

    Rows are in one class if a chain of links joins them: equal word sequences, or a
    probability Jaccard of five-word shingles of at least the threshold. ``class_id`` is the
    least doc_id of the class (NULL only if all are NULL); ``is_first`` marks the rows with the
    least (doc_id, mark), ``mark`` telling texts under one id apart; classes whose least ids are
    equal, as different texts share an id, also share the ``class_id``. Texts without words (NULL,
    empty, blank) are one class; texts of fewer than five words are one shingle. No bucket is
    capped: members are compared with hubs, and members of components that stay apart by their
    rare shingles.
    """
    with batches_of(docs.sparkSession, 1000):  # every job that runs Python runs in here
        return _near_classes(docs, threshold)


def _near_classes(docs: DataFrame, threshold: float) -> DataFrame:
    sketches = stage(sketched(docs), "sketches")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    copies = sketches.groupBy("c1", "c2").agg(
        F.min(key).alias("rep"), F.count(F.lit(1)).alias("n"), F.any_value("bands").alias("bands")
    )
    # Distinct texts get a number, fixed once written: eight bytes travel where hashes would.
    numbered = copies.withColumn("node", F.monotonically_increasing_id())
    reps = stage(numbered, "representatives")
    buckets = reps.select("node", F.explode("bands").alias("key"))
    hubs = buckets.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    shared = stage(
        buckets.join(hubs.filter("hub != last").drop("last"), "key").select("key", "node", "hub"), "buckets"
    )
    wanted = shared.select("node").distinct()
    wanted = wanted.join(reps.select("node", "rep"), "node").select(
        "node", F.col("rep.doc_id").alias("r_id"), F.col("rep.mark").alias("r_mark")
    )
    whole = docs.select(F.col("doc_id").alias("d_id"), text_mark().alias("d_mark"), whole_text().alias("text"))
    texts = stage(
        whole.join(wanted, F.col("d_id").eqNullSafe(F.col("r_id")) & (F.col("d_mark") == F.col("r_mark")))
        .groupBy("node")
        .agg(F.any_value("text").alias("text")),
        "texts",
    )
    pairs = stage(_first_hubs(shared), "pairs")
    seen, found = pairs, connected(verified(pairs, texts, threshold))
    for turn in range(MORE_HUBS + 1):
        parted = _parted(shared, found)
        again = _other_hubs(parted, turn - 1) if turn else _own_hubs(parted)
        again = stage(again.join(seen, ["x", "y"], "left_anti"), "pairs")
        seen = seen.union(again)
        found = connected(found.union(verified(again, texts, threshold)))
    mixed = _parted(shared, found).select("node", "comp").distinct()
    mixed = stage(mixed.join(texts, "node"), "mixed")
    if not mixed.isEmpty():
        rest = stage(unsettled_pairs(mixed, threshold).join(seen, ["x", "y"], "left_anti"), "pairs")
        found = _linked(rest, found, texts, threshold)
    rooted = reps.drop("bands").join(
        found.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left"
    ).withColumn("root", F.coalesce("root", "node"))
    classes = rooted.groupBy("root").agg(F.min("rep").alias("first"), F.sum("n").alias("class_size"))
    named = rooted.select("c1", "c2", "root").join(classes, "root").drop("root")
    return sketches.drop("bands").join(named, ["c1", "c2"]).select(
        "doc_id",
        "mark",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        key.eqNullSafe(F.col("first")).alias("is_first"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, the first; of equal rows one stays."""
    first = near_classes(docs, threshold).filter("is_first").select(
        F.col("doc_id").alias("k_id"), F.col("mark").alias("k_mark")
    ).distinct()
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d_id"), text_mark().alias("d_mark"))
    met = packed.join(first, F.col("d_id").eqNullSafe(F.col("k_id")) & (F.col("d_mark") == F.col("k_mark")), "left_semi")
    one = Window.partitionBy("d_id", "d_mark").orderBy(F.xxhash64("row"))
    return met.withColumn("n", F.row_number().over(one)).filter("n = 1").select("row.*")
