"""Mixing sources to target weights by hierarchical budgets.

A token budget flows down a tree of domains, languages and sources. Siblings share their
parent's budget by weight; one that has too little to give is used up, and what it leaves goes
to its siblings first. Only if all of them are used up does the shortage reach the next level,
because a subtree never claims more than it holds. Each leaf then takes whole epochs and a
prefix, measured in tokens, of the seeded order of one more.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwise.llm.common import text_mark, whole_text
from tillwise.sources.staging import stage

LEVELS = ("domain", "lang", "source")
# Domains of the benchmark's sources; any other source is of the domain "other".
DOMAINS = {
    **{f"src{i}": "web" for i in range(0, 10)},
    **{f"src{i}": "reference" for i in range(10, 15)},
    **{f"src{i}": "forum" for i in range(15, 20)},
}
# Weights among siblings by path; whatever is not named weighs 1.
WEIGHTS = {"web": 5, "reference": 3, "forum": 2, "web/en": 3, "reference/en": 2, "web/en/src0": 4}
MAX_EPOCHS = 3
SEED = "mix-1"
EDGE_ROWS = 4096  # so many places of a leaf are ordered in one task
PLACE_DIGITS, _DIGITS = 48, 3


def domain_of(source: Column, domains: Mapping[str, str] = DOMAINS) -> Column:
    table = F.create_map(*[F.lit(x) for pair in sorted(domains.items()) for x in pair])
    return F.coalesce(F.try_element_at(table, source), F.lit("other"))


def token_count(text: Column) -> Column:
    """Words separated by ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _keyed(docs: DataFrame, domains: Mapping[str, str]) -> list[Column]:
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return [
        domain_of(name("source"), domains).alias("t_domain"),
        name("lang").alias("t_lang"),
        name("source").alias("t_source"),
    ]


_PATH = [f"t_{level}" for level in LEVELS]


def shared_out(nodes: DataFrame, siblings: list[str], name: str) -> DataFrame:
    """Adds ``share``: the part of ``budget`` that each sibling gets by weight, up to its capacity.

    In the order of capacity per weight, siblings are used up one after the other until what
    is left, shared by the weight that is left, stays below the next one's capacity.
    """
    group = Window.partitionBy(*siblings)
    order = group.orderBy("ratio", name)
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    level = (
        nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf"))))
        .withColumn("at", F.row_number().over(order))
        .withColumn("used", F.coalesce(F.sum("capacity").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(group) - F.sum("weight").over(rest) + F.col("weight"))
        .withColumn("unit", F.when(F.col("left_weight") > 0, (F.col("budget") - F.col("used")) / F.col("left_weight")).otherwise(F.lit(0.0)))
        .withColumn("stop", F.min(F.when(F.col("ratio") > F.col("unit"), F.struct("at", "unit"))).over(group))
    )
    full = F.col("stop").isNull() | (F.col("at") < F.col("stop.at"))
    share = F.when(full, F.col("capacity").cast("double")).otherwise(F.col("stop.unit") * F.col("weight"))
    return level.withColumn("share", share).drop("ratio", "at", "used", "left_weight", "unit", "stop")


def budgets(
    leaves: DataFrame, budget: int | None, weights: Mapping[str, int], max_epochs: int
) -> DataFrame:
    """(t_domain, t_lang, t_source, available, target) from (path, available) rows.

    ``budget`` None asks for as many tokens as there are.
    """
    table = F.create_map(*[F.lit(x) for path, w in sorted(weights.items()) for x in (path, w)]) if weights else None
    total = leaves.agg(F.sum("available")).scalar()
    rows = leaves.withColumn("root", F.lit(0))
    rows = rows.withColumn("budget", (total if budget is None else F.lit(budget)).cast("double"))
    for depth in range(1, len(_PATH) + 1):
        path, parent = _PATH[:depth], ["root", *_PATH[: depth - 1]]
        named = F.concat_ws("/", *path)
        weight = F.coalesce(F.try_element_at(table, named), F.lit(1)) if weights else F.lit(1)
        nodes = rows.groupBy("root", *path).agg(
            (F.sum("available") * max_epochs).alias("capacity"), F.first("budget").alias("budget")
        )
        nodes = shared_out(nodes.withColumn("weight", weight.cast("long")), parent, path[-1])
        rows = rows.drop("budget").join(
            nodes.select("root", *path, F.col("share").alias("budget")), ["root", *path]
        )
    return rows.select(*_PATH, "available", F.floor("budget").cast("long").alias("target"))


def _place(seed: str) -> Column:
    """The row's place in the seeded order of the leaf's last, partial epoch, as hexadecimal digits.

    Rows under one id are told apart by their mark, the sign bit turned so that digits order it.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("epochs"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return F.concat(key, F.lpad(F.hex(F.col("mark").bitwiseXOR(F.lit(-(2**63)))), 16, "0"))


def plan(
    docs: DataFrame,
    budget: int | None = None,
    weights: Mapping[str, int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    domains: Mapping[str, str] = DOMAINS,
) -> tuple[DataFrame, DataFrame]:
    """(rows, leaves): the documents' tokens, and per leaf its target, epochs and cutoff.

    Places are cut into 4,096 ranges by their first digits. Sums per range find the one in which
    the prefix ends; as long as that of any leaf holds more than ``EDGE_ROWS`` places it is cut
    again by the next digits. Only the last range is ordered place by place.
    """
    rows = docs.select("doc_id", text_mark().alias("mark"), *_keyed(docs, domains), token_count(whole_text()).alias("n_tokens"))
    rows = stage(rows, "mix-rows")
    leaves = rows.groupBy(*_PATH).agg(F.sum("n_tokens").alias("available"))
    asked = budgets(leaves, budget, weights, max_epochs)
    epochs = F.when(F.col("available") > 0, F.floor(F.col("target") / F.col("available"))).otherwise(0).cast("long")
    asked = asked.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("available"))
    asked = stage(asked, "mix-budgets")
    keyed = rows.join(asked.select(*_PATH, "epochs"), _PATH).withColumn("place", _place(seed))
    edge = asked.select(*_PATH, "rest", F.lit("").alias("edge"), F.lit(0).cast("long").alias("before"))
    for digits in range(_DIGITS, PLACE_DIGITS + 1, _DIGITS):
        edge = stage(_narrowed(keyed, edge, digits), "mix-edges")
        if edge.filter(F.col("n") > EDGE_ROWS).isEmpty():
            break
    inside = keyed.join(edge, _PATH).filter(F.startswith("place", "edge"))
    places = inside.groupBy(*_PATH, "rest", "before", "place").agg(F.sum("n_tokens").alias("tokens"))  # equal rows go together
    upto = Window.partitionBy(*_PATH).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        places.withColumn("upto", F.col("before") + F.sum("tokens").over(upto))
        .filter(F.col("upto") <= F.col("rest")).groupBy(*_PATH).agg(F.max("place").alias("last"))
    )
    cutoffs = asked.join(edge.select(*_PATH, "edge"), _PATH, "left").join(last, _PATH, "left")
    return rows, stage(cutoffs, "mix-cutoffs")


def _narrowed(keyed: DataFrame, edge: DataFrame, digits: int) -> DataFrame:
    """Per leaf the range of so many digits in which the prefix ends, the tokens before it and its places.

    A range of equal places can't be cut and counts as one.
    """
    ranges = (
        keyed.join(edge.drop("n"), _PATH).filter(F.startswith("place", "edge"))
        .groupBy(*_PATH, "rest", "before", F.substring("place", 1, digits).alias("range"))
        .agg(
            F.sum("n_tokens").alias("tokens"),
            F.when(F.min("place") == F.max("place"), 1).otherwise(F.count(F.lit(1))).alias("n"),
        )
    )
    order = Window.partitionBy(*_PATH).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    upto = ranges.withColumn("upto", F.col("before") + F.sum("tokens").over(order)).filter(F.col("upto") > F.col("rest"))
    first = F.min(F.struct("range", (F.col("upto") - F.col("tokens")).alias("before"), "n")).alias("e")
    return upto.groupBy(*_PATH, "rest").agg(first).select(
        *_PATH, "rest", F.col("e.range").alias("edge"), "e.before", "e.n"
    )


def _copies(max_epochs: int) -> Column:
    """Whole epochs, and one more for rows of the prefix."""
    at_edge = F.startswith("place", "edge") & F.coalesce(F.col("place") <= F.col("last"), F.lit(False))
    inside = F.col("edge").isNull() | (F.col("place") < F.col("edge")) | at_edge
    return F.least(F.col("epochs") + inside.cast("long"), F.lit(max_epochs).cast("long"))


def allocate(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED, **options) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, available, target, copies) per row of ``docs``.

    ``copies`` says how often the row goes into the mix, 0 if not at all. A prefix never exceeds
    its leaf's budget. NULL languages and sources are the empty name; texts without words have
    no tokens and follow the order of the prefix; equal rows are taken together or not at all; an
    empty table gives an empty result.
    """
    rows, cutoffs = plan(docs, max_epochs=max_epochs, seed=seed, **options)
    return rows.join(cutoffs, _PATH).withColumn("place", _place(seed)).select(
        "doc_id", *[F.col(f"t_{level}").alias(level) for level in LEVELS],
        "n_tokens", "available", "target", _copies(max_epochs).alias("copies"),
    )


def mixed(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED, **options) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say; the texts are not shuffled."""
    _, cutoffs = plan(docs, max_epochs=max_epochs, seed=seed, **options)
    domains = options.get("domains", DOMAINS)
    packed = docs.select(F.struct("*").alias("row"), "doc_id", text_mark().alias("mark"), *_keyed(docs, domains))
    copies = packed.join(cutoffs, _PATH).withColumn("place", _place(seed)).withColumn("copies", _copies(max_epochs))
    return copies.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
