"""Secret scans: strong patterns, and weak parts linked where they complement each other.

A lone identifier, key-like string or endpoint is no finding. Parts are interval-joined within
a scope: two parts are linked if at most ``REACH`` code points lie between them. The lines of a broken
key are one part: key-like strings with at most ``ADJACENT`` code points between them. A weak part is
reported only if linked to one that completes it: an identifier or endpoint to a secret, a secret to
an identifier or endpoint. A key-like value right behind the name of an identifier (``client_id=...``)
is that identifier and no secret.

Java's matcher calls itself once per round of a repeated group, so a long text could exhaust the
stack of its thread: repeats here are of single character classes, or possessive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwise.llm.common import whole_text
from tillwise.sources.staging import stage

# The strong kinds in the order in which equal starts are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
ASSIGN_VALUE_CHARS = 6
# Weak kinds: what each looks like, and which part of a credential it is.
WEAK = {
    "identity": r"(?i)(?<![A-Za-z0-9_])(?:user(?:name)?|login|client_?id|account(?:_?id)?|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._-]{3,})",
    "login": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "keylike": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}={0,2}",
    "endpoint": r"(?i)(?<![A-Za-z0-9_])(?:https?|ftp|ssh|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D\"'<>]{3,}",
    "host": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?(?![0-9])",
}
PART = {
    "assign": "secret", "hex": "secret", "keylike": "secret",
    "access": "identifier", "identity": "identifier", "login": "identifier",
    "endpoint": "endpoint", "host": "endpoint",
}
ORDER = {kind: i for i, kind in enumerate([*BASE, *WEAK])}
VALUE_GROUP = {ASSIGN: 2, WEAK["identity"]: 1}  # patterns of a name and a value
REACH = 300
ADJACENT = 8  # line end, quotes and a small indent


def _lengths(text: Column, pattern: str) -> Column:
    """Per match: code points since the match before, of the match, and of its value.

    The text splits at the matches, so places are running sums of these lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    group = VALUE_GROUP.get(pattern, 0)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    both = F.arrays_zip(gaps.alias("g"), found.alias("m"), value.alias("v"))
    lengths = F.transform(
        both,
        lambda x: F.struct(
            F.char_length(x["g"]).alias("g"), F.char_length(x["m"]).alias("m"), F.char_length(x["v"]).alias("v")
        ),
    )
    return F.when(text.rlike(pattern), lengths)


def _parts(scanned: DataFrame) -> DataFrame:
    """(rid, kind_no, start, end, value) of every match, in code points, the end exclusive."""
    each = scanned.select("rid", F.posexplode("found").alias("kind_no", "lengths")).select(
        "rid", "kind_no", F.posexplode("lengths").alias("at", "x")
    )
    upto = Window.partitionBy("rid", "kind_no").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ended = each.repartition("rid").withColumn("end", F.sum(F.col("x.g") + F.col("x.m")).over(upto))
    short = (F.col("kind_no") == ORDER["assign"]) & (F.col("x.v") < ASSIGN_VALUE_CHARS)
    return ended.filter(~short).select(
        "rid",
        "kind_no",
        (F.col("end") - F.col("x.m")).alias("start"),
        "end",
        (F.col("end") - F.col("x.v")).alias("value"),
    )


def _unnamed(parts: DataFrame) -> DataFrame:
    """The parts without key-like strings that are the value of an identity."""
    up = Window.partitionBy("rid").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    named = F.max(F.when(F.col("kind_no") == ORDER["identity"], F.col("value"))).over(up)
    is_name = (F.col("kind_no") == ORDER["keylike"]) & (F.col("named") == F.col("start"))
    return parts.withColumn("named", named).filter(~F.coalesce(is_name, F.lit(False)))


def _near_gaps(parts: DataFrame, reach: int) -> DataFrame:
    """With ``completed``: at most ``reach`` code points lie between a complementary part and this one.

    A part that starts before is near if the largest end of those is, one that starts after if
    the least start of those is. Of the lines of one key all are completed if one is.
    """
    by_text = Window.partitionBy("rid")
    ordered = by_text.orderBy("start", "kind_no", "end")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    up = by_text.orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    down = by_text.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    is_secret = F.col("part") == "secret"
    line = F.col("kind_no").isin(ORDER["keylike"], ORDER["hex"])
    adjoins = F.coalesce(F.max(F.when(line, F.col("end"))).over(before) + ADJACENT >= F.col("start"), F.lit(False))
    last = lambda which: F.max(F.when(which, F.col("end"))).over(up)
    first = lambda which: F.min(F.when(which, F.col("start"))).over(down)
    other = lambda found: F.when(is_secret, found(~is_secret)).otherwise(found(is_secret))
    near = F.coalesce(F.col("last") >= F.col("start") - reach, F.lit(False)) | F.coalesce(
        F.col("first") <= F.col("end") + reach, F.lit(False)
    )
    return (
        parts.withColumn("opens", (line & ~adjoins).cast("int"))
        .withColumn("run", F.when(line, F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0))))
        .withColumn("last", other(last))
        .withColumn("first", other(first))
        .withColumn("near", near)
        .withColumn("whole", F.max("near").over(Window.partitionBy("rid", "run")))
        .withColumn("completed", F.when(line, F.col("whole")).otherwise(F.col("near")))
    )


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The strong parts, and the weak ones that complement another part within reach.

    Links are frames over the start, so no pairs are formed. A weak part that overlaps
    a strong one is left out, as it says nothing new.
    """
    strong = F.col("kind_no") < len(BASE)
    part = F.element_at(F.array(*[F.lit(PART[k]) for k in ORDER]), F.col("kind_no") + 1)
    by_text = Window.partitionBy("rid")
    up = by_text.orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    down = by_text.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    kinds = _unnamed(parts).withColumn("part", part)
    return (
        _near_gaps(kinds, reach)
        .withColumn("covered", F.max(F.when(strong, F.col("end"))).over(up))
        .withColumn("next", F.min(F.when(strong, F.col("start"))).over(down))
        .filter(
            strong
            | (
                F.col("completed")
                & ~F.coalesce(F.col("covered") > F.col("start"), F.lit(False))
                & ~F.coalesce(F.col("next") < F.col("end"), F.lit(False))
            )
        )
        .select("rid", "kind_no", "start", "end")
    )


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in ORDER])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind_no"] + 1), s["start"], s["end"])), ","
    )


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, spans, base, n_weak) per row: spans are (start, kind_no, end) structs in order.

    ``base`` has the strong kinds only. A NULL or empty text has no spans; repeated rows are
    scanned one by one; a NULL id is kept; an empty table gives an empty result.
    """
    text = whole_text()
    scanned = docs.select(
        "doc_id", F.array(*[_lengths(text, p) for p in {**BASE, **WEAK}.values()]).alias("found")
    ).withColumn("rid", F.monotonically_increasing_id())
    scanned = stage(scanned, "secret-parts")  # the row numbers are fixed once written
    spans = linked(_parts(scanned), reach).groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind_no", "end"))).alias("spans")
    )
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>")
    full = scanned.select("rid", "doc_id").join(spans, "rid", "left").withColumn("spans", F.coalesce("spans", none))
    return full.select(
        "doc_id",
        "spans",
        F.filter("spans", lambda s: s["kind_no"] < len(BASE)).alias("base"),
        F.size(F.filter("spans", lambda s: s["kind_no"] >= len(BASE))).cast("long").alias("n_weak"),
    )


def report(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Counts per strong kind, a digest of the strong spans, and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind_no"] == ORDER[k])).cast("long")
    return scan(docs, reach).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        "n_weak",
    )
