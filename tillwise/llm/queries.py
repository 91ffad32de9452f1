"""The operators bound to the benchmark tables, by query name, with SQL where it can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import (
    filter_audit, licenses, line_dedup, lm_scoring, mixing, near_dup, quality_gam, quality_rules, resampling,
    secrets, sentencepiece_codec, sharding, topk,
)
from tillwise.llm.common import remainder, table
from tillwise.sources.staging import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return lines.select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One folder per input and application: asked again, the stored map is edited.
    folder = f"{shared_dir(spark)}/slot-map-{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}"
    return sharding.assign_shards(table(spark, sf_dir, "documents"), folder=folder)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), each_row=True)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), tokenizer())


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "row.doc_id",
        (remainder("row.doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allocate(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "row.doc_id", *[F.col(f"m.{c}").alias(c) for c in quality_rules.COUNTS], "base_failed", "kept", "bound"
    )


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode(table(spark, sf_dir, "documents"), tokenizer(), add_eos=True)
    return digest(coded)


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform(F.filter("places", lambda p: p["base"]), lambda p: p["start"])
    return found.select(
        "row.doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.array_join("expressions", ";").alias("expressions"),
        "terms",
    )


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def digest(coded: DataFrame) -> DataFrame:
    """Digest columns of encoded rows; ``covered_bytes`` counts the source bytes of the pieces."""
    return coded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.array_max("ends") - F.array_min("starts"), F.lit(0)).cast("long").alias("covered_bytes"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_sharding, op3_topk, op4_lm_scoring, op5_secrets, op6_quality, op7_near_dup,
        op8_mixing, op9_quality_rules, op10_sentencepiece, op11_licenses, op12_resampling, op13_filter_audit,
    )
}

OP1_SQL = """
WITH lines AS (
  SELECT doc_id, u.line, u.pos,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM documents, LATERAL (
    SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos) u
), common AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN common c ON lines.key = c.key
GROUP BY doc_id
"""

OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def _level_sql(depth: int) -> str:
    path = ["t_domain", "t_lang", "t_source"][:depth]
    parent = path[:-1]
    part = f"PARTITION BY {', '.join(parent)}" if parent else ""
    budget = (
        f"JOIN share{depth - 1} p USING ({', '.join(parent)})" if parent else "JOIN (SELECT sum(available)::DOUBLE AS share FROM leaves) p ON true"
    )
    named = " || '/' || ".join(path)
    weights = " ".join(f"WHEN '{k}' THEN {w}" for k, w in sorted(mixing.WEIGHTS.items()))
    return f"""
, node{depth} AS (
  SELECT {', '.join(f'n.{c}' for c in path)}, n.capacity, p.share AS budget,
         (CASE {named.replace('t_', 'n.t_')} {weights} ELSE 1 END)::BIGINT AS weight
  FROM (SELECT {', '.join(path)}, sum(available) * {mixing.MAX_EPOCHS} AS capacity FROM leaves GROUP BY ALL) n {budget}
), ranked{depth} AS (
  SELECT *, capacity::DOUBLE / weight AS ratio,
         row_number() OVER ({part} ORDER BY capacity::DOUBLE / weight, {path[-1]}) AS place,
         coalesce(sum(capacity) OVER ({part} ORDER BY capacity::DOUBLE / weight, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER ({part} ORDER BY capacity::DOUBLE / weight, {path[-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
  FROM node{depth}
), unit{depth} AS (
  SELECT *, (budget - used::DOUBLE) / left_weight::DOUBLE AS unit FROM ranked{depth}
), stop{depth} AS (
  SELECT *, min(CASE WHEN ratio > unit THEN place END) OVER ({part}) AS stop_at FROM unit{depth}
), share{depth} AS (
  SELECT {', '.join(path)},
         CASE WHEN stop_at IS NULL OR place < stop_at THEN capacity::DOUBLE
              ELSE max(CASE WHEN place = stop_at THEN unit END) OVER ({part}) * weight END AS share
  FROM stop{depth}
)"""


OP8_SQL = (
    """
WITH rows AS (
  SELECT doc_id, coalesce(lang, '') AS t_lang, coalesce(source, '') AS t_source,
         CASE """
    + " ".join(f"WHEN source = '{s}' THEN '{d}'" for s, d in mixing.DOMAINS.items())
    + """ ELSE 'other' END AS t_domain,
         len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS n_tokens
  FROM documents
), leaves AS (
  SELECT t_domain, t_lang, t_source, sum(n_tokens)::BIGINT AS available FROM rows GROUP BY ALL
)"""
    + "".join(_level_sql(d) for d in (1, 2, 3))
    + f""", asked AS (
  SELECT l.*, floor(share)::BIGINT AS target,
         CASE WHEN available > 0 THEN floor(floor(share) / available)::BIGINT ELSE 0 END AS epochs
  FROM leaves l JOIN share3 USING (t_domain, t_lang, t_source)
), keyed AS (
  SELECT r.*, available, target, epochs,
         sum(n_tokens) OVER (PARTITION BY t_domain, t_lang, t_source
                             ORDER BY md5('{mixing.SEED}:' || epochs || ':' || doc_id), doc_id) AS upto
  FROM rows r JOIN asked USING (t_domain, t_lang, t_source)
)
SELECT doc_id, t_domain AS domain, t_lang AS lang, t_source AS source, n_tokens::BIGINT AS n_tokens, available, target,
       least(epochs + CASE WHEN upto <= target - epochs * available THEN 1 ELSE 0 END, {mixing.MAX_EPOCHS})::BIGINT AS copies
FROM keyed
"""
)

OP13_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w
  FROM documents
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM texts LEFT JOIN marks USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before + bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
  FROM steps, cells GROUP BY ALL
)
SELECT * EXCLUDE (bit), sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM counted
"""

SQL = {"op1_line_dedup": OP1_SQL, "op3_topk": OP3_SQL, "op8_mixing": OP8_SQL, "op13_filter_audit": OP13_SQL}
