"""Importance resampling towards a target: documents are drawn by how much likelier the target makes
their words and word runs than the corpus does.

A table of 256 bytes lower-cases A-Z and blanks the separators of UTF-8 text, ``bytes.split`` yields
the words, and zlib.crc32 seeded with the checksum of a run extends it by one word, so no run is ever
spelt out. Counters reduce the hashed features to one count per bucket; the gain of a bucket is the
logarithm of its smoothed share in the target over that in the corpus. Gumbel noise, drawn from the
id, makes the highest scores a sample without replacement.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import passed_through
from tillwise.plans.ordered import with_order_stats
from tillwise.sources.staging import stage

BUCKETS, MAX_N, SEED, PERCENT, LEAST_WORDS = 10_000, 1, 2024, 10, 20
PIECE = 1 << 20
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def pieces(data: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in lists of about ``size`` bytes, so a long text is never a list as a whole."""
    data = data.translate(_WORD_BYTES)
    low = 0
    while low < len(data):
        high = data.find(b" ", low + size) if low + size < len(data) else -1
        high = len(data) if high < 0 else high
        yield data[low:high].split()
        low = high


def features(data: bytes, max_n: int = MAX_N, size: int = PIECE) -> Iterator[tuple[int, list[int]]]:
    """(new words, crc32 of the runs of 1 to ``max_n`` words that end in them), piece by piece.

    A run is its words joined by one space; its checksum is that of the run without its last word,
    carried on over a space and that word.
    """
    tail: list[bytes] = []
    for words in pieces(data, size):
        line = tail + words
        found: list[int] = []
        sums = list(map(crc32, line))
        for n in range(1, max_n + 1):
            if n > 1:  # sums[i] is of the run of n words from line[i] on
                sums = [crc32(b" " + word, before) for before, word in zip(sums, line[n - 1 :])]
            found += sums[max(len(tail) - n + 1, 0) :]
        yield len(words), found
        tail = line[max(len(line) - max_n + 1, 0) :] if max_n > 1 else []


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N) -> list[int]:
    """Features per bucket over all rows. At most ``buckets`` numbers come out of each task and return."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for batch in batches:
            for value in batch.column(0):
                for _, found in features((value.as_py() or "").encode(), max_n):
                    seen.update([x % buckets for x in found])
        yield pa.record_batch([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["bucket", "n"])

    out = [0] * buckets
    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln) of the target's smoothed share over the corpus's, per bucket."""
    buckets, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return [
        math.floor(1000 * math.log(float(t + 1) * (s_all + buckets) / (float(s + 1) * (t_all + buckets))))
        for s, t in zip(corpus, target)
    ]


def noise(seed: int, doc_id: str) -> int:
    """floor(1000 g) for a Gumbel variable g that depends on the seed and the id only."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, gain: list[int], doc_id: str = "doc_id", text: str = "text", max_n: int = MAX_N, seed: int = SEED
) -> DataFrame:
    """(row, n_features, n_words, weight, score) per row: the sum of gains, and that with noise."""
    packed = passed_through(docs, id_text=F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    names = ["n_features", "n_words", "weight", "score"]
    table = np.array(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int]] = []
            for name, value in zip(batch.column("id_text"), pc.struct_field(batch.column("row"), text)):
                n_features = n_words = weight = 0
                for words, found in features((value.as_py() or "").encode(), max_n):
                    n_words += words
                    n_features += len(found)
                    weight += int(table[np.array(found, np.int64) % len(table)].sum())
                out.append([n_features, n_words, weight, weight + noise(seed, name.as_py())])
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.record_batch(
                [batch.column("row"), *[pa.array(list(c), pa.int64()) for c in columns]], names=["row", *names]
            )

    schema = T.StructType([packed.schema["row"], *[T.StructField(n, T.LongType()) for n in names]])
    return packed.mapInArrow(run, schema)


def _ranked(numbered: DataFrame, percent: int, least_words: int) -> DataFrame:
    """With ``rank``: 1, 2, 3, ... in order of the score for the rows drawn, NULL for the others.

    The order is made by sorted ranges of narrow rows; the row number ends it, so equal ids and
    scores still spread over several ranges.
    """
    eligible = F.col("n_words") >= least_words
    rows = stage(numbered.withColumn("eligible", eligible.cast("int")), "resample-scores")
    drawn = percent * (rows.agg(F.sum("eligible")).first()[0] or 0) // 100
    placed = with_order_stats(rows, ["-eligible", "-score"], ["doc_id", "rid"], row_number="place")
    return placed.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place")))


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N, seed: int = SEED,
    percent: int = PERCENT, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score, rank) for every row of ``docs``.

    Of the N rows with at least ``least_words`` words the floor(percent * N / 100) highest scores are
    drawn, ties to the smaller id. Gains come from all rows of ``docs`` and of ``target``. NULL and
    empty texts have no features and weight 0; a NULL id draws noise as an empty one and goes before
    all others in a tie; of equal rows each is drawn by itself; an empty table gives an empty result.
    """
    gain = gains(bucket_counts(docs, "text", buckets, max_n), bucket_counts(target, "text", buckets, max_n))
    found = scored(docs.select("doc_id", "text"), gain, max_n=max_n, seed=seed).select(
        "row.doc_id", "n_features", "n_words", "weight", "score", F.monotonically_increasing_id().alias("rid")
    )
    return _ranked(found, percent, least_words).select("doc_id", "n_features", "n_words", "weight", "score", "rank")


def draw(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N, seed: int = SEED,
    percent: int = PERCENT, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(row, weight, score, rank) of the rows drawn, with all their columns; as ``resample``.

    The scored rows are written once, so that the numbers by which they are found again are fixed.
    """
    gain = gains(bucket_counts(docs, "text", buckets, max_n), bucket_counts(target, "text", buckets, max_n))
    rows = stage(
        scored(docs, gain, max_n=max_n, seed=seed).withColumn("rid", F.monotonically_increasing_id()), "resample-rows"
    )
    narrow = rows.select(F.col("row.doc_id").alias("doc_id"), "n_words", "score", "rid")
    ranks = _ranked(narrow, percent, least_words).filter("rank IS NOT NULL").select("rid", "rank")
    return rows.join(ranks, "rid").select("row", "weight", "score", "rank")
