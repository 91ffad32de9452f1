"""LM scoring: marginal likelihood of a text over all segmentations into subword pieces.

The vocabulary is that of a given tokenizer. Its pieces get unigram scores from the training
documents, and a word's probability is summed over every way to spell it with pieces, by a
forward recursion in log space. Pieces never cross words, so a document's log probability is
the sum over its words and its end, and each distinct word is worked out once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import remainder, whole_text
from tillwise.llm.sentencepiece_codec import load
from tillwise.sources.staging import stage

FREQUENT_WORDS = 100_000  # at most so many words, of at most so many bytes, are broadcast
FREQUENT_BYTES = 64
_FLUSH = 200_000
_MARK = "▁"


def held_out() -> Column:
    return remainder("doc_id", 7) == 2


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return pc.fill_null(batch.column("text"), "").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c): every distinct lower-cased word of all documents, with its count in training.

    Words are counted inside each task first; a task's table is handed on when it grows large.
    """
    packed = docs.select(whole_text().alias("text"), held_out().alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.record_batch(
                [_strings(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["word", "c"]
            )
            counts.clear()
            return out

        for batch in batches:
            for text, held in zip(_texts(batch), batch.column("held_out").to_pylist()):
                words = text.lower().split()
                if held:
                    for word in words:
                        counts.setdefault(word, 0)
                else:
                    counts.update(words)
                if len(counts) > _FLUSH:
                    yield flush()
        yield flush()

    return packed.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def piece_counts(words: DataFrame, model_path: str) -> dict[int, int]:
    """How often each piece occurs when the training words are segmented by the tokenizer.

    At most one count per entry of the vocabulary returns to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = load(model_path)[0]
        totals = np.zeros(processor.get_piece_size())
        for batch in batches:
            for low in range(0, batch.num_rows, 5000):
                part = batch.slice(low, 5000)
                coded = processor.encode(part.column("word").to_pylist(), num_threads=1)
                sizes = [len(ids) for ids in coded]
                ids = np.fromiter((i for row in coded for i in row), np.int64, sum(sizes))
                weights = np.repeat(part.column("c").to_numpy(zero_copy_only=False), sizes)
                totals += np.bincount(ids, weights, minlength=len(totals))
        there = np.flatnonzero(totals)
        yield pa.record_batch(
            [pa.array(there), pa.array(totals[there].astype(np.int64))], names=["piece", "n"]
        )

    found = words.filter("c > 0").mapInArrow(run, "piece long, n long")
    return {r.piece: r.n for r in found.groupBy("piece").agg(F.sum("n").alias("n")).collect()}


def piece_scores(model_path: str, counts: Mapping[int, int], ends: int) -> tuple[dict[str, float], list[float], float]:
    """log10 probability of each spelt piece, of each byte piece, and of the end; add-one counts."""
    processor = load(model_path)[0]
    size = processor.get_piece_size()
    total = sum(counts.values()) + ends + size + 1
    score = lambda n: math.log10((n + 1) / total)
    spelt, raw = {}, [score(0)] * 256
    for i in range(size):
        if processor.is_byte(i):
            raw[int(processor.id_to_piece(i)[1:-1], 16)] = score(counts.get(i, 0))
        elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
            spelt[processor.id_to_piece(i)] = score(counts.get(i, 0))
    return spelt, raw, score(ends)


class Lattice:
    """Forward recursion over all segmentations of a word."""

    def __init__(self, spelt: Mapping[str, float], raw: list[float]):
        self.spelt, self.raw = spelt, raw
        self.longest = max(map(len, spelt), default=1)
        self.prefixes = {p[:i] for p in spelt for i in range(1, len(p))}

    def log10(self, word: str) -> float:
        """log10 of the summed probability of all spellings of the word, its mark included.

        A character that is no piece itself is spelt in bytes.
        """
        text = _MARK + word
        n, spelt, prefixes = len(text), self.spelt, self.prefixes
        forward: list[list[float]] = [[] for _ in range(n + 1)]
        forward[0] = [0.0]
        total = 0.0
        for at in range(n):
            into = forward[at]
            if not into:
                continue
            top = max(into)
            total = into[0] if len(into) == 1 else top + math.log10(sum(10 ** (x - top) for x in into))
            forward[at] = []
            one = text[at]
            if one not in spelt:
                forward[at + 1].append(total + sum(self.raw[b] for b in one.encode("utf-8", "replace")))
            end = at
            piece = ""
            while end < n:
                end += 1
                piece = text[at:end]
                score = spelt.get(piece)
                if score is not None:
                    forward[end].append(total + score)
                if piece not in prefixes:
                    break
        into = forward[n]
        top = max(into)
        return top + math.log10(sum(10 ** (x - top) for x in into))


def scored_words(words: DataFrame, spelt: Mapping[str, float], raw: list[float]) -> DataFrame:
    """Adds ``lattice``, the log10 marginal probability of the word, to (word, c)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(spelt, raw)
        for batch in batches:
            values = [lattice.log10(w) for w in batch.column("word").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(values, pa.float64())], names=["word", "c", "lattice"])

    return words.mapInArrow(run, "word string, c long, lattice double")


def most_frequent(words: DataFrame, limit: int) -> DataFrame:
    """Words of at most ``FREQUENT_BYTES`` above the count at which ``limit`` would be passed.

    The count is read off a histogram of a few thousand steps, exact below 1,024 and of about
    1.6 % above, so the words themselves are neither sorted nor sent more than once.
    """
    step = F.when(F.col("c") < 1024, F.col("c")).otherwise(1024 + F.floor(F.log(F.col("c") / 1024) * 64))
    short = words.filter(F.octet_length("word") <= FREQUENT_BYTES).withColumn("step", step.cast("long"))
    sizes = {r.step: r.n for r in short.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken, lowest = 0, max(sizes, default=0) + 1
    for at in sorted(sizes, reverse=True):
        taken += sizes[at]
        if taken > limit:
            break
        lowest = at
    return short.filter(F.col("step") >= lowest).drop("step")


def _by_frequent(docs: DataFrame, words: list[bytes], c: np.ndarray, base: np.ndarray, lattice: np.ndarray) -> DataFrame:
    """Sums over the frequent words of each document, and its other words with their counts."""
    packed = docs.select("doc_id", held_out().alias("held_out"), whole_text().alias("text"))
    kind = dict(packed.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(words)}
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                counted, known, bases, lattices, rest, sizes, cuts = [], [], [], [], [], [], [0]
                for text in _texts(part):
                    tokens = text.lower().split()
                    at = np.fromiter(map(place.get, tokens, repeat(-1)), np.int64, len(tokens))
                    hit = at[at >= 0]
                    counted.append(len(tokens))
                    known.append(int(np.count_nonzero(c[hit])))
                    bases.append(float(base[hit].sum()))
                    lattices.append(float(lattice[hit].sum()))
                    others = Counter(tokens[i] for i in np.flatnonzero(at < 0))
                    rest += others.keys()
                    sizes += others.values()
                    cuts.append(len(rest))
                pairs = pa.StructArray.from_arrays([_strings(rest), pa.array(sizes, pa.int32())], ["word", "n"])
                yield pa.record_batch(
                    [
                        part.column("doc_id"), part.column("held_out"),
                        pa.array(counted, pa.int64()), pa.array(known, pa.int64()),
                        pa.array(bases, pa.float64()), pa.array(lattices, pa.float64()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pairs),
                    ],
                    names=["doc_id", "held_out", "n_words", "known", "base", "lattice", "others"],
                )

    return packed.mapInArrow(
        run,
        f"doc_id {kind}, held_out boolean, n_words long, known long, base double, lattice double, "
        "others array<struct<word string, n int>>",
    )


def score_documents(docs: DataFrame, model_path: str, frequent: int = FREQUENT_WORDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    ``score`` is the log10 probability of the text's words and end under the piece model,
    ``base_score`` that of an add-one word unigram; both learn only from documents that are not
    held out. A NULL text is empty and consists of its end. Repeated rows count as often as they
    occur and score alike; a NULL id hashes as empty text. Without training documents every
    count is zero and scores come from the smoothing alone. An empty table gives an empty result.
    """
    counts = stage(word_counts(docs), "word-counts")
    ends = docs.filter(~held_out()).count()
    sums = counts.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n, v = (sums.n or 0) + ends, sums.v + (ends > 0)
    unit = n + 1 * (v + 1)
    spelt, raw, end_score = piece_scores(model_path, piece_counts(counts, model_path), ends)
    words = stage(scored_words(counts, spelt, raw), "word-scores")
    top = most_frequent(words, frequent).toPandas()
    c = top["c"].to_numpy(np.int64)
    split = _by_frequent(
        docs, [w.encode() for w in top["word"]], c, np.log10((c + 1) / unit), top["lattice"].to_numpy(float)
    )
    split = stage(split.withColumn("rid", F.monotonically_increasing_id()), "word-split")
    rest = split.select("rid", F.inline("others")).join(words, "word")
    rest = rest.groupBy("rid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).cast("long").alias("r_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(unit))).alias("r_base"),
        F.sum(F.col("n") * F.col("lattice")).alias("r_lattice"),
    )
    whole = split.drop("others").join(rest, "rid", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return whole.select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (plus("known", "r_known") + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (plus("base", "r_base") + math.log10((ends + 1) / unit)).alias("base_score"),
        (plus("lattice", "r_lattice") + end_score).alias("score"),
    )
