from __future__ import annotations

import itertools
import math
from collections import Counter

import public_tokenizers
import pytest

from tests.llm import brute, rows
from tillwise.llm import lm_scoring
from tillwise.llm.lm_scoring import Lattice, score_documents
from tillwise.llm.sentencepiece_codec import load

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def spellings(word, spelt, raw):
    """Summed probability over every segmentation, one by one."""
    text, total = "▁" + word, 0.0
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
        parts = [text[a:b] for a, b in zip(at, at[1:])]
        logs = [spelt[p] if p in spelt else sum(raw[b] for b in p.encode()) if len(p) == 1 else None for p in parts]
        total += 0 if None in logs else 10 ** sum(logs)
    return math.log10(total)


def test_lattice_sums_all_segmentations():
    spelt, raw, _ = lm_scoring.piece_scores(MODEL, {300: 50, 400: 7, 1000: 3}, 4)
    lattice = Lattice(spelt, raw)
    for word in ["a", "the", "there", "naïve", "日本x", "\U0001f600z", "ab\x00c", "inging"]:
        assert lattice.log10(word) == pytest.approx(spellings(word, spelt, raw), rel=1e-12)


def test_very_long_word():
    spelt, raw, _ = lm_scoring.piece_scores(MODEL, {}, 0)
    assert -1e6 < Lattice(spelt, raw).log10("abc" * 10000) < -1e4


def expected(data):
    train, ends = Counter(), 0
    for d in data:
        if brute.crc_mod(d["doc_id"], 7) != 2:
            train.update(brute.words((d["text"] or "").translate(brute.LOWER)))
            ends += 1
    n, v = sum(train.values()) + ends, len(train) + (ends > 0)
    pieces = Counter()
    processor = load(MODEL)[0]
    for word, c in train.items():
        for i in processor.encode(word):
            pieces[i] += c
    spelt, raw, end = lm_scoring.piece_scores(MODEL, pieces, ends)
    lattice = Lattice(spelt, raw)
    out = []
    for d in data:
        tokens = brute.words((d["text"] or "").translate(brute.LOWER))
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tokens) + math.log10((ends + 1) / (n + v + 1))
        out.append((
            d["doc_id"] if d["doc_id"] is not None else -1, brute.crc_mod(d["doc_id"], 7) == 2, len(tokens) + 1,
            sum(train[w] > 0 for w in tokens) + (ends > 0), n, base, sum(map(lattice.log10, tokens)) + end,
        ))
    return sorted(out)


@pytest.mark.parametrize("frequent", [0, 10, 100_000])
def test_against_brute_force(spark, frequent):
    data = rows.awkward()
    got = score_documents(rows.frame(spark, data), MODEL, frequent)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in got.collect())
    for a, b in zip(got, expected(rows.dicts(data)), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_nothing_to_learn_from(spark):
    held = [(i, "some text", "en", "s", 1, "", 0, "") for i in range(30) if brute.crc_mod(i, 7) == 2]
    for r in score_documents(rows.frame(spark, held), MODEL).collect():
        assert r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.score < 0


def test_empty(spark):
    assert score_documents(rows.frame(spark, []), MODEL).collect() == []
