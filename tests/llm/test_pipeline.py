from __future__ import annotations

import os

import pytest
import sentencepiece

import corpus_pipeline
from tests.llm import brute, rows
from tillwise.llm import mixing, quality_rules
from tillwise.llm.common import table
from tillwise.llm.queries import tokenizer

SF = "/root/testdata/sf0.001"


def brute_pipeline(docs, cutoffs):
    def good(d):
        m = brute.measures(d["text"])
        above = lambda rule: round(share(rule, m) * 1e12) > round(cutoffs.get((d["lang"] or "", rule), 9) * 1e12)
        return not brute.base_failed(m) and not any(map(above, quality_rules.RULES))

    def share(rule, m):
        top, bottom = quality_rules.RULES[rule].split(" / ")
        return m[top] / max(m[bottom.split("(")[1].split(",")[0]], 1)

    docs = [d for d in docs if good(d)]
    lines = brute.line_dedup(docs, 10)
    docs = [d | {"text": lines[d["doc_id"], d["text"] or ""][2]} for d in docs]
    classes, first = brute.near_classes(docs), {}
    for d, c in sorted(zip(docs, classes), key=lambda x: x[0]["doc_id"]):
        first.setdefault(c, d)
    docs = list(first.values())
    copies = brute.mixing_copies(docs, mixing.DOMAINS, mixing.WEIGHTS, mixing.MAX_EPOCHS, mixing.SEED)
    coder = sentencepiece.SentencePieceProcessor(model_file=tokenizer(), add_eos=True)
    out = []
    for d, n in zip(docs, copies):
        ids = coder.encode(d["text"])
        out += [(d["doc_id"], len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(coder.decode(ids)))] * n
    return sorted(out)


@pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")
def test_run_against_brute_force(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    counted = quality_rules.measured(docs.select("doc_id", "lang", "text"))
    cutoffs = quality_rules.learn_cutoffs(counted, labels)
    got = corpus_pipeline.run(spark, SF).drop("covered_bytes").collect()
    assert sorted(map(tuple, got)) == brute_pipeline([r.asDict() for r in docs.collect()], cutoffs)


@pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")
def test_stages_keep_the_columns(spark):
    docs = rows.frame(spark, rows.awkward())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
        out.collect()
        assert stage(spark, docs.limit(0), SF).collect() == []
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "mixing", "sentencepiece",
    ]
