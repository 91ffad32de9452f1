from __future__ import annotations

import public_tokenizers
import pytest
import sentencepiece

from tests.llm import brute, rows
from tillwise.llm.queries import digest
from tillwise.llm.sentencepiece_codec import Normalizer, encode, load

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  a  b ", "ﬁne ① ｱｲｳ  é́ x", "Ａ　Ｂ ", "ΑΣ ς", "\t\n tab", "ｶﾞ", "a​b", "㌔ ", " 　 z", "한글 ½",
    "\U0001f600 smile", "▁marked ▁▁ x", "x" * 5000, "line\nline\n", "…  ﷺ  ", "\u0000nul",
]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("prefix", [False, True])
@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("escape", [False, True])
def test_normaliser_and_alignment(rule, prefix, squeeze, escape):
    lib = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=squeeze, escape_whitespaces=escape
    )
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(lib.serialized_model_proto())
    mine = Normalizer(model.normalizer_spec.precompiled_charsmap, prefix, squeeze, escape)
    for text in TEXTS[:-1]:
        want, offsets = lib.normalize(text, with_offsets=True)
        got, source = mine(text)
        assert got.decode() == want
        at, starts = 0, []
        for ch in [*want, ""]:
            starts.append(len(text.encode()[: source[at]].decode()))
            at += len(ch.encode())
        assert starts == list(offsets)


def test_ids_spans_and_text(spark):
    data = [(i, t, "en", "s", 1, "", 0, "") for i, t in enumerate(TEXTS)] + rows.awkward()
    df = rows.frame(spark, data)
    coded = encode(df, MODEL, add_eos=True)
    assert coded.select("row.*").schema == df.schema
    plain = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in coded.collect():
        text = r.row.text or ""
        ids = plain.encode(text) + [2]
        assert r.ids == ids and r.decoded == plain.decode(ids)
        raw = text.encode()
        spans = list(zip(r.starts, r.ends))
        assert all(0 <= a <= b <= len(raw) for a, b in spans)
        assert all(b == a2 for (_, b), (a2, _) in zip(spans, spans[1:])) and (not raw or spans[0][0] == 0)
        assert b"".join(raw[a:b] for a, b in spans) == raw
        for i, (a, b) in zip(ids, spans):
            piece = plain.id_to_piece(i)
            if not (plain.is_byte(i) or plain.is_control(i)):
                assert piece.replace("▁", " ").encode().lstrip() == raw[a:b].replace("▁".encode(), b" ").lstrip()


def test_digest(spark):
    df = rows.frame(spark, [(1, "Hello  world\n", "", "", 0, "", 0, ""), (2, None, "", "", 0, "", 0, "")])
    plain = sentencepiece.SentencePieceProcessor(model_file=MODEL, add_eos=True)
    for r in digest(encode(df, MODEL)).collect():
        text = {1: "Hello  world\n", 2: ""}[r.doc_id]
        ids = plain.encode(text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == brute.sha(" ".join(map(str, ids)))
        assert r.decoded_sha256 == brute.sha(plain.decode(ids)) and r.covered_bytes == len(text.encode())


def test_empty_and_cached(spark):
    assert encode(rows.frame(spark, []), MODEL).collect() == []
    assert load(MODEL)[2][2] == 0
