"""Encoding by prefixes against the library of the model."""

import hashlib

import public_tokenizers
import pytest
from common import awkward, documents
from hypothesis import given, settings, strategies as st

from loanbook.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.Model(MODEL)


def _expected(model, text):
    ids = model.processor.encode(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(model.processor.decode(ids).encode()).hexdigest())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.sampled_from(" \u2581 .,_²\n\tabetnisr中é\U0001f600\x00"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_random_texts(model, text):
    ids, digits = model.encode(text)
    assert ids == model.processor.encode(text) and digits == ",".join(map(str, ids))


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "x" * 20_000, "long" * 30_000, " " * 5_000, "中文" * 20_000, "a\u2581 " * 500,
                                  "<s> </s> <unk> <0x0A>", "\U0001f600" * 300, "E². x². ².²", "a_b__c. d_"])
def test_edges(model, text):
    assert model.encode(text)[0] == model.processor.encode(text)


def test_every_piece_and_pair_of_pieces(model):
    """Each piece alone, and each with another, as texts: their borders are what the table rests on."""
    own = [p.replace("\u2581", " ") for p in model.id]
    for k, piece in enumerate(own):
        other = own[k * 7919 % len(own)]
        for text in (piece, piece + other):
            assert model.encode(text)[0] == model.processor.encode(text), text


def test_forgetting_changes_nothing(model, monkeypatch, spark):
    monkeypatch.setattr(pieces, "REMEMBERED", 40)
    small = pieces.Model(MODEL)
    for r in documents(spark).limit(30).collect():
        assert small.encode(r.text or "") == model.encode(r.text or "")


def test_documents(spark, model):
    docs = documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = pieces.encoded(docs, MODEL).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == _expected(model, texts[r.doc_id])


def test_awkward_rows(spark, model):
    df = awkward(spark)
    got = sorted(tuple(r) for r in pieces.encoded(df, MODEL).select("n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == sorted(_expected(model, r.text) for r in df.collect())
    with_ids = pieces.encoded(df, MODEL, with_ids=True)
    assert with_ids.where("size(ids) <> n_tokens").count() == 0 and with_ids.where("doc_id is null").count() == 2
    assert pieces.encoded(df.limit(0), MODEL).count() == 0
