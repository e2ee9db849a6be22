import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import ODD
from quarry.llm import piece_codec
from quarry.llm.piece_codec import Codec, decode_ids, encode_documents, encode_word, encode_words
from quarry.llm.pieces import SPACE, PieceModel, piece_model
from quarry.llm.token_counts import count_tokens, count_words, whole_tokens


PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXT = st.text(alphabet=st.sampled_from("abcdeé \t\n▁.,0中①😀ing  theTHE-"), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_whole_texts_as_the_library(texts):
    for t, (ids, back) in zip(texts, Codec(piece_model(PATH)).encode(texts), strict=True):
        want = LIB.encode(t)
        assert ids == ",".join(map(str, want))
        assert back == LIB.decode(want)
    assert count_words(PATH, texts, {}) == [len(LIB.encode(t)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abceinrst▁é中😀", min_size=1, max_size=70))
def test_one_agenda_and_many(word):
    model = piece_model(PATH)
    word = SPACE + word.replace(SPACE, "")
    flat, size = encode_words(model, [word, SPACE, word * 9, word])
    many = [x.tolist() for x in np.split(flat, np.cumsum(size)[:-1])]
    assert many[0] == many[3] == encode_word(model, word) and many[2] == encode_word(model, word * 9)
    assert many == model.library_ids([word, SPACE, word * 9, word])


def test_nothing_remembered_gives_the_same(monkeypatch):
    texts = ["one two three", "", "é中😀 two", "three " * 50, "a▁b  c", "one four"] * 3
    want = list(Codec(piece_model(PATH)).encode(texts))
    monkeypatch.setattr(piece_codec, "REMEMBERED", 0)
    codec = Codec(piece_model(PATH))
    assert [x for t in texts for x in codec.encode([t])] == want and not codec.ids


def test_bytes_of_no_character():
    model = piece_model(PATH)
    ids = [model.byte_ids[0xE4], model.byte_ids[0xB8], 300, model.byte_ids[0x80]]
    assert decode_ids(model, [model.ids[SPACE], *ids])[1:] == LIB.decode([model.ids[SPACE], *ids])


def test_whole_token_proof():
    whole = whole_tokens(PATH)
    assert len(whole) > 10_000
    for w in sorted(whole)[::500]:
        if len(w) > 1:
            assert len(LIB.encode(w[1:])) == 1


def test_a_missing_model_is_refused(tmp_path):
    with pytest.raises((OSError, RuntimeError)):
        PieceModel(str(tmp_path / "none.model"))


def test_documents(make_docs):
    docs = make_docs(ODD, extra=["n_tokens", "ids", "n_bytes"])
    texts = {(i, t) for i, t in ODD}
    want = sorted((str(i), len(LIB.encode(t or "")), len((t or "").encode())) for i, t in ODD)
    got = count_tokens(docs, PATH, limit=100).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_bytes) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    out = encode_documents(docs, PATH).collect()
    assert len(out) == len(ODD)
    for r in out:
        ids = [int(x) for x in r.ids.split(",")] if r.ids else []
        assert r.n_tokens == len(ids)
        assert any(i == r.doc_id and LIB.encode(t or "") == ids and LIB.decode(ids) == r.decoded for i, t in texts)
    digests = encode_documents(docs, PATH, with_text=False).collect()
    assert sorted(r.ids_sha256 for r in digests) == sorted(hashlib.sha256(r.ids.encode()).hexdigest() for r in out)
    assert sorted(r.decoded_sha256 for r in digests) == sorted(
        hashlib.sha256(r.decoded.encode()).hexdigest() for r in out)


def test_empty(make_docs):
    assert count_tokens(make_docs([]), PATH).collect() == []
    assert encode_documents(make_docs([]), PATH).collect() == []
