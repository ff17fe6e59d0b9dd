"""Merge rounds and their decoder against the sentencepiece library."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.llm import pieces
from parley.llm.queries import catalog, tokenizer_file

library = pytest.importorskip("sentencepiece")
FILE = "piece_bpe_32k.model"
ODD = [
    "", " ", "  ", "a  b ", "\n\t x", "\r\n", "ﬁ K Å é é", "<s> </s><unk>", "<0x41>", "▁x ▁ y▁", "\x00a", "你好 世界\U0001f600",
    " a　b", "12 345", " " * 40 + "x" + " " * 17, "tail ", "aaaaaaaaab" * 9, "the" * 30, "\U0010ffff", "-" * 70,
]


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(tokenizer_file(FILE))


@pytest.fixture(scope="module")
def reference():
    return library.SentencePieceProcessor(model_file=tokenizer_file(FILE))


def _check(model, reference, texts):
    for text, ids in zip(texts, model.encode(texts), strict=True):
        want = reference.encode(text)
        assert ids.tolist() == want, text[:60]
        assert model.decode(ids) == reference.decode(want)


def test_odd_texts(model, reference):
    _check(model, reference, ODD)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet="the inoa▁ \n1é")), max_size=8))
def test_texts(model, reference, texts):
    _check(model, reference, texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(259, 31999), max_size=30))
def test_texts_made_of_pieces(model, reference, ids):
    _check(model, reference, ["".join(reference.id_to_piece(ids)).replace("▁", " ")])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 258), st.sampled_from([1, 2, 28705]), st.integers(259, 31999)), max_size=9))
def test_decoding_of_any_ids(model, reference, ids):
    assert model.decode(np.array(ids, np.int64)) == reference.decode(ids)


@pytest.mark.parametrize("rounds", [0, 1, 3, pieces.ROUNDS])
def test_rounds_and_single_merges_agree(model, reference, rounds, monkeypatch):
    monkeypatch.setattr(pieces, "ROUNDS", rounds)
    model.memo = {}
    letters = "etaoinshrdlu"
    long_word = "".join(letters[(i * i * 7 + i // 3) % 12] for i in range(30_000))
    _check(model, reference, [*ODD, long_word, " " * 5_000, "x" * 20_000, "a b " * 4_000])


def test_memo_is_bounded(reference, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 50)
    model = pieces.PieceModel(tokenizer_file(FILE))
    for start in range(0, 400, 40):
        texts = [" ".join(f"w{i}" for i in range(start, start + 40)), "y" * 100]
        _check(model, reference, texts)
        assert max(len(model.memo), len(model.older)) <= 50 + 41
        assert "▁" + "y" * 100 not in model.memo


def test_query_equals_library(spark, folder, reference):
    found = {r["doc_id"]: tuple(r)[1:] for r in catalog()["op13_piece_rounds"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(docs) == len(found)
    for row in docs:
        ids = reference.encode(row["text"] or "")
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), reference.decode(ids))]
        assert found[row["doc_id"]] == (len(ids), *digests)


def test_edges(spark, edge_docs, no_docs, reference):
    path = tokenizer_file(FILE)
    rows = pieces.encode(edge_docs, path, decoded=True).collect()
    texts = sorted(((r["doc_id"] or -1, r["text"] or "") for r in edge_docs.collect()))
    assert sorted((r["doc_id"] or -1, r["decoded"]) for r in rows) == texts
    want = sorted((d, reference.encode(t)) for d, t in texts)
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in rows) == want
    assert pieces.encode(no_docs, path).count() == 0
    again = pieces.decode(pieces.encode(edge_docs, path), path).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in again) == texts
    nothing = spark.createDataFrame([(1, None), (2, []), (3, [None, 264])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in pieces.decode(nothing, path).collect()} == {1: "", 2: "", 3: "a"}


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    parsed = proto.ModelProto.FromString(open(tokenizer_file(FILE), "rb").read())
    parsed.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(parsed.SerializeToString())
    with pytest.raises(ValueError, match="normalizer"):
        pieces.PieceModel(str(tmp_path / "other.model"))
