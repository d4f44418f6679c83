"""Encoding and decoding against the sentencepiece library."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from daytally.llm import pieces
from daytally.llm.common import table

SF = "/root/testdata/sf0.001"
MODEL = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
VOCABULARY, LIBRARY = pieces.loaded(MODEL)
AWKWARD = [
    "", " ", "a", "  a  b ", "\x00x", "a\tb\n\n", "▁x ▁", "�", "<s></s><unk>", "<0x41>", "é😀𝔘", " " * 70 + "the" + " " * 33, "\x85  ",
    "x" * 5000, "ab" * 3000, "的" * 2000, "aaa" + "́" * 40, "don't  stop--now!!!!!!!!", "1234567890" * 300, "▁" * 50,
]


@pytest.mark.parametrize("text", AWKWARD)
def test_awkward_texts(text):
    ids = VOCABULARY.encode(text)
    assert ids == LIBRARY.encode(text, add_eos=True) and VOCABULARY.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text(alphabet=" ▁abetshion\n.,", max_size=300), st.lists(st.sampled_from(sorted(VOCABULARY.ids)), max_size=30).map("".join)))
def test_any_text(text):
    ids = VOCABULARY.encode(text)
    assert ids == LIBRARY.encode(text, add_eos=True) and VOCABULARY.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=30))
def test_any_ids(ids):
    assert VOCABULARY.decode(ids) == LIBRARY.decode(ids)


def test_stretches_that_are_not_kept(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 3)
    monkeypatch.setattr(pieces, "TOGETHER", 2)
    own = pieces.Vocabulary(MODEL)
    for i in range(20):
        texts = [f"one two three{i} four", "five six two one ", "x" * 60]
        assert own.encode_all(texts) == LIBRARY.encode(texts, add_eos=True)
        assert len(own.kept) + len(own.kept_before) < 20 and "x" * 60 not in own.kept


def test_heap_and_array_agree():
    short = [piece * 2 for piece in list(VOCABULARY.ids)[::50]] + ["a\u0301b", "zz\n\n", "\u4e00\u4e01q"]
    assert VOCABULARY.merged_together(short) == [VOCABULARY.merged(s) for s in short]


def test_no_merge_is_cut():
    letters = pieces.stretches(["ab", "b\u0301", "▁a", ".,", "▁."])
    assert letters.findall("▁ab\u0301.,▁.a12\n") == ["▁ab\u0301", ".,▁.a", "12\n"]
    for piece in VOCABULARY.ids:
        assert VOCABULARY.stretches.findall(piece) == [piece]


def expected(text):
    ids = LIBRARY.encode(text or "", add_eos=True)
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(), True)


def test_the_given_documents(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in __import__("__spark_entry__").queries()["op12_pieces"](spark, SF).collect()}
    assert got == {r["doc_id"]: expected(r["text"]) for r in rows}


def test_awkward_rows(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [(None, "no id"), (None, None), (50, None), (1, " "), (1, " "), (51, "long text " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit("?").alias(c) for c in ("n_tokens", "agrees", "ids_sha256", "decoded_sha256", "ids")])
    got = [tuple(r) for r in pieces.encode_table(docs, MODEL).collect()]
    assert sorted(got, key=str) == sorted([(i, *expected(t)) for i, t in rows], key=str)
    assert pieces.encode_table(docs.limit(0), MODEL).count() == 0


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("select 1L as doc_id, cast(unhex('61FF62E282') as string) as text")
    assert [tuple(r) for r in pieces.encode_table(docs, MODEL).collect()] == [(1, *expected("a�b�"))]


def test_other_vocabularies_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as format_

    for change in ("unigram", "rules", "bytes"):
        proto = format_.ModelProto()
        proto.ParseFromString(MODEL)
        if change == "unigram":
            proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
        elif change == "rules":
            proto.normalizer_spec.precompiled_charsmap = b"x"
        else:
            proto.trainer_spec.byte_fallback = False
        with pytest.raises(ValueError):
            pieces.Vocabulary(proto.SerializeToString())
    (tmp_path / "large").write_bytes(b"x" * 100)
    with pytest.MonkeyPatch.context() as patch, pytest.raises(ValueError):
        patch.setattr(pieces, "LARGEST", 50)
        pieces.read_model(str(tmp_path / "large"))
