"""Byte-level BPE against the library and against merging by rank."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from clicktide.llm import byte_bpe, queries
from tests.llm.helpers import SF, awkward, documents_of, empty, needs_data, random_texts, rows_of

ENCODER = byte_bpe.encoder_of(queries.BYTE_RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ENCODER.ranks, special_tokens={}
)
WORDS = ["a", " the", "ing", "\n", "\t", "  ", "é", "日本", "😀", "'s", "1", "22", "!!", "x" * 30, "Z", " ab", "\x00", "ﬁ"]


def same(text):
    ids = ENCODER.encode(text)
    assert ids.tolist() == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


def test_random_texts():
    for text in random_texts(3000, WORDS, 40):
        same(text)


@settings(max_examples=200, deadline=None)
@given(st.text("abenrstion ", min_size=1, max_size=25))
def test_backtracking_is_merging_by_rank(text):
    piece = text.encode()
    assert list(ENCODER.backtrack(piece.decode("latin-1"))) == ENCODER.merged(piece)


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 20_000, " " * 20_000, "日" * 9000, "<|endoftext|>", "0123456789" * 3000])
def test_long_pieces(text):
    same(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_ENTRIES", 7)
    small = byte_bpe.BytePairEncoder(ENCODER.ranks, public_tokenizers.PATTERN)
    for text in random_texts(300, WORDS, 30):
        assert small.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_ranks_must_have_all_bytes():
    with pytest.raises(ValueError, match="no token"):
        byte_bpe.BytePairEncoder({b"a": 0}, ".")


@needs_data
def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = rows_of(queries.op10_byte_bpe(spark, SF))
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        ids = LIBRARY.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_awkward_rows(spark):
    def code(frame):
        return byte_bpe.encode_decode(frame, queries.BYTE_RANKS, public_tokenizers.PATTERN).collect()

    rows = code(awkward(spark))
    assert len(rows) == 8 and [r.ids for r in rows if r.doc_id in (1, 2)] == [[], []]
    assert [bytes(r.decoded) for r in rows if r.doc_id == 6] == ["Größe, naïve café 😀 日本語 \x00 end".encode()]
    assert code(empty(awkward(spark))) == []
    assert code(documents_of(spark, ["", None]))[1].decoded == b""
