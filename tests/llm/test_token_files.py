"""Token files against the tokenizer itself, and the wavelet matrix against plain lists."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventpulse.llm.token_files import BatchEncoder, read_documents, write_token_files
from eventpulse.llm.wavelet import WaveletMatrix

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "\n", " \n x", "a  b", "it's 's 't 're'll 've x'd'm 'sx '", "'", "a'", "don't''s", "x 's",
    "12abc 3½ Ⅷ²", "日本語 テスト😀 é", "<|endoftext|> a", "\t\t a b　c ", "a\x00b\x1c\x85",
    "'re", "'r", "e", "'", "s", " '", "ll", "éèñ ß ª º ǅ", "١٢٣ ௧", "--- !?x", "x" * 3000, "a \r\n\r\n  b  ",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def encoded(encoder, texts):
    ids, counts = encoder.encode(pa.array(texts, pa.large_string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_encoder_on_odd_texts(library):
    assert encoded(BatchEncoder(PATH), ODD) == library(ODD)


_encoder = BatchEncoder(PATH)
_chars = st.one_of(st.sampled_from("'stremvld  \n\t!1aé.  "), st.characters(exclude_categories=["Cs"]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(_chars, max_size=30), min_size=1, max_size=6))
def test_encoder_on_any_texts(library, texts):
    assert encoded(_encoder, texts) == library(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=300), st.integers(1, 30))
def test_wavelet_matrix(values, times):
    values = values * times
    made = WaveletMatrix.from_bytes(WaveletMatrix.build(np.array(values, np.uint32)).to_bytes())
    assert made.ids.tolist() == values
    for i in range(0, len(values), max(1, len(values) // 7)):
        token = values[i]
        assert made.access(i) == token
        assert made.count(token, i) == values[:i].count(token)
        assert made.select(token, values[:i].count(token)) == i
    assert made.count(99_999) == 0
    with pytest.raises(IndexError):
        made.access(len(values))


def test_files_of_documents(spark, frame, library):
    rows = [(7 * i % 31 if i % 9 else None, ODD[i % len(ODD)] if i % 5 else None) for i in range(90)]
    docs = frame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS shard", "'x' AS payload")
    got = sorted(tuple(r) for r in read_documents(write_token_files(docs, PATH)).select("start", "doc_id", "n_tokens", "ids_crc32").collect())
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    assert [r[1] is not None and r[1] for r in got] == sorted((r[0] is not None and r[0] for r in rows), key=lambda x: (x is not False, x))
    want = {}
    for (doc_id, text), ids in zip(rows, library([t or "" for _, t in rows])):
        want.setdefault(doc_id, []).append((len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())))
    have = {}
    for _, doc_id, n, crc in got:
        have.setdefault(doc_id, []).append((n, crc))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


def test_very_long_texts(frame, library):
    dice = random.Random(3)
    texts = ["word é 12, " * 40_000, "x" * 100_000, "\n" * 50_000, "".join(dice.choices("ab cé1'\n", k=200_000)), "日本語 " * 30_000]
    rows = [(i, text) for i, text in enumerate(texts)] + [(10 + i, f"short {i}") for i in range(20)]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in read_documents(write_token_files(frame(rows, "doc_id bigint, text string"), PATH)).collect()}
    at = 0
    for (doc_id, _), ids in zip(rows, library([t for _, t in rows])):
        assert got[doc_id] == (at, len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes()))
        at += len(ids) + 1


def test_empty_table(frame):
    assert read_documents(write_token_files(frame([], "doc_id bigint, text string"), PATH)).collect() == []


@pytest.fixture(scope="module")
def default_library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


_added_encoder = BatchEncoder(PATH, added_tokens=True)
_parts = st.lists(st.one_of(st.just("<|endoftext|>"), st.just("<|endof"), st.text(_chars, max_size=8)), max_size=8)


def test_added_tokens_on_odd_texts(default_library):
    assert encoded(_added_encoder, ["a<|endoftext|>b"]) == [[64, 50256, 65]]
    odd = [*ODD, "<|endoftext|>", "<|endoftext|><|endoftext|>", "it<|endoftext|>'s  <|endoftext|>  b ", "", "<|endoftext", "|>"]
    assert encoded(_added_encoder, odd) == default_library(odd)


@settings(max_examples=200, deadline=None)
@given(st.lists(_parts.map("".join), min_size=1, max_size=5))
def test_added_tokens_on_any_texts(default_library, texts):
    assert encoded(_added_encoder, texts) == default_library(texts)


def test_added_tokens_left_to_the_library(tmp_path):
    from tokenizers import AddedToken

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.add_tokens([AddedToken("<x>", lstrip=True, normalized=False)])
    path = str(tmp_path / "own.json")
    tokenizer.save(path)
    texts = ["a  <x> b", "no", "", "<x><|endoftext|>"]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoded(BatchEncoder(path, added_tokens=True), texts) == want


def test_query_gives_added_tokens_their_ids(spark, tmp_path, default_library):
    from eventpulse.llm.queries import op8

    rows = [(1, "a<|endoftext|>b"), (2, "plain"), (3, None), (4, "<|endoftext|>")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in op8(spark, str(tmp_path)).collect()}
    ids = default_library([t or "" for _, t in rows])
    assert got == {i: (len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for (i, _), x in zip(rows, ids)}
