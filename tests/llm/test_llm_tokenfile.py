from __future__ import annotations

from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventloom.llm import tokenfile
from eventloom.llm.queries import QUERIES
from eventloom.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"


FRESH = Tokenizer.from_file(PATH)


def whole(text):
    """By a tokenizer that nothing has been set on."""
    return FRESH.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=2000))
def test_segments_round_trip(ids):
    segment = tokenfile.Segment(tokenfile.pack(np.array(ids, np.uint32)))
    assert segment.read().tolist() == ids
    for i in range(0, len(ids), 37):
        assert segment[i] == ids[i]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="aΣσ'sS \n\t\r\x85  ́é<|endoftext|>1!", max_size=40))
def test_words_encode_as_the_whole_text(text):
    assert tokenfile.encoder(PATH).encode(text).tolist() == whole(text)


@pytest.mark.parametrize(
    "text", ["a <|endoftext|> b", "a<|endoftext|>b", "<|ENDOFTEXT|> É<|startoftext|>", "<|endoftext|>" * 3, "<|endof text|>", "e<|endoftext|>\u0301"]
)
def test_special_tokens(text):
    assert tokenfile.encoder(PATH).encode(text).tolist() == whole(text)


def test_words_are_kept(monkeypatch):
    """The rules in the tokenizer's file are known, so a word that came before is not encoded again."""
    encoder = tokenfile.Encoder(PATH)
    assert encoder.by_words
    want = whole("one two, three.")
    assert encoder.encode("One two, three.").tolist() == want
    monkeypatch.setattr(encoder, "_ids", None)
    assert encoder.encode("one Two, three.").tolist() == want


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    fresh = Tokenizer.from_file(path)
    for text in ("Hello World.\n\n  x", "", "It's <|endoftext|> HERE, é"):
        assert tokenfile.encoder(path).encode(text).tolist() == fresh.encode(text, add_special_tokens=False).ids


def expected(rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        ids = np.array([*whole(text or ""), 2], "<u4")
        out.append((doc, start, len(ids), crc32(ids.tobytes())))
        start += len(ids)
    return out


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


@pytest.mark.parametrize("segment", [50, 1 << 20])
def test_files(spark, monkeypatch, segment):
    monkeypatch.setattr(tokenfile, "SEGMENT", segment)
    rows = [(i * 3, f"text {i} of many words") for i in range(200)]
    rows += [(None, "x"), (None, "<|endoftext|>"), (1, None), (1, ""), (4, "b"), (4, "a"), (4, "a"), (700, "long word " * 30_000), (5, "y" * 5000)]
    path = scratch_path(spark, "tokens")
    tokenfile.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, PATH)
    assert result(tokenfile.read_token_files(spark, path)) == expected(rows)


def test_empty_table(spark):
    path = scratch_path(spark, "tokens")
    tokenfile.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert tokenfile.read_token_files(spark, path).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op10_token_files"](spark, SF_DIR)) == expected(rows)
