from __future__ import annotations

import random
import tracemalloc
from zlib import crc32

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.llm import pieces
from eventloom.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = st.text(max_size=60) | st.text(alphabet="abcde the\n .,é▁  ñ1", max_size=200)


@settings(max_examples=300, deadline=None)
@given(TEXTS.filter(lambda t: "▁" not in t))
def test_without_dropout_as_the_library(text):
    got = pieces.encoder(PATH, 0.0, 0).encode([text], ["k"])[0].tolist()
    assert got == LIBRARY.encode(text)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.sampled_from([0.0, 0.1, 0.5, 1.0]), st.integers(0, 3))
def test_lossless(text, dropout, seed):
    work = pieces.encoder(PATH, dropout, seed)
    for key in ("a", None):
        assert work.pieces.decode(work.encode([text], [key])[0]) == text


def test_arrays_and_heap_agree():
    rng = random.Random(5)
    work = pieces.encoder(PATH, 0.2, 9)
    chunks = ["".join(rng.choices("etaoinshr ", k=rng.randrange(2, 40))) for _ in range(2000)]
    symbols = [work.pieces.symbols(c) for c in chunks]
    table = np.full((len(chunks), 41), -1, np.int64)
    for row, s in zip(table, symbols, strict=True):
        row[: len(s)] = s
    keys = pieces.mix(np.arange(len(chunks), dtype=np.uint64))
    got = [row[row != -1].tolist() for row in pieces.in_arrays(work.pieces, table, keys, 0.2)]
    assert got == [pieces.agenda(work.pieces, s.tolist(), int(k), 0.2) for s, k in zip(symbols, keys, strict=True)]


def test_chunks_do_not_depend_on_their_batch():
    work = pieces.Encoder(PATH, 0.3, 4)
    texts = ["some words, and more of them", "other words of them\nand more", "é€ x" * 30]
    together = work.encode(texts, ["k"] * 3)
    for text, ids in zip(texts, together, strict=True):
        assert pieces.Encoder(PATH, 0.3, 4).encode([text], ["k"])[0].tolist() == ids.tolist()


def test_dropout_varies_and_repeats():
    text = "the quick brown fox jumps over the lazy dog " * 5
    plain = LIBRARY.encode(text)
    seen = {tuple(pieces.encoder(PATH, 0.2, seed).encode([text], ["k"])[0]) for seed in range(6)}
    again = {tuple(pieces.Encoder(PATH, 0.2, seed).encode([text], ["k"])[0]) for seed in range(6)}
    assert len(seen) >= 4 and seen == again
    assert sum(len(s) > len(plain) for s in seen) >= 3
    assert pieces.encoder(PATH, 1.0, 0).encode(["abc"], [""])[0].tolist() == [LIBRARY.piece_to_id(p) for p in "▁abc"]


def test_every_occurrence_is_decided_on_its_own():
    """Occurrences of a word in one text, and in many, take many forms, each as the agenda gives it for its key."""
    work, count = pieces.Encoder(PATH, 0.1, 3), 3000
    chunk = " " + "international"
    ids = work.encode([chunk[1:] + chunk * (count - 1)], ["k"])[0].tolist()
    docs = np.full(count, work.key_of("k"), np.uint64)
    own = pieces.mix(pieces.mix(docs) + np.arange(count, dtype=np.uint64))
    symbols = work.pieces.symbols(chunk).tolist()
    each = [pieces.agenda(work.pieces, symbols, int(k), 0.1) for k in own]
    assert ids == [i for row in each for i in row]
    assert len(set(map(tuple, each))) > 20
    seen = {tuple(work.encode([chunk[1:]], [str(k)])[0]) for k in range(count)}
    assert len(seen) > 20


def test_long_texts_and_forgetting(monkeypatch):
    monkeypatch.setattr(pieces, "MOST_CHUNKS", 10)
    work = pieces.Encoder(PATH, 0.1, 1)
    for text in ("x" * 20_000, "many words " * 5_000, "é€\U0001f600" * 2_000):
        assert work.pieces.decode(work.encode([text], ["k"])[0]) == text


def test_columns(spark):
    rows = [(1, "Hello  world", 5), (2, None, 6), (None, "", 7), (1, "Hello  world", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    df = df.withColumn("found", pieces.encode(F.col("text"), F.col("doc_id"), PATH))
    got = df.withColumn("back", pieces.decode(F.col("found"), PATH)).collect()
    assert [r.back for r in got] == ["Hello  world", None, "", "Hello  world"]
    assert got[0].found == got[3].found and got[2].found == []


def test_query(spark):
    got = QUERIES["op7_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(texts)
    work = pieces.encoder(PATH, 0.1, 0)
    for r in got[:40]:
        ids = work.encode([texts[r.doc_id]], [str(r.doc_id)])[0]
        assert (r.n_pieces, r.ids_crc32, r.lossless) == (len(ids), crc32(ids.astype("<u4").tobytes()), True)


def test_memory_does_not_follow_the_merges_of_a_step():
    work = pieces.Encoder(PATH, 0.1, 0)
    work._learn([" international", " words"])
    at, keys = np.tile([0, 1], 100_000), pieces.mix(np.arange(200_000, dtype=np.uint64))
    whole = work._plain(at, keys)
    assert 0 < whole.sum() < len(whole) and (work._plain(at[:999], keys[:999]) == whole[:999]).all()
    tracemalloc.start()
    work._plain(at, keys)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000_000
