"""The pipeline on a small fixture, stage by stage against plain versions."""

from __future__ import annotations

import random

import corpus_pipeline as cp
from eventloom.llm.queries import table
from tests.llm.test_llm_neardup import plain

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)


def test_stages_on_the_given_tables(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in cp.STAGES:
        before, docs = docs, cp.stored(stage(spark, docs, SF_DIR), name)
        texts = {r.doc_id: r.text for r in before.collect()}
        kept = {r.doc_id for r in docs.collect()}
        if name != "sentencepiece":
            assert docs.columns == before.columns
        if name == "language_id":
            assert kept == set(rows)
        elif name == "minhash_neardup":
            assert kept == {d for d, _, c in plain(list(texts.items())) if d == c}
        elif name == "benchmark_decontamination":
            items = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
            assert kept == {d for d, t in texts.items() if not any(i in t for i in items)}
        elif name == "sentencepiece":
            assert kept == set(texts) and all(r.lossless for r in docs.collect())
    assert sorted(map(str, cp.run(spark, SF_DIR).collect())) == sorted(map(str, docs.collect()))


def test_planted_rows(spark):
    rng = random.Random(8)

    def prose(n):
        return " ".join(rng.choice(["the", "and", "of", "river", "stone", "lamp", "garden"]) + str(rng.randrange(999)) for _ in range(n))

    shared, copy, clean = prose(60), prose(200), [(50 + i, prose(120)) for i in range(10)]
    rows = [(1, "12345 !!"), (2, None), (3, copy), (4, copy), (5, copy + " more"), (6, f"{prose(50)} {shared} {prose(50)}")]
    rows += [(7, f"{prose(50)} {shared} {prose(50)}"), (None, prose(30)), *clean]
    docs = frame(spark, rows)
    docs = cp.stored(cp.language_id(spark, docs, SF_DIR), "a")
    assert {r.doc_id for r in docs.collect()} == {3, 4, 5, 6, 7, None, *[d for d, _ in clean]}
    docs = cp.stored(cp.minhash_neardup(spark, docs, SF_DIR), "b")
    assert {r.doc_id for r in docs.collect()} == {3, 6, 7, None, *[d for d, _ in clean]}
    docs = cp.stored(cp.substring_dedup(spark, docs, SF_DIR), "c")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert shared in texts[6] and shared not in texts[7]
    assert all(texts[d] == t for d, t in clean)
    assert all(r.n_chars == len(r.text) for r in docs.collect())


def test_empty_table(spark):
    docs = frame(spark, [])
    for name, stage in cp.STAGES:
        docs = cp.stored(stage(spark, docs, SF_DIR), name)
        assert docs.count() == 0


def test_clashing_names_and_no_n_chars(spark):
    names = "doc_id long, text string, lang string, dropped_id string, language_found string, found_id string, found_places int"
    prose = " ".join(f"the{i} and{i % 7} of{i % 11}" for i in range(40))
    rows = [(1, prose, "en", "a", "b", "c", 1), (2, prose, "en", "d", "e", "f", 2), (3, "12", None, None, None, None, None)]
    docs = spark.createDataFrame(rows, names)
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, SF_DIR), name)
    assert [tuple(r) for r in docs.collect()] == [rows[0]]
