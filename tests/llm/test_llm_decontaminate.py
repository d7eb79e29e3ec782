from __future__ import annotations

import random

import numpy as np
import pytest

from eventloom.llm import decontaminate as dc
from eventloom.llm.queries import QUERIES

ITEM = "item_id long, text string"
DOC = "doc_id long, text string, item_id long"


def items(rng, n):
    rows = []
    for i in range(n):
        words = [f"w{min(rng.randrange(1, 3000), rng.randrange(1, 3000))}" for _ in range(rng.randrange(12, 50))]
        rows.append((i, " ".join(words[:-5]).capitalize() + rng.choice(["? ", "\n", " "]) + " ".join(words[-5:])))
    return rows


def index_of(rows):
    texts = [(i, t) for i, t in rows if t]
    sets = [set(dc.WORD.findall(t.lower())) for _, t in texts]
    frequency = {w: sum(w in s for s in sets) for s in sets for w in s}
    mean = sum(len(dc.WORD.findall(t)) for _, t in texts) / len(texts)
    return dc.build_index(texts, frequency, len(texts), mean)


def test_wand_finds_all_above_threshold():
    rng = random.Random(4)
    index = index_of(items(rng, 300))
    for least in (0.05, 0.2, 0.6):
        for _ in range(60):
            words = np.array(sorted(rng.sample(range(len(index.words)), 60)))
            scores = np.zeros(len(index.ids))
            for w in words:
                numbers, impacts = index.postings[w]
                scores[numbers] += impacts
            got = dict(dc.wand(index, words, least))
            assert set(got) == set(np.flatnonzero(scores >= least - 1e-9))
            assert all(abs(scores[i] - s) < 1e-9 for i, s in got.items())


@pytest.mark.parametrize("part_items", [20_000, 90])
def test_planted_items(spark, monkeypatch, part_items):
    monkeypatch.setattr(dc, "PART_ITEMS", part_items)
    rng = random.Random(6)
    bench = items(rng, 100)
    docs, want = [], set()
    for d in range(150):
        words = [f"w{rng.randrange(1, 3000)}" for _ in range(rng.randrange(0, 400))]
        for i in rng.sample(range(100), rng.randrange(3)) if d % 3 == 0 else []:
            at = rng.randrange(len(words) + 1)
            copy = bench[i][1].upper().replace(" ", " - ") if rng.random() < 0.3 else bench[i][1]
            words = words[:at] + ["|"] + copy.split(" ") + ["|"] + words[at:]
            want.add((d, i))
        docs.append((d, " ".join(words), 0))
    index = index_of(bench)
    plain = set()
    for d, text, _ in docs:  # every passage of the item's length against every item
        words = dc.WORD.findall(text.lower())
        have = dc.grams(words)
        for i, parts in zip(index.ids, index.parts, strict=True):
            both = parts[0] | parts[1]
            if sum(g in have for g in both) >= dc.OVERLAP * len(both):
                plain.add((d, i))
    found = dc.contaminated(spark.createDataFrame(docs, DOC), spark.createDataFrame(bench, ITEM)).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(got) == len(found)
    assert got == plain
    assert len(want - got) <= len(want) // 20  # a copy may be parted by another one put inside it


def test_edges(spark):
    text = "one two three four five six seven eight nine ten? eleven twelve"
    bench = [(1, None), (2, ""), (3, "?!"), (None, text), (5, text.upper()), (6, "so?")]
    docs = [(1, None, 1), (2, "", 1), (None, f"x {text} y", 1), (4, "z " * 100_000 + text, 1), (4, text, 1)]
    rows = dc.contaminated(spark.createDataFrame(docs, DOC), spark.createDataFrame(bench, ITEM)).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in rows) == sorted((d, i) for d in ("None", "4", "4") for i in ("None", "5"))
    empty = spark.createDataFrame([], ITEM)
    assert dc.contaminated(spark.createDataFrame(docs, DOC), empty).count() == 0
    assert dc.contaminated(spark.createDataFrame([], DOC), spark.createDataFrame(bench, ITEM)).count() == 0


def test_items_of_one_id_or_none(spark):
    one = "which river runs through the old town of stone? the green one"
    two = "who lit the lamp in the garden of glass? nobody at all"
    docs = [(1, f"a b {one} c d", 0), (2, f"e f {two} g h", 0), (3, "Paris is a town in which the river runs", 0), (4, "paris!", 0)]
    for ids in ((7, 8), (7, 7), (None, None)):
        bench = [(ids[0], one), (ids[1], two), (ids[1], two), (9, "Paris"), (10, "?\n")]
        rows = dc.contaminated(spark.createDataFrame(docs, DOC), spark.createDataFrame(bench, ITEM)).collect()
        assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, ids[0]), (2, ids[1]), (4, 9)]


def test_index_holds_no_table_of_words_by_blocks():
    index = index_of(items(random.Random(3), 600))
    postings = sum(len(numbers) for numbers, _ in index.postings)
    assert sum(len(blocks) for blocks, _ in index.maxima) <= postings < len(index.words) * (600 // dc.BLOCK) / 4


def test_one_item_longer_than_a_part(spark, monkeypatch):
    monkeypatch.setattr(dc, "PART_CHARS", 300)
    bench = items(random.Random(9), 12) + [(99, " ".join(f"long{i}" for i in range(400)) + "? so it is")]
    docs = [(i, text, 0) for i, text in bench]
    rows = dc.contaminated(spark.createDataFrame(docs, DOC), spark.createDataFrame(bench, ITEM)).collect()
    assert {(i, i) for i, _ in bench} == {(r.doc_id, r.item_id) for r in rows}


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontaminate"](spark, sf_dir).collect()}
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = {(d.doc_id, b.item_id) for d in docs for b in bench if b.text in d.text}
    assert want and want == found
