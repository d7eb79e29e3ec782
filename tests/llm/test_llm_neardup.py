from __future__ import annotations

import random
import re

from eventloom.llm import neardup
from eventloom.llm.graph import components
from eventloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain(rows):
    """Component ids by comparing all pairs of shingle sets."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(words[i : i + 2]) for i in range(max(1, len(words) - 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(s), least.get(find(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]


def check(spark, rows):
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)
    assert got == sorted(plain(rows), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_edges(spark):
    text = "a b c d e f g h i j k l m n o p"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\vTwo"), (None, text)]
    rows += [(9, text + " q"), (9, text), (12, text + " x y"), (11, text.upper()), (10, "w " * 50_000)]
    check(spark, rows)


def test_empty(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_groups_of_near_copies(spark):
    rng = random.Random(7)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(150):  # a chain: ever more edits, so that the ends are far apart
        words = list(base)
        for k in range(i // 8):
            words[(7 * k) % 120] = f"x{k}"
        words[rng.randrange(120)] = f"y{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(rng.choices("abcdefghij", k=60))) for i in range(40)]
    check(spark, rows)


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)]
    links += [(999, i) for i in range(900, 999)] + [(5, 5), (None, 3)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        if a is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    want = {i: find(i) for i in list(root) if find(i) != i}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op8_minhash_neardup"](spark, SF_DIR).collect()}
    assert got == set(plain(rows))
