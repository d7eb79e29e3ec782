"""Language ID, URL filter, top-k search and license scan: against SQL, plain versions and edge cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from eventloom.llm import langid, licenses, topk, urls
from eventloom.llm.oracle import ORACLE_SQL
from eventloom.llm.queries import QUERIES, URL_RULES
from tools.compare import connect, problems

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    count, found = problems(connect(SF_DIR), result, ORACLE_SQL[name])
    assert not found and count > 0
    if name in ("op3_url_filter", "op5_license_scan"):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert not any(node in plan for node in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


# --- language ID ------------------------------------------------------------


def test_held_out_accuracy(spark):
    rows = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and len(held) > 100
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    en, fr = "the river and the old stone bridge ", "le fleuve et le vieux pont de pierre "
    rows = [(i, (en, fr)[i % 2] * (1 + i % 3), ("en", "fr")[i % 2], "x") for i in range(40)]
    odd = [(100, None, "en", "x"), (101, "", None, "x"), (102, "12 ² !?", "fr", "x"), (103, "日本", None, "x")]
    odd += [(104, "stones", None, "x"), (105, fr.upper() * 5000, None, "x"), (None, en, "fr", "x"), (104, "stones", None, "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    found = langid.predict(docs)
    assert found.columns == [*docs.columns, "language_found"]
    got = {r.doc_id: tuple(r.language_found) for r in found.collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[103] == ("en", 0.5)
    assert [got[i][0] for i in (104, 105, None)] == ["en", "fr", "en"]
    assert found.count() == len(rows + odd)
    untaught = langid.predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.language_found.lang for r in untaught} == {"und"}
    assert langid.predict(docs.where("false")).count() == 0


def test_scorer_forgets_words(monkeypatch):
    import numpy as np

    model = langid.Model(["a", "b"], {"x": 0, "\ty": 1}, np.array([[1, -1], [-2, 2]], np.float32))
    few = langid.Scorer(model)
    few.most, few.table = 3, few.table[:3]
    words = [random.Random(1).choice(["x", "y", "zy", "q", "yy", "xx"]) for _ in range(200)]
    assert few.judge(" ".join(words)) == langid.Scorer(model).judge(" ".join(words))


# --- URL filter -------------------------------------------------------------


def test_hosts_paths_and_rules(spark):
    cases = {
        None: ("", "", None, None),
        "no scheme": ("", "", None, None),
        "http://": ("", "", None, None),
        "HTTP://A.Example.ORG/es/x?y#z": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "x://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "x://badexample.org/en/12": ("badexample.org", "/en/12", "org/", "allow"),
        "x://org/": ("org", "/", "org/", "allow"),
        "x://example.org?u=http://b.com/de/": ("example.org", "", None, None),
        "x://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
        "x://a.com/fr/\nb": ("a.com", "/fr/\nb", "com/fr/", "allow"),
        "a\n://É.com#/fr/": ("É.com", "", None, None),
    }
    rows = spark.createDataFrame([(u,) for u in cases], "url string")
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    rule = urls.rule_for(host, path, URL_RULES)
    for r in rows.select("url", host.alias("h"), path.alias("p"), rule["rule"].alias("r"), rule["verdict"].alias("v")).collect():
        assert (r.h, r.p, r.r, r.v) == cases[r.url]


def test_reputation_blocks_bad_hosts(spark):
    rows = [(f"x://{h}.site.net/{i}", bad) for h, n, bad in (("bad", 40, 1), ("good", 200, 0)) for i in range(n)]
    rows += [(f"x://mixed{h}.site.net/{i}", int(i % 4 == 0)) for h in range(6) for i in range(40)]
    rows += [("x://few.site.net/", 1), ("x://none.site.net/", None), (None, None)]
    outcomes = spark.createDataFrame(rows, "url string, bad int")
    pages = outcomes.select(F.monotonically_increasing_id().alias("page_id"), "url", F.lit("x").alias("host"))
    got = {r.host: r for r in urls.judge(pages, outcomes).collect()}
    assert [h for h, r in got.items() if r.verdict == "block"] == ["bad.site.net"] and len(got) == 11
    assert (got["bad.site.net"].host_labelled, got["none.site.net"].host_labelled) == (40, 0)
    assert urls.judge(pages.where("false"), outcomes.where("false")).count() == 0
    assert {r.verdict for r in urls.judge(pages, outcomes.withColumn("bad", F.lit(None).cast("int"))).collect()} == {"allow"}


# --- top-k ------------------------------------------------------------------


def plain_top(rows, queries, k):
    out = []
    for q, x in queries:
        scored = [(-sum(int(a) * int(b) for a, b in zip(x, y, strict=True)), c) for c, y in rows if c != q and len(x) == len(y)]
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_top_k_equals_all_pairs(spark, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rows = [(i, [float(rng.randrange(-99, 99)) for _ in range(20)]) for i in range(400)]
    rows += [(1000 + i, [50.0] * 20) for i in range(60)] + [(2000, [1.0, 2.0]), (2001, [3.0, 4.0]), (2002, []), (2003, [])]
    rows += [(3000 + i, [0.0] * 20) for i in range(20)] + [(7, rows[7][1])]
    frame = spark.createDataFrame(rows, "id long, vector array<double>").repartition(5)
    queries = [r for r in rows if r[0] % 20 == 0 or r[0] in (1003, 2001, 2003)]
    asked = spark.createDataFrame(queries, "id long, vector array<double>")
    got = sorted(tuple(r) for r in topk.top_k(asked, frame, 10).collect())
    assert got == plain_top(rows, queries, 10)
    assert topk.top_k(asked.where("false"), frame).count() == 0
    assert topk.top_k(asked, frame.where("false")).count() == 0


def test_bounds_drop_candidates():
    import numpy as np

    rng = np.random.default_rng(1)
    columns, query = np.floor(rng.normal(0, 100, (64, 2000))), np.floor(rng.normal(0, 100, 64))
    scores = query @ columns
    least = float(np.sort(scores)[-10])
    left = topk._lengths(query[:, None])[:, 0]
    kept = topk.survivors(query, left, columns, topk._lengths(columns), least)
    assert set(np.flatnonzero(scores >= least)) <= set(kept)
    assert len(kept) < 30


def test_unusable_and_huge_vectors(spark):
    nan, inf, big = float("nan"), float("inf"), 2.0**70
    rows = [(0, [1.0]), (1, None), (2, [None]), (3, [nan]), (4, [inf]), (5, [2.0]), (6, [big]), (7, [-big]), (None, [9.0])]
    frame = spark.createDataFrame(rows, "id long, vector array<double>").where(topk.usable(F.col("vector")))
    got = [tuple(r) for r in topk.top_k(frame.where("id in (0, 6)"), frame).orderBy("query_id", "rank").collect()]
    most = 2**63 - 1
    assert got == [
        (0, 1, 6, most), (0, 2, 5, 2), (0, 3, 7, -(2**63)),
        (6, 1, 0, most), (6, 2, 5, most), (6, 3, 7, -(2**63)),
    ]


# --- licenses ---------------------------------------------------------------


def test_license_edges(spark):
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, "The MIT-License; mit license\nMIT\nLICENSE", "x"),
        (4, "Licensed under the Apache License, Version 2.0.", "x"),
        (5, "licensed under apache\nlicense version 2 0", "x"),
        (6, "word " * 50_000 + "GNU General Public\tLicense", "x"),
        (None, "Éé All RIGHTS (reserved) licenses", "x"),
        (3, "mit license", "x"),
        (9, "submit license mit licensee", "x"),
    ]
    got = [
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 3))
        for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string")).collect()
    ]
    assert sorted(got, key=str) == sorted(
        [
            (1, 0, 0, None, None, "", "", 0.0),
            (2, 0, 0, None, None, "", "", 0.0),
            (3, 7, 3, 1, 5, "mit", "mit", 0.0),
            (4, 8, 1, 3, 3, "apache", "apache", 1.0),
            (5, 7, 1, 2, 2, "apache", "apache", 0.875),
            (6, 50_004, 1, 50_001, 50_001, "gpl", "gpl", 0.0),
            (None, 5, 0, None, None, "", "reserved", 1.0),
            (3, 2, 1, 0, 0, "mit", "mit", 0.0),
            (9, 4, 0, None, None, "", "", 0.0),
        ],
        key=str,
    )


def test_template_join_equals_all_pairs(spark):
    rng = random.Random(11)
    vocabulary = [f"t{i}" for i in range(40)]
    templates = [(" ".join(rng.sample(vocabulary, rng.randrange(1, 14))), f"l{i}") for i in range(25)]
    blocks = [(i, rng.sample(vocabulary, rng.randrange(1, 30))) for i in range(400)]
    want = set()
    for i, words in blocks:
        for text, label in templates:
            own = set(text.split())
            if 10 * len(own & set(words)) >= 8 * len(own):
                want.add((i, label, len(own & set(words)) / len(own)))
    frame = spark.createDataFrame(blocks, "row long, words array<string>")
    got = [tuple(r) for r in licenses.template_matches(frame, templates).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert licenses.template_matches(frame, []).count() == 0
    assert licenses.template_matches(frame.where("false"), templates).count() == 0
