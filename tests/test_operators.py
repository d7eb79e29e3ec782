from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eventloom.operators import checks
from eventloom.operators.coverage import KNOWN_EVENT_TYPES, landed_range, missing_types, type_coverage
from eventloom.operators.grouped import dedupe_events, latest_by
from eventloom.operators.rows import empty_history, row_differences, scd2_snapshot, upsert

START = datetime(2024, 1, 1)


def test_latest_by_matches_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(800):
        time = None if rng.random() < 0.1 else START + timedelta(seconds=rng.randrange(60))
        name = None if rng.random() < 0.2 else rng.choice("abcd")
        key = rng.choice([None, 1, 2, 3, 4, 5]) if rng.random() < 0.6 else 1  # one key holds half of the rows
        rows.append((key, name, time, rng.choice([True, False, None])))
    df = spark.createDataFrame(rows, "k int, name string, t timestamp, flag boolean")
    found = latest_by(df, ["k"], "name", "t", first_seen="lo", last_seen="hi", any_true=["flag"], count="n")
    got = {r.k: (r.name, r.lo, r.hi, r.flag, r.n) for r in found.collect()}
    want = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        named = [(r[2], r[1]) for r in mine if r[1] is not None and r[2] is not None]
        times = [r[2] for r in mine if r[2] is not None]
        want[key] = (max(named)[1], min(times), max(times), any(r[3] for r in mine), len(mine))
    assert got == want


def test_latest_by_without_any_usable_value(spark):
    df = spark.createDataFrame([(1, None, START), (2, "a", None)], "k int, name string, t timestamp")
    assert {r.k: r.name for r in latest_by(df, ["k"], "name", "t").collect()} == {1: None, 2: None}


def test_dedupe_ignores_unsortable_columns(spark):
    df = spark.createDataFrame([(1, 2, {"a": "b"}), (1, 1, {"c": "d"})], "id int, created_at int, m map<string,string>")
    (row,) = dedupe_events(df).collect()
    assert row.m == {"c": "d"}


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (3, 3, "c")], "x int, y int, v string")
    updates = spark.createDataFrame([(1, None, "A"), (4, 4, "D")], "x int, y int, v string")
    assert {tuple(r) for r in upsert(target, updates, ["x", "y"]).collect()} == {
        (1, None, "A"),
        (1, 2, "b"),
        (3, 3, "c"),
        (4, 4, "D"),
    }


def test_row_differences_counts_copies_and_nulls(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b")], "x int, y string")
    right = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "x int, y string")
    assert {tuple(r) for r in row_differences(left, right).collect()} == {(1, None, 2, 1), (3, "c", 0, 1)}
    assert row_differences(left, left).count() == 0


def test_history_matches_brute_force(spark):
    rng = random.Random(3)
    history, versions = None, []
    for step in range(5):
        as_of = START + timedelta(days=step)
        present = {k: rng.choice(["a", "b", None]) for k in range(30) if rng.random() < 0.7}
        current = spark.createDataFrame(list(present.items()), "id int, name string")
        if history is None:
            history = empty_history(current, "id", ["name"])
        history = scd2_snapshot(history, current, "id", ["name"], F.lit(as_of))
        rows = history.collect()
        history = spark.createDataFrame(rows, history.schema)
        for key, name in present.items():
            live = [v for v in versions if v[0] == key and v[3] is None]
            if not live:
                versions.append([key, name, as_of, None])
            elif live[0][1] != name:
                live[0][3] = as_of
                versions.append([key, name, as_of, None])
        assert {(r.id, r.name, r.valid_from, r.valid_to) for r in rows} == {tuple(v) for v in versions}
        assert len(rows) == len(versions) == len({r.version_id for r in rows})
    assert any(v[3] is not None for v in versions)


def test_coverage(spark):
    rows = [("PushEvent", START), ("PushEvent", START + timedelta(days=2)), ("WatchEvent", START - timedelta(days=1))]
    coverage = type_coverage(spark.createDataFrame(rows, "type string, created_at timestamp"))
    assert [(r.type, r.event_count) for r in coverage.collect()] == [("WatchEvent", 1), ("PushEvent", 2)]
    assert tuple(landed_range(coverage).first()) == (START - timedelta(days=1), START + timedelta(days=2))
    absent = [r.type for r in missing_types(coverage).collect()]
    assert absent == sorted(set(KNOWN_EVENT_TYPES) - {"PushEvent", "WatchEvent"}) and len(KNOWN_EVENT_TYPES) == 17


def test_checks_find_their_violations(spark):
    df = spark.createDataFrame(
        [(1, "opened", 5, 10), (1, "odd", -1, 10), (None, None, None, 3), (None, "opened", 12, 3)],
        "id int, action string, low int, high int",
    )
    assert [tuple(r) for r in checks.check_unique(df, "id").collect()] == [(1, 2)]
    assert checks.check_not_null(df, "id").count() == 2
    assert [tuple(r) for r in checks.check_accepted_values(df, "action", ["opened"]).collect()] == [("odd", 1)]
    assert [tuple(r) for r in checks.check_unique_combination(df, ["id", "high"]).orderBy("high").collect()] == [
        (None, 3, 2),
        (1, 10, 2),
    ]
    assert checks.check_between(df, "low", low=0).count() == 1
    assert checks.check_between(df, "low", 0, 10).count() == 2
    assert checks.check_between(df, "low", 0, 10, "id IS NOT NULL").count() == 1
    assert checks.check_order(df, "low", "high").count() == 1
    report = checks.check_report(
        [
            checks.Check("a", checks.check_not_null(df, "id")),
            checks.Check("b", checks.check_accepted_values(df, "action", ["opened"]), severity="warn"),
            checks.Check("c", df, checks.is_missing("high")),
            checks.Check("d", df, checks.is_outside("low", low=0)),
        ]
    )
    assert {tuple(r) for r in report.collect()} == {
        ("a", "error", 2, "fail"),
        ("b", "warn", 1, "warn"),
        ("c", "error", 0, "pass"),
        ("d", "error", 1, "fail"),
    }


def test_attributable_needs_key_and_time(spark):
    fact = spark.createDataFrame(
        [(1, 1, START), (1, 2, START), (1, 3, None)], "repo_id int, pr_number int, first_review_at timestamp"
    )
    answers = spark.createDataFrame(
        [(1, 1, START), (1, 1, START), (1, 2, START + timedelta(seconds=1)), (2, 2, START)],
        "repo_id int, pr_number int, responded_at timestamp",
    )
    assert [r.pr_number for r in checks.check_attributable(fact, answers).collect()] == [2]
