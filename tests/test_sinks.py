from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from eventloom.sinks import tables

DAY = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "repo_id long, t timestamp, v string")


def values(df):
    return sorted(r.v for r in df.collect())


def test_mark_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(1, DAY, "a"), (1, DAY + timedelta(hours=2), "b"), (1, None, "no time")]
    tables.append_incremental(frame(spark, first), path, "t")
    more = [
        *first,
        (1, DAY + timedelta(hours=1), "late"),
        (1, DAY + timedelta(hours=2), "same second"),
        (1, DAY + timedelta(hours=3), "c"),
    ]
    tables.append_incremental(frame(spark, more), path, "t")
    tables.append_incremental(frame(spark, more), path, "t")
    assert values(spark.read.parquet(path)) == ["a", "b", "c"]


def test_append_new_finds_late_rows_by_key(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(1, DAY, "a"), (1, DAY + timedelta(days=2), "b")]
    more = [*first, (1, DAY + timedelta(days=1), "late"), (1, DAY + timedelta(days=2), "same second")]
    tables.append_new(frame(spark, first), path, ["v"], "t", "2024-01-01")
    for _ in range(2):
        tables.append_new(frame(spark, more), path, ["v"], "t", "2024-01-02")
    assert values(spark.read.parquet(path)) == ["a", "b", "late", "same second"]


def test_mark_does_not_pass_through_the_drivers_clock(spark, tmp_path, monkeypatch):
    """The hour that a clock change repeats is two hours."""
    import time

    path = str(tmp_path / "t")
    rows = spark.sql("SELECT 1L AS repo_id, timestamp_seconds(1446359400L + 3600 * id) AS t, 'v' AS v FROM range(2)")
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        for _ in range(3):
            tables.append_incremental(rows, path, "t")
    finally:
        monkeypatch.undo()
        time.tzset()
    assert spark.read.parquet(path).count() == 2


def test_append_to_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_incremental(frame(spark, []), path, "t")
    tables.append_incremental(frame(spark, [(1, DAY, "a")]), path, "t")
    assert values(spark.read.parquet(path)) == ["a"]


def test_published_versions_switch_when_done(spark, tmp_path):
    root = str(tmp_path / "t")
    assert tables.read_published(spark, root) is None
    assert tables.upsert_table(frame(spark, [(1, DAY, "a"), (2, DAY, "b")]), root, ["repo_id"]) == 1
    before = tables.read_published(spark, root)
    # the new version reads the old one
    assert tables.upsert_table(frame(spark, [(2, DAY, "B"), (3, DAY, "c")]), root, ["repo_id"]) == 2
    assert values(before) == ["a", "b"]
    assert values(tables.read_published(spark, root)) == ["B", "a", "c"]
    # an unfinished version is not seen, and is written over
    tables.publish(frame(spark, [(9, DAY, "x")]), root)
    (Path(root) / "version=3" / "_SUCCESS").unlink()
    assert values(tables.read_published(spark, root)) == ["B", "a", "c"]
    assert tables.publish(frame(spark, [(8, DAY, "y")]), root) == 3
    assert values(tables.read_published(spark, root)) == ["y"]


def test_mart_is_partitioned_by_day_and_sorted(spark, tmp_path):
    path = str(tmp_path / "mart")
    rows = [(i % 7, DAY + timedelta(days=i % 3), str(i)) for i in range(60)]
    tables.write_mart(frame(spark, rows), path, "t")
    stored = spark.read.parquet(path)
    assert stored.count() == 60
    assert sorted(r.day for r in stored.select("day").distinct().collect()) == [date(2024, 1, d) for d in (1, 2, 3)]
    for folder in Path(path).glob("day=*"):
        for file in folder.glob("*.parquet"):
            repos = [r.repo_id for r in spark.read.parquet(str(file)).collect()]
            assert repos == sorted(repos)
    tables.overwrite_partitions(frame(spark, [(1, DAY, "new")]), path, "t")
    again = spark.read.parquet(path)
    assert again.where(F.col("day") == "2024-01-01").count() == 1 and again.count() == 41


def test_old_versions_stay_until_dropped(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(5):
        tables.publish(frame(spark, [(i, DAY, "a")]), root)
    assert tables.published_versions(spark, root) == [1, 2, 3, 4, 5]
    tables.drop_versions(spark, root, keep=2)
    assert tables.published_versions(spark, root) == [4, 5]
