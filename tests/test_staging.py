from __future__ import annotations

from conftest import at
from pyspark.sql import functions as F

from eventloom.plans import staging


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


ANN, BOB = (1, "ann"), (2, "bob")


def test_copy_in_adjacent_hour_is_dropped(spark, archive, seed):
    archive.add("a", "WatchEvent", "2015-03-01T10:00:00", ANN, "{}")
    archive.add("a", "WatchEvent", "2015-03-01T10:00:00", ANN, "{}", hour=9)
    assert staging.stage_watches(archive.frame(spark), seed).count() == 1


def test_dedupe_keeps_earliest_and_is_per_type(spark, archive, seed):
    archive.add("a", "WatchEvent", "2015-03-01T10:00:05", ANN, "{}", repo=(1, "later"))
    archive.add("a", "WatchEvent", "2015-03-01T10:00:00", ANN, "{}", repo=(1, "earlier"))
    archive.add("a", "PushEvent", "2015-03-01T09:00:00", ANN, '{"distinct_size": 3}')
    bronze = archive.frame(spark)
    assert rows(staging.stage_watches(bronze, seed), "repo_name") == [("earlier",)]
    assert rows(staging.stage_pushes(bronze, seed), "distinct_commit_count") == [(3,)]


def test_equal_copies_choose_the_same_row_whatever_the_order(spark, archive, seed):
    for name in ("c", "a", "b"):
        archive.add("x", "WatchEvent", "2015-03-01T10:00:00", ANN, "{}", repo=(1, name))
    bronze = archive.frame(spark)
    forward = rows(staging.stage_watches(bronze, seed), "repo_name")
    backward = rows(staging.stage_watches(bronze.orderBy(F.desc("repo.name")), seed), "repo_name")
    assert forward == backward == [("a",)]


def test_null_ids_collapse_to_one_row(spark, archive, seed):
    archive.add(None, "WatchEvent", "2015-03-01T10:00:00", ANN, "{}")
    archive.add(None, "WatchEvent", "2015-03-01T11:00:00", BOB, "{}")
    assert rows(staging.stage_watches(archive.frame(spark), seed), "actor_login") == [("ann",)]


def test_bot_flag(spark, archive, seed):
    logins = ["x[bot]", "X[BOT]", "RENOVATE", "travis-ci", "helper-bot", "bot", None]
    for i, login in enumerate(logins):
        archive.add(str(i), "WatchEvent", "2015-03-01T10:00:00", (i, login), "{}")
    flags = dict(rows(staging.stage_watches(archive.frame(spark), seed), "actor_login", "is_bot_actor"))
    assert flags == {
        "x[bot]": True,
        "X[BOT]": True,
        "RENOVATE": True,
        "travis-ci": True,
        "helper-bot": False,
        "bot": False,
        None: None,
    }


def test_floor_drops_earlier_events(spark, archive, seed):
    archive.add("old", "WatchEvent", "2014-12-31T23:59:59", ANN, "{}")
    archive.add("new", "WatchEvent", "2015-01-01T00:00:00", ANN, "{}")
    # a copy of a new event in a file of the old year does not count on its own
    archive.add("edge", "WatchEvent", "2015-01-01T00:00:00", ANN, "{}", dt="2014-12-31", hour=23)
    assert rows(staging.stage_watches(archive.frame(spark), seed), "event_id") == [("new",)]


def test_values_that_do_not_parse_become_null(spark, archive, seed):
    archive.add("cut", "PullRequestEvent", "2015-03-01T10:00:00", ANN, '{"action": "opened", "num')
    archive.add(
        "odd",
        "PullRequestEvent",
        "2015-03-01T10:00:00",
        ANN,
        {"action": "opened", "number": "seven", "pull_request": {"id": 5, "created_at": "soon", "user": "ann"}},
    )
    archive.add("none", "PullRequestEvent", "2015-03-01T10:00:00", ANN, None)
    staged = staging.stage_pull_requests(archive.frame(spark), seed)
    assert rows(staged, "event_id", "action", "pr_number", "pr_id", "pr_author_id", "pr_created_at") == [
        ("cut", None, None, None, None, None),
        ("none", None, None, None, None, None),
        ("odd", "opened", None, 5, None, None),
    ]


def test_pull_request_columns(spark, archive, seed):
    archive.opened("a", 7, "2015-03-01T10:00:00", (3, "cleo[bot]"), actor=ANN)
    row = staging.stage_pull_requests(archive.frame(spark), seed).first().asDict()
    assert row.pop("event_created_at") == row.pop("pr_created_at") == at("2015-03-01T10:00:00").replace(tzinfo=None)
    assert row == {
        "event_id": "a",
        "actor_id": 1,
        "actor_login": "ann",
        "repo_id": 1,
        "repo_name": "org/one",
        "action": "opened",
        "pr_number": 7,
        "pr_id": 1007,
        "pr_author_login": "cleo[bot]",
        "pr_author_id": 3,
        "pr_closed_at": None,
        "pr_merged_at": None,
        "pr_state": "open",
        "is_bot_actor": False,
        "is_bot_pr_author": True,
    }


def test_pull_request_comments_are_told_from_issue_comments(spark, archive, seed):
    archive.comment("a", 7, "2015-03-01T10:00:00", BOB)
    archive.comment("b", 7, "2015-03-01T10:00:00", BOB, on_pull_request=False)
    staged = staging.stage_issue_comments(archive.frame(spark), seed)
    assert rows(staged, "event_id", "issue_number", "is_pr_comment") == [("a", 7, True), ("b", 7, False)]


def test_first_time_is_that_of_the_staged_rows_and_needs_no_shuffle_of_them(spark, archive, seed):
    archive.opened("a", 1, "2015-03-01T10:00:00", ANN)
    archive.opened("a", 1, "2015-03-01T10:00:00", ANN, hour=9)
    archive.opened(None, 2, "2015-02-01T10:00:00", BOB)
    archive.add("b", "WatchEvent", "2015-01-01T10:00:00", ANN, "{}")
    archive.opened("c", 3, "2014-12-31T10:00:00", BOB)
    bronze = archive.frame(spark)
    found = spark.range(1).select(staging.first_time(bronze, "PullRequestEvent").alias("t"))
    staged = staging.stage_pull_requests(bronze, seed).agg(F.min("event_created_at"))
    assert found.first()[0] == staged.first()[0] == at("2015-02-01T10:00:00").replace(tzinfo=None)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_orders_of_one_row_group_are_dealt_to_all_cores(spark, tmp_path):
    from workload.archive import spread, table

    spark.range(200).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    rows = table(spark, str(tmp_path), "orders")
    dealt = spread(rows)
    tasks = {r.part: r.n for r in dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()}
    assert len(tasks) >= spark.sparkContext.defaultParallelism
    assert sum(tasks.values()) == 200
    assert sorted(r.id for r in dealt.collect()) == list(range(200))
