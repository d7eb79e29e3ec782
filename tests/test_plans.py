"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventloom.operators.grouped import first_per_group, latest_by
from eventloom.operators.responses import first_response
from eventloom.plans import lifecycle as lc
from eventloom.plans import staging
from eventloom.sinks.tables import write_bronze
from eventloom.sources.bronze import landed_hours, read_bronze


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """Plan after the adaptive changes of a finished run."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture
def stored_bronze(spark, archive, tmp_path):
    for day in ("2014-12-31", "2015-03-01", "2015-03-02"):
        archive.opened(f"p{day}", 1, f"{day}T10:00:00", (1, "ann"))
        archive.review(f"r{day}", 1, f"{day}T11:00:00", (2, "bob"))
        archive.add(f"w{day}", "WatchEvent", f"{day}T11:00:00", (2, "bob"), "{}")
    root = str(tmp_path / "bronze")
    write_bronze(archive.frame(spark), root)
    return read_bronze(spark, root), root


def test_staging_prunes_folders_and_row_groups(spark, stored_bronze, seed):
    text = plan(staging.stage_pull_requests(stored_bronze[0], seed))
    assert re.search(r"PartitionFilters: \[isnotnull\(dt#\d+\), \(dt#\d+ >= 2015-01-01\)\]", text)
    assert "EqualTo(type,PullRequestEvent)" in text
    assert "org" not in re.search(r"ReadSchema: \S+", text).group(0)


def test_watches_never_read_the_payload(spark, stored_bronze, seed):
    schema = re.search(r"ReadSchema: \S+", plan(staging.stage_watches(stored_bronze[0], seed))).group(0)
    assert "payload" not in schema


def test_payload_stays_out_of_the_shuffle(spark, stored_bronze, seed):
    text = staging.stage_pull_requests(stored_bronze[0], seed)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (\[.*?\])\n", text)
    assert exchanges and not any("payload" in columns for columns in exchanges)
    assert any("event_id" in columns for columns in exchanges)


def test_landed_hours_opens_no_data_file(spark, stored_bronze):
    text = plan(landed_hours(spark, stored_bronze[1]))
    assert "Format: BINARYFILE" in text and "ReadSchema: struct<>" in text


def test_groups_are_cut_before_the_shuffle(spark, stored_bronze, seed):
    text = plan(staging.stage_pull_requests(stored_bronze[0], seed))
    shuffle = text.index("Exchange hashpartitioning(event_id")
    assert "WindowGroupLimit" in text[:shuffle] and "Partial" in text[shuffle:].split("Sort", 1)[0]


def test_latest_by_hashes_the_full_input(spark):
    df = spark.createDataFrame([(1, "a", datetime(2024, 1, 1))], "k int, name string, t timestamp")
    text = plan(latest_by(df, ["k"], "name", "t"))
    deepest = text[text.index("Exchange hashpartitioning(k#", text.index("name")) :]
    assert "HashAggregate(keys=[k#" in deepest and "SortAggregate" not in deepest.split("HashAggregate", 1)[1]


def test_hot_key_is_split_in_the_response_join(spark):
    """One pull request holds nearly all responses; its join partition is split."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        opened = datetime(2024, 1, 1)
        opens = spark.range(50).select(
            F.lit(1).cast("long").alias("repo_id"),
            F.col("id").alias("pr_number"),
            F.col("id").alias("pr_author_id"),
            F.lit(opened).alias("pr_created_at"),
        )
        hot = spark.range(0, 60000, 1, 8).select(
            F.lit(1).cast("long").alias("repo_id"),
            F.when(F.col("id") < 55000, 7).otherwise(F.col("id") % 50).alias("pr_number"),
            (F.hash("id") % 1000).cast("long").alias("responder_id"),
            (F.lit(opened) + F.make_dt_interval(secs=F.col("id") + 60)).alias("responded_at"),
        )
        answered = first_response(
            opens,
            hot,
            lc.PR_KEY,
            author="pr_author_id",
            opened="pr_created_at",
            responder="responder_id",
            responded="responded_at",
            out="first_review_at",
        )
        text = final_plan(answered)
        assert "skew=true" in text
        found = {r.pr_number: r.first_review_at for r in answered.collect()}
        assert len(found) == 50 and found[7] == opened + timedelta(seconds=60)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_first_per_group_with_a_hot_key(spark):
    df = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") < 30000, None).otherwise(F.col("id")).alias("k"), (40000 - F.col("id")).alias("o")
    )
    kept = first_per_group(df, ["k"], ["o"])
    assert kept.count() == 10001
    assert kept.where("k IS NULL").first().o == 40000 - 29999

