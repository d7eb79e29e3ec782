"""Registered queries: each runs library operators over the whole given tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions.bots import with_bot_flag
from eventloom.functions.columns import days, month_start, seconds_between, try_long
from eventloom.operators import checks
from eventloom.operators.calendar import date_spine, dim_date, hour_spine
from eventloom.operators.coverage import landed_range, missing_types, type_coverage
from eventloom.operators.grouped import dedupe_events, first_per_group, latest_by
from eventloom.operators.responses import first_response
from eventloom.operators.rows import empty_history, row_differences, scd2_snapshot
from eventloom.plans import lifecycle as lc
from eventloom.plans import landing, marts, staging, warehouse
from eventloom.session import configure, scratch_path, shuffles_removed
from eventloom.sinks import tables as sinks
from eventloom.sinks.parts import read_parts, upsert_parts
from eventloom.sources import hours
from eventloom.sources.bronze import landed_hours, read_bot_seed, read_bronze, read_timeline_bronze
from eventloom.sources.raw import adapt_timeline, read_raw_events, to_bronze
from workload.archive import (
    BEGINNING,
    START,
    activity,
    archive,
    author_login,
    bot_seed,
    file_times,
    order_repo_id,
    plain,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    @wraps(make)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(make(configure(spark), sf_dir))

    QUERIES[make.__name__] = run
    return run


# --- first response on the tables themselves -------------------------------


def _opens(spark: SparkSession, sf_dir: str, opened: Column) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        order_repo_id().alias("repo_id"),
        F.col("o_orderkey").alias("pr_number"),
        F.col("o_custkey").alias("pr_author_id"),
        opened.alias("opened_at"),
    )


def _first_response_latency(spark: SparkSession, sf_dir: str, opened: Column) -> DataFrame:
    opens = _opens(spark, sf_dir, opened)
    start = opens.agg(F.min("opened_at")).scalar()
    first = first_per_group(opens, ["repo_id", "pr_author_id"], ["opened_at", "pr_number"])
    answered = first_response(
        first,
        table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "pr_number"),
        ["pr_number"],  # order keys are unique over all priorities
        author="pr_author_id",
        opened="opened_at",
        responder="l_suppkey",
        responded="l_shipdate",
        out="first_review_at",
    )
    return first.join(answered, "pr_number", "left").select(
        "repo_id",
        "pr_number",
        "pr_author_id",
        "opened_at",
        "first_review_at",
        seconds_between(F.col("opened_at"), F.col("first_review_at")).alias("review_latency_seconds"),
        F.year("opened_at").alias("opened_year"),
        (F.col("opened_at") <= start + days(90)).alias("is_first_contributor_uncertain"),
    )


@query
def first_response_latency(spark, sf_dir):
    return _first_response_latency(spark, sf_dir, F.col("o_orderdate"))


@query
def first_response_latency_month_ties(spark, sf_dir):
    """Opening times cut to the month, so numbers decide many ties."""
    return _first_response_latency(spark, sf_dir, month_start(F.col("o_orderdate")))


# --- operators on the events table ------------------------------------------


@query
def dedupe_by_id(spark, sf_dir):
    """Every event twice, the copy an hour later."""
    events = table(spark, sf_dir, "events")
    later = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    return dedupe_events(events.unionByName(later), "event_id", "ts")


@query
def dedupe_null_ids(spark, sf_dir):
    """Events without an id collapse into the earliest of them."""
    events = table(spark, sf_dir, "events").withColumn(
        "event_id", F.when(F.col("event_type") != "error", F.col("event_id"))
    )
    return dedupe_events(events, "event_id", "ts")


@query
def bot_flag(spark, sf_dir):
    events = activity(spark, sf_dir).select(
        F.col("id").alias("event_id"),
        F.when(F.col("type") != "IssuesEvent", F.col("actor.login")).alias("actor_login"),
    )
    return with_bot_flag(events, "actor_login", bot_seed(spark, sf_dir), "is_bot_actor")


@query
def json_unnest(spark, sf_dir):
    parsed = table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "k string, z string"))
    return parsed.select(
        "event_id",
        F.col("p.k").alias("k_text"),
        try_long(F.col("p.k")).alias("k"),
        try_long(F.col("event_type")).alias("not_a_number"),
        F.col("p.z").isNotNull().alias("has_z"),
    )


def _timeline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the older shape; those of one kind carry no payload."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("type"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("actor"),
        F.concat(F.lit("https://example.org/"), F.col("event_type")).alias("url"),
        F.struct(
            F.get_json_object("props", "$.k").cast("bigint").alias("id"),
            F.concat(F.lit("repo-"), F.get_json_object("props", "$.k")).alias("name"),
            F.lit(None).cast("string").alias("url"),
        ).alias("repository"),
        F.when(F.col("event_type") != "signup", F.col("props")).alias("payload"),
    )


@query
def timeline_adapter(spark, sf_dir):
    return staging.stage_timeline(adapt_timeline(_timeline_rows(spark, sf_dir)))


# --- staging of the derived archive ------------------------------------------


def _staged(stage, spark: SparkSession, sf_dir: str, start: str = BEGINNING) -> DataFrame:
    return stage(archive(spark, sf_dir), bot_seed(spark, sf_dir), start)


@query
def stage_pull_requests(spark, sf_dir):
    return _staged(staging.stage_pull_requests, spark, sf_dir, START)


@query
def stage_reviews(spark, sf_dir):
    return _staged(staging.stage_reviews, spark, sf_dir, START)


@query
def stage_review_comments(spark, sf_dir):
    return _staged(staging.stage_review_comments, spark, sf_dir, START)


@query
def stage_issue_comments(spark, sf_dir):
    return _staged(staging.stage_issue_comments, spark, sf_dir, START)


@query
def stage_pushes(spark, sf_dir):
    return _staged(staging.stage_pushes, spark, sf_dir, START)


@query
def stage_watches(spark, sf_dir):
    return _staged(staging.stage_watches, spark, sf_dir, START)


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lc.review_candidates(
        _staged(staging.stage_reviews, spark, sf_dir),
        _staged(staging.stage_review_comments, spark, sf_dir),
        _staged(staging.stage_issue_comments, spark, sf_dir),
    )


def _lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    prs = _staged(staging.stage_pull_requests, spark, sf_dir)
    start = staging.first_time(archive(spark, sf_dir), "PullRequestEvent", BEGINNING)
    return lc.pr_lifecycle(prs, _candidates(spark, sf_dir), start=start)


@query
def review_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir)


@query
def pr_lifecycle(spark, sf_dir):
    return _lifecycle(spark, sf_dir)


# --- marts of the derived archive ----------------------------------------------


@query
def fct_pr_review_latency(spark, sf_dir):
    return marts.fct_pr_review_latency(_lifecycle(spark, sf_dir))


@query
def latency_by_repo_year(spark, sf_dir):
    return marts.latency_by_repo_year(marts.fct_pr_review_latency(_lifecycle(spark, sf_dir)))


def _activity_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "prs": _staged(staging.stage_pull_requests, spark, sf_dir),
        "pushes": _staged(staging.stage_pushes, spark, sf_dir),
        "watches": _staged(staging.stage_watches, spark, sf_dir),
    }


@query
def fct_repo_daily_activity(spark, sf_dir):
    return marts.fct_repo_daily_activity(**_activity_sources(spark, sf_dir))


@query
def fct_contributor_cohorts(spark, sf_dir):
    return marts.fct_contributor_cohorts(_staged(staging.stage_pull_requests, spark, sf_dir))


@query
def dim_repo(spark, sf_dir):
    return marts.dim_repo(**_activity_sources(spark, sf_dir))


@query
def dim_actor(spark, sf_dir):
    return marts.dim_actor(**_activity_sources(spark, sf_dir))


@query
def calendar_dim(spark, sf_dir):
    """Calendar over the range of order dates."""
    range_ = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    start = range_.select("a").scalar().cast("date")
    end = F.date_add(range_.select("b").scalar().cast("date"), 1)
    return dim_date(date_spine(spark, start, end))


# --- coverage and hours -----------------------------------------------------------


@query
def event_type_coverage(spark, sf_dir):
    return type_coverage(archive(spark, sf_dir))


@query
def landed_time_range(spark, sf_dir):
    return landed_range(type_coverage(archive(spark, sf_dir)))


@query
def missing_event_types(spark, sf_dir):
    return missing_types(type_coverage(archive(spark, sf_dir)))


def _hours(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, Column]:
    """Expected hours of the events' days; an hour counts as landed when it has a purchase."""
    events = table(spark, sf_dir, "events")
    range_ = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    start = range_.select("a").scalar().cast("date")
    latest = range_.select("b").scalar()
    expected = hour_spine(spark, start, F.date_add(latest.cast("date"), 1))
    hourly = events.select(F.col("ts").cast("date").alias("dt"), F.hour("ts").alias("hour"), "event_type", "value")
    landed = hourly.where("event_type = 'purchase'").select("dt", "hour").distinct()
    failures = hourly.where("event_type = 'error' AND value > 50").select(
        "dt", "hour", F.lit("truncated gzip").alias("detail")
    )
    return expected, landed, failures, latest


@query
def pending_hours(spark, sf_dir):
    expected, landed, _, _ = _hours(spark, sf_dir)
    return hours.pending_hours(expected, landed)


@query
def missing_hours(spark, sf_dir):
    expected, landed, failures, latest = _hours(spark, sf_dir)
    return hours.missing_hours(expected, landed, failures, latest)


@query
def landing_summary(spark, sf_dir):
    expected, landed, _, _ = _hours(spark, sf_dir)
    return hours.landing_summary(hours.hour_status(expected, landed))


# --- landing, sinks and increments -------------------------------------------------


def _write_hour_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The events table as gzip JSON, one folder named like its hour file each."""
    rows = file_times(activity(spark, sf_dir))
    created = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at")
    common = F.to_json(F.struct("id", "type", "actor", "repo", created))
    open_object = F.expr("substring(head, 1, length(head) - 1)")
    line = F.concat(open_object, F.lit(', "payload": '), F.col("payload"), F.lit("}"))
    name = F.concat(F.date_format("file_time", "yyyy-MM-dd-"), F.hour("file_time").cast("string"), F.lit(".json"))
    (
        rows.select(common.alias("head"), "payload", name.alias("file"))
        .select(line.alias("value"), "file")
        .hint("rebalance", F.col("file"))
        .write.partitionBy("file")
        .option("compression", "gzip")
        .text(path)
    )


@query
def land_hours(spark, sf_dir):
    """Raw gzip hour files to bronze and back, with the number of rows in each hour."""
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    _write_hour_files(spark, sf_dir, raw)
    sinks.write_bronze(to_bronze(read_raw_events(spark, raw)), root)
    landed = read_bronze(spark, root)
    counts = landed.groupBy("dt", "hour", "type").agg(
        F.count("*").alias("row_count"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
        F.sum(F.get_json_object("payload", "$.distinct_size").cast("bigint")).alias("commits"),
    )
    return counts.join(landed_hours(spark, root), hours.KEY, "left_semi")


@query
def land_with_bad_files(spark, sf_dir):
    """A whole landing run: some hours have no file and some a truncated one, which the ledger names.

    Files are cut in the driver, small as they are, since Spark writes none that are not whole.
    """
    raw, root, ledger = (scratch_path(spark, name) for name in ("raw", "bronze", "ledger"))
    _write_hour_files(spark, sf_dir, raw)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(raw).select("path", "length")
    hour = F.regexp_extract("path", r"-(\d{1,2})\.json", 1)
    by_hour = files.withColumn("hour", hour).where("hour IN ('7', '13')").collect()
    for file in by_hour:
        sinks.cut_file(spark, file.path, 0 if file.hour == "13" else file.length // 2)
    # an empty file stands for one that was never published
    paths = [r.path for r in files.where("length > 0").select("path").collect() if not re.search(r"-13\.json", r.path)]
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts").cast("date"), F.date_add(F.max("ts").cast("date"), 1)).first()
    recorded = F.lit("2024-01-01").cast("timestamp")
    summary = landing.land_events(spark, paths, root, ledger, str(first), str(last), recorded, on_corrupt="quarantine")
    landed = read_bronze(spark, root).groupBy("dt", "hour").agg(F.count("*").alias("row_count"))
    rows = landed.select("dt", "hour", F.lit("landed").alias("status"), "row_count").unionByName(
        read_parts(spark, ledger).select("dt", "hour", F.col("reason").alias("status"), F.lit(0).cast("long").alias("row_count"))
    )
    totals = [summary.select(c).scalar().alias(f"hours_{c}") for c in ("landed", "missing")]
    return rows.select("*", *totals)


@query
def upsert_by_bucket(spark, sf_dir):
    """As ``upsert_by_key``, into a table in parts, of which those with such keys are written."""
    root = scratch_path(spark, "upserted")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    changed = orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("C"))
    added = orders.where("o_orderstatus = 'F'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    for rows in (orders, changed.unionByName(added)):
        upsert_parts(rows, root, ["o_orderpriority", "o_orderkey"], buckets=16)
    return read_parts(spark, root)


@query
def mart_by_day(spark, sf_dir):
    """Daily activity written by day, then two weeks written again, then read back."""
    path = scratch_path(spark, "mart")
    events = table(spark, sf_dir, "events").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("repo_id"), "event_id", "ts", "value"
    )
    sinks.write_mart(events, path, "ts")
    redone = events.where(F.dayofmonth("ts") > 15).withColumn("value", F.col("value") * 2)
    sinks.overwrite_partitions(redone, path, "ts")
    return spark.read.parquet(path)


def _first_batch(events: DataFrame) -> DataFrame:
    """The earlier half of the time range, less the errors."""
    low, high = (events.agg(F.to_unix_timestamp(f("ts").cast("timestamp"))).scalar() for f in (F.min, F.max))
    early = F.to_unix_timestamp(F.col("ts").cast("timestamp")) < F.floor((low + high) / 2)
    return events.where(early & (F.col("event_type") != "error"))


@query
def append_past_mark(spark, sf_dir):
    """Rows older than the mark are not picked up by the second append."""
    path = scratch_path(spark, "appended")
    events = table(spark, sf_dir, "events")
    sinks.append_incremental(_first_batch(events), path, "ts")
    sinks.append_incremental(events, path, "ts")
    return spark.read.parquet(path)


@query
def append_by_key(spark, sf_dir):
    """Found by key from the first day on, they are."""
    path = scratch_path(spark, "appended")
    events = table(spark, sf_dir, "events")
    since = str(events.agg(F.min("ts")).first()[0].date())
    sinks.append_new(_first_batch(events), path, ["event_id"], "ts", since)
    sinks.append_new(events, path, ["event_id"], "ts", since)
    return spark.read.parquet(path).drop("day")


@query
def upsert_by_key(spark, sf_dir):
    root = scratch_path(spark, "upserted")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    changed = orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("C"))
    added = orders.where("o_orderstatus = 'F'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    keys = ["o_orderpriority", "o_orderkey"]
    sinks.upsert_table(orders, root, keys)
    sinks.upsert_table(changed.unionByName(added), root, keys)
    return sinks.read_published(spark, root)


def _stored_history(spark: SparkSession, root: str, snapshots, key: str, label: str) -> DataFrame:
    """Change history after all ``snapshots`` (current rows, time), published after each."""
    for current, as_of in snapshots:
        history = sinks.read_published(spark, root)
        if history is None:
            history = empty_history(current, key, [label])
        sinks.publish(scd2_snapshot(history, current, key, [label], as_of), root)
    return sinks.read_published(spark, root)


@query
def scd2_history(spark, sf_dir):
    """A snapshot for every ten days of the data, of the users active in them with their latest event type."""
    events = table(spark, sf_dir, "events")
    start = F.date_trunc("day", events.agg(F.min("ts")).scalar())
    span = events.agg(F.date_diff(F.max("ts").cast("date"), F.min("ts").cast("date"))).first()[0]

    def snapshots():
        for step in range(1, span // 10 + 2):
            since, until = start + days(10 * (step - 1)), start + days(10 * step)
            window = events.where((F.col("ts") >= since) & (F.col("ts") < until))
            yield latest_by(window, ["user_id"], "event_type", "ts"), until

    return _stored_history(spark, scratch_path(spark, "history"), snapshots(), "user_id", "event_type")


def _snapshots(spark: SparkSession, sf_dir: str, dim: Query, key: str, label: str) -> DataFrame:
    """Two snapshots of a dimension: after half of the events, and after all."""
    events = table(spark, sf_dir, "events")
    half = F.date_trunc("day", events.agg(F.min("ts")).scalar()) + days(15)
    end = F.date_trunc("day", events.agg(F.max("ts")).scalar()) + days(1)
    sources = _activity_sources(spark, sf_dir)
    taken = (
        (dim(**{name: df.where(F.col("event_created_at") < as_of) for name, df in sources.items()}), as_of)
        for as_of in (half, end)
    )
    return _stored_history(spark, scratch_path(spark, "history"), taken, key, label)


@query
def snapshot_repos(spark, sf_dir):
    return _snapshots(spark, sf_dir, marts.dim_repo, "repo_id", "repo_name")


@query
def snapshot_actors(spark, sf_dir):
    return _snapshots(spark, sf_dir, marts.dim_actor, "actor_id", "actor_login")


def _table_prs(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("timestamp")
    # one status lands 200 days late
    delay = F.when(F.col("o_orderstatus") == "P", days(200)).otherwise(days(0))
    return table(spark, sf_dir, "orders").select(
        order_repo_id().alias("repo_id"),
        F.col("o_orderkey").alias("pr_number"),
        F.col("o_custkey").alias("pr_author_id"),
        author_login().alias("pr_author_login"),
        F.col("o_orderdate").cast("timestamp").alias("pr_created_at"),
        none.alias("pr_closed_at"),
        none.alias("pr_merged_at"),
        F.lit("opened").alias("action"),
        F.lit(False).alias("is_bot_pr_author"),
        F.col("o_orderdate").cast("timestamp").alias("event_created_at"),
        (F.col("o_orderdate").cast("timestamp") + delay).alias("landed_at"),
    )


def _table_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", order_repo_id().alias("repo_id"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "repo_id",
            F.col("l_orderkey").alias("pr_number"),
            F.col("l_suppkey").alias("responder_id"),
            F.col("l_shipdate").cast("timestamp").alias("responded_at"),
        )
    )


def _by_year(spark: SparkSession, sf_dir: str):
    """(all pull requests, all responses, first year, last year) of the tables, the responses stored by day."""
    prs = _table_prs(spark, sf_dir)
    stored = scratch_path(spark, "responses")
    responses = _table_responses(spark, sf_dir)
    sinks.write_mart(responses, stored, "responded_at")
    responses = sinks.read_by_day(spark, stored, responses.schema)
    times = prs.agg(F.year(F.min("landed_at")), F.year(F.max("landed_at"))).first()
    last_response = responses.agg(F.year(F.max("responded_at"))).first()[0]
    return prs, responses, times[0], max(times[1], last_response)


def _responded(responses: DataFrame, end: Column, since: Column | None = None) -> DataFrame:
    """Rows of responses stored by day that are before ``end``, from ``since`` on; other days' files are not opened."""
    rows = responses.where((F.col("responded_at") < end) & (F.col("day") <= end.cast("date")))
    return rows if since is None else rows.where((F.col("responded_at") >= since) & (F.col("day") >= since.cast("date")))


@query
def lifecycle_incremental(spark, sf_dir):
    """The lifecycle table brought up to date once per year with what had landed in it."""
    prs, responses, first, last = _by_year(spark, sf_dir)
    root = scratch_path(spark, "lifecycle")
    for year in range(first, last + 1):
        begin, end = (F.lit(f"{y}-01-01").cast("timestamp") for y in (year, year + 1))
        landed, answered = prs.where(F.col("landed_at") < end), _responded(responses, end)
        known = landed.drop("landed_at")
        previous = sinks.read_published(spark, root)
        if previous is None:
            rows = lc.pr_lifecycle(known, answered)
        else:
            new = landed.where(F.year("landed_at") == year), _responded(responses, end, begin)
            rows = lc.pr_lifecycle_update(previous, lc.touched_authors(previous, *new), known, answered)
        sinks.publish(rows, root)
    return sinks.read_published(spark, root)


@query
def lifecycle_with_age_limit(spark, sf_dir):
    """The same when items are watched for 365 days only, so some late responses are passed over."""
    prs, responses, first, last = _by_year(spark, sf_dir)
    root = scratch_path(spark, "lifecycle")
    for year in range(first, last + 1):
        end = F.lit(f"{year + 1}-01-01").cast("timestamp")
        lc.refresh_lifecycle(
            spark,
            root,
            prs.where(F.col("landed_at") < end).drop("landed_at"),
            _responded(responses, end),
            lc.LifecycleSettings(max_age_days=365),
            as_of=end,
        )
    return sinks.read_published(spark, root)


# --- the warehouse from landed files -------------------------------------------------


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived archive in two files a month, since it has an event in almost every hour of seven years."""
    return archive(spark, sf_dir).withColumn("dt", F.trunc("dt", "month")).withColumn(
        "hour", F.when(F.crc32("id") % 2 == 0, 12).otherwise(0)
    )


def _refreshed_warehouse(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A warehouse after three landings, each of every third month of all years.

    The first landing has some files with rows left out and others made up; the
    third lands these again as they should be.
    """
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "warehouse")
    seed = bot_seed(spark, sf_dir)
    rows = _monthly(spark, sf_dir)
    batch = (12 * F.year("dt") + F.month("dt")) % 3
    wrong = (F.col("hour") == 12) & (batch == 0)
    landings = [
        rows.where((batch == 0) & ~(wrong & (F.crc32("id") % 8 == 0))).withColumn(
            "payload",
            F.when(wrong, F.regexp_replace("payload", r'"number":(\d)', '"number":7$1')).otherwise(F.col("payload")),
        ),
        rows.where(batch == 1),
        rows.where((batch == 2) | wrong),
    ]
    for landing in landings:
        with shuffles_removed(spark):
            sinks.write_bronze(landing.hint("rebalance", F.col("dt"), F.col("hour")), bronze)
        # an archive of seven years and few rows: years are its periods
        warehouse.refresh_events(spark, bronze, root, BEGINNING, "year", 8)
        warehouse.refresh_marts(spark, root, seed)
        # nobody reads earlier states, which take as much disk as the present one
        warehouse.clean_up(spark, root, keep=1)
    return root, seed


@query
def warehouse_refresh(spark, sf_dir):
    """Lifecycle table of the warehouse after late files and files landed again."""
    root, _ = _refreshed_warehouse(spark, sf_dir)
    return warehouse.read_table(spark, root, "lifecycle")


@query
def warehouse_views(spark, sf_dir):
    """Rows of the other tables of that warehouse, asked for in SQL over its views."""
    root, seed = _refreshed_warehouse(spark, sf_dir)
    warehouse.register_views(spark, root, seed)
    return spark.sql(
        """
        SELECT 'daily' AS name, repo_id AS key_1, unix_date(activity_date) AS key_2,
            push_count AS n, pr_opened_count + 1000 * watch_count AS m, CAST(NULL AS STRING) AS label
        FROM fct_repo_daily_activity
        UNION ALL
        SELECT 'cohort', repo_id, pr_author_id, total_prs_opened, unix_seconds(first_contribution_at), pr_author_login
        FROM fct_contributor_cohorts
        UNION ALL
        SELECT 'repo', repo_id, NULL, unix_seconds(first_seen_at), unix_seconds(last_seen_at), repo_name FROM dim_repo
        UNION ALL
        SELECT 'actor', actor_id, CAST(is_bot_actor AS BIGINT), unix_seconds(first_seen_at), unix_seconds(last_seen_at),
            actor_login
        FROM dim_actor
        UNION ALL
        SELECT 'latency', repo_id, pr_number, review_latency_seconds, CAST(opened_year AS BIGINT), pr_author_login
        FROM fct_pr_review_latency
        UNION ALL
        SELECT 'response', repo_id, pr_number, responder_id, unix_seconds(responded_at), NULL
        FROM int_review_candidates
        """
    )


@query
def replace_hour(spark, sf_dir):
    """An hour of each day landed twice, the second time with half of its rows."""
    path = scratch_path(spark, "bronze")
    rows = activity(spark, sf_dir).select("*", F.col("created_at").cast("date").alias("dt"), F.hour("created_at").alias("hour"))
    rows = rows.withColumn("org", F.lit(None).cast(schemas.ORG)).select(schemas.BRONZE.fieldNames())
    sinks.write_bronze(rows, path)
    sinks.write_bronze(rows.where("hour = 7 AND type <> 'WatchEvent'"), path)
    return read_bronze(spark, path).groupBy("dt", "hour", "type").agg(F.count("*").alias("row_count"))


@query
def land_timeline_files(spark, sf_dir):
    """Timeline files landed and read back, with a second call that finds nothing to land."""
    raw, root = scratch_path(spark, "timeline"), scratch_path(spark, "timeline-bronze")
    rows = _timeline_rows(spark, sf_dir)
    name = F.concat(F.date_format("created_at", "yyyy-MM-dd-"), F.lit("0.json"))
    lines = F.to_json(F.struct("*"), {"ignoreNullFields": "true", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"})
    lines = rows.select(name.alias("file"), lines.alias("value"))
    lines.hint("rebalance", F.col("file")).write.partitionBy("file").option("compression", "gzip").text(raw)
    for _ in range(2):
        landing.land_timeline(spark, f"{raw}/*", root)
    return staging.stage_timeline(read_timeline_bronze(spark, root))


@query
def bot_flag_from_csv(spark, sf_dir):
    """The flag of each account of the events, by a seed read from a CSV file."""
    path = scratch_path(spark, "seed")
    bot_seed(spark, sf_dir).write.option("header", True).csv(path)
    accounts = activity(spark, sf_dir).select(F.col("actor.login").alias("actor_login")).distinct()
    return with_bot_flag(accounts, "actor_login", read_bot_seed(spark, path), "is_bot_actor")


# --- checks ---------------------------------------------------------------------


@query
def check_unique(spark, sf_dir):
    return checks.check_unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def check_not_null(spark, sf_dir):
    return checks.check_not_null(_staged(staging.stage_reviews, spark, sf_dir), "reviewer_id").select(
        "event_id", "repo_id", "pr_number"
    )


@query
def check_accepted_values(spark, sf_dir):
    return checks.check_accepted_values(
        table(spark, sf_dir, "events"), "event_type", ["view", "click", "signup", "purchase"]
    )


@query
def check_unique_combination(spark, sf_dir):
    return checks.check_unique_combination(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_between(spark, sf_dir):
    return checks.check_between(
        table(spark, sf_dir, "lineitem"), "l_quantity", 5, 45, row_condition="l_returnflag <> 'N'"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query
def check_order(spark, sf_dir):
    """Line items shipped before their order was placed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = table(spark, sf_dir, "lineitem").select(columns)
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return checks.check_order(joined, "o_orderdate", "l_shipdate")


@query
def check_first_is_earliest(spark, sf_dir):
    """Checks each author's *latest* pull request per repository, so earlier ones turn up."""
    opens = _table_prs(spark, sf_dir)
    backwards = Window.partitionBy("repo_id", "pr_author_id").orderBy(F.desc("pr_created_at"), F.desc("pr_number"))
    chosen = opens.withColumn("rank", F.row_number().over(backwards)).where("rank = 1")
    return checks.check_first_is_earliest(chosen.withColumnRenamed("pr_created_at", "opened_at"), opens)


@query
def check_attributable(spark, sf_dir):
    """Facts compared with the responses of full quantity only, so some have no source."""
    prs, responses = _table_prs(spark, sf_dir), _table_responses(spark, sf_dir)
    fact = marts.fct_pr_review_latency(lc.pr_lifecycle(prs, responses))
    lines = table(spark, sf_dir, "lineitem").where("l_discount > 0.02")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", order_repo_id().alias("repo_id"))
    human = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "repo_id", F.col("l_orderkey").alias("pr_number"), F.col("l_shipdate").cast("timestamp").alias("responded_at")
    )
    return checks.check_attributable(fact, human).select("repo_id", "pr_number", "first_review_at")


@query
def check_same_rows(spark, sf_dir):
    """Line items against line items with one return flag changed."""
    left = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    right = left.withColumn(
        "l_returnflag",
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), "X").otherwise(F.col("l_returnflag")),
    )
    return row_differences(left, right)


@query
def check_summary(spark, sf_dir):
    """The checks on the staged and final tables of the derived archive, as a report."""

    def keep(name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(spark, name)
        sinks.write_table(df, path)
        return spark.read.parquet(path)

    # checks read stored tables, so the work before them is done once
    prs = keep("prs", _staged(staging.stage_pull_requests, spark, sf_dir))
    candidates = keep("candidates", _candidates(spark, sf_dir))
    fact = keep("fact", marts.fct_pr_review_latency(lc.pr_lifecycle(prs, candidates)))
    return checks.check_report(
        [
            checks.Check("pull_request_event_id_unique", checks.check_unique(prs, "event_id")),
            checks.Check(
                "pull_request_action_known", checks.check_accepted_values(prs, "action", ["opened"]), severity="warn"
            ),
            checks.Check("pull_request_number_not_null", prs, checks.is_missing("pr_number")),
            checks.Check("fact_key_unique", checks.check_unique_combination(fact, lc.PR_KEY)),
            checks.Check("latency_not_negative", fact, checks.is_outside("review_latency_seconds", low=0)),
            checks.Check("review_after_opening", fact, checks.is_out_of_order("opened_at", "first_review_at")),
            checks.Check("first_pull_request_is_earliest", checks.check_first_is_earliest(fact, lc.human_opens(prs))),
            checks.Check("review_has_human_source", checks.check_attributable(fact, candidates)),
        ]
    )
