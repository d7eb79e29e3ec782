"""An event archive derived from the given tables.

orders become pull request events, lineitem rows become reviews and comments on
them, and events become pushes, stars and other kinds. The rows go through the
same JSON payloads, hour folders and boundary copies as a landed archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import schemas

# The first day that the staging queries take from the derived
# archive, and a day before all of it.
START = "1995-02-01"
BEGINNING = "1900-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Output form: instants as times without zone (UTC)."""
    instants = {f.name for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.select(*[F.col(c).cast("timestamp_ntz") if c in instants else F.col(c) for c in df.columns])


def _iso(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _json(struct: Column) -> Column:
    return F.to_json(struct, {"ignoreNullFields": "false"})


def _numbered(prefix: str, number: str) -> Column:
    return F.concat(F.lit(prefix), F.col(number).cast("string"))


def bot_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known bots: the accounts in debt, in upper case."""
    suppliers = table(spark, sf_dir, "supplier").where("s_acctbal < 0")
    customers = table(spark, sf_dir, "customer").where("c_acctbal < -500")
    return suppliers.select(_numbered("SUPPLIER-", "s_suppkey").alias("login")).unionByName(
        customers.select(_numbered("USER-", "c_custkey").alias("login"))
    )


def order_repo_id() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("bigint")


def author_login() -> Column:
    suffix = F.when(F.col("o_totalprice") > 450000, "[Bot]").otherwise("")
    return F.concat(_numbered("User-", "o_custkey"), suffix)


def author_id() -> Column:
    return F.when(F.col("o_totalprice") >= 10000, F.col("o_custkey"))


def _repo(repo_id: Column, name: Column) -> Column:
    return F.struct(repo_id.alias("id"), name.alias("name"))


def _actor(actor_id: Column, login: Column) -> Column:
    return F.struct(actor_id.alias("id"), login.alias("login"))


def _order_repo() -> Column:
    return _repo(order_repo_id(), F.concat(F.lit("priority/"), F.lower(F.expr("substring(o_orderpriority, 3)"))))


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a table dealt to three tasks a core: a scan has one for each row group at most."""
    return rows.repartition(3 * rows.sparkSession.sparkContext.defaultParallelism)


def _pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = F.col("o_orderstatus") == "P"
    payload = F.struct(
        F.when(closed, "closed").otherwise("opened").alias("action"),
        F.col("o_orderkey").alias("number"),
        F.struct(
            (F.col("o_orderkey") + 1000000).alias("id"),
            F.when(closed, "closed").otherwise("open").alias("state"),
            _iso(F.col("o_orderdate")).alias("created_at"),
            F.when(closed, _iso(F.col("o_orderdate"))).alias("closed_at"),
            # not a time for one of the states
            F.when(F.col("o_orderstatus") == "O", "n/a").alias("merged_at"),
            _actor(author_id(), author_login()).alias("user"),
        ).alias("pull_request"),
    )
    return spread(table(spark, sf_dir, "orders")).select(
        _numbered("P", "o_orderkey").alias("id"),
        F.lit("PullRequestEvent").alias("type"),
        _actor(F.col("o_custkey"), _numbered("user-", "o_custkey")).alias("actor"),
        _order_repo().alias("repo"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        # some payloads are cut off
        F.when(F.col("o_totalprice") < 5000, '{"action": "open').otherwise(_json(payload)).alias("payload"),
    )


def responder_login() -> Column:
    suffix = F.when(F.col("l_discount") == 0, "[bot]").otherwise("")
    return F.when(F.col("l_tax") > 0, F.concat(_numbered("supplier-", "l_suppkey"), suffix))


def responder_id() -> Column:
    return F.when(F.col("l_quantity") > 1, F.col("l_suppkey"))


def _response_time() -> Column:
    """Shipping day, with a time of day from line number and quantity."""
    minutes = (F.col("l_quantity") - 2).cast("int")
    return F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=F.col("l_linenumber"), mins=minutes)


def _responses(rows: DataFrame, return_flag: str, event_type: str, payload: Column) -> DataFrame:
    identity = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")]
    return rows.where(F.col("l_returnflag") == return_flag).select(
        F.concat_ws("-", F.lit("L"), *identity).alias("id"),
        F.lit(event_type).alias("type"),
        _actor(F.col("l_suppkey"), responder_login()).alias("actor"),
        _order_repo().alias("repo"),
        "created_at",
        _json(payload).alias("payload"),
        "file_time",
    )


def _all_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    # files come before the join, so that what is asked of them leaves out rows in front of its shuffle
    lines = file_times(table(spark, sf_dir, "lineitem").withColumn("created_at", _response_time()))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    user = _actor(responder_id(), responder_login())
    time = _iso(_response_time())
    is_pull_request = F.col("l_linestatus") == "F"
    pull_request = F.struct(F.col("l_orderkey").alias("number"), (F.col("l_orderkey") + 1000000).alias("id"))
    review = F.struct(
        F.when(F.col("l_linestatus") == "F", "approved").otherwise("commented").alias("state"),
        time.alias("submitted_at"),
        user.alias("user"),
    )
    line_comment = F.struct(
        time.alias("created_at"), F.col("l_partkey").alias("pull_request_review_id"), user.alias("user")
    )
    link = F.struct(_numbered("https://example.org/pulls/", "l_orderkey").alias("url"))
    issue = F.struct(F.col("l_orderkey").alias("number"), F.when(is_pull_request, link).alias("pull_request"))
    comment = F.struct(
        F.when(F.col("l_quantity") < 50, time).otherwise("unknown").alias("created_at"), user.alias("user")
    )
    reviews = F.struct(pull_request.alias("pull_request"), review.alias("review"))
    line_comments = F.struct(pull_request.alias("pull_request"), line_comment.alias("comment"))
    comments = F.struct(issue.alias("issue"), comment.alias("comment"))
    return (
        _responses(rows, "R", "PullRequestReviewEvent", reviews)
        .unionByName(_responses(rows, "A", "PullRequestReviewCommentEvent", line_comments))
        .unionByName(_responses(rows, "N", "IssueCommentEvent", comments))
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table in raw form."""
    kind = F.col("event_type")
    number = F.get_json_object("props", "$.k")
    half = F.when(F.dayofmonth("ts") <= 15, "early").otherwise("late")
    bot = F.when(F.col("value") > 150, "[bot]").otherwise("")
    return table(spark, sf_dir, "events").select(
        _numbered("E", "event_id").alias("id"),
        F.when(kind == "view", "PushEvent")
        .when(kind == "click", "WatchEvent")
        .when(kind == "signup", "ForkEvent")
        .when(kind == "purchase", "CreateEvent")
        .otherwise("IssuesEvent")
        .alias("type"),
        _actor(F.col("user_id"), F.concat(_numbered("User-", "user_id"), bot)).alias("actor"),
        _repo(
            number.try_cast("bigint"),
            F.when(F.col("value") <= 300, F.concat(half, F.lit("/repo-"), number)),
        ).alias("repo"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.when(kind == "view", F.concat(F.lit('{"distinct_size": '), number, F.lit("}")))
        .otherwise('{"action": "started"}')
        .alias("payload"),
    )


def file_times(events: DataFrame) -> DataFrame:
    """One row per file an event sits in: its own hour, and in the first minute also the one before."""
    own = F.col("created_at")
    both = F.array(own, own - F.expr("INTERVAL 1 HOUR"))
    return events.withColumn("file_time", F.explode(F.when(F.minute(own) == 0, both).otherwise(F.array(own))))


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of the whole derived archive."""
    rows = (
        file_times(_pull_requests(spark, sf_dir))
        .unionByName(_all_responses(spark, sf_dir))
        .unionByName(file_times(activity(spark, sf_dir)))
    )
    return rows.select(
        "id",
        "type",
        "actor",
        "repo",
        F.lit(None).cast(schemas.ORG).alias("org"),
        "created_at",
        "payload",
        F.col("file_time").cast("date").alias("dt"),
        F.hour("file_time").alias("hour"),
    )
