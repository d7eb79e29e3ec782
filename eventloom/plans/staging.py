"""One narrow table per event type, unnested from bronze.

Order of work: filter by partition, type and time at the scan; parse the few
payload fields; then deduplicate the narrow rows. The payload itself, by far
the widest column, never reaches the shuffle. Bot flags come last and depend on
the seed only, so stored rows need no rewrite when the seed changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.bots import with_bot_flag
from eventloom.functions.columns import try_long, try_time
from eventloom.functions.payload import PAYLOAD_FIELDS, parse_payload
from eventloom.operators.grouped import dedupe_events

# Fixed value: first day of the current event format.
ARCHIVE_START = "2015-01-01"


def _text(path: str) -> Column:
    return F.col(f"p.{path}")


def _long(path: str) -> Column:
    return try_long(_text(path))


def _time(path: str) -> Column:
    return try_time(_text(path))


def _pull_request_fields() -> dict[str, Column]:
    return {
        "action": _text("action"),
        "pr_number": _long("number"),
        "pr_id": _long("pull_request.id"),
        "pr_author_login": _text("pull_request.user.login"),
        "pr_author_id": _long("pull_request.user.id"),
        "pr_created_at": _time("pull_request.created_at"),
        "pr_closed_at": _time("pull_request.closed_at"),
        "pr_merged_at": _time("pull_request.merged_at"),
        "pr_state": _text("pull_request.state"),
    }


def _review_fields() -> dict[str, Column]:
    return {
        "pr_number": _long("pull_request.number"),
        "pr_id": _long("pull_request.id"),
        "review_state": _text("review.state"),
        "reviewed_at": _time("review.submitted_at"),
        "reviewer_login": _text("review.user.login"),
        "reviewer_id": _long("review.user.id"),
    }


def _review_comment_fields() -> dict[str, Column]:
    return {
        "pr_number": _long("pull_request.number"),
        "pr_id": _long("pull_request.id"),
        **_comment_fields(),
        "pull_request_review_id": _long("comment.pull_request_review_id"),
    }


def _issue_comment_fields() -> dict[str, Column]:
    return {
        "issue_number": _long("issue.number"),
        # only issues that are pull requests carry this link
        "is_pr_comment": _text("issue.pull_request.url").isNotNull(),
        **_comment_fields(),
    }


def _comment_fields() -> dict[str, Column]:
    return {
        "commented_at": _time("comment.created_at"),
        "commenter_login": _text("comment.user.login"),
        "commenter_id": _long("comment.user.id"),
    }


def _push_fields() -> dict[str, Column]:
    return {"distinct_commit_count": _long("distinct_size")}


_FIELDS = {
    "PullRequestEvent": _pull_request_fields,
    "PullRequestReviewEvent": _review_fields,
    "PullRequestReviewCommentEvent": _review_comment_fields,
    "IssueCommentEvent": _issue_comment_fields,
    "PushEvent": _push_fields,
    "WatchEvent": dict,
}


def unnest_copies(bronze: DataFrame, event_type: str, start: str = ARCHIVE_START) -> DataFrame:
    """Rows of one event type from ``start`` on as they are in their files, with the file's ``dt`` and ``hour``."""
    kept = bronze.where(
        (F.col("type") == event_type)
        & (F.col("created_at") >= F.lit(start).cast("timestamp"))
        # a floor on created_at alone cannot skip folders
        & (F.col("dt") >= F.lit(start).cast("date"))
    )
    if event_type in PAYLOAD_FIELDS:
        kept = kept.withColumn("p", parse_payload(F.col("payload"), event_type))
    return kept.select(
        F.col("id").alias("event_id"),
        F.col("created_at").alias("event_created_at"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        *[column.alias(name) for name, column in _FIELDS[event_type]().items()],
        "dt",
        "hour",
    )


def one_per_event(copies: DataFrame) -> DataFrame:
    """One row per event of ``unnest_copies``: the earliest, then that of the earliest file."""
    return dedupe_events(copies, "event_id", "event_created_at", ["dt", "hour"]).drop("dt", "hour")


def unnest(bronze: DataFrame, event_type: str, start: str = ARCHIVE_START) -> DataFrame:
    """Deduplicated rows of one event type from ``start`` on, without bot flags."""
    return one_per_event(unnest_copies(bronze, event_type, start))


def first_time(bronze: DataFrame, event_type: str, start: str = ARCHIVE_START) -> Column:
    """Earliest time of the events of one type; that of their copies, so nothing is parsed, deduplicated or flagged."""
    return unnest_copies(bronze, event_type, start).agg(F.min("event_created_at")).scalar()


def flag_bots(unnested: DataFrame, seed: DataFrame) -> DataFrame:
    """Flags for the acting account and, on pull requests, for the author."""
    flagged = with_bot_flag(unnested, "actor_login", seed, "is_bot_actor")
    if "pr_author_login" in unnested.columns:
        flagged = with_bot_flag(flagged, "pr_author_login", seed, "is_bot_pr_author")
    return flagged


def stage_pull_requests(bronze: DataFrame, seed: DataFrame, start: str = ARCHIVE_START) -> DataFrame:
    return flag_bots(unnest(bronze, "PullRequestEvent", start), seed)


def stage_reviews(bronze: DataFrame, seed: DataFrame, start: str = ARCHIVE_START) -> DataFrame:
    return flag_bots(unnest(bronze, "PullRequestReviewEvent", start), seed)


def stage_review_comments(bronze: DataFrame, seed: DataFrame, start: str = ARCHIVE_START) -> DataFrame:
    return flag_bots(unnest(bronze, "PullRequestReviewCommentEvent", start), seed)


def stage_issue_comments(bronze: DataFrame, seed: DataFrame, start: str = ARCHIVE_START) -> DataFrame:
    return flag_bots(unnest(bronze, "IssueCommentEvent", start), seed)


def stage_pushes(bronze: DataFrame, seed: DataFrame, start: str = ARCHIVE_START) -> DataFrame:
    return flag_bots(unnest(bronze, "PushEvent", start), seed)


def stage_watches(bronze: DataFrame, seed: DataFrame, start: str = ARCHIVE_START) -> DataFrame:
    return flag_bots(unnest(bronze, "WatchEvent", start), seed)


def stage_timeline(bronze: DataFrame) -> DataFrame:
    """Timeline rows under staged names; neither filtered nor deduplicated."""
    return bronze.select(
        F.col("id").alias("event_id"),
        "type",
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        F.col("created_at").alias("event_created_at"),
        "payload",
    )
