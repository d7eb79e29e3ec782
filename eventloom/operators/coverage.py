"""Coverage of event types over the landed range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The public list of event types.
KNOWN_EVENT_TYPES = (
    "CommitCommentEvent",
    "CreateEvent",
    "DeleteEvent",
    "ForkEvent",
    "GollumEvent",
    "IssueCommentEvent",
    "IssuesEvent",
    "MemberEvent",
    "PublicEvent",
    "PullRequestEvent",
    "PullRequestReviewCommentEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewThreadEvent",
    "PushEvent",
    "ReleaseEvent",
    "SponsorshipEvent",
    "WatchEvent",
)


def type_coverage(events: DataFrame, type_column: str = "type", time_column: str = "created_at") -> DataFrame:
    """First seen, last seen and row count of each type, earliest type first."""
    return (
        events.groupBy(F.col(type_column).alias("type"))
        .agg(
            F.min(time_column).alias("first_seen"),
            F.max(time_column).alias("last_seen"),
            F.count("*").alias("event_count"),
        )
        .orderBy(F.col("first_seen").asc_nulls_last(), "type")
    )


def landed_range(coverage: DataFrame) -> DataFrame:
    """Range of the whole archive, from the per-type ranges."""
    return coverage.agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def missing_types(coverage: DataFrame, known: Sequence[str] = KNOWN_EVENT_TYPES) -> DataFrame:
    """Known types with no event at all, sorted."""
    listed = coverage.sparkSession.createDataFrame([(name,) for name in known], "type string")
    return listed.join(coverage.select("type"), "type", "left_anti").orderBy("type")
