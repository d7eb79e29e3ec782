"""Payload parsing: one ``from_json`` per row, with only the fields read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_USER = "user struct<id: string, login: string>"

# The payload paths read for each event type. Every leaf is text;
# a leaf that holds an object comes back as its JSON text, so presence tests work.
PAYLOAD_FIELDS = {
    "PullRequestEvent": (
        "action string, number string, pull_request struct<id: string, state: string, "
        f"created_at: string, closed_at: string, merged_at: string, {_USER}>"
    ),
    "PullRequestReviewEvent": (
        "pull_request struct<number: string, id: string>, "
        f"review struct<state: string, submitted_at: string, {_USER}>"
    ),
    "PullRequestReviewCommentEvent": (
        "pull_request struct<number: string, id: string>, "
        f"comment struct<created_at: string, pull_request_review_id: string, {_USER}>"
    ),
    "IssueCommentEvent": (
        "issue struct<number: string, pull_request: struct<url: string>>, "
        f"comment struct<created_at: string, {_USER}>"
    ),
    "PushEvent": "distinct_size string",
}


def parse_payload(payload: Column, event_type: str) -> Column:
    """Struct of the fields read for ``event_type``; malformed text gives NULLs."""
    return F.from_json(payload, PAYLOAD_FIELDS[event_type])
