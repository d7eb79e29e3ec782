from __future__ import annotations

import json
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from eventloom.schemas import BRONZE, SEED  # noqa: E402
from eventloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def seed(spark):
    return spark.createDataFrame([("renovate",), ("Travis-CI",)], SEED)


def at(text: str) -> datetime:
    """A UTC time such as 2015-03-01T10:00:00."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


class Archive:
    """Hand-made bronze rows."""

    def __init__(self):
        self.rows = []

    def add(self, event_id, event_type, when, actor, payload, repo=(1, "org/one"), hour=None, dt=None):
        """``actor`` is (id, login); ``dt`` and ``hour`` are those of the file."""
        time = at(when)
        text = payload if isinstance(payload, str) or payload is None else json.dumps(payload)
        self.rows.append(
            (
                event_id,
                event_type,
                actor,
                repo,
                None,
                time,
                text,
                time.date() if dt is None else datetime.fromisoformat(dt).date(),
                time.hour if hour is None else hour,
            )
        )
        return self

    def opened(self, event_id, number, when, author, action="opened", repo=(1, "org/one"), actor=None, **rest):
        payload = {
            "action": action,
            "number": number,
            "pull_request": {
                "id": 1000 + number if isinstance(number, int) else None,
                "state": "open",
                "created_at": when + "Z",
                "closed_at": None,
                "merged_at": None,
                "user": {"id": author[0], "login": author[1]},
            },
        }
        return self.add(event_id, "PullRequestEvent", when, actor or author, payload, repo, **rest)

    def review(self, event_id, number, when, who, repo=(1, "org/one"), **rest):
        payload = {
            "pull_request": {"number": number, "id": 1000 + number},
            "review": {"state": "approved", "submitted_at": when + "Z", "user": {"id": who[0], "login": who[1]}},
        }
        return self.add(event_id, "PullRequestReviewEvent", when, who, payload, repo, **rest)

    def line_comment(self, event_id, number, when, who, repo=(1, "org/one")):
        payload = {
            "pull_request": {"number": number, "id": 1000 + number},
            "comment": {
                "created_at": when + "Z",
                "pull_request_review_id": 77,
                "user": {"id": who[0], "login": who[1]},
            },
        }
        return self.add(event_id, "PullRequestReviewCommentEvent", when, who, payload, repo)

    def comment(self, event_id, number, when, who, on_pull_request=True, repo=(1, "org/one")):
        issue = {"number": number}
        if on_pull_request:
            issue["pull_request"] = {"url": f"https://example.org/{number}"}
        payload = {"issue": issue, "comment": {"created_at": when + "Z", "user": {"id": who[0], "login": who[1]}}}
        return self.add(event_id, "IssueCommentEvent", when, who, payload, repo)

    def frame(self, spark):
        return spark.createDataFrame(self.rows, BRONZE)


@pytest.fixture
def archive():
    return Archive()
