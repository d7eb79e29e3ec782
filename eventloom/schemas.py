"""Declared schemas of the archive layers.

Payloads stay JSON text in bronze, so a change of payload shape never needs a
migration there. Reading with these schemas also unions files by name: a
column a file does not have comes back as NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

ACTOR = T.StructType([T.StructField("id", T.LongType()), T.StructField("login", T.StringType())])
REPO = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
ORG = ACTOR

RAW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("actor", ACTOR),
        T.StructField("repo", REPO),
        T.StructField("org", ORG),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("payload", T.StringType()),
    ]
)

PARTITIONS = [T.StructField("dt", T.DateType()), T.StructField("hour", T.IntegerType())]

BRONZE = T.StructType([*RAW.fields, *PARTITIONS])

TIMELINE_RAW = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("actor", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField(
            "repository",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("name", T.StringType()),
                    T.StructField("url", T.StringType()),
                ]
            ),
        ),
        T.StructField("payload", T.StringType()),
    ]
)

TIMELINE_BRONZE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("actor", ACTOR),
        T.StructField("repo", TIMELINE_RAW["repository"].dataType),
        T.StructField("org", ORG),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("payload", T.StringType()),
        *PARTITIONS,
    ]
)

SEED = T.StructType([T.StructField("login", T.StringType())])

# Absent hours: one row per (dt, hour), with the reason it is absent.
MISSING_HOURS = T.StructType(
    [
        *PARTITIONS,
        T.StructField("reason", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)

CANDIDATES = T.StructType(
    [
        T.StructField("repo_id", T.LongType()),
        T.StructField("pr_number", T.LongType()),
        T.StructField("responder_id", T.LongType()),
        T.StructField("responded_at", T.TimestampType()),
    ]
)
