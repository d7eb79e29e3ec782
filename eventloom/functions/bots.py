"""Bot classification of logins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_bot_flag(df: DataFrame, login: str, seed: DataFrame, out: str) -> DataFrame:
    """Add ``out``: the login ends in ``[bot]`` or is on the seed list, in any case.

    A login with the suffix is a bot already, so the seed is compared with the
    login as it is. A NULL login gives NULL, which ``~flag`` filters drop.

    The seed carries no broadcast hint: Spark broadcasts it while it is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    known = seed.select(F.lower("login").alias("_known_bot")).where("_known_bot IS NOT NULL").distinct()
    return (
        df.join(known, F.lower(F.col(login)) == F.col("_known_bot"), "left")
        .withColumn(out, F.col(login).ilike("%[bot]") | F.col("_known_bot").isNotNull())
        .drop("_known_bot")
    )
