"""Writers. All go through Spark's commit protocol, so a lost executor only re-runs tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.rows import upsert, without_keys


# an hour is about 100 MB: several row groups, so that types lie in different ones
BRONZE_ROW_GROUP_BYTES = 16 * 1024 * 1024


def write_bronze(df: DataFrame, root: str) -> None:
    """Replace the (dt, hour) partitions present in ``df`` and leave the others.

    No shuffle: each hour file is one task already. The writer needs rows sorted
    by partition anyway; sorting by type too lets a scan for one event type skip
    the row groups and pages of all others, whose payloads are most of the bytes.
    """
    (
        df.sortWithinPartitions("dt", "hour", "type")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.block.size", BRONZE_ROW_GROUP_BYTES)
        .partitionBy("dt", "hour")
        .parquet(root)
    )


def write_table(df: DataFrame, path: str) -> None:
    """Full rebuild. ``path`` must not be an input of ``df``."""
    df.write.mode("overwrite").parquet(path)


def write_mart(df: DataFrame, path: str, time_column: str, cluster_by: Sequence[str] = ("repo_id",)) -> None:
    """Full rebuild by day, clustered inside each day so min/max statistics prune."""
    _by_day(df, time_column, cluster_by).write.mode("overwrite").partitionBy("day").parquet(path)


def overwrite_partitions(
    df: DataFrame, path: str, time_column: str, cluster_by: Sequence[str] = ("repo_id",)
) -> None:
    """Replace the days present in ``df``, which must hold those days whole."""
    (
        _by_day(df, time_column, cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def _by_day(df: DataFrame, time_column: str, cluster_by: Sequence[str]) -> DataFrame:
    # rebalance: AQE splits a day too large for one task and joins small ones
    dated = df.withColumn("day", F.col(time_column).cast("date"))
    return dated.hint("rebalance", F.col("day")).sortWithinPartitions("day", *cluster_by)


def append_incremental(df: DataFrame, path: str, time_column: str) -> None:
    """Append the rows past the table's high-water mark; rows without a time are never taken.

    The mark stays inside the query, so no clock or time zone of the driver takes
    part. Rows that land out of order, or share the second of the mark, are lost;
    ``append_new`` finds those by key.
    """
    spark = df.sparkSession
    rows = df.where(F.col(time_column).isNotNull())
    if path_exists(spark, path):
        mark = spark.read.schema(df.schema).parquet(path).agg(F.max(time_column)).scalar()
        rows = rows.where(mark.isNull() | (F.col(time_column) > mark))
    rows.write.mode("append").parquet(path)


def append_new(
    df: DataFrame, path: str, keys: Sequence[str], time_column: str, since: str | None = None
) -> None:
    """Append the rows whose keys are not stored yet, by day; rows without a time are left out.

    ``df`` has one row per key. Rows before the day ``since`` are passed over;
    by default none are. A row's day belongs to its key, so only the stored days
    that the rows are in are compared.
    """
    spark = df.sparkSession
    rows = df.where(F.col(time_column).isNotNull())
    if since:
        rows = rows.where(F.col(time_column) >= F.lit(since).cast("timestamp"))
    rows = rows.withColumn("day", F.col(time_column).cast("date"))
    if path_exists(spark, path):
        stored = read_by_day(spark, path, df.schema)
        if since:
            stored = stored.where(F.col("day") >= F.lit(since).cast("date"))
        rows = without_keys(rows, stored, [*keys, "day"])
    _by_day(rows.drop("day"), time_column, keys).write.mode("append").partitionBy("day").parquet(path)


def read_by_day(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table stored by day; with its schema given, it may hold no file yet."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    return _status(spark, path) is not None


def _status(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.globStatus(hadoop_path) or None


def cut_file(spark: SparkSession, path: str, size: int) -> None:
    """Keep the first ``size`` bytes of a small file, as after a transfer that broke off."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    source = files.open(place)
    content = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source))
    source.close()
    target = files.create(place, True)
    target.write(bytearray(content[:size]))
    target.close()


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def published_versions(spark: SparkSession, root: str) -> list[int]:
    """Finished versions below ``root``, oldest first."""
    done = _status(spark, f"{root}/version=*/_SUCCESS") or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)


def read_published(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Latest finished version of a table, or None before the first.

    A table without rows may hold no file when it is stored by day; with its
    schema given it is read all the same.
    """
    versions = published_versions(spark, root)
    if not versions:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/version={versions[-1]}")


def publish(df: DataFrame, root: str, time_column: str | None = None, cluster_by: Sequence[str] = ("repo_id",)) -> int:
    """Write ``df`` as the next version; readers move over once it is finished.

    ``df`` may read an earlier version of the same table. A job that dies half
    way leaves no success marker, and its folder is replaced by the next try.
    With ``time_column`` the version is stored by day. Earlier versions stay for
    readers that have begun, until ``drop_versions`` is called.
    """
    versions = published_versions(df.sparkSession, root)
    version = versions[-1] + 1 if versions else 1
    path = f"{root}/version={version}"
    if time_column is None:
        write_table(df, path)
    else:
        write_mart(df, path, time_column, cluster_by)
    return version


def drop_versions(spark: SparkSession, root: str, keep: int = 3) -> None:
    """Remove all but the latest ``keep`` versions; call it when no reader of the others is left."""
    for old in published_versions(spark, root)[:-keep]:
        remove_folder(spark, f"{root}/version={old}")


def upsert_table(updates: DataFrame, root: str, keys: Sequence[str]) -> int:
    """Publish the table with ``updates`` put in place of rows with equal keys."""
    stored = read_published(updates.sparkSession, root)
    return publish(updates if stored is None else upsert(stored, updates, keys), root)
