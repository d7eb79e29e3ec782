"""First row per group and latest value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group in ``order``, NULLs last; NULL keys form a group.

    Spark limits each map task to one row per group before the shuffle
    (WindowGroupLimit), so a hot group reaches its reducer as one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def dedupe_events(
    df: DataFrame, id_column: str = "id", order_column: str = "created_at", tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per id: the earliest by ``order_column``, then by ``tie_break``.

    All other sortable columns follow as last tie-breaks, so the row kept does
    not depend on scan order.
    """
    head = [order_column, *tie_break]
    rest = [f.name for f in df.schema.fields if f.name not in {id_column, *head} and _sortable(f.dataType)]
    return first_per_group(df, [id_column], [*head, *rest])


def _sortable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_sortable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _sortable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def value_partials(df: DataFrame, keys: Sequence[str], value: str, order: str, any_true: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, value): its last and first time, number of rows, and flags.

    These rows are enough for ``merge_partials``, also when they are made of parts of the rows
    at a time and stored.
    """
    return df.groupBy(*keys, value).agg(
        F.max(order).alias("_last"),
        F.min(order).alias("_first"),
        F.count("*").alias("_rows"),
        *[F.bool_or(c).alias(c) for c in any_true],
    )


def merge_partials(
    partials: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    value_at: str | None = None,
    first_seen: str | None = None,
    last_seen: str | None = None,
    any_true: Sequence[str] = (),
    count: str | None = None,
) -> DataFrame:
    """One row per key from its ``value_partials``; equal times are decided by the larger value."""
    usable = F.col(value).isNotNull() & F.col("_last").isNotNull()
    outputs = [
        # max_by passes over rows whose ordering is NULL
        F.max_by(value, F.when(usable, F.struct("_last", value))).alias(value)
    ]
    outputs += [F.bool_or(c).alias(c) for c in any_true]
    if value_at:
        outputs.append(F.max(F.when(usable, F.col("_last"))).alias(value_at))
    if first_seen:
        outputs.append(F.min("_first").alias(first_seen))
    if last_seen:
        outputs.append(F.max("_last").alias(last_seen))
    if count:
        outputs.append(F.sum("_rows").alias(count))
    return partials.groupBy(*keys).agg(*outputs)


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: str,
    *,
    first_seen: str | None = None,
    last_seen: str | None = None,
    any_true: Sequence[str] = (),
    count: str | None = None,
) -> DataFrame:
    """Latest non-NULL ``value`` per key, with optional range, flags and row count.

    A text buffer would put ``max_by`` on sort-based aggregation of every input
    row. Grouping by (keys, value) first keeps the full input on hash
    aggregation with map-side combine; only one row per distinct value is left
    for ``max_by``. Equal times are decided by the larger value.
    """
    per_value = value_partials(df, keys, value, order, any_true)
    return merge_partials(
        per_value, keys, value, first_seen=first_seen, last_seen=last_seen, any_true=any_true, count=count
    )
