"""Landing of hour files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.sinks.tables import write_bronze
from eventloom.sources.raw import to_bronze


def land_new_hours(
    spark: SparkSession, raw_dir: str, bronze_root: str, checkpoint: str, files_per_batch: int = 24
) -> None:
    """Land the hour files in ``raw_dir`` that earlier runs have not landed, then stop.

    The stream's checkpoint remembers the files done. A batch that is repeated
    after a failure replaces the same partitions, so nothing is doubled.
    """
    stream = (
        spark.readStream.schema(schemas.RAW)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(raw_dir)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )

    def land(batch: DataFrame, _batch_id: int) -> None:
        write_bronze(to_bronze(batch), bronze_root)

    (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
