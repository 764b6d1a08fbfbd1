"""Newly arrived rounds, processed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def process_new(spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame]) -> None:
    """Run transform over the Parquet files under `source` that earlier runs haven't seen, and end.

    Each batch writes a folder of its own, named by its number, and overwrites it if it is run again, so a restart neither loses nor repeats rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    rows = spark.readStream.schema(schema).parquet(source)
    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def processed(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).drop("batch")


def count_labels(batch: DataFrame) -> DataFrame:
    """Segments per round and label of a batch."""
    return batch.groupBy("round_id", "label").agg(F.count("*").alias("n"))
