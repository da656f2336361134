"""File streams that stand in for a broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column layout of the Kafka source, with text instead of bytes.
RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

MAX_FILES_PER_TRIGGER = 1000


def read_record_files(
    spark: SparkSession,
    path: str,
    file_format: str = "json",
    schema: T.StructType | str = RECORD,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """Stream new files of ``path``, a bounded number per micro-batch."""
    return (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
    )
