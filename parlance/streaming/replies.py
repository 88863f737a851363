"""Late replies as a stream: reply files are picked up as they arrive, parsed, and kept once for each id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parlance.sources.readers import REPLY, reply_columns


def read_replies(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Reply lines of files that appear in a folder, with arrived_at (the file's time)."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).format("text").load(folder)
    parsed = lines.select(F.from_json("value", REPLY).alias("r"), F.col("_metadata.file_modification_time").alias("arrived_at"))
    return parsed.filter("r.custom_id is not null").select(*reply_columns(F.col("r")), "arrived_at")


def first_replies(replies: DataFrame, delay: str = "7 days") -> DataFrame:
    """The first reply of each id within the watermark; state of older ids is dropped."""
    return replies.withWatermark("arrived_at", delay).dropDuplicatesWithinWatermark(["custom_id"])


def status_counts(replies: DataFrame, delay: str = "1 hour", width: str = "10 minutes") -> DataFrame:
    """Replies by window of arrival and status, of successes and failures."""
    return replies.withWatermark("arrived_at", delay).groupBy(F.window("arrived_at", width), "status").count()


def write_replies(replies: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Appends to parquet, exactly once, all that is there now."""
    return replies.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
