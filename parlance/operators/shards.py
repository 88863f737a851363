"""Requests in shards of bounded rows and bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parlance.session import materialize

from .rows import with_sequence

ROWS_PER_SHARD = 5_000
RETRY_ROWS, RETRY_BYTES = 50_000, 200 * 1024 * 1024


def sharded(requests: DataFrame, order: list[str], prefix: str, rows: int = ROWS_PER_SHARD, first: int = 1) -> DataFrame:
    """``requests`` with a ``shard`` name: so many rows each, in order, numbered from ``first``."""
    n = F.floor((F.col("__seq") - 1) / rows) + first
    return with_sequence(requests, order, "__seq").withColumn("shard", F.concat(F.lit(f"{prefix}_shard_"), F.when(n < 10_000, F.lpad(n.cast("string"), 4, "0")).otherwise(n.cast("string")))).drop("__seq")


def shards_by_size(requests: DataFrame, line: str, order: list[str], rows: int = RETRY_ROWS, size: int = RETRY_BYTES, per_run: int = 500_000) -> DataFrame:
    """``requests`` with a ``shard`` number such that no shard has more than so many rows or bytes of ``line`` and its line end.

    Runs of bounded length are cut greedily in order, each on its own, so the work is spread; a run's last shard may stay
    short. A line that is larger than a shard has one to itself.
    """
    numbered = with_sequence(requests, order, "__seq").withColumns({"__run": F.floor((F.col("__seq") - 1) / per_run), "__bytes": F.octet_length(line) + 1})

    def cut(pdf):
        shard, count, used, out = 0, 0, 0, []
        pdf = pdf.sort_values("__seq")
        for b in pdf["__bytes"]:
            if count and (count >= rows or used + b > size):
                shard, count, used = shard + 1, 0, 0
            count, used = count + 1, used + b
            out.append(shard)
        return pdf.assign(__own=out)[["__seq", "__run", "__own"]]

    owned = numbered.select("__seq", "__run", "__bytes").groupBy("__run").applyInPandas(cut, "__seq bigint, __run bigint, __own bigint")
    owned = materialize(owned, "shards")
    runs = owned.groupBy("__run").agg((F.max("__own") + 1).alias("n"))
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("__run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    placed = owned.join(F.broadcast(offsets), "__run").select("__seq", (F.col("__first") + F.col("__own") + 1).alias("shard"))
    return numbered.join(placed, "__seq").drop("__seq", "__run", "__bytes")
