"""Choosing one row of several, and numbering rows, without bringing a whole group or table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parlance.functions.text import fingerprint
from parlance.session import materialize


def _chosen(df: DataFrame, keys: list[str], order: list[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = pick(F.struct(*[F.col(c) for c in rest]), F.struct(*order)).alias("__row")
    out = df.groupBy(*keys).agg(row)
    return out.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of least ``order`` for each key. Combined before the shuffle, so a hot key sends one row from each task."""
    return _chosen(df, keys, [F.col(c) for c in order], F.min_by)


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of greatest ``order`` for each key; nulls in it come before all others."""
    return _chosen(df, keys, [F.col(c) for c in order], F.max_by)


def distinct_texts(df: DataFrame, text: str, order: list[str]) -> DataFrame:
    """Rows whose stripped text comes first, with its fingerprint. Rows without a text are never copies of each other."""
    df = df.withColumn("fingerprint", F.when(F.coalesce(F.length(text), F.lit(0)) > 0, fingerprint(F.col(text))))
    return first_wins(df.filter("fingerprint is not null"), ["fingerprint"], order).select(*df.columns).unionByName(df.filter("fingerprint is null"))


def with_sequence(df: DataFrame, order: list[str], name: str = "seq", start: int = 1) -> DataFrame:
    """Consecutive numbers in the order of columns that identify a row.

    Rows are range-partitioned, counted for each range, and numbered within their range from its offset on. The offsets
    are one row for each range, so they may be broadcast.
    """
    ordered = df.repartitionByRange(*[F.col(c) for c in order]).withColumn("__range", F.spark_partition_id())
    ordered = materialize(ordered, "ranges")
    counts = ordered.groupBy("__range").agg(F.count("*").alias("n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ordered.join(F.broadcast(offsets), "__range").withColumn(name, F.col("__before") + within + (start - 1)).drop("__range", "__before")


def entry_ids(df: DataFrame, order: list[str], prefix: str, name: str) -> DataFrame:
    """Ids such as S1D-000001 in the order of ``order``."""
    return with_sequence(df, order, "__seq").withColumn(name, F.concat(F.lit(f"{prefix}-"), F.when(F.col("__seq") < 1_000_000, F.lpad(F.col("__seq").cast("string"), 6, "0")).otherwise(F.col("__seq").cast("string")))).drop("__seq")


def first_rows(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """The first n rows in order; all of them if n is None."""
    return df if n is None else df.orderBy(*order).limit(n)
