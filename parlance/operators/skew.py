"""Joins that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 200_000


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: list[str], weight: str, hot_rows: int = HOT_ROWS, how: str = "inner") -> DataFrame:
    """Join, inner or left, of ``rows`` with ``lookup`` (unique ``keys``; ``weight``: number of rows that have the key).

    Keys of ``hot_rows`` rows or more go to a broadcast table and their rows stay where they are. There are at most
    rows / hot_rows such keys, which bounds the broadcast. All other keys are joined by a shuffle in which no key has
    more than ``hot_rows`` rows but the null key of a left join, which joins nothing. That shuffle is asked for, since the
    lookup grows with the data and the size of its files says little of its size in memory.
    """
    heavy = F.broadcast(lookup.filter(F.col(weight) >= hot_rows))
    light = lookup.filter(F.col(weight) < hot_rows)
    cold = rows.join(heavy.select(*keys), keys, "left_anti").join(light.hint("merge"), keys, how)
    return rows.join(heavy, keys).unionByName(cold)


def slots_of(df: DataFrame, key: str, slots: int = 1 << 20) -> DataFrame:
    """Distinct hash slots of a key: at most ``slots`` rows whatever the data."""
    return df.select(F.pmod(F.xxhash64(key), F.lit(slots)).alias("slot")).distinct()


def bounded_semi_filter(rows: DataFrame, wanted: DataFrame, key: str, slots: int = 1 << 20) -> DataFrame:
    """``rows`` without most of those whose key is not in ``wanted``; none of the others is lost.

    A semi-join on hash slots with a broadcast of at most ``slots`` numbers, to thin out rows ahead of an exact join.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    return rows.withColumn("slot", slot).join(F.broadcast(slots_of(wanted, key, slots)), "slot", "left_semi").drop("slot")
