"""Exact quotas: stratified samples with refill, and stratified splits. Membership goes by the order of a seeded hash."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parlance.functions.dims import TURN_BUCKETS
from parlance.functions.text import count_turns, turn_bucket

from .rows import distinct_texts

BUCKETS = [f"{a}-{b}" for a, b in TURN_BUCKETS]


def seeded(seed: int, *cols: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def bucketed(rows: DataFrame, text: str, order: list[str]) -> DataFrame:
    """Distinct texts with their turns and turn bucket."""
    out = distinct_texts(rows, text, order)
    return out.withColumn("turns", count_turns(F.col(text))).withColumn("bucket", turn_bucket(F.col("turns"), TURN_BUCKETS))


def sample_quotas(counts: DataFrame, target: int, label_shares: dict[str, float], weights: tuple[float, ...]) -> DataFrame:
    """(label, bucket, available, needed, taken) from ``counts``(label, bucket, available).

    A label's target is the whole part of its share, a bucket's the whole part of its weight of that; what rounding left
    over goes to the label's bucket with most rows, the first of equals. Quotas are worked out in doubles, whose whole
    parts can be one lower than those of exact fractions.
    """
    spark = counts.sparkSession
    plan = [(label, b, i, int(int(target * share) * w), int(target * share)) for label, share in label_shares.items() for i, (b, w) in enumerate(zip(BUCKETS, weights))]
    quotas = spark.createDataFrame(plan, "label string, bucket string, ord int, base int, label_target int")
    have = quotas.join(counts.select("label", "bucket", "available"), ["label", "bucket"], "left").withColumn("available", F.coalesce("available", F.lit(0)).cast("bigint"))
    by_label = Window.partitionBy("label")
    left_over = F.col("label_target") - F.sum("base").over(by_label)
    most = F.row_number().over(by_label.orderBy(F.desc("available"), "ord")) == 1
    needed = (F.col("base") + F.when(most, left_over).otherwise(0)).cast("bigint")
    return have.withColumn("needed", needed).select("label", "bucket", "available", "needed", F.least("needed", "available").alias("taken"))


def stratified_sample(rows: DataFrame, text: str, label: str, order: list[str], target: int, label_shares: dict[str, float], weights: tuple[float, ...], seed: int = 42) -> DataFrame:
    """``rows`` that are sampled, of distinct texts, by label and turn bucket; what a bucket lacks is taken from the label's leftovers.

    Null labels count as the first label; labels without a share are never sampled. No rank beyond twice the target can
    matter, neither for a bucket's own rows nor for its leftovers, so every task drops the others before the shuffle.
    """
    first = next(iter(label_shares))
    pool = bucketed(rows.withColumn("label", F.coalesce(F.col(label), F.lit(first))), text, order).filter(F.col("label").isin(*label_shares))
    quotas = sample_quotas(pool.groupBy("label", "bucket").agg(F.count("*").alias("available")), target, label_shares, weights)
    lacking = quotas.groupBy("label").agg((F.sum("needed") - F.sum("taken")).alias("lacking"))
    pool = pool.withColumn("__h", seeded(seed, "fingerprint"))
    ranked = pool.withColumn("__rank", F.row_number().over(Window.partitionBy("label", "bucket").orderBy("__h"))).filter(F.col("__rank") <= 2 * target).join(F.broadcast(quotas.select("label", "bucket", "taken")), ["label", "bucket"])
    left = ranked.filter("__rank > taken").withColumn("__rank", F.row_number().over(Window.partitionBy("label").orderBy("__h"))).join(F.broadcast(lacking), "label").filter("__rank <= lacking")
    columns = list(dict.fromkeys([*rows.columns, "label", "bucket"]))
    return ranked.filter("__rank <= taken").select(*columns).unionByName(left.select(*columns))


def turn_sample(rows: DataFrame, text: str, order: list[str], target: int, weights: tuple[float, ...], seed: int = 42) -> DataFrame:
    """The same without labels: by turn bucket, refilled from all leftovers."""
    return stratified_sample(rows.withColumn("__all", F.lit("all")), text, "__all", order, target, {"all": 1.0}, weights, seed).drop("__all", "label")


def largest_remainder(counts: dict[str, int], total: int) -> dict[str, int]:
    """``total`` shared in proportion to counts: whole parts, then one each to the largest remainders, the first of equals."""
    n = sum(counts.values())
    if not n:
        return dict.fromkeys(counts, 0)
    exact = {k: total * c / n for k, c in counts.items()}
    out = {k: math.floor(x) for k, x in exact.items()}
    for k in sorted(counts, key=lambda k: (out[k] - exact[k], list(counts).index(k)))[: total - sum(out.values())]:
        out[k] += 1
    return out


def split_quotas(counts: dict[str, int], shares: dict[str, float]) -> dict[str, dict[str, int]]:
    """Rows of test, val and train of each stratum: test takes the ceiling of its share of all, val that of the rest, both in proportion to strata."""
    n = sum(counts.values())
    n_test = math.ceil(shares["test"] * n)
    train = largest_remainder(counts, n - n_test)
    test = {k: c - train[k] for k, c in counts.items()}
    m = n - n_test
    n_val = math.ceil(shares["val"] / (1.0 - shares["test"]) * m)
    kept = largest_remainder(train, m - n_val)
    return {k: {"test": test[k], "val": train[k] - kept[k], "train": kept[k]} for k in counts}


def assign_splits(rows: DataFrame, stratum: str, key: str, strata: list[str], shares: dict[str, float], seed: int = 42, cells: int = 1 << 12) -> DataFrame:
    """``rows`` with a new ``split``, stratified: exact quotas, members in hash order. Rows of strata not listed are left out.

    Ranks come from counts of hash cells, added up in order, and from the place within a cell, so no task sorts a stratum.
    """
    h = seeded(seed, key)
    rows = rows.filter(F.col(stratum).isin(*strata)).drop("split").withColumn("__h", h).withColumn("__cell", F.conv(F.substring(h, 1, 3), 16, 10).cast("int"))
    cell_counts = rows.groupBy(stratum, "__cell").agg(F.count("*").alias("n"))
    found = {r[0]: r[1] for r in cell_counts.groupBy(stratum).agg(F.sum("n")).collect()}
    quotas = split_quotas({s: found.get(s, 0) for s in strata}, shares)
    before = Window.partitionBy(stratum).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cell_counts.select(stratum, "__cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    # at most strata x 4096 rows
    ranked = rows.join(F.broadcast(offsets), [stratum, "__cell"]).withColumn("__rank", F.col("__before") + F.row_number().over(Window.partitionBy(stratum, "__cell").orderBy("__h", key)))
    limit = lambda which: F.create_map(*[x for s in strata for x in (F.lit(s), F.lit(sum(quotas[s][w] for w in which)))])[F.col(stratum)]
    split = F.when(F.col("__rank") <= limit(["test"]), "test").when(F.col("__rank") <= limit(["test", "val"]), "val").otherwise("train")
    return ranked.withColumn("split", split).drop("__h", "__cell", "__before", "__rank")
