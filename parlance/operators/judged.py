"""Joining judge replies to what was asked, and telling why a reply is no use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parlance.functions.dims import DOMAINS
from parlance.functions.replies import failure, scored, with_object

from .rows import last_wins

RETRYABLE = ("missing_from_batch", "api_error", "json_parse_error", "score_normalization_error", "incomplete_merge")
#: More failures than this hold a run back.
HOLDOUT_LIMIT = 100
DUAL = {"dim": ("causality", "consistency", "reaction", "desire"), "dlg": ("coherence", "empathy")}


def taxonomy(replies: DataFrame, manifest: DataFrame, prefix_len: int = 100) -> DataFrame:
    """Replies(custom_id, status_code, reply, error) with their manifest columns, parsed object, reason and detail.

    Replies to unknown ids stay, under a reason of their own; several replies to one id all stay. One pass gives both the
    parsed rows (reason is null) and the failures.
    """
    known = manifest.withColumn("__known", F.lit(True))
    out = with_object(replies.join(known, "custom_id", "left"), "reply")
    out = out.withColumn("reason", failure(F.col("status_code"), F.col("reply"), F.col("object"), F.coalesce("__known", F.lit(False))))
    detail = F.when(F.col("reason") == "api_error", F.coalesce("error", F.lit(""))).when(F.col("reason") == "json_parse_error", F.coalesce(F.nullif(F.substring("reply", 1, prefix_len), F.lit("")), F.lit("empty")))
    return out.withColumn("detail", detail).drop("__known")


def missing(replies: DataFrame, manifest: DataFrame) -> DataFrame:
    """Manifest ids that no reply has."""
    return manifest.join(replies.select("custom_id").distinct(), "custom_id", "left_anti")


def dual_outcomes(replies: DataFrame, manifest: DataFrame, order: list[str]) -> DataFrame:
    """Every manifest row of two-part judging with its scores and its first failure, dim before dlg.

    ``replies``(custom_id, status_code, reply, error, *order): ids end in -dim or -dlg; one without is a reply to both,
    used if there is no -dim. Of several replies to a part the last counts. A row is complete with all six scores.
    """
    d = DOMAINS["commonsense"]
    suffix = F.when(F.col("custom_id").endswith("-dim"), "dim").when(F.col("custom_id").endswith("-dlg"), "dlg").otherwise("single")
    base = F.when(suffix == "single", F.col("custom_id")).otherwise(F.expr("substring(custom_id, 1, length(custom_id) - 4)"))
    parts = last_wins(replies.withColumns({"base": base, "part": suffix}).drop("custom_id"), ["base", "part"], order)
    parts = with_object(parts, "reply").withColumn("why", F.when(F.coalesce("status_code", F.lit(0)) != 200, "api_error").when(F.col("object").isNull(), "json_parse_error"))
    r = F.struct(F.coalesce("why", F.lit("")).alias("why"), "object")
    wide = parts.groupBy("base").pivot("part", ["dim", "dlg", "single"]).agg(F.first(r))
    out = manifest.join(wide.withColumnRenamed("base", "custom_id"), "custom_id", "left")
    alone = F.col("single").isNotNull() & F.col("dim").isNull()
    part_why = lambda p: F.when(F.col(p).isNull(), "missing_from_batch").otherwise(F.nullif(F.col(p)["why"], F.lit("")))
    why = F.when(alone, F.nullif(F.col("single")["why"], F.lit(""))).otherwise(F.coalesce(part_why("dim"), part_why("dlg")))
    failed_id = F.when(alone, F.col("custom_id")).when(part_why("dim").isNotNull(), F.concat("custom_id", F.lit("-dim"))).otherwise(F.concat("custom_id", F.lit("-dlg")))
    scores = {}
    for part, dims in DUAL.items():
        obj = F.when(alone, F.col("single")["object"]).otherwise(F.col(part)["object"])
        scores |= {f"{d.prefix}_{dim}": c for dim, c in zip(dims, scored(obj, d, dims))}
    out = out.withColumn("reason", why).withColumn("failed_id", F.when(F.col("reason").isNotNull(), failed_id)).withColumns(scores)
    lacking = F.lit(False)
    for n in scores:
        lacking = lacking | F.col(n).isNull()
    incomplete = F.col("reason").isNull() & ~alone & lacking
    return out.withColumn("failed_id", F.when(incomplete, F.col("custom_id")).otherwise(F.col("failed_id"))).withColumn("reason", F.when(incomplete, "incomplete_merge").otherwise(F.col("reason"))).drop("dim", "dlg", "single")


def failure_breakdown(failures: DataFrame) -> DataFrame:
    """(reason, n, first_id): failures by reason."""
    return failures.groupBy("reason").agg(F.count("*").alias("n"), F.min("custom_id").alias("first_id"))


def failure_samples(failures: DataFrame, each: int = 5) -> DataFrame:
    """(reason, custom_id): the first few ids of each reason. Every task passes on no more than these."""
    place = F.row_number().over(Window.partitionBy("reason").orderBy("custom_id"))
    return failures.select("reason", "custom_id").withColumn("place", place).filter(F.col("place") <= each).drop("place")


def retry_set(failures: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests to send again: of each retryable failed id its own request, else both of its two parts if both are there."""
    ids = failures.filter(F.col("reason").isin(*RETRYABLE)).select("custom_id").distinct()
    wanted = ids.select(F.col("custom_id").alias("failed_id"), F.posexplode(F.array(F.col("custom_id"), F.concat("custom_id", F.lit("-dim")), F.concat("custom_id", F.lit("-dlg")))).alias("k", "custom_id"))
    found = wanted.join(requests, "custom_id")
    kinds = found.groupBy("failed_id").agg(F.min("k").alias("own"), F.countDistinct("k").alias("parts"))
    kept = found.join(kinds, "failed_id").filter("(own = 0 and k = 0) or (own > 0 and parts = 2)")
    return kept.drop("failed_id", "k", "own", "parts").distinct()


def lost_for_retry(failures: DataFrame, requests: DataFrame) -> DataFrame:
    """Retryable failed ids for which there is no request to send again."""
    ids = failures.filter(F.col("reason").isin(*RETRYABLE)).select("custom_id").distinct()
    sent = retry_set(failures, requests).select(F.col("custom_id").alias("sent"))
    stem = F.regexp_replace("sent", "-(dim|dlg)$", "")
    return ids.join(sent.select(F.explode(F.array(F.col("sent"), stem)).alias("custom_id")).distinct(), "custom_id", "left_anti")


def with_retries(first: DataFrame, *attempts: DataFrame) -> DataFrame:
    """Replies of the first run and of retries; for each id that of the latest attempt."""
    everything = first.withColumn("attempt", F.lit(0))
    for i, a in enumerate(attempts, 1):
        everything = everything.unionByName(a.withColumn("attempt", F.lit(i)))
    return last_wins(everything, ["custom_id"], ["attempt"]).drop("attempt")


def within_holdout(failures: DataFrame, limit: int = HOLDOUT_LIMIT) -> bool:
    """Whether so few ids failed that they may be held out. Reads no more than limit + 1 of them."""
    return failures.limit(limit + 1).count() <= limit
