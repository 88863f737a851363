"""Summaries of preference pairs, one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Margins whose loss of pairs is reported.
THRESHOLDS = (0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50, 0.60)


def pair_scores(pairs: DataFrame) -> DataFrame:
    """Pairs with their domain, contrast, and the chosen and rejected score maps."""
    e = F.col("evaluation")
    variant_chosen = e["chosen_score_source"] == "stage_2"
    return pairs.select(
        "pair_id", F.col("metadata.domain").alias("domain"), F.col("metadata.contrast.direction").alias("direction"), F.col("metadata.contrast.scope").alias("scope"), F.col("metadata.contrast.decision").alias("label"), F.col("metadata.contrast.intent_followed").alias("followed"), F.col("metadata.difficulty").alias("difficulty"), F.col("metadata.dimensions.decision").alias("decision"),
        e["stage_1_scores"].alias("original"), e["stage_2_scores"].alias("variant"), F.when(variant_chosen, e["stage_2_scores"]).otherwise(e["stage_1_scores"]).alias("chosen"), F.when(variant_chosen, e["stage_1_scores"]).otherwise(e["stage_2_scores"]).alias("rejected"),
    )


def both_have(a: Column, b: Column, dims: Column) -> Column:
    return F.filter(dims, lambda d: F.map_contains_key(a, d) & F.map_contains_key(b, d))


def score_shift(pairs: DataFrame) -> DataFrame:
    """(domain, dim, n, avg_original, avg_variant, shift) of characterizing dimensions that both sides have."""
    rows = pair_scores(pairs).select("domain", "original", "variant", F.explode(both_have(F.col("original"), F.col("variant"), F.col("decision"))).alias("dim"))
    out = rows.groupBy("domain", "dim").agg(F.count("*").alias("n"), F.avg(F.col("original")[F.col("dim")]).alias("o"), F.avg(F.col("variant")[F.col("dim")]).alias("v"))
    return out.select("domain", "dim", "n", F.round("o", 6).alias("avg_original"), F.round("v", 6).alias("avg_variant"), F.round(F.col("v") - F.col("o"), 6).alias("shift"))


def direction_distribution(pairs: DataFrame) -> DataFrame:
    """(domain, variant_chosen, original_chosen, total, variant_pct): the variant is chosen where intent and direction agree."""
    rows = pair_scores(pairs).select("domain", ((F.col("direction") == "positive") == F.col("followed")).alias("variant"))
    out = rows.groupBy("domain").agg(F.count_if("variant").alias("variant_chosen"), F.count_if(~F.col("variant")).alias("original_chosen"), F.count("*").alias("total"))
    return out.withColumn("variant_pct", F.round(F.col("variant_chosen") * 100.0 / F.col("total"), 6))


def variant_types(pairs: DataFrame) -> DataFrame:
    rows = pair_scores(pairs)
    whole = F.col("scope") == "global"
    return rows.groupBy("domain").agg(F.count_if(whole & (F.col("direction") == "positive")).alias("global_improve"), F.count_if(whole & (F.col("direction") == "negative")).alias("global_degrade"), F.count_if(~whole).alias("dimension_targeted"), F.count("*").alias("total"))


def margins(pairs: DataFrame) -> DataFrame:
    """(pair_id, domain, margin): mean of chosen less rejected over decision dimensions that both have; pairs without any are left out."""
    rows = pair_scores(pairs)
    shared = both_have(F.col("chosen"), F.col("rejected"), F.col("decision"))
    total = F.aggregate(shared, F.lit(0.0), lambda acc, d: acc + (F.col("chosen")[d] - F.col("rejected")[d]))
    return rows.filter(F.size(shared) > 0).select("pair_id", "domain", (total / F.size(shared)).alias("margin"))


def margin_sensitivity(pairs: DataFrame) -> DataFrame:
    """(domain, threshold, lost, total): pairs that a margin threshold, inclusive, would lose."""
    counted = margins(pairs).groupBy("domain").agg(F.count("*").alias("total"), *[F.count_if(F.col("margin") <= t).alias(f"t{i}") for i, t in enumerate(THRESHOLDS)])
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{i}").alias("lost")) for i, t in enumerate(THRESHOLDS)])).alias("r")
    return counted.select("domain", "total", rows).select("domain", "r.threshold", "r.lost", "total")


def label_rollup(pairs: DataFrame) -> DataFrame:
    """(domain, label, n) with totals: of each label, and of all."""
    rows = pair_scores(pairs).select("domain", "label")
    return rows.groupingSets([["domain", "label"], ["label"], []], "domain", "label").agg(F.count("*").alias("n")).select("domain", "label", "n")
