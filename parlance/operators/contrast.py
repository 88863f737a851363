"""Tiers, candidates, labels and preference pairs: projections and classifications over scored dialogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.dims import CONTINUATION_SHARES, DOMAINS, by_domain, char_names_of, names_of
from parlance.functions.numeric import exact_mean, let

from .rows import entry_ids, first_wins, last_wins

LOW, MEDIUM, TURNING = 0.40, 0.70, 0.55
MARGIN, STABILITY = 0.05, 0.20
EASY, MIDDLING = 0.30, 0.15
FLIPPED = ("global_flip_pass", "target_flip_pass")


def score_map(scores: Column, domain: Column) -> Column:
    """Present scores of the domain as a map, from the wide struct of all dimensions."""
    return by_domain(domain, lambda d: F.map_filter(F.map_from_arrays(F.array(*map(F.lit, d.names)), F.array(*[scores[n] for n in d.names])), lambda k, v: v.isNotNull()))


def char_map(scores: Column, domain: Column) -> Column:
    return by_domain(domain, lambda d: F.map_filter(F.map_from_arrays(F.array(*map(F.lit, d.char_names)), F.array(*[scores[n] for n in d.char_names])), lambda k, v: v.isNotNull()))


def characterizing_avg(scores: Column, domain: Column) -> Column:
    """Mean of the domain's present characterizing scores; null if there are none."""
    return by_domain(domain, lambda d: exact_mean(F.array(*[scores[n] for n in d.char_names])))


def mean_at(scores: Column, dims: Column) -> Column:
    """Mean of a score map over those of ``dims`` that it has; null if none."""
    return exact_mean(F.transform(F.filter(dims, lambda d: F.map_contains_key(scores, d)), lambda d: scores[d]))


def tier(avg: Column) -> Column:
    return F.when(avg < LOW, "low").when(avg < MEDIUM, "medium").when(avg >= MEDIUM, "high")


def direction(avg: Column) -> Column:
    return F.when(avg < TURNING, "positive").when(avg >= TURNING, "negative")


def valid_entries(entries: DataFrame) -> DataFrame:
    """Entries with a score in any dimension, whose messages all have a role of the two, in any case."""
    names = [n for d in DOMAINS.values() for n in d.names]
    scored = F.coalesce(*[F.col("scores")[n] for n in names]).isNotNull()
    roles = F.coalesce(F.forall("messages", lambda m: F.coalesce(F.lower(m["role"]).isin("user", "assistant"), F.lit(False))), F.lit(False))
    return entries.filter(scored & roles)


def tiered(entries: DataFrame) -> DataFrame:
    """Training entries (a null split counts as one) with avg, tier and direction; those without an average are left out."""
    out = entries.filter("split is null or split = 'train'").withColumn("avg", characterizing_avg(F.col("scores"), F.col("domain")))
    return out.filter("avg is not null").withColumns({"tier": tier(F.col("avg")), "direction": direction(F.col("avg"))})


def candidates(entries: DataFrame, domain: str | None = None) -> DataFrame:
    """Rows for rewriting: one global for each dialogue but those of commonsense, and one targeted for each characterizing dimension, scored or not."""
    out = tiered(entries if domain is None else entries.filter(F.col("domain") == domain))
    chars = char_names_of(F.col("domain"))
    whole = F.struct(F.lit("global").alias("scope"), F.when(F.col("direction") == "positive", "global_improve").otherwise("global_degrade").alias("variant_type"), chars.alias("targets"))
    each = F.transform(chars, lambda d: F.struct(F.lit("target").alias("scope"), F.lit("dimension_targeted").alias("variant_type"), F.array(d).alias("targets")))
    kinds = F.when(F.col("domain") == "commonsense", each).otherwise(F.concat(F.array(whole), each))
    out = out.withColumn("c", F.explode(kinds)).withColumns({"scope": F.col("c.scope"), "variant_type": F.col("c.variant_type"), "target_dimensions": F.col("c.targets")}).drop("c")
    tag = F.when(F.col("variant_type") == "global_improve", "gimp").when(F.col("variant_type") == "global_degrade", "gdeg").otherwise(F.concat(F.lit("dt-"), F.col("target_dimensions")[0]))
    return out.withColumn("custom_id", F.concat_ws("-", F.lit("s2g"), "dialogue_id", tag))


def sampled_turns(key: Column, most: Column) -> Column:
    """Messages to continue with, by the fixed distribution over a hash of the key, at most ``most``."""
    u = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    out, upto = None, 0.0
    items = list(CONTINUATION_SHARES.items())
    for n, share in items[:-1]:
        upto += share
        out = (F.when(u < upto, n) if out is None else out.when(u < upto, n))
    return F.least(out.otherwise(items[-1][0]), most)


def prefix_of(messages: Column, n: Column) -> Column:
    """All but the last n messages; the first alone if there aren't more than n."""
    size = F.size(messages)
    return F.when(size > n, F.slice(messages, F.lit(1), size - n)).otherwise(F.slice(messages, 1, 1))


def continuation_of(messages: Column, n: Column) -> Column:
    """The last n messages; all but the first if there aren't more than n, or all of a single one."""
    size = F.size(messages)
    return F.when(size > n, F.slice(messages, size - n + 1, n)).when(size > 1, F.slice(messages, F.lit(2), size - 1)).otherwise(messages)


def requests(rows: DataFrame) -> DataFrame:
    """Candidates with two messages or more, with turn_count, prefix and the part to rewrite."""
    out = rows.filter(F.size("messages") >= 2).withColumn("turn_count", sampled_turns(F.col("custom_id"), F.size("messages") - 1))
    return out.withColumns({"prefix": prefix_of(F.col("messages"), F.col("turn_count")), "rewritable": continuation_of(F.col("messages"), F.col("turn_count"))})


def delivered_once(variants: DataFrame) -> DataFrame:
    """One row for each variant_id, the first loaded; its messages must be there."""
    return first_wins(variants.filter(F.size("variant_messages") > 0), ["variant_id"], ["loaded_at", "generated_at"])


def latest_results(results: DataFrame) -> DataFrame:
    """The last evaluated result for each variant_id; nulls in the time come first, then scores decide."""
    keyed = results.withColumn("__tie", F.to_json(F.struct("label", F.array_sort(F.map_entries("variant_scores")).alias("v"))))
    return last_wins(keyed, ["variant_id"], ["evaluated_at", "__tie"]).drop("__tie")


def first_entries(entries: DataFrame) -> DataFrame:
    """One row for each dialogue_id, the least entry_id."""
    return first_wins(entries, ["dialogue_id"], ["entry_id"])


def evaluations(variants: DataFrame, entries: DataFrame) -> DataFrame:
    """Evaluation requests: variants with their original's prefix, of the length that the variant leaves, and its scores."""
    original = entries.select(F.col("dialogue_id").alias("candidate_id"), "domain", "messages", score_map(F.col("scores"), F.col("domain")).alias("stage_1_scores"), "domain_metadata")
    out = variants.join(original, "candidate_id")
    return out.select(F.concat(F.lit("s2v-"), "variant_id").alias("custom_id"), "variant_id", "candidate_id", "domain", "direction", "variant_type", "target_dimensions", "stage_1_scores", "domain_metadata", prefix_of(F.col("messages"), F.size("variant_messages")).alias("prefix"), "variant_messages")


def label(original: Column, variant: Column, way: Column, scope: Column, chars: Column, targets: Column, margin: float = MARGIN, stability: float = STABILITY) -> Column:
    """One of six labels from how scores moved in the wanted way.

    Global variants go by the means of characterizing scores, targeted ones by those of their targets, and then by whether
    any other characterizing score that both sides have moved by more than ``stability``. Margins are exclusive.
    """
    sign = F.when(way == "positive", F.lit(1.0)).otherwise(F.lit(-1.0))
    moved = lambda dims: sign * (mean_at(variant, dims) - mean_at(original, dims))
    others = F.filter(chars, lambda d: ~F.array_contains(targets, d) & F.map_contains_key(original, d) & F.map_contains_key(variant, d))
    coarse = F.exists(others, lambda d: F.abs(variant[d] - original[d]) > stability)
    whole = let(moved(chars), lambda m: F.when(m > margin, "global_pass").when(m < -margin, "global_flip_pass").otherwise("reject"))
    aimed = let(moved(targets), lambda m: F.when(m < -margin, "target_flip_pass").when(m > margin, F.when(coarse, "target_coarse_pass").otherwise("target_pass")).otherwise("reject"))
    return F.when(scope == "global", whole).when(F.coalesce(F.size(targets), F.lit(0)) > 0, aimed).otherwise("reject")


def effective_dims(targets: Column, chars: Column) -> Column:
    return F.when(F.coalesce(F.size(targets), F.lit(0)) > 0, targets).otherwise(chars)


def margin_between(original: Column, variant: Column, dims: Column) -> Column:
    """Distance of the two means, each over the dims that its side has; 0 if one has none."""
    return F.coalesce(F.abs(mean_at(variant, dims) - mean_at(original, dims)), F.lit(0.0))


def difficulty(margin: Column) -> Column:
    return F.when(margin >= EASY, "easy").when(margin >= MIDDLING, "medium").otherwise("hard")


def outcomes(variants: DataFrame, results: DataFrame, entries: DataFrame) -> DataFrame:
    """Every variant with its outcome: no_result, rejected, no_original, bad_ordering, or pair, the first that holds.

    For pairs also the sides: the variant is chosen when its effective direction, the intended one unless the label says
    that it flipped, is positive.
    """
    scores = results.select("variant_id", "original_scores", "variant_scores", "label", F.lit(True).alias("has_result"))
    original = entries.select(F.col("dialogue_id").alias("candidate_id"), "domain", "messages", F.lit(True).alias("has_original"))
    out = variants.join(scores, "variant_id", "left").join(original, "candidate_id", "left")
    chars = char_names_of(F.col("domain"))
    dims = effective_dims(F.col("target_dimensions"), chars)
    flipped = F.col("label").isin(*FLIPPED)
    up = (F.col("direction") == "positive") != flipped
    out = out.withColumns({"chars": chars, "dims": dims, "up": up, "turn_count": F.size("variant_messages")})
    out = out.withColumns({"mean_original": mean_at(F.col("original_scores"), F.col("dims")), "mean_variant": mean_at(F.col("variant_scores"), F.col("dims"))})
    ordered = F.coalesce(F.when(F.col("up"), F.col("mean_variant") > F.col("mean_original")).otherwise(F.col("mean_original") > F.col("mean_variant")), F.lit(False))
    outcome = F.when(F.col("has_result").isNull() | F.col("label").isNull(), "no_result").when(F.col("label") == "reject", "rejected").when(F.col("has_original").isNull(), "no_original").when(~ordered, "bad_ordering").otherwise("pair")
    return out.withColumn("outcome", outcome)


def pairs(variants: DataFrame, results: DataFrame, entries: DataFrame) -> DataFrame:
    """Preference pairs, numbered in the order of variant_id, as nested rows."""
    made = entry_ids(outcomes(variants, results, entries).filter("outcome = 'pair'"), ["variant_id"], "S2D", "pair_id")
    n = F.col("turn_count")
    original = continuation_of(F.col("messages"), n)
    side = lambda variant_first: F.when(F.col("up") == F.lit(variant_first), F.col("variant_messages")).otherwise(original)
    distance = F.coalesce(F.abs(F.col("mean_variant") - F.col("mean_original")), F.lit(0.0))
    target_scope = F.col("variant_type") != "global"
    metadata = F.struct(
        "domain", F.lit("train").alias("split"), "generation_model", n.alias("turn_count"), difficulty(distance).alias("difficulty"),
        F.struct(F.when(target_scope, "target").otherwise("global").alias("scope"), "direction", F.col("label").alias("decision"), (~F.col("label").isin(*FLIPPED)).alias("intent_followed")).alias("contrast"),
        F.struct(names_of(F.col("domain")).alias("domain"), F.when(target_scope, F.col("target_dimensions")).otherwise(F.array().cast("array<string>")).alias("target"), F.col("chars").alias("decision")).alias("dimensions"),
    )
    source = lambda up: F.when(F.col("up") == F.lit(up), "stage_2").otherwise("stage_1")
    evaluation = F.struct(F.lit("lm_judge").alias("method"), F.col("original_scores").alias("stage_1_scores"), F.col("variant_scores").alias("stage_2_scores"), source(True).alias("chosen_score_source"), source(False).alias("rejected_score_source"))
    return made.select("pair_id", "variant_id", F.col("candidate_id").alias("source_dialogue_id"), metadata.alias("metadata"), evaluation.alias("evaluation"), prefix_of(F.col("messages"), n).alias("messages"), side(True).alias("chosen"), side(False).alias("rejected"))
