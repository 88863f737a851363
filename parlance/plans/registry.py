"""Queries of the pipeline's own operators over whole tables, and the SQL that each is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions import numeric, text
from parlance.functions.dims import ALL_DIMS, BUCKET_WEIGHTS, DESCRIPTIONS, DOMAINS, LABEL_SHARES, SPLIT_SHARES, TURN_BUCKETS
from parlance.functions.replies import scored
from parlance.operators import analytics, contrast, judged, merge, quota, rows, shards
from parlance.session import table

from . import prompts
from .judge import stub_score

SAMPLE_TARGET = 200
RELATIONS = ["HinderedBy", "IsAfter", "xAttr", "xReact", "oReact", "xWant", "oWant", "xNeed"]


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "stage1_entry")


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contrast.delivered_once(table(spark, sf_dir, "stage2_variant"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contrast.latest_results(table(spark, sf_dir, "eval_result"))


def delivered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.first_wins(table(spark, sf_dir, "stage2_pair"), ["pair_id"], ["built_at"])


# --- texts, copies, samples, splits


def turn_count_buckets(spark, sf_dir):
    t = table(spark, sf_dir, "documents").filter("text is not null").select(text.count_turns(F.col("text")).alias("turns"))
    return t.groupBy(text.turn_bucket(F.col("turns"), TURN_BUCKETS).alias("bucket")).agg(F.count("*").alias("n_docs"), F.sum("turns").alias("n_turns"))


def dedupe_fingerprint(spark, sf_dir):
    return rows.distinct_texts(table(spark, sf_dir, "manifest").select("row_id", "content"), "content", ["row_id"]).select("row_id", "fingerprint")


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "manifest").filter("label is not null").select("row_id", "content", F.initcap(F.lower(text.strip(F.col("label")))).alias("label"))


def stratified_sample_quota(spark, sf_dir):
    pool = quota.bucketed(_labelled(spark, sf_dir), "content", ["row_id"])
    counts = pool.groupBy("label", "bucket").agg(F.count("*").alias("available"))
    return quota.sample_quotas(counts, SAMPLE_TARGET, LABEL_SHARES, BUCKET_WEIGHTS["coherence"])


def stratified_sample_rows(spark, sf_dir):
    return quota.stratified_sample(_labelled(spark, sf_dir), "content", "label", ["row_id"], SAMPLE_TARGET, LABEL_SHARES, BUCKET_WEIGHTS["coherence"]).select("row_id", "label", "bucket")


def split_assign(spark, sf_dir):
    return quota.assign_splits(entries(spark, sf_dir).select("entry_id", "domain"), "domain", "entry_id", list(DOMAINS), SPLIT_SHARES).select("entry_id", "domain", "split")


def split_counts(spark, sf_dir):
    return split_assign(spark, sf_dir).groupBy("domain", "split").agg(F.count("*").alias("n"))


def split_crosstab(spark, sf_dir):
    t = entries(spark, sf_dir).groupBy("domain").agg(*[F.count_if(F.col("split") == s).alias(s) for s in SPLIT_SHARES], F.count_if(F.col("split").isNull()).alias("none"), F.count("*").alias("total"))
    return t.withColumn("train_pct", F.round(F.col("train") * 100.0 / F.col("total"), 6))


def dialogue_messages(spark, sf_dir):
    t = table(spark, sf_dir, "manifest").select("row_id", F.posexplode(text.messages_of(F.col("content"))).alias("pos", "m"))
    return t.select("row_id", "pos", "m.role", "m.content")


def context_turns(spark, sf_dir):
    t = table(spark, sf_dir, "manifest").filter(F.contains("content", F.lit("[UTT]")))
    return t.select("row_id", text.context_lines(F.col("content")).alias("lines"))


def conversation_turns(spark, sf_dir):
    t = table(spark, sf_dir, "manifest").filter("content like 'SPK%'")
    return t.select("row_id", text.numbered_turns(F.col("content")).alias("turns"))


# --- scores and replies


def merge_scores_long(spark, sf_dir):
    return merge.long_scores(entries(spark, sf_dir))


def normalize_scores(spark, sf_dir):
    x = F.col("l_discount") * F.col("l_quantity") + F.col("l_tax") - F.lit(0.5)
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", x.alias("x"))
    five = numeric.coerce_score(F.col("x"))
    return t.select("l_orderkey", "l_linenumber", five.alias("score"), numeric.unit_from_five(five).alias("from_five"), numeric.coerce_unit(F.col("x")).alias("unit"), numeric.normalize_score(F.col("x")).alias("normalized"))


def stub_scores(spark, sf_dir):
    t = entries(spark, sf_dir).select("entry_id", "dialogue_id", F.explode(F.array(*map(F.lit, ALL_DIMS[:6]))).alias("dim"))
    return t.select("entry_id", "dim", stub_score(F.col("dialogue_id"), F.col("dim")).alias("score"))


def stub_scores_all(spark, sf_dir):
    """Scores of all 23 dimensions, whatever the entry's domain."""
    t = entries(spark, sf_dir).select("entry_id", "dialogue_id", F.explode(F.array(*map(F.lit, ALL_DIMS))).alias("dim"))
    return t.select("entry_id", "dim", stub_score(F.col("dialogue_id"), F.col("dim")).alias("score"))


def _replies(spark, sf_dir):
    """Replies of every shape for each coherence entry, by its id; the manifest lacks some."""
    e = entries(spark, sf_dir).filter("domain = 'coherence'").select("entry_id", F.concat(F.lit("co-"), "entry_id").alias("custom_id"), (F.pmod("entry_id", F.lit(5)) + 1).alias("s"), F.pmod("entry_id", F.lit(8)).alias("k"))
    nested = F.format_string('{"co_topic_coherence": {"reasoning": "r", "score": %d}, "overall_coherence_score": %d}', "s", "s")
    reply = (
        F.when(F.col("k") == 0, nested).when(F.col("k") == 1, F.concat(F.lit("```json\n"), nested, F.lit("\n```"))).when(F.col("k") == 2, F.format_string('Sure: {"topic_coherence": %d,\r\n}', "s"))
        .when(F.col("k") == 3, F.format_string("{'topic_coherence': %d}", "s")).when(F.col("k") == 4, F.format_string("[%d]", "s")).when(F.col("k") == 5, F.lit("I can't say")).when(F.col("k") == 6, nested)
    )
    replies = e.select("entry_id", "custom_id", F.when(F.col("k") == 6, 500).otherwise(200).alias("status_code"), reply.alias("reply"), F.when(F.col("k") == 6, "server error").alias("error"))
    return replies, e.filter(F.pmod("entry_id", F.lit(11)) != 0).select("custom_id")


def judge_parse_taxonomy(spark, sf_dir):
    out = judged.taxonomy(*_replies(spark, sf_dir))
    score = scored(F.col("object"), DOMAINS["coherence"], ("topic_coherence",))[0]
    return out.select("entry_id", "reason", F.when(F.col("reason").isNull(), score).alias("score"))


def failure_breakdown(spark, sf_dir):
    return judged.failure_breakdown(judged.taxonomy(*_replies(spark, sf_dir)).filter("reason is not null"))


def missing_responses(spark, sf_dir):
    manifest = table(spark, sf_dir, "manifest").select("custom_id").distinct()
    return judged.missing(entries(spark, sf_dir).select(F.col("source_id").alias("custom_id")), manifest)


def _dual(spark, sf_dir):
    e = entries(spark, sf_dir).filter("domain = 'commonsense'").select("entry_id", F.concat(F.lit("cs-"), "entry_id").alias("base"), (F.pmod("entry_id", F.lit(101)) / 100.0).alias("v"))
    fields = lambda names: F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"cs_{n}": '), F.col("v").cast("string")) for n in names]), F.lit("}"))
    dim = e.filter("entry_id % 7 <> 0").select(F.concat("base", F.lit("-dim")).alias("custom_id"), F.lit(200).alias("status_code"), F.when(F.col("entry_id") % 3 == 0, fields(("causality", "consistency", "reaction"))).otherwise(fields(("causality", "consistency", "reaction", "desire"))).alias("reply"), F.lit(None).cast("string").alias("error"), F.lit(1).alias("line_no"))
    dlg = e.select(F.concat("base", F.lit("-dlg")).alias("custom_id"), F.when(F.col("entry_id") % 5 == 0, 500).otherwise(200).alias("status_code"), fields(("coherence", "empathy")).alias("reply"), F.lit(None).cast("string").alias("error"), F.lit(1).alias("line_no"))
    late = dim.filter("substr(custom_id, 4, 1) = '1'").withColumn("reply", F.lit("broken")).withColumn("line_no", F.lit(2))
    return dim.unionByName(dlg).unionByName(late), e.select("entry_id", F.col("base").alias("custom_id"))


def dual_prompt_merge(spark, sf_dir):
    out = judged.dual_outcomes(*_dual(spark, sf_dir), ["line_no"])
    total = sum((F.col(n) for n in DOMAINS["commonsense"].names[1:]), F.col(DOMAINS["commonsense"].names[0]))
    return out.select("entry_id", "failed_id", "reason", F.when(F.col("reason").isNull(), F.round(total, 6)).alias("total"))


def retry_set(spark, sf_dir):
    replies, manifest = _dual(spark, sf_dir)
    failures = judged.dual_outcomes(replies, manifest, ["line_no"]).filter("reason is not null").select(F.col("failed_id").alias("custom_id"), "reason")
    asked = manifest.select(F.explode(F.array(F.concat("custom_id", F.lit("-dim")), F.concat("custom_id", F.lit("-dlg")))).alias("custom_id"))
    return judged.retry_set(failures, asked)


def gold_enrich(spark, sf_dir):
    m = table(spark, sf_dir, "manifest").filter("pid is not null").select("row_id", "pid")
    relation = F.element_at(F.array(*map(F.lit, RELATIONS)), (F.pmod("row_id", F.lit(len(RELATIONS))) + 1).cast("int"))
    lookup = merge.gold_by_pid(m.withColumn("gold", relation), ["row_id"])
    return merge.enrich(m, lookup, "pid").select("row_id", F.col("domain_metadata")["gold_relation"].alias("gold_relation"), F.col("domain_metadata")["target_dimension"].alias("target_dimension"))


def metadata_enrich(spark, sf_dir):
    m = table(spark, sf_dir, "manifest").select("row_id", "uid", "country_1", "country_2")
    lookup = merge.metadata_by_uid(m, ["row_id"], ("country_1", "country_2"))
    return merge.enrich(m.select("row_id", "uid"), lookup, "uid").select("row_id", F.col("domain_metadata")["country_1"].alias("country_1"), F.col("domain_metadata")["country_2"].alias("country_2"))


def entry_validity(spark, sf_dir):
    return contrast.valid_entries(entries(spark, sf_dir)).groupBy("domain").agg(F.count("*").alias("n_valid"))


# --- candidates, requests, labels, pairs


def tier_distribution(spark, sf_dir):
    return contrast.tiered(entries(spark, sf_dir)).groupBy("domain", "tier").agg(F.count("*").alias("n"))


def direction_split(spark, sf_dir):
    return contrast.tiered(entries(spark, sf_dir)).groupBy("domain", "direction").agg(F.count("*").alias("n"), F.round(F.avg("avg"), 6).alias("mean_avg"))


def candidates(spark, sf_dir):
    return contrast.candidates(entries(spark, sf_dir)).select("entry_id", "custom_id", "variant_type", "direction", F.array_join("target_dimensions", ",").alias("targets"))


def turn_sample(spark, sf_dir):
    return contrast.requests(contrast.candidates(entries(spark, sf_dir))).select("entry_id", "custom_id", "turn_count", F.size("prefix").alias("n_prefix"), F.size("rewritable").alias("n_rewritable"))


def generation_prompts(spark, sf_dir):
    return prompts.generation_prompt(contrast.requests(contrast.candidates(contrast.valid_entries(entries(spark, sf_dir))))).select("entry_id", "custom_id", "prompt")


def judge_prompts(spark, sf_dir):
    m = table(spark, sf_dir, "manifest").filter("custom_id like 'co-%' or custom_id like 'em-%'")
    both = F.when(F.col("custom_id").startswith("co-"), prompts.whole_number_judge(F.col("content"), DOMAINS["coherence"])).otherwise(prompts.whole_number_judge(F.col("content"), DOMAINS["empathy"]))
    return m.select("row_id", "custom_id", both.alias("prompt")).filter("prompt is not null")


def multicultural_prompts(spark, sf_dir):
    """Judge prompts of conversations; the id stands in for the statement, which the manifest lacks."""
    m = table(spark, sf_dir, "manifest").filter("content like 'SPK%'")
    return m.select("row_id", prompts.multicultural_judge(F.col("content"), F.col("custom_id"), F.col("country_1"), F.col("country_2")).alias("prompt")).filter("prompt is not null")


def commonsense_prompts(spark, sf_dir):
    """Both judge prompts of contexts; the id stands in for the target, and there are no relations but one."""
    m = table(spark, sf_dir, "manifest").filter(F.contains("content", F.lit("[UTT]")))
    relations = F.create_map(*[x for r in RELATIONS[:-1] for x in (F.lit(r), F.coalesce("label", F.lit("")) if r == "xWant" else F.lit(""))])
    return m.select("row_id", F.explode(prompts.commonsense_judges(F.col("content"), F.col("custom_id"), relations)).alias("p")).select("row_id", "p.part", "p.prompt")


def turn_bucket_sample(spark, sf_dir):
    """A sample by turn bucket alone."""
    m = table(spark, sf_dir, "manifest").select("row_id", "content")
    return quota.turn_sample(m, "content", ["row_id"], SAMPLE_TARGET, BUCKET_WEIGHTS["empathy"]).select("row_id", "bucket")


def shard_assignment(spark, sf_dir):
    c = contrast.candidates(contrast.first_entries(entries(spark, sf_dir))).select("custom_id")
    return shards.sharded(c, ["custom_id"], "stage2_gen", rows=500, first=0)


def prefix_continuation(spark, sf_dir):
    v = variants(spark, sf_dir).select("variant_id", F.col("candidate_id").alias("dialogue_id"), F.size("variant_messages").alias("n"))
    j = v.join(contrast.first_entries(entries(spark, sf_dir)).select("dialogue_id", "messages"), "dialogue_id")
    said = lambda c: F.md5(F.array_join(F.transform(c, lambda m: F.coalesce(m["content"], F.lit(""))), "|"))
    return j.select("variant_id", said(contrast.prefix_of(F.col("messages"), F.col("n"))).alias("prefix_md5"), said(contrast.continuation_of(F.col("messages"), F.col("n"))).alias("continuation_md5"))


def eval_requests(spark, sf_dir):
    e = contrast.evaluations(variants(spark, sf_dir), contrast.first_entries(entries(spark, sf_dir)))
    return e.select("custom_id", "variant_id", "domain", "direction", F.size("stage_1_scores").alias("n_scores"), F.size("prefix").alias("n_prefix"))


def evaluation_prompts(spark, sf_dir):
    e = contrast.evaluations(variants(spark, sf_dir), contrast.first_entries(entries(spark, sf_dir)))
    return prompts.evaluation_prompt(e).select("custom_id", "prompt")


def latest_results(spark, sf_dir):
    return results(spark, sf_dir).select("variant_id", "label", F.round(F.aggregate(F.array_sort(F.map_values("variant_scores")), F.lit(0.0), lambda a, x: a + x), 6).alias("score_sum"))


def eval_labels(spark, sf_dir):
    j = variants(spark, sf_dir).join(results(spark, sf_dir).drop("label"), "variant_id").join(contrast.first_entries(entries(spark, sf_dir)).select(F.col("dialogue_id").alias("candidate_id"), "domain"), "candidate_id")
    label = contrast.label(F.col("original_scores"), F.col("variant_scores"), F.col("direction"), F.col("variant_type"), contrast.char_names_of(F.col("domain")), F.col("target_dimensions"))
    return j.select("variant_id", "domain", label.alias("label"))


def label_distribution(spark, sf_dir):
    t = eval_labels(spark, sf_dir).groupBy("domain").agg(*[F.count_if(F.col("label") == x).alias(x) for x in ("global_pass", "global_flip_pass", "target_pass", "target_coarse_pass", "target_flip_pass", "reject")], F.count("*").alias("total"))
    return t.withColumn("usable_pct", F.round((F.col("total") - F.col("reject")) * 100.0 / F.col("total"), 6))


def pair_outcomes(spark, sf_dir):
    out = contrast.outcomes(variants(spark, sf_dir), results(spark, sf_dir), contrast.first_entries(entries(spark, sf_dir)))
    return out.groupBy("outcome").agg(F.count("*").alias("n"))


def pairs(spark, sf_dir):
    p = contrast.pairs(variants(spark, sf_dir), results(spark, sf_dir), contrast.first_entries(entries(spark, sf_dir)))
    said = lambda c: F.md5(F.array_join(F.transform(c, lambda m: F.coalesce(m["content"], F.lit(""))), "|"))
    return p.select("pair_id", "variant_id", "source_dialogue_id", F.col("metadata.domain").alias("domain"), F.col("metadata.difficulty").alias("difficulty"), F.col("metadata.contrast.scope").alias("scope"), F.col("metadata.contrast.decision").alias("decision"), F.col("metadata.contrast.intent_followed").alias("intent_followed"), F.col("evaluation.chosen_score_source").alias("chosen_source"), said(F.col("messages")).alias("prompt_md5"), said(F.col("chosen")).alias("chosen_md5"), said(F.col("rejected")).alias("rejected_md5"))


def pair_difficulty(spark, sf_dir):
    return delivered_pairs(spark, sf_dir).groupBy(F.col("metadata.domain").alias("domain"), F.col("metadata.difficulty").alias("difficulty")).agg(F.count("*").alias("n"))


def _of_pairs(summary):
    def query(spark, sf_dir):
        return summary(delivered_pairs(spark, sf_dir))

    return query


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs made from variants, results and originals, by domain, label and difficulty."""
    p = contrast.pairs(variants(spark, sf_dir), results(spark, sf_dir), contrast.first_entries(entries(spark, sf_dir)))
    return p.groupBy(F.col("metadata.domain").alias("domain"), F.col("metadata.contrast.decision").alias("label"), F.col("metadata.difficulty").alias("difficulty")).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        turn_count_buckets, dedupe_fingerprint, stratified_sample_quota, stratified_sample_rows, split_assign, split_counts, split_crosstab, dialogue_messages, context_turns, conversation_turns,
        merge_scores_long, normalize_scores, stub_scores, stub_scores_all, judge_parse_taxonomy, failure_breakdown, missing_responses, dual_prompt_merge, retry_set, gold_enrich, metadata_enrich, entry_validity,
        tier_distribution, direction_split, candidates, turn_sample, generation_prompts, judge_prompts, multicultural_prompts, commonsense_prompts, turn_bucket_sample, shard_assignment, prefix_continuation, eval_requests, evaluation_prompts, latest_results, eval_labels, label_distribution, pair_outcomes, pairs, pair_difficulty, flagship,
    )
} | {"score_shift": _of_pairs(analytics.score_shift), "direction_distribution": _of_pairs(analytics.direction_distribution), "variant_type_breakdown": _of_pairs(analytics.variant_types), "margin_sensitivity": _of_pairs(analytics.margin_sensitivity), "label_rollup": _of_pairs(analytics.label_rollup)}

# --- the same in SQL

SPACE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
_strip = lambda x: rf"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"
_turns = lambda x: rf"greatest(1, len(list_filter(string_split({x}, chr(10)), lambda s: NOT regexp_full_match(s, '{SPACE}*'))))"
_bucket = lambda t: f"CASE WHEN {t} BETWEEN 2 AND 6 THEN '2-6' WHEN {t} BETWEEN 7 AND 10 THEN '7-10' WHEN {t} BETWEEN 11 AND 16 THEN '11-16' ELSE '17-999' END"
_chars = "CASE domain " + " ".join(f"WHEN '{n}' THEN [{', '.join(repr(x) for x in d.char_names)}]" for n, d in DOMAINS.items()) + " END"
_names = "CASE domain " + " ".join(f"WHEN '{n}' THEN [{', '.join(repr(x) for x in d.names)}]" for n, d in DOMAINS.items()) + " END"
_char_scores = "CASE domain " + " ".join(f"WHEN '{n}' THEN [{', '.join('scores.' + x for x in d.char_names)}]" for n, d in DOMAINS.items()) + " END"
_all_scores = "CASE domain " + " ".join(f"WHEN '{n}' THEN [{', '.join('scores.' + x for x in d.names)}]" for n, d in DOMAINS.items()) + " END"
# exact means: doubles of [0, 1] are whole multiples of 2^-60 here; sums of whole numbers are exact, and the quotient is
# rounded once, when it becomes a double, with a bit that tells whether anything was cut off
_sum60 = lambda xs: f"list_sum([(x * 1152921504606846976e0)::BIGINT for x in {xs}])"
_exact = lambda xs: f"((4 * {_sum60(xs)} // len({xs}) + CASE WHEN 4 * {_sum60(xs)} % len({xs}) <> 0 AND 4 * {_sum60(xs)} // len({xs}) % 2 = 0 THEN 1 ELSE 0 END)::BIGINT::DOUBLE / 4611686018427387904e0)"
_mean = lambda m, dims: _exact(f"[{m}[d] for d in {dims} if {m}[d] IS NOT NULL]")
_tiered = f"tiered AS (SELECT *, CASE WHEN a < 0.40e0 THEN 'low' WHEN a < 0.70e0 THEN 'medium' ELSE 'high' END tier, CASE WHEN a < 0.55e0 THEN 'positive' ELSE 'negative' END direction FROM (SELECT *, {_exact(f'list_filter({_char_scores}, lambda x: x IS NOT NULL)')} a, {_chars} chars FROM {{src}} WHERE split IS NULL OR split = 'train') WHERE a IS NOT NULL)"
_cand = f"""{_tiered}, kinds AS (
  SELECT entry_id, dialogue_id, messages, direction, CASE direction WHEN 'positive' THEN 'global_improve' ELSE 'global_degrade' END variant_type, chars targets FROM tiered WHERE domain <> 'commonsense'
  UNION ALL SELECT entry_id, dialogue_id, messages, direction, 'dimension_targeted', [d] FROM (SELECT *, unnest(chars) d FROM tiered)),
cand AS (SELECT *, 's2g-' || dialogue_id || '-' || CASE variant_type WHEN 'global_improve' THEN 'gimp' WHEN 'global_degrade' THEN 'gdeg' ELSE 'dt-' || targets[1] END custom_id FROM kinds)"""
_first_entries = "first_entries AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY dialogue_id ORDER BY entry_id) rn FROM stage1_entry) WHERE rn = 1)"
_variants = "v AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY loaded_at NULLS FIRST, generated_at NULLS FIRST) rn FROM stage2_variant WHERE len(variant_messages) > 0) WHERE rn = 1)"
_results = "r AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY evaluated_at DESC NULLS LAST) rn FROM eval_result) WHERE rn = 1)"
_dpairs = "p AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY built_at NULLS FIRST) rn FROM stage2_pair) WHERE rn = 1)"
_pair_scores = f"{_dpairs}, ps AS (SELECT pair_id, metadata.domain AS domain, metadata.contrast.direction AS direction, metadata.contrast.scope AS scope, metadata.contrast.decision AS label, metadata.contrast.intent_followed AS followed, metadata.dimensions.decision AS decision, evaluation.stage_1_scores o, evaluation.stage_2_scores v, CASE WHEN evaluation.chosen_score_source = 'stage_2' THEN evaluation.stage_2_scores ELSE evaluation.stage_1_scores END c, CASE WHEN evaluation.chosen_score_source = 'stage_2' THEN evaluation.stage_1_scores ELSE evaluation.stage_2_scores END j FROM p)"
_said = lambda x: f"md5(array_to_string([coalesce(m.content, '') for m in {x}], '|'))"
_prefix = lambda n: f"CASE WHEN len(messages) > {n} THEN messages[1:len(messages) - {n}] ELSE messages[1:1] END"
_rest = lambda n: f"CASE WHEN len(messages) > {n} THEN messages[len(messages) - {n} + 1:len(messages)] WHEN len(messages) > 1 THEN messages[2:len(messages)] ELSE messages END"
_speakerless = "trim_line"
for _p in text.SPEAKERS:
    _speakerless = f"regexp_replace({_speakerless}, '{_p.replace(chr(92) + 's', SPACE)}', '', 'i')"
_SPK = "^SPK[0-9]{2}-[A-Z]{3}[0-9]{3}:"
_unspk = f"regexp_replace(line, '{_SPK}', '')"
_effective = f"CASE WHEN len(target_dimensions) > 0 THEN target_dimensions ELSE {_chars} END"
_labelled_sql = f"lab AS (SELECT row_id, content, upper(l[1]) || l[2:] AS label FROM (SELECT *, lower({_strip('label')}) l FROM manifest WHERE label IS NOT NULL)), pool AS (SELECT *, {_bucket('turns')} bucket FROM (SELECT *, {_turns('content')} turns FROM (SELECT *, md5({_strip('content')}) fingerprint, row_number() OVER (PARTITION BY md5({_strip('content')}) ORDER BY row_id) rn FROM lab WHERE length(content) > 0) WHERE rn = 1)), weights(bucket, ord, w) AS (VALUES ('2-6', 0, 0.20e0), ('7-10', 1, 0.25e0), ('11-16', 2, 0.30e0), ('17-999', 3, 0.25e0)), shares(label, share) AS (VALUES ('Yes', 0.70e0), ('No', 0.30e0)), plan AS (SELECT label, bucket, ord, floor(floor({SAMPLE_TARGET} * share) * w)::BIGINT base, floor({SAMPLE_TARGET} * share)::BIGINT goal FROM shares, weights), have AS (SELECT plan.*, coalesce(n, 0) available FROM plan LEFT JOIN (SELECT label, bucket, count(*) n FROM pool GROUP BY ALL) USING (label, bucket)), quotas AS (SELECT label, bucket, available, base + CASE WHEN row_number() OVER (PARTITION BY label ORDER BY available DESC, ord) = 1 THEN goal - sum(base) OVER (PARTITION BY label) ELSE 0 END needed FROM have)"

ORACLES: dict[str, str] = {
    "turn_count_buckets": f"WITH t AS (SELECT {_turns('text')} turns FROM documents WHERE text IS NOT NULL) SELECT {_bucket('turns')} bucket, count(*) n_docs, sum(turns)::BIGINT n_turns FROM t GROUP BY 1",
    "dedupe_fingerprint": f"SELECT min(row_id) row_id, md5({_strip('content')}) fingerprint FROM manifest WHERE length(content) > 0 GROUP BY 2 UNION ALL SELECT row_id, NULL FROM manifest WHERE content IS NULL OR content = ''",
    "stratified_sample_quota": f"WITH {_labelled_sql} SELECT label, bucket, available::BIGINT available, needed::BIGINT needed, least(needed, available)::BIGINT taken FROM quotas",
    "stratified_sample_rows": f"WITH {_labelled_sql}, ranked AS (SELECT pool.*, row_number() OVER (PARTITION BY label, bucket ORDER BY md5('42|' || fingerprint)) rk FROM pool WHERE label IN ('Yes', 'No')), cut AS (SELECT ranked.*, rk <= least(needed, available) own FROM ranked JOIN quotas USING (label, bucket)), refill AS (SELECT cut.*, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || fingerprint)) k FROM cut WHERE NOT own), lack AS (SELECT label, sum(needed - least(needed, available)) n FROM quotas GROUP BY 1) SELECT row_id, label, bucket FROM cut WHERE own UNION ALL SELECT row_id, refill.label, bucket FROM refill JOIN lack ON refill.label = lack.label AND k <= n",
    "dialogue_messages": f"WITH l AS (SELECT row_id, unnest(string_split(replace(content, '\\n', chr(10)), chr(10))) raw, generate_subscripts(string_split(replace(content, '\\n', chr(10)), chr(10)), 1) i FROM manifest), s AS (SELECT row_id, i, {_strip('raw')} trim_line FROM l), m AS (SELECT row_id, i, {_speakerless} AS content FROM s WHERE trim_line <> '') SELECT row_id, pos, CASE WHEN pos % 2 = 0 THEN 'user' ELSE 'assistant' END AS role, content FROM (SELECT *, (row_number() OVER (PARTITION BY row_id ORDER BY i) - 1)::INT pos FROM m WHERE content <> '')",
    "context_turns": f"SELECT row_id, array_to_string([replace(replace(s, 'user1:', 'Speaker 1:'), 'user2:', 'Speaker 2:') for s in [{_strip('x')} for x in string_split(content, '[UTT]')] if s <> ''], chr(10)) AS lines FROM manifest WHERE contains(content, '[UTT]')",
    "conversation_turns": f"WITH l AS (SELECT row_id, {_strip('raw')} line, i FROM (SELECT row_id, unnest(string_split(content, chr(10))) raw, generate_subscripts(string_split(content, chr(10)), 1) i FROM manifest WHERE content LIKE 'SPK%')), g AS (SELECT *, sum(regexp_matches(line, '{_SPK}')::INT) OVER (PARTITION BY row_id ORDER BY i) t FROM l WHERE line <> ''), j AS (SELECT row_id, t, string_agg(CASE WHEN regexp_matches(line, '{_SPK}') THEN 'Turn ' || t || CASE WHEN line LIKE 'SPK01%' THEN ' (Speaker 1): ' ELSE ' (Speaker 2): ' END || {_strip(_unspk)} ELSE line END, ' ' ORDER BY i) s FROM g WHERE t > 0 GROUP BY 1, 2) SELECT m.row_id, coalesce(string_agg(s, chr(10) ORDER BY t), '') turns FROM manifest m LEFT JOIN j ON m.row_id = j.row_id WHERE content LIKE 'SPK%' GROUP BY 1",
    "split_crosstab": "SELECT domain, count(*) FILTER (split = 'train') train, count(*) FILTER (split = 'val') val, count(*) FILTER (split = 'test') test, count(*) FILTER (split IS NULL) \"none\", count(*) total, round(count(*) FILTER (split = 'train') * 100.0e0 / count(*), 6) train_pct FROM stage1_entry GROUP BY 1",
    "merge_scores_long": f"SELECT * FROM (SELECT entry_id, unnest([{', '.join(repr(n) for n in ALL_DIMS)}]) dim, unnest([{', '.join('scores.' + n for n in ALL_DIMS)}]) score FROM stage1_entry) WHERE score IS NOT NULL",
    "normalize_scores": "WITH t AS (SELECT l_orderkey, l_linenumber, l_discount * l_quantity + l_tax - 0.5e0 x FROM lineitem), s AS (SELECT *, greatest(1, least(5, round_even(x, 0)))::INT score FROM t) SELECT l_orderkey, l_linenumber, score, format('{:.2f}', (score - 1) / 4.0e0)::DOUBLE from_five, format('{:.2f}', greatest(0.0e0, least(1.0e0, x)))::DOUBLE unit, format('{:.2f}', CASE WHEN x BETWEEN 0 AND 1 THEN x ELSE greatest(0.0e0, least(1.0e0, (x - 1) / 4.0e0)) END)::DOUBLE normalized FROM s",
    "stub_scores": f"SELECT entry_id, dim, (('0x' || substr(md5(dialogue_id || '|' || dim), 1, 4))::BIGINT % 101) / 100.0e0 score FROM (SELECT entry_id, dialogue_id, unnest([{', '.join(repr(n) for n in ALL_DIMS[:6])}]) dim FROM stage1_entry)",
    "stub_scores_all": f"SELECT entry_id, dim, (('0x' || substr(md5(dialogue_id || '|' || dim), 1, 4))::BIGINT % 101) / 100.0e0 score FROM (SELECT entry_id, dialogue_id, unnest([{', '.join(repr(n) for n in ALL_DIMS)}]) dim FROM stage1_entry)",
    "judge_parse_taxonomy": "SELECT entry_id, reason, CASE WHEN reason IS NULL THEN (entry_id % 5) / 4.0e0 END score FROM (SELECT entry_id, CASE WHEN entry_id % 11 = 0 THEN 'unknown_custom_id' WHEN entry_id % 8 = 6 THEN 'api_error' WHEN entry_id % 8 IN (4, 5, 7) THEN 'json_parse_error' END reason FROM stage1_entry WHERE domain = 'coherence')",
    "failure_breakdown": "SELECT reason, count(*) n, min('co-' || entry_id) first_id FROM (SELECT entry_id, CASE WHEN entry_id % 11 = 0 THEN 'unknown_custom_id' WHEN entry_id % 8 = 6 THEN 'api_error' WHEN entry_id % 8 IN (4, 5, 7) THEN 'json_parse_error' END reason FROM stage1_entry WHERE domain = 'coherence') WHERE reason IS NOT NULL GROUP BY 1",
    "missing_responses": "SELECT DISTINCT custom_id FROM manifest WHERE custom_id NOT IN (SELECT source_id FROM stage1_entry WHERE source_id IS NOT NULL)",
    "gold_enrich": f"WITH m AS (SELECT row_id, pid, ['HinderedBy', 'IsAfter', 'xAttr', 'xReact', 'oReact', 'xWant', 'oWant', 'xNeed'][row_id % 8 + 1] g FROM manifest WHERE pid IS NOT NULL), f AS (SELECT pid, first(g ORDER BY row_id) g FROM m WHERE pid <> '' GROUP BY 1) SELECT m.row_id, f.g gold_relation, CASE WHEN f.g IN ('HinderedBy', 'IsAfter') THEN 'cs_causality' WHEN f.g = 'xAttr' THEN 'cs_consistency' WHEN f.g IN ('xReact', 'oReact') THEN 'cs_reaction' WHEN f.g IN ('xWant', 'oWant') THEN 'cs_desire' WHEN f.g IS NOT NULL THEN '' END target_dimension FROM m LEFT JOIN f USING (pid)",
    "metadata_enrich": "WITH f AS (SELECT uid, last(coalesce(country_1, '') ORDER BY row_id) a, last(coalesce(country_2, '') ORDER BY row_id) b FROM manifest WHERE uid <> '' GROUP BY 1) SELECT row_id, a country_1, b country_2 FROM manifest LEFT JOIN f USING (uid)",
    "entry_validity": f"SELECT domain, count(*) n_valid FROM stage1_entry WHERE coalesce({', '.join('scores.' + n for n in ALL_DIMS)}) IS NOT NULL AND messages IS NOT NULL AND len([m for m in messages if coalesce(lower(m.role), '') NOT IN ('user', 'assistant')]) = 0 GROUP BY 1",
    "tier_distribution": f"WITH {_tiered.format(src='stage1_entry')} SELECT domain, tier, count(*) n FROM tiered GROUP BY ALL",
    "direction_split": f"WITH {_tiered.format(src='stage1_entry')} SELECT domain, direction, count(*) n, round(avg(a), 6) mean_avg FROM tiered GROUP BY ALL",
    "candidates": f"WITH {_cand.format(src='stage1_entry')} SELECT entry_id, custom_id, variant_type, direction, array_to_string(targets, ',') targets FROM cand",
    "turn_sample": f"WITH {_cand.format(src='stage1_entry')}, u AS (SELECT *, ('0x' || substr(md5(custom_id), 1, 8))::BIGINT / 4294967296.0e0 u FROM cand WHERE len(messages) >= 2), t AS (SELECT entry_id, custom_id, len(messages) k, least(CASE WHEN u < 0.15e0 THEN 1 WHEN u < 0.15e0 + 0.40e0 THEN 3 WHEN u < 0.15e0 + 0.40e0 + 0.30e0 THEN 5 ELSE 7 END, len(messages) - 1)::INT turn_count FROM u) SELECT entry_id, custom_id, turn_count, (k - turn_count)::INT n_prefix, turn_count n_rewritable FROM t",
    "shard_assignment": f"WITH {_first_entries}, {_cand.format(src='first_entries')} SELECT custom_id, 'stage2_gen_shard_' || lpad(((row_number() OVER (ORDER BY custom_id) - 1) // 500)::VARCHAR, 4, '0') shard FROM cand",
    "prefix_continuation": f"WITH {_first_entries}, {_variants}, j AS (SELECT variant_id, messages, len(variant_messages) n FROM v JOIN first_entries e ON v.candidate_id = e.dialogue_id) SELECT variant_id, {_said(_prefix('n'))} prefix_md5, {_said(_rest('n'))} continuation_md5 FROM j",
    "eval_requests": f"WITH {_first_entries}, {_variants} SELECT 's2v-' || variant_id custom_id, variant_id, domain, direction, len(list_filter({_all_scores}, lambda x: x IS NOT NULL))::INT n_scores, len({_prefix('len(variant_messages)')})::INT n_prefix FROM v JOIN first_entries e ON v.candidate_id = e.dialogue_id",
    "latest_results": f"WITH {_results} SELECT variant_id, label, round(coalesce(list_sum(list_sort(map_values(variant_scores))), 0), 6) score_sum FROM r",
    "pair_difficulty": f"WITH {_dpairs} SELECT metadata.domain AS domain, metadata.difficulty AS difficulty, count(*) n FROM p GROUP BY ALL",
    "score_shift": f"WITH {_pair_scores}, d AS (SELECT domain, o, v, unnest([x for x in decision if o[x] IS NOT NULL AND v[x] IS NOT NULL]) dim FROM ps) SELECT domain, dim, count(*) n, round(avg(o[dim]), 6) avg_original, round(avg(v[dim]), 6) avg_variant, round(avg(v[dim]) - avg(o[dim]), 6) shift FROM d GROUP BY ALL",
    "direction_distribution": f"WITH {_pair_scores}, d AS (SELECT domain, (direction = 'positive') = followed variant FROM ps) SELECT domain, count(*) FILTER (variant) variant_chosen, count(*) FILTER (NOT variant) original_chosen, count(*) total, round(count(*) FILTER (variant) * 100.0e0 / count(*), 6) variant_pct FROM d GROUP BY 1",
    "variant_type_breakdown": f"WITH {_pair_scores} SELECT domain, count(*) FILTER (scope = 'global' AND direction = 'positive') global_improve, count(*) FILTER (scope = 'global' AND direction = 'negative') global_degrade, count(*) FILTER (scope <> 'global') dimension_targeted, count(*) total FROM ps GROUP BY 1",
    "margin_sensitivity": f"WITH {_pair_scores}, d AS (SELECT domain, [c[x] - j[x] for x in decision if c[x] IS NOT NULL AND j[x] IS NOT NULL] m FROM ps), g AS (SELECT domain, list_reduce(list_prepend(0.0e0, m), lambda a, b: a + b) / len(m) margin FROM d WHERE len(m) > 0) SELECT domain, threshold, count(*) FILTER (margin <= threshold) lost, count(*) total FROM g, (SELECT unnest([0.05e0, 0.10e0, 0.15e0, 0.20e0, 0.25e0, 0.30e0, 0.40e0, 0.50e0, 0.60e0]) threshold) GROUP BY ALL",
    "label_rollup": f"WITH {_pair_scores} SELECT domain, label, count(*) n FROM ps GROUP BY GROUPING SETS ((domain, label), (label), ())",
}

_split_sql = f"""WITH c AS (SELECT domain, count(*)::DOUBLE n, list_position(['coherence', 'empathy', 'commonsense', 'multicultural'], domain) ord FROM stage1_entry GROUP BY 1),
tot AS (SELECT sum(n) n, ceil(0.15e0 * sum(n)) n_test, ceil(0.10e0 / (1.0e0 - 0.15e0) * (sum(n) - ceil(0.15e0 * sum(n)))) n_val FROM c),
f1 AS (SELECT c.*, (tot.n - n_test) k, (tot.n - n_test - n_val) k2, floor((tot.n - n_test) * c.n / tot.n) lo, (tot.n - n_test) * c.n / tot.n ex, tot.n - n_test m FROM c, tot),
t1 AS (SELECT *, lo + CASE WHEN row_number() OVER (ORDER BY lo - ex, ord) <= k - sum(lo) OVER () THEN 1 ELSE 0 END trainval FROM f1),
f2 AS (SELECT *, floor(k2 * trainval / m) lo2, k2 * trainval / m ex2 FROM t1),
q AS (SELECT *, n - trainval q_test, lo2 + CASE WHEN row_number() OVER (ORDER BY lo2 - ex2, ord) <= k2 - sum(lo2) OVER () THEN 1 ELSE 0 END q_train FROM f2),
a AS (SELECT entry_id, e.domain, CASE WHEN rk <= q_test THEN 'test' WHEN rk <= q_test + trainval - q_train THEN 'val' ELSE 'train' END split FROM (SELECT entry_id, domain, row_number() OVER (PARTITION BY domain ORDER BY md5('42|' || entry_id), entry_id) rk FROM stage1_entry) e JOIN q USING (domain))"""
ORACLES["split_assign"] = f"{_split_sql} SELECT entry_id, domain, split FROM a"
ORACLES["split_counts"] = f"{_split_sql} SELECT domain, split, count(*) n FROM a GROUP BY ALL"

_dual_sql = """WITH e AS (SELECT entry_id, 'cs-' || entry_id base, (entry_id % 101) / 100.0e0 v, entry_id::VARCHAR LIKE '1%' AS late FROM stage1_entry WHERE domain = 'commonsense'),
o AS (SELECT *, CASE WHEN entry_id % 7 = 0 THEN 'missing_from_batch' WHEN late THEN 'json_parse_error' WHEN entry_id % 5 = 0 THEN 'api_error' WHEN entry_id % 3 = 0 THEN 'incomplete_merge' END reason, CASE WHEN entry_id % 7 = 0 OR late THEN base || '-dim' WHEN entry_id % 5 = 0 THEN base || '-dlg' WHEN entry_id % 3 = 0 THEN base END failed_id FROM e)"""
ORACLES["dual_prompt_merge"] = f"{_dual_sql} SELECT entry_id, failed_id, reason, CASE WHEN reason IS NULL THEN round(6 * v, 6) END total FROM o"
ORACLES["retry_set"] = f"{_dual_sql} SELECT DISTINCT unnest(CASE WHEN failed_id = base THEN [base || '-dim', base || '-dlg'] ELSE [failed_id] END) custom_id FROM o WHERE reason IS NOT NULL"

_moved = lambda dims: f"sgn * ({_mean('variant_scores', dims)} - {_mean('original_scores', dims)})"
_labels = f"""{_first_entries}, {_variants}, {_results}, j AS (SELECT v.*, r.original_scores, r.variant_scores, e.domain, {_chars} chars, CASE direction WHEN 'positive' THEN 1.0e0 ELSE -1.0e0 END sgn FROM v JOIN r USING (variant_id) JOIN first_entries e ON v.candidate_id = e.dialogue_id),
k AS (SELECT *, {_moved('chars')} g, {_moved('target_dimensions')} t, len([d for d in chars if NOT list_contains(target_dimensions, d) AND original_scores[d] IS NOT NULL AND variant_scores[d] IS NOT NULL AND abs(variant_scores[d] - original_scores[d]) > 0.2e0]) > 0 AS coarse FROM j),
labelled AS (SELECT variant_id, domain, CASE WHEN variant_type = 'global' THEN CASE WHEN g > 0.05e0 THEN 'global_pass' WHEN g < -0.05e0 THEN 'global_flip_pass' ELSE 'reject' END WHEN len(target_dimensions) > 0 THEN CASE WHEN t < -0.05e0 THEN 'target_flip_pass' WHEN t > 0.05e0 THEN CASE WHEN coarse THEN 'target_coarse_pass' ELSE 'target_pass' END ELSE 'reject' END ELSE 'reject' END label FROM k)"""
ORACLES["eval_labels"] = f"WITH {_labels} SELECT variant_id, domain, label FROM labelled"
ORACLES["label_distribution"] = f"WITH {_labels} SELECT domain, {', '.join(f'count(*) FILTER (label = {x!r}) {x}' for x in ('global_pass', 'global_flip_pass', 'target_pass', 'target_coarse_pass', 'target_flip_pass', 'reject'))}, count(*) total, round((count(*) - count(*) FILTER (label = 'reject')) * 100.0e0 / count(*), 6) usable_pct FROM labelled GROUP BY 1"
_outcomes = f"""{_first_entries}, {_variants}, {_results}, j AS (SELECT v.*, r.variant_id IS NOT NULL AND label IS NOT NULL has, label, original_scores, variant_scores, e.dialogue_id, e.domain, e.messages, (direction = 'positive') <> (label IN ('global_flip_pass', 'target_flip_pass')) up, {_effective} dims FROM v LEFT JOIN r ON v.variant_id = r.variant_id LEFT JOIN first_entries e ON v.candidate_id = e.dialogue_id),
k AS (SELECT *, {_mean('original_scores', 'dims')} mo, {_mean('variant_scores', 'dims')} mv, len(variant_messages) n FROM j),
o AS (SELECT *, CASE WHEN NOT has THEN 'no_result' WHEN label = 'reject' THEN 'rejected' WHEN dialogue_id IS NULL THEN 'no_original' WHEN NOT coalesce(CASE WHEN up THEN mv > mo ELSE mo > mv END, false) THEN 'bad_ordering' ELSE 'pair' END outcome FROM k)"""
_pairs_sql = f"{_outcomes}, made AS (SELECT 'S2D-' || lpad((row_number() OVER (ORDER BY variant_id))::VARCHAR, 6, '0') pair_id, *, CASE WHEN coalesce(abs(mv - mo), 0) >= 0.30e0 THEN 'easy' WHEN coalesce(abs(mv - mo), 0) >= 0.15e0 THEN 'medium' ELSE 'hard' END difficulty FROM o WHERE outcome = 'pair')"
ORACLES["pair_outcomes"] = f"WITH {_outcomes} SELECT outcome, count(*) n FROM o GROUP BY 1"
ORACLES["pairs"] = f"WITH {_pairs_sql} SELECT pair_id, variant_id, candidate_id source_dialogue_id, domain, difficulty, CASE variant_type WHEN 'global' THEN 'global' ELSE 'target' END scope, label decision, label NOT IN ('global_flip_pass', 'target_flip_pass') intent_followed, CASE WHEN up THEN 'stage_2' ELSE 'stage_1' END chosen_source, {_said(_prefix('n'))} prompt_md5, {_said(f'CASE WHEN up THEN variant_messages ELSE ({_rest(chr(110))}) END')} chosen_md5, {_said(f'CASE WHEN up THEN ({_rest(chr(110))}) ELSE variant_messages END')} rejected_md5 FROM made"
ORACLES["flagship"] = f"WITH {_pairs_sql} SELECT domain, label, difficulty, count(*) n FROM made GROUP BY ALL"

# --- prompts, put together in SQL

_q = lambda t: "'" + t.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
_said_by = lambda x: f"array_to_string([CASE WHEN lower(m.role) = 'user' THEN 'User: ' ELSE 'Assistant: ' END || coalesce(m.content, '') for m in {x}], chr(10))"
_anchors = "0.0 not at all, 0.25 a little, 0.5 in part, 0.75 largely, 1.0 fully"
_by_domain = lambda of: "CASE domain " + " ".join(f"WHEN '{n}' THEN {of(d)}" for n, d in DOMAINS.items()) + " END"
_described = "CASE d " + " ".join(f"WHEN '{n}' THEN {_q(DESCRIPTIONS[x])}" for d in DOMAINS.values() for n, x in zip(d.names, d.dims)) + " END"
_culture = "CASE WHEN domain = 'multicultural' AND len([k for k in map_keys(domain_metadata) if trim(domain_metadata[k]) <> '']) > 0 THEN chr(10) || 'CULTURAL CONTEXT:' || chr(10) || array_to_string(['- ' || k || ': ' || domain_metadata[k] for k in list_sort([k for k in map_keys(domain_metadata) if trim(domain_metadata[k]) <> ''])], chr(10)) || chr(10) ELSE '' END"
_numbered = lambda d: "\n".join(f"{i}. {x}: {DESCRIPTIONS[x]}?" for i, x in enumerate(d.dims[:-1], 1))
_shape = lambda d: ", ".join(f'"{x}": {{"reasoning": "...", "score": 1-5}}' for x in d.dims[:-1]) + f', "{d.dims[-1]}": 1-5'
_judge = lambda name: f"""{_q("Judge the dialogue below." + chr(10) * 2 + "DIALOGUE:" + chr(10))} || content || {_q(chr(10) * 2 + "QUESTIONS:" + chr(10) + _numbered(DOMAINS[name]) + chr(10) * 2 + "Answer as JSON only: {" + _shape(DOMAINS[name]) + "}")}"""
ORACLES["judge_prompts"] = f"SELECT row_id, custom_id, CASE WHEN custom_id LIKE 'co-%' THEN {_judge('coherence')} ELSE {_judge('empathy')} END prompt FROM manifest WHERE (custom_id LIKE 'co-%' OR custom_id LIKE 'em-%') AND trim(content) <> ''"
_or_absent = lambda c: f"coalesce(nullif(trim({c}), ''), '(not available)')"
_unit_shape = lambda names: ", ".join(f'"{n}": 0.0-1.0' for n in names)
_nl = "\n"
ORACLES["multicultural_prompts"] = f"""WITH t AS ({ORACLES['conversation_turns']}) SELECT row_id, {_q(f"Judge the conversation between speakers of two cultures.{_nl}{_nl}COUNTRIES: ")} || {_or_absent('country_1')} || ', ' || {_or_absent('country_2')} || {_q(f"{_nl}STATEMENT: ")} || custom_id || {_q(f"{_nl}{_nl}TURNS:{_nl}")} || turns || {_q(f"{_nl}{_nl}SCALE: {_anchors}{_nl}Answer as JSON only: {{{_unit_shape(DOMAINS['multicultural'].names)}}}")} prompt FROM manifest JOIN t USING (row_id) WHERE trim(custom_id) <> '' AND turns <> ''"""
_cs_head = f"""{_q(f"Judge the last utterance in its context.{_nl}{_nl}CONTEXT:{_nl}")} || lines || {_q(f"{_nl}{_nl}TARGET: ")} || custom_id"""
_cs_ask = lambda dims: _q(f"{_nl}{_nl}SCALE: {_anchors}{_nl}Answer as JSON only: {{{_unit_shape(['cs_' + x for x in dims])}}}")
_cs_refs = f" || {_q(_nl)} || ".join(f"{_q(f'- {r}: ')} || " + (_or_absent("label") if r == "xWant" else "'(not available)'") for r in RELATIONS[:-1])
ORACLES["commonsense_prompts"] = f"""WITH t AS ({ORACLES['context_turns']}), j AS (SELECT m.row_id, custom_id, label, lines FROM manifest m JOIN t USING (row_id) WHERE custom_id <> '') SELECT row_id, 'dim' part, {_cs_head} || {_q(f"{_nl}{_nl}REFERENCES:{_nl}")} || {_cs_refs} || {_cs_ask(DOMAINS['commonsense'].dims[:4])} prompt FROM j UNION ALL SELECT row_id, 'dlg', {_cs_head} || {_cs_ask(DOMAINS['commonsense'].dims[4:])} FROM j"""
_rubric = lambda dims: f"coalesce(nullif(array_to_string(['- ' || d || ': ' || {_described} for d in {dims}], chr(10)), ''), '(no dimensions)')"
ORACLES["evaluation_prompts"] = f"""WITH {_first_entries}, {_variants} SELECT 's2v-' || variant_id custom_id, {_q(f"Score the continuation.{_nl}{_nl}CONVERSATION SO FAR:{_nl}")} || {_said_by(_prefix('len(variant_messages)'))} || {_q(f"{_nl}{_nl}CONTINUATION:{_nl}")} || {_said_by('variant_messages')} || {_q(f"{_nl}{_nl}DIMENSIONS:{_nl}")} || {_rubric(_names)} || {_culture} || {_q(f'{_nl}{_nl}SCALE: {_anchors}{_nl}Answer as JSON only: {{"scores": {{dimension: number}}}}')} prompt FROM v JOIN first_entries e ON v.candidate_id = e.dialogue_id"""
_wanted = "CASE direction WHEN 'positive' THEN CASE WHEN x <= 0.3e0 THEN 'a substantial improvement' WHEN x <= 0.6e0 THEN 'a clear improvement' ELSE 'a subtle improvement' END ELSE CASE WHEN x >= 0.7e0 THEN 'a substantial decline' WHEN x >= 0.4e0 THEN 'a clear decline' ELSE 'a minimal decline' END END"
_pairs_of = "list_filter(list_zip(chars, char_scores), lambda p: p[2] IS NOT NULL AND list_contains(targets, p[1]))"
_hint = "CASE direction WHEN 'positive' THEN 'make it plainer than it is, by what is said and not by telling it: ' ELSE 'let it fall off without a remark on it: ' END"
_valid = f"coalesce({', '.join('scores.' + n for n in ALL_DIMS)}) IS NOT NULL AND messages IS NOT NULL AND len([m for m in messages if coalesce(lower(m.role), '') NOT IN ('user', 'assistant')]) = 0"
_task = "CASE variant_type WHEN 'global_improve' THEN 'Rewrite the continuation so that it is better in every listed dimension.' WHEN 'global_degrade' THEN 'Rewrite the continuation so that it is worse in every listed dimension, and still natural.' ELSE CASE direction WHEN 'positive' THEN 'Rewrite the continuation so that it is better in the target dimension alone.' ELSE 'Rewrite the continuation so that it is worse in the target dimension alone. Be subtle: no rudeness, no obvious mistakes.' END END"
_keep = "[x for x in CASE WHEN variant_type = 'dimension_targeted' THEN chars ELSE all_names END if NOT list_contains(targets, x)]"
ORACLES["generation_prompts"] = f"""WITH good AS (SELECT * FROM stage1_entry WHERE {_valid}), {_cand.format(src='good')}, u AS (SELECT *, ('0x' || substr(md5(custom_id), 1, 8))::BIGINT / 4294967296.0e0 u FROM cand WHERE len(messages) >= 2),
t AS (SELECT c.entry_id, c.custom_id, c.messages, c.direction, c.variant_type, c.targets, domain, domain_metadata, {_chars} chars, {_names} all_names, {_char_scores} char_scores, least(CASE WHEN u < 0.15e0 THEN 1 WHEN u < 0.15e0 + 0.40e0 THEN 3 WHEN u < 0.15e0 + 0.40e0 + 0.30e0 THEN 5 ELSE 7 END, len(c.messages) - 1)::INT n FROM u c JOIN good USING (entry_id))
SELECT entry_id, custom_id, {_task} || {_q(f"{_nl}{_nl}CONVERSATION SO FAR:{_nl}")} || {_said_by(_prefix('n'))} || {_q(f"{_nl}{_nl}CONTINUATION:{_nl}")} || {_said_by('messages[len(messages) - n + 1:len(messages)]')} || {_q(f"{_nl}{_nl}DIMENSIONS:{_nl}")} || {_rubric('targets')} || {_q(f"{_nl}{_nl}SCORES:{_nl}")}
|| array_to_string(['- ' || p[1] || ': now ' || format('{{:.2f}}', p[2]) || ', wanted: ' || {_wanted.replace('x <=', 'p[2] <=').replace('x >=', 'p[2] >=')} for p in {_pairs_of}], chr(10))
|| {_q(f"{_nl}{_nl}GUIDANCE:{_nl}")} || array_to_string(['- ' || d || ': ' || {_hint} || {_described} for d in targets], chr(10)) || chr(10)
|| CASE WHEN len({_keep}) > 0 AND (variant_type = 'dimension_targeted' OR variant_type = 'global_degrade') THEN {_q(f"{_nl}LEAVE AS THEY ARE:{_nl}")} || array_to_string(['- ' || x for x in {_keep}], chr(10)) || chr(10) ELSE '' END || {_culture}
|| {_q(f"{_nl}INSTRUCTIONS:{_nl}Write ")} || n || ' messages. Answer as JSON only: {{"continuation": [{{"role": "user|assistant", "content": "..."}}]}}' prompt FROM t"""
ORACLES["turn_bucket_sample"] = f"""WITH lab AS (SELECT row_id, content FROM manifest), pool AS (SELECT *, {_bucket('turns')} bucket FROM (SELECT *, {_turns('content')} turns FROM (SELECT *, CASE WHEN length(content) > 0 THEN md5({_strip('content')}) END fingerprint, row_number() OVER (PARTITION BY md5({_strip('content')}) ORDER BY row_id) rn FROM lab) WHERE rn = 1 OR coalesce(length(content), 0) = 0)),
plan(bucket, ord, base) AS (VALUES ('2-6', 0, floor({SAMPLE_TARGET} * 0.25e0)::BIGINT), ('7-10', 1, floor({SAMPLE_TARGET} * 0.30e0)::BIGINT), ('11-16', 2, floor({SAMPLE_TARGET} * 0.30e0)::BIGINT), ('17-999', 3, floor({SAMPLE_TARGET} * 0.15e0)::BIGINT)),
have AS (SELECT plan.*, coalesce(n, 0) available FROM plan LEFT JOIN (SELECT bucket, count(*) n FROM pool GROUP BY 1) USING (bucket)),
quotas AS (SELECT bucket, available, base + CASE WHEN row_number() OVER (ORDER BY available DESC, ord) = 1 THEN {SAMPLE_TARGET} - sum(base) OVER () ELSE 0 END needed FROM have),
ranked AS (SELECT pool.*, row_number() OVER (PARTITION BY bucket ORDER BY CASE WHEN fingerprint IS NULL THEN md5('42') ELSE md5('42|' || fingerprint) END) rk FROM pool), cut AS (SELECT ranked.*, rk <= least(needed, available) own FROM ranked JOIN quotas USING (bucket)),
refill AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || fingerprint)) k FROM cut WHERE NOT own) SELECT row_id, bucket FROM cut WHERE own UNION ALL SELECT row_id, bucket FROM refill WHERE k <= (SELECT sum(needed - least(needed, available)) FROM quotas)"""
