"""The pipeline's steps over folders of one root, and their command line: python -m parlance STEP --root DIR."""

from __future__ import annotations

import argparse
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.dims import BUCKET_WEIGHTS, DOMAINS, LABEL_SHARES, SAMPLE_SIZE, SPLIT_SHARES, char_names_of
from parlance.functions.replies import continuation, evaluation_scores, scored, scored_lines
from parlance.operators import analytics, contrast, judged, merge, quota, shards
from parlance.operators.rows import first_rows, last_wins
from parlance.session import materialize, release
from parlance.sources import readers, writers

from . import prepare as prepare_domain
from . import prompts, report
from .judge import JudgeBackend, StubJudge


def prepare(spark: SparkSession, root: str, domain: str, limit: int | None = None, target: int = SAMPLE_SIZE) -> prepare_domain.Prepared:
    """Requests of a domain's raw files under raw/, written with their manifest.

    Of coherence and empathy ``target`` dialogues are sampled, by label and turn bucket and by turn bucket; all of the others.
    """
    raw = f"{root}/raw/{domain}"
    if domain == "coherence":
        items = quota.stratified_sample(readers.coherence(spark, raw), "content", "label", ["ord"], target, LABEL_SHARES, BUCKET_WEIGHTS["coherence"])
        made = prepare_domain.whole_number_domain(domain, items, limit)
    elif domain == "empathy":
        items = quota.turn_sample(readers.empathy(spark, raw), "content", ["ord"], target, BUCKET_WEIGHTS["empathy"])
        made = prepare_domain.whole_number_domain(domain, items, limit)
    elif domain == "commonsense":
        made = prepare_domain.commonsense(readers.commonsense(spark, raw), ["PID", "CTX", "SEG"], limit)
    else:
        made = prepare_domain.multicultural(readers.multicultural(spark, raw), ["source_file", "uid", "conversation"], limit)
    lines = made.requests.select("custom_id", writers.envelope(F.col("custom_id"), F.col("prompt")).alias("line"))
    writers.request_shards(shards.sharded(lines, ["custom_id"], DOMAINS[domain].prefix), f"{root}/requests/{domain}")
    writers.manifest(made.manifest, f"{root}/manifest/{domain}")
    return made


def attempts(spark: SparkSession, root: str, name: str) -> list[str]:
    """Folders of retries' replies, retries/NAME/1 and on, as far as they are there without a gap."""
    found: list[str] = []
    while readers.there(spark, path := f"{root}/retries/{name}/{len(found) + 1}"):
        found.append(path)
    return found


def replies_of(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One reply of each id: the last line of the latest attempt that has the id."""
    own = lambda path: last_wins(readers.replies(spark, path), ["custom_id"], ["file", "line_no"])
    return judged.with_retries(own(f"{root}/replies/{name}"), *map(own, attempts(spark, root, name)))


def parse(spark: SparkSession, root: str, domain: str) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, with scores on the scale of 0 to 1 as object, and failures of a domain's replies."""
    replies = replies_of(spark, root, domain)
    manifest = readers.manifest(spark, f"{root}/manifest/{domain}")
    if domain == "commonsense":
        out = judged.dual_outcomes(replies, manifest, ["file", "line_no"])
        names = DOMAINS[domain].names
        good = out.filter("reason is null").withColumn("object", F.to_json(F.struct(*names)))
        good = good.withColumn("fields", F.regexp_replace(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), r"^\{|\}$", ""))
        return good, out.filter("reason is not null").select(F.col("failed_id").alias("custom_id"), "reason")
    out = judged.taxonomy(replies, manifest)
    out = out.withColumn("fields", scored_lines(F.col("object"), DOMAINS[domain])).withColumn("object", F.when(F.col("object").isNotNull(), F.to_json(F.struct(*scored(F.col("object"), DOMAINS[domain])))))
    lost = judged.missing(replies, manifest).select("custom_id", F.lit("missing_from_batch").alias("reason"))
    return out.filter("reason is null"), out.filter("reason is not null").select("custom_id", "reason").unionByName(lost)


def write_parsed(spark: SparkSession, root: str, domain: str) -> tuple[int, int]:
    """Writes a domain's parsed results over results/DOMAIN/PREFIX_results_N.jsonl: _id, what the manifest has, and the scores. Gives how many there are, and how many failures."""
    good, failed = parse(spark, root, domain)
    known = [c for c in ("content", "label", "pid", "uid", "country_1", "country_2", "source_file") if c in good.columns]
    head = F.regexp_replace(F.to_json(F.struct(F.col("custom_id").alias("_id"), *known)), r"\}$", "")
    lines = materialize(good.select(F.concat(head, F.lit(","), F.col("fields"), F.lit("}")).alias("line")), "parsed")
    writers.named_lines(lines, f"{root}/results/{domain}", f"{DOMAINS[domain].prefix}_results")
    return lines.count(), failed.count()


def failures(spark: SparkSession, root: str, domains: list[str]) -> DataFrame:
    """(domain, custom_id, reason) of the domains' replies that are no use."""
    parts = [parse(spark, root, d)[1].select(F.lit(d).alias("domain"), "custom_id", "reason") for d in domains]
    return materialize(reduce(DataFrame.unionByName, parts), "failures")


def retry(spark: SparkSession, root: str, domain: str, failed: DataFrame) -> tuple[int, int]:
    """Writes the requests to send again for a domain's failures to requests/retry/DOMAIN/K, whose replies belong to retries/DOMAIN/K.

    Gives how many requests these are, and how many failed ids have none.
    """
    own = failed.filter(F.col("domain") == domain).select("custom_id", "reason")
    requests = readers.request_lines(spark, f"{root}/requests/{domain}/*")
    again = materialize(judged.retry_set(own, requests), "retry")
    n = again.count()
    if n:
        k = len(attempts(spark, root, domain)) + 1
        name = F.concat(F.lit(f"{DOMAINS[domain].prefix}_retry_{k}_shard_"), F.when(F.col("shard") < 10_000, F.lpad(F.col("shard").cast("string"), 4, "0")).otherwise(F.col("shard").cast("string")))
        writers.request_shards(shards.shards_by_size(again, "line", ["custom_id"]).withColumn("shard", name), f"{root}/requests/retry/{domain}/{k}")
    return n, judged.lost_for_retry(own, requests).count()


def merged(spark: SparkSession, root: str, metadata: DataFrame | None = None, gold: DataFrame | None = None) -> DataFrame:
    """All domains' entries with their new splits."""
    parts = {}
    for name in DOMAINS:
        good, _ = parse(spark, root, name)
        lookup, key = {"multicultural": (metadata, "uid"), "commonsense": (gold, "pid")}.get(name, (None, None))
        good = merge.enrich(good, lookup, key) if lookup is not None else good.withColumn("domain_metadata", F.lit(None).cast("map<string,string>"))
        parts[name] = good.withColumn("source_id", F.col("custom_id"))
    entries = merge.merge_domains(parts)
    return quota.assign_splits(entries, "domain", "dialogue_id", list(DOMAINS), SPLIT_SHARES)


def lookups(spark: SparkSession, root: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Metadata by uid of raw/multicultural/*.csv and gold by pid of raw/gold.json; None, with a warning, for one whose files aren't there."""
    metadata = gold = None
    if readers.there(spark, f"{root}/raw/multicultural/*.csv"):
        rows = readers.multicultural(spark, f"{root}/raw/multicultural")
        rows = rows.withColumns({"file": F.concat("source_file", F.lit(".csv")), "line_no": F.monotonically_increasing_id()} | {f: F.lit("") for f in merge.METADATA_FIELDS if f not in rows.columns})
        metadata = merge.metadata_by_uid(rows, ["file", "line_no"])
    else:
        warnings.warn(f"no {root}/raw/multicultural/*.csv: multicultural entries have no metadata", stacklevel=2)
    if readers.there(spark, f"{root}/raw/gold.json"):
        gold = merge.gold_by_pid(readers.gold(spark, f"{root}/raw/gold.json").filter("length(gold) > 0"), ["ord"])
    else:
        warnings.warn(f"no {root}/raw/gold.json: commonsense entries have no metadata", stacklevel=2)
    return metadata, gold


def generation_requests(entries: DataFrame, domain: str | None = None) -> DataFrame:
    rows = prompts.generation_prompt(contrast.requests(contrast.candidates(contrast.valid_entries(entries), domain)))
    return rows.withColumn("line", writers.envelope(F.col("custom_id"), F.col("prompt")))


def variants(replies: DataFrame, manifest: DataFrame, model: str = "judge") -> DataFrame:
    """Variants of generated replies to known ids; replies that don't parse are left out."""
    known = last_wins(manifest, ["custom_id"], ["dialogue_id"])
    out = replies.join(known, "custom_id").withColumn("variant_messages", continuation(F.col("reply"))).filter("variant_messages is not null")
    return out.select(F.col("dialogue_id").alias("candidate_id"), F.concat(F.lit("var-"), "custom_id").alias("variant_id"), F.when(F.col("variant_type") == "dimension_targeted", "targeted").otherwise("global").alias("variant_type"), "direction", "target_dimensions", "variant_messages", F.lit(model).alias("generation_model"))


#: What the manifest of evaluation requests holds.
EVALUATION = "custom_id string, variant_id string, candidate_id string, domain string, direction string, variant_type string, target_dimensions array<string>, stage_1_scores map<string,double>"


def evaluated(requests: DataFrame, replies: DataFrame, margin: float = contrast.MARGIN) -> DataFrame:
    """Results of evaluation replies, labelled; a score must move by more than ``margin``."""
    rows = requests.join(replies, "custom_id").withColumn("variant_scores", evaluation_scores(F.col("reply"))).filter("variant_scores is not null")
    label = contrast.label(F.col("stage_1_scores"), F.col("variant_scores"), F.col("direction"), F.col("variant_type"), char_names_of(F.col("domain")), F.col("target_dimensions"), margin)
    return rows.select("variant_id", F.col("stage_1_scores").alias("original_scores"), "variant_scores", label.alias("label"))


def refused_replies(replies: DataFrame, manifest: DataFrame, usable: Column) -> DataFrame:
    """(custom_id, reason) of generation or evaluation replies that are no use: to unknown ids, with an error, or not of the shape asked for, and of ids without a reply."""
    known = manifest.select("custom_id").distinct().withColumn("__known", F.lit(True))
    rows = replies.join(known, "custom_id", "left")
    reason = F.when(F.col("__known").isNull(), "unknown_custom_id").when(F.col("status_code") != 200, "api_error").when(~usable, "json_parse_error")
    lost = judged.missing(replies, known.select("custom_id")).select("custom_id", F.lit("missing_from_batch").alias("reason"))
    return rows.select("custom_id", reason.alias("reason")).filter("reason is not null").unionByName(lost)


def answer_by_stub(spark: SparkSession, root: str, name: str) -> None:
    """Replies of the stub judge to requests/NAME, where a batch service's replies would be: scores for judging, a marked echo for generation."""
    ids = readers.request_lines(spark, f"{root}/requests/{name}/*").select("custom_id")
    if name == "generation":
        message = F.struct(F.lit("assistant").alias("role"), F.concat(F.lit("A rewritten line for "), F.col("custom_id"), F.lit(".")).alias("content"))
        reply = F.to_json(F.struct(F.array(message).alias("continuation")))
    elif name == "evaluation":
        asked = readers.manifest_rows(spark, f"{root}/manifest/evaluation", EVALUATION)
        ids = ids.join(asked.select("custom_id", "domain"), "custom_id")
        reply = StubJudge().scores(F.lit("scores"))
    else:
        ids = ids.withColumn("domain", F.lit(name))
        reply = StubJudge().scores(None)
    body = F.struct(F.lit("stub").alias("model"), F.array(F.struct(F.struct(reply.alias("content")).alias("message"))).alias("choices"))
    line = F.to_json(F.struct("custom_id", F.struct(F.lit(200).alias("status_code"), body.alias("body")).alias("response"), F.lit(None).cast("string").alias("error")))
    writers.named_lines(ids.select(line.alias("line")), f"{root}/replies/{name}", "batch")


def evaluate(variants: DataFrame, entries: DataFrame, backend: JudgeBackend | None = None) -> DataFrame:
    """Results of a backend's evaluation of all variants."""
    requests = prompts.evaluation_prompt(contrast.evaluations(variants, entries))
    return evaluated(requests, (backend or StubJudge()).answer(requests.select("custom_id", "prompt", "domain")))


STEPS = ("prepare", "run", "parse", "retry", "merge", "split", "select", "generate", "evaluate", "pairs", "analyze", "render", "all")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="parlance", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True)
    parser.add_argument("--domain", choices=tuple(DOMAINS))
    parser.add_argument("--max-samples", type=int, help="rows of each domain to prepare, or of all to select, at most")
    parser.add_argument("--margin-threshold", type=float, default=contrast.MARGIN, help="by how much scores must move for a label but reject")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.step == "all":  # offline: the stub judge answers
        for step, of in (("prepare", None), ("run", "judging"), ("parse", None), ("retry", None), ("merge", None), ("select", None), ("generate", None), ("run", "generation"), ("evaluate", None), ("run", "evaluation"), ("pairs", None), ("analyze", None)):
            take_step(spark, step, args, of)
            release(spark)
    else:
        take_step(spark, args.step, args)
        release(spark)


def take_step(spark: SparkSession, step: str, args: argparse.Namespace, of: str | None = None) -> None:
    """One step of the pipeline over the folders of ``args.root``."""
    root, names = args.root, [args.domain] if args.domain else list(DOMAINS)
    if step == "prepare":
        for name in names:
            print(name, report.markdown(prepare(spark, root, name, args.max_samples).summary), sep="\n")
    elif step == "run":
        asked = {None: [*names, "generation", "evaluation"], "judging": names}.get(of, [of])
        for name in asked:
            if readers.there(spark, f"{root}/requests/{name}/*") and not readers.there(spark, f"{root}/replies/{name}/*"):
                answer_by_stub(spark, root, name)
    elif step == "parse":
        for name in names:
            print(name, "{} parsed, {} failed".format(*write_parsed(spark, root, name)))
    elif step == "retry":
        failed = failures(spark, root, names)
        if judged.within_holdout(failed):
            writers.json_lines(failed, f"{root}/holdout", mode="overwrite")
            print(f"{failed.count()} failures, held out: no retry")
            return
        for name in names:
            print(name, "{} requests to send again, {} failed ids without a request".format(*retry(spark, root, name, failed)))
    elif step == "merge":
        failed = failures(spark, root, list(DOMAINS))
        writers.json_lines(failed, f"{root}/failures")
        print(report.markdown(judged.failure_breakdown(failed)))
        if not judged.within_holdout(failed):
            warnings.warn(f"more than {judged.HOLDOUT_LIMIT} failures: see {root}/failures and the retry step", stacklevel=2)
        writers.json_lines(merged(spark, root, *lookups(spark, root)), f"{root}/entries")
    elif step == "analyze":
        pairs = readers.pairs(spark, f"{root}/pairs")
        for summary in (analytics.score_shift, analytics.direction_distribution, analytics.variant_types, analytics.margin_sensitivity, analytics.label_rollup):
            print(summary.__name__, report.markdown(summary(pairs)), sep="\n")
    elif step == "render":
        for r in prompts.rendered(spark).orderBy("ord").collect():  # 32 prompts of a made-up dialogue
            print("=" * 80, f"{r['ord']}: {r['domain']} {r['kind']}", r["prompt"], sep="\n")
    else:
        _second_stage(spark, step, args)


def _second_stage(spark: SparkSession, step: str, args: argparse.Namespace) -> None:
    root = args.root
    entries = readers.entries(spark, f"{root}/entries")
    if step == "split":
        again = materialize(quota.assign_splits(entries, "domain", "dialogue_id", list(DOMAINS), SPLIT_SHARES), "split")
        writers.json_lines(again, f"{root}/entries", mode="overwrite")  # its rows are in the scratch folder
        print(report.markdown(again.groupBy("domain", "split").count().orderBy("domain", "split")))
    elif step == "select":
        chosen = contrast.candidates(contrast.valid_entries(first_rows(entries, ["dialogue_id"], args.max_samples)), args.domain)
        writers.json_lines(chosen, f"{root}/candidates")
        print(report.glimpse(chosen.select("custom_id", "domain", "variant_type", "direction")))
    elif step == "generate":
        rows = generation_requests(entries, args.domain)
        writers.request_shards(shards.sharded(rows.select("custom_id", "line"), ["custom_id"], "stage2_gen", first=0), f"{root}/requests/generation")
        writers.manifest(rows.select("custom_id", "dialogue_id", "domain", "variant_type", "direction", "turn_count", "target_dimensions", "domain_metadata"), f"{root}/manifest/generation")
    else:
        manifest = readers.manifest_rows(spark, f"{root}/manifest/generation", "custom_id string, dialogue_id string, domain string, variant_type string, direction string, turn_count int, target_dimensions array<string>")
        replies = replies_of(spark, root, "generation")
        made = variants(replies, manifest)
        if step == "evaluate":
            refused = refused_replies(replies, manifest, continuation(F.col("reply")).isNotNull())
            writers.json_lines(refused, f"{root}/failures_generation", mode="overwrite")
            print(report.markdown(judged.failure_breakdown(refused)))
            requests = prompts.evaluation_prompt(contrast.evaluations(made, entries))
            lines = requests.select("custom_id", writers.envelope(F.col("custom_id"), F.col("prompt")).alias("line"))
            writers.request_shards(shards.sharded(lines, ["custom_id"], "stage2_eval", first=0), f"{root}/requests/evaluation")
            writers.manifest(requests.select("custom_id", "variant_id", "candidate_id", "domain", "direction", "variant_type", "target_dimensions", "stage_1_scores"), f"{root}/manifest/evaluation")
            return
        if readers.there(spark, f"{root}/manifest/evaluation"):
            asked = last_wins(readers.manifest_rows(spark, f"{root}/manifest/evaluation", EVALUATION), ["custom_id"], ["variant_id"])
        else:
            asked = contrast.evaluations(made, entries)
        replies = replies_of(spark, root, "evaluation")
        refused = refused_replies(replies, asked, evaluation_scores(F.col("reply")).isNotNull())
        writers.json_lines(refused, f"{root}/failures_evaluation", mode="overwrite")
        results = evaluated(asked, replies, args.margin_threshold)
        print(report.markdown(judged.failure_breakdown(refused)), report.markdown(results.groupBy("label").count().orderBy("label")), sep="\n")
        writers.json_lines(contrast.pairs(made, results, entries), f"{root}/pairs")
