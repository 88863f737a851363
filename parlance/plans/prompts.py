"""Prompts as column expressions. The wording is this project's own; what goes into them is fixed by the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.dims import DESCRIPTIONS, DOMAINS, Domain, by_domain, description_of
from parlance.functions.numeric import let, round2
from parlance.functions.text import context_lines, numbered_turns, spoken

ABSENT = "(not available)"
ANCHORS = "0.0 not at all, 0.25 a little, 0.5 in part, 0.75 largely, 1.0 fully"


def _given(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(ABSENT))


def whole_number_judge(content: Column, d: Domain) -> Column:
    """Judging on a scale of 1 to 5: a question for each dimension but the overall one, which is a number alone."""
    *asked, overall = d.dims
    questions = "\n".join(f"{i}. {x}: {DESCRIPTIONS[x]}?" for i, x in enumerate(asked, 1))
    shape = ", ".join(f'"{x}": {{"reasoning": "...", "score": 1-5}}' for x in asked)
    text = F.concat(F.lit("Judge the dialogue below.\n\nDIALOGUE:\n"), content, F.lit(f'\n\nQUESTIONS:\n{questions}\n\nAnswer as JSON only: {{{shape}, "{overall}": 1-5}}'))
    return F.when(F.trim(content) != "", text)


def multicultural_judge(conversation: Column, statement: Column, country_1: Column, country_2: Column) -> Column:
    d = DOMAINS["multicultural"]
    turns = numbered_turns(conversation)
    shape = ", ".join(f'"{n}": 0.0-1.0' for n in d.names)
    parts = F.concat(F.lit("Judge the conversation between speakers of two cultures.\n\nCOUNTRIES: "), _given(country_1), F.lit(", "), _given(country_2), F.lit("\nSTATEMENT: "), statement, F.lit("\n\nTURNS:\n"), turns, F.lit(f"\n\nSCALE: {ANCHORS}\nAnswer as JSON only: {{{shape}}}"))
    return F.when((F.trim(conversation) != "") & (F.trim(statement) != "") & (turns != ""), parts)


def commonsense_judges(ctx: Column, seg: Column, relations: Column) -> Column:
    """The two requests of a commonsense dialogue, as an array of (part, prompt); null unless context and target are there."""
    d = DOMAINS["commonsense"]
    head = F.concat(F.lit("Judge the last utterance in its context.\n\nCONTEXT:\n"), context_lines(ctx), F.lit("\n\nTARGET: "), seg)
    names = ("HinderedBy", "IsAfter", "xAttr", "xReact", "oReact", "xWant", "oWant")
    references = F.concat_ws("\n", *[F.concat(F.lit(f"- {n}: "), _given(relations[n])) for n in names])
    ask = lambda dims: F.lit(f"\n\nSCALE: {ANCHORS}\nAnswer as JSON only: {{{', '.join(f'"cs_{x}": 0.0-1.0' for x in dims)}}}")
    both = F.array(
        F.struct(F.lit("dim").alias("part"), F.concat(head, F.lit("\n\nREFERENCES:\n"), references, ask(d.dims[:4])).alias("prompt")),
        F.struct(F.lit("dlg").alias("part"), F.concat(head, ask(d.dims[4:])).alias("prompt")),
    )
    return F.when((F.coalesce(ctx, F.lit("")) != "") & (F.coalesce(seg, F.lit("")) != ""), both)


def wanted_change(score: Column, direction: Column) -> Column:
    """How much is to change, by the score as it is."""
    up = F.when(score <= 0.3, "a substantial improvement").when(score <= 0.6, "a clear improvement").otherwise("a subtle improvement")
    down = F.when(score >= 0.7, "a substantial decline").when(score >= 0.4, "a clear decline").otherwise("a minimal decline")
    return F.when(direction == "positive", up).otherwise(down)


def two_places(score: Column) -> Column:
    return let(round2(score), lambda r: F.format_string("%.2f", r))


def score_lines(scores: Column, dims: Column, direction: Column) -> Column:
    """A line for each dimension that has a score."""
    have = F.filter(dims, lambda d: F.map_contains_key(scores, d))
    return F.array_join(F.transform(have, lambda d: F.concat(F.lit("- "), d, F.lit(": now "), two_places(scores[d]), F.lit(", wanted: "), wanted_change(scores[d], direction))), "\n")


def rubric(dims: Column) -> Column:
    text = F.array_join(F.transform(dims, lambda d: F.concat(F.lit("- "), d, F.lit(": "), F.coalesce(description_of(d), F.lit("(unknown)")))), "\n")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("(no dimensions)"))


def guidance(dims: Column, direction: Column) -> Column:
    """What to do about each dimension that is to change."""
    up, down = "make it plainer than it is, by what is said and not by telling it: ", "let it fall off without a remark on it: "
    return F.array_join(F.transform(dims, lambda d: F.concat(F.lit("- "), d, F.lit(": "), F.when(direction == "positive", up).otherwise(down), F.coalesce(description_of(d), F.lit("(unknown)")))), "\n")


def culture_block(metadata: Column) -> Column:
    """What is known of a dialogue's cultures; empty where nothing is."""
    keys = F.array_sort(F.filter(F.map_keys(metadata), lambda k: F.trim(metadata[k]) != ""))
    lines = F.array_join(F.transform(keys, lambda k: F.concat(F.lit("- "), k, F.lit(": "), metadata[k])), "\n")
    return F.coalesce(F.when(lines != "", F.concat(F.lit("\nCULTURAL CONTEXT:\n"), lines, F.lit("\n"))), F.lit(""))


def generation_prompt(rows: DataFrame) -> DataFrame:
    """``rows`` of requests with their prompt: the prefix, the part to rewrite, what to change and what to leave."""
    from parlance.operators.contrast import char_map

    chars = by_domain(F.col("domain"), lambda d: F.array(*map(F.lit, d.char_names)))
    names = by_domain(F.col("domain"), lambda d: F.array(*map(F.lit, d.names)))
    rows = rows.withColumns({"__scores": char_map(F.col("scores"), F.col("domain")), "__names": names, "__chars": chars})
    t, way = F.col("target_dimensions"), F.col("direction")
    task = F.when(F.col("variant_type") == "global_improve", "Rewrite the continuation so that it is better in every listed dimension.").when(F.col("variant_type") == "global_degrade", "Rewrite the continuation so that it is worse in every listed dimension, and still natural.").when(way == "positive", "Rewrite the continuation so that it is better in the target dimension alone.").otherwise("Rewrite the continuation so that it is worse in the target dimension alone. Be subtle: no rudeness, no obvious mistakes.")
    keep = F.array_except(F.when(F.col("scope") == "global", F.col("__names")).otherwise(F.col("__chars")), t)
    keep_block = F.when((F.size(keep) > 0) & ((F.col("scope") == "target") | (F.col("variant_type") == "global_degrade")), F.concat(F.lit("\nLEAVE AS THEY ARE:\n"), F.array_join(F.transform(keep, lambda d: F.concat(F.lit("- "), d)), "\n"), F.lit("\n"))).otherwise("")
    # joined piece by piece, so that no text of a dialogue is searched for a place to put the next one
    prompt = F.concat(task, F.lit("\n\nCONVERSATION SO FAR:\n"), spoken(F.col("prefix")), F.lit("\n\nCONTINUATION:\n"), spoken(F.col("rewritable")), F.lit("\n\nDIMENSIONS:\n"), rubric(t), F.lit("\n\nSCORES:\n"), score_lines(F.col("__scores"), t, way), F.lit("\n\nGUIDANCE:\n"), guidance(t, way), F.lit("\n"), keep_block, culture_block(F.when(F.col("domain") == "multicultural", F.col("domain_metadata"))), F.lit("\nINSTRUCTIONS:\nWrite "), F.col("turn_count").cast("string"), F.lit(' messages. Answer as JSON only: {"continuation": [{"role": "user|assistant", "content": "..."}]}'))
    return rows.withColumn("prompt", prompt).drop("__scores", "__names", "__chars")


def evaluation_prompt(rows: DataFrame) -> DataFrame:
    """``rows`` of evaluations with their prompt: prefix, variant, all of the domain's dimensions and the scale."""
    names = by_domain(F.col("domain"), lambda d: F.array(*map(F.lit, d.names)))
    prompt = F.concat(F.lit("Score the continuation.\n\nCONVERSATION SO FAR:\n"), spoken(F.col("prefix")), F.lit("\n\nCONTINUATION:\n"), spoken(F.col("variant_messages")), F.lit("\n\nDIMENSIONS:\n"), rubric(names), culture_block(F.when(F.col("domain") == "multicultural", F.col("domain_metadata"))), F.lit(f'\n\nSCALE: {ANCHORS}\nAnswer as JSON only: {{"scores": {{dimension: number}}}}'))
    return rows.withColumn("prompt", prompt)


#: A dialogue to look at prompts with.
SAMPLE = (("user", "I missed the last train and had to walk home."), ("assistant", "That sounds tiring. How far was it?"), ("user", "An hour and a half, and it rained."), ("assistant", "Then I hope you could sleep in."))


def rendered(spark: SparkSession) -> DataFrame:
    """(ord, domain, kind, prompt): each kind of generation prompt of every domain, better and worse, and its evaluation prompt, for one made-up dialogue."""
    messages = [{"role": r, "content": c} for r, c in SAMPLE]
    rows, ends = [], []
    for name, d in DOMAINS.items():
        chars = d.char_names
        metadata = {"country_1": "Exampleland", "country_2": "Otherland", "situation": "two friends talk"} if name == "multicultural" else None
        kinds = [("global", "global_improve", "positive", chars), ("global", "global_degrade", "negative", chars)] + [("target", "dimension_targeted", way, [c]) for way in ("positive", "negative") for c in chars]
        for scope, kind, way, dims in kinds:
            scores = {n: (0.45 if len(dims) > 1 else 0.25 if n == dims[0] else 0.55) for n in chars}
            rows.append((len(rows) + len(ends) + 1, name, scope, kind, way, dims, messages[:1], messages[1:], 3, scores, metadata))
        ends.append((len(rows) + len(ends) + 1, name, messages[:2], messages[2:], metadata))
    said = "array<struct<role string, content string>>"
    scores = ", ".join(f"{n}: double" for d in DOMAINS.values() for n in d.names)
    asked = spark.createDataFrame([(*r[:9], {n: r[9].get(n) for d in DOMAINS.values() for n in d.names}, r[10]) for r in rows], f"ord int, domain string, scope string, variant_type string, direction string, target_dimensions array<string>, prefix {said}, rewritable {said}, turn_count int, scores struct<{scores}>, domain_metadata map<string,string>")
    made = generation_prompt(asked).select("ord", "domain", F.concat_ws(" ", "variant_type", "direction", F.array_join("target_dimensions", ",")).alias("kind"), "prompt")
    last = spark.createDataFrame(ends, f"ord int, domain string, prefix {said}, variant_messages {said}, domain_metadata map<string,string>")
    return made.unionByName(evaluation_prompt(last).select("ord", "domain", F.lit("evaluation").alias("kind"), "prompt"))
