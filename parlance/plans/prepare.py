"""From raw items to judge requests and their manifest, for each domain."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.dims import DOMAINS
from parlance.functions.text import context_lines, fingerprint
from parlance.operators.rows import distinct_texts, first_rows
from parlance.sources.readers import relation_responses

from . import prompts


class Prepared(NamedTuple):
    """requests(custom_id, prompt), manifest, and one row of counters."""

    requests: DataFrame
    manifest: DataFrame
    summary: DataFrame


def _id(prefix: str, own: Column | None, content: Column) -> Column:
    by_text = F.substring(fingerprint(F.coalesce(content, F.lit(""))), 1, 16)
    return F.concat(F.lit(f"{prefix}-"), by_text if own is None else F.coalesce(F.nullif(own, F.lit("")), by_text))


def _prepared(items: DataFrame, text: Column, order: list[str], limit: int | None, custom_id: Column, asked: Column, manifest: list[Column]) -> Prepared:
    """``asked``: array of (suffix, prompt), null or empty for items that can't be asked. Copies are told before that check."""
    chosen = first_rows(items, order, limit).withColumn("__text", text)
    rows = distinct_texts(chosen, "__text", order).withColumns({"custom_id": custom_id, "__asked": asked})
    valid = rows.filter(F.coalesce(F.size("__asked"), F.lit(0)) > 0)
    requests = valid.select("custom_id", F.explode("__asked").alias("a")).select(F.concat("custom_id", "a.suffix").alias("custom_id"), "a.prompt")
    none = F.lit(0).cast("bigint")
    counts = chosen.agg(F.count("*").alias("total"), none.alias("own"), none.alias("valid")).unionByName(rows.agg(none.alias("total"), F.count("*").alias("own"), F.count_if(F.coalesce(F.size("__asked"), F.lit(0)) > 0).alias("valid")))
    summary = counts.agg(*[F.sum(c).alias(c) for c in ("total", "own", "valid")]).select("total", (F.col("total") - F.col("own")).alias("duplicates"), (F.col("own") - F.col("valid")).alias("invalid"), "valid")
    return Prepared(requests, valid.select("custom_id", *manifest), summary)


def _single(prompt: Column) -> Column:
    return F.when(prompt.isNotNull(), F.array(F.struct(F.lit("").alias("suffix"), prompt.alias("prompt"))))


def whole_number_domain(domain: str, items: DataFrame, limit: int | None = None) -> Prepared:
    """Coherence and empathy: ``items``(ord, content[, label])."""
    d = DOMAINS[domain]
    rest = [F.col("content"), *([F.col("label")] if "label" in items.columns else [])]
    return _prepared(items, F.col("content"), ["ord"], limit, _id(d.prefix, None, F.col("content")), _single(prompts.whole_number_judge(F.col("content"), d)), rest)


def commonsense(items: DataFrame, order: list[str], limit: int | None = None) -> Prepared:
    """``items`` with PID, UID, CTX, SEG and relation columns: two requests of each, one manifest row."""
    both = F.transform(prompts.commonsense_judges(F.col("CTX"), F.col("SEG"), relation_responses(items)), lambda a: F.struct(F.concat(F.lit("-"), a["part"]).alias("suffix"), a["prompt"].alias("prompt")))
    whole = F.concat(F.coalesce("CTX", F.lit("")), F.coalesce("SEG", F.lit("")))
    content = F.concat_ws("\nTarget: ", context_lines(F.coalesce("CTX", F.lit(""))), F.nullif("SEG", F.lit("")))
    return _prepared(items, whole, order, limit, _id("cs", F.col("PID"), whole), both, [content.alias("content"), F.col("PID").alias("pid"), F.col("UID").alias("uid")])


def multicultural(items: DataFrame, order: list[str], limit: int | None = None) -> Prepared:
    """``items`` with uid, conversation, statement_original, country_1, country_2, source_file."""
    asked = _single(prompts.multicultural_judge(F.col("conversation"), F.col("statement_original"), F.col("country_1"), F.col("country_2")))
    manifest = [F.col("conversation").alias("content"), F.col("uid"), F.col("country_1"), F.col("country_2"), F.col("source_file")]
    return _prepared(items, F.col("conversation"), order, limit, _id("mu", F.col("uid"), F.col("conversation")), asked, manifest)
