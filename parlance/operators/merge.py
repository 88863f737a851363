"""From parsed replies to one schema: metadata lookups, the 23-score row, the union of domains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.dims import ALL_DIMS, DOMAINS, RELATION_DIM
from parlance.functions.numeric import normalize_score
from parlance.functions.replies import number, raw_value
from parlance.functions.text import messages_of

from .rows import entry_ids, first_wins, last_wins
from .skew import lookup_join

#: The descriptive fields of a multicultural dialogue.
METADATA_FIELDS = ("country_1", "country_2", "demographics_1", "demographics_2", "statement_original", "statement_cultural", "situation", "cultural_reasoning_1", "cultural_reasoning_2", "arousal_reasoning", "arousal_score", "social_norms_1", "social_norms_2", "prejudices_1", "prejudices_2")


def metadata_by_uid(rows: DataFrame, order: list[str], fields: tuple[str, ...] = METADATA_FIELDS) -> DataFrame:
    """(uid, domain_metadata): the last row of each uid that isn't empty, as a map; null fields count as empty."""
    kept = last_wins(rows.filter(F.coalesce(F.length("uid"), F.lit(0)) > 0).select("uid", *order, *fields), ["uid"], order)
    return kept.select("uid", F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields])).alias("domain_metadata"))


def gold_by_pid(rows: DataFrame, order: list[str], relation: str = "gold") -> DataFrame:
    """(pid, domain_metadata): the first relation of each pid and the dimension that it speaks to, empty if unknown."""
    kept = first_wins(rows.filter(F.coalesce(F.length("pid"), F.lit(0)) > 0).select("pid", *order, F.col(relation).alias("gold")), ["pid"], order)
    known = F.create_map(*[F.lit(x) for kv in RELATION_DIM.items() for x in kv])
    return kept.select("pid", F.create_map(F.lit("gold_relation"), F.coalesce("gold", F.lit("")), F.lit("target_dimension"), F.coalesce(known[F.col("gold")], F.lit(""))).alias("domain_metadata"))


def enrich(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``domain_metadata`` of their key, null if the lookup lacks it. A key may hold any share of the rows."""
    weight = rows.groupBy(key).agg(F.count("*").alias("__rows"))
    return lookup_join(rows, lookup.join(weight, key), [key], "__rows", how="left").drop("__rows")


def full_scores(present: dict[str, Column]) -> Column:
    """The struct of all 23 dimensions, null where a domain has none."""
    return F.struct(*[(present[n] if n in present else F.lit(None).cast("double")).alias(n) for n in ALL_DIMS])


def normalized_scores(obj: Column, domain: str) -> dict[str, Column]:
    """The domain's scores in a parsed row's JSON: the prefixed key before the bare one where it is null, on the scale of 0 to 1."""
    d = DOMAINS[domain]
    return {n: normalize_score(number(F.coalesce(raw_value(obj, n), raw_value(obj, dim)))) for n, dim in zip(d.names, d.dims)}


def entries_of(domain: str, rows: DataFrame) -> DataFrame:
    """Stage-1 rows of ``rows``(source_id, content, object, domain_metadata) of one domain, still without ids."""
    return rows.select("source_id", F.lit(domain).alias("domain"), messages_of(F.coalesce("content", F.lit(""))).alias("messages"), F.lit(None).cast("string").alias("split"), full_scores(normalized_scores(F.col("object"), domain)).alias("scores"), "domain_metadata", F.lit(list(DOMAINS).index(domain)).alias("domain_ord"))


def merge_domains(parts: dict[str, DataFrame]) -> DataFrame:
    """All domains' entries, numbered in the order of domains, then of source ids."""
    merged = reduce(DataFrame.unionByName, [entries_of(d, parts[d]) for d in DOMAINS if d in parts])
    merged = merged.withColumn("__tie", F.xxhash64(F.to_json(F.struct("messages", "scores"))))
    return entry_ids(merged, ["domain_ord", "source_id", "__tie"], "S1D", "dialogue_id").drop("domain_ord", "__tie")


def long_scores(entries: DataFrame) -> DataFrame:
    """(entry_id, dim, score) of all present scores."""
    pairs = F.array(*[F.struct(F.lit(n).alias("dim"), F.col("scores")[n].alias("score")) for n in ALL_DIMS])
    return entries.select("entry_id", F.inline(F.filter(pairs, lambda p: p["score"].isNotNull())))
