import json
import math
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parlance.functions.dims import ALL_DIMS, BUCKET_WEIGHTS, DOMAINS, RELATION_DIM, SPLIT_SHARES, char_names_of, registry_table
from parlance.operators import analytics, contrast, judged, merge, quota, rows, shards
from parlance.plans import report

MSG = "array<struct<role string, content string>>"
SCORES = "struct<" + ", ".join(f"{n}: double" for n in ALL_DIMS) + ">"
ENTRY = f"entry_id bigint, dialogue_id string, domain string, messages {MSG}, split string, scores {SCORES}, domain_metadata map<string,string>"


def scores(**given_scores):
    return tuple(given_scores.get(n) for n in ALL_DIMS)


def dialogue(n):
    return [("user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(n)]


def entry(i, domain="coherence", n=4, split=None, **s):
    return (i, f"S1D-{i:06d}", domain, dialogue(n), split, scores(**s), None)


# --- registry


def test_registry(spark):
    assert len(ALL_DIMS) == 23 == len(set(ALL_DIMS)) == registry_table(spark).count()
    assert [len(d.characterizing) for d in DOMAINS.values()] == [2, 2, 4, 2]


# --- rows


def test_first_and_last_win(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", None, "z"), (None, 1, "n")], "k string, o int, v string")
    assert sorted(map(tuple, rows.first_wins(df, ["k"], ["o"]).collect()), key=str) == sorted([("a", None, "z"), (None, 1, "n")], key=str)
    assert {r["v"] for r in rows.last_wins(df, ["k"], ["o"]).collect()} == {"x", "n"}
    assert rows.first_wins(df.limit(0), ["k"], ["o"]).count() == 0


def test_distinct_texts(spark):
    df = spark.createDataFrame([(1, " a "), (2, "a"), (3, None), (4, None), (5, ""), (6, ""), (7, "b")], "id int, t string")
    assert sorted(r["id"] for r in rows.distinct_texts(df, "t", ["id"]).collect()) == [1, 3, 4, 5, 6, 7]


def test_sequence_is_gapless(spark):
    ids = list(range(500))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id int").repartition(7)
    assert [tuple(r) for r in rows.with_sequence(df, ["id"]).orderBy("id").collect()] == [(i, i + 1) for i in range(500)]
    assert rows.entry_ids(df.filter("id < 2"), ["id"], "S1D", "name").orderBy("id").collect()[1]["name"] == "S1D-000002"
    assert rows.with_sequence(df.limit(0), ["id"]).count() == 0


# --- quotas


def test_split_quotas_of_a_known_run():
    counts = dict(zip(DOMAINS, (12797, 12789, 12862, 12816)))
    q = quota.split_quotas(counts, SPLIT_SHARES)
    assert [q[d]["test"] for d in DOMAINS] == [1920, 1918, 1929, 1923]
    assert [q[d]["val"] for d in DOMAINS] == [1280, 1279, 1286, 1282]
    assert [q[d]["train"] for d in DOMAINS] == [9597, 9592, 9647, 9611]


@given(st.lists(st.integers(0, 5000), min_size=4, max_size=4))
def test_split_quotas_add_up(ns):
    counts = dict(zip(DOMAINS, ns))
    q = quota.split_quotas(counts, SPLIT_SHARES)
    assert all(sum(q[d].values()) == counts[d] and min(q[d].values()) >= 0 for d in DOMAINS)
    assert sum(x["test"] for x in q.values()) == math.ceil(0.15 * sum(ns))


def test_assign_splits(spark):
    df = spark.createDataFrame([(i, list(DOMAINS)[i % 3 % 4]) for i in range(900)] + [(1000, "other"), (1001, None)], "id bigint, domain string").withColumn("split", F.lit("old"))
    a = {r["id"]: r["split"] for r in quota.assign_splits(df, "domain", "id", list(DOMAINS), SPLIT_SHARES).collect()}
    assert len(a) == 900 and sum(s == "test" for s in a.values()) == 135 and sum(s == "val" for s in a.values()) == math.ceil(0.10 / (1.0 - 0.15) * 765)
    assert a == {r["id"]: r["split"] for r in quota.assign_splits(df.repartition(9), "domain", "id", list(DOMAINS), SPLIT_SHARES).collect()}
    b = {r["id"]: r["split"] for r in quota.assign_splits(df, "domain", "id", list(DOMAINS), SPLIT_SHARES, seed=1).collect()}
    assert a != b


def test_sample_quotas_of_a_full_pool(spark):
    counts = spark.createDataFrame([(x, b, 100_000) for x in ("Yes", "No") for b in quota.BUCKETS], "label string, bucket string, available bigint")
    got = {(r["label"], r["bucket"]): r["needed"] for r in quota.sample_quotas(counts, 12_800, {"Yes": 0.7, "No": 0.3}, BUCKET_WEIGHTS["coherence"]).collect()}
    assert [got["Yes", b] for b in quota.BUCKETS] == [1792, 2240, 2688, 2240] and [got["No", b] for b in quota.BUCKETS] == [768, 960, 1152, 960]


def test_sample_refills_within_a_label(spark):
    items = [(i, "\n".join(f"{i} {j}" for j in range(3)), "Yes") for i in range(140)] + [(1000 + i, "\n".join(f"{i} {j}" for j in range(8)), "No") for i in range(60)] + [(5000, "0 0\n0 1\n0 2", "Yes"), (5001, "x", "Maybe"), (5002, "just one", None)]
    df = spark.createDataFrame(items, "id bigint, content string, label string")
    got = quota.stratified_sample(df, "content", "label", ["id"], 90, {"Yes": 0.7, "No": 0.3}, BUCKET_WEIGHTS["coherence"]).collect()
    labels = [r["label"] for r in got]
    assert labels.count("Yes") == int(90 * 0.7) == 62 and labels.count("No") == 27 and len({r["id"] for r in got}) == len(got)
    assert not {5000, 5001} & {r["id"] for r in got}


def test_sample_by_turns_alone(spark):
    df = spark.createDataFrame([(i, "\n".join(f"{i} {j}" for j in range(2 + i % 20))) for i in range(300)], "id bigint, content string")
    got = quota.turn_sample(df, "content", ["id"], 100, BUCKET_WEIGHTS["empathy"])
    assert got.count() == 100 and got.columns == ["id", "content", "bucket"]


def test_failure_samples(spark):
    df = spark.createDataFrame([("r", f"{i:02d}") for i in range(20)] + [("s", "x")], "reason string, custom_id string")
    assert sorted(map(tuple, judged.failure_samples(df, 2).collect())) == [("r", "00"), ("r", "01"), ("s", "x")]


# --- contrast


@pytest.mark.parametrize("score, tier, direction", [(0.39, "low", "positive"), (0.40, "medium", "positive"), (0.54, "medium", "positive"), (0.55, "medium", "negative"), (0.70, "high", "negative")])
def test_tiers(spark, score, tier, direction):
    df = spark.createDataFrame([entry(1, co_topic_coherence=score, co_logical_consistency=score)], ENTRY)
    r = contrast.tiered(df).first()
    assert (r["tier"], r["direction"]) == (tier, direction)


def test_candidates(spark):
    df = spark.createDataFrame([entry(1, co_topic_coherence=0.2), entry(2, "commonsense", cs_causality=0.9), entry(3, split="val", co_topic_coherence=0.2), entry(4), entry(5, split="train", co_mutual_grounding=0.5), entry(6, split="train", n=1, co_topic_coherence=0.8)], ENTRY)
    got = {(r["entry_id"], r["custom_id"], r["variant_type"]) for r in contrast.candidates(df).collect()}
    assert got == {(1, "s2g-S1D-000001-gimp", "global_improve"), (6, "s2g-S1D-000006-gdeg", "global_degrade"), *((i, f"s2g-S1D-{i:06d}-dt-{d}", "dimension_targeted") for i in (1, 6) for d in DOMAINS["coherence"].char_names), *((2, f"s2g-S1D-000002-dt-{d}", "dimension_targeted") for d in DOMAINS["commonsense"].char_names)}
    assert {r["entry_id"] for r in contrast.requests(contrast.candidates(df)).collect()} == {1, 2}
    assert {r["entry_id"] for r in contrast.candidates(df, "commonsense").collect()} == {2}
    assert {r["entry_id"] for r in contrast.valid_entries(df).collect()} == {1, 2, 3, 5, 6}


def test_prefix_and_continuation(spark):
    cases = [(4, 2), (4, 4), (4, 9), (1, 1), (2, 1)]
    df = spark.createDataFrame([(dialogue(n), k) for n, k in cases], f"m {MSG}, k int")
    got = [(len(r[0]), [x["content"] for x in r[1]]) for r in df.select(contrast.prefix_of(F.col("m"), F.col("k")), contrast.continuation_of(F.col("m"), F.col("k"))).collect()]
    assert got == [(2, ["m2", "m3"]), (1, ["m1", "m2", "m3"]), (1, ["m1", "m2", "m3"]), (1, ["m0"]), (1, ["m1"])]


def test_sampled_turns(spark):
    df = spark.range(20_000).select(contrast.sampled_turns(F.col("id").cast("string"), F.lit(100)).alias("n"))
    share = {r["n"]: r["count"] / 20_000 for r in df.groupBy("n").count().collect()}
    assert all(abs(share[n] - s) < 0.02 for n, s in {1: 0.15, 3: 0.40, 5: 0.30, 7: 0.15}.items())


LABEL_CASES = [
    ("global", "positive", {"a": 0.3, "b": 0.3}, {"a": 0.7, "b": 0.7}, ["a", "b"], "global_pass"),
    ("global", "negative", {"a": 0.3, "b": 0.3}, {"a": 0.7, "b": 0.7}, ["a", "b"], "global_flip_pass"),
    ("global", "positive", {"a": 0.5}, {"a": 0.625}, ["a", "b"], "reject"),
    ("global", "positive", {"c": 0.5}, {"a": 0.9}, ["a", "b"], "reject"),
    ("targeted", "positive", {"a": 0.3, "b": 0.5}, {"a": 0.7, "b": 0.5}, ["a"], "target_pass"),
    ("targeted", "positive", {"a": 0.3, "b": 0.5}, {"a": 0.7, "b": 0.9}, ["a"], "target_coarse_pass"),
    ("targeted", "negative", {"a": 0.3, "b": 0.5}, {"a": 0.7, "b": 0.5}, ["a"], "target_flip_pass"),
    ("targeted", "positive", {"a": 0.5}, {"a": 0.625}, ["a"], "reject"),
    ("targeted", "positive", {"a": 0.25, "b": 0.5}, {"a": 0.75, "b": 0.75}, ["a"], "target_pass"),
    ("targeted", "positive", {"a": 0.3}, {"a": 0.9}, [], "reject"),
    ("targeted", "positive", {"b": 0.3}, {"a": 0.9}, ["a"], "reject"),
    ("targeted", "positive", {"a": 0.3}, {"a": 0.9}, None, "reject"),
]


def test_labels(spark):
    df = spark.createDataFrame([c[:5] for c in LABEL_CASES], "scope string, way string, o map<string,double>, v map<string,double>, t array<string>")
    label = contrast.label(F.col("o"), F.col("v"), F.col("way"), F.col("scope"), F.array(F.lit("a"), F.lit("b")), F.col("t"), margin=0.125, stability=0.25)
    assert [r[0] for r in df.select(label).collect()] == [c[5] for c in LABEL_CASES]


def test_difficulty(spark):
    df = spark.createDataFrame([(0.3,), (0.29,), (0.15,), (0.14,)], "m double")
    assert [r[0] for r in df.select(contrast.difficulty(F.col("m"))).collect()] == ["easy", "medium", "medium", "hard"]


VARIANT = f"candidate_id string, variant_id string, variant_type string, direction string, variant_messages {MSG}, generation_model string, target_dimensions array<string>"
RESULT = "variant_id string, original_scores map<string,double>, variant_scores map<string,double>, label string"
LOW_, HIGH_ = {"co_topic_coherence": 0.3, "co_logical_consistency": 0.3}, {"co_topic_coherence": 0.7, "co_logical_consistency": 0.7}


def test_pairs(spark):
    said = [("assistant", "v1"), ("user", "v2")]
    v = [("S1D-000001", f"v{i}", "global", "positive", said, "m", ["co_topic_coherence", "co_logical_consistency"]) for i in range(5)] + [("none", "v5", "global", "positive", said, "m", []), ("S1D-000001", "v6", "targeted", "negative", said, None, None)]
    r = [("v0", LOW_, HIGH_, "global_pass"), ("v1", HIGH_, LOW_, "global_flip_pass"), ("v2", LOW_, HIGH_, "reject"), ("v3", HIGH_, LOW_, "global_pass"), ("v5", LOW_, HIGH_, "global_pass"), ("v6", HIGH_, LOW_, "target_pass")]
    e = spark.createDataFrame([entry(1, co_topic_coherence=0.3)], ENTRY)
    V, R = spark.createDataFrame(v, VARIANT), spark.createDataFrame(r, RESULT)
    out = {x["variant_id"]: x["outcome"] for x in contrast.outcomes(V, R, e).collect()}
    assert out == {"v0": "pair", "v1": "pair", "v2": "rejected", "v3": "bad_ordering", "v4": "no_result", "v5": "no_original", "v6": "pair"}
    p = {x["variant_id"]: x for x in contrast.pairs(V, R, e).collect()}
    assert [p[k]["pair_id"] for k in ("v0", "v1", "v6")] == ["S2D-000001", "S2D-000002", "S2D-000003"]
    assert [m["content"] for m in p["v0"]["chosen"]] == ["v1", "v2"] and [m["content"] for m in p["v0"]["rejected"]] == ["m2", "m3"]
    assert [m["content"] for m in p["v1"]["chosen"]] == ["m2", "m3"] and not p["v1"]["metadata"]["contrast"]["intent_followed"] and p["v1"]["metadata"]["contrast"]["direction"] == "positive"
    assert p["v1"]["evaluation"]["chosen_score_source"] == "stage_1" and p["v0"]["metadata"]["difficulty"] == "easy"
    assert p["v6"]["metadata"]["contrast"]["scope"] == "target" and p["v6"]["metadata"]["dimensions"]["decision"] == DOMAINS["coherence"].char_names
    shift = analytics.score_shift(contrast.pairs(V, R, e)).collect()
    assert len(shift) == 2 and all(abs(s["avg_original"] - (0.3 + 0.7 + 0.7) / 3) < 1e-6 for s in shift)
    d = analytics.direction_distribution(contrast.pairs(V, R, e)).first()
    assert (d["variant_chosen"], d["original_chosen"]) == (1, 2)
    assert contrast.pairs(V.limit(0), R, e).count() == 0


# --- judged


def test_taxonomy_keeps_unknown_and_repeated_ids(spark):
    replies = spark.createDataFrame([("a", 200, '{"x": 1}', None), ("a", 200, "{'x': 1}", None), ("b", 500, None, "boom"), ("c", 200, "[1]", None), ("d", None, "{}", None), ("zz", 200, "{}", None)], "custom_id string, status_code int, reply string, error string")
    manifest = spark.createDataFrame([(x, "t") for x in "abcdef"], "custom_id string, content string")
    got = sorted(((r["custom_id"], r["reason"]) for r in judged.taxonomy(replies, manifest).collect()), key=str)
    assert got == sorted([("a", None), ("a", None), ("b", "api_error"), ("c", "json_parse_error"), ("d", "api_error"), ("zz", "unknown_custom_id")], key=str)
    assert sorted(r[0] for r in judged.missing(replies, manifest).select("custom_id").collect()) == ["e", "f"]


def test_dual_outcomes(spark):
    dim, dlg = '{"causality": 0.1, "consistency": 0.2, "reaction": 0.3, "desire": 0.4}', '{"coherence": 0.5, "cs_empathy": 0.6}'
    replies = [("a-dim", 200, dim, 1), ("a-dlg", 200, dlg, 1), ("b-dim", 200, dim, 1), ("c-dim", 500, dim, 1), ("c-dlg", 500, dlg, 1), ("d-dim", 200, "{}", 1), ("d-dlg", 200, dlg, 1), ("e-dim", 200, "bad", 1), ("e-dim", 200, dim, 2), ("e-dlg", 200, dlg, 1), ("f", 200, dim, 1), ("g-dlg", 200, dlg, 1)]
    df = spark.createDataFrame([(c, s, r, None, n) for c, s, r, n in replies], "custom_id string, status_code int, reply string, error string, line_no int")
    manifest = spark.createDataFrame([(x,) for x in "abcdefgh"], "custom_id string")
    got = {r["custom_id"]: (r["failed_id"], r["reason"], r["cs_empathy"]) for r in judged.dual_outcomes(df, manifest, ["line_no"]).collect()}
    assert got["a"] == (None, None, 0.6) and got["e"] == (None, None, 0.6)
    assert {k: v[:2] for k, v in got.items() if v[1]} == {"b": ("b-dlg", "missing_from_batch"), "c": ("c-dim", "api_error"), "d": ("d", "incomplete_merge"), "g": ("g-dim", "missing_from_batch"), "h": ("h-dim", "missing_from_batch")}
    assert got["f"][1] is None


def test_retries(spark):
    failures = spark.createDataFrame([("a", "api_error"), ("a", "api_error"), ("b", "incomplete_merge"), ("c-dim", "json_parse_error"), ("d", "api_error"), ("e", "unknown_custom_id"), ("f", "incomplete_merge")], "custom_id string, reason string")
    asked = spark.createDataFrame([("a", "1"), ("b-dim", "2"), ("b-dlg", "3"), ("c-dim", "4"), ("c-dlg", "5"), ("e", "6"), ("f-dim", "7")], "custom_id string, line string")
    assert sorted(r["custom_id"] for r in judged.retry_set(failures, asked).collect()) == ["a", "b-dim", "b-dlg", "c-dim"]
    assert sorted(r["custom_id"] for r in judged.lost_for_retry(failures, asked).collect()) == ["d", "f"]
    assert judged.within_holdout(failures) and not judged.within_holdout(failures, 3)
    first, again = spark.createDataFrame([("a", "old"), ("b", "old")], "custom_id string, reply string"), spark.createDataFrame([("a", "new")], "custom_id string, reply string")
    assert {tuple(r) for r in judged.with_retries(first, again).collect()} == {("a", "new"), ("b", "old")}
    assert {tuple(r) for r in judged.failure_breakdown(failures).collect()} >= {("api_error", 3, "a"), ("incomplete_merge", 2, "b")}


def test_shards(spark):
    df = spark.createDataFrame([(f"{i:03d}", "x" * (i % 7)) for i in range(100)], "custom_id string, line string")
    names = [r["shard"] for r in shards.sharded(df, ["custom_id"], "co", rows=30).orderBy("custom_id").collect()]
    assert names[0] == names[29] == "co_shard_0001" and names[30] == "co_shard_0002" and names[99] == "co_shard_0004"
    by = {}
    for r in shards.shards_by_size(df, "line", ["custom_id"], rows=8, size=25, per_run=40).collect():
        by.setdefault(r["shard"], []).append(len(r["line"]) + 1)
    assert sum(map(len, by.values())) == 100 and all(len(v) <= 8 and (sum(v) <= 25 or len(v) == 1) for v in by.values())
    assert sorted(by) == list(range(1, len(by) + 1))


# --- merge


def test_merge(spark):
    co = spark.createDataFrame([("co-1", "Human A: hi\nHuman B: yo", json.dumps({"co_topic_coherence": {"reasoning": "r", "score": 0.0}, "discourse_structure": 5, "logical_consistency": 1}), None)], "source_id string, content string, object string, domain_metadata map<string,string>")
    mu = spark.createDataFrame([("mu-1", None, json.dumps({"mu_naturalness": 0.126}), {"country_1": "X"})], "source_id string, content string, object string, domain_metadata map<string,string>")
    got = merge.merge_domains({"multicultural": mu, "coherence": co}).orderBy("dialogue_id").collect()
    assert [r["dialogue_id"] for r in got] == ["S1D-000001", "S1D-000002"] and [r["domain"] for r in got] == ["coherence", "multicultural"]
    s = got[0]["scores"]
    assert (s["co_topic_coherence"], s["co_discourse_structure"], s["co_logical_consistency"], s["co_mutual_grounding"], s["mu_naturalness"]) == (0.0, 1.0, 1.0, None, None)
    assert got[1]["messages"] == [] and got[1]["scores"]["mu_naturalness"] == 0.13


def test_lookups(spark):
    gold = spark.createDataFrame([("p", 1, "xWant"), ("p", 2, "xAttr"), ("", 3, "xAttr"), (None, 4, "xAttr"), ("q", 5, "odd"), ("r", 6, None)], "pid string, ord int, gold string")
    got = {r["pid"]: (r["domain_metadata"]["gold_relation"], r["domain_metadata"]["target_dimension"]) for r in merge.gold_by_pid(gold, ["ord"]).collect()}
    assert got == {"p": ("xWant", "cs_desire"), "q": ("odd", ""), "r": ("", "")}
    meta = spark.createDataFrame([("u", 1, "A"), ("u", 2, None), ("", 3, "B")], "uid string, ord int, country_1 string")
    assert [tuple(r) for r in merge.metadata_by_uid(meta, ["ord"], ("country_1",)).collect()] == [("u", {"country_1": ""})]


def test_fixed_values():
    assert analytics.THRESHOLDS == (0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50, 0.60)
    assert RELATION_DIM == {"HinderedBy": "cs_causality", "IsAfter": "cs_causality", "xAttr": "cs_consistency", "xReact": "cs_reaction", "oReact": "cs_reaction", "xWant": "cs_desire", "oWant": "cs_desire"}
    assert set(RELATION_DIM.values()) <= set(DOMAINS["commonsense"].names)


def test_reports_say_what_they_leave_out(spark):
    df = spark.range(5)
    assert report.markdown(df, most=3).endswith("(2 more rows)") and report.markdown(df, most=5).count("\n") == 6


def test_unknown_domain_has_no_dims(spark):
    assert spark.createDataFrame([("x",)], "d string").select(char_names_of(F.col("d"))).first()[0] is None
