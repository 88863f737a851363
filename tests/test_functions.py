import json
import random
import statistics

from pyspark.sql import functions as F

from parlance.functions import dims, numeric, replies, text


def one(spark, col, *values, schema="x double"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(col).collect()]


def test_round2_equals_exact_rounding(spark):
    rng = random.Random(1)
    xs = [i / 1000 for i in range(1001)] + [i / 200 for i in range(201)] + [rng.random() for _ in range(3000)] + [0.125, 0.375, 0.625, 0.875, 0.0, 1.0, 2.675]
    assert one(spark, numeric.round2(F.col("x")), *xs) == [round(x, 2) for x in xs]


def test_exact_mean_equals_statistics_mean(spark):
    rng = random.Random(2)
    rows = [([rng.randrange(101) / 100 for _ in range(n)],) for n in (1, 2, 3, 4, 5, 6) for _ in range(500)]
    got = [r[0] for r in spark.createDataFrame(rows, "x array<double>").select(numeric.exact_mean(F.col("x"))).collect()]
    assert got == [statistics.mean(r[0]) for r in rows]


def test_exact_mean_of_nothing_is_null(spark):
    rows = [([],), (None,), ([None],), ([None, 0.5],)]
    assert [r[0] for r in spark.createDataFrame(rows, "x array<double>").select(numeric.exact_mean(F.col("x"))).collect()] == [None, None, None, 0.5]


def test_scores(spark):
    x = F.col("x")
    assert one(spark, numeric.coerce_score(x), 2.5, 3.5, 0.0, 9.0, None, float("nan")) == [2, 4, 1, 5, None, None]
    assert one(spark, numeric.unit_from_five(x.cast("int")), 1.0, 2.0, 5.0, None) == [0.0, 0.25, 1.0, None]
    assert one(spark, numeric.coerce_unit(x), -1.0, 0.126, 7.0, float("nan"), None) == [0.0, 0.13, 1.0, 0.0, None]
    assert one(spark, numeric.normalize_score(x), 1.0, 0.5, 3.0, 9.0, -1.0, float("nan")) == [1.0, 0.5, 0.5, 1.0, 0.0, 1.0]


def test_numbers_in_text(spark):
    assert one(spark, numeric.to_double(F.col("x")), "1", " 2.5 ", "1e1", "1.0d", "1_0", "x", None, schema="x string") == [1.0, 2.5, 10.0, None, None, None, None]


def test_messages(spark):
    got = one(spark, text.messages_of(F.col("x")), "Human A: hi\\nhuman b: Target: yo\n\n  SPK01-USA001:  x ", "", None, schema="x string")
    assert [(m["role"], m["content"]) for m in got[0]] == [("user", "hi"), ("assistant", "yo"), ("user", "x")]
    assert got[1] == [] and got[2] is None


def test_turns_and_buckets(spark):
    assert one(spark, text.count_turns(F.col("x")), "a\n \nb", "", "a", schema="x string") == [2, 1, 1]
    assert one(spark, text.turn_bucket(F.col("x").cast("int"), dims.TURN_BUCKETS), 1.0, 2.0, 6.0, 7.0, 16.0, 17.0, 2000.0) == ["17-999", "2-6", "2-6", "7-10", "11-16", "17-999", "17-999"]


def test_contexts_and_conversations(spark):
    assert one(spark, text.context_lines(F.col("x")), "user1: a [UTT]  [UTT] user2: b", schema="x string") == ["Speaker 1: a\nSpeaker 2: b"]
    assert one(spark, text.numbered_turns(F.col("x")), "lost\nSPK01-USA001: a\nmore\nSPK02-DEU002: b", schema="x string") == ["Turn 1 (Speaker 1): a more\nTurn 2 (Speaker 2): b"]


def test_replies(spark):
    cases = ['{"a": 1}', '```json\n{"a": {"score": 4, "reasoning": "x"},}\n```', "{'a': 2}", "[1, 2]", "no", "", None, 'so: {"a": 3} ok', '{"a": 1', "{'a': __import__('os')}"]
    got = [r[0] for r in replies.with_object(spark.createDataFrame([(c,) for c in cases], "x string"), "x").select("object").collect()]
    assert [g is not None for g in got] == [True, True, True, False, False, False, False, True, False, False]
    d = dims.Domain("co", "1-5", ("a",), ("a",))
    assert one(spark, replies.scored(F.col("x"), d)[0], *got[:3], schema="x string") == [0.0, 0.75, 0.25]


def test_continuation(spark):
    cases = [{"continuation": [{"role": "User", "content": "a"}, {"role": "assistant", "content": ["b", "c"]}]}, {"continuation": []}, {"continuation": [{"role": "judge", "content": "a"}]}, {"continuation": [{"role": "user"}]}, {}]
    got = one(spark, replies.continuation(F.col("x")), *map(json.dumps, cases), "junk", '{"continuation": [{"role": "user", "content": "a"}]} x', schema="x string")
    assert [(m["role"], m["content"]) for m in got[0]] == [("user", "a"), ("assistant", "b c")]
    assert got[1:] == [None] * 6


def test_evaluation_scores(spark):
    assert one(spark, replies.evaluation_scores(F.col("x")), '{"scores": {"a": 0.5, "b": 2}}', '{"scores": {"a": "x"}}', "{}", "[", schema="x string")[0] == {"a": 0.5, "b": 2.0}


def test_long_literals_are_parsed(spark):
    long = "{'topic_coherence': 4, 'note': '" + "x" * 1_200_000 + "'}"
    got = replies.with_object(spark.createDataFrame([(long,)], "reply string"), "reply").first()["object"]
    assert got is not None and json.loads(got)["topic_coherence"] == 4
