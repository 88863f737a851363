"""Sources, sinks, prompts, the pipeline and the stream, over files in a temporary folder."""

import json

import pytest
from pyspark.sql import functions as F

from parlance.functions.dims import ALL_DIMS, DOMAINS
from parlance.plans import judge, pipeline, prompts, registry
from parlance.sources import readers, writers
from parlance.streaming import replies as stream


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return str(path)


def reply(custom_id, content, code=200):
    return {"custom_id": custom_id, "response": {"status_code": code, "body": {"model": "m", "choices": [{"message": {"content": content}}]}}, "error": None}


def test_raw_corpora(spark, tmp_path):
    assert [tuple(r) for r in readers.coherence(spark, write(tmp_path / "c.json", {"dialogue": ["a", None, "b"], "labels": ["Yes", "No", "No"]})).collect()] == [(0, "a", "Yes"), (2, "b", "No")]
    with pytest.raises(Exception, match="differ in length"):
        readers.coherence(spark, write(tmp_path / "d.json", {"dialogue": ["a"], "labels": []})).collect()
    for i, x in enumerate((["a", {"content": "b"}, {"dialogue": "c"}, {"other": 1}], {"dialogues": ["a", {"input": "b"}]})):
        got = [r["content"] for r in readers.empathy(spark, write(tmp_path / f"e{i}.json", x)).collect()]
        assert got == [["a", "b", "c"], ["a", "b"]][i]
    tsv = write(tmp_path / "t.tsv", "PID\tCTX\txWant_response", 'P1\t"a ""q"" b"\tw', "P2\tc\t")
    df = readers.commonsense(spark, tsv, tsv)
    assert df.count() == 4 and df.filter("PID = 'P1'").first()["CTX"] == 'a "q" b'
    m = df.select("PID", readers.relation_responses(df).alias("m")).filter("PID = 'P1'").first()["m"]
    assert m["xWant"] == "w" and m["xAttr"] == "" and len(m) == 7
    write(tmp_path / "countries" / "x.csv", "uid,conversation", 'u1,"SPK01-AAA001: a\nSPK02-AAA002: b"')
    r = readers.multicultural(spark, str(tmp_path / "countries")).first()
    assert r["source_file"] == "x" and r["conversation"].count("\n") == 1
    assert [tuple(r) for r in readers.gold(spark, write(tmp_path / "g.json", [{"pid": "p", "gold": "xWant", "more": 1}])).collect()] == [(0, "p", "xWant")]


def test_lines(spark, tmp_path):
    path = write(tmp_path / "r" / "batch_1.jsonl", reply("a", "x"), "broken {", "", reply("b", "y", 500), {"custom_id": "c"}, "[1]")
    got = {r["custom_id"]: (r["status_code"], r["reply"], r["status"]) for r in readers.replies(spark, path).collect()}
    assert got == {"a": (200, "x", "Success"), "b": (500, "y", "Failed"), "c": (0, "", "Failed")}
    path = write(tmp_path / "m.jsonl", {"custom_id": "a", "content": "x", "extra": 1}, "junk", {"content": "no id"})
    assert [r["custom_id"] for r in readers.manifest(spark, path).collect()] == ["a"]
    path = write(tmp_path / "s.jsonl", {"custom_id": "a", "n": 1}, {"custom_id": "a", "n": 2}, {"n": 3})
    assert [json.loads(r["line"])["n"] for r in readers.request_lines(spark, path).collect()] == [2]
    old = {"stage_1_dialogue_id": "d1", "source": "coherence", "messages": [{"role": "user", "content": "x"}], "co_topic_coherence": 0.5}
    path = write(tmp_path / "e.jsonl", old, {"dialogue_id": "d2", "domain": "empathy", "messages": [], "scores": {"em_emotional_awareness": 0.1}}, {"dialogue_id": "d3", "domain": "odd", "scores": {"co_topic_coherence": 1}}, {"dialogue_id": "d4", "domain": "empathy", "scores": {}}, "bad")
    assert {r["dialogue_id"]: r["domain"] for r in readers.entries(spark, path).collect()} == {"d1": "coherence", "d2": "empathy"}


def test_request_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "hi"\nnow', "s_0001"), ("b", "x", "s_0002")], "custom_id string, prompt string, shard string")
    writers.request_shards(df.select("shard", writers.envelope(F.col("custom_id"), F.col("prompt")).alias("line")), str(tmp_path / "out"))
    back = {r["custom_id"]: json.loads(r["line"]) for r in readers.request_lines(spark, str(tmp_path / "out" / "*")).collect()}
    assert back["a"]["body"]["messages"] == [{"role": "user", "content": 'say "hi"\nnow'}] and back["a"]["body"]["temperature"] == 0 and back["b"]["body"]["response_format"] == {"type": "json_object"}


def test_prompts(spark):
    df = spark.createDataFrame([("Human A: x\nHuman B: y", "user1: a [UTT] user2: b", "t", {"xWant": "w", "xAttr": " "}), ("", "", "t", None)], "content string, ctx string, seg string, rel map<string,string>")
    a, b = df.select(prompts.whole_number_judge(F.col("content"), DOMAINS["empathy"]), prompts.commonsense_judges(F.col("ctx"), F.col("seg"), F.col("rel"))).collect()
    assert "Human B: y" in a[0] and all(d in a[0] for d in DOMAINS["empathy"].dims) and b[0] is None and b[1] is None
    assert [p["part"] for p in a[1]] == ["dim", "dlg"] and "Speaker 2: b" in a[1][0]["prompt"] and "xWant: w" in a[1][0]["prompt"] and "xAttr: (not available)" in a[1][0]["prompt"] and "xWant" not in a[1][1]["prompt"]
    m = spark.createDataFrame([("SPK01-USA001: hi", "s", "A", None), ("no turns", "s", "A", "B")], "c string, s string, a string, b string").select(prompts.multicultural_judge(F.col("c"), F.col("s"), F.col("a"), F.col("b"))).collect()
    assert "Turn 1 (Speaker 1): hi" in m[0][0] and m[1][0] is None
    assert [r[0] for r in spark.createDataFrame([(0.125,), (0.3,)], "x double").select(prompts.two_places(F.col("x"))).collect()] == ["0.12", "0.30"]


def test_generation_prompts(spark):
    rows = registry.generation_prompts(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r["prompt"] and "CONTINUATION" in r["prompt"] for r in rows)
    targeted = [r["prompt"] for r in rows if "-dt-" in r["custom_id"]]
    assert all("target dimension alone" in p for p in targeted)


def test_pipeline_over_files(spark, tmp_path):
    root = tmp_path / "root"
    for name, d in DOMAINS.items():
        ids = [f"{d.prefix}-{i}" for i in range(40)]
        write(root / "manifest" / name / "m.jsonl", *({"custom_id": i, "content": "Human A: one\nHuman B: two\nHuman A: three", "uid": i, "pid": i} for i in ids))
        raw = {n: (1 + k % 5 if d.scale == "1-5" else k / 10) for k, n in enumerate(d.names)}
        if name == "commonsense":
            lines = [reply(f"{i}-{s}", json.dumps(raw)) for i in ids for s in ("dim", "dlg")]
        else:
            lines = [reply(i, "```json\n" + json.dumps(raw) + "\n```") for i in ids[1:]]
        write(root / "replies" / name / "batch_1.jsonl", *lines)
    good, failed = pipeline.parse(spark, str(root), "empathy")
    assert good.count() == 39 and [tuple(r) for r in failed.collect()] == [("em-0", "missing_from_batch")]
    pipeline.main(["merge", "--root", str(root)])
    entries = readers.entries(spark, str(root / "entries"))
    assert entries.count() == 157 and entries.filter("split = 'test'").count() == 24
    pipeline.main(["select", "--root", str(root)])
    pipeline.main(["generate", "--root", str(root)])
    lines = readers.request_lines(spark, str(root / "requests" / "generation" / "*")).collect()
    assert len(lines) == spark.read.json(str(root / "candidates")).count() > 0
    written = {"continuation": [{"role": "Assistant", "content": "new"}]}
    write(root / "replies" / "generation" / "batch_1.jsonl", *(reply(r["custom_id"], json.dumps(written)) for r in lines), reply("s2g-odd", json.dumps(written)))
    made = pipeline.variants(readers.replies(spark, str(root / "replies" / "generation")), spark.read.json(str(root / "manifest" / "generation")))
    assert made.count() == len(lines)
    scores = json.dumps({"scores": dict.fromkeys(ALL_DIMS, 0.99)})
    write(root / "replies" / "evaluation" / "batch_1.jsonl", *(reply(f"s2v-{r['variant_id']}", scores) for r in made.collect()))
    pipeline.main(["pairs", "--root", str(root)])
    pairs = readers.pairs(spark, str(root / "pairs"))
    assert pairs.count() > 0 and pairs.first()["metadata"]["split"] == "train"
    assert pipeline.evaluate(made, entries, judge.StubJudge()).count() == made.count()


@pytest.mark.parametrize(
    ("domain", "given"),
    [
        ("coherence", {1: 0.0, 2: 0.25, 3: 0.5, 3.6: 0.75, 5: 1.0, 7: 1.0}),
        ("empathy", {"1": 0.0, 0: 0.0, 4: 0.75, "x": None}),
        ("multicultural", {0: 0.0, 1: 1.0, 1.2: 1.0, 0.126: 0.13, -1: 0.0, "x": None}),
        ("commonsense", {0: 0.0, 1: 1.0, 1.2: 1.0}),
    ],
)
def test_scores_of_replies_on_one_scale(spark, tmp_path, domain, given):
    d, root = DOMAINS[domain], tmp_path / "root"
    for name in DOMAINS:
        ids = [f"{DOMAINS[name].prefix}-{k}" for k in range(len(given))]
        write(root / "manifest" / name / "m.jsonl", *({"custom_id": i, "content": "Human A: x"} for i in ids))
        lines = []
        for k, (i, v) in enumerate(zip(ids, given)):
            value = {"reasoning": "r", "score": v} if k % 2 and name != "commonsense" else v
            content = json.dumps({(n if k % 3 else dim): value for n, dim in zip(d.names, d.dims)})
            lines += [reply(f"{i}{s}", content) for s in (("-dim", "-dlg") if name == "commonsense" else ("",))]
        write(root / "replies" / name / "batch_1.jsonl", *(lines if name == domain else [reply("odd", "{}")]))
    got = {r["source_id"]: r["scores"] for r in pipeline.merged(spark, str(root)).collect()}
    want = {f"{d.prefix}-{k}": dict.fromkeys(d.names, w) for k, w in enumerate(given.values())}
    assert {i: {n: s[n] for n in d.names} for i, s in got.items()} == want
    assert all(s[n] is None for s in got.values() for n in ALL_DIMS if n not in d.names)


def test_merge_step_looks_metadata_up(spark, tmp_path):
    root = tmp_path / "root"
    for name, d in DOMAINS.items():
        ids = [f"{d.prefix}-{i}" for i in range(3)]
        write(root / "manifest" / name / "m.jsonl", *({"custom_id": i, "content": "Human A: x", "uid": i, "pid": i} for i in ids))
        write(root / "replies" / name / "batch_1.jsonl", *(reply(f"{i}{s}", json.dumps(dict.fromkeys(d.names, 1))) for i in ids for s in (("-dim", "-dlg") if name == "commonsense" else ("",))))
    write(root / "raw" / "multicultural" / "a.csv", "uid,conversation,country_1,situation", "mu-0,c,A,one", "mu-1,c,B,", "mu-0,c,C,two", ",c,D,x")
    write(root / "raw" / "multicultural" / "a-b.csv", "uid,conversation,country_1,situation", "mu-0,c,E,early", "mu-9,c,F,x")
    write(root / "raw" / "gold.json", json.dumps([{"pid": "cs-0", "gold": ""}, {"pid": "cs-0", "gold": "xWant"}, {"pid": "cs-0", "gold": "xAttr"}, {"pid": "cs-1", "gold": "odd"}]))
    pipeline.main(["merge", "--root", str(root)])
    got = {r["source_id"]: r["domain_metadata"] for r in readers.entries(spark, str(root / "entries")).collect()}
    assert len(got) == 12 and {i for i, m in got.items() if m} == {"mu-0", "mu-1", "cs-0", "cs-1"}
    assert len(got["mu-0"]) == 15 and (got["mu-0"]["country_1"], got["mu-0"]["situation"], got["mu-0"]["country_2"]) == ("C", "two", "")
    assert (got["mu-1"]["country_1"], got["mu-1"]["situation"]) == ("B", "")
    assert got["cs-0"] == {"gold_relation": "xWant", "target_dimension": "cs_desire"} and got["cs-1"] == {"gold_relation": "odd", "target_dimension": ""}


def test_retry_and_evaluate_steps(spark, tmp_path, capsys):
    root = tmp_path / "root"
    for name, d in DOMAINS.items():
        ids = [f"{d.prefix}-{i:03}" for i in range(130 if name in ("empathy", "commonsense") else 3)]
        parts = ("-dim", "-dlg") if name == "commonsense" else ("",)
        good = json.dumps({n: 5 if d.scale == "1-5" else 0.9 for n in d.names})
        write(root / "manifest" / name / "m.jsonl", *({"custom_id": i, "content": "Human A: one\nHuman B: two\nHuman A: three"} for i in ids))
        write(root / "requests" / name / "shard=x" / "p.txt", *({"custom_id": f"{i}{p}", "body": "b"} for i in ids for p in parts if i != "em-129"))
        few = name in ("empathy", "commonsense")
        write(root / "replies" / name / "batch_1.jsonl", *(reply(f"{i}{p}", "no use" if few and i[-3:] >= "060" and p != "-dlg" else good) for i in ids for p in parts), *([reply("em-000", good)] if name == "empathy" else []))
    step = lambda name: pipeline.main([name, "--root", str(root)])
    step("retry")
    said = capsys.readouterr().out
    assert "empathy 69 requests to send again, 1 failed ids without a request" in said and "commonsense 70 requests" in said and "coherence 0 requests" in said
    sent = {d: [r["custom_id"] for r in readers.request_lines(spark, str(root / "requests" / "retry" / d / "1" / "*")).collect()] for d in ("empathy", "commonsense")}
    assert sorted(sent["empathy"]) == [f"em-{i:03}" for i in range(60, 129)] and sorted(sent["commonsense"]) == [f"cs-{i:03}-dim" for i in range(60, 130)]
    for name, ids in sent.items():
        d = DOMAINS[name]
        content = json.dumps({n: 1 if d.scale == "1-5" else 0.1 for n in d.names})
        write(root / "retries" / name / "1" / "batch_1.jsonl", *(reply(i, content) for i in ids))
    step("retry")
    assert "1 failures, held out" in capsys.readouterr().out
    step("merge")
    assert [json.loads(x) for f in (root / "failures").glob("*.json") for x in f.read_text().split("\n") if x] == [{"domain": "empathy", "custom_id": "em-129", "reason": "json_parse_error"}]
    entries = readers.entries(spark, str(root / "entries"))
    got = {r["source_id"]: r["scores"] for r in entries.collect()}
    assert entries.count() == len(got) == 129 + 130 + 6
    assert got["em-000"]["em_emotional_awareness"] == 1.0 and got["em-060"]["em_emotional_awareness"] == 0.0 and got["cs-060"]["cs_desire"] == 0.1 and got["cs-060"]["cs_empathy"] == 0.9
    step("generate")
    asked = readers.request_lines(spark, str(root / "requests" / "generation" / "*")).collect()
    written = json.dumps({"continuation": [{"role": "assistant", "content": "new"}]})
    write(root / "replies" / "generation" / "batch_1.jsonl", *(reply(r["custom_id"], written) for r in asked for _ in range(2)))
    step("evaluate")
    lines = {r["custom_id"]: json.loads(r["line"]) for r in readers.request_lines(spark, str(root / "requests" / "evaluation" / "*")).collect()}
    manifest = {r["custom_id"]: r for r in spark.read.json(str(root / "manifest" / "evaluation")).collect()}
    assert lines.keys() == manifest.keys() == {f"s2v-var-{r['custom_id']}" for r in asked} and len(asked) > 100
    assert all("Score the continuation" in x["body"]["messages"][0]["content"] for x in lines.values()) and all(m["stage_1_scores"] and m["candidate_id"] for m in manifest.values())


def test_prepare(spark, tmp_path, capsys):
    root = tmp_path / "root"
    write(root / "raw" / "coherence" / "c.json", {"dialogue": ["Human A: x\nHuman B: y", " Human A: x\nHuman B: y ", "", "z"], "labels": ["Yes", "No", "No", "Yes"]})
    write(root / "raw" / "empathy" / "e.json", ["one", {"content": "two"}, "one"])
    write(root / "raw" / "commonsense" / "train.tsv", "PID\tUID\tCTX\tSEG\txWant_response", "P1\tu\tuser1: a [UTT] user2: b\tc\tw", "P2\tu\t\tc\tw", "P1\tu\tuser1: a [UTT] user2: b\tc\tw", "\tu\tq\tr\t")
    write(root / "raw" / "multicultural" / "x.csv", "uid,conversation,statement_original,country_1,country_2", "u1,SPK01-AAA001: a,s,A,B", "u2,no turns,s,A,B")
    pipeline.main(["prepare", "--root", str(root)])
    assert "| total | duplicates | invalid | valid |" in capsys.readouterr().out
    ids = lambda d: sorted(r["custom_id"] for r in readers.request_lines(spark, str(root / "requests" / d / "*")).collect())
    assert len(ids("coherence")) == 2 and len(ids("empathy")) == 2 and ids("multicultural") == ["mu-u1"]
    cs = ids("commonsense")
    assert {"cs-P1-dim", "cs-P1-dlg"} <= set(cs) and len(cs) == 4
    m = {r["custom_id"]: r for r in readers.manifest(spark, str(root / "manifest" / "commonsense")).collect()}
    assert m["cs-P1"]["content"] == "Speaker 1: a\nSpeaker 2: b\nTarget: c" and len(m) == 2


def test_more_readers(spark, tmp_path):
    write(tmp_path / "f" / "other.jsonl", reply("a", "x"))
    assert [r["custom_id"] for r in readers.reply_folder(spark, str(tmp_path / "f")).collect()] == ["a"]
    write(tmp_path / "f" / "batch_1.jsonl", reply("b", "x"))
    assert [r["custom_id"] for r in readers.reply_folder(spark, str(tmp_path / "f")).collect()] == ["b"]
    bad = write(tmp_path / "g" / "batch_1.jsonl", reply("b", "x"), "broken {")
    with pytest.raises(Exception, match="no JSON"):
        readers.replies(spark, bad, strict=True).collect()
    write(tmp_path / "p" / "em_results.jsonl", {"_id": "em-1", "content": "x", "em_helpful_response": 0.5}, "junk", {"custom_id": "em-2"})
    assert sorted((r["source_id"], r["content"]) for r in readers.parsed_rows(spark, str(tmp_path / "p"), "empathy").collect()) == [("em-1", "x"), ("em-2", None)]
    write(tmp_path / "s" / "co_shard_0001.jsonl", "x" * 50)
    write(tmp_path / "s" / "em_shard_0001.jsonl", "x" * 500)
    assert {r["domain"]: r["fits"] for r in readers.shard_files(spark, str(tmp_path / "s"), 100).collect()} == {"co": True, "em": False}


def test_stream_of_replies(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder / "1.jsonl", reply("a", "x"), reply("b", "y", 500), "bad")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    run = lambda: stream.write_replies(stream.first_replies(stream.read_replies(spark, str(folder))), out, check).awaitTermination()
    run()
    write(folder / "2.jsonl", reply("a", "late"), reply("c", "z"))
    run()
    assert {r["custom_id"]: r["reply"] for r in spark.read.parquet(out).collect()} == {"a": "x", "b": "y", "c": "z"}
    q = stream.status_counts(stream.read_replies(spark, str(folder))).writeStream.format("memory").queryName("statuses").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("statuses").filter("status = 'Success'").agg(F.sum("count")).first()[0] >= 3


def test_all_steps_by_the_command_line(spark, tmp_path, capsys):
    """From raw files to reports by the command line alone; the stub judge answers, with a broken and a repeated reply, and one retry."""
    root = tmp_path / "root"
    talk = lambda i: f"Human A: one {i}\nHuman B: two {i}\nHuman A: three {i}\nHuman B: four {i}"
    write(root / "raw" / "coherence" / "c.json", {"dialogue": [talk(i) for i in range(40)], "labels": ["Yes", "No"] * 20})
    write(root / "raw" / "empathy" / "e.json", [talk(f"e{i}") for i in range(130)])
    write(root / "raw" / "commonsense" / "t.tsv", "PID\tUID\tCTX\tSEG\txWant_response", *(f"P{i}\tu\tuser1: a{i} [UTT] user2: b\tc\tw" for i in range(12)))
    write(root / "raw" / "multicultural" / "x.csv", "uid,conversation,statement_original,country_1,country_2,situation", *(f'u{i},"SPK01-AAA001: a{i}\nSPK02-BBB002: b",s,A,B,at a market' for i in range(12)))
    write(root / "raw" / "gold.json", json.dumps([{"pid": f"P{i}", "gold": "xWant"} for i in range(12)]))
    step = lambda *args: pipeline.main([*args, "--root", str(root)])
    step("prepare")
    assert {(r["domain"], r["fits"]) for r in readers.shard_files(spark, str(root / "requests" / "coherence")).collect()} == {("co", True)}
    assert [p.name for p in (root / "requests" / "commonsense").glob("*.jsonl")] == ["cs_shard_0001.jsonl"]
    step("run")
    # more than 100 replies break off: they are sent again and answered
    batch = sorted((root / "replies" / "empathy").glob("*.jsonl"))[0]
    lines = [json.loads(x) for f in sorted((root / "replies" / "empathy").glob("*.jsonl")) for x in f.read_text().split("\n") if x]
    for f in (root / "replies" / "empathy").glob("*"):
        f.unlink()
    for f in (root / "replies" / "empathy").glob(".*"):
        f.unlink()
    good = {x["custom_id"]: x for x in lines}
    write(batch, *(reply(i, "no use") if k < 110 else x for k, (i, x) in enumerate(sorted(good.items()))), *(list(good.values())[-1:] * 2))
    step("retry")
    again = [r["custom_id"] for r in readers.request_lines(spark, str(root / "requests" / "retry" / "empathy" / "1" / "*")).collect()]
    assert len(again) == 110
    write(root / "retries" / "empathy" / "1" / "batch_1.jsonl", *(good[i] for i in again))
    step("parse")
    assert "empathy\n130 parsed, 0 failed" in capsys.readouterr().out.replace("empathy 130", "empathy\n130")
    results = readers.parsed_rows(spark, str(root / "results" / "empathy"), "empathy").collect()
    assert len(results) == 130 and all("em_overall_empathy_score" in r["object"] for r in results)
    step("retry")
    assert "0 failures, held out" in capsys.readouterr().out
    step("merge")
    entries = readers.entries(spark, str(root / "entries"))
    assert entries.count() == 40 + 130 + 12 + 12
    assert entries.filter("domain_metadata['situation'] = 'at a market'").count() == 12 and entries.filter("domain_metadata['target_dimension'] = 'cs_desire'").count() == 12
    before = {r["dialogue_id"]: r["split"] for r in entries.collect()}
    step("split")
    assert {r["dialogue_id"]: r["split"] for r in readers.entries(spark, str(root / "entries")).collect()} == before
    step("select")
    step("generate")
    asked = readers.request_lines(spark, str(root / "requests" / "generation" / "*"))
    assert asked.filter("line like '%CULTURAL CONTEXT%at a market%'").count() > 0 and asked.filter("line like '%GUIDANCE%'").count() == asked.count()
    step("run")
    step("evaluate")
    step("run")
    step("pairs", "--margin-threshold", "0.1")
    step("analyze")
    said = capsys.readouterr().out
    pairs = readers.pairs(spark, str(root / "pairs"))
    assert pairs.count() == pairs.select("pair_id").distinct().count() > 0 and "margin_sensitivity" in said and "rows, 4 columns" in said
    dim = F.get("metadata.dimensions.target", F.lit(0))
    moved = pairs.select(F.abs(F.col("evaluation.stage_1_scores")[dim] - F.col("evaluation.stage_2_scores")[dim]).alias("d")).filter("d is not null")
    assert moved.filter("d <= 0.0999").count() == 0 < moved.count()
    assert not [f for f in (root / "failures_generation").glob("*.json") if f.read_text().strip()]


def test_all_at_once(spark, tmp_path, capsys):
    root = tmp_path / "root"
    write(root / "raw" / "coherence" / "c.json", {"dialogue": [f"Human A: one {i}\nHuman B: two {i}\nHuman A: three" for i in range(30)], "labels": ["Yes"] * 30})
    write(root / "raw" / "empathy" / "e.json", [f"Human A: one {i}\nHuman B: two" for i in range(30)])
    write(root / "raw" / "commonsense" / "t.tsv", "PID\tUID\tCTX\tSEG\txWant_response", *(f"P{i}\tu\tuser1: a{i} [UTT] user2: b\tc\tw" for i in range(10)))
    write(root / "raw" / "multicultural" / "x.csv", "uid,conversation,statement_original,country_1,country_2", *(f'u{i},"SPK01-AAA001: a{i}\nSPK02-BBB002: b",s,A,B' for i in range(10)))
    with pytest.warns(UserWarning, match="gold"):
        pipeline.main(["all", "--max-samples", "20", "--root", str(root)])
    assert readers.pairs(spark, str(root / "pairs")).count() > 0 and readers.manifest(spark, str(root / "manifest" / "coherence")).count() == 20


def test_rendered_prompts(spark, capsys):
    rows = prompts.rendered(spark).orderBy("ord").collect()
    assert [r["ord"] for r in rows] == list(range(1, 33)) and all("missed the last train" in r["prompt"] for r in rows)
    assert sum(r["kind"] == "evaluation" for r in rows) == 4 and sum("Exampleland" in r["prompt"] for r in rows) == 7


def test_missing_commonsense_files_are_warned_of(spark, tmp_path):
    tsv = write(tmp_path / "t.tsv", "PID\tCTX", "P1\tc")
    with pytest.warns(UserWarning, match="gone.tsv"):
        assert readers.commonsense(spark, tsv, str(tmp_path / "gone.tsv")).count() == 1
