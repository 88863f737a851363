import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from parlance.llm import near, sketch

WORD = re.compile(r"[^\W_]+")


def shingles(t, k=3):
    w = WORD.findall((t or "").lower())
    return frozenset(zip(*[w[i:] for i in range(k)]))


def similar(a, b, t=0.5):
    return bool(a and b) and len(a & b) >= t * len(a | b)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    out = []
    for _ in range(n):
        base = rng.choices(words, k=rng.randrange(12, 80))
        out.append(" ".join(base))
        for _ in range(rng.randrange(3)):
            edited = list(base)
            for _ in range(rng.randrange(4)):
                edited[rng.randrange(len(edited))] = rng.choice(words)
            out.append(" ".join(edited))
    return out


def test_pairs_equal_brute_force(spark):
    texts = corpus(1, 150) + [None, "", "one two", "one two", "?!", "ONE, two; three", "one two three"] + ["same same same text again"] * 9 + [None] * 2
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + [(None, texts[0], "x"), (None, None, None)], "id bigint, text string, class_id string")
    sets = {i: shingles(t) for i, t, _ in rows}
    want = {(a, b) for a, b in itertools.combinations(sets, 2) if similar(sets[a], sets[b])}
    found = near.near(df, near.Params(width=3, threshold=0.5, rows=4, bands=48))
    got = [tuple(r) for r in near.row_pairs(found).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # groups are the components of all pairs, though not all pairs are looked at
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in want:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    groups = near.grouped(df, near.Params(width=3, threshold=0.5, rows=4, bands=48)).collect()
    assert {r["id"]: r["group_id"] for r in groups} == {i: root(i) for p in want for i in p} and len(groups) == len({r["id"] for r in groups})


def test_groups_of_any_ids(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(-5, text), (-(2**63), text + " eleven"), (2**63 - 1, text + " twelve"), (3, "of something else entirely, a few words"), (None, text)]
    got = near.grouped(spark.createDataFrame(rows, "id bigint, text string"), near.Params(width=3, threshold=0.5, rows=4, bands=48)).collect()
    assert sorted(map(tuple, got)) == [(-(2**63), -(2**63), -(2**63)), (-5, -5, -(2**63)), (2**63 - 1, 2**63 - 1, -(2**63))]


def test_families_are_grouped_without_all_their_pairs(spark, monkeypatch):
    """A family of near copies costs about a pair for each member, and a chain of buckets still comes out as one group."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:50] + [f"x{i}"]) for i in range(700)] + [" ".join(words[k : k + 20]) for k in range(0, 40, 4)]
    looked = []
    verified = near._verified
    monkeypatch.setattr(near, "_verified", lambda made, pairs, p: looked.append(pairs.count()) or verified(made, pairs, p))
    got = near.grouped(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string"), near.Params(width=3, threshold=0.5, rows=4, bands=32, hot_bucket=100)).collect()
    assert len({r["group_id"] for r in got if r["id"] < 700}) == 1 and len([r for r in got if r["id"] < 700]) == 700
    assert len({r["group_id"] for r in got if r["id"] >= 700}) == 1 and sum(looked) < 60 * 700


def test_hot_buckets_lose_nothing(spark):
    texts = corpus(2, 60)
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    p = near.Params(width=3, threshold=0.5, rows=4, bands=48)
    few = {tuple(r) for r in near.row_pairs(near.near(df, p._replace(hot_bucket=1)), hot=2).collect()}
    assert few == {tuple(r) for r in near.row_pairs(near.near(df, p)).collect()} and few


def test_heavy_buckets_lose_nothing(spark):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[:30] + [f"x{i}"]) for i in range(120)]
    df = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "id bigint, text string, side tinyint")
    p = near.Params(width=3, threshold=0.5, rows=4, bands=16, sample_in=1, hot_bucket=10, salts=4)
    assert near._heavy(near.materialize(df.mapInPandas(near._sketcher(p), near._ROW), "t"), p) is not None
    assert {tuple(r) for r in near.row_pairs(near.near(df.drop("side"), p)).collect()} == set(itertools.combinations(range(120), 2))
    assert {tuple(r) for r in near.sided_pairs(near.near(df, p, sided=True), hot=7).collect()} == {(a, b) for a in range(0, 120, 2) for b in range(1, 120, 2)}


def test_blocks_give_all_pairs_of_a_bucket_once(spark):
    kept = spark.createDataFrame([(1, c, c % 2) for c in range(40)], "key bigint, c bigint, side tinyint")
    assert {tuple(r) for r in near.bucket_pairs(kept, 7, False).collect()} == set(itertools.combinations(range(40), 2))
    assert {tuple(r) for r in near.bucket_pairs(kept, 7, True).collect()} == {(a, b) for a in range(0, 40, 2) for b in range(1, 40, 2)}


def test_sided_pairs_equal_brute_force(spark):
    texts = corpus(3, 100) + ["same words in all of these"] * 6
    rng = random.Random(4)
    rows = [(i, t, rng.randrange(2)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id bigint, text string, side tinyint")
    sets = {i: (shingles(t), s) for i, t, s in rows}
    want = {(a, b) for a in sets for b in sets if sets[a][1] == 0 and sets[b][1] == 1 and similar(sets[a][0], sets[b][0])}
    got = [tuple(r) for r in near.sided_pairs(near.near(df, near.Params(width=3, threshold=0.5, rows=4, bands=48, kind="low"), sided=True)).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "id bigint, text string")
    assert near.row_pairs(near.near(df, near.Params())).count() == 0


def test_default_threshold(spark):
    w = [f"x{i}" for i in range(100)]
    texts = [" ".join(w), " ".join(w[:98] + ["y", "z"]), " ".join(w[:60] + [f"q{i}" for i in range(40)])]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    assert [tuple(r) for r in near.row_pairs(near.near(df, near.Params())).collect()] == [(0, 1)]


def test_registers_and_estimates():
    rng = np.random.default_rng(5)
    universe = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    a, b = universe[:1000], universe[500:]
    for kind, registers in (("hyper", sketch.hyper_registers), ("low", sketch.low_registers)):
        r = [registers(sketch.minima(np.sort(x), np.array([0]), 2048, 1))[0] for x in (a, b)]
        equal, chance = (r[0] == r[1]).mean(), sketch.chance_collision(kind)
        assert abs((equal - chance) / (1 - chance) - 1 / 3) < 0.05


def test_packing_of_sets_is_exact():
    h = np.sort(np.random.default_rng(6).integers(0, 2**63, 50, dtype=np.uint64))
    assert (sketch.unpack(sketch.pack(h)) == (h & np.uint64(2**40 - 1))).all()


def test_long_text(spark):
    t = " ".join(f"w{i}" for i in range(100_000))
    df = spark.createDataFrame([(1, t), (2, t + " end"), (3, "short text of few words")], "id bigint, text string")
    assert [tuple(r) for r in near.row_pairs(near.near(df, near.Params())).select("id_a", "id_b").filter(F.lit(True)).collect()] == [(1, 2)]
