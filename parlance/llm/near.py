"""Problems 3 and 5: near-duplicate texts by sketches in banded buckets, estimation and exact verification.

One pass over the texts gives each row the 128-bit hash of its shingle set (its class: rows of equal sets are copies of
each other), and the registers of its sketch. Bands of registers are bucketed by class, copies collapsed within a task
before anything is shuffled. Buckets with one class fall away in the sort that follows; the others yield candidate pairs
of classes, hot buckets in blocks that are joined cell by cell, so no task meets a whole hot bucket. Candidates with a
collision-corrected estimate far below the threshold fall away; a second pass packs the shingle sets of the rest, which
are compared exactly. What comes out is a list of linked class pairs and the membership of rows in classes.

Nulls, empty texts and texts with fewer words than a shingle have an empty set, belong to no class and have no links.
Rows without an id, or without a side where there are two, are left out. Rows repeated with one id are paired with others as often as they stand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parlance.operators.skew import lookup_join
from parlance.session import materialize, ship, tasks_for

from . import sketch
from .components import connect, of_nodes


class Params(NamedTuple):
    """width: words of a shingle. Pairs of similarity ``threshold`` share a band with chance 1 - (1 - t^rows)^bands."""

    width: int = 5
    threshold: float = 0.8
    rows: int = 8
    bands: int = 24
    kind: str = "hyper"
    estimate_registers: int = 64
    sigmas: float = 4.0
    hot_bucket: int = 2_000
    sample_in: int = 64
    salts: int = 256
    bitmap_bits: int = 1 << 23


#: Most buckets that are handled as heavy.
MOST_HEAVY = 100_000


class Near(NamedTuple):
    """links(a, b, inter, total): pairs of class representatives, a < b unless sided. members(id, class_id, n_rows[, side])."""

    links: DataFrame
    members: DataFrame


_ROW = "id bigint, side tinyint, c1 bigint, c2 bigint, n int, fresh boolean, registers binary"


def _sketcher(p: Params) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int, int]] = set()
        for whole in batches:
            for k in range(0, len(whole), 256):
                pdf = whole.iloc[k : k + 256]
                h, at = sketch.shingle_sets(pdf["text"].tolist(), p.width)
                n = np.diff(at)
                has = n > 0
                if not has.any():
                    continue
                starts = at[:-1][has]
                c1 = (np.add.reduceat(sketch.mix(h, 11), starts) ^ n[has].astype(np.uint64)).view(np.int64)
                c2 = np.bitwise_xor.reduceat(sketch.mix(h, 12), starts).view(np.int64)
                side = pdf["side"].to_numpy()[has]
                low = sketch.minima(h, starts, p.rows * p.bands, 20_240)
                registers = sketch.hyper_registers(low) if p.kind == "hyper" else sketch.low_registers(low)
                fresh = []
                for key in zip(c1.tolist(), c2.tolist(), side.tolist()):
                    fresh.append(key not in seen)
                    seen.add(key)
                if len(seen) > 1_000_000:
                    seen.clear()
                yield pd.DataFrame({"id": pdf["id"].to_numpy()[has], "side": side, "c1": c1, "c2": c2, "n": n[has].astype(np.int32), "fresh": fresh, "registers": [r.tobytes() for r in registers]})

    return run


def _estimator(p: Params) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    chance, k, t = sketch.chance_collision(p.kind), p.estimate_registers, p.threshold
    least = t - p.sigmas * (t * (1 - t) / k) ** 0.5

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                a, b = (np.frombuffer(b"".join(map(bytes, pdf[c])), np.uint16).reshape(-1, k) for c in ("ra", "rb"))
                equal = (a == b).mean(axis=1)
                estimate = (equal - chance) / (1 - chance)
                na, nb = pdf["na"].to_numpy(), pdf["nb"].to_numpy()
                fits = np.minimum(na, nb) >= t * np.maximum(na, nb) - 1e-9
                yield pdf.loc[(estimate >= least) & fits, ["a", "b"]]

    return run


def _packer(p: Params, bitmap: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            slot = (sketch.mix(whole["id"].to_numpy(np.int64).view(np.uint64), 3) % np.uint64(p.bitmap_bits)).astype(np.int64)
            wanted = whole[(bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1]
            for k in range(0, len(wanted), 256):
                pdf = wanted.iloc[k : k + 256]
                h, at = sketch.shingle_sets(pdf["text"].tolist(), p.width)
                yield pd.DataFrame({"id": pdf["id"], "shingles": [sketch.pack(h[x:y]) for x, y in zip(at, at[1:])]})

    return run


def _verifier(p: Params) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    t = Fraction(str(p.threshold))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for a, b, sa, sb in zip(pdf["a"], pdf["b"], pdf["sa"], pdf["sb"]):
                x, y = sketch.unpack(sa), sketch.unpack(sb)
                both = np.concatenate((x, y))
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                total = len(both) - inter
                if inter * t.denominator >= t.numerator * total:
                    out.append((a, b, inter, total))
            yield pd.DataFrame(out, columns=["a", "b", "inter", "total"])

    return run


def _bits_of(ids: DataFrame, p: Params) -> np.ndarray:
    """A bitmap of fixed size over hashed ids: what comes to the driver is at most its bits, whatever the number of ids."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(p.bitmap_bits, bool)
        for pdf in batches:
            bits[(sketch.mix(pdf["id"].to_numpy(np.int64).view(np.uint64), 3) % np.uint64(p.bitmap_bits)).astype(np.int64)] = True
        packed = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.nonzero(packed)[0]
        for k in range(0, len(at), 10_000):
            yield pd.DataFrame({"slot": at[k : k + 10_000], "word": packed[at[k : k + 10_000]]})

    words = ids.mapInPandas(fold, "slot bigint, word bigint").groupBy("slot").agg(F.bit_or("word").alias("word")).toPandas()
    out = np.zeros(p.bitmap_bits // 64, np.int64)
    out[words["slot"].to_numpy(np.int64)] = words["word"].to_numpy(np.int64)
    return out.view(np.uint8)


def bucket_pairs(kept: DataFrame, hot: int, sided: bool) -> DataFrame:
    """Distinct pairs (ca, cb) of classes that share a bucket of ``kept``(key, c, side)."""
    return cell_pairs(kept, hot, sided).distinct()


def cell_pairs(kept: DataFrame, hot: int, sided: bool) -> DataFrame:
    """Pairs (ca, cb) of members of each bucket of ``kept``(key, c, side), each pair once for each bucket.

    A bucket of m rows is cut into g = ceil(m / hot) blocks; each of its pairs of blocks is a cell joined on its own, so a
    hot bucket is spread over g^2 / 2 cells and none of its pairs is lost.
    """
    sizes = kept.groupBy("key").agg(F.count("*").alias("m")).filter(F.col("m") > hot)
    sized = lookup_join(kept, sizes, ["key"], "m", how="left").withColumn("g", F.coalesce(F.ceil(F.col("m") / F.lit(hot)), F.lit(1)).cast("int"))
    sized = sized.withColumn("block", F.pmod(F.xxhash64("c"), F.col("g").cast("bigint")).cast("int"))
    if sided:
        left = sized.filter("side = 0").select("key", F.col("c").alias("ca"), F.col("block").alias("i"), F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("j"))
        right = sized.filter("side = 1").select("key", F.col("c").alias("cb"), F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("i"), F.col("block").alias("j"))
        return left.join(right, ["key", "i", "j"]).filter("ca <> cb").select("ca", "cb")
    left = sized.select("key", F.col("c").alias("ca"), F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.col("g") - 1)).alias("j"))
    right = sized.select("key", F.col("c").alias("cb"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"), F.col("block").alias("j"))
    pairs = left.join(right, ["key", "i", "j"]).filter("ca < cb or (i < j and ca <> cb)")
    return pairs.select(F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb"))


def _keyed(sketched: DataFrame, p: Params) -> DataFrame:
    """(c, side, key): a row for each band of each class."""
    part = F.transform(F.sequence(F.lit(0), F.lit(p.bands - 1)), lambda i: F.substring("registers", i * (2 * p.rows) + 1, F.lit(2 * p.rows)))
    return sketched.filter("fresh").select(F.col("c1").alias("c"), "side", F.posexplode(part).alias("band", "part")).select("c", "side", F.xxhash64("band", "part").alias("key"))


def _heavy(sketched: DataFrame, p: Params) -> DataFrame | None:
    """Keys of buckets that a sample of classes shows to be large, at most MOST_HEAVY of them; None if there are none.

    They only decide how buckets are spread over tasks; a large bucket that the sample misses comes out the same, later.
    """
    sample = sketched.filter(F.pmod(F.xxhash64("c1"), F.lit(p.sample_in)) == 0)
    n = sample.filter("fresh").count()
    least = max(p.hot_bucket // p.sample_in + 1, -(-n * p.bands // MOST_HEAVY), 8)
    found = materialize(_keyed(sample, p).groupBy("key").count().filter(F.col("count") >= least).select("key"), "heavy")
    return F.broadcast(found.withColumn("heavy", F.lit(True))) if found.limit(1).count() else None


def _buckets(sketched: DataFrame, p: Params, sided: bool) -> DataFrame:
    """(key, c, side) of buckets with two classes or more, for sided joins with both sides.

    One sort of each bucket drops repeated classes and buckets of one. Heavy buckets are sorted in parts, by class, and
    kept whole, so that no task sorts all of one.
    """
    keyed = _keyed(sketched, p)
    heavy = _heavy(sketched, p)
    salt = F.lit(0)
    if heavy is not None:
        keyed = keyed.join(heavy, "key", "left")
        salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("c"), F.lit(p.salts))).otherwise(0)
    keyed = keyed.withColumn("salt", salt)
    bucket = Window.partitionBy("key", "salt")
    inside = bucket.orderBy("c", "side")
    marked = keyed.withColumns({"before": F.lag("c").over(inside), "after": F.lead("c").over(inside)})
    border = "(c <> before or c <> after)"
    if sided:  # classes are told apart by side too, so a class stands in a bucket once for each side
        marked = marked.withColumns({"side_before": F.lag("side").over(inside), "side_after": F.lead("side").over(inside)})
        marked = marked.withColumn("sides", F.max("side").over(bucket) - F.min("side").over(bucket))
        border = "sides > 0 and (c <> before or c <> after or side <> side_before or side <> side_after)"
    if heavy is not None:
        border = f"coalesce(heavy, false) or {border}"
    return marked.filter(border).select("key", "c", "side")


class _Sketched(NamedTuple):
    """The rows as they are read, their sketches, and one row for each class: c, id, number of shingles, first registers."""

    rows: DataFrame
    sketches: DataFrame
    classes: DataFrame


def _sketched(rows: DataFrame, p: Params) -> _Sketched:
    rows = rows.select("id", "text", F.col("side") if "side" in rows.columns else F.lit(0).cast("tinyint").alias("side")).filter("id is not null and side is not null")
    spark = rows.sparkSession
    ship(spark)
    spread = rows.repartition(tasks_for(rows)) if rows.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism else rows
    sketches = materialize(spread.mapInPandas(_sketcher(p), _ROW), "sketches")
    classes = sketches.groupBy("c1", "c2").agg(F.min("id").alias("class_id"), F.count("*").alias("n_rows"), F.min("n").alias("n"), F.min(F.substring("registers", 1, 2 * p.estimate_registers)).alias("r"))
    return _Sketched(spread, sketches, classes)


def _verified(made: _Sketched, pairs: DataFrame, p: Params) -> DataFrame:
    """(a, b, inter, total): those of ``pairs``(ca, cb) that are as similar as asked for, by estimate and then by their shingles."""
    side = lambda s: made.classes.select(F.col("c1").alias(f"c{s}"), F.col("class_id").alias(s), F.col("n").alias(f"n{s}"), F.col("r").alias(f"r{s}")).hint("merge")
    likely = pairs.join(side("a"), "ca").drop("ca").join(side("b"), "cb").drop("cb")
    likely = materialize(likely.mapInPandas(_estimator(p), "a bigint, b bigint"), "likely")
    ends = likely.select(F.explode(F.array("a", "b")).alias("id"))
    sets = made.rows.select("id", "text").mapInPandas(_packer(p, _bits_of(ends, p)), "id bigint, shingles binary").dropDuplicates(["id"])
    # with how many links a set is wanted for on either side: that of a hub is not joined by one task
    sets = sets.join(likely.groupBy(F.col("a").alias("id")).agg(F.count("*").alias("as_a")).hint("merge"), "id", "left").join(likely.groupBy(F.col("b").alias("id")).agg(F.count("*").alias("as_b")).hint("merge"), "id", "left")
    sets = materialize(sets.filter("as_a is not null or as_b is not null"), "sets")
    both = likely
    for s in ("a", "b"):
        both = lookup_join(both, sets.filter(f"as_{s} is not null").select(F.col("id").alias(s), F.col("shingles").alias(f"s{s}"), F.col(f"as_{s}").alias("links")), [s], "links").drop("links")
    return materialize(both.mapInPandas(_verifier(p), "a bigint, b bigint, inter int, total int"), "links")


def _members(made: _Sketched) -> DataFrame:
    named = materialize(made.classes.select("c1", "c2", "class_id", "n_rows"), "classes")
    return lookup_join(made.sketches.select("id", "side", "c1", "c2"), named, ["c1", "c2"], "n_rows").select("id", "side", "class_id", "n_rows")


def near(rows: DataFrame, p: Params, sided: bool = False) -> Near:
    """Links between classes of ``rows``(id bigint, text string, side tinyint), and membership.

    ``sided``: only links between a class with a row of side 0 and one with a row of side 1 (a: side 0, b: side 1).
    """
    made = _sketched(rows, p)
    kept = materialize(_buckets(made.sketches, p, sided), "buckets")
    links = _verified(made, bucket_pairs(kept, p.hot_bucket, sided), p)
    if not sided:
        links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "inter", "total")
    return Near(links, _members(made))


def _tied(links: DataFrame) -> DataFrame:
    """(class_id, group_id): the least class of all that ``links``(a, b) tie together, for each class that has a link."""
    offset = F.lit(str(1 << 63)).cast("decimal(20,0)")
    name = lambda c: F.lpad((F.col(c).cast("decimal(20,0)") + offset).cast("string"), 20, "0")  # noqa: E731  in the order of ids, negative ones too
    number = lambda c: (F.col(c).cast("decimal(20,0)") - offset).cast("bigint")
    ends = links.select(F.concat_ws("|", "a", "b").alias("key"), F.explode(F.array(name("a"), name("b"))).alias("node"))
    return of_nodes(connect(ends.select("node", "key"))).select(number("node").alias("class_id"), number("component").alias("group_id"))


def grouped(rows: DataFrame, p: Params) -> DataFrame:
    """(id, class_id, group_id) of every row that has copies or linked texts, without a pair for each two texts of a group.

    class_id: least id of the row's copies. group_id: least class of all that links tie together. First each class of a
    bucket is held against the bucket's least one. After that only classes of one bucket that are in different groups
    so far can change anything: those outside of the bucket's largest group are held against all of it. So a family of m
    texts that are all near each other costs m pairs, not m * m / 2, and no link between groups is lost.
    """
    made = _sketched(rows, p)
    kept = materialize(_buckets(made.sketches, p, False).select("key", "c").distinct(), "buckets")
    hubs = kept.groupBy("key").agg(F.min("c").alias("ca"), F.count("*").alias("m"))
    stars = lookup_join(kept, hubs, ["key"], "m").filter("c <> ca").select(F.least("c", "ca").alias("ca"), F.greatest("c", "ca").alias("cb")).distinct()
    links = _verified(made, stars, p).select("a", "b")
    so_far = materialize(_tied(links), "groups-so-far")
    named = made.classes.select(F.col("c1").alias("c"), "class_id")
    own = named.join(so_far.hint("merge"), "class_id", "left").select("c", F.coalesce("group_id", "class_id").alias("g"))
    held = materialize(kept.join(own.hint("merge"), "c").select("key", "c", "g"), "bucket-groups")
    sizes = held.groupBy("key", "g").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("g", F.struct("n", "g")).alias("largest"), F.sum("n").alias("m"), F.count("*").alias("groups")).filter("groups > 1")
    mixed = materialize(lookup_join(held, sizes, ["key"], "m").select("key", "c", "g", "m", (F.col("g") != F.col("largest")).alias("outside")), "mixed")
    more = _verified(made, _across(mixed, p.hot_bucket), p).select("a", "b")
    tied = _tied(links.unionByName(more))
    found = _members(made).join(tied.hint("merge"), "class_id", "left").filter("n_rows > 1 or group_id is not null")
    return found.select("id", "class_id", F.coalesce("group_id", "class_id").alias("group_id"))


def _across(mixed: DataFrame, hot: int) -> DataFrame:
    """Distinct pairs (ca, cb) of classes of different groups of each bucket of ``mixed``(key, c, g, m, outside), one of them outside of the largest; buckets are cut into blocks as in cell_pairs."""
    cut = mixed.withColumn("blocks", F.ceil(F.col("m") / F.lit(hot)).cast("int")).withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks").cast("bigint")).cast("int"))
    left = cut.filter("outside").select("key", F.col("c").alias("x"), F.col("g").alias("gx"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    right = cut.select("key", F.col("c").alias("y"), F.col("g").alias("gy"), "block")
    return left.join(right, ["key", "block"]).filter("gx <> gy").select(F.least("x", "y").alias("ca"), F.greatest("x", "y").alias("cb")).distinct()


def row_pairs(found: Near, hot: int = 20_000) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair of rows that are copies or members of linked classes."""
    linked = found.links.select(F.explode(F.array("a", "b")).alias("class_id")).distinct()
    alone = found.members.filter("n_rows > 1")
    members = materialize(alone.unionByName(found.members.filter("n_rows = 1").join(linked, "class_id", "left_semi")).select("id", "class_id", "n_rows"), "members")
    x = members.select(F.col("id").alias("x"), F.col("class_id").alias("a"))
    y = members.select(F.col("id").alias("y"), F.col("class_id").alias("b"))
    across = found.links.select("a", "b").join(x, "a").join(y, "b")
    copies = members.filter("n_rows > 1")
    within = cell_pairs(copies.select(F.col("class_id").alias("key"), F.col("id").alias("c"), F.lit(0).alias("side")), hot, False).toDF("x", "y")
    return across.select("x", "y").unionByName(within.select("x", "y")).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def sided_pairs(found: Near, hot: int = 20_000) -> DataFrame:
    """(x, y): x of side 0, y of side 1, copies or members of linked classes."""
    linked = found.links.select(F.explode(F.array("a", "b")).alias("class_id")).distinct()
    two = found.members.groupBy("class_id").agg((F.max("side") - F.min("side")).alias("d")).filter("d > 0").select("class_id")
    members = materialize(found.members.join(linked.unionByName(two).distinct(), "class_id", "left_semi").select("id", "side", "class_id"), "members")
    x = members.filter("side = 0").select(F.col("id").alias("x"), F.col("class_id").alias("a"))
    y = members.filter("side = 1").select(F.col("id").alias("y"), F.col("class_id").alias("b"))
    within = cell_pairs(members.select(F.col("class_id").alias("key"), F.col("id").alias("c"), "side"), hot, True).toDF("x", "y")
    return found.links.select("a", "b").join(x, "a").join(y, "b").select("x", "y").unionByName(within)
