"""Problem 4: splits that keep related records together, over an incremental table of components.

Sources are nodes, a key that they share (a pid) ties them. Components come from hub labels and pointer jumping, each
round written to the shared folder. The component table and the splits of its components are kept in a ``Store``, version
by version. A batch of new ties contracts the stored table first: its components are single nodes of the new graph, so a
batch costs what its own ties cost. Components that have a split keep it, new ones get one by filling the deficits of the
targets, and merges of components with different splits are quarantined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from parlance.functions.text import fold, strip
from parlance.operators.skew import HOT_ROWS, lookup_join
from parlance.session import materialize

#: Shares of the splits.
TARGETS = {"train": 0.75, "val": 0.10, "test": 0.15}
#: Hash buckets of the running sum: the first ten bits.
BUCKETS = 1 << 10


def tie_key(pid: Column) -> Column:
    """The pid trimmed, ignoring case; blank ones tie nothing."""
    return F.nullif(fold(strip(pid)), F.lit(""))


def ties(manifest: DataFrame, node: str = "custom_id", key: str = "pid") -> DataFrame:
    """Distinct (node, key), without nulls."""
    return manifest.select(F.col(node).alias("node"), tie_key(F.col(key)).alias("key")).dropna().distinct()


def connect(edges: DataFrame, hot_rows: int = HOT_ROWS, max_rounds: int = 60) -> DataFrame:
    """(name, is_key, component) of all nodes and keys of ``edges``(node, key): component is the least node of all that are tied together, directly or through others.

    A round takes the least label of each key, then the least of each node's keys, then lets every label jump to its own
    label. Both minima are combined before the shuffle; keys and nodes that tie a large share of all rows are looked up
    by broadcast of a bounded list, so a hub splits over all tasks.
    """
    edges = materialize(edges, "edges")
    labels = materialize(edges.groupBy("node").agg(F.count("*").alias("degree")).withColumn("label", F.col("node")), "labels-0")
    for i in range(max_rounds):
        labelled = lookup_join(edges, labels, ["node"], "degree", hot_rows)
        of_key = materialize(labelled.groupBy("key").agg(F.min("label").alias("least"), F.count("*").alias("nodes")), "keys")
        of_node = lookup_join(edges, of_key, ["key"], "nodes", hot_rows).groupBy("node").agg(F.min("least").alias("least"))
        step = materialize(labels.join(of_node.hint("merge"), "node").select("node", "degree", "label", "least"), "step")
        pointing = step.groupBy("least").agg(F.count("*").alias("pointing"))
        target = step.select(F.col("node").alias("least"), F.col("least").alias("jump")).join(pointing.hint("merge"), "least")
        jumped = lookup_join(step, target, ["least"], "pointing", hot_rows)
        labels = materialize(jumped.select("node", "degree", F.least("least", "jump").alias("new"), "label"), f"labels-{i + 1}")
        changed = labels.filter("new <> label").limit(1).count()
        labels = labels.select("node", "degree", F.col("new").alias("label"))
        if not changed:
            return labels.select(F.col("node").alias("name"), F.lit(False).alias("is_key"), F.col("label").alias("component")).unionByName(of_key.select(F.col("key").alias("name"), F.lit(True).alias("is_key"), F.col("least").alias("component")))
    raise RuntimeError(f"no end after {max_rounds} rounds")


def update_components(previous: DataFrame | None, edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The component table (name, is_key, component) after further ``edges``(node, key).

    ``previous`` is an earlier result, None at first. Only new ties are followed: nodes and keys that it knows stand for
    their component, and it is told which of its components are one now. The result equals that over all edges at once.
    """
    if previous is None:
        return connect(edges, hot_rows)
    edges = materialize(edges, "new-edges")
    nodes = previous.filter("not is_key").select(F.col("name").alias("node"), "component")
    keys = previous.filter("is_key").select(F.col("name").alias("key"), F.col("component").alias("node"))
    mapped = edges.join(nodes.hint("merge"), "node", "left").select(F.coalesce("component", "node").alias("node"), "key")
    known = edges.select("key").distinct().join(keys.hint("merge"), "key").select("node", "key")
    merged = connect(mapped.unionByName(known).distinct(), hot_rows)
    merged = materialize(merged, "merged")
    now = merged.filter("not is_key").select(F.col("name").alias("component"), F.col("component").alias("now"))
    old = previous.join(now.hint("merge"), "component", "left").select("name", "is_key", F.coalesce("now", "component").alias("component"))
    new = merged.join(previous.select("name", "is_key").hint("merge"), ["name", "is_key"], "left_anti").select("name", "is_key", "component")
    return old.unionByName(new)


def of_nodes(components: DataFrame) -> DataFrame:
    """(node, component) of a component table."""
    return components.filter("not is_key").select(F.col("name").alias("node"), "component")


class Store:
    """Versions of a component table and of its components' splits in a lasting folder.

    A version is a folder of its own, seen once it is written whole, so readers and later batches never meet half of one.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def version(self) -> int:
        """The latest version that is whole; 0 if there is none."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/v*/splits/_SUCCESS")
        found = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
        return max((int(f.getPath().getParent().getParent().getName()[1:]) for f in found), default=0)

    def components(self) -> DataFrame | None:
        """(name, is_key, component) of the latest version."""
        v = self.version()
        return self.spark.read.parquet(f"{self.folder}/v{v}/components") if v else None

    def splits(self) -> DataFrame | None:
        """(component, split, status) of the latest version."""
        v = self.version()
        return self.spark.read.parquet(f"{self.folder}/v{v}/splits") if v else None

    def add(self, edges: DataFrame, entries: DataFrame | None = None, targets: dict[str, float] | None = None) -> DataFrame:
        """The next version: ``edges``(node, key) tied in, and splits for the components of ``entries``(source_id, split), if given. Gives the splits."""
        v, held = self.version() + 1, self.splits()
        update_components(self.components(), edges).write.parquet(f"{self.folder}/v{v}/components")
        now = self.spark.read.parquet(f"{self.folder}/v{v}/components")
        if entries is not None:
            out = assign(with_splits(component_groups(entries, now), now, held), targets).select("component", "split", "status")
        else:
            out = held if held is not None else self.spark.createDataFrame([], "component string, split string, status string")
        out.write.parquet(f"{self.folder}/v{v}/splits")
        return self.splits()


def _sources(entries: DataFrame, components: DataFrame) -> DataFrame:
    """(source_id, component, rows, and rows of each split) of ``entries``(source_id, split). Sources in no component are one of their own."""
    counts = [F.count_if(F.col("split") == s).alias(f"n_{s}") for s in TARGETS]
    sources = entries.filter("source_id is not null").groupBy("source_id").agg(F.count("*").alias("rows"), F.min("split").alias("s_low"), F.max("split").alias("s_high"), *counts)
    known = of_nodes(components).withColumnRenamed("node", "source_id").hint("merge")
    return materialize(sources.join(known, "source_id", "left").withColumn("component", F.coalesce("component", "source_id")), "sources")


def _by_component(sources: DataFrame) -> DataFrame:
    counts = [F.sum(f"n_{s}").alias(f"n_{s}") for s in TARGETS]
    return sources.groupBy("component").agg(F.min("source_id").alias("group_key"), F.sum("rows").alias("group_rows"), F.count("*").alias("sources"), F.min("s_low").alias("low"), F.max("s_high").alias("high"), *counts)


def component_groups(entries: DataFrame, components: DataFrame) -> DataFrame:
    """(component, group_key, group_rows, sources, low, high, n_train, n_val, n_test): one row for each group of ``entries``.

    group_key: least source_id among the entries of its group; low and high: least and greatest non-null split there.
    Null sources are related to nothing and left out.
    """
    return materialize(_by_component(_sources(entries, components)), "groups")


def source_groups(entries: DataFrame, components: DataFrame) -> DataFrame:
    """(source_id, group_key, rows, group_rows, low, high): one row for each source, with what ``component_groups`` says of its group."""
    sources = _sources(entries, components)
    groups = materialize(_by_component(sources).select("component", "group_key", "group_rows", "sources", "low", "high"), "source-groups")
    return lookup_join(sources.select("source_id", "component", "rows"), groups, ["component"], "sources").select("source_id", "group_key", "rows", "group_rows", "low", "high")


def spread_rows(entries: DataFrame, components: DataFrame) -> DataFrame:
    """(entry_id, group_key): every row, null splits included, of a group whose rows are in two or more splits."""
    split = source_groups(entries, components).filter("low <> high").select("source_id", "group_key", "rows")
    return lookup_join(entries.select("entry_id", "source_id"), materialize(split, "spread"), ["source_id"], "rows").select("entry_id", "group_key")


def with_splits(groups: DataFrame, components: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """``groups`` of ``component_groups`` with split and status.

    kept: the split that the store holds for all of its components that have one, or else the one split that its rows are in.
    quarantined: the store holds different splits for components that are one now, or held one of them as quarantined; it
    has none. settled: the store holds nothing and its rows are in several splits; it gets the one that most of them are in,
    the first of equals. new: no row has a split. ``held``(component, split, status): the store's splits so far.
    """
    most = F.greatest(*[F.col(f"n_{s}") for s in TARGETS])
    majority = F.coalesce(*[F.when(F.col(f"n_{s}") == most, s) for s in TARGETS])
    first = F.when(F.col("low") == F.col("high"), F.col("low")).when(F.col("low").isNotNull(), majority)
    status = F.when(F.col("low").isNull(), "new").when(F.col("low") != F.col("high"), "settled").otherwise("kept")
    if held is None:
        return groups.withColumns({"split": first, "status": status})
    # where each component that the store knows has gone
    now = of_nodes(components).select(F.col("node").alias("component"), F.col("component").alias("now")).hint("merge")
    moved = held.join(now, "component", "left").select(F.coalesce("now", "component").alias("component"), "split", (F.col("status") == "quarantined").alias("apart"))
    moved = moved.groupBy("component").agg(F.min("split").alias("held_low"), F.max("split").alias("held_high"), F.max("apart").alias("apart"))
    out = groups.join(moved.hint("merge"), "component", "left")
    clash = F.coalesce(F.col("apart"), F.lit(False)) | F.coalesce(F.col("held_low") != F.col("held_high"), F.lit(False))
    out = out.withColumns({"split": F.when(clash, F.lit(None)).otherwise(F.coalesce("held_low", first)), "status": F.when(clash, "quarantined").when(F.col("held_low").isNotNull(), "kept").otherwise(status)})
    return out.drop("held_low", "held_high", "apart")


def assign(groups: DataFrame, targets: dict[str, float] | None = None, seed: int = 42) -> DataFrame:
    """``groups``(component, group_key, group_rows, split, status) with a split for the new ones: (component, group_key, group_rows, split, status).

    New groups fill, in hash order, what each split lacks of its share of all rows that aren't quarantined. The running sum
    over them is taken in two levels of hash buckets, so no task orders all of them.
    """
    targets = targets or TARGETS
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col("group_key")))
    groups = groups.select("component", "group_key", "group_rows", "split", "status", h.alias("h"), F.shiftright(F.conv(F.substring(h, 1, 3), 16, 10).cast("int"), 2).alias("b"))
    groups = materialize(groups, "unassigned")
    held = {r["split"]: r["n"] for r in groups.filter("status <> 'new'").groupBy("split").agg(F.sum("group_rows").alias("n")).filter(F.col("split").isin(*targets)).collect()}
    fresh = groups.filter("status = 'new'")
    buckets = fresh.groupBy("b").agg(F.sum("group_rows").alias("n"))
    total_new = buckets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total = total_new + sum(held.values())
    lacks = {s: max(0.0, share * total - held.get(s, 0)) for s, share in targets.items()}
    scale = total_new / (sum(lacks.values()) or 1)
    bounds, upto = [], 0.0
    for s, lack in lacks.items():
        upto += lack * scale
        bounds.append((s, upto))
    ahead = buckets.select("b", F.coalesce(F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    inside = F.sum("group_rows").over(Window.partitionBy("b").orderBy("h", "group_key").rowsBetween(Window.unboundedPreceding, -1))
    middle = F.col("ahead") + F.coalesce(inside, F.lit(0)) + F.col("group_rows") / 2
    choice = reduce(lambda c, x: c.when(middle <= x[1], x[0]), bounds[:-1], F.when(F.lit(False), "")).otherwise(bounds[-1][0])
    # at most BUCKETS rows
    new = fresh.join(F.broadcast(ahead), "b").select("component", "group_key", "group_rows", choice.alias("split"), "status")
    return groups.filter("status <> 'new'").select("component", "group_key", "group_rows", "split", "status").unionByName(new)
