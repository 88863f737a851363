"""Problem 7: filling containers of fixed capacity by hierarchical residual packing.

Texts are sized in tokens of a public tokenizer. A text beyond the capacity gives as many full containers as it holds and
a remainder; nothing else is cut. Each task packs its pieces best-fit in decreasing order and emits its nearly full bins.
Its underfull bins become items of the next round, where fewer tasks pack the bins of several former ones, mixed anew, down
to a single task. All underfull bins are handed on that could still take another one; only a bin's number and fill travel
from round to round, and where a text is in the end is found by following these numbers. Where so many bins stay open that
one task would be too large for them, the tasks don't become fewer, and rounds go on while they still close bins.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.session import materialize, ship

#: Capacities are listed in the plan, so their number is bounded.
MOST_CAPACITIES = 1000
_ENCODERS: dict = {}


def _encoder(path: str | None):
    """A tiktoken encoder of a rank file; by default the 50k byte-level vocabulary of the public_tokenizers package."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens): whole texts; null and empty texts have no tokens."""

    ship(docs.sparkSession)

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoder(vocabulary).encode_ordinary
        return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), count(F.col(text_col)).alias("n_tokens"))


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: in decreasing order of size, into the fullest bin that has room, else a new one."""
    bins = np.empty(len(sizes), np.int64)
    free: list[tuple[int, int]] = []  # (room, bin), in order of room
    opened = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect_left(free, (size, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = capacity, opened
            opened += 1
        bins[i] = b
        if room > size:
            insort(free, (room - size, b))
    return bins


_PLACED = "pack_id int, item bigint, bin bigint, fill bigint"


def _packer(round_no: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity, part = int(pdf["capacity"].iloc[0]), int(pdf["part"].iloc[0])
        pdf = pdf.sort_values("item", kind="stable", ignore_index=True)
        sizes = pdf["size"].to_numpy(np.int64)
        bins = best_fit(sizes, capacity)
        fill = np.bincount(bins, sizes).astype(np.int64)
        number = (round_no << 56) + (part << 32) + bins
        return pd.DataFrame({"pack_id": pdf["pack_id"], "item": pdf["item"], "bin": number, "fill": fill[bins]})

    return run


def _round(items: DataFrame, round_no: int, parts: int) -> DataFrame:
    """(pack_id, item, bin, fill): the bin of each of ``items``(pack_id, capacity, item, size), packed in so many tasks for each capacity."""
    part = F.pmod(F.xxhash64("item", F.lit(round_no)), F.lit(parts)).cast("int")
    placed = items.withColumn("part", part).groupBy("pack_id", "part").applyInPandas(_packer(round_no), _PLACED)
    return materialize(placed, f"packed-{round_no}")


def _open(placed: DataFrame, capacities: DataFrame, nearly_full: float) -> DataFrame:
    """(pack_id, capacity, item, size): bins that are underfull, and have room for the emptiest bin of their capacity."""
    bins = placed.groupBy("pack_id", "bin").agg(F.first("fill").alias("size")).join(F.broadcast(capacities), "pack_id")
    bins = materialize(bins.filter(F.col("size") < F.col("capacity") * nearly_full), "open")
    least = F.broadcast(bins.groupBy("pack_id").agg(F.min("size").alias("least")))  # a row for each capacity
    return bins.join(least, "pack_id").filter("capacity - size >= least").select("pack_id", "capacity", F.col("bin").alias("item"), "size")


def pack(sized: DataFrame, capacities: DataFrame, per_task: int = 2_000, fan_in: int = 8, nearly_full: float = 0.99, max_parts: int = 1 << 20) -> DataFrame:
    """(pack_id, doc_id, piece, tokens, sequence_id): where each piece of each text of ``sized``(doc_id, n_tokens) goes.

    ``capacities``(pack_id, capacity_tokens) applies to every text, so the work grows with their number. A text without
    tokens takes no room and has no sequence. Containers never hold more than their capacity. Capacities below 1 are left
    out. Repeated rows are packed as often as they stand; rows without an id can't be told where they are and are left out.

    ``per_task``: items that a task packs, about. A round has an ``fan_in``-th of the tasks of the one before.
    """
    spark = sized.sparkSession
    ship(spark)
    sized = materialize(sized.select("doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")).filter("doc_id is not null"), "sized")
    n = sized.count()
    wanted = capacities.filter("capacity_tokens >= 1").select("pack_id", "capacity_tokens").limit(MOST_CAPACITIES + 1).collect()
    if len(wanted) > MOST_CAPACITIES:
        raise ValueError(f"more than {MOST_CAPACITIES} capacities; pack them in several calls")
    own = spark.createDataFrame([(int(r["pack_id"]), int(r["capacity_tokens"])) for r in wanted], "pack_id int, capacity bigint")
    each = F.array(*[F.struct(F.lit(r["pack_id"]).cast("int").alias("pack_id"), F.lit(r["capacity_tokens"]).cast("bigint").alias("capacity")) for r in wanted])
    pairs = sized.select("doc_id", "n_tokens", F.explode(each.cast("array<struct<pack_id:int,capacity:bigint>>")).alias("p")).select("p.pack_id", "p.capacity", "doc_id", "n_tokens")
    empty = pairs.filter("n_tokens = 0").select("pack_id", "doc_id", F.lit(0).cast("bigint").alias("piece"), F.lit(0).cast("bigint").alias("tokens"), F.lit(None).cast("string").alias("sequence_id"))
    cut = pairs.filter("n_tokens > 0").withColumns({"whole": F.expr("n_tokens div capacity"), "rest": F.expr("n_tokens % capacity")})
    full = cut.filter("whole > 0").select("pack_id", "capacity", "doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)).alias("piece"))
    full = full.select("pack_id", "doc_id", "piece", F.col("capacity").alias("tokens"), F.format_string("%d-full-%d-%d", "pack_id", "doc_id", "piece").alias("sequence_id"))
    # numbered once and written, so that an item keeps its number
    pieces = materialize(cut.filter("rest > 0").select("pack_id", "capacity", "doc_id", F.col("whole").alias("piece"), F.col("rest").alias("tokens"), F.monotonically_increasing_id().alias("item")), "pieces")

    parts = max(1, min(max_parts, -(-n // per_task)))
    rounds = [_round(pieces.select("pack_id", "capacity", "item", F.col("tokens").alias("size")), 0, parts)]
    before = None
    while parts > 1 or (before or 0) > per_task:
        left = materialize(_open(rounds[-1], own, nearly_full), "left")
        n_left = left.groupBy("pack_id").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
        parts = max(1, -(-parts // fan_in), -(-n_left // per_task)) if n_left else 1
        if n_left < 2 or before is not None and parts > 1 and n_left > 0.999 * before:
            break
        rounds.append(_round(left, len(rounds), min(parts, max_parts)))
        before = n_left if parts > 1 else None
    # the last bin of each bin that was an item again, from the last round back
    last = None
    for placed in reversed(rounds[1:]):
        step = placed.select("pack_id", F.col("item").alias("bin"), F.col("bin").alias("next"))
        if last is not None:
            step = step.join(last.select("pack_id", F.col("bin").alias("next"), F.col("next").alias("then")), ["pack_id", "next"], "left").select("pack_id", "bin", F.coalesce("then", "next").alias("next"))
        last = materialize(step, "last")
    packed = rounds[0].select("pack_id", "item", "bin")
    if last is not None:
        packed = packed.join(last, ["pack_id", "bin"], "left").select("pack_id", "item", F.coalesce("next", "bin").alias("bin"))
    packed = pieces.select("pack_id", "item", "doc_id", "piece", "tokens").join(packed, ["pack_id", "item"]).select("pack_id", "doc_id", "piece", "tokens", F.format_string("%d-%d", "pack_id", "bin").alias("sequence_id"))
    return empty.unionByName(full).unionByName(packed)


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(pack_id, capacity_tokens, sequences, tokens, room_left): how well the containers are filled."""
    by_pack = packed.filter("sequence_id is not null").groupBy("pack_id", "sequence_id").agg(F.sum("tokens").alias("t"))
    by_pack = by_pack.groupBy("pack_id").agg(F.count("*").alias("sequences"), F.sum("t").alias("tokens"))
    return capacities.join(by_pack, "pack_id").select("pack_id", "capacity_tokens", "sequences", "tokens", (1 - F.col("tokens") / (F.col("sequences") * F.col("capacity_tokens"))).alias("room_left"))
