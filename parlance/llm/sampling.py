"""Problem 2: samples that match target shares of categories, from mergeable reservoirs filled in one pass.

Every row has a random priority that depends on its id and a seed only. A task's reservoir of a category holds the rows of
least priority that it has met, as many as the category's quota can be at most, and the number of all. Reservoirs of several
tasks or files are merged by putting them together: the least rows of all are among them, and numbers add up. After the
final counts the quotas are trimmed to what is there and each reservoir to its quota, uniformly, since priorities are random.
The input is read once; a quota may be any share of any number of rows and is met exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parlance.session import materialize, ship

#: Cells of priorities, by their first bits.
CELL_BITS, PRIORITY_BITS = 14, 60
#: Up to so many targets their quotas are known to every task; with more, reservoirs hold all rows.
MOST_TARGETS = 50_000
_RESERVOIR = "plan string, category string, id bigint, priority bigint, n bigint"


def _most(targets: DataFrame, upper: int | None) -> dict[tuple[str, str], int] | None:
    """The most rows that each category's quota can ask for, if the populations have ``upper`` rows at most; None: no bound."""
    rows = targets.select("plan", "category", "sample_pct", "target_pct", "min_rows").limit(MOST_TARGETS + 1).collect() if upper is not None else []
    if upper is None or len(rows) > MOST_TARGETS:
        return None
    out: dict[tuple[str, str], int] = {}
    for r in rows:
        quota = max(r["min_rows"] or 0, upper * (r["sample_pct"] or 0) * (r["target_pct"] or 0) // 10_000)
        out[r["plan"], r["category"]] = max(quota, out.get((r["plan"], r["category"]), 0))
    return out


def reservoirs(rows: DataFrame, targets: DataFrame, upper: int | None = None, seed: int = 42) -> DataFrame:
    """(plan, category, id, priority, n): the reservoirs of all tasks over ``rows``(plan, category, id), and in rows without a priority how many each has met.

    ``upper``: no plan has more rows than this, which bounds the reservoirs; without it they hold all rows of the targets'
    categories. Null categories and those without a target count for the population only. Rows repeated with one id are
    rows of their own.
    """
    ship(rows.sparkSession)
    most = _most(targets, upper)
    wanted = None if most is not None else {(r["plan"], r["category"]) for r in targets.select("plan", "category").distinct().limit(MOST_TARGETS).collect()}
    whole = wanted is not None and len(wanted) == MOST_TARGETS  # more targets than are told to tasks: every category is held
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "plan", F.col("id").cast("string"))), 1, PRIORITY_BITS // 4), 16, 10).cast("bigint")
    keyed = rows.select("plan", "category", "id", h.alias("priority"))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: dict[tuple, int] = {}
        held: dict[tuple, list[np.ndarray]] = {}

        def least(key: tuple, k: int | None) -> np.ndarray:
            both = np.concatenate(held[key])
            if k is not None and len(both) > k:
                both = both[np.lexsort((both[:, 1], both[:, 0]))[:k]]
            held[key] = [both]
            return both

        for pdf in batches:
            for (plan, category), own in pdf.groupby(["plan", "category"], dropna=False, sort=False):
                key = (plan, category if isinstance(category, str) else None)
                met[key] = met.get(key, 0) + len(own)
                k = most.get(key, 0) if most is not None else None if whole or key in wanted else 0
                own = own[own["id"].notna()]
                if k == 0 or key[1] is None or not len(own):
                    continue
                held.setdefault(key, []).append(np.stack((own["priority"].to_numpy(np.int64), own["id"].to_numpy(np.int64)), axis=1))
                if k is not None and sum(map(len, held[key])) > 2 * k + 10_000:
                    least(key, k)
        none = pd.array([None] * len(met), "Int64")
        yield pd.DataFrame({"plan": pd.Series([k[0] for k in met], dtype=object), "category": pd.Series([k[1] for k in met], dtype=object), "id": none, "priority": none, "n": pd.Series(list(met.values()), dtype="int64")})
        for key in list(held):
            both = least(key, most[key] if most is not None else None)
            for i in range(0, len(both), 50_000):
                part = both[i : i + 50_000]
                yield pd.DataFrame({"plan": np.full(len(part), key[0], object), "category": np.full(len(part), key[1], object), "id": pd.array(part[:, 1], "Int64"), "priority": pd.array(part[:, 0], "Int64"), "n": 0})
            del held[key]

    return materialize(keyed.mapInPandas(fill, _RESERVOIR), "reservoirs")


def merged(*parts: DataFrame) -> DataFrame:
    """The reservoirs of several parts of the data."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report(reservoir: DataFrame, targets: DataFrame) -> DataFrame:
    """One row for each row of ``targets``(plan, category, sample_pct, target_pct, min_rows).

    population: rows of the plan, of any category. required: the category's share of the sample, its minimum at least.
    taken: what can be given. achieved_pct: its share of all that the plan's sample takes. exhausted: fewer rows are
    available than required. A category or plan without rows is exhausted unless nothing is required of it.
    """
    by_category = reservoir.groupBy("plan", "category").agg(F.sum("n").alias("available"))
    population = by_category.groupBy("plan").agg(F.sum("available").alias("population"))
    out = targets.select("plan", "category", "sample_pct", "target_pct", "min_rows").join(population, "plan", "left").join(by_category, ["plan", "category"], "left")
    out = out.withColumns({"population": F.coalesce("population", F.lit(0)), "available": F.coalesce("available", F.lit(0))})
    share = F.expr("(population * sample_pct * target_pct) div 10000")
    out = out.withColumn("required", F.greatest(F.col("min_rows").cast("bigint"), share))
    out = out.withColumn("taken", F.least("available", "required")).withColumn("exhausted", F.col("available") < F.col("required"))
    return out.withColumn("achieved_pct", F.round(F.try_divide(F.col("taken") * 100.0, F.sum("taken").over(Window.partitionBy("plan"))), 6))


def sample(reservoir: DataFrame, targets: DataFrame) -> DataFrame:
    """(plan, category, id): the sample, exactly ``taken`` rows of each category of the report, from the reservoirs alone.

    The cell of priorities that a quota falls into is found from counts; rows of the cells before it are taken as they
    stand, and only those of that cell are ranked. Ties of priority are broken by id.
    """
    quotas = report(reservoir, targets).select("plan", "category", "taken")
    rows = reservoir.filter("priority is not null").select("plan", "category", "id", "priority", F.shiftright("priority", PRIORITY_BITS - CELL_BITS).cast("int").alias("cell"))
    cells = rows.groupBy("plan", "category", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("plan", "category").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    edge = cells.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).join(quotas, ["plan", "category"])
    # at most one cell of each category of the targets
    edge = edge.filter("ahead < taken and ahead + n >= taken").select("plan", "category", F.col("cell").alias("edge"), (F.col("taken") - F.col("ahead")).alias("need"))
    small = targets.limit(MOST_TARGETS + 1).count() <= MOST_TARGETS
    marked = rows.join(F.broadcast(edge) if small else edge, ["plan", "category"])
    whole = marked.filter("cell < edge").select("plan", "category", "id")
    place = F.row_number().over(Window.partitionBy("plan", "category").orderBy("priority", "id"))
    last = marked.filter("cell = edge").withColumn("place", place).filter("place <= need").select("plan", "category", "id")
    return whole.unionByName(last)
