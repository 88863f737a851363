"""The judge: an interface to whatever answers requests, and a stub that answers offline, always alike."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.dims import by_domain


class JudgeBackend(Protocol):
    def answer(self, requests: DataFrame) -> DataFrame:
        """(custom_id, status_code, reply, error) for ``requests``(custom_id, prompt, domain)."""


def stub_score(key: Column, dim: Column) -> Column:
    """A score of 0.00 to 1.00 from a hash of key and dimension."""
    return (F.conv(F.substring(F.md5(F.concat(key, F.lit("|"), dim)), 1, 4), 16, 10).cast("int") % 101) / F.lit(100.0)


class StubJudge:
    """Scores every dimension of the request's domain by hash."""

    @staticmethod
    def scores(under: Column | None) -> Column:
        """A reply's JSON for ``custom_id`` and ``domain``: 0 to 1 for each dimension, under a key of its own or, for judging, as the object itself on the domain's scale."""
        names = by_domain(F.col("domain"), lambda d: F.array(*map(F.lit, d.names)))
        if under is not None:
            return F.to_json(F.create_map(under, F.map_from_arrays(names, F.transform(names, lambda n: stub_score(F.col("custom_id"), n)))))
        five = F.col("domain").isin("coherence", "empathy")
        return F.to_json(F.map_from_arrays(names, F.transform(names, lambda n: F.when(five, F.round(1 + 4 * stub_score(F.col("custom_id"), n))).otherwise(stub_score(F.col("custom_id"), n)))))

    def answer(self, requests: DataFrame) -> DataFrame:
        names = by_domain(F.col("domain"), lambda d: F.array(*map(F.lit, d.names)))
        scores = F.map_from_arrays(names, F.transform(names, lambda n: stub_score(F.col("custom_id"), n)))
        return requests.select("custom_id", F.lit(200).alias("status_code"), F.to_json(F.struct(scores.alias("scores"))).alias("reply"), F.lit(None).cast("string").alias("error"))
