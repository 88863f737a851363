"""Score arithmetic with exactly defined rounding, as JVM expressions."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def to_double(text: Column) -> Column:
    """A number written in decimal notation, else null; suffixes and hexadecimal forms that a cast accepts are no numbers."""
    return let(text, lambda t: F.when(t.rlike(NUMBER), F.trim(t).try_cast("double")))


def round2(x: Column) -> Column:
    """Round a double of [0, 1000) to two places as exact decimal arithmetic on its binary value does, ties to even.

    With k = floor(100 x), x is compared with the doubles next to the midpoint (2k + 1) / 200: only a value equal to the
    midpoint's double can be a tie in binary, and of those only multiples of 1/8 are true ties.
    """
    return let(x, lambda v: let(_floor100(v), lambda k: _nearest(v, k)))


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, so that expressions of expressions don't grow out of bounds."""
    return F.transform(F.array(value), body)[0]


def _floor100(x: Column) -> Column:
    k = F.floor(x * 100)
    return F.when(k / F.lit(100.0) > x, k - 1).when((k + 1) / F.lit(100.0) <= x, k + 1).otherwise(k)


def _nearest(x: Column, k: Column) -> Column:
    middle = (2 * k + 1) / F.lit(200.0)
    # the midpoint's double lies below or above the true midpoint, or on it when 8 x is whole
    tie = F.when(F.pmod(x * 8, F.lit(1.0)) == 0, F.pmod(k, F.lit(2)) == 1).otherwise(_double_above_midpoint(k))
    up = F.when(x > middle, F.lit(True)).when(x < middle, F.lit(False)).otherwise(tie)
    return F.when(up, (k + 1) / F.lit(100.0)).otherwise(k / F.lit(100.0))


def _double_above_midpoint(k: Column) -> Column:
    """Whether the double of (2k + 1) / 200 is above the true midpoint: its decimal expansion tells exactly."""
    middle = (2 * k + 1) / F.lit(200.0)
    # the product with 200 = 25 * 8 is taken apart without rounding error (Dekker); its error has the sign of the deviation
    t = middle * F.lit(134217729.0)
    high = t - (t - middle)
    low = middle - high
    product = middle * F.lit(200.0)
    error = (high * F.lit(200.0) - product) + low * F.lit(200.0)
    return (product - (2 * k + 1).cast("double")) + error > 0


def exact_mean(values: Column) -> Column:
    """Mean of an array of doubles, correctly rounded for score-like inputs; null for empty or null arrays. Null items don't count.

    Sums with Neumaier's compensation, then corrects the quotient by its exactly known remainder.
    """
    present = F.filter(values, lambda v: v.isNotNull())
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c"))

    def add(acc: Column, v: Column) -> Column:
        t = acc["s"] + v
        lost = F.when(F.abs(acc["s"]) >= F.abs(v), (acc["s"] - t) + v).otherwise((v - t) + acc["s"])
        return F.struct(t.alias("s"), (acc["c"] + lost).alias("c"))

    def finish(acc: Column) -> Column:
        n = F.size(present).cast("double")
        q = acc["s"] / n
        t = q * F.lit(134217729.0)
        high = t - (t - q)
        product = q * n
        error = (high * n - product) + (q - high) * n
        return q + (((acc["s"] - product) - error) + acc["c"]) / n

    return F.when(F.size(present) > 0, F.aggregate(present, zero, add, finish))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def coerce_score(x: Column) -> Column:
    """Whole score of 1 to 5: halves to even, clamped; null for no number."""
    return let(x, lambda v: F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), F.lit(None)).otherwise(clamp(F.rint(v), 1.0, 5.0).cast("int")))


def unit_from_five(score: Column) -> Column:
    """Scores of 1 to 5 on the scale of 0 to 1."""
    return round2((score - 1) / F.lit(4.0))


def coerce_unit(x: Column) -> Column:
    """Clamped to [0, 1] and rounded to two places; what is no number at all (NaN) counts as 0."""
    return let(x, lambda v: F.when(F.isnan(v), F.lit(0.0)).otherwise(round2(clamp(v, 0.0, 1.0))))


def normalize_score(x: Column) -> Column:
    """Values in [0, 1] stay, rounded; others are taken as of a scale of 1 to 5 and clamped. A raw 1 stays 1; NaN gives 1."""
    return let(x, lambda v: F.when(F.isnan(v), F.lit(1.0)).otherwise(round2(F.when((v >= 0) & (v <= 1), v).otherwise(clamp((v - 1) / F.lit(4.0), 0.0, 1.0)))))

