"""Problem 6: duplicates hidden by formatting, by canonical 128-bit prints counted with map-side combining."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import bare
from parlance.operators.skew import HOT_ROWS, lookup_join
from parlance.session import materialize

from .confusables import normalized

#: Unit separators of the canonical form; none of them is a letter or digit.
FIELD, RECORD = "\x1f", "\x1e"


#: Objects within objects have their keys put in order down to this depth.
DEPTH = 3


def _object(c: Column, depth: int) -> Column:
    """A JSON object key by key, its keys in order; null if it is none."""
    whole = F.trim(F.regexp_replace(c, r"(?U)^[\s\x{feff}]+|\s+$", ""))
    entries = F.map_entries(F.from_json(F.when(whole.startswith("{") & whole.endswith("}"), whole), "map<string,string>"))
    value = lambda v: F.coalesce(_object(v, depth - 1), bare(v), F.lit("")) if depth > 1 else F.coalesce(bare(v), F.lit(""))
    pairs = F.array_sort(F.transform(entries, lambda e: F.concat(bare(e["key"]), F.lit(FIELD), value(e["value"]))))
    return F.concat(F.lit("{"), F.array_join(pairs, RECORD))


def canonical_text(c: Column) -> Column:
    """Letters and digits, ignoring case; a JSON object key by key, its keys in order, those of objects within it, too. Null stays null."""
    return F.coalesce(_object(c, DEPTH), bare(c))


def in_plain_characters(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rows`` with their text in the one form of problem 9, so that composed and decomposed letters, full-width ones and look-alikes are equal before ``prints``."""
    return normalized(rows, id_col, text_col).select(F.col("doc_id").alias(id_col), F.col("clean").alias(text_col))


def canonical_messages(c: Column) -> Column:
    """Number of messages, and of each its role and its letters and digits, ignoring case. Null stays null."""
    part = F.transform(c, lambda m: F.concat(F.coalesce(F.lower(m["role"]), F.lit("")), F.lit(FIELD), F.coalesce(bare(m["content"]), F.lit(""))))
    return F.when(c.isNotNull(), F.concat(F.size(c).cast("string"), F.lit(RECORD), F.array_join(part, RECORD)))


def prints(rows: DataFrame, id_col: str, canonical: Column) -> DataFrame:
    """(record_id, print, checked): the 128-bit print, and an independent 64-bit check of the same form.

    Records of null content have no form and are copies of nothing; empty ones are copies of each other.
    """
    form = rows.select(F.col(id_col).alias("record_id"), canonical.alias("form")).filter("form is not null")
    return form.select("record_id", F.unhex(F.md5("form")).alias("print"), F.xxhash64("form", F.length("form")).alias("checked"))


def copies(printed: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(record_id, first_id, n_copies): every row of a group of two or more equal records.

    The print and its check together are the key, so two forms that collide in 128 bits stay apart (see collisions).
    """
    printed = materialize(printed, "prints")
    groups = printed.groupBy("print", "checked").agg(F.count("*").alias("n_copies"), F.min("record_id").alias("first_id"))
    groups = materialize(groups.filter("n_copies > 1"), "groups")
    return lookup_join(printed, groups, ["print", "checked"], "n_copies", hot_rows).select("record_id", "first_id", "n_copies")


def kept_with_counts(printed: DataFrame) -> DataFrame:
    """(first_id, n_copies): one record for each form, with its number of copies."""
    return printed.groupBy("print", "checked").agg(F.min("record_id").alias("first_id"), F.count("*").alias("n_copies")).select("first_id", "n_copies")


def collisions(printed: DataFrame) -> DataFrame:
    """Prints that stand for more than one form."""
    return printed.groupBy("print").agg(F.min("checked").alias("low"), F.max("checked").alias("high")).filter("low <> high")
