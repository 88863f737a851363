"""Small results as markdown tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def glimpse(df: DataFrame, rows: int = 10, columns: int = 8) -> str:
    """The first rows and columns of a table, and how many of both there are."""
    text = markdown(df.select(*df.columns[:columns]).limit(rows))
    return f"{text}\n{df.count():,} rows, {len(df.columns)} columns"


def markdown(df: DataFrame, most: int = 200) -> str:
    """A table; numbers to the right. A report of more than ``most`` rows ends with a line that says how many more there are."""
    rows = df.limit(most + 1).collect()
    more = df.count() - most if len(rows) > most else 0
    rows = rows[:most]
    kinds = dict(df.dtypes)
    right = {c: kinds[c] in ("int", "bigint", "double", "float") for c in df.columns}
    text = lambda v: "" if v is None else f"{v:,.3f}" if isinstance(v, float) else f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else str(v)
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "|".join("--:" if right[c] else "---" for c in df.columns) + "|"]
    lines += ["| " + " | ".join(text(r[c]) for c in df.columns) + " |" for r in rows]
    return "\n".join(lines + ([f"({more:,} more rows)"] if more else []))
