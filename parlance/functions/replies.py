"""Judge replies: tolerant JSON, scores of any shape, and the reasons why a reply is no use."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dims import Domain
from .numeric import coerce_score, coerce_unit, let, to_double, unit_from_five
from .text import fix_json, strip, strip_code_fences


def _literal_udf():
    def literal(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            try:
                x = ast.literal_eval(t) if t is not None else None
                return json.dumps(x, allow_nan=False) if isinstance(x, dict) else None
            except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
                return None

        return texts.map(one)

    return F.pandas_udf(literal, "string")


def _is_object(t: Column) -> Column:
    """JSON that is an object; a text that goes on after it is none."""
    v = F.try_parse_json(t)
    return v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT") & t.endswith("}")


def with_object(df: DataFrame, reply: str, name: str = "object") -> DataFrame:
    """``df`` with the JSON object of a reply, repaired, as text, else null.

    Fences and surrounding words go, commas before closing brackets too. What is no JSON then may be a literal of single
    quotes; only such texts go to Python, in Arrow batches, all others as nulls.
    """
    text, plain = f"__{name}_text", f"__{name}_plain"
    df = df.withColumn(text, fix_json(strip_code_fences(F.col(reply))))
    df = df.withColumn(plain, let(F.col(text), lambda t: F.when(_is_object(t), t)))
    odd = F.when(F.col(plain).isNull() & F.col(text).startswith("{") & F.col(text).endswith("}"), F.col(text))
    return df.withColumn(name, F.coalesce(F.col(plain), _literal_udf()(odd))).drop(text, plain)


def raw_value(obj: Column, name: str) -> Column:
    """A value of an object as text: the score of a nested {'reasoning', 'score'}, or the value itself; null if absent."""
    own = F.get_json_object(obj, f"$.{name}")
    return let(own, lambda v: F.when(v.startswith("{"), F.get_json_object(v, "$.score")).otherwise(v))


def number(text: Column) -> Column:
    """A reply's value as a number: digits, or true and false as 1 and 0."""
    return let(text, lambda t: F.when(t == "true", F.lit(1.0)).when(t == "false", F.lit(0.0)).otherwise(to_double(t)))


def scored(obj: Column, d: Domain, dims: tuple[str, ...] | None = None) -> list[Column]:
    """A column for each dimension: the prefixed key before the bare one, coerced to the domain's scale and to [0, 1]."""
    out = []
    for dim in dims or d.dims:
        x = number(F.coalesce(raw_value(obj, f"{d.prefix}_{dim}"), raw_value(obj, dim)))
        out.append((unit_from_five(coerce_score(x)) if d.scale == "1-5" else coerce_unit(x)).alias(f"{d.prefix}_{dim}"))
    return out


def scored_lines(obj: Column, d: Domain) -> Column:
    """The fields of a parsed result, as the inside of a JSON object: each score as a number, or with its reasoning where the reply gave one."""
    fields = []
    for dim, score in zip(d.dims, scored(obj, d)):
        name = f"{d.prefix}_{dim}"
        own = F.coalesce(F.get_json_object(obj, f"$.{name}"), F.get_json_object(obj, f"$.{dim}"))
        nested = F.struct(F.struct(F.get_json_object(own, "$.reasoning").alias("reasoning"), score.alias("score")).alias(name))
        whole = F.when(own.startswith("{"), F.to_json(nested, {"ignoreNullFields": "false"})).otherwise(F.to_json(F.struct(score.alias(name)), {"ignoreNullFields": "false"}))
        fields.append(F.regexp_replace(whole, r"^\{|\}$", ""))
    return F.concat_ws(",", *fields)


def failure(status_code: Column, reply: Column, obj: Column, known: Column) -> Column:
    """The first reason that holds, else null: unknown_custom_id, api_error, json_parse_error."""
    return F.when(~known, "unknown_custom_id").when(F.coalesce(status_code, F.lit(0)) != 200, "api_error").when(obj.isNull(), "json_parse_error")


def continuation(reply: Column) -> Column:
    """Messages of a generated {'continuation': [{role, content}]}; null unless the reply is strict JSON and every message fits.

    List contents are joined by spaces, roles are lower-cased and must be user or assistant, and there must be messages.
    """
    items = let(strip(reply), lambda t: F.from_json(F.get_json_object(F.when(_is_object(t), t), "$.continuation"), "array<string>"))

    def message(i: Column) -> Column:
        c = F.get_json_object(i, "$.content")
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(i), "$.content", "variant"))
        joined = let(kind, lambda k: F.when(k.startswith("ARRAY"), F.array_join(F.from_json(c, "array<string>"), " ")).when(k == "STRING", c))
        return F.struct(F.lower(F.get_json_object(i, "$.role")).alias("role"), joined.alias("content"))

    fits = lambda ms: F.forall(ms, lambda m: F.coalesce(m["role"].isin("user", "assistant") & m["content"].isNotNull(), F.lit(False)))
    return let(F.transform(items, message), lambda ms: F.when((F.size(ms) > 0) & fits(ms), ms))


def evaluation_scores(reply: Column) -> Column:
    """The map of an evaluation's {'scores': {dim: number}}, as it stands; null unless strict JSON with numbers only."""
    return let(strip(reply), lambda t: F.from_json(F.get_json_object(F.when(_is_object(t), t), "$.scores"), "map<string,double>"))
