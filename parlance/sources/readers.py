"""Readers of raw corpora, request and reply files, and tables. Line order is kept as (file, line) where it decides."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.dims import ALL_DIMS, DOMAINS, RELATION_DIM
from parlance.operators.rows import last_wins

MESSAGES = "array<struct<role string, content string>>"
SCORES = "struct<" + ", ".join(f"{n}: double" for n in ALL_DIMS) + ">"
MANIFEST = "custom_id string, content string, label string, pid string, uid string, country_1 string, country_2 string, source_file string"
REPLY = "custom_id string, response struct<status_code int, body struct<model string, choices array<struct<message struct<content string>>>>>, error string"
PAIR = (
    "pair_id string, source_dialogue_id string, metadata struct<domain string, split string, generation_model string, turn_count int, difficulty string, "
    "contrast struct<scope string, direction string, decision string, intent_followed boolean>, dimensions struct<domain array<string>, target array<string>, decision array<string>>>, "
    "evaluation struct<method string, stage_1_scores map<string,double>, stage_2_scores map<string,double>, chosen_score_source string, rejected_score_source string>, "
    f"messages {MESSAGES}, chosen {MESSAGES}, rejected {MESSAGES}"
)


def there(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder has a path of this pattern."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files, blank lines left out. A line's number is its byte order within its file's splits: unique and ascending."""
    df = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("mono"), F.col("value").alias("line"))
    return df.filter(F.trim("line") != "").select("file", F.struct("block", "mono").alias("line_no"), "line")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, line_no, r): parsed lines; those that are no JSON object, or null in every field, are skipped."""
    parsed = numbered_lines(spark, path).withColumn("r", F.from_json("line", schema, {"mode": "PERMISSIVE"}))
    return parsed.filter(F.col("r").isNotNull() & F.trim("line").startswith("{") & (F.to_json("r") != "{}")).select("file", "line_no", "r")


def coherence(spark: SparkSession, path: str) -> DataFrame:
    """(ord, content, label) of one JSON object of parallel arrays. Raises if they differ in length; entries that are no text are left out."""
    one = spark.read.schema("dialogue array<string>, labels array<string>").option("multiLine", True).json(path)
    checked = one.withColumn("dialogue", F.when(F.size("dialogue") == F.size("labels"), F.col("dialogue")).otherwise(F.raise_error(F.lit("dialogue and labels differ in length"))))
    rows = checked.select(F.posexplode(F.arrays_zip("dialogue", "labels")).alias("ord", "r"))
    return rows.select("ord", F.col("r.dialogue").alias("content"), F.col("r.labels").alias("label")).filter("content is not null")


def empathy(spark: SparkSession, path: str) -> DataFrame:
    """(ord, content): a JSON list, or an object's dialogue or dialogues; items are texts, or objects with content, dialogue or input."""
    raw = spark.read.text(path, wholetext=True).select(F.col("value").alias("t"))
    is_list = F.trim("t").startswith("[")
    items = F.from_json(F.when(is_list, F.col("t")).otherwise(F.coalesce(F.get_json_object("t", "$.dialogue"), F.get_json_object("t", "$.dialogues"))), "array<string>")
    rows = raw.select(F.posexplode(items).alias("ord", "item"))
    key = lambda k: F.get_json_object("item", f"$.{k}")
    text = F.when(F.trim("item").startswith("{"), F.coalesce(key("content"), key("dialogue"), key("input"))).otherwise(F.col("item"))
    return rows.select("ord", text.alias("content")).filter("content is not null")


def commonsense(spark: SparkSession, *paths: str) -> DataFrame:
    """Tab-separated files with a header; all columns are texts. Files are joined by name; a warning for those that aren't there."""
    for p in paths:
        if not there(spark, p):
            warnings.warn(f"no {p}", stacklevel=2)
    paths = tuple(p for p in paths if there(spark, p))
    if not paths:
        raise FileNotFoundError("none of the commonsense files is there")
    parts = [spark.read.options(sep="\t", header=True, multiLine=True, escape='"', inferSchema=False).csv(p) for p in paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def relation_responses(df: DataFrame) -> Column:
    """The seven relation columns as a map, empty where there is none."""
    own = set(df.columns)
    return F.create_map(*[x for r in RELATION_DIM for x in (F.lit(r), F.coalesce(F.col(f"{r}_response"), F.lit("")) if f"{r}_response" in own else F.lit(""))])


def multicultural(spark: SparkSession, folder: str) -> DataFrame:
    """All csv files of a folder, with source_file (the name without its ending)."""
    df = spark.read.options(header=True, multiLine=True, escape='"').csv(f"{folder}/*.csv")
    return df.withColumn("source_file", F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", ""))


def gold(spark: SparkSession, path: str) -> DataFrame:
    """(ord, pid, gold) of a JSON array."""
    raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<struct<pid string, gold string>>")).alias("ord", "r"))
    return raw.select("ord", "r.pid", "r.gold")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, MANIFEST).select("r.*").filter("custom_id is not null")


def manifest_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A manifest that a step of the pipeline wrote."""
    return spark.read.schema(schema).json(path)


def reply_columns(r: Column) -> list[Column]:
    """custom_id, model, status_code, reply, error, status of a reply line."""
    body = r["response"]["body"]
    code = F.coalesce(r["response"]["status_code"], F.lit(0))
    return [r["custom_id"].alias("custom_id"), F.coalesce(body["model"], F.lit("")).alias("model"), code.alias("status_code"), F.coalesce(F.get(body["choices"], F.lit(0))["message"]["content"], F.lit("")).alias("reply"), r["error"].alias("error"), F.when(code == 200, "Success").otherwise("Failed").alias("status")]


def replies(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Replies of a batch service, one for each readable line: file, line_no, custom_id, model, status_code, reply, error, status.

    ``strict``: a line that isn't JSON raises when it is read, instead of being skipped.
    """
    if strict:
        checked = numbered_lines(spark, path).withColumn("line", F.when(F.try_parse_json("line").isNotNull(), F.col("line")).otherwise(F.raise_error(F.concat(F.lit("no JSON: "), F.substring("line", 1, 200)))))
        return checked.select("file", "line_no", F.from_json("line", REPLY).alias("r")).select("file", "line_no", *reply_columns(F.col("r")))
    return json_lines(spark, path, REPLY).select("file", "line_no", *reply_columns(F.col("r")))


def request_lines(spark: SparkSession, path: str) -> DataFrame:
    """(custom_id, line) of request shards; the last of an id counts."""
    rows = numbered_lines(spark, path).withColumn("custom_id", F.get_json_object("line", "$.custom_id")).filter("custom_id is not null")
    return last_wins(rows, ["custom_id"], ["file", "line_no"]).select("custom_id", "line")


def entries(spark: SparkSession, path: str) -> DataFrame:
    """Scored entries from JSON lines, older field names too: source, stage_1_dialogue_id, and scores beside the other fields.

    Lines without domain, id or any score are skipped.
    """
    flat = ", ".join(f"{n} double" for n in ALL_DIMS)
    rows = json_lines(spark, path, f"dialogue_id string, stage_1_dialogue_id string, source_id string, domain string, source string, messages {MESSAGES}, split string, scores {SCORES}, domain_metadata map<string,string>, {flat}").select("r.*")
    scores = F.coalesce("scores", F.struct(*[F.col(n) for n in ALL_DIMS]))
    out = rows.select(F.coalesce("dialogue_id", "stage_1_dialogue_id").alias("dialogue_id"), "source_id", F.coalesce("domain", "source").alias("domain"), "messages", "split", scores.alias("scores"), "domain_metadata")
    return out.filter(F.col("dialogue_id").isNotNull() & F.col("domain").isin(*DOMAINS) & F.coalesce(*[F.col("scores")[n] for n in ALL_DIMS]).isNotNull())


def pairs(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, PAIR).select("r.*")


def reply_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Replies of a folder: of its batch_*.jsonl files, or of all *.jsonl where there are none of that name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "batch_*.jsonl").load(folder)
    named = files.select("path").limit(1).count() > 0
    return replies(spark, f"{folder}/batch_*.jsonl" if named else f"{folder}/*.jsonl")


def parsed_rows(spark: SparkSession, folder: str, domain: str) -> DataFrame:
    """Parsed rows of a domain's result files: source_id, content, uid, pid and the whole line as object; bad lines are skipped."""
    lines = numbered_lines(spark, f"{folder}/{DOMAINS[domain].prefix}_*.jsonl")
    own = F.from_json("line", "_id string, custom_id string, content string, uid string, pid string")
    rows = lines.withColumn("r", own).filter(F.col("r").isNotNull() & F.try_parse_json("line").isNotNull() & F.trim("line").startswith("{"))
    return rows.select(F.coalesce("r._id", "r.custom_id").alias("source_id"), "r.content", "r.uid", "r.pid", F.col("line").alias("object"))


def shard_files(spark: SparkSession, folder: str, max_bytes: int = 200 * 1024 * 1024) -> DataFrame:
    """(path, length, domain, fits): request shards of a folder, as request_shards writes them, none of them read. The domain is the name before _shard_."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl").load(folder).select("path", "length")
    return files.withColumn("domain", F.regexp_extract("path", r"([^/]+?)(?:_shard_[^/]*)?\.jsonl$", 1)).withColumn("fits", F.col("length") <= max_bytes)
