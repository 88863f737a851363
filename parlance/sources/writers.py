"""Writers of JSON lines. Results go to new folders; nothing is rewritten in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str, nulls: bool = True, mode: str = "error") -> None:
    df.write.mode(mode).option("ignoreNullFields", str(not nulls).lower()).json(path)


def envelope(custom_id: Column, prompt: Column, model: str = "judge") -> Column:
    """A request line for a batch service: temperature 0, a JSON object wanted."""
    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    body = F.struct(F.lit(model).alias("model"), F.array(message).alias("messages"), F.lit(0).alias("temperature"), F.struct(F.lit("json_object").alias("type")).alias("response_format"))
    return F.to_json(F.struct(custom_id.alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body")))


def request_shards(requests: DataFrame, path: str, mode: str = "error") -> None:
    """``requests``(shard, line): a file SHARD.jsonl for each shard."""
    requests.select("shard", "line").repartition("shard").write.mode(mode).partitionBy("shard").text(path)
    spark = requests.sparkSession
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = own(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in files.globStatus(own(f"{path}/shard=*")) or []:
        name = folder.getPath().getName().split("=", 1)[1]
        parts = files.globStatus(own(f"{folder.getPath()}/part-*"))
        for k, part in enumerate(sorted(parts, key=lambda f: f.getPath().getName())):  # one: a shard is written by one task
            files.rename(part.getPath(), own(f"{path}/{name}{f'_{k}' if k else ''}.jsonl"))
        files.delete(folder.getPath(), True)


def named_lines(lines: DataFrame, path: str, stem: str) -> None:
    """``lines``(line) as files STEM_00000.jsonl and on, in place of what was there."""
    lines.select("line").write.mode("overwrite").text(path)
    spark = lines.sparkSession
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = own(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for k, part in enumerate(sorted(f.getPath().toString() for f in files.globStatus(own(f"{path}/part-*")) or [])):
        files.rename(own(part), own(f"{path}/{stem}_{k:05d}.jsonl"))


def manifest(df: DataFrame, path: str, mode: str = "error") -> None:
    """Without null fields."""
    json_lines(df, path, nulls=False, mode=mode)
