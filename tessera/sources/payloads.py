"""Saved API payloads: <folder>/<source>/<key>.json, one payload a file."""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def board_names(spark: SparkSession, boards: dict[str, dict[str, str]]) -> DataFrame:
    rows = [(source, key, name) for source, own in boards.items() for key, name in own.items()]
    return spark.createDataFrame(rows, "source string, key string, company string")


def read_boards(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """The [boards.<source>] tables of a TOML file, read by Spark, so that it may lie anywhere."""
    text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    return tomllib.loads(text).get("boards", {})


def no_payloads(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "payload_seq long, source string, key string, company string, raw string").withColumn("body", F.try_parse_json("raw"))


def payloads_of(files: DataFrame, boards: dict[str, dict[str, str]]) -> DataFrame:
    """files: path and raw (a whole file's text). payload_seq, source, key, company, raw and body (a variant; null if it is no JSON).

    Payloads are ordered by a hash of source and file name, which every row knows by itself: no task
    sees all paths, and bodies stay where they were read.
    """
    parts = F.split("path", "/")
    named = files.withColumns({"source": F.url_decode(F.element_at(parts, -2)), "key": F.regexp_replace(F.url_decode(F.element_at(parts, -1)), r"\.json$", "")})
    known = board_names(files.sparkSession, boards).withColumnsRenamed({"source": "board_source", "key": "board_key"})
    joined = named.join(F.broadcast(known), (F.col("source") == F.col("board_source")) & (F.col("key") == F.col("board_key")), "left")
    order = F.pmod(F.xxhash64("source", "key"), F.lit(2**31))
    return joined.select(order.alias("payload_seq"), "source", "key", "company", "raw", F.try_parse_json("raw").alias("body"))


def read_payloads(spark: SparkSession, folder: str, boards: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """One row a file, as payloads_of gives them."""
    files = spark.read.text(f"{folder.rstrip('/')}/*/*.json", wholetext=True)
    return payloads_of(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw")), boards or {})
