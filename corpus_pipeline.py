"""A pipeline over `documents`: quality, near duplicates, benchmark passages, mix, shards.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read
again as the next one's docs. Stages keep whole rows: decisions drop or repeat rows, texts stay as
they are. All but the last return the columns of `documents`; the last adds size, text_crc32, shard
and slot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tessera.llm.bitfilter import bit_filter, passes
from tessera.llm.columns import Aside
from tessera.llm.op1_mixing import mixed
from tessera.llm.op2_jaccard import jaccard_copies
from tessera.llm.op3_sharding import shard, with_digest
from tessera.llm.op8_quality import THRESHOLD, quality_field, score_quality
from tessera.llm.op9_decontaminate import decontaminate
from tessera.session import discard, materialize


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    field = quality_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, field).where(F.col("_score") >= THRESHOLD).select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one row: that of the smallest doc_id (null is the greatest), then of the least hash of its text.

    Rows without words are linked with nothing and stay. Only rows that may be named as copies are
    shuffled: a filter of bounded size tells the others, which stay where they are.
    """
    named = jaccard_copies(docs).select(F.col("doc_id").alias("_of"), F.col("mark").alias("_text"), F.col("gone").alias("_gone"), F.xxhash64("doc_id", "mark").alias("_key"))
    named = materialize(named, "named")
    others, asked, aside = _parted(docs, named)
    stay = others.unionByName(aside.back(asked.where("_gone IS NULL")))
    return stay.unionByName(aside.back(asked.where("NOT _gone")).dropDuplicates(["doc_id", "text"]))


def _parted(docs: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame, Aside]:
    """The rows that named (_of, _text, _gone, _key) surely doesn't name, and the others, joined with it."""
    bits = bit_filter(named, "_key")

    @F.pandas_udf(BooleanType())
    def may_be_named(keys: pd.Series) -> pd.Series:
        return pd.Series(passes(bits, keys.to_numpy(np.int64)))

    aside = Aside(docs)
    own = aside("doc_id").cast("long")
    marked = aside.df.withColumn("_mark", F.xxhash64(aside("text"))).withColumn("_maybe", may_be_named(F.xxhash64(own, "_mark")))
    asked = marked.where("_maybe").join(named, own.eqNullSafe(F.col("_of")) & (F.col("_mark") == F.col("_text")), "left")
    return aside.back(marked.where("NOT _maybe")), asked, aside


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), min_items=1).where("contaminated")
    named = found.select(F.col("doc_id").alias("_of"), F.col("mark").alias("_text"), F.lit(True).alias("_gone"), F.xxhash64("doc_id", "mark").alias("_key")).distinct()
    others, asked, aside = _parted(docs, materialize(named, "contaminated"))
    return others.unionByName(aside.back(asked.where("_gone IS NULL")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in shards of equal row counts, shuffled uniformly."""
    return shard(with_digest(docs), ["doc_id", "size", "text_crc32"])


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mix_sources", mix_sources),
    ("shards", shards),
]

#: The classifier's scores can't be stated in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
