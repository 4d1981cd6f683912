"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod folds; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int, held_out: int, cost: Callable[[Column], Column], most: int) -> DataFrame:
    """_raw and _label of at most `rows` labelled documents outside the held-out fold, in the order of a hash of their ids.

    cost: of a document's bytes, a long; documents are taken in that order as long as their costs sum
    to `most` at most (one above `most` by itself is passed over). The sample of ids is bounded by
    `rows`, so it is sent to the documents. Ids with a label that is not 0 or 1, or with both, are left
    out; of rows that repeat an id, one whose text has the least hash counts.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != held_out))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min(label).alias("_label"), F.max(label).alias("_other")).where("_label = _other")
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(rows).select("_id", F.col("_label").cast("int").alias("_label"))
    found = docs.select("doc_id", F.col("text").cast("binary").alias("_raw")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    found = found.withColumn("_cost", F.coalesce(cost(F.col("_raw")), F.lit(0)).cast("long")).where(F.col("_cost") <= most)
    one = found.groupBy("_id").agg(F.min_by(F.struct("_raw", "_label", "_cost"), F.xxhash64("_raw")).alias("_row"))
    sample = materialize(one.select("_id", "_row.*"), "labelled")
    # at most `rows` short rows meet in one task
    order = Window.orderBy(F.xxhash64("_id"), "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = sample.select(F.col("_id").alias("_of"), F.sum("_cost").over(order).alias("_upto")).where(F.col("_upto") <= most).select("_of")
    return sample.join(F.broadcast(taken), F.col("_id") == F.col("_of")).select("_raw", "_label")
