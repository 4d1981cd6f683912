"""Mixing sources to target weights.

Every document gets a hash-random key; within each source the documents are sorted by it (the
key's range is cut into even cells, each sorted by itself), word counts are accumulated by
distributed prefix sums, and the mix is cut at each source's exact budget. A budget above the
source's size takes whole epochs first.

Defined results: a null text has size 0; a null source is a source of its own, the last one;
a source without words has target 0; rows that repeat are documents of their own, and equal rows
share their source's budget in either order; an empty table gives an empty result; further columns
of the input, whatever their names, stay only in mix().
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.columns import Aside
from tessera.llm.prefix import KEY_BITS, cell_count, cell_of, running_sums
from tessera.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
RESULTS = ("_size", "_source_size", "_target", "_epochs", "_taken", "_copies")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """sizes: source, source_size, one row a source. Adds weight and target.

    A target is min(most * size, level * weight), where level makes them sum to the sum of sizes.
    That sum is concave in level, so the level is the largest of the levels that hold if the sources
    up to some one, in the order of most * size / weight, stand at their cap. The table has a row for
    each source of the mix, so one task can rank it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("_place", F.row_number().over(by_name)).withColumn("weight", weight)
    earlier = Window.orderBy(F.lit(float(most)) * F.col("source_size") / F.col("weight"), "_place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.lit(most) * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    share = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    levels = ranked.withColumn("_level", left.cast("double") / share.cast("double"))
    levels = levels.withColumn("_level", F.max("_level").over(everything))
    target = F.least(F.lit(float(most)) * F.col("source_size"), F.col("_level") * F.col("weight"))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MAX_EPOCHS,
    seed: str = "mix",
    rows: int | None = None,
) -> DataFrame:
    """docs (doc_id, text, source and any others) with _size, _source_size, _target, _taken, _epochs and _copies.

    _taken is the exact number of words that the mix takes of the document, repeats counted.
    _copies is the number of whole documents that stands for it: the document at the cut counts
    if its middle lies before the cut.
    """
    aside = Aside(docs)
    return aside.back(_mix(aside, _keyed(aside, seed), weights, most, docs.count() if rows is None else rows), *RESULTS)


def _keyed(aside: Aside, seed: str) -> DataFrame:
    """The input with _size and _key, the only columns that need the text."""
    text = aside("text")
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(aside("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    return aside.df.withColumn("_size", F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")).withColumn("_key", key)


def _mix(aside: Aside, keyed: DataFrame, weights: tuple[int, ...], most: int, rows: int) -> DataFrame:
    cells, source = cell_count(rows), aside("source")
    keyed = keyed.withColumn("_group", F.when(source.isNull(), "n").otherwise(F.concat(F.lit("v"), source)))
    keyed = keyed.withColumn("_cell", cell_of(F.conv(F.substring("_key", 1, KEY_BITS // 4), 16, 10).cast("long"), cells))
    per_source = keyed.groupBy("_group", source.alias("source")).agg(F.sum("_size").alias("source_size"))
    targets = source_targets(per_source.select("source", "source_size"), weights, most)
    targets = targets.select(
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("source"))).alias("_target_group"),
        F.col("target").alias("_target"),
    )
    summed = running_sums(keyed, "_group", "_cell", ["_key", "_size"], "_size", ("_before", "_source_size"))
    joined = summed.join(targets, F.col("_group") == F.col("_target_group")).drop("_target_group")
    budget = F.floor(F.col("_target") + 0.5)
    epochs = F.when(F.col("_source_size") > 0, F.expr("floor(_target + 0.5) div _source_size")).otherwise(F.lit(0))
    left = budget - F.col("_epochs") * F.col("_source_size") - F.col("_before")
    return (
        joined.withColumn("_epochs", epochs)
        .withColumn("_left", left)
        .withColumn("_taken", F.col("_epochs") * F.col("_size") + F.greatest(F.lit(0), F.least(F.col("_size"), F.col("_left"))))
        .withColumn("_copies", F.col("_epochs") + (F.col("_left") * 2 > F.col("_size")).cast("long"))
        .drop("_group", "_key", "_cell", "_before", "_left")
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """The mixed corpus itself, with the columns of docs: each document as often as the mix takes it."""
    aside = Aside(docs)
    repeated = _mix(aside, _keyed(aside, seed), weights, most, docs.count()).where("_copies > 0")
    return aside.back(repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of documents, whose texts are read once: what is left of them is written."""
    aside = Aside(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    keyed = materialize(_keyed(aside, "mix").select(aside("doc_id"), aside("source"), "_size", "_key"), "sized")
    return _mix(aside, keyed, WEIGHTS, MAX_EPOCHS, keyed.count()).select(
        aside("doc_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_source_size").cast("long").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_taken").cast("long").alias("taken"),
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight,
             row_number() OVER (ORDER BY source IS NULL, source) AS place FROM s),
l AS (SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
      FROM w WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, max(level) OVER () * weight) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs,
             floor(e.target + 0.5)::BIGINT - e.epochs * e.source_size
             - coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS still
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, still)))::BIGINT AS taken FROM p
"""
