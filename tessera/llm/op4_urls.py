r"""URL filters: host-suffix and path-prefix expressions, looked up by short hash prefixes.

Each URL is expanded into (host suffix, path prefix) expressions: the host and every shorter name
after one of its dots, and the prefixes of the path whose lengths some rule has. Expressions are
equi-joined with the rules on the first 32 bits of their SHA-256 alone: the rules of one prefix are one
row with a list, so that the join may find strangers, and full digests confirm which of the list are
meant. Of a URL's rules the longest wins; of equally long ones, a block, then the greater text.

A rule is written host + path, as `example.org/es/`: its host goes up to the first `/`.

Defined results: host and path of a URL that is null or has no `://` are empty, and no rule fits
an empty host; without a rule the verdict is ALLOW, as a list names what it blocks; rows that
repeat are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.columns import Aside

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
DEFAULT = "allow"
#: Rules up to this number and these bytes are broadcast; beyond, both sides are dealt by hash prefix and skewed ones split.
BROADCAST_RULES, BROADCAST_BYTES = 100_000, 1 << 24
#: Letters of a digest (4 bits each) that are joined on.
PREFIX = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digests(host: Column, path: Column, prefix: int) -> tuple[Column, Column]:
    digest = F.sha2(F.concat(host, F.lit("\n"), path), 256)
    return F.substring(digest, 1, prefix), digest


def filter_urls(pages: DataFrame, rules=RULES, url: str = "url", default: str = DEFAULT, prefix: int = PREFIX, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """pages with _host, _path, _rule (null where none fits) and _verdict.

    rules: (verdict, host + path) pairs, or a DataFrame of verdict and rule.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, rule string")
    named = rules.where("rule IS NOT NULL AND instr(rule, '/') > 1").select(
        F.when(F.col("verdict") == "block", 1).otherwise(0).alias("_blocks"),
        F.col("rule").alias("_rule"),
        F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER).alias("_rule_host"),
        F.expr("substring(rule, instr(rule, '/'))").alias("_rule_path"),
    )
    # lengths of paths are few, whatever the number of rules: a path of n letters needs n letters
    lengths = sorted(r[0] for r in named.select(F.char_length("_rule_path")).distinct().collect())
    short, full = _digests(F.col("_rule_host"), F.col("_rule_path"), prefix)
    named = named.select(short.alias("_short"), full.alias("_full"), F.char_length("_rule").alias("_length"), "_blocks", "_rule").distinct()
    held = named.groupBy("_short").agg(F.collect_list(F.struct("_full", "_length", "_blocks", "_rule")).alias("_held"))
    size = named.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("_rule")), F.lit(0)).alias("bytes")).first()
    if size["n"] <= broadcast_rules and size["bytes"] <= BROADCAST_BYTES:
        held = F.broadcast(held)

    aside = Aside(pages)
    rows = aside.df.withColumn("_host", host_of(aside(url))).withColumn("_path", path_of(aside(url)))
    # each different address is judged once
    addresses = rows.where("_host != ''").select("_host", "_path").distinct()
    labels = F.split("_host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length("_path"))
    paths = F.transform(fitting, lambda n: F.substring(F.col("_path"), F.lit(1), n))
    expanded = addresses.select("_host", "_path", F.explode(hosts).alias("_suffix"), paths.alias("_prefixes")).select("_host", "_path", "_suffix", F.explode("_prefixes").alias("_prefix"))
    short, full = _digests(F.col("_suffix"), F.col("_prefix"), prefix)
    expanded = expanded.select("_host", "_path", short.alias("_seek"), full.alias("_whole"))
    found = expanded.join(held, F.col("_seek") == F.col("_short"))
    confirmed = F.filter("_held", lambda r: r["_full"] == F.col("_whole"))
    ranked = F.array_max(F.transform(confirmed, lambda r: F.struct(r["_length"].alias("_length"), r["_blocks"].alias("_blocks"), r["_rule"].alias("_rule"))))
    found = found.select("_host", "_path", ranked.alias("_fits")).where("_fits IS NOT NULL")
    best = found.groupBy(F.col("_host").alias("_best_host"), F.col("_path").alias("_best_path")).agg(F.max("_fits").alias("_best"))
    # urls without a host fit nothing: they are dealt by where they are read, not all under one key
    host = F.when(F.col("_host") == "", F.concat(F.lit("\n"), F.spark_partition_id().cast("string"))).otherwise(F.col("_host"))
    judged = rows.withColumn("_asked_host", host).join(best, (F.col("_asked_host") == F.col("_best_host")) & (F.col("_path") == F.col("_best_path")), "left")
    verdict = F.when(F.col("_best").isNull(), default).when(F.col("_best._blocks") == 1, "block").otherwise("allow")
    return aside.back(judged.withColumns({"_rule": F.col("_best._rule"), "_verdict": verdict}), "_host", "_path", "_rule", "_verdict")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages).select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


OP4_SQL = r"""
WITH rules(v, r) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'), ('block', 'com/de/')),
q AS (SELECT v, r, split_part(r, '/', 1) AS rh, substr(r, strpos(r, '/')) AS rp FROM rules),
p AS (SELECT page_id, row_number() OVER () AS n,
        coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
m AS (SELECT p.*, q.v, q.r, row_number() OVER (PARTITION BY p.n ORDER BY length(q.r) DESC NULLS LAST, q.v DESC, q.r DESC) AS k
      FROM p LEFT JOIN q ON (p.host = q.rh OR ends_with(p.host, '.' || q.rh)) AND starts_with(p.path, q.rp))
SELECT page_id, host, path, r AS rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""
