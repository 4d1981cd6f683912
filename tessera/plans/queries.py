"""Queries over the driver's tables that call functions and single operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import REMOTE_WORDS, clean, fold, positive_int, salary_text, work_mode
from tessera.functions.urls import TRACKING, canonical_url as canonical
from tessera.operators.components import connected_components
from tessera.operators.grouping import LEGAL_FORMS, company_key, dedup_key as key_of, title_key
from tessera.operators.rules import title_matches
from tessera.plans.enrich import affinity as affinity_of, detect_seniority
from tessera.plans.profile import Profile
from tessera.plans.store import job_id_of

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TRACKED = ", ".join(f"'{t}'" for t in TRACKING)
CANONICAL = rf"""
  SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || '://'
    || regexp_replace(lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)), '^www\.', '')
    || CASE WHEN regexp_replace(regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1), '/+$', '') = '' THEN '/'
            ELSE regexp_replace(regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1), '/+$', '') END
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_sort(kept), '&') ELSE '' END AS canonical
  FROM (SELECT page_id, url, list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
          lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_') AND lower(split_part(p, '=', 1)) NOT IN ({_TRACKED})) AS kept FROM pages)
"""


@query(CANONICAL)
def canonical_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", canonical(F.col("url")).alias("canonical"))


@query(f"SELECT canonical, count(*)::BIGINT AS pages, min(page_id) AS first_page FROM ({CANONICAL}) GROUP BY canonical HAVING count(*) > 1")
def url_groups(spark, sf_dir):
    return canonical_url(spark, sf_dir).groupBy("canonical").agg(F.count("*").alias("pages"), F.min("page_id").alias("first_page")).where("pages > 1")


@query("SELECT doc_id, sha256(text) AS content_hash, 'j' || substr(sha1(text), 1, 15) AS job_id FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"), job_id_of(F.col("text")).alias("job_id"))


@query(r"""
SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9+#]+', ' ', 'g')) AS folded,
  len(list_filter(string_split(regexp_replace(lower(p_name), '[^a-z0-9+#]+', ' ', 'g'), ' '), lambda w: starts_with(w, 'part'))) > 0 AS matches
FROM part""")
def fold_match(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", fold(F.col("p_name")).alias("folded"), title_matches(F.col("p_name"), ("part",)).alias("matches"))


@query(r"""
SELECT p_partkey, trim(regexp_replace(lower(regexp_replace('(x) ' || p_type || ' [y] ' || p_brand, '[\(\[][^\)\]]*[\)\]]', ' ', 'g')), '[^a-z0-9+#]+', ' ', 'g')) AS title FROM part""")
def title_notes(spark, sf_dir):
    title = F.concat(F.lit("(x) "), "p_type", F.lit(" [y] "), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", title_key(title).alias("title"))


_LEGAL = ", ".join(f"'{w}'" for w in LEGAL_FORMS)


@query(rf"""
SELECT s_suppkey, c || '|supplier of goods' AS dedup_key FROM (
  SELECT s_suppkey, array_to_string(list_filter(string_split(trim(regexp_replace(lower(s_name || ', Inc.'), '[^a-z0-9+#]+', ' ', 'g')), ' '), lambda w: w NOT IN ({_LEGAL})), ' ') AS c FROM supplier) WHERE c <> ''""")
def company_keys(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    name = F.concat("s_name", F.lit(", Inc."))
    return supplier.where(company_key(name) != "").select("s_suppkey", key_of(name, F.lit("Supplier of goods (remote)")).alias("dedup_key"))


@query("""
WITH RECURSIVE k AS (SELECT doc_id, md5(text) AS key FROM documents UNION SELECT doc_id, 'n' || n_chars || '|' || source FROM documents),
e AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM k a JOIN k b USING (key)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT a AS doc_id, min(b) AS component FROM r GROUP BY a""")
def whole_key_components(spark, sf_dir):
    """As components, but both keys come from whole columns: the text, and source with n_chars."""
    docs = table(spark, sf_dir, "documents")
    keys = docs.select("doc_id", F.explode(F.array(F.md5("text"), F.concat(F.lit("n"), F.col("n_chars").cast("string"), F.lit("|"), "source"))).alias("key"))
    first = keys.groupBy("key").agg(F.min("doc_id").alias("first"))
    found = connected_components(keys.join(first, "key").select(F.col("first").alias("a"), F.col("doc_id").alias("b")))
    return found.select(F.col("node").alias("doc_id"), "component")


_PROFILE = Profile("", "", "senior", ("Python", "SQL"), 1200)


@query("""
WITH p AS (SELECT p_partkey, p_size % 5 AS level, p_size % 3 AS stack, CASE WHEN p_size % 4 <> 0 THEN p_retailprice::BIGINT END AS pay FROM part)
SELECT p_partkey, round_even(100.0::DOUBLE * (0.6::DOUBLE * CASE stack WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0.5::DOUBLE ELSE 2.0::DOUBLE / 3.0::DOUBLE END
  + 0.25::DOUBLE * CASE level WHEN 0 THEN 0.2::DOUBLE WHEN 1 THEN 0.6::DOUBLE WHEN 2 THEN 1.0::DOUBLE WHEN 3 THEN 0.6::DOUBLE ELSE 0.5::DOUBLE END
  + 0.15::DOUBLE * CASE WHEN pay IS NULL THEN 0.5::DOUBLE WHEN pay >= 1200 THEN 1.0::DOUBLE ELSE 0.2::DOUBLE END), 0)::INTEGER AS affinity FROM p""")
def affinity(spark, sf_dir):
    size = F.col("p_size")
    level = F.get(F.array(*map(F.lit, ("junior", "mid", "senior", "lead", "unknown"))), size % 5)
    none, half, most = F.array().cast("array<string>"), F.array(F.lit("Python"), F.lit("Go")), F.array(*map(F.lit, ("Python", "SQL", "Go")))
    stack = F.when(size % 3 == 0, none).when(size % 3 == 1, half).otherwise(most)
    pay = F.when(size % 4 != 0, F.round("p_retailprice").cast("long"))
    found = table(spark, sf_dir, "part").withColumns({"stack": stack, "level": level, "pay": pay})
    return found.select("p_partkey", affinity_of(F.col("stack"), F.col("level"), F.col("pay"), _PROFILE)[0].alias("affinity"))


@query(r"""
SELECT p_partkey, CASE WHEN list_contains(w, 'junior') THEN 'junior' WHEN list_contains(w, 'lead') THEN 'lead' WHEN list_contains(w, 'senior') THEN 'senior' WHEN y <= 2 THEN 'junior' WHEN y <= 4 THEN 'mid' ELSE 'senior' END AS seniority
FROM (SELECT p_partkey, p_size % 10 AS y, ['engineer', CASE p_size % 7 WHEN 0 THEN 'junior' WHEN 1 THEN 'lead' WHEN 2 THEN 'senior' ELSE 'plain' END] AS w FROM part)""")
def seniority(spark, sf_dir):
    kind = F.get(F.array(*map(F.lit, ("Junior", "Lead", "Senior", "Plain", "Plain", "Plain", "Plain"))), F.col("p_size") % 7)
    titled = table(spark, sf_dir, "part").withColumn("title", F.concat(F.lit("Engineer "), kind)).withColumn("said", F.concat((F.col("p_size") % 10).cast("string"), F.lit("+ years of it")))
    return titled.select("p_partkey", detect_seniority(fold(F.col("title")), F.col("said")).alias("seniority"))


@query("""
SELECT o_orderkey, CASE WHEN low = high THEN 'USD ' || format('{:,}', low) ELSE 'USD ' || format('{:,}', low) || '-' || format('{:,}', high) END || ' / year' AS salary
FROM (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS low, floor(o_totalprice)::BIGINT + (o_orderkey % 2) * 5000 AS high FROM orders) WHERE low > 0""")
def salaries(spark, sf_dir):
    low = positive_int(F.col("o_totalprice").cast("string"))
    orders = table(spark, sf_dir, "orders").withColumn("low", low).where("low > 0").withColumn("high", F.col("low") + F.col("o_orderkey") % 2 * 5000)
    return orders.select("o_orderkey", salary_text(F.col("low"), F.col("high"), F.lit("USD"), F.lit("year")).alias("salary"))


@query("SELECT user_id, event_id, n::BIGINT AS n FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n <= 3")
def first_of_each(spark, sf_dir):
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.row_number().over(order).cast("long").alias("n")).where("n <= 3")


#: References that occur in texts, decoded in SQL one by one; the operator decodes all of them.
_DECODED = "replace(replace(replace(replace(replace(text, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&nbsp;', chr(160)), '&amp;', '&')"
_BLANKS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_REMOTE = " OR ".join(f"contains(said, '{w}')" for w in REMOTE_WORDS)


@query(rf"""
SELECT conv_id, turn, nullif(trim(regexp_replace({_DECODED}, '{_BLANKS}', ' ', 'g')), '') AS cleaned,
  CASE WHEN {_REMOTE} THEN 'remote' WHEN contains(said, 'hybrid') THEN 'hybrid' WHEN role <> '' THEN 'onsite' END AS mode
FROM (SELECT *, lower(coalesce(role, '') || ' ' || coalesce(text, '')) AS said FROM conversations)""")
def all_turns_cleaned(spark, sf_dir):
    """Every turn, with references and blanks of any kind."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", clean(F.col("text")).alias("cleaned"), work_mode(F.col("role"), F.col("text")).alias("mode"))
