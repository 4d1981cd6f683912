"""Queries that map the driver's tables to the record pipeline's schemas and call its operators, and their SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.grouping import LEGAL_FORMS, SOURCE_ORDER, group_postings
from tessera.operators.rules import irrelevant, posting_problem
from tessera.plans import report
from tessera.plans.enrich import RulesProvider, candidates
from tessera.plans.extract import annotate, rejections, source_stats
from tessera.plans.profile import Profile
from tessera.plans.queries import CANONICAL, ORACLE_SQL, QUERIES, query, table
from tessera.plans.store import Tables, check_counts, load_groups, match_groups

__all__ = ["ORACLE_SQL", "QUERIES"]

PROFILE = Profile("", "", "senior", ("Python", "SQL"), 1200)
NOW = datetime(2020, 5, 5)


def _pick(key: Column, values: tuple, otherwise: Column) -> Column:
    """The entry of values at key, where there is one."""
    out = F.when(F.lit(False), otherwise)
    for place, value in enumerate(values):
        if value is not None:
            out = out.when(key == place, F.lit(value))
    return out.otherwise(otherwise)


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


@query("""
WITH p AS (
  SELECT o_orderkey AS seq, CASE o_orderkey % 11 WHEN 1 THEN 'ftp://files.example/x' WHEN 2 THEN 'https://localhost' WHEN 3 THEN 'https://a b.com' WHEN 4 THEN '' ELSE 'https://jobs.example/' || o_orderkey END AS url,
    floor(o_totalprice)::BIGINT AS low, CASE o_orderkey % 11 WHEN 5 THEN 999 WHEN 6 THEN 3000000 ELSE floor(o_totalprice)::BIGINT + 10 END AS high,
    CASE o_orderkey % 11 WHEN 7 THEN 'usd' WHEN 8 THEN '' ELSE 'USD' END AS currency, o_orderdate + INTERVAL 10 YEARS AS posted FROM orders),
r AS (SELECT *, CASE WHEN url = '' THEN 'missing_required_field' WHEN url NOT LIKE 'https://jobs%' THEN 'invalid_url' WHEN posted > TIMESTAMP '2006-01-02' THEN 'invalid_date'
    WHEN low < 1000 OR low > 2000000 OR high < 1000 OR high > 2000000 OR low > high OR currency = 'usd' THEN 'invalid_salary' END AS rule FROM p)
SELECT seq, rule, CASE rule WHEN 'missing_required_field' THEN 'url' WHEN 'invalid_url' THEN url WHEN 'invalid_date' THEN strftime(posted, '%Y-%m-%dT%H:%M:%S')
  WHEN 'invalid_salary' THEN CASE WHEN low < 1000 OR low > 2000000 THEN low || ' outside (1000, 2000000)' WHEN high < 1000 OR high > 2000000 THEN high || ' outside (1000, 2000000)'
    WHEN low > high THEN 'min ' || low || ' > max ' || high ELSE 'currency ''usd''' END END AS detail FROM r""")
def posting_rules(spark, sf_dir):
    """The rule chain over orders as postings, some broken in each way."""
    kind, low = F.col("o_orderkey") % 11, F.floor("o_totalprice").cast("long")
    postings = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        _text("o_orderkey").alias("source_job_id"),
        _pick(kind, (None, "ftp://files.example/x", "https://localhost", "https://a b.com", ""), F.concat(F.lit("https://jobs.example/"), _text("o_orderkey"))).alias("url"),
        F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("Firm "), _text("o_custkey")).alias("company"),
        low.alias("salary_min"),
        _pick(kind, (None,) * 5 + (999, 3_000_000), low + 10).cast("long").alias("salary_max"),
        _pick(kind, (None,) * 7 + ("usd", ""), F.lit("USD")).alias("salary_currency"),
        (F.col("o_orderdate") + F.expr("INTERVAL 10 YEARS")).cast("timestamp_ntz").alias("posted_at"),
    )
    return postings.withColumn("p", posting_problem(datetime(2006, 1, 1))).select("seq", "p.rule", "p.detail")


@query("""
SELECT p_partkey, CASE p_size % 3 WHEN 1 THEN 'not_remote (hybrid)' WHEN 2 THEN 'not_remote (unknown)' ELSE CASE WHEN p_partkey % 4 <> 0 THEN 'other_role' END END AS reason FROM part""")
def relevance(spark, sf_dir):
    """the relevance filter over parts as postings."""
    title = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("Senior Data Engineering, "), "p_name")).otherwise(F.concat(F.lit("Office manager, "), "p_brand"))
    rows = table(spark, sf_dir, "part").withColumns({"title": title, "work_mode": _pick(F.col("p_size") % 3, ("remote", "hybrid"), _none())})
    return rows.select("p_partkey", irrelevant().alias("reason"))


_LEGAL = ", ".join(f"'{w}'" for w in LEGAL_FORMS)
_SOURCES = "[" + ", ".join(f"'{s}'" for s in SOURCE_ORDER) + "]"


@query(f"""
WITH RECURSIVE p AS (
  SELECT page_id AS seq, page_id % 91 AS id, page_id % 91 % 7 AS place, canonical, CASE WHEN page_id % 3 <> 0 THEN 'firm ' || page_id % 30 || '|data engineer ' || page_id % 40 END AS dedup_key,
    CASE WHEN page_id % 3 <> 0 THEN 'Firm ' || page_id % 30 || ', Inc.' END AS company, CASE WHEN page_id % 4 = 0 THEN NULL WHEN page_id % 5 = 0 THEN 0 ELSE page_id * 10 END AS salary_min,
    CASE WHEN page_id % 6 = 0 THEN '' ELSE 'pay ' || page_id END AS salary_text, row_number() OVER (PARTITION BY page_id % 91 ORDER BY page_id) AS n FROM ({CANONICAL})),
u AS (SELECT *, place * 1000000000 + seq AS o FROM p WHERE n = 1),
k AS (SELECT seq, 'url:' || canonical AS key FROM u WHERE canonical IS NOT NULL UNION ALL SELECT seq, 'key:' || dedup_key FROM u WHERE dedup_key IS NOT NULL),
e AS (SELECT DISTINCT a.seq AS a, b.seq AS b FROM k a JOIN k b USING (key)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
g AS (SELECT a AS seq, min(b) AS group_seq FROM r GROUP BY a)
SELECT group_seq, arg_min(canonical, o) AS canonical_url, (list(dedup_key ORDER BY o))[1] AS dedup_key, arg_min(company, o) FILTER (WHERE company <> '') AS company,
  arg_min(salary_min, o) FILTER (WHERE salary_min <> 0)::BIGINT AS salary_min, arg_min(salary_text, o) FILTER (WHERE salary_text <> '') AS salary_text,
  string_agg({_SOURCES}[place + 1] || ':' || id, ',' ORDER BY o) AS links FROM u JOIN g USING (seq) GROUP BY group_seq""")
def grouped_postings(spark, sf_dir):
    """Pages as postings; repeated records, shared addresses and shared keys make groups."""
    n = F.col("page_id")
    ident = n % 91
    rows = table(spark, sf_dir, "pages").select(
        n.alias("seq"),
        F.get(F.array(*map(F.lit, SOURCE_ORDER)), (ident % 7).cast("int")).alias("source"),
        ident.cast("string").alias("source_job_id"),
        "url",
        F.concat(F.lit("Data Engineer "), (n % 40).cast("string"), F.lit(" (Remote)")).alias("title"),
        F.when(n % 3 != 0, F.concat(F.lit("Firm "), (n % 30).cast("string"), F.lit(", Inc."))).alias("company"),
        F.when(n % 4 == 0, _none("long")).when(n % 5 == 0, F.lit(0)).otherwise(n * 10).cast("long").alias("salary_min"),
        F.when(n % 6 == 0, "").otherwise(F.concat(F.lit("pay "), n.cast("string"))).alias("salary_text"),
        *[_none(kind).alias(name) for name, kind in (("location", "string"), ("work_mode", "string"), ("salary_max", "long"), ("salary_currency", "string"), ("posted_at", "timestamp_ntz"), ("description", "string"))],
    )
    links = F.array_join(F.transform("links", lambda x: F.concat_ws(":", x["source"], x["source_job_id"])), ",")
    return group_postings(rows).select("group_seq", "canonical_url", "dedup_key", "company", "salary_min", "salary_text", links.alias("links"))


def _stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as stored jobs, some of them with a link, and orders as groups that may match them."""
    key, own = _text("c_custkey"), F.col("c_custkey")
    seen = (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(own % 120).cast("int"))).alias("last_seen_at")
    customer = table(spark, sf_dir, "customer")
    empty = {name: _none(kind).alias(name) for name, kind in (("location", "string"), ("salary_min", "long"), ("salary_max", "long"), ("salary_currency", "string"), ("posted_at", "timestamp_ntz"), ("description", "string"))}
    jobs = customer.select(
        F.concat(F.lit("j"), key).alias("job_id"),
        F.concat(F.lit("https://c.example/"), key).alias("canonical_url"),
        F.concat_ws("|", "c_nationkey", "c_mktsegment").alias("dedup_key"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("company"),
        F.lit("remote").alias("work_mode"),
        F.when(own % 2 == 0, "own").alias("salary_text"),
        *empty.values(),
        F.lit("").alias("content_hash"),
        seen.alias("first_seen_at"),
        seen,
        F.lit(1).alias("first_run_id"),
        F.lit(1).alias("last_run_id"),
    )
    links = customer.where(own % 4 == 0).select(F.lit("s").alias("source"), F.concat(F.lit("c"), key).alias("source_job_id"), F.concat(F.lit("j"), key).alias("job_id"), F.lit("u").alias("url"), seen.alias("first_seen_at"), seen, F.lit(1).alias("last_run_id"))
    order = F.col("o_orderkey")
    url = F.when(order % 3 == 0, F.concat(F.lit("https://c.example/"), F.expr("o_orderkey div 3").cast("string"))).otherwise(F.concat(F.lit("https://o.example/"), order.cast("string")))
    ident = F.when(order % 7 == 0, F.concat(F.lit("c"), F.expr("o_orderkey div 7").cast("string"))).otherwise(F.concat(F.lit("o"), order.cast("string")))
    groups = table(spark, sf_dir, "orders").select(
        order.alias("group_seq"),
        url.alias("canonical_url"),
        F.when(order % 5 != 0, F.concat((F.col("o_custkey") % 25).cast("string"), F.lit("|BUILDING"))).alias("dedup_key"),
        F.lit("T").alias("title"),
        F.lit("C").alias("company"),
        F.lit("remote").alias("work_mode"),
        F.concat(F.lit("pay "), order.cast("string")).alias("salary_text"),
        *empty.values(),
        F.array(F.struct(F.lit("s").alias("source"), ident.alias("source_job_id"), url.alias("url"))).alias("links"),
    )
    return jobs, links, groups


_MATCHED = """
j AS (SELECT 'j' || c_custkey AS job_id, 'https://c.example/' || c_custkey AS canonical_url, c_nationkey || '|' || c_mktsegment AS dedup_key, CASE WHEN c_custkey % 2 = 0 THEN 'own' END AS salary_text,
    TIMESTAMP '2020-01-01' + to_days((c_custkey % 120)::INTEGER) AS seen FROM customer),
l AS (SELECT 'c' || c_custkey AS id, 'j' || c_custkey AS job_id, TIMESTAMP '2020-01-01' + to_days((c_custkey % 120)::INTEGER) AS seen FROM customer WHERE c_custkey % 4 = 0),
g AS (SELECT o_orderkey AS group_seq, CASE WHEN o_orderkey % 3 = 0 THEN 'https://c.example/' || o_orderkey // 3 ELSE 'https://o.example/' || o_orderkey END AS canonical_url,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 25 || '|BUILDING' END AS dedup_key, CASE WHEN o_orderkey % 7 = 0 THEN 'c' || o_orderkey // 7 ELSE 'o' || o_orderkey END AS id FROM orders),
f AS (SELECT g.*, coalesce(l.job_id, j.job_id) AS early FROM g LEFT JOIN l USING (id) LEFT JOIN j ON j.canonical_url = g.canonical_url),
t AS (SELECT early AS job_id, min(group_seq) AS touched FROM f WHERE early IS NOT NULL GROUP BY early),
n AS (SELECT f.group_seq, j.job_id, CASE WHEN t.touched < f.group_seq THEN TIMESTAMP '2020-05-05' ELSE j.seen END AS seen FROM f JOIN j ON f.dedup_key = j.dedup_key LEFT JOIN t ON t.job_id = j.job_id WHERE early IS NULL),
b AS (SELECT group_seq, arg_max(job_id, (seen, job_id)) AS by_key FROM n WHERE seen >= TIMESTAMP '2020-03-06' GROUP BY group_seq),
m AS (SELECT f.*, coalesce(early, by_key) AS matched FROM f LEFT JOIN b USING (group_seq))"""


@query(f"WITH {_MATCHED} SELECT group_seq, matched FROM m")
def matched_groups(spark, sf_dir):
    """Groups against stored jobs, by link, by address, by key within 60 days."""
    jobs, links, groups = _stored(spark, sf_dir)
    return match_groups(groups, jobs, links, NOW).select("group_seq", "matched")


@query(f"""
WITH {_MATCHED},
s AS (SELECT matched, arg_min('pay ' || group_seq, group_seq) AS pay FROM m WHERE matched IS NOT NULL GROUP BY matched)
SELECT job_id, coalesce(salary_text, pay) AS salary_text, 1 AS first_run_id, CASE WHEN pay IS NULL THEN 1 ELSE 2 END AS last_run_id, CASE WHEN pay IS NULL THEN seen ELSE TIMESTAMP '2020-05-05' END AS last_seen_at
FROM j LEFT JOIN s ON job_id = matched
UNION ALL SELECT 'j' || substr(sha1(canonical_url), 1, 15), 'pay ' || group_seq, 2, 2, TIMESTAMP '2020-05-05' FROM m WHERE matched IS NULL""")
def loaded_jobs(spark, sf_dir):
    """Stored jobs after a load: values stay, gaps are filled, new jobs come."""
    jobs, links, groups = _stored(spark, sf_dir)
    return load_groups(Tables({"jobs": jobs, "job_sources": links}), groups, 2, NOW).jobs.select("job_id", "salary_text", "first_run_id", "last_run_id", "last_seen_at")


@query(f"""
WITH {_MATCHED}
SELECT id AS source_job_id, coalesce(l.job_id, matched, 'j' || substr(sha1(canonical_url), 1, 15)) AS job_id, coalesce(canonical_url, 'u') AS url, coalesce(l.seen, TIMESTAMP '2020-05-05') AS first_seen_at, CASE WHEN group_seq IS NULL THEN 1 ELSE 2 END AS last_run_id
FROM l FULL JOIN m USING (id)""")
def loaded_links(spark, sf_dir):
    """Links after a load: known ones stay with their job, others come."""
    jobs, links, groups = _stored(spark, sf_dir)
    return load_groups(Tables({"jobs": jobs, "job_sources": links}), groups, 2, NOW).job_sources.select("source_job_id", "job_id", "url", "first_seen_at", "last_run_id")


@query("""
SELECT 'jobs_missing_required' AS name, count(*)::BIGINT AS failing FROM customer WHERE c_custkey % 50 = 0
UNION ALL SELECT 'duplicate_canonical_url', count(*)::BIGINT FROM (SELECT c_custkey % 1000 FROM customer GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orphan_source_links', count(*)::BIGINT FROM orders LEFT JOIN customer ON c_custkey = o_custkey + 10 WHERE c_custkey IS NULL
UNION ALL SELECT 'job_without_sources', count(*)::BIGINT FROM customer LEFT JOIN orders ON c_custkey = o_custkey + 10 WHERE o_orderkey IS NULL""")
def failed_checks(spark, sf_dir):
    """The load checks over customers as jobs and orders as links."""
    key = F.col("c_custkey")
    jobs = table(spark, sf_dir, "customer").select(key.alias("job_id"), F.when(key % 50 == 0, "").otherwise("T").alias("title"), F.lit("C").alias("company"), F.concat(F.lit("u"), (key % 1000).cast("string")).alias("canonical_url"))
    links = table(spark, sf_dir, "orders").select((F.col("o_custkey") + 10).alias("job_id"))
    return check_counts(Tables({"jobs": jobs, "job_sources": links}))


@query("""
SELECT n_name AS source, n_nationkey::BIGINT AS payloads, 1::BIGINT AS records, 2::BIGINT AS rejected, 3::BIGINT AS filtered, 4::BIGINT AS kept, count(DISTINCT c_custkey) FILTER (WHERE c_custkey % 5 = 2)::BIGINT AS new_jobs
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey WHERE n_regionkey = 2 GROUP BY ALL""")
def report_by_source(spark, sf_dir):
    """Counts of a run by source, with its new jobs."""
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    stats = nation.select(F.col("n_name").alias("source"), F.col("n_regionkey").alias("run_id"), F.col("n_nationkey").cast("long").alias("payloads"), *[F.lit(i + 1).cast("long").alias(c) for i, c in enumerate(("records", "rejected", "filtered", "kept"))])
    links = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("source"), F.col("c_custkey").alias("job_id"), F.col("n_regionkey").alias("last_run_id"))
    jobs = customer.select(F.col("c_custkey").alias("job_id"), (F.col("c_custkey") % 5).alias("first_run_id"))
    return report.by_source(Tables({"source_stats": stats, "job_sources": links, "jobs": jobs}), 2)


@query("""
WITH s AS (SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS sources FROM lineitem GROUP BY l_orderkey)
SELECT o_orderpriority AS title, 'Firm ' || o_custkey AS company, CASE WHEN o_orderkey % 4 <> 0 THEN 'mid' END AS seniority, CASE WHEN o_orderkey % 4 <> 0 THEN floor(o_totalprice)::INTEGER % 100 END AS affinity,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus || ', SQL' END AS stack, 'pay ' || o_orderkey AS salary_text, sources
FROM orders JOIN s ON l_orderkey = o_orderkey WHERE o_orderkey % 10 = 3
ORDER BY affinity DESC NULLS LAST, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END DESC NULLS LAST, o_orderpriority, o_orderkey LIMIT 10""")
def report_top_jobs(spark, sf_dir):
    """The best new jobs of a run."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    jobs = orders.select(key.alias("job_id"), (key % 10).alias("first_run_id"), F.col("o_orderpriority").alias("title"), F.concat(F.lit("Firm "), _text("o_custkey")).alias("company"), F.concat(F.lit("pay "), _text("o_orderkey")).alias("salary_text"), F.when(key % 3 != 0, F.col("o_orderdate")).alias("posted_at"))
    links = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("job_id"), F.col("l_returnflag").alias("source"))
    scores = orders.where(key % 4 != 0).select(key.alias("job_id"), F.lit("mid").alias("seniority"), (F.floor("o_totalprice") % 100).cast("int").alias("affinity"), F.array("o_orderstatus", F.lit("SQL")).alias("stack"))
    return report.top_jobs(Tables({"jobs": jobs, "job_sources": links, "enrichments": scores}), 3)


@query("""
SELECT term, count(*)::BIGINT AS jobs FROM (SELECT DISTINCT doc_id, unnest(string_split(lower(text), ' ')) AS term FROM documents WHERE doc_id % 3 = 1) GROUP BY term ORDER BY jobs DESC, term LIMIT 12""")
def report_stack_demand(spark, sf_dir):
    """The terms of the jobs seen in a run."""
    docs = table(spark, sf_dir, "documents")
    jobs = docs.select(F.col("doc_id").alias("job_id"), (F.col("doc_id") % 3).alias("last_run_id"))
    scores = docs.select(F.col("doc_id").alias("job_id"), F.array_distinct(F.split(F.lower("text"), " ")).alias("stack"))
    return report.stack_demand(Tables({"jobs": jobs, "enrichments": scores}), 1)


@query("""
SELECT l_linestatus AS stage, l_returnflag AS rule, count(*)::BIGINT AS records, string_agg(DISTINCT 's' || l_linenumber, ', ' ORDER BY 's' || l_linenumber) AS sources, arg_min('order ' || l_orderkey, l_orderkey * 10 + l_linenumber) AS example
FROM lineitem WHERE l_suppkey % 3 = 1 GROUP BY l_linestatus, l_returnflag""")
def report_rejected(spark, sf_dir):
    """Rejections of a run by stage and rule, with an example."""
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 3).alias("run_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_linestatus").alias("stage"),
        F.col("l_returnflag").alias("rule"),
        F.concat(F.lit("s"), _text("l_linenumber")).alias("source"),
        F.concat(F.lit("order "), _text("l_orderkey")).alias("detail"),
    )
    return report.rejected(Tables({"rejections": lines}), 1)


@query("SELECT count(*) FILTER (WHERE o_orderkey % 4 = 2)::BIGINT AS new, count(*) FILTER (WHERE o_custkey % 4 = 2 AND o_orderkey % 4 < 2)::BIGINT AS again, count(*)::BIGINT AS total FROM orders")
def report_run_counts(spark, sf_dir):
    """New jobs, jobs seen again, all jobs."""
    return report.run_counts(table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 4).alias("first_run_id"), (F.col("o_custkey") % 4).alias("last_run_id")), 2)


@query("SELECT d.doc_id AS job_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR l.quality = 0 OR l.toxic = 1 OR l.doc_id % 7 = 0 OR l.doc_id % 11 = 0")
def stale_jobs(spark, sf_dir):
    """All jobs to score: without a score, or with other content, profile, provider or model."""
    provider = RulesProvider()
    jobs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("job_id"), F.lit("h").alias("content_hash"), F.col("n_chars").alias("first_seen_at"))
    scores = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("job_id"),
        F.when(F.col("quality") == 0, "old").otherwise("h").alias("content_hash"),
        F.when(F.col("toxic") == 1, "old").otherwise(PROFILE.fingerprint).alias("profile_hash"),
        F.when(F.col("doc_id") % 7 == 0, "other").otherwise(provider.name).alias("provider"),
        F.when(F.col("doc_id") % 11 == 0, "other").otherwise(provider.model).alias("model"),
    )
    return candidates(jobs, scores, PROFILE, provider).select("job_id")


_PARTS = """
p AS (SELECT p_partkey AS id, p_size % 7 AS key, row_number() OVER (PARTITION BY p_size % 7 ORDER BY p_partkey) - 1 AS pos,
    CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'Cook ' || p_name ELSE 'Data Engineer' END AS title, CASE WHEN p_partkey % 6 = 0 THEN 'x' ELSE 'https://j.example/' || p_partkey END AS url, p_brand AS company FROM part),
a AS (SELECT *, CASE WHEN title = '' THEN 'missing_raw_field' WHEN url = 'x' THEN 'invalid_url' END AS rule FROM p),
o AS (SELECT *, CASE WHEN rule IS NOT NULL THEN 'rejected' WHEN title LIKE 'Cook%' THEN 'filtered' ELSE 'kept' END AS outcome FROM a)"""


def _annotated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts as the records of seven payloads of a board, and one payload that can't be read."""
    key = F.col("p_partkey")
    record = F.struct(
        key.alias("id"),
        _pick(key % 5, ("",), F.when(key % 5 == 1, F.concat(F.lit("Cook "), "p_name")).otherwise("Data Engineer")).alias("title"),
        F.when(key % 6 == 0, "x").otherwise(F.concat(F.lit("https://j.example/"), _text("p_partkey"))).alias("url"),
        F.col("p_brand").alias("company_name"),
        F.lit("2020-04-01T00:00:00").alias("publication_date"),
        F.concat(F.lit("<p>"), "p_type", F.lit("</p>")).alias("description"),
    )
    bodies = table(spark, sf_dir, "part").groupBy((F.col("p_size") % 7).alias("n")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(record)).alias("jobs"))).alias("raw"))
    broken = spark.createDataFrame([(7, "{cut")], "n int, raw string")
    payloads = bodies.unionByName(broken).select(F.col("n").cast("long").alias("payload_seq"), F.lit("remotive").alias("source"), _text("n").alias("key"), _none().alias("company"), "raw", F.try_parse_json("raw").alias("body"))
    return payloads, annotate(payloads, NOW)


@query(f"""
WITH {_PARTS}
SELECT (key::BIGINT << 31) + pos + 1 AS seq, outcome, title, rule FROM o UNION ALL SELECT 7::BIGINT << 31, 'rejected', NULL, 'unreadable_payload'""")
def annotated_records(spark, sf_dir):
    """Records of payloads, normalized, checked and filtered."""
    return _annotated(spark, sf_dir)[1].select("seq", "outcome", F.when(F.col("pos") >= 0, F.col("title")).alias("title"), "problem.rule")


@query(f"WITH {_PARTS} SELECT 'remotive' AS source, 8::BIGINT AS payloads, count(*)::BIGINT AS records, count(*) FILTER (WHERE outcome = 'rejected')::BIGINT + 1 AS rejected, count(*) FILTER (WHERE outcome = 'filtered')::BIGINT AS filtered, count(*) FILTER (WHERE outcome = 'kept')::BIGINT AS kept FROM o")
def extracted_counts(spark, sf_dir):
    """Counts of a run by source."""
    return source_stats(*_annotated(spark, sf_dir))


@query(f"WITH {_PARTS} SELECT rule, count(*)::BIGINT AS records, min(id::VARCHAR) AS first_id FROM o WHERE rule IS NOT NULL GROUP BY rule UNION ALL SELECT 'unreadable_payload', 1, NULL")
def rejected_records(spark, sf_dir):
    """Rejected records with their rules."""
    return rejections(_annotated(spark, sf_dir)[1]).groupBy("rule").agg(F.count("*").alias("records"), F.min("source_job_id").alias("first_id"))
