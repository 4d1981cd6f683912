"""Grouping of postings that describe one job, and the merged view of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import fold, words
from tessera.functions.urls import canonical_url
from tessera.operators.components import connected_components

# Sources from the most to the least trusted.
SOURCE_ORDER = ("greenhouse", "lever", "ashby", "himalayas", "remotive", "jobicy", "remoteok")
# Words that name a legal form.
LEGAL_FORMS = ("inc", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "gmbh", "ag", "sa", "sas", "sl", "srl", "bv", "plc", "pty", "spa", "ltda")
# Words of a title that say nothing about the job.
TITLE_NOISE = ("remote", "fully", "100", "anywhere", "worldwide", "latam", "hiring")

MERGED = ("title", "company", "location", "work_mode", "salary_min", "salary_max", "salary_currency", "salary_text", "posted_at", "description")


def _without(folded: Column, noise) -> Column:
    return F.array_join(F.filter(words(folded), lambda w: ~w.isin(*noise)), " ")


def company_key(company: Column) -> Column:
    return _without(fold(company), LEGAL_FORMS)


def title_key(title: Column) -> Column:
    return _without(fold(F.regexp_replace(title, r"[\(\[][^\)\]]*[\)\]]", " ")), TITLE_NOISE)


def dedup_key(company: Column, title: Column) -> Column:
    """Company and title without noise; null without a company."""
    key = company_key(company)
    return F.when(key != "", F.concat(key, F.lit("|"), F.coalesce(title_key(title), F.lit(""))))


def source_rank(source: Column) -> Column:
    place = F.array_position(F.array(*[F.lit(s) for s in SOURCE_ORDER]), source)
    return F.when(place > 0, place).otherwise(len(SOURCE_ORDER) + 1)


def group_postings(postings: DataFrame) -> DataFrame:
    """postings with a unique long seq in input order -> one row a group.

    group_seq (the first seq), canonical_url and dedup_key of the first member by (rank, seq), the
    merged fields (the first value that is not empty, by the same order) and links in that order.
    """
    unique = postings.groupBy("source", "source_job_id").agg(F.min_by(F.struct(*postings.columns), "seq").alias("_first")).select("_first.*")
    keyed = unique.withColumns({"canonical_url": canonical_url(F.col("url")), "dedup_key": dedup_key(F.col("company"), F.col("title")), "rank": source_rank(F.col("source"))})
    keys = keyed.select("seq", F.explode(F.array(F.concat(F.lit("url:"), "canonical_url"), F.concat(F.lit("key:"), "dedup_key"))).alias("key")).where("key IS NOT NULL")
    first = keys.groupBy("key").agg(F.min("seq").alias("first"))
    edges = keys.join(first, "key").select(F.col("first").alias("a"), F.col("seq").alias("b"))
    groups = connected_components(edges).select(F.col("node").alias("seq"), F.col("component").alias("group_seq"))
    order = F.struct("rank", "seq")

    def first_value(name: str) -> Column:
        held = F.col(name).isNotNull()
        if dict(keyed.dtypes)[name] == "string":
            held = held & (F.col(name) != "")
        elif dict(keyed.dtypes)[name] == "bigint":
            held = held & (F.col(name) != 0)
        return F.min_by(F.col(name), F.when(held, order)).alias(name)

    links = F.transform(F.array_sort(F.collect_list(F.struct("rank", "seq", "source", "source_job_id", "url"))), lambda x: F.struct(x["source"].alias("source"), x["source_job_id"].alias("source_job_id"), x["url"].alias("url")))
    return keyed.join(groups, "seq").groupBy("group_seq").agg(
        F.min_by("canonical_url", order).alias("canonical_url"),
        F.min_by("dedup_key", order).alias("dedup_key"),
        *[first_value(n) for n in MERGED],
        links.alias("links"),
    )
