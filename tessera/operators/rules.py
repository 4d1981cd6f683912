"""Quality rules and the relevance filter, as column builders: the first rule that fails rejects."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import fold, words
from tessera.operators.folding import fold_text

EARLIEST = datetime(2000, 1, 1)
SKEW = timedelta(days=1)
SALARY_LOW, SALARY_HIGH = 1_000, 2_000_000

# Roles that are looked for.
DEFAULT_ROLES = ("Data Engineer", "Analytics Engineer", "Data Platform Engineer", "ETL Developer", "Big Data Engineer")


def _failed(rule: str, detail: Column) -> Column:
    return F.struct(F.lit("normalize").alias("stage"), F.lit(rule).alias("rule"), detail.alias("detail"))


def _empty(name: str) -> Column:
    return F.coalesce(F.col(name) == "", F.lit(True))


def missing_fields() -> Column:
    names = F.array_compact(F.array(*[F.when(_empty(n), F.lit(n)) for n in ("source_job_id", "title", "company", "url")]))
    return F.when(F.size(names) > 0, _failed("missing_required_field", F.array_join(names, ", ")))


def invalid_url() -> Column:
    url = F.col("url")
    authority = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    sound = F.lower(url).rlike(r"^\s*https?:") & authority.contains(".") & ~url.contains(" ")
    # an address in brackets that is never closed can't be read at all
    sound = sound & (authority.contains("[") == authority.contains("]"))
    return F.when(~_empty("url") & ~sound, _failed("invalid_url", F.substring(url, 1, 120)))


def iso_time(time: Column) -> Column:
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(time, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))


def invalid_date(now: datetime) -> Column:
    posted = F.col("posted_at")
    bad = (posted < F.lit(EARLIEST).cast("timestamp_ntz")) | (posted > F.lit(now + SKEW).cast("timestamp_ntz"))
    return F.when(bad, _failed("invalid_date", iso_time(posted)))


def invalid_salary() -> Column:
    low, high, currency = F.col("salary_min"), F.col("salary_max"), F.col("salary_currency")

    def outside(x: Column) -> Column:
        return F.when(~x.between(SALARY_LOW, SALARY_HIGH), F.concat(x.cast("string"), F.lit(f" outside ({SALARY_LOW}, {SALARY_HIGH})")))

    swapped = F.when(low > high, F.concat(F.lit("min "), low.cast("string"), F.lit(" > max "), high.cast("string")))
    foreign = F.when((currency != "") & ~currency.rlike("^[A-Z]{3}$"), F.concat(F.lit("currency '"), currency, F.lit("'")))
    detail = F.coalesce(outside(low), outside(high), swapped, foreign)
    return F.when(detail.isNotNull(), _failed("invalid_salary", detail))


def posting_problem(now: datetime) -> Column:
    """Null, or stage, rule and detail of the first rule that a normalized posting breaks."""
    return F.coalesce(missing_fields(), invalid_url(), invalid_date(now), invalid_salary())


def _begins(words_of: Column, need: str) -> Column:
    return F.exists(words_of, lambda w: w.startswith(need))


def title_matches(title: Column, roles=DEFAULT_ROLES) -> Column:
    """Every word of some role begins some word of the title."""
    has = words(fold(title))
    found = F.lit(False)
    for needed in (fold_text(role).split() for role in roles):
        if needed:
            every = F.lit(True)
            for need in needed:
                every = every & _begins(has, need)
            found = found | every
    return found


def irrelevant(roles=DEFAULT_ROLES) -> Column:
    """Null, or why a sound posting is none that is looked for."""
    mode = F.col("work_mode")
    return F.when(~mode.eqNullSafe("remote"), F.concat(F.lit("not_remote ("), F.coalesce(mode, F.lit("unknown")), F.lit(")"))).when(~title_matches(F.col("title"), roles), "other_role")
