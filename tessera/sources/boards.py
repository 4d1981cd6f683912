"""The seven boards: how records lie in a payload, which keys they need, and what they become.

A board is data (where its records are, required keys) and one projection of a variant record to
the common columns. All boards' projections are unions of one plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import clean, html_to_text, mapped, parse_datetime, positive_int, salary_text, unescape, work_mode

# What boards call work places and pay periods.
LEVER_PLACES = {"remote": "remote", "hybrid": "hybrid", "on-site": "onsite", "onsite": "onsite"}
LEVER_PERIODS = {"per-year-salary": "year", "per-month-salary": "month", "per-hour-wage": "hour"}
ASHBY_PLACES = {"remote": "remote", "hybrid": "hybrid", "onsite": "onsite"}
HIMALAYAS_PERIODS = {"annual": "year", "yearly": "year", "monthly": "month", "hourly": "hour"}

FIELDS = ("source_job_id", "url", "title", "company", "location", "work_mode", "salary_min", "salary_max", "salary_currency", "salary_text", "posted_at", "description")


def at(path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col("record"), f"$.{path}", kind)


def held(path: str) -> Column:
    """The text at a path; what is empty, 0 or false counts as absent."""
    value = at(path)
    return F.when(~value.isin("", "0", "false", "0.0"), value)


def kind_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def absent(path: str) -> Column:
    """No such key, JSON null, or an empty text."""
    value = F.try_variant_get(F.col("record"), f"$.{path}", "variant")
    return value.isNull() | F.is_variant_null(value) | ((kind_of(value) == "STRING") & (at(path) == ""))


def time_at(path: str) -> Column:
    """The time at a path, of a number or a text."""
    number = kind_of(F.try_variant_get(F.col("record"), f"$.{path}", "variant")).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(number, parse_datetime(at(path), numbers=True)).otherwise(parse_datetime(at(path)))


def first_time(*paths: str) -> Column:
    """The time at the first path that holds something."""
    out = time_at(paths[-1])
    for path in reversed(paths[:-1]):
        out = F.when(held(path).isNotNull(), time_at(path)).otherwise(out)
    return out


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _title(path: str) -> Column:
    return F.coalesce(clean(at(path)), F.lit(""))


def _greenhouse() -> dict[str, Column]:
    title, location = _title("title"), clean(at("location.name"))
    return {
        "source_job_id": F.concat_ws(":", F.col("key"), at("id")),
        "url": at("absolute_url"),
        "title": title,
        "company": F.coalesce(F.nullif(F.col("company"), F.lit("")), clean(at("company_name")), F.col("key")),
        "location": location,
        "work_mode": work_mode(location, title),
        "posted_at": first_time("first_published", "updated_at"),
        "description": html_to_text(unescape(at("content"))),
    }


def _lever() -> dict[str, Column]:
    title, location = _title("text"), clean(at("categories.location"))
    period = F.coalesce(mapped(at("salaryRange.interval"), LEVER_PERIODS), F.lit("year"))
    low, high, currency = positive_int(at("salaryRange.min")), positive_int(at("salaryRange.max")), clean(at("salaryRange.currency"))
    yearly = period == "year"
    return {
        "source_job_id": F.concat_ws(":", F.col("key"), at("id")),
        "url": at("hostedUrl"),
        "title": title,
        "company": F.coalesce(F.nullif(F.col("company"), F.lit("")), F.col("key")),
        "location": location,
        "work_mode": F.coalesce(mapped(F.lower(at("workplaceType")), LEVER_PLACES), work_mode(location, title)),
        "salary_min": F.when(yearly, low),
        "salary_max": F.when(yearly, high),
        "salary_currency": currency,
        "salary_text": salary_text(low, high, currency, period),
        "posted_at": time_at("createdAt"),
        "description": F.col("sections"),
    }


def _ashby() -> dict[str, Column]:
    title, location = _title("title"), clean(at("location"))
    parts = at("compensation.summaryComponents", "array<struct<compensationType:string,interval:string,currencyCode:string,minValue:string,maxValue:string>>")
    pay = F.get(F.filter(parts, lambda p: (p["compensationType"] == "Salary") & (p["interval"] == "1 YEAR")), F.lit(0))
    low, high, currency = positive_int(pay["minValue"]), positive_int(pay["maxValue"]), clean(pay["currencyCode"])
    place = mapped(F.replace(F.lower(at("workplaceType")), F.lit("-"), F.lit("")), ASHBY_PLACES)
    return {
        "source_job_id": F.concat_ws(":", F.col("key"), at("id")),
        "url": F.coalesce(held("jobUrl"), held("applyUrl"), F.lit("")),
        "title": title,
        "company": F.coalesce(F.nullif(F.col("company"), F.lit("")), F.col("key")),
        "location": location,
        "work_mode": F.coalesce(place, F.when(held("isRemote").isNotNull(), "remote"), work_mode(location, title)),
        "salary_min": low,
        "salary_max": high,
        "salary_currency": currency,
        "salary_text": F.coalesce(clean(at("compensation.compensationTierSummary")), salary_text(low, high, currency, F.lit("year"))),
        "posted_at": time_at("publishedAt"),
        "description": F.coalesce(held("descriptionPlain"), html_to_text(at("descriptionHtml"))),
    }


def _remotive() -> dict[str, Column]:
    return {
        "source_job_id": at("id"),
        "url": at("url"),
        "title": _title("title"),
        "company": clean(at("company_name")),
        "location": clean(at("candidate_required_location")),
        "work_mode": F.lit("remote"),
        "salary_text": clean(at("salary")),
        "posted_at": time_at("publication_date"),
        "description": html_to_text(at("description")),
    }


def _remoteok() -> dict[str, Column]:
    low, high = positive_int(at("salary_min")), positive_int(at("salary_max"))
    currency = F.when(low.isNotNull() | high.isNotNull(), "USD")
    return {
        "source_job_id": at("id"),
        "url": F.coalesce(held("url"), F.concat(F.lit("https://remoteok.com/remote-jobs/"), at("id"))),
        "title": _title("position"),
        "company": clean(at("company")),
        "location": clean(at("location")),
        "work_mode": F.lit("remote"),
        "salary_min": low,
        "salary_max": high,
        "salary_currency": currency,
        "salary_text": salary_text(low, high, currency, F.lit("year")),
        "posted_at": first_time("epoch", "date"),
        "description": html_to_text(at("description")),
    }


def _jobicy() -> dict[str, Column]:
    low, high, currency = positive_int(at("annualSalaryMin")), positive_int(at("annualSalaryMax")), clean(at("salaryCurrency"))
    return {
        "source_job_id": at("id"),
        "url": at("url"),
        "title": _title("jobTitle"),
        "company": clean(at("companyName")),
        "location": clean(at("jobGeo")),
        "work_mode": F.lit("remote"),
        "salary_min": low,
        "salary_max": high,
        "salary_currency": currency,
        "salary_text": salary_text(low, high, currency, F.lit("year")),
        "posted_at": time_at("pubDate"),
        "description": html_to_text(F.coalesce(held("jobDescription"), held("jobExcerpt"))),
    }


def _himalayas() -> dict[str, Column]:
    period = F.coalesce(mapped(F.lower(F.coalesce(held("salaryPeriod"), F.lit("annual"))), HIMALAYAS_PERIODS), F.lit("year"))
    low, high, currency = positive_int(at("minSalary")), positive_int(at("maxSalary")), clean(at("currency"))
    places = F.array_join(F.filter(at("locationRestrictions", "array<string>"), lambda x: x != ""), ", ")
    return {
        "source_job_id": at("guid"),
        "url": F.coalesce(held("applicationLink"), at("guid")),
        "title": _title("title"),
        "company": clean(at("companyName")),
        "location": F.coalesce(F.nullif(places, F.lit("")), F.lit("Worldwide")),
        "work_mode": F.lit("remote"),
        "salary_min": F.when(period == "year", low),
        "salary_max": F.when(period == "year", high),
        "salary_currency": currency,
        "salary_text": salary_text(low, high, currency, period),
        "posted_at": time_at("pubDate"),
        "description": html_to_text(at("description")),
    }


@dataclass(frozen=True)
class Board:
    """in_jobs: records lie in body.jobs, else body is the list. shaped: paths that must be objects if present."""

    required: tuple[str, ...]
    project: Callable[[], dict[str, Column]]
    in_jobs: bool = True
    objects: tuple[str, ...] = ()


BOARDS = {
    "greenhouse": Board(("id", "title", "absolute_url"), _greenhouse, objects=("location",)),
    "lever": Board(("id", "text", "hostedUrl"), _lever, in_jobs=False, objects=("categories", "salaryRange")),
    "ashby": Board(("id", "title"), _ashby, objects=("compensation",)),
    "remotive": Board(("id", "title", "url"), _remotive),
    "remoteok": Board(("id", "position"), _remoteok, in_jobs=False),
    "jobicy": Board(("id", "jobTitle", "url"), _jobicy),
    "himalayas": Board(("guid", "title"), _himalayas),
}
