"""Payloads to annotated postings: explode, check, normalize, check again, filter."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import strip_tags, tidy_lines, unescape
from tessera.operators.rules import DEFAULT_ROLES, irrelevant, posting_problem
from tessera.sources.boards import BOARDS, FIELDS, absent, at, kind_of

_TYPES = {"salary_min": "bigint", "salary_max": "bigint", "posted_at": "timestamp_ntz"}
_PROBLEM = "struct<stage:string,rule:string,detail:string>"


def _problem(rule: str, detail: Column) -> Column:
    return F.struct(F.lit("extract").alias("stage"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


#: Parts texts that are decoded together; private characters that no text should hold.
_SEAM = "\uE000\uE001"


def _lever_sections() -> Column:
    """Lever's text: the plain part, each list as heading and body, the rest; blocks parted by an empty line."""
    lists = F.coalesce(at("lists", "array<variant>"), F.array().cast("array<variant>"))
    headings = F.transform(lists, lambda b: F.trim(F.regexp_replace(F.coalesce(F.try_variant_get(b, "$.text", "string"), F.lit("")), r"\s+", " ")))
    bodies = F.transform(lists, lambda b: strip_tags(F.coalesce(F.try_variant_get(b, "$.content", "string"), F.lit(""))))
    bodies = F.transform(F.split(unescape(F.array_join(bodies, _SEAM)), _SEAM), tidy_lines)
    blocks = F.zip_with(headings, bodies, lambda h, b: F.array_join(F.filter(F.array(h, b), lambda x: x != ""), "\n"))
    ends = [F.array(F.regexp_replace(F.coalesce(at(n), F.lit("")), r"^\s+|\s+\z", "")) for n in ("descriptionPlain", "additionalPlain")]
    return F.nullif(F.array_join(F.filter(F.concat(ends[0], blocks, ends[1]), lambda x: x != ""), "\n\n"), F.lit(""))


def _records(payloads: DataFrame, name: str) -> DataFrame:
    """One row a record of a board, and one with a problem for a payload whose records can't be listed."""
    board = BOARDS[name]
    own = payloads.where(F.col("source") == name)
    kind = F.coalesce(kind_of(F.col("body")), F.lit("VOID"))
    if board.in_jobs:
        jobs = F.try_variant_get("body", "$.jobs", "variant")
        listed = F.coalesce(kind_of(jobs), F.lit("ABSENT"))
        broken = ~kind.startswith("OBJECT") | ~(listed.startswith("ARRAY") | listed.startswith("OBJECT") | listed.isin("STRING", "ABSENT"))
    else:
        jobs = F.col("body")
        listed = kind
        broken = ~(kind.startswith("ARRAY") | kind.startswith("OBJECT") | (kind == "STRING"))
    shaped = own.withColumns({"broken": broken, "jobs": jobs, "listed": listed})
    unreadable = shaped.where("broken").select("payload_seq", "source", "key", "company", F.lit(-1).alias("pos"), F.lit(None).cast("variant").alias("record"), _problem("unreadable_payload", kind).alias("problem"))
    each = own.sparkSession.tvf.variant_explode(F.col("jobs").outer())
    exploded = shaped.where("NOT broken").withColumnRenamed("key", "payload_key").lateralJoin(each).select("payload_seq", "source", F.col("payload_key").alias("key"), "company", "pos", "listed", F.col("value").alias("record"))
    # an object in the place of a list is gone through by its names
    record = F.when(F.col("listed").startswith("ARRAY"), F.col("record")).otherwise(F.parse_json(F.lit('"name"')))
    records = exploded.withColumn("record", record).drop("listed")
    if name == "ashby":
        listed = F.try_variant_get("record", "$.isListed", "variant")
        off = listed.isNotNull() & (F.is_variant_null(listed) | at("isListed").isin("false", "0", "", "0.0", "[]", "{}"))
        records = records.where(~off)
    if name == "remoteok":
        records = records.where(kind_of(F.col("record")).startswith("OBJECT") & F.try_variant_get("record", "$.legal", "variant").isNull())
    return records.withColumn("problem", F.lit(None).cast(_PROBLEM)).unionByName(unreadable)


def _record_problem(name: str) -> Column:
    board = BOARDS[name]
    kind = kind_of(F.col("record"))
    named = F.when(kind.startswith("ARRAY"), "list").when(kind == "STRING", "str").when(kind == "BOOLEAN", "bool").when(kind == "VOID", "NoneType").when(kind == "BIGINT", "int").otherwise("float")
    missing = F.array_compact(F.array(*[F.when(absent(k), F.lit(k)) for k in board.required]))
    odd = F.lit(False)
    for path in board.objects:
        inner = F.try_variant_get("record", f"$.{path}", "variant")
        odd = odd | F.coalesce(inner.isNotNull() & ~F.is_variant_null(inner) & ~kind_of(inner).startswith("OBJECT") & ~at(path).isin("", "0", "false"), F.lit(False))
    return (
        F.when(~kind.startswith("OBJECT"), _problem("not_an_object", named))
        .when(F.size(missing) > 0, _problem("missing_raw_field", F.array_join(missing, ", ")))
        .when(odd, _problem("unparseable", F.lit("a field that should be an object is none")))
    )


def annotate(payloads: DataFrame, now: datetime, roles=DEFAULT_ROLES) -> DataFrame:
    """One row a record, and one for each payload that can't be read.

    seq orders rows as the input does; outcome is kept, filtered or rejected; problem says why a row
    is rejected. Payloads of unknown sources are passed over.
    """
    parts = None
    for name, board in BOARDS.items():
        rows = _records(payloads, name)
        rows = rows.withColumn("problem", F.coalesce("problem", _record_problem(name)))
        if name == "lever":
            rows = rows.withColumn("sections", _lever_sections())
        made = board.project()
        ident = F.coalesce(F.nullif(at("id"), F.lit("")), F.nullif(at("guid"), F.lit("")))
        normal = [made.get(f, F.lit(None)).cast(_TYPES.get(f, "string")).alias(f) for f in FIELDS]
        part = rows.select("payload_seq", "pos", "source", "problem", ident.alias("raw_id"), *normal)
        parts = part if parts is None else parts.unionByName(part)
    checked = parts.withColumn("raw_problem", F.col("problem")).withColumn("problem", F.coalesce("problem", posting_problem(now)))
    outcome = F.when(F.col("problem").isNotNull(), "rejected").when(irrelevant(roles).isNotNull(), "filtered").otherwise("kept")
    reject_id = F.when(F.col("raw_problem").isNotNull(), F.col("raw_id")).otherwise(F.col("source_job_id"))
    # a payload's records are fewer than 2**31
    seq = F.shiftleft(F.col("payload_seq"), 31) + F.col("pos") + 1
    return checked.withColumns({"outcome": outcome, "reject_id": reject_id, "seq": seq}).drop("raw_problem", "raw_id")


def source_stats(payloads: DataFrame, annotated: DataFrame) -> DataFrame:
    """source, payloads, records, rejected, filtered and kept; a source without records has its row."""
    read = payloads.where(F.col("source").isin(*BOARDS)).groupBy("source").agg(F.count("*").alias("payloads"))

    def share(outcome: str) -> Column:
        return F.count_if(F.col("outcome") == outcome).alias(outcome)

    seen = annotated.groupBy("source").agg(F.count_if(F.col("pos") >= 0).alias("records"), share("rejected"), share("filtered"), share("kept"))
    counts = ("records", "rejected", "filtered", "kept")
    return read.join(seen, "source", "left").select("source", "payloads", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


def rejections(annotated: DataFrame) -> DataFrame:
    return annotated.where("outcome = 'rejected'").select("seq", F.col("problem.stage").alias("stage"), "source", F.col("reject_id").alias("source_job_id"), F.col("problem.rule").alias("rule"), F.col("problem.detail").alias("detail"))
