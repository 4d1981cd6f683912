"""Scalar functions, one row a case."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.urls import canonical_url
from tessera.operators.grouping import dedup_key, title_key
from tessera.operators.rules import title_matches


def values(spark, column, rows, schema="x string"):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_canonical_url(spark):
    cases = {
        "https://WWW.Careers.Example/jobs/4001/?utm_source=x&gh_src=y&b=2&a=1#apply": "https://careers.example/jobs/4001?a=1&b=2",
        "http://x.example": "http://x.example/",
        "https://x.example/a//": "https://x.example/a",
        "https://x.example/a?flag": "https://x.example/a?flag=",
        "https://x.example/a?q=a%20b&p=ü": "https://x.example/a?p=%C3%BC&q=a+b",
        "https://x.example/a?a-b=1&a=2": "https://x.example/a?a=2&a-b=1",
        " https://x.example/A?UTM_x=1 ": "https://x.example/A",
        "\thttps://x.example/A\u00a0\n": "https://x.example/A",
        "https://x.example/a?q=100%&p=%zz~*+b&&=x": "https://x.example/a?=x&p=%25zz~%2A+b&q=100%25",
    }
    assert values(spark, canonical_url(F.col("x")), list(cases)) == list(cases.values())
    assert values(spark, canonical_url(F.col("x")), [None]) == [None]


def test_html_to_text(spark):
    cases = {"<p>Hi&nbsp;there</p><ul><li>a</li><li>b</li></ul>": "Hi there\n\n- a\n- b", "<p>cut <b": "cut", "a<br/>b": "a\n\nb", "a<br>b": "a\nb", "<script>x</script>": None, "": None, None: None}
    cases |= {
        "<P CLASS='a > b'>x</P>y": "x\ny",
        "a < b & c &lt;b&gt; 3<4 <i>x</i>": "a < b & c <b> 3<4 x",
        "<!-- <p>no</p> --><style>p > a {}</style>yes<script>var a = '<!--';</script>!<br />?": "yes!\n\n?",
        "<prefix>a</prefix><p-x>b</p-x><hr>c": "ab\nc",
        "a\u00a0 \u2003b\u2028c\r\nd\n\n\n\ne": "a b\nc\nd\n\ne",
        "<script>never closed <p>x": None,
        "<li>one<li/>two": "- one\n- two",
    }
    assert values(spark, T.html_to_text(F.col("x")), list(cases)) == list(cases.values())


def test_clean_and_fold(spark):
    assert values(spark, T.clean(F.col("x")), ["  a \n b ", "a &amp; b", " a ", "", " ", None]) == ["a b", "a & b", "a", None, None, None]
    assert values(spark, T.fold(F.col("x")), ["Señor C++ / C#", "S.A.S.", "", None]) == ["senor c++ c#", "s a s", "", ""]


def test_parse_datetime(spark):
    cases = {
        "2026-09-25T14:00:00-04:00": datetime(2026, 9, 25, 18),
        "2026-09-25T14:00:00Z": datetime(2026, 9, 25, 14),
        "2026-09-25 14:00:00": datetime(2026, 9, 25, 14),
        "2026-09-25": datetime(2026, 9, 25),
        "1758891600000": datetime(2025, 9, 26, 13),
        "1758891600": datetime(2025, 9, 26, 13),
        "20260925": datetime(1970, 8, 23, 12, 2, 5),
        "2026": datetime(1970, 1, 1, 0, 33, 46),
        "Fri, 26 Sep 2026 10:00:00 GMT": datetime(2026, 9, 26, 10),
        "1758891600.5": None,
        "not a date": None,
        "": None,
        None: None,
    }
    assert values(spark, T.parse_datetime(F.col("x")), list(cases)) == list(cases.values())
    assert values(spark, T.parse_datetime(F.col("x"), numbers=True), ["1758891600.5"]) == [datetime(2025, 9, 26, 13, 0, 0, 500000)]


def test_numbers_and_pay(spark):
    assert values(spark, T.positive_int(F.col("x")), ["70000", "95000.7", "0", "-3", "x", "NaN", "inf", None]) == [70000, 95000, None, None, None, None, None, None]
    pay = T.salary_text(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    rows = [(5000, 5000, "USD", "month"), (95000, 125000, "USD", "year"), (None, 7, None, "hour"), (None, None, "USD", "year")]
    assert values(spark, pay, rows, "a long, b long, c string, d string") == ["USD 5,000 / month", "USD 95,000-125,000 / year", "7 / hour", None]


def test_work_mode(spark):
    rows = [("Hybrid, remote ok", "x"), ("Hybrid", "x"), ("Berlin", "x"), (None, "x"), (None, "Anywhere job")]
    assert values(spark, T.work_mode(F.col("a"), F.col("b")), rows, "a string, b string") == ["remote", "hybrid", "onsite", None, "remote"]


def test_keys(spark):
    assert values(spark, title_key(F.col("x")), ["Remote Data Engineer [US only]", "(x)"]) == ["data engineer", ""]
    rows = [(None, "Data Engineer"), ("Acme, Inc.", "Data Engineer (EU)"), ("Inc.", "x")]
    assert values(spark, dedup_key(F.col("a"), F.col("b")), rows, "a string, b string") == [None, "acme|data engineer", None]


@pytest.mark.parametrize("title,found", [("Senior Data Engineering Lead", True), ("Engineer, Big Data", True), ("Data Analyst", False), ("", False)])
def test_title_matches(spark, title, found):
    assert values(spark, title_matches(F.col("x"), ("Data Engineer",)), [title]) == [found]
