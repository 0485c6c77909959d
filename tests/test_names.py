from __future__ import annotations

from pyspark.sql import functions as F

from scanpress.functions import names as nm
from scanpress.operators import filters


def test_scan_name_ledger_l1(spark):
    df = spark.createDataFrame([("gazette_1001-001",), ("gazette-daily-2011_2-10",), ("nodash",)], "stem string")
    got = df.select(nm.scan_issue("stem"), nm.scan_page("stem")).collect()
    assert [tuple(r) for r in got] == [("gazette_1001", 1), ("gazette-daily-2011_2", 10), (None, None)]


def test_article_name_ledger_l1_l2_l3(spark):
    names = ["gazette_1001-001_x.html", "gazette-daily-2011_2-10_x.html", "gazette_1001.html", "gazette_1-2-3_x.html",
             "gazette_1001-001_a_b.html"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    parsed = {r.file_name: (r.issue, r.page) for r in filters.parse_article_names(df).collect()}
    assert parsed == {
        "gazette_1001-001_x.html": ("1001", 2),
        "gazette-daily-2011_2-10_x.html": ("2", 11),
        "gazette_1001-001_a_b.html": ("1001", 2),
    }
    bad = sorted(r.file_name for r in filters.bad_names(df).collect())
    assert bad == ["gazette_1-2-3_x.html", "gazette_1001.html"]


def test_scan_key_ledger_l4(spark):
    df = spark.createDataFrame([("a_b.html",), ("gazette_1001-001_x.html",), ("abc",)], "n string")
    assert [r[0] for r in df.select(nm.scan_key("n")).collect()] == ["a_b.html", "gazette_1001-001", "abc"]


def test_file_stem(spark):
    df = spark.createDataFrame([("a.b.html",), (".bashrc",), ("plain",)], "n string")
    assert [r[0] for r in df.select(nm.file_stem("n")).collect()] == ["a.b", ".bashrc", "plain"]


def test_page_overflow_is_null_not_error(spark):
    df = spark.createDataFrame([("gazette_1-99999999999_x.html",)], "n string")
    assert df.select(nm.article_page(F.col("n"))).collect()[0][0] is None
