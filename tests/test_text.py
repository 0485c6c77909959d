from __future__ import annotations

import textwrap

from conftest import col_values
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from scanpress.functions import text as tx


def test_shorten_ledger_l16(spark):
    values = ["a" * 80, "one " + "z" * 70, "a" * 54 + " bbbbbb", "short   headline \t here", "x" * 60]
    got = col_values(spark, values, tx.shorten_text)
    assert got == [textwrap.shorten(v, width=60, placeholder=" [...]") for v in values]
    assert got[:3] == ["[...]", "one [...]", "a" * 54 + " [...]"]


def test_shorten_hyphen_uses_textwrap(spark):
    values = ["well-known " * 8, "state-of-the-art machine-learning approaches for newspaper-scan reading"]
    assert col_values(spark, values, tx.shorten_text) == [textwrap.shorten(v, 60, placeholder=" [...]") for v in values]


def test_slug_ledger_l16_l17(spark):
    values = ["a" * 80, "one " + "z" * 70, "Élan vital — Δ", "straße ﬁ ½", "日本語", "Hello, World!"]
    got = col_values(spark, values, tx.slugify_headline)
    assert got == ["", "one", "elan-vital", "strae-fi-12", "", "hello-world"]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=90))
def test_slug_python_properties(text):
    slug = tx.py_headline_slug(text)
    assert tx.py_slugify(slug) == slug
    import re

    assert re.fullmatch(r"([a-z0-9]+(-[a-z0-9]+)*)?", slug)


def test_slug_catalyst_equals_python(spark):
    values = [
        "Plain ASCII headline",
        "  Many   spaces\tand\nnewlines  ",
        "A very long ASCII headline that certainly goes past the sixty character limit of shorten",
        "Mixed-case HEADLINE with-hyphen",
        "Ümlaut and accents: café, naïve, Ærø",
        "Tabs and unicode spaces",
        "",
        "!!!",
    ]
    assert col_values(spark, values, tx.slugify_headline) == [tx.py_headline_slug(v) for v in values]


def test_element_text_ledger_l12(spark):
    values = ["Foo <b>Bar</b>", "  a &amp; b  ", "<i> x </i>\n<i>y</i>", ""]
    assert col_values(spark, values, tx.element_text) == ["FooBar", "a & b", "xy", ""]


def test_html_to_text_rule(spark):
    html = (
        "<html><head><title>T</title><style>p{}</style></head><body><!-- c --><p>One &amp; <b>two</b></p>"
        "<div>Three&nbsp;four</div><pre>x</pre><script>var a='<p>'</script></body></html>"
    )
    assert col_values(spark, [html], tx.html_to_text) == ["T\n\nOne & two\n\nThree four\n\nx"]


def test_article_text_and_markdown(spark):
    df = spark.createDataFrame(
        [("H", "", "Ann", "<p>Body</p>"), ("H2", "Sub", None, None)],
        "h string, s string, a string, b string",
    )
    got = [r[0] for r in df.select(tx.article_text("h", "s", "a", "b")).collect()]
    assert got == ["H\n\nAuthor: Ann\n\nBody", "H2\n\nSub\n\n"]
    md = [r[0] for r in df.select(tx.article_markdown("h", "s", "a", "b")).collect()]
    assert md == ["# H\n\nAnn\n\n<p>Body</p>", "# H2\n\n**Sub**\n\n"]


def test_text_is_made_once_below_higher_order_functions(spark):
    """Every pass over the document has one mention in what the references are decoded from: there Spark shares nothing."""
    from scanpress.functions.text import html_to_text

    df = spark.range(1).select(F.concat(F.lit("<p>a&amp;b</p>"), F.col("id").cast("string")).alias("h"))
    plan = df.select(html_to_text("h").alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("(?i)</?(p|br|") == 1
    assert plan.count("(script|style)[^>]*>.*?</") == 2  # plainly, and marked for texts whose openers never close


def test_few_row_groups_are_spread(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from scanpress.session import spread

    target = spark.sparkContext.defaultParallelism
    table = pa.table({"n": list(range(4000)), "text": [random_text(i) for i in range(4000)]})
    pq.write_table(table, f"{tmp_dir}/one.parquet", row_group_size=4000, compression="none", use_dictionary=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = spark.read.parquet(f"{tmp_dir}/one.parquet")
        assert df.rdd.getNumPartitions() >= target  # many splits, of which one holds all rows
        rows = spread(df).rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(rows) == 4000 and max(rows) <= 2 * 4000 / target


def random_text(seed):
    import random

    return "".join(random.Random(seed).choices("abcdefghijklmnopqrstuvwxyz", k=400))
