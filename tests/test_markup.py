from __future__ import annotations

from pyspark.sql import functions as F

from scanpress.functions.markup import article_fields, article_html, html_meta, py_html_meta


def test_article_html_escapes_and_skips_empty_ledger_l18_l25(spark):
    df = spark.createDataFrame(
        [('A & "B"\nC', "", None, "", "News", "<p>x</p>")],
        "h string, s string, a string, slug string, c string, b string",
    )
    html = df.select(article_html("h", "s", "a", "slug", "c", "b")).collect()[0][0]
    assert html == (
        '<html><head><meta name="title" content="A &amp; &quot;B&quot; C"/>'
        '<meta name="category" content="News"/></head><body><main><p>x</p></main></body></html>'
    )


def test_round_trip_is_stable(spark):
    df = spark.createDataFrame([("T <1> & 'q'", "Sub", "Ann", "t-1-q", None, "<p>b</p>")],
                               "h string, s string, a string, slug string, c string, b string")
    doc = df.select(article_html("h", "s", "a", "slug", "c", "b").alias("html"))
    back = doc.select(*article_fields(html_meta("html"))).collect()[0]
    assert tuple(back) == ("T <1> & 'q'", "Sub", "Ann", None)


def test_meta_case_ledger_l21(spark):
    html = '<html><head><meta name="Title" content="a"><meta content="z" name="author"></head><body></body></html>'
    df = spark.createDataFrame([(html,)], "html string")
    corpus = df.select(html_meta("html").alias("m")).collect()[0].m
    reader = df.select(html_meta("html", lower_names=False, head_only=True).alias("m")).collect()[0].m
    assert corpus == {"title": "a", "author": "z"}
    assert reader == {"Title": "a", "author": "z"}
    assert df.select(article_fields(html_meta("html", False, True))[0]).collect()[0][0] == "Untitled"


def test_meta_last_duplicate_wins(spark):
    html = '<meta name="title" content="one"/><meta name="title" content="two"/>'
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(html_meta("html")).collect()[0][0] == {"title": "two"}
    assert py_html_meta(html) == {"title": "two"}


def test_deformed_document_ledger_l23(spark):
    from scanpress.functions.markup import document_status

    df = spark.createDataFrame([("<html><p>no head</p></html>",), ("<html><head></head><body>x</body></html>",)], "html string")
    assert [r[0] for r in df.select(document_status("html")).collect()] == ["DEFORMED", "OK"]
    fields = df.select(*article_fields(html_meta("html", False, True))).collect()
    assert tuple(fields[0]) == ("Untitled", None, None, None)


def test_corpus_text_excludes_headline_ledger_l24(spark):
    from scanpress.functions.text import article_text, html_to_text

    df = spark.createDataFrame([("Big News", None, "Ann", "<p>Body text.</p>")], "h string, s string, a string, b string")
    doc = df.select(article_html("h", "s", "a", F.lit("big-news"), F.lit(None).cast("string"), "b").alias("html"), "*")
    corpus_txt, full_txt = doc.select(html_to_text("html"), article_text("h", "s", "a", "b")).collect()[0]
    assert corpus_txt == "Body text."
    assert full_txt == "Big News\n\nAuthor: Ann\n\nBody text."


def test_meta_tags_in_comments_and_scripts_are_no_tags_and_entities_decode(spark):
    from scanpress.functions.markup import html_meta, with_html_meta

    meta = '<meta name="title" content="{}"/>'
    docs = {
        f"<html><head>{meta.format('New')}<!-- {meta.format('Old')} --></head></html>": "New",
        f"<html><head>{meta.format('New')}<script>var s='{meta.format('Js')}'</script></head></html>": "New",
        f"<html><head>{meta.format('New')}<title>{meta.format('T')}</title></head></html>": "New",
        f"<html><head><title>T</title>{meta.format('It&rsquo;s &#8217;98 &amp; on')}</head></html>": "It\u2019s \u201998 & on",
        f"<html><head>{meta.format('Plain &amp; regular')}</head></html>": "Plain & regular",
    }
    df = spark.createDataFrame([(h,) for h in docs], "html string")
    rows = with_html_meta(df.withColumn("m", html_meta("html")), "html", "n").collect()
    for row in rows:
        if "<title><meta" not in row.html:  # whether a title holds tags is the parser's own rule
            assert row.m["title"] == docs[row.html], row.html
        assert row.n == row.m, row.html
