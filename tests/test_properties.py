from __future__ import annotations

import random
import textwrap

from pyspark.sql import functions as F

from scanpress.functions import text as tx
from scanpress.operators.extract import is_regular_markup, py_extract_articles, regular_articles
from scanpress.operators.filters import quarantine
from scanpress.operators.extract import with_reply_status
from scanpress.plans import fixtures as fx

SF = "/root/testdata/sf0.001"
WORDS = ["a", "bb", "news", "Élan", "straße", "x" * 30, "y" * 70, "well-known", "--", "ﬁ", "½", "Ünïcödé", "!?", "日本",
         "Ἀθῆναι", "Москва", "ǅemal", "x²", "wait…", "a—b", "€5", "cafe\u0301", "ｆｕｌｌ", "Œuvre", "ĳssel", "Ωmega"]


def _random_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    seps = [" ", "  ", "\t", "\n", "  ", "　"]
    out = []
    for _ in range(n):
        k = rng.randint(0, 14)
        out.append(rng.choice(["", " "]) + "".join(rng.choice(WORDS) + rng.choice(seps) for _ in range(k)))
    return out


def _random_block_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    blocks = [(0x80, 0x52F), (0x1E00, 0x1FFF), (0x2000, 0x20CF)]
    out = []
    for _ in range(n):
        chars = []
        for _ in range(rng.randint(1, 30)):
            lo, hi = rng.choice(blocks)
            chars.append(chr(rng.randint(lo, hi)) if rng.random() < 0.5 else rng.choice("abc XYZ 09"))
        out.append("".join(chars))
    return out


def test_catalyst_slug_and_shorten_equal_python(spark):
    values = _random_texts(11, 300) + _random_block_texts(3, 300)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = df.select("i", tx.slugify_headline("v").alias("slug"), tx.shorten_text("v").alias("short")).orderBy("i").collect()
    for row, v in zip(got, values):
        assert row.slug == tx.py_headline_slug(v), v
        assert row.short == textwrap.shorten(v, 60, placeholder=" [...]"), v


def _random_reply(rng: random.Random) -> str:
    parts = []
    for _ in range(rng.randint(0, 4)):
        header = ""
        for tag in ("headline", "strapline", "author_name", "category"):
            if rng.random() < 0.7:
                inner = rng.choice([
                    "", " ", "Plain", "A &amp; B", "x <b>y</b> z", "  spaced  out  ", "&lt;tag&gt;",
                    "&nbsp;X&nbsp;", "a\xa0b", "tab\there", "new\nline <br/> next", "&quot;q&quot; &#39;s",
                    "<i> </i>", "Ünïcödé straße",
                ])
                header += f"<{tag}>{inner}</{tag}>"
        body = "" if rng.random() < 0.2 else f"<main>{rng.choice(['<p>p</p>', '', '<p>a<b>b</p>', 'text'])}</main>"
        parts.append(f"<article><header>{header}</header>{body}</article>" + rng.choice(["", "\n", "<hr>"]))
    return rng.choice(["", "Intro. "]) + "".join(parts)


def test_regex_path_equals_parser_path(spark):
    rng = random.Random(5)
    replies = [_random_reply(rng) for _ in range(200)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, m string")
    rows = df.select("i", is_regular_markup("m").alias("ok"), regular_articles("m").alias("a")).orderBy("i").collect()
    for row, markup in zip(rows, replies):
        assert row.ok, markup
        assert [a.asDict() for a in row.a] == py_extract_articles(markup), markup


def test_names_unique_and_quarantine_partition(spark):
    docs = fx.article_docs(fx.doc_articles(fx.read_table(spark, SF, "documents")))
    assert docs.select("file_name").distinct().count() == docs.count()
    replies = with_reply_status(fx.responses(fx.read_table(spark, SF, "pages")))
    ok = replies.filter(F.col("status") == "OK").count()
    assert ok + quarantine(replies).count() == replies.count()


def _random_meta_doc(rng: random.Random) -> str:
    values = ["plain", "A &amp; B", "&lt;tag&gt;", "&quot;quoted&quot;", "it&#39;s", "", "Ünïcödé", "x&nbsp;y"]
    metas = []
    for _ in range(rng.randint(0, 6)):
        name = rng.choice(["title", "Title", "author", "subtitle", "slug", "category", "AUTHOR"])
        value = rng.choice(values)
        if rng.random() < 0.15:
            metas.append(f"<meta content=\"{value}\" name=\"{name}\">")  # irregular order: parser path
        else:
            metas.append(f'<meta name="{name}" content="{value}"{rng.choice(["", "/", " /"])}>')
    return "<html><head>" + "".join(metas) + "</head><body><p>b</p></body></html>"


def test_meta_regex_path_equals_parser(spark):
    from scanpress.functions.markup import py_html_meta, with_html_meta

    rng = random.Random(9)
    docs = [_random_meta_doc(rng) for _ in range(200)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, html string")
    corpus = with_html_meta(df, "html", "m").orderBy("i").collect()
    reader = with_html_meta(df, "html", "m", lower_names=False, head_only=True).orderBy("i").collect()
    for row_c, row_r, doc in zip(corpus, reader, docs):
        assert dict(row_c.m) == py_html_meta(doc, True, False), doc
        assert dict(row_r.m) == py_html_meta(doc, False, True), doc


def test_linear_tag_and_comment_removal_equal_regex(spark):
    import re as regex
    import time

    from scanpress.functions.text import remove_tags
    from scanpress.operators.extract import remove_comments

    rng = random.Random(12)
    parts = ["<", ">", "<p>", "</b>", "<!--", "-->", "--", "a", " ", "\n", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", remove_tags("t").alias("a"), remove_comments("t").alias("b")).orderBy("i").collect()
    for row, text in zip(rows, texts):
        assert row.a == regex.sub(r"<[^>]*>", "", text), text
        assert row.b == regex.sub(r"(?s)<!--.*?-->", "", text), text
    hostile = spark.createDataFrame([("x < y <!-- " * 30000,)], "t string")
    start = time.time()
    hostile.select(remove_tags("t"), remove_comments("t")).collect()
    assert time.time() - start < 60


def _py_html_to_text(x: str) -> str:
    """Our plain-text rule written with Python's re, as the reference for the Spark form."""
    import html
    import re as regex
    from html.entities import html5

    from scanpress.functions.text import BLOCK_TAGS

    out = regex.sub(r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->", "", x)
    out = regex.sub(rf"(?i)</?({BLOCK_TAGS})\b[^>]*>", "\n", out)
    out = regex.sub(r"<[^>]*>", "", out)
    def decoded(match):  # noqa: ANN001, ANN202
        if not match.group().startswith("&#") and match.group()[1:] not in html5:
            return match.group()
        return html.unescape(match.group()).replace("\xa0", " ")

    out = regex.sub(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", decoded, out)
    out = regex.sub(r"[ \t]+", " ", out)
    out = regex.sub(r"[ \t\r]*\n[ \t\r\n]*", "\n\n", out)
    return regex.sub(r"^[ \t\r\n]+|[ \t\r\n]+$", "", out)


def test_html_to_text_equals_python_rule(spark):
    from scanpress.functions.text import html_to_text

    rng = random.Random(8)
    parts = ["<", ">", "<p>", "</p>", "<p class=x", "<br/>", "<b>", "text", " ", "\n", "&amp;", "&lt;", "<!--", "-->",
             "<script>", "</script>", "<P>", "<pre>", "é", "&rsquo;", "&#8217;", "&#x2014;", "&nbsp;", "&#160;", "&",
             "rsquo;", "&bogus;", "&notit;", "&copy", "&#0;", "&#x110000;", "&#150;", ";", "\xa0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 16))) for _ in range(1500)]
    texts += ["It&rsquo;s &pound;5 &mdash; caf&eacute; &#8217;98", "&amp;rsquo; &amp;amp;lt;"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in df.select("i", html_to_text("t")).orderBy("i").collect()]
    for text, value in zip(texts, got):
        assert value == _py_html_to_text(text), text
    # digits beyond what Python converts at once
    long = spark.createDataFrame([("&#" + "0" * 9000 + "65;" + "&#" + "9" * 9000 + ";",)], "t string")
    assert long.select(html_to_text("t")).first()[0] == "A\ufffd"


def test_script_and_comment_removal_equals_regex_and_is_linear(spark):
    import re as regex
    import time

    from scanpress.functions.text import SCRIPTS_AND_COMMENTS, remove_scripts_and_comments

    rng = random.Random(21)
    parts = ["<script>", "</script>", "<style x>", "</STYLE>", "<SCRIPT a=1>", "<!--", "-->", "<", ">", "a", " ", "\n",
             "s", "!", "<script", "é", "", "", "s", "!"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in df.select("i", remove_scripts_and_comments("t")).orderBy("i").collect()]
    for text, value in zip(texts, got):
        assert value == regex.sub(SCRIPTS_AND_COMMENTS, "", text), repr(text)
    hostile = spark.createDataFrame([("x <!-- <script> " * 30000,)], "t string")
    start = time.time()
    hostile.select(remove_scripts_and_comments("t")).collect()
    assert time.time() - start < 60
