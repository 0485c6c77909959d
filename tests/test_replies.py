from __future__ import annotations


from scanpress.functions.markup import strip_fences
from scanpress.functions.replies import finish_reason
from scanpress.operators.extract import extract_articles, py_extract_articles, with_reply_status
from scanpress.schemas import RESPONSES


def _replies(spark, rows):
    full = [(f"p{i}", "gemini-2.0", 0, 1, "ai", content, meta, 10, 5) for i, (content, meta) in enumerate(rows)]
    return spark.createDataFrame(full, RESPONSES)


def test_finish_reason_ledger_l9(spark):
    metas = [
        '{"finish_reason":"","stop_reason":"stop"}',
        '{"prompt_feedback":{"block_reason":0}}',
        '{"prompt_feedback":{"block_reason":"SAFETY"}}',
        "{}",
        '{"finish_reason":"STOP"}',
    ]
    df = spark.createDataFrame([(m,) for m in metas], "m string")
    assert [r[0] for r in df.select(finish_reason("m")).collect()] == ["stop", "missing", "SAFETY", "missing", "STOP"]


def test_strip_fences_ledger_l10_l11(spark):
    texts = [
        "a```html<x/>```b```<y/>```c",
        "```markdown\n<x/>\n```",
        "only ``` one fence",
        'pre <?xml version="1.0" encoding="UTF-8"?>\n<article/>  ',
        "```xml\n<?xml encoding='x'?>\n<a>1</a>\n```",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(strip_fences("t")).collect()]
    assert got == ["<x/>```b```<y/>", "markdown\n<x/>", "only ``` one fence", "<article/>", "<a>1</a>"]


def test_status_and_extraction_ledger(spark):
    rows = [
        ("```html\n<article><header><headline>Foo <b>Bar</b></headline><strapline></strapline></header>"
         "<main><p>x</p></main></article>\n```", '{"finish_reason":"STOP"}'),
        ("<article><header><headline> </headline></header></article>", '{"stop_reason":"end_turn"}'),
        ("no articles here", '{"finish_reason":"STOP"}'),
        ("<article><headline>A</headline></article>", '{"finish_reason":"MAX_TOKENS"}'),
        ("<article><headline>Out</headline><article><headline>In</headline><main>m</main></article></article>",
         '{"finish_reason":"stop"}'),
    ]
    replies = with_reply_status(_replies(spark, rows))
    status = [r.status for r in replies.orderBy("page_id").collect()]
    assert status == ["OK", "OK", "NO_ARTICLES", "BAD_FINISH:MAX_TOKENS", "OK"]
    arts = extract_articles(replies).orderBy("page_id", "ordinal").collect()
    got = [(a.page_id, a.ordinal, a.headline, a.strapline, a.body_html) for a in arts]
    assert got == [
        ("p0", 0, "FooBar", "", "<p>x</p>"),  # L12, L13
        ("p1", 0, "Untitled", None, None),  # L13, L26
        ("p4", 0, "Out", None, "m"),  # L14: outer article's first main comes from the inner one
        ("p4", 1, "In", None, "m"),
    ]


def test_multi_generation_and_non_string(spark):
    df = spark.createDataFrame(
        [("p0", "m", 0, 2, "ai", "<article/>", "{}", 1, 1), ("p1", "m", 0, 1, "ai", None, '{"finish_reason":"STOP"}', 1, 1),
         ("p2", "m", 0, 1, "human", "<article/>", '{"finish_reason":"STOP"}', 1, 1)],
        RESPONSES,
    )
    got = [r.status for r in with_reply_status(df).orderBy("page_id").collect()]
    assert got == ["MULTI_GENERATION", "NON_STRING", "NOT_AI_MESSAGE"]


def test_parser_path_equals_regex_path(spark):
    markup = (
        "<article><header><headline>T &amp; U</headline><author_name>Ann</author_name>"
        "<category>News</category></header><main><p>a<b>b</p></main></article>"
        "<article><header><headline></headline></header><main><p>c</p></main></article>"
    )
    upper = markup.replace("<article>", '<ARTICLE id="1">').replace("</article>", "</Article>")
    df = _replies(spark, [(markup, '{"finish_reason":"STOP"}'), (upper, '{"finish_reason":"STOP"}')])
    arts = extract_articles(df).orderBy("page_id", "ordinal").collect()
    fields = [(a.ordinal, a.headline, a.strapline, a.author_name, a.category, a.body_html) for a in arts]
    assert fields[:2] == fields[2:]
    assert fields[0] == (0, "T & U", None, "Ann", "News", "<p>a<b>b</p>")
    assert py_extract_articles(markup) == [
        {"headline": "T & U", "strapline": None, "author_name": "Ann", "category": "News", "body_html": "<p>a<b>b</p>"},
        {"headline": "Untitled", "strapline": None, "author_name": None, "category": None, "body_html": "<p>c</p>"},
    ]


def test_unclosed_article_runs_to_end():
    got = py_extract_articles("<article><headline>X</headline><main>m")
    assert got == [{"headline": "X", "strapline": None, "author_name": None, "category": None, "body_html": "m"}]


def test_entity_rules_follow_the_reference_parser(spark):
    # Named references need their semicolon (and an HTML 4 name) to be decoded; numeric ones are decoded.
    markup = "<article><headline>AT&amp T &amp; Q&A &eacute; &#39;x&#x27; &bogus; end&amp</headline></article>"
    assert py_extract_articles(markup)[0]["headline"] == "AT&amp T & Q&A é 'x' &bogus; end&amp"
    plain = "<article><headline>R&amp;D &lt;1&gt;</headline></article>"
    bare = "<article><headline>R&amp D</headline></article>"
    df = _replies(spark, [(plain, '{"finish_reason":"STOP"}'), (bare, '{"finish_reason":"STOP"}')])
    got = [r.headline for r in extract_articles(df).orderBy("page_id").collect()]
    assert got == ["R&D <1>", "R&amp D"]


def test_encoding_line_matches_python_search_and_is_linear(spark):
    import random
    import time

    from scanpress.functions.markup import after_encoding_line

    rng = random.Random(4)
    parts = ["<", ">", "\n", "encoding", "x", " ", '<?xml version="1.0" encoding="UTF-8"?>', "<a", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(500)]

    def scanned(text):
        """What follows the first tag naming an encoding that ends its line, found character by character."""
        opened = None
        for at, char in enumerate(text):
            if char == "<" and opened is None:
                opened = at
            elif char == ">" and opened is not None:
                if "encoding" in text[opened + 1 : at] and text[at + 1 : at + 2] == "\n":
                    return text[at + 2 :]
                opened = None
        return text

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in df.select("i", after_encoding_line("t")).orderBy("i").collect()]
    for text, value in zip(texts, got):
        assert value == scanned(text), text
    # Many unclosed "<" and no ">": a backtracking search would be quadratic here.
    hostile = spark.createDataFrame([("encoding " + "a < " * 50000,)], "t string")
    start = time.time()
    assert len(hostile.select(after_encoding_line("t")).collect()[0][0]) == 200009
    assert time.time() - start < 60


def test_unclosed_elements_nest_without_limit():
    soup = "<article><headline>H</headline><main>" + "<p>x" * 5000 + "<b>y" * 5000 + "</i></main></article>"
    row = py_extract_articles(soup)[0]
    assert row["headline"] == "H" and row["body_html"].count("<p>") == 5000


def test_failed_model_call_names_its_error(spark):
    rows = [("p", "m", 0, None, None, None, None, None, None, "RuntimeError: rate limited")]
    schema = (
        "page_id string, model string, attempt int, n_generations int, message_type string, content string, "
        "response_metadata string, input_tokens long, output_tokens long, error string"
    )
    from scanpress.operators.extract import with_reply_status

    assert with_reply_status(spark.createDataFrame(rows, schema)).first().status == "MODEL_ERROR:RuntimeError"


def test_bare_less_than_is_text(spark):
    markup = "<article><headline>5 < 6 > 4</headline><main>b</main></article>"
    df = _replies(spark, [(markup, '{"finish_reason":"STOP"}')])
    assert [r.headline for r in extract_articles(df).collect()] == ["5 < 6 > 4"]


def test_every_reply_is_extracted_or_quarantined(spark):
    from scanpress.operators.filters import quarantine

    stop = '{"finish_reason":"STOP"}'
    texts = [
        '<script>var a="<article>"</script>',
        "<script>'<article></article>'</script><article><headline>A</headline></article>",
        "<![CDATA[<article></article>]]>",
        '<b title="x > <article>">y</b>',
        "text <article",
        "<article><headline>5 < 6 > 4</headline></article>",
        "<article><headline>S</headline><main>" + "<p>x" * 5000 + "</main></article>",
        "<article>",
        "<!DOCTYPE html><article><headline>D</headline></article>",
        "<style><article></style>",
    ]
    replies = with_reply_status(_replies(spark, [(t, stop) for t in texts]))
    counted = {r.page_id: (r.n_articles, r.status) for r in replies.collect()}
    found = {r.page_id: r["count"] for r in extract_articles(replies).groupBy("page_id").count().collect()}
    refused = {r.page_id for r in quarantine(replies).collect()}
    pages = {f"p{i}" for i in range(len(texts))}
    assert found.keys() | refused == pages and not found.keys() & refused
    assert {p: n for p, (n, status) in counted.items() if status == "OK"} == found
    assert {"p0", "p2", "p3", "p4", "p9"} <= refused and found["p1"] == 1 and found["p6"] == 1
