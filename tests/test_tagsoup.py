"""The tag-soup reader: total, linear, and equal to the standard parser on plain documents."""

from __future__ import annotations

import random
import time
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scanpress.functions.tagsoup import END, START, TEXT, ExpansionError, decode_text, read_articles, read_meta, tokens
from scanpress.operators.extract import HEADER_FIELDS, extract_articles, parse_reply, py_extract_articles, with_reply_status
from scanpress.operators.filters import quarantine
from scanpress.schemas import RESPONSES

PIECES = [
    "<article>", "</article>", "<main>", "</main>", "<headline>", "</headline>", "<![1]>", "<![ x]]>", "<![foo[", "<![CDATA[", "]]>",
    "<!--", "-->", "<!", "<?", "</", "<", ">", "/>", '"', "'", "=", "&", "&amp;", "&#", "&#x41", "&#99999999999999999999;", ";", "a", " ",
    "\n", "\x00", "é", "<p>", "<br/>", "<script>", "</script", "<title>", "</title>", "<textarea>", "<plaintext>", '<a b="', "<meta name='x' content=",
    "<head>", "\ud800", "<article/>", "<ARTICLE x=1>",
]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join) | st.text(max_size=200))
def test_no_string_raises_and_tokens_cover_in_order(text):
    at = 0
    for kind, name, begin, end, _ in tokens(text, with_attributes=True):
        assert kind in (START, END, TEXT) and at <= begin < end <= len(text)
        assert (name is None) == (kind is TEXT)
        at = end
    for row in py_extract_articles(text):
        assert row["headline"]
    assert read_meta(text) is not None and decode_text(text) is not None


def test_random_bytes_never_raise():
    rng = random.Random(1)
    for _ in range(300):
        data = bytes(rng.choice(b"<>/!?[]-=\"' &;#ax\n\xc3\xa9\x00") for _ in range(rng.randrange(400)))
        articles, error = parse_reply("<article>" + data.decode("utf-8", "replace"))
        assert error is None and articles


class _Events(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.events = []

    def handle_starttag(self, tag, attrs):
        self.events.append((START, tag, attrs))

    def handle_endtag(self, tag):
        self.events.append((END, tag, None))

    def handle_data(self, data):
        self.events.append((TEXT, data, None))


def test_plain_documents_read_as_the_standard_parser_does():
    rng = random.Random(2)
    for _ in range(200):
        doc = "<!DOCTYPE html><?xml version='1.0'?>"
        for _ in range(rng.randint(1, 12)):
            tag = rng.choice(["p", "b", "h1", "article", "header"])
            attrs = rng.choice(["", ' class="a > b"', " id='x y' hidden", " data-n=5", ' T="A &amp; &quot;B&quot;"', "  \n a = 1 "])
            doc += f"<{tag}{attrs}>" + rng.choice(["", "text", "1 < 2", "R&D", "<!-- <b> -->", "<br>"]) + rng.choice(["", f"</{tag}>", f"</{tag} >"])
        parser = _Events()
        parser.feed(doc)
        parser.close()
        own = [(k, n if k is not TEXT else doc[b:e], a) for k, n, b, e, a in tokens(doc, with_attributes=True)]
        join = lambda events: "".join(f"<{k} {n} {a}>" if k is not TEXT else n for k, n, a in events)
        assert join(own) == join(parser.events), doc


@pytest.mark.parametrize(
    "unit",
    ["<article>", "<article></main>", "<headline>", "&amp;x", "&#65;", "<a x=\"", "<p title='", "<![CDATA[", "<![x", "<!--", "</x", "<x ", "<title>", "<textarea>", "<script ", "< ", "<p>", "</article>"],
)
def test_time_grows_with_the_text(unit):
    def seconds(n):
        start = time.process_time()
        py_extract_articles("<article><headline>" + unit * n)
        read_meta("<head>" + unit * n)
        return time.process_time() - start

    seconds(1000)
    assert seconds(40_000) < 40 * max(seconds(4_000), 0.02)  # ten times the text; quadratic growth would be a hundred


def test_nested_articles_share_their_first_fields():
    markup = "<article><article><headline>in</headline><main>m</main></article><headline>out</headline></article>"
    assert [(a["headline"], a["main"]) for a in read_articles(markup, HEADER_FIELDS, "main")] == [("in", "m"), ("in", "m")]
    later = "<article><headline>a</headline></article><article><main>b</main></article>"
    assert [(a["headline"], a["main"]) for a in read_articles(later, HEADER_FIELDS, "main")] == [("a", None), (None, "b")]
    with pytest.raises(ExpansionError):
        read_articles("<article><main>" * 5000, HEADER_FIELDS, "main")


def test_a_reply_that_cannot_be_read_is_set_aside_alone(spark):
    texts = ["<article><headline>A</headline><![1]></article>", "<article><main>" * 5000, "<article>b<![foo[</article>", "<![ x]]>", None]
    rows = [(f"p{i}", "m", 0, 1, "ai", t, '{"finish_reason":"STOP"}', 1, 1) for i, t in enumerate(texts)]
    replies = with_reply_status(spark.createDataFrame(rows, RESPONSES))
    assert {r.page_id: r.reason for r in quarantine(replies).collect()} == {
        "p1": "PARSE_ERROR:ExpansionError", "p3": "NO_ARTICLES", "p4": "NON_STRING",
    }
    assert sorted((r.page_id, r.headline) for r in extract_articles(replies).collect()) == [("p0", "A"), ("p2", "Untitled")]


def test_reading_ends_once_the_open_bodies_are_too_long(monkeypatch):
    from scanpress.functions import tagsoup

    read, whole = [], tagsoup.tokens
    monkeypatch.setattr(tagsoup, "tokens", lambda *a: (read.append(1) or t for t in whole(*a)))
    markup = "<article><main>" * 3000 + "x" + "</main></article>" * 10
    with pytest.raises(tagsoup.ExpansionError):
        tagsoup.read_articles(markup, ("headline",), "main")
    assert len(read) < 3000  # of 6,021
    # Within the bound, nested and shared bodies are all read.
    markup = "<article><article><main>" * 50 + "x" + "</main></article></article>" * 50
    rows = tagsoup.read_articles(markup, ("headline",), "main")
    assert len(rows) == 100 and rows[0]["main"] == rows[1]["main"] and rows[99]["main"] == "x"


def test_malformed_status_parses_replies_once(spark):
    from scanpress.plans.queries import q_malformed_status

    plan = q_malformed_status(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan  # the checked replies were written, and both sides of the join read them
