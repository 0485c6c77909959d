"""Replies to articles (SC-13, SC-14, GEN-1).

``with_reply_status`` adds the reply checks as columns; ``extract_articles``
turns every ``<article>`` of an accepted reply into one row.

Markup is split into two kinds in one pass:

* regular rows (plain lower-case tags, balanced and not nested, only basic
  entities) are taken apart by Catalyst regular expressions inside
  ``transform`` - no Python;
* the rest go to a total tag-soup reader (:mod:`scanpress.functions.tagsoup`)
  in a vectorised UDF, which receives NULL for every regular row.  No reply can
  stop the others: one that cannot be read becomes ``PARSE_ERROR``.

Both produce the same ``array<struct>`` so the result is one ``posexplode``.
The status needs the number of articles, so replies are parsed with the checks
and extraction takes the parsed articles from there.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.functions.markup import strip_fences
from scanpress.functions.replies import finish_reason, response_status
from scanpress.functions.tagsoup import read_articles
from scanpress.functions.text import _c, element_text, has_rare_space, upto_last

COMMENT = r"(?s)<!--.*?-->"
ARTICLE_BLOCK = r"(?s)<article>(.*?)</article>"
# The element names a reply article is built from.
HEADER_FIELDS = ("headline", "strapline", "author_name", "category")
FIELD_TAGS = (*HEADER_FIELDS, "main")

ARTICLE_FIELDS = T.StructType([
    T.StructField("headline", T.StringType()),
    T.StructField("strapline", T.StringType()),
    T.StructField("author_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("body_html", T.StringType()),
])
PARSED = T.StructType([T.StructField("articles", T.ArrayType(ARTICLE_FIELDS)), T.StructField("error", T.StringType())])


def remove_comments(col: Column | str) -> Column:
    """``re.sub("(?s)<!--.*?-->", "", text)`` in linear time.

    A ``<!--`` after the last ``-->`` can never close, and the lazy search
    would rescan the tail from each of them; the regex therefore runs on the
    text up to the last ``-->`` and the tail is kept as it is.
    """
    text = _c(col)
    return F.concat(F.regexp_replace(upto_last(text, "-->"), COMMENT, ""), F.substring_index(text, "-->", -1))


def reply_markup(content: Column | str) -> Column:
    """Reply markup with fences, encoding line and comments removed."""
    return remove_comments(strip_fences(content))


# Markup in which an article tag may be text: elements with raw content, declarations, instructions, quoted values.
HIDING = r"(?i)<(?:script|style|textarea|title|xmp|iframe|noembed|noframes|plaintext)[\s/>]|<[!?]|=\s*(?:\"[^\"]*<article|'[^']*<article)"


def with_reply_status(responses: DataFrame) -> DataFrame:
    """Add ``finish_reason``, ``markup``, ``is_regular``, ``parsed``, ``n_articles`` and ``status`` to reply rows.

    A row whose ``error`` column says that the model call failed gets ``MODEL_ERROR:<error type>``, one that the parser
    could not read ``PARSE_ERROR:<error type>``.
    """
    checked = response_status("n_generations", "message_type", "finish_reason", "content", "n_articles", "parsed.error")
    if "error" in responses.columns:
        failed = F.concat(F.lit("MODEL_ERROR:"), F.substring_index("error", ":", 1))
        checked = F.when(F.col("error").isNotNull(), failed).otherwise(checked)
    read = responses.withColumn("finish_reason", finish_reason("response_metadata")).withColumn("markup", reply_markup("content"))
    return with_parsed(read).withColumn("status", checked)


# ---------------------------------------------------------------- regular path


# Start and end tags of the elements extraction reads, in any case and with
# any attributes.
STRUCTURE_TAG = r"(?i)</?(?:article|headline|strapline|author_name|category|main)(?:[\s/][^>]*)?>"
# Stands for a field that opens and closes; no tag begins with it.
_PAIR = "+"
ENTITY = r"&#?[a-zA-Z0-9]+;?"
# Fixed value: the entities the regular path decodes.
KNOWN_ENTITIES = ("&amp;", "&lt;", "&gt;", "&quot;", "&#39;", "&nbsp;")


def structure_tags(markup: Column | str) -> Column:
    """The structural tags of the markup, in order (one regex pass)."""
    return F.regexp_extract_all(upto_last(markup), F.lit(STRUCTURE_TAG), 0)


def is_regular_markup(markup: Column | str, tags: Column | str | None = None) -> Column:
    """True when regular expressions read the markup exactly as a parser would.

    One pass collects the structural tags; two replacements over what they
    are together check that every tag is plain lower case, that articles
    neither nest nor stay open, and that field elements open and close
    inside one article without nesting.  A second pass checks that
    every reference-like ``&name`` is one of the decoded entities, written
    with its semicolon (anything else is left to the parser).
    """
    m = _c(markup)
    # Pass a staged column as ``tags``.
    tags = structure_tags(m) if tags is None else _c(tags)
    # Fields that open and close become a mark, then articles that hold nothing but marks vanish: what other tags there
    # are, or pairs elsewhere, is left.
    fields = F.regexp_replace(F.array_join(tags, ""), rf"<({'|'.join(FIELD_TAGS)})></\1>", _PAIR)
    rest = F.regexp_replace(fields, rf"<article>\{_PAIR}*+</article>", "")
    checks = [
        rest == "",
        F.forall(F.regexp_extract_all(m, F.lit(ENTITY), 0), lambda e: e.isin(*KNOWN_ENTITIES)),
        ~m.rlike(HIDING),
        # A "<" that opens no tag is text to a parser, and may pair with a later ">" in a regex.
        ~m.rlike(r"<(?![A-Za-z/!?])"),
        ~has_rare_space(m),
    ]
    out = checks[0]
    for check in checks[1:]:
        out = out & check
    return F.coalesce(out, F.lit(False))


def _field(block: Column, tag: str) -> Column:
    inner = F.regexp_extract(block, rf"(?s)<{tag}>(.*?)</{tag}>", 1)
    return F.when(block.contains(f"<{tag}>"), element_text(inner))


def regular_articles(markup: Column | str) -> Column:
    """``array<struct>`` of the articles of regular markup, in document order."""
    blocks = F.regexp_extract_all(_c(markup), F.lit(ARTICLE_BLOCK), 1)

    def one(block: Column) -> Column:
        headline = _field(block, "headline")
        body = F.when(
            block.contains("<main>"), F.regexp_extract(block, r"(?s)<main>(.*?)(?:</main>|$)", 1)
        )
        return F.struct(
            F.coalesce(F.nullif(headline, F.lit("")), F.lit("Untitled")).alias("headline"),
            _field(block, "strapline").alias("strapline"),
            _field(block, "author_name").alias("author_name"),
            _field(block, "category").alias("category"),
            body.alias("body_html"),
        )

    return F.transform(blocks, one)


# ---------------------------------------------------------------- irregular path


def py_extract_articles(markup: str) -> list[dict[str, str | None]]:
    """Articles of any markup, at any depth, in document order."""
    rows = read_articles(markup, HEADER_FIELDS, "main")
    for row in rows:
        row["headline"] = row["headline"] or "Untitled"
        row["body_html"] = row.pop("main")
    return rows


def parse_reply(markup: str | None) -> tuple[list[dict[str, str | None]] | None, str | None]:
    """(articles, None), or (None, kind of error): one reply never stops the others."""
    if markup is None:
        return None, None
    try:
        return py_extract_articles(markup), None
    except Exception as error:  # noqa: BLE001 - the row is set aside with the reason
        return None, type(error).__name__


@F.pandas_udf(PARSED)
def _parse_udf(values: pd.Series) -> pd.DataFrame:
    parsed = [parse_reply(v) for v in values]
    return pd.DataFrame({"articles": [p[0] for p in parsed], "error": [p[1] for p in parsed]}, dtype=object)


def with_parsed(replies: DataFrame) -> DataFrame:
    """Add ``is_regular`` (the markup is read by regular expressions) and ``parsed``: what the parser read of the others
    that hold an article tag, or the kind of error it met.

    Every reply is parsed at most once.  The parser is declared non-deterministic, so a filter on what follows from it
    stays above it and does not copy the markup expressions.
    """
    staged = replies.withColumn("_tags", structure_tags("markup")).withColumn("is_regular", is_regular_markup("markup", "_tags"))
    doubtful = ~F.col("is_regular") & F.exists("_tags", lambda t: t.rlike("(?i)^<article"))
    parsed = _parse_udf.asNondeterministic()(F.when(doubtful, F.col("markup")))
    tags = F.size(F.filter("_tags", lambda t: t == "<article>"))
    n_articles = F.when(F.col("is_regular"), tags).when(doubtful, F.array_size("parsed.articles"))
    counted = F.when(F.col("markup").isNotNull() & F.col("parsed.error").isNull(), F.coalesce(n_articles, F.lit(0)))
    return staged.withColumn("parsed", parsed).withColumn("n_articles", counted.cast("int")).drop("_tags")


def extract_articles(
    replies: DataFrame, keys: tuple[str, ...] = ("page_id", "model", "attempt"), only_ok: bool = True
) -> DataFrame:
    """GEN-1: one row per ``<article>`` of each accepted reply, with its 0-based ordinal.

    Failed replies give a NULL array, so ``posexplode`` drops them without a
    filter being pushed into (and duplicating) the markup expressions.
    """
    if "status" not in replies.columns:
        replies = with_reply_status(replies)
    elif "parsed" not in replies.columns:
        replies = with_parsed(replies)
    wanted = F.col("status") == "OK" if only_ok else F.lit(True)
    found = F.when(wanted & F.col("is_regular"), regular_articles("markup")).when(wanted, F.col("parsed.articles"))
    exploded = replies.select(*keys, F.posexplode(found).alias("ordinal", "a"))
    return exploded.select(
        *keys,
        F.col("ordinal").cast("int").alias("ordinal"),
        *[F.col(f"a.{f}").alias(f) for f in ARTICLE_FIELDS.fieldNames()],
    )
