"""Markup functions: fences, meta tags, article fields, article documents (SC-6, 7, 11, 12)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.functions.tagsoup import read_meta
from scanpress.functions.text import OTHER_ENTITY, _c, decode_entities, escape_attr, upto_last

# ---------------------------------------------------------------- SC-12 strip fences

# The search for a fenced span, written as one replacement so the column is
# referenced once: the leftmost fence, an optional html/xml tag, then
# everything up to the last fence.  No match leaves the text as it is.
FENCED_SPAN = r"(?s)^.*?```(?:html|xml)?(.*)```.*$"
# Everything through the first tag mentioning "encoding" that ends a line.
ENCODING_PREFIX = r"(?s)^.*?<[^>]*encoding[^>]*>\n"
STRIP_WS = r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$"


def after_encoding_line(col: Column | str) -> Column:
    """Text after the first ``<...encoding...>`` tag that ends a line; the text itself when there is none.

    The same result as a regular-expression search for such a tag and all
    that follows it, but in linear time (a search backtracks over the rest of
    the text after every unclosed ``<``).  Split at ``>``: a ``<`` in
    segment i can only close at the ``>`` ending that segment, so the match
    ends at the first segment whose text after its first ``<`` contains
    ``encoding`` and whose ``>`` is followed by a newline.
    """
    text = _c(col)
    segments = F.split(text, ">")
    newline_next = F.slice(F.transform(segments, lambda seg: seg.startswith("\n")), 2, F.size(segments))
    pairs = F.arrays_zip(segments.alias("seg"), newline_next.alias("nl"))

    def qualifies(pair: Column) -> Column:
        seg = pair["seg"]
        lt = F.instr(seg, "<")
        after_lt = seg.substr(lt + 1, F.length(seg))
        return F.coalesce(pair["nl"], F.lit(False)) & (lt > 0) & after_lt.contains("encoding")

    first = F.array_position(F.transform(pairs, qualifies), True)
    # Characters up to and including the closing ">" of that segment; the
    # newline after it is skipped as well.
    consumed = F.aggregate(
        F.slice(segments, 1, F.greatest(first, F.lit(1)).cast("int")),
        F.lit(0),
        lambda acc, seg: acc + F.length(seg) + 1,
    )
    return F.when(first > 0, text.substr(consumed + 2, F.length(text))).otherwise(text)


def strip_fences(col: Column | str) -> Column:
    """Markup inside a reply.

    The span from the first to the last triple backtick (an ``html``/``xml``
    tag after the opening fence is dropped, any other tag word stays); then
    everything up to and including a tag mentioning ``encoding`` that ends a
    line; then trimmed.  A reply with a single fence is left as it is.
    """
    text = _c(col)
    # Literal tests first: most replies skip both steps.
    fenced = F.when(text.contains("```"), F.regexp_replace(text, FENCED_SPAN, "$1")).otherwise(text)
    # The plain search is linear unless two "<" occur with no ">" between
    # them (then every "<" rescans its segment); only that text takes the
    # split form, whose array functions are slower per character.
    crowded = fenced.rlike("<[^<>]*<")
    body = (
        F.when(~fenced.contains("encoding"), fenced)
        .when(crowded, after_encoding_line(fenced))
        .otherwise(F.regexp_replace(fenced, ENCODING_PREFIX, ""))
    )
    return F.regexp_replace(body, STRIP_WS, "")


# ---------------------------------------------------------------- SC-6 meta tags

META_TAG = r'<meta\s+name="([^"]*)"\s+content="([^"]*)"\s*/?>'
META_ANY = r"(?i)<meta\b[^>]*>"
HEAD = r"(?is)<head\b[^>]*>(.*?)</head>"
# Markup whose content is not tags: a meta tag found after it may be no tag at all.
RAW_MARKUP = r"(?i)<!--|<!\[|<(?:script|style)\b|<(?:title|textarea)\b[^>]*>[^<]*<(?!/)"


def _plain_meta(html: Column, tags: Column) -> Column:
    """True where every ``<meta`` the regex finds is a tag, with entities Catalyst decodes."""
    return ~html.rlike(RAW_MARKUP) & F.forall(tags, lambda t: ~t.rlike(OTHER_ENTITY))


def _dedup_last(keys: Column, values: Column) -> Column:
    """Entries (key, value) where a later duplicate key wins, without session settings."""
    entries = F.arrays_zip(keys.alias("key"), values.alias("value"))
    return F.filter(
        entries,
        lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))), e["key"]),
    )


def regular_meta(tags: Column, lower_names: bool) -> Column:
    """Map of meta tags (an array of ``<meta ...>`` strings) written in the regular form."""
    names = F.transform(tags, lambda t: F.regexp_extract(t, META_TAG, 1))
    if lower_names:
        names = F.transform(names, lambda s: F.lower(s))
    names = F.transform(names, lambda s: decode_entities(s, nbsp="\xa0"))
    values = F.transform(tags, lambda t: decode_entities(F.regexp_extract(t, META_TAG, 2), nbsp="\xa0"))
    return F.map_from_entries(_dedup_last(names, values))


def py_html_meta(html: str, lower_names: bool = True, head_only: bool = False) -> dict[str, str]:
    """Meta tags of any HTML."""
    return read_meta(html, lower_names, head_only)


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def _meta_lower_udf(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else py_html_meta(v, True, False))


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def _meta_case_head_udf(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else py_html_meta(v, False, True))


def html_meta(col: Column | str, lower_names: bool = True, head_only: bool = False) -> Column:
    """``map<name, content>`` of ``<meta>`` tags that have both attributes.

    Corpus form (default): names lower-cased, tags anywhere.  Reader form
    (``lower_names=False, head_only=True``): names as written, ``<head>`` only.
    The last duplicate wins.  Documents whose every meta tag has the regular
    form stay in Catalyst; the rest are parsed by a vectorised UDF that is
    given NULL for the regular rows.  Inside a job prefer
    :func:`with_html_meta`, which stages the regex passes as columns.
    """
    if (lower_names, head_only) not in ((True, False), (False, True)):
        msg = "html_meta supports the corpus form and the reader form"
        raise ValueError(msg)
    html = _c(col)
    scope = F.coalesce(F.regexp_extract(html, HEAD, 1), F.lit("")) if head_only else html
    # One pass over the document collects the meta tags; the rest works on
    # that short array.
    tags = F.regexp_extract_all(scope, F.lit(META_ANY), 0)
    regular = F.forall(tags, lambda t: t.rlike(f"^{META_TAG}$")) & _plain_meta(html, tags)
    udf = _meta_lower_udf if lower_names else _meta_case_head_udf
    if head_only:
        regular = regular & html.rlike(HEAD)
    return F.when(html.isNull(), F.lit(None)).when(regular, regular_meta(tags, lower_names)).otherwise(
        udf(F.when(~regular, html))
    )


def with_html_meta(df, col: str = "html", out: str = "meta", lower_names: bool = True, head_only: bool = False):  # noqa: ANN001, ANN201
    """Add the meta map of ``col`` as ``out`` - the form to use inside a job.

    Higher-order functions are evaluated without common-subexpression
    elimination, so the regex passes over the document (all meta tags,
    their names, their values) are staged as columns once and the checks
    and the map are built from those short arrays.
    """
    if (lower_names, head_only) not in ((True, False), (False, True)):
        msg = "html_meta supports the corpus form and the reader form"
        raise ValueError(msg)
    html = F.col(col)
    scope = F.coalesce(F.regexp_extract(html, HEAD, 1), F.lit("")) if head_only else html
    # Meta tags end in ">": searching up to the last one is exact and keeps
    # an unclosed tail from being rescanned.
    staged = df.withColumn("_meta_scope", upto_last(scope))
    staged = (
        staged.withColumn("_meta_tags", F.regexp_extract_all("_meta_scope", F.lit(META_ANY), 0))
        .withColumn("_meta_names", F.regexp_extract_all("_meta_scope", F.lit(META_TAG), 1))
        .withColumn("_meta_values", F.regexp_extract_all("_meta_scope", F.lit(META_TAG), 2))
    )
    regular = (F.size("_meta_tags") == F.size("_meta_names")) & _plain_meta(html, F.col("_meta_tags"))
    if head_only:
        regular = regular & html.rlike(HEAD)
    staged = staged.withColumn("_meta_regular", F.coalesce(regular, F.lit(False)))
    names = F.col("_meta_names")
    if lower_names:
        names = F.transform(names, lambda s: F.lower(s))
    names = F.transform(names, lambda s: decode_entities(s, nbsp="\xa0"))
    values = F.transform("_meta_values", lambda s: decode_entities(s, nbsp="\xa0"))
    # The decoded names are read again for every entry while duplicates are
    # dropped, so they are a column too.
    staged = staged.withColumn("_meta_keys", names)
    udf = _meta_lower_udf if lower_names else _meta_case_head_udf
    flag = F.col("_meta_regular")
    entries = _dedup_last(F.col("_meta_keys"), values)
    meta = F.when(html.isNull(), F.lit(None)).when(flag, F.map_from_entries(entries)).otherwise(
        udf(F.when(~flag, html))
    )
    return staged.withColumn(out, meta).drop(
        "_meta_scope", "_meta_tags", "_meta_names", "_meta_values", "_meta_regular", "_meta_keys"
    )


# ---------------------------------------------------------------- SC-7 fields


def article_fields(meta: Column | str) -> list[Column]:
    """headline (default ``Untitled``), strapline, author, category from a meta map."""
    m = _c(meta)
    return [
        F.coalesce(m.getItem("title"), F.lit("Untitled")).alias("headline"),
        m.getItem("subtitle").alias("strapline"),
        m.getItem("author").alias("author"),
        m.getItem("category").alias("category"),
    ]


# ---------------------------------------------------------------- SC-11 article document


def _meta_tag(name: str, value: Column) -> Column:
    return F.when(
        value.isNotNull() & (value != ""),
        F.concat(F.lit(f'<meta name="{name}" content="'), escape_attr(value), F.lit('"/>')),
    )


def article_html(
    headline: Column | str,
    strapline: Column | str,
    author: Column | str,
    slug: Column | str,
    category: Column | str,
    body_html: Column | str,
) -> Column:
    """One HTML document per article: metas in order title, subtitle, author, slug, category.

    Empty values are skipped; newlines in the title become spaces; the body
    holds the ``<main>`` element, or nothing when the article had none.
    """
    metas = F.concat_ws(
        "",
        _meta_tag("title", F.replace(_c(headline), F.lit("\n"), F.lit(" "))),
        _meta_tag("subtitle", _c(strapline)),
        _meta_tag("author", _c(author)),
        _meta_tag("slug", _c(slug)),
        _meta_tag("category", _c(category)),
    )
    body = F.coalesce(F.concat(F.lit("<main>"), _c(body_html), F.lit("</main>")), F.lit(""))
    return F.concat(F.lit("<html><head>"), metas, F.lit("</head><body>"), body, F.lit("</body></html>"))


def document_status(col: Column | str) -> Column:
    """Reader form check: a document without ``<head>`` or ``<body>`` is ``DEFORMED`` (not an error)."""
    html = _c(col)
    return F.when(html.rlike(r"(?i)<head\b") & html.rlike(r"(?i)<body\b"), F.lit("OK")).otherwise(F.lit("DEFORMED"))


def document_body(col: Column | str) -> Column:
    """Inner HTML of ``<body>`` (the reader's ``text_body``); NULL when the document has none."""
    html = _c(col)
    pattern = r"(?is)<body\b[^>]*>(.*?)(?:</body>|$)"
    return F.when(html.rlike(r"(?i)<body\b"), F.regexp_extract(html, pattern, 1))
