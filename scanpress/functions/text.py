"""Text functions: whitespace, shorten, slugs, entities, HTML to text (SC-4, 5, 8, 9, 10, 15).

Everything here is a ``Column -> Column`` built from Catalyst string
functions.  Slugs use a ``translate`` table derived from NFKD for Latin,
Greek and Cyrillic text.  Values Catalyst cannot do exactly (other scripts,
ligatures, hyphen-aware shortening, rare whitespace) go through an Arrow
``pandas_udf`` that receives NULL for every other row, so the Python side
only does work for the rows that need it.
"""

from __future__ import annotations

import html
import json
import re
import textwrap
import unicodedata
from collections.abc import Callable
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.schemas import SHORTEN_PLACEHOLDER, SLUG_WIDTH

# Whitespace as Python's ``str.split()`` / ``str.strip()`` see it, in two
# parts.  The Latin-1 part is a regex class Java compiles to a bitmap (fast);
# the rest are rare characters found with plain substring tests, and rows
# holding one go to the Python path.
FAST_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0]"
# Fixed value: the other characters Python treats as whitespace.
RARE_SPACES = "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where ``value`` is evaluated once however often ``use`` mentions it.

    Below a higher-order function (:func:`decode_references`) Spark does not share common subexpressions: each mention of
    a text would run the passes that make it again.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def has_rare_space(col: Column | str) -> Column:
    """True when the text holds whitespace outside Latin-1 (then only the Python path is exact)."""
    text = _c(col)
    out = text.contains(RARE_SPACES[0])
    for ch in RARE_SPACES[1:]:
        out = out | text.contains(ch)
    return out


def strip_ws(col: Column | str) -> Column:
    """Python ``str.strip()`` for text without rare spaces (see :func:`has_rare_space`)."""
    return F.regexp_replace(_c(col), f"^{FAST_WS}+|{FAST_WS}+$", "")


def collapse_ws(col: Column | str) -> Column:
    """``' '.join(text.split())`` for text without rare spaces: trim, one space per whitespace run."""
    return F.regexp_replace(strip_ws(col), f"{FAST_WS}+", " ")


def decode_entities(col: Column | str, nbsp: str = " ") -> Column:
    """Decode the basic named entities; ``&amp;`` last so ``&amp;lt;`` stays ``&lt;``.

    ``nbsp`` is what ``&nbsp;`` becomes: a plain space in our plain-text rule,
    U+00A0 where the value must equal what an HTML parser yields.
    """
    out = _c(col)
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", nbsp)):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


# An ampersand that does not start one of the entities ``decode_entities`` knows.
OTHER_ENTITY = "&(?!(?:lt|gt|quot|nbsp|amp|#39);)"
_REFERENCE = re.compile(r"&(?:#([0-9]+)|#[xX]([0-9a-fA-F]+)|([A-Za-z][A-Za-z0-9]*));")


def _referenced(match: re.Match) -> str:
    decimal, hexadecimal, name = match.groups()
    if name is not None:
        char = html5.get(f"{name};", match.group())
    else:
        # Eight digits are beyond the last code point in either base.
        digits = (decimal or hexadecimal).lstrip("0")[:8] or "0"
        char = html.unescape(f"&#{'x' if hexadecimal else ''}{digits};")
    return " " if char == "\xa0" else char


def py_decode_references(text: str) -> str:
    """Every ``&name;`` of HTML 5 and every numeric reference decoded, in one pass.

    Unknown names and references without ``;`` stay as they are; a reference
    to U+00A0 becomes a plain space, as ``&nbsp;`` does.
    """
    return _REFERENCE.sub(_referenced, text)


def _names_by_letter() -> Column:
    """A map from first letter to a map from name to characters, of all names of HTML 5 that end with a semicolon; the
    optimizer folds it into one literal."""
    found: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        chars = text.replace("\xa0", " ")
        if name.endswith(";"):
            found.setdefault(name[0], {})[name[:-1]] = chars
    entries = []
    for letter, names in found.items():
        pairs = ",".join(f"'{n}','{''.join(f'{chr(92)}U{ord(c):08x}' for c in chars)}'" for n, chars in names.items())
        entries.append(f"'{letter}',map({pairs})")
    return F.expr(f"map({','.join(entries)})")


def _code_point(code: Column) -> Column:
    """The character a numeric reference stands for, as HTML 5 reads it (a plain space for U+00A0)."""
    low = F.array(*[F.lit(html.unescape(f"&#{n};").replace("\xa0", " ")) for n in range(161)])
    whole = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code <= 160, F.get(low, code))
        .when(code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd"))
        .when(code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE), F.lit(""))
        .otherwise(whole)
    )


def decode_references(col: Column | str) -> Column:
    """:func:`py_decode_references` in Catalyst.

    The text is split at ``&``; what stands before the first ``;`` of each piece is looked up in a literal map by first
    letter and name, or read as a number.
    """
    names = _names_by_letter()

    def decoded(piece: Column) -> Column:
        end = F.instr(piece, ";")
        name = F.substring(piece, F.lit(1), end - 1)
        rest = F.substring(piece, end + 1, F.length(piece))
        digits = F.regexp_replace(name, "^#[xX]?0*", "")
        hexadecimal = name.rlike("^#[xX]")
        value = F.coalesce(F.conv(F.when(digits == "", "0").otherwise(digits), 16, 10).cast("long"), F.lit(0))
        value = F.when(hexadecimal, value).otherwise(F.coalesce(digits.try_cast("long"), F.lit(0)))
        # Eight digits are beyond the last code point in either base.
        code = F.when(F.length(digits) > 7, F.lit(0x110000)).otherwise(value).cast("int")
        char = (
            F.when((end < 2) | (end > 40) & ~name.startswith("#"), F.lit(None))
            .when(name.rlike("^#(?:[0-9]+|[xX][0-9a-fA-F]+)$"), _code_point(code))
            .otherwise(F.try_element_at(F.try_element_at(names, F.left(name, F.lit(1))), name))
        )
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

    # One mention of the column: what it stands for is evaluated once.
    return F.array_join(F.transform(F.split(_c(col), "&"), lambda piece, i: F.when(i == 0, piece).otherwise(decoded(piece))), "")


def escape_attr(col: Column | str) -> Column:
    """Escape a value for a double-quoted HTML attribute."""
    out = F.replace(_c(col), F.lit("&"), F.lit("&amp;"))
    for char, entity in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def escape_text(col: Column | str) -> Column:
    """Escape a value for HTML text content."""
    out = F.replace(_c(col), F.lit("&"), F.lit("&amp;"))
    for char, entity in (("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


# ---------------------------------------------------------------- SC-4 shorten


def shorten(col: Column | str, width: int = SLUG_WIDTH) -> Column:
    """``textwrap.shorten(text, width)`` for text without hyphens.

    Collapse whitespace; a value that fits is kept; otherwise the longest
    run of whole words that leaves room for the placeholder is kept, and a
    first word that alone is too long leaves the bare placeholder.  Hyphen
    breaks are handled by :func:`slugify_headline`'s UDF path.
    """
    room = width - len(SHORTEN_PLACEHOLDER)
    text = collapse_ws(col)
    fits = F.length(text) <= width
    head = F.regexp_extract(text, rf"^(.{{1,{room}}}) ", 1)
    return (
        F.when(fits, text)
        .when(head != "", F.concat(head, F.lit(SHORTEN_PLACEHOLDER)))
        .otherwise(F.lit(SHORTEN_PLACEHOLDER.strip()))
    )


@F.pandas_udf(T.StringType())
def _shorten_udf(values: pd.Series) -> pd.Series:
    return values.map(
        lambda v: None if v is None else textwrap.shorten(v, width=SLUG_WIDTH, placeholder=SHORTEN_PLACEHOLDER)
    )


def shorten_text(col: Column | str) -> Column:
    """``textwrap.shorten(text, 60)`` for any text.

    Text with a hyphen to break at, or with rare whitespace, goes to a
    vectorised UDF (NULL for every other row); the rest stays in Catalyst.
    """
    text = _c(col)
    slow = has_rare_space(text) | (text.contains("-") & (F.length(collapse_ws(text)) > SLUG_WIDTH))
    return F.when(~slow, shorten(text)).otherwise(_shorten_udf(F.when(slow, text)))


# ---------------------------------------------------------------- SC-5 slugify


def ascii_slug(col: Column | str) -> Column:
    """Slug of an ASCII value: lower, non-alphanumeric runs to ``-``, strip ``-``."""
    return F.regexp_replace(F.regexp_replace(F.lower(_c(col)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def py_slugify(text: str) -> str:
    """Slug of any value: NFKD, drop what is not ASCII, then :func:`ascii_slug`."""
    ascii_text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")
    return re.sub(r"[^a-z0-9]+", "-", ascii_text.lower()).strip("-")


def py_headline_slug(text: str) -> str:
    return py_slugify(textwrap.shorten(text, width=SLUG_WIDTH, placeholder=SHORTEN_PLACEHOLDER))


@F.pandas_udf(T.StringType())
def _headline_slug_udf(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else py_headline_slug(v))


# Code-point blocks whose NFKD-to-ASCII mapping Catalyst applies with
# ``translate`` (Latin, IPA, combining marks, Greek, Cyrillic, Latin
# extended additional, Greek extended, general punctuation, super/subscripts,
# currency).  Other scripts go to the UDF.
TRANSLATED_BLOCKS = ((0x80, 0x52F), (0x1E00, 0x1FFF), (0x2000, 0x20CF))


def _ascii_translation() -> tuple[str, str]:
    """``translate`` arguments, derived by rule.

    For each code point c in the blocks, NFKD(c) without non-ASCII is either
    one character (mapped), empty (deleted) or longer (left to the UDF).
    NFKD decomposes character by character, so translating a string gives
    the same ASCII as normalising it whole.
    """
    mapped_from, mapped_to, deleted = [], [], []
    for lo, hi in TRANSLATED_BLOCKS:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            out = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
            if len(out) == 1:
                mapped_from.append(ch)
                mapped_to.append(out)
            elif not out:
                deleted.append(ch)
    return "".join(mapped_from) + "".join(deleted), "".join(mapped_to)


TRANSLATE_FROM, TRANSLATE_TO = _ascii_translation()


def catalyst_ascii(col: Column | str) -> Column:
    """NFKD-to-ASCII for text whose characters are all ASCII or covered by the translation."""
    return F.translate(_c(col), TRANSLATE_FROM, TRANSLATE_TO)


def needs_python_slug(col: Column | str) -> Column:
    """Rows Catalyst cannot slug exactly: characters outside the translation, or a hyphen in a value to be shortened."""
    text = _c(col)
    # Covered characters all become ASCII (or vanish) under the translation,
    # so anything non-ASCII left afterwards is uncovered.
    uncovered = catalyst_ascii(text).rlike(r"[^\x00-\x7F]")
    return uncovered | has_rare_space(text) | (text.contains("-") & (F.length(collapse_ws(text)) > SLUG_WIDTH))


def slugify_headline(col: Column | str) -> Column:
    """``slugify(shorten(headline, 60))``: the article slug.

    Rows Catalyst can do exactly stay in codegen (``translate`` applies the
    NFKD-to-ASCII table); the rest are sent to a vectorised UDF, which gets
    NULL for the other rows.
    """
    text = _c(col)
    slow = needs_python_slug(text)
    fast = ascii_slug(catalyst_ascii(shorten(text)))
    return F.when(text.isNull(), F.lit(None)).when(~slow, fast).otherwise(
        _headline_slug_udf(F.when(slow, text))
    )


def with_headline_slug(df, col: str = "headline", out: str = "slug"):  # noqa: ANN001, ANN201
    """Add ``slugify(shorten(col))`` as ``out`` with the routing flag computed once.

    As a column expression the flag would be evaluated on both sides of the
    Python step; as a column of its own it is evaluated once per row.
    """
    flagged = df.withColumn("_slug_slow", needs_python_slug(col))
    slow = F.col("_slug_slow")
    fast = ascii_slug(catalyst_ascii(shorten(col)))
    slug = F.when(F.col(col).isNull(), F.lit(None)).when(~slow, fast).otherwise(
        _headline_slug_udf(F.when(slow, F.col(col)))
    )
    return flagged.withColumn(out, slug).drop("_slug_slow")


def slugify(col: Column | str) -> Column:
    """Plain ``slugify`` (no shortening) with the same Catalyst / UDF split."""
    text = _c(col)
    ascii_text = catalyst_ascii(text)
    slow = ascii_text.rlike(r"[^\x00-\x7F]")
    return F.when(~slow, ascii_slug(ascii_text)).otherwise(_slugify_udf(F.when(slow, text)))


@F.pandas_udf(T.StringType())
def _slugify_udf(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else py_slugify(v))


# ---------------------------------------------------------------- SC-15 element text


def element_text(col: Column | str) -> Column:
    """Text of an element: text nodes stripped, empty ones dropped, joined with no separator."""
    nodes = F.split(_c(col), "<[^>]*>")
    cleaned = F.transform(nodes, lambda s: strip_ws(decode_entities(s, nbsp="\xa0")))
    return F.array_join(F.filter(cleaned, lambda s: s != ""), "")


# ---------------------------------------------------------------- SC-8 html to text

# Fixed rule (our plain-text conversion): tags that end a block of text.
BLOCK_TAGS = (
    "p|br|div|h[1-6]|li|ul|ol|article|main|header|footer|nav|section|body|html|head|title"
)


def upto_last(col: Column | str, closer: str = ">") -> Column:
    """The text up to and including the last ``closer`` (empty when there is none).

    Patterns that must end in ``closer`` can only match inside it, and run
    there without rescanning an unclosed tail from every opener.
    """
    text = _c(col)
    return text.substr(F.lit(1), F.length(text) - F.length(F.substring_index(text, closer, -1)))


def remove_tags(col: Column | str) -> Column:
    """``re.sub("<[^>]*>", "", text)`` in linear time.

    The regex rescans the rest of the text from every ``<`` that no ``>``
    follows, which is quadratic when many such ``<`` pile up.  Those can only
    sit after the last ``>``, and nothing there can be removed, so the regex
    runs on the text up to the last ``>`` (where every scan stops at the next
    ``>``) and the tail is appended as it is.
    """
    text = _c(col)
    return F.concat(F.regexp_replace(upto_last(text), r"<[^>]*>", ""), F.substring_index(text, ">", -1))


SCRIPTS_AND_COMMENTS = r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->"
# Private-use characters: a marker for openers that cannot close, and its escape.
_MARK, _ESC = "\ue000", "\ue001"


def _from(text: Column, start: Column, pattern: str, replacement: str) -> Column:
    """Replace ``pattern`` only in ``text`` after its first ``start`` characters."""
    head = text.substr(F.lit(1), start)
    tail = text.substr(start + 1, F.length(text))
    return F.concat(head, F.regexp_replace(tail, pattern, replacement))


def remove_scripts_and_comments(col: Column | str) -> Column:
    """``re.sub(SCRIPTS_AND_COMMENTS, "", text)`` in linear time.

    The lazy search rescans the rest of the text from every opener that has
    no closer after it.  Those are exactly the script/style openers after
    the last script/style closer and the ``<!--`` after the last ``-->``; no
    match can start at them, so their ``<`` is swapped for a private-use
    marker before the search and swapped back after it (a marker already in
    the text is escaped first).
    """
    original = _c(col)
    # Literal tests on the tails decide whether any opener may be unclosed;
    # only such text pays for the marking (a wrong "no" costs time, never
    # correctness: the plain search is exact).
    script_tail = F.substring_index(F.substring_index(F.lower(original), "</script", -1), "</style", -1)
    comment_tail = F.substring_index(original, "-->", -1)
    crowded = once(script_tail, lambda s: s.contains("<script") | s.contains("<style")) | comment_tail.contains("<!--")
    plain = F.regexp_replace(original, SCRIPTS_AND_COMMENTS, "")

    text = F.replace(original, F.lit(_MARK), F.lit(_MARK + _ESC))
    last_script = F.length(F.regexp_extract(text, r"(?is)^(.*</(?:script|style)>)", 1))
    last_comment = F.length(text) - F.length(F.substring_index(text, "-->", -1))
    marked = _from(text, last_script, r"(?i)<(script|style)", _MARK + "$1")
    marked = _from(marked, last_comment, "<!--", _MARK + "!--")
    out = F.regexp_replace(marked, SCRIPTS_AND_COMMENTS, "")
    out = F.regexp_replace(out, _MARK + "([sS!])", "<$1")
    exact = F.replace(out, F.lit(_MARK + _ESC), F.lit(_MARK))
    return F.when(crowded, exact).otherwise(plain)


def _untagged(col: Column | str) -> Column:
    return once(remove_scripts_and_comments(col), _without_tags)


def _without_tags(out: Column) -> Column:
    # Tags end in ">", so none starts after the last one: both tag steps run
    # on the text up to it (each scan then stops at the next ">", keeping the
    # work linear), and the tail is kept as it is.
    def split(tail: Column) -> Column:
        head = out.substr(F.lit(1), F.length(out) - F.length(tail))
        head = F.regexp_replace(head, rf"(?i)</?({BLOCK_TAGS})\b[^>]*>", "\n")
        return F.concat(F.regexp_replace(head, r"<[^>]*>", ""), tail)

    return once(F.substring_index(out, ">", -1), split)


def html_to_text(col: Column | str) -> Column:
    """Readable, unwrapped plain text, one paragraph per block, entities decoded.

    References are looked up in a dictionary of all names; no row leaves Catalyst.
    """
    out = decode_references(_untagged(col))
    out = F.regexp_replace(out, r"[ \t]{2,}|\t", " ")
    out = F.regexp_replace(out, r"[ \t\r]*\n[ \t\r\n]*", "\n\n")
    return F.regexp_replace(out, r"^[ \t\r\n]+|[ \t\r\n]+$", "")


# ---------------------------------------------------------------- SC-9 / SC-10


def _truthy(col: Column | str) -> Column:
    c = _c(col)
    return F.when(c != "", c)


def article_text(
    headline: Column | str,
    strapline: Column | str,
    author: Column | str,
    body_html: Column | str,
) -> Column:
    """Headline, strapline and ``Author: x`` when present, then the body text; blank-line joined."""
    return F.concat_ws(
        "\n\n",
        _c(headline),
        _truthy(strapline),
        F.concat(F.lit("Author: "), _truthy(author)),
        F.coalesce(html_to_text(body_html), F.lit("")),
    )


def article_markdown(
    title: Column | str,
    subtitle: Column | str,
    author: Column | str,
    body_text: Column | str,
) -> Column:
    """``# title``, ``**subtitle**``, author, body; each block only if present."""
    return F.concat_ws(
        "\n\n",
        F.concat(F.lit("# "), _truthy(title)),
        F.concat(F.lit("**"), _truthy(subtitle), F.lit("**")),
        _truthy(author),
        F.coalesce(_c(body_text), F.lit("")),
    )
