"""Operator 2, chat formatting with Spark expressions only.

Template, one block per run of turns of one role::

    <turn ROLE>
    text<part/>text of the next turn of the same role</turn>

Inside texts, a control string (``<turn ``, ``</turn>``, ``<part/>``, with any
number of backslashes after its ``<``) gets one more backslash there; reading
back takes one away, so every text survives.  Roles are percent-escaped
(``% < >`` and newline).

Turn structs are collected per conversation and sorted; runs of equal roles
are cut out of that array and joined.  Texts are escaped before they are
collected, in the scan stage, so the collected arrays are touched only by
linear array expressions.

The loss mask is a run-length code over the code points of the formatted
string, one entry per turn: ``skip`` code points without loss, then ``take``
with (the escaped text of a turn whose role is in ``loss_roles``).  Entries
are relative, so none needs a running sum; what follows the last entry is
without loss.

Defined results: null texts and roles count as empty; turns that share a turn
number are ordered by role, then escaped text; a null turn number comes first;
rows without a conversation id form one conversation of that null id; repeated
rows are repeated turns; an empty table gives no conversation; extra columns
are ignored.  One conversation is one string, so it must fit Spark's 2 GB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOSS_ROLES = ("assistant",)
OPEN, OPENED, PART, CLOSE = "<turn ", ">\n", "<part/>", "</turn>\n"
CONTROL = r"(turn |/turn>|part/>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)" + CONTROL, r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)" + CONTROL, r"<$1$2")


def _escape_role(role: Column) -> Column:
    for char, code in (("%", "%25"), ("<", "%3C"), (">", "%3E"), ("\n", "%0A")):
        role = F.replace(role, F.lit(char), F.lit(code))
    return role


def _unescape_role(role: Column) -> Column:
    for char, code in (("\n", "%0A"), (">", "%3E"), ("<", "%3C"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(char))
    return role


def _lead(block: Column, part: Column, role: Column) -> Column:
    """Code points between the previous turn's text and this one's."""
    head = F.length(role) + len(OPEN) + len(OPENED) + F.when(block > 0, len(CLOSE)).otherwise(0)
    return F.when(part == 0, head).otherwise(len(PART))


def format_chats(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask array<struct<skip int, take int>>."""
    empty = F.lit("")
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        _escape_role(F.coalesce(F.col(role_col), empty)).alias("role"),
        escape(F.coalesce(F.col(text_col), empty)).alias("text"),
    )
    chats = df.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    role_at = lambda i: F.get(F.col("turns"), i)["role"]
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (role_at(i) != role_at(F.greatest(i - 1, F.lit(0))))
    )
    runs = F.transform(
        "starts",
        lambda s, k: F.slice(
            "turns", s + 1, F.coalesce(F.get(F.col("starts"), k + 1), F.size("turns")) - s
        ),
    )
    block = lambda b: F.concat(
        F.lit(OPEN), b[0]["role"], F.lit(OPENED), F.array_join(F.transform(b, lambda t: t["text"]), PART), F.lit(CLOSE)
    )
    loss = [r.replace("%", "%25").replace("<", "%3C").replace(">", "%3E").replace("\n", "%0A") for r in loss_roles]

    def mask(b: Column, k: Column) -> Column:
        def entry(t: Column, j: Column) -> Column:
            n, lead, taken = F.length(t["text"]), _lead(k, j, t["role"]), t["role"].isin(loss)
            return F.struct(
                (lead + F.when(taken, 0).otherwise(n)).alias("skip"), F.when(taken, n).otherwise(0).alias("take")
            )

        return F.transform(b, entry)

    return (
        chats.withColumn("starts", starts)
        .withColumn("runs", runs)
        .select(
            "conv_id",
            F.array_join(F.transform("runs", block), "").alias("formatted"),
            F.flatten(F.transform("runs", mask)).alias("loss_mask"),
        )
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """Reverse of :func:`format_chats`: conv_id, formatted, turns array<struct<role, text>>, loss_texts array<string>.

    ``loss_texts`` are the unescaped texts under the mask.  A mask that does
    not meet the turn boundaries of its string is an error.
    """

    def turns(b: Column, k: Column) -> Column:
        role = F.regexp_extract(b, r"^<turn ([^>]*)>\n", 1)
        body = F.substr(b, F.length(role) + (len(OPEN) + len(OPENED) + 1), F.length(b))
        return F.transform(
            F.split(body, PART, -1),
            lambda p, j: F.struct(
                _unescape_role(role).alias("role"), unescape(p).alias("text"), (_lead(k, j, role) + F.length(p)).alias("span")
            ),
        )

    blocks = F.split("formatted", CLOSE, -1)
    parsed = formatted.withColumn("blocks", blocks).withColumn(
        "parts", F.flatten(F.transform(F.slice("blocks", F.lit(1), F.size("blocks") - 1), turns))
    )
    under = F.zip_with(
        "parts",
        "loss_mask",
        lambda p, m: F.when(p["span"].eqNullSafe(m["skip"] + m["take"]), F.when(m["take"] > 0, p["text"])).otherwise(
            F.raise_error(F.lit("loss mask does not fit its text")).cast("string")
        ),
    )
    return parsed.select(
        "conv_id",
        "formatted",
        F.transform("parts", lambda p: F.struct(p["role"].alias("role"), p["text"].alias("text"))).alias("turns"),
        F.filter(under, lambda t: t.isNotNull()).alias("loss_texts"),
    )
