"""Reply functions: finish reason and status (SC-13, SC-14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanpress.functions.text import _c
from scanpress.schemas import ACCEPTED_FINISH_REASONS

# JSON values Python treats as false: they fall through to the next key.
_FALSY = ("", "0", "false", "0.0", "[]", "{}")


def _truthy_json(metadata: Column, path: str) -> Column:
    value = F.get_json_object(metadata, path)
    return F.when(~value.isin(*_FALSY), value)


def finish_reason(col: Column | str) -> Column:
    """First truthy of ``finish_reason``, ``stop_reason``, ``prompt_feedback.block_reason``; else ``missing``."""
    metadata = _c(col)
    return F.coalesce(
        _truthy_json(metadata, "$.finish_reason"),
        _truthy_json(metadata, "$.stop_reason"),
        _truthy_json(metadata, "$.prompt_feedback.block_reason"),
        F.lit("missing"),
    )


def is_accepted(reason: Column | str) -> Column:
    return _c(reason).isin(*ACCEPTED_FINISH_REASONS)


def response_status(
    n_generations: Column | str,
    message_type: Column | str,
    reason: Column | str,
    content: Column | str,
    n_articles: Column | str,
    parse_error: Column | str | None = None,
) -> Column:
    """Checks in a fixed order; the first failing one names the status.

    ``OK`` / ``MULTI_GENERATION`` / ``NOT_AI_MESSAGE`` / ``BAD_FINISH:<reason>``
    / ``NON_STRING`` / ``PARSE_ERROR:<error type>`` / ``NO_ARTICLES``.
    """
    error = F.lit(None).cast("string") if parse_error is None else _c(parse_error)
    return (
        F.when(F.coalesce(_c(n_generations), F.lit(1)) != 1, F.lit("MULTI_GENERATION"))
        .when(F.coalesce(_c(message_type), F.lit("")) != "ai", F.lit("NOT_AI_MESSAGE"))
        .when(~is_accepted(reason), F.concat(F.lit("BAD_FINISH:"), _c(reason)))
        .when(_c(content).isNull(), F.lit("NON_STRING"))
        .when(error.isNotNull(), F.concat(F.lit("PARSE_ERROR:"), error))
        .when(_c(n_articles) == 0, F.lit("NO_ARTICLES"))
        .otherwise(F.lit("OK"))
    )
