"""Replies to named article documents: the main job, end to end.

replies -> finish reason, status (SC-13, SC-14) -> accepted only (FLT-1/2)
-> articles (SC-12, GEN-1) -> slug (SC-4, SC-5) -> unique names (WN-1)
-> one HTML document per article (SC-11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.functions.markup import article_html
from scanpress.functions.text import with_headline_slug
from scanpress.operators.extract import extract_articles, with_reply_status
from scanpress.operators.naming import name_offset, unique_names


def articles_from_replies(replies: DataFrame) -> DataFrame:
    """Every article of every accepted reply, with its slug."""
    return with_headline_slug(extract_articles(with_reply_status(replies)))


def article_documents(
    articles: DataFrame, existing_names: DataFrame | None = None, order: tuple[str, ...] | None = None
) -> DataFrame:
    """Unique file names and HTML documents for articles that carry a slug; repeats are numbered in ``order``."""
    if order is None:
        order = ("ordinal", "model", "attempt") if "model" in articles.columns else ("ordinal",)
    if existing_names is None:
        named = unique_names(articles, order=order)
    else:
        named = name_offset(articles, existing_names, order=order)
    return named.withColumn(
        "html", article_html("headline", "strapline", "author_name", "slug", "category", "body_html")
    )


def replies_to_documents(replies: DataFrame) -> DataFrame:
    """The flagship job: replies in, ``(file_name, html)`` plus article fields out.

    Every accepted reply contributes; for tables holding several attempts per
    page pass them through ``operators.attempts.first_successful_replies``
    first (``run_extraction`` does).
    """
    docs = article_documents(articles_from_replies(replies))
    return docs.select(
        "page_id", "model", "ordinal", "file_name", "headline", "strapline", "author_name", "category",
        "slug", F.col("html"),
    )


def run_extraction(
    spark,  # noqa: ANN001
    replies_path: str,
    out_dir: str,
    existing_names_path: str | None = None,
    replies_format: str = "parquet",
    prices=None,  # noqa: ANN001
    first_success_only: bool = True,
    run_id: str | None = None,
) -> dict[str, str]:
    """The transcription job end to end, added to the tables under ``out_dir``.

    * ``articles``: ``(file_name, html)`` plus article fields of each page's
      first successful attempt (all successful ones with
      ``first_success_only=False``), named against
      the names already written (by earlier runs into ``out_dir``, and those
      of ``existing_names_path``, a table with a ``file_name`` column);
    * ``quarantine``: failed replies with their reason;
    * ``cost``: tokens and exact cost per model, ``total_cost`` the sum;
    * ``summary``: pages done, replies, failures, articles.

    Each table is a ``CommitTable`` with a ``run_id`` column: runs accumulate,
    and what an aborted run wrote stays invisible.  A run repeated under its
    ``run_id`` adds only the tables it had not committed.  Returns the paths
    of this run's rows; :func:`run_output` reads all runs.
    """
    import uuid

    from scanpress.sources.commits import CommitTable
    from scanpress.operators.audit import failure_reasons, run_summary
    from scanpress.operators.cost import cost_by_model, prices_frame, total_cost
    from scanpress.operators.filters import quarantine
    from scanpress.sources.files import read_responses

    from scanpress.operators.ranking import materialize

    # Six outputs read the checked replies: the checks run once, and each
    # output then reads only its columns of that table.
    replies = materialize(with_reply_status(read_responses(spark, replies_path, replies_format)), "checked-replies")
    run_id = uuid.uuid4().hex if run_id is None else run_id
    existing = _names_of_runs(spark, out_dir)
    if existing_names_path:
        others = spark.read.parquet(existing_names_path).select("file_name")
        existing = others if existing is None else existing.unionByName(others)
    from scanpress.operators.attempts import first_successful_replies

    # Failed attempts are still quarantined and billed below.
    accepted = first_successful_replies(replies) if first_success_only else replies
    docs = article_documents(with_headline_slug(extract_articles(accepted)), existing)
    price_list = prices if prices is not None else prices_frame(spark)
    per_model = cost_by_model(replies.select("model", "input_tokens", "output_tokens"), price_list)
    outputs = {
        "articles": docs.select(
            "file_name", "page_id", "model", "attempt", "ordinal", "headline", "strapline", "author_name",
            "category", "slug", "html",
        ),
        "quarantine": quarantine(replies),
        "failure_reasons": failure_reasons(replies),
        "cost": per_model,
        "total_cost": total_cost(per_model),
        "summary": run_summary(replies),
    }
    paths = {}
    for name, frame in outputs.items():
        rows = frame.withColumn("run_id", F.lit(run_id))
        out = CommitTable(spark, f"{out_dir.rstrip('/')}/{name}", rows.schema)
        out.append(rows, run_id)
        paths[name] = out.commits()[run_id]
    return paths


def run_output(spark, out_dir: str, name: str) -> DataFrame | None:  # noqa: ANN001
    """The rows of one output table of every committed run into ``out_dir``; None before the first."""
    from scanpress.sources.commits import CommitTable

    root = f"{out_dir.rstrip('/')}/{name}"
    found = list(CommitTable(spark, root, T.StructType()).commits().values())
    return CommitTable(spark, root, spark.read.parquet(found[0]).schema).read() if found else None


def _names_of_runs(spark, out_dir: str) -> DataFrame | None:  # noqa: ANN001
    articles = run_output(spark, out_dir, "articles")
    return None if articles is None else articles.select("file_name")
