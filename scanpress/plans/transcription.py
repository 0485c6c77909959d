"""Scans to article documents: the whole job, from scan files to named articles, restartable at any point.

    scan files -> integrity check -> rounds of model calls -> replies (ledger) -> articles -> names -> documents

*Ledger.*  Replies are kept in a table of commits (:class:`CommitTable`), one row per scan path and attempt.  Round m
asks the m-th model, and only for scans without a good reply so far: an anti join on the scan's path, which is its
identity (scans of two folders may share a name).  A round is cut into micro-batches of ``parallelism *
calls_per_task`` scans; the replies of one are committed before the next is asked, so a job that dies asks again for
at most one micro-batch, and a lost task for ``calls_per_task`` scans.  A restart asks for nothing that is committed.

*Scans that cannot be read* are entered once, as ``INVALID_SCAN:<damage>``, and never sent to a model.

*Outputs* are commits too: a run adds the documents of pages whose good reply has none yet, named against all names
written before; an earlier run's documents stay, an aborted run leaves nothing visible.

A round is planned once; its micro-batches run a few partitions of that plan each.  Only paths are shuffled; image bytes
are read, checked and sent to the model by one task, which writes its replies, and the driver commits them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.functions.names import base_name, file_stem
from scanpress.functions.text import with_headline_slug
from scanpress.operators.audit import run_summary
from scanpress.operators.cost import cost_by_model, prices_frame, total_cost
from scanpress.operators.extract import extract_articles, with_reply_status
from scanpress.operators.filters import valid_scans
from scanpress.operators.ranking import materialize
from scanpress.operators.requests import TRANSCRIPTS, build_requests, transcribe_pages
from scanpress.plans.articles import article_documents
from scanpress.sources.commits import CommitTable
from scanpress.session import qualified_uri
from scanpress.sources.files import arrow_opens, read_files, read_listed, read_scans

#: One row per scan and attempt: what the model answered, and what the checks say of it.
LEDGER = T.StructType([
    T.StructField("path", T.StringType()),
    *TRANSCRIPTS.fields,
    T.StructField("finish_reason", T.StringType()),
    T.StructField("n_articles", T.IntegerType()),
    T.StructField("status", T.StringType()),
])

DOCUMENTS = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("page_id", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("headline", T.StringType()),
    T.StructField("strapline", T.StringType()),
    T.StructField("author_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("slug", T.StringType()),
    T.StructField("html", T.StringType()),
])

INVALID = "INVALID_SCAN:"
ModelCall = Callable[[dict[str, Any]], dict[str, Any]]


def ledger(spark: SparkSession, folder: str) -> CommitTable:
    return CommitTable(spark, f"{folder.rstrip('/')}/ledger", LEDGER)


def documents(spark: SparkSession, folder: str) -> CommitTable:
    return CommitTable(spark, f"{folder.rstrip('/')}/articles", DOCUMENTS)


@contextmanager
def _micro_batch(spark: SparkSession, partitions: int):  # noqa: ANN202
    """The file source lists a micro-batch's few paths without a job, and cuts them into at least this many partitions, so
    calls run side by side."""
    wanted = {
        "spark.sql.files.minPartitionNum": str(partitions),
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "100000",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def frontier(scans: DataFrame, replies: DataFrame, attempt: int) -> DataFrame:
    """Paths round ``attempt`` still has to ask for: neither answered well, nor unreadable, nor asked in this round."""
    settled = (F.col("status") == "OK") | F.col("status").startswith(INVALID) | (F.col("attempt") == attempt)
    return scans.select("path").join(replies.filter(settled).select("path"), "path", "left_anti")


def _checked(replies: DataFrame) -> DataFrame:
    """Ledger rows of the replies, with their status."""
    return with_reply_status(replies).select(*LEDGER.fieldNames())


def _unread(damaged: DataFrame, attempt: int) -> DataFrame:
    """Ledger rows of the scans that no model was asked for."""
    nothing = [f for f in LEDGER.fields if f.name not in ("path", "page_id", "attempt", "status")]
    return damaged.select(
        "path", "page_id", F.lit(attempt).alias("attempt"), F.concat(F.lit(INVALID), "damage").alias("status"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in nothing],
    ).select(*LEDGER.fieldNames())


def transcribe_scans(
    spark: SparkSession,
    scan_folders: list[str],
    out_dir: str,
    model_call: ModelCall,
    models: list[str],
    prompt: str,
    system: str | None = None,
    parallelism: int = 12,
    calls_per_task: int = 32,
) -> CommitTable:
    """Ask the models in turn, each only for the scans the ones before it failed on; returns the ledger."""
    table = ledger(spark, out_dir)
    listed = read_scans(spark, *scan_folders, with_content=False).select("path")
    scans = materialize(listed, "scan-paths")  # one listing for all rounds
    per_batch = parallelism * calls_per_task
    direct = all(arrow_opens(qualified_uri(spark, f)) for f in (out_dir, *scan_folders))
    for attempt, model in enumerate(models):
        asked = materialize(frontier(scans, table.read(), attempt), f"frontier-{attempt}")
        n = asked.count()
        batches = -(-n // per_batch)
        if not batches:
            continue
        run = uuid.uuid4().hex
        if direct:
            _ask_all(spark, table, asked, batches, f"{attempt}/{run}", attempt, model, model_call, prompt, system, parallelism)
            continue
        # Each batch is read back by its number; sorted, most of the table's pages are skipped.
        dealt = asked.withColumn("batch", F.pmod(F.xxhash64("path"), F.lit(batches)).cast("int"))
        dealt = materialize(dealt.repartitionByRange("batch").sortWithinPartitions("batch"), f"batches-{attempt}")
        for batch in range(batches):
            paths = [r.path for r in dealt.filter(F.col("batch") == batch).collect()]  # about ``per_batch`` paths
            if paths:
                _ask(spark, table, paths, f"{attempt}/{run}/{batch}", attempt, model, model_call, prompt, system, parallelism)
    return table


def _ask_all(
    spark: SparkSession, table: CommitTable, asked: DataFrame, batches: int, key: str, attempt: int, model: str,
    model_call: ModelCall, prompt: str, system: str | None, parallelism: int,
) -> None:
    """A round in one plan: a partition holds the calls of one task, a micro-batch runs ``parallelism`` of its partitions.

    Planning a batch of its own and listing its files took longer than its calls.  Damaged scans need no call and are
    entered first, in one commit.
    """
    damaged = valid_scans(_scan_bytes(read_listed(asked.repartition(spark.sparkContext.defaultParallelism, "path"))))
    damaged = damaged.filter(~F.col("valid")).select("path", "page_id", "damage")
    unread = materialize(_unread(damaged, attempt), f"unread-{attempt}")
    if not unread.isEmpty():
        table.append(unread, f"{key}/unread")
    dealt = _scan_bytes(read_listed(asked.repartition(batches * parallelism, "path")))
    replies = _replies(valid_scans(dealt), attempt, model, model_call, prompt, system, None)
    folders = [f"data-{uuid.uuid4().hex}" for _ in range(batches)]
    written = table.write_parts(_checked(replies), lambda partition: folders[partition // parallelism]).rdd
    for batch, data in enumerate(folders):
        parts = range(batch * parallelism, (batch + 1) * parallelism)
        if spark.sparkContext.runJob(written, list, parts):
            table.publish(f"{key}/{batch}", data)


def _ask(
    spark: SparkSession, table: CommitTable, paths: list[str], key: str, attempt: int, model: str, model_call: ModelCall,
    prompt: str, system: str | None, parallelism: int,
) -> None:
    """Check, request, call and commit one micro-batch, read by Spark's file source: for stores that Arrow cannot open."""
    with _micro_batch(spark, parallelism):
        scans = valid_scans(_scan_bytes(read_files(spark, paths)))
        replies = _replies(scans, attempt, model, model_call, prompt, system, parallelism)
        damaged = scans.filter(~F.col("valid")).select("path", "page_id", "damage")
        table.append(_checked(replies).unionByName(_unread(damaged, attempt)), key)


def _scan_bytes(content: DataFrame) -> DataFrame:
    return content.select("path", file_stem(base_name("path")).alias("page_id"), "content")


def _replies(
    scans: DataFrame, attempt: int, model: str, model_call: ModelCall, prompt: str, system: str | None, parallelism: int | None
) -> DataFrame:
    requests = build_requests(scans.filter(F.col("valid")), prompt, [model], system, keys=("path", "page_id"))
    return transcribe_pages(requests, model_call, parallelism, attempt, keys=("path", "page_id"))


def good_replies(replies: DataFrame) -> DataFrame:
    """AG-3 by scan path: each page's first good reply.  Rounds ask no page again, so there is one at most, but ledgers
    of several jobs may overlap."""
    ok = replies.filter(F.col("status") == "OK")
    chosen = ok.groupBy("path").agg(F.min("attempt").alias("attempt"))
    return ok.join(chosen, ["path", "attempt"], "left_semi")


def failed_pages(replies: DataFrame) -> DataFrame:
    """FLT-2 over rounds: pages that no model answered well, with the reason of their first attempt."""
    first = F.min_by(F.struct("page_id", "status"), "attempt")
    pages = replies.groupBy("path").agg(first.alias("first"), F.bool_or(F.col("status") == "OK").alias("ok"), F.count(F.lit(1)).alias("attempts"))
    return pages.filter(~F.col("ok")).select("path", "first.page_id", F.col("first.status").alias("reason"), "attempts")


def write_documents(spark: SparkSession, out_dir: str, run_id: str | None = None) -> CommitTable:
    """Add the documents of all pages that have a good reply and no document yet, as one commit."""
    out = documents(spark, out_dir)
    written = out.read()
    replies = ledger(spark, out_dir).read()
    done = written.select("path").distinct()
    todo = good_replies(replies).join(done, "path", "left_anti")
    keys = ("path", "page_id", "model", "attempt")
    # Names are numbered on keys first and joined back, so the articles are kept, not extracted twice.
    articles = materialize(with_headline_slug(extract_articles(with_reply_status(todo.drop("status", "n_articles", "finish_reason")), keys)), "articles")
    named = article_documents(articles, written.select("file_name"), order=("path", "ordinal", "model", "attempt"))
    out.append(named, run_id)
    return out


def progress(replies: DataFrame, written: DataFrame) -> DataFrame:
    """UDF-2 that lasts: pages asked for, pages with a document, failed pages, articles, calls; the committed rows alone count,
    so a batch that ran twice counts once."""
    pages = replies.groupBy("path").agg(F.bool_or(F.col("status") == "OK").alias("ok"), F.count(F.lit(1)).alias("calls"),
                                        F.bool_or(F.col("status").startswith(INVALID)).alias("unread"))
    by_page = written.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    return pages.join(by_page, "path", "full").agg(
        F.count("calls").alias("pages_done"),
        F.count_if(~F.col("ok")).alias("pages_failed"),
        F.coalesce(F.sum(F.col("calls") - F.col("unread").cast("int")), F.lit(0)).alias("calls"),
        F.count("n").alias("pages_with_documents"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("documents"),
    )


def scans_to_documents(
    spark: SparkSession,
    scan_folders: list[str],
    out_dir: str,
    model_call: ModelCall,
    models: list[str],
    prompt: str,
    system: str | None = None,
    parallelism: int = 12,
    calls_per_task: int = 32,
    run_id: str | None = None,
    prices: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The job: documents of all pages so far, failed pages with their reason, cost of every reply, progress."""
    transcribe_scans(spark, scan_folders, out_dir, model_call, models, prompt, system, parallelism, calls_per_task)
    written = write_documents(spark, out_dir, run_id).read()
    replies = ledger(spark, out_dir).read()
    asked = replies.filter(F.col("model").isNotNull())
    per_model = cost_by_model(asked.select("model", "input_tokens", "output_tokens"), prices_frame(spark) if prices is None else prices)
    return {
        "documents": written,
        "failed": failed_pages(replies),
        "cost": per_model,
        "total_cost": total_cost(per_model),
        "summary": run_summary(asked, page="path"),
        "progress": progress(replies, written),
    }
