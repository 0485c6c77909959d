"""Structured Streaming forms of the main job and of cost tracking (ST-1, ST-2).

ST-1 is stateless: each reply file that arrives is checked, its articles
extracted and appended; the checkpoint makes a rerun add nothing.

ST-2 keeps running token sums per model, one row each, and commits them as a
snapshot per micro-batch; :func:`latest_costs` reads the newest one.
"""

from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.functions.text import with_headline_slug
from scanpress.operators.cost import model_usage, price_model_usage
from scanpress.operators.extract import extract_articles, with_reply_status
from scanpress.schemas import RESPONSES
from scanpress.sources.commits import CommitTable

USAGE = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("input_tokens", T.LongType()),
    T.StructField("output_tokens", T.LongType()),
])


def stream_articles(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    fmt: str = "parquet",
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
):
    """ST-1: replies arriving in ``source_dir`` -> articles appended to Parquet in ``out_dir``.

    By default the query drains what is there (``availableNow``) and returns;
    with ``processing_time`` (e.g. ``"30 seconds"``) it keeps running and the
    started query is returned.  ``max_files_per_trigger`` bounds a micro-batch.
    """
    replies = with_reply_status(_source(spark, source_dir, fmt, max_files_per_trigger))
    # UDF-2 in a stream: pages handled and failed per micro-batch, reported in
    # the query progress (``observedMetrics["pages"]``).
    replies = replies.observe(
        "pages",
        F.count(F.lit(1)).alias("pages_done"),
        F.count_if(F.col("status") != "OK").alias("pages_failed"),
    )
    articles = with_headline_slug(extract_articles(replies))
    query = (
        articles.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
    )
    return _run(query, processing_time)


def _run(writer, processing_time: str | None):  # noqa: ANN001, ANN202
    """Drain what is there and return (``availableNow``), or keep running every ``processing_time``."""
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


#: Running sums of a model, as a snapshot holds them.
SUMS = T.StructType([
    T.StructField("model", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ("replies", "input_tokens", "output_tokens", "replies_without_usage")],
])
KEPT_SNAPSHOTS = 2


def stream_cost(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
):
    """ST-2: running per-model token sums; each micro-batch commits a snapshot of all models and withdraws old ones.

    A snapshot has one row per model and becomes visible as a whole.  A replayed batch replaces its own; readers that
    hold the snapshot before the newest can finish.
    """
    reader = spark.readStream.schema(USAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    sums = model_usage(reader.parquet(source_dir))
    stream = "s" + hashlib.sha256(checkpoint_dir.encode()).hexdigest()[:16]

    def snapshot(batch: DataFrame, batch_id: int) -> None:
        # A replayed batch must be evaluated again as well (its state is committed with it); its new snapshot replaces the old.
        table = CommitTable(batch.sparkSession, out_dir, SUMS)
        batch_key = f"{stream}/{batch_id:012d}"
        key = f"{batch_key}/{uuid.uuid4().hex}"
        table.append(batch.coalesce(1), key)
        before = sorted(k for k in table.commits() if k.startswith(f"{stream}/") and k < batch_key)
        kept = {key, *before[1 - KEPT_SNAPSHOTS :]}
        table.drop([k for k in table.commits() if k not in kept])

    writer = sums.writeStream.outputMode("complete").foreachBatch(snapshot).option("checkpointLocation", checkpoint_dir)
    return _run(writer, processing_time)


def latest_costs(spark: SparkSession, out_dir: str, prices: DataFrame) -> DataFrame:
    """The newest snapshot of the running sums, priced like the batch job (AG-1)."""
    table = CommitTable(spark, out_dir, SUMS)
    return price_model_usage(table.read(sorted(table.commits())[-1:]), prices)


def stream_named_articles(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    fmt: str = "parquet",
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
):
    """ST-1 with names: each micro-batch's articles get file names that avoid every name already written.

    The names written so far are keyed state (:mod:`scanpress.streaming.names`), so no batch reads the output.  Names
    that others wrote into the output before this stream's first start enter the state once, as a second source.

    Each batch is one partition of the output, ``stream_checkpoint=<hash of the checkpoint path>/batch_id=<n>``,
    overwritten as a whole: a batch replayed after a failure starts from the same state, gets the same names and
    replaces whatever part of it was committed.  Several streams (checkpoints) may share one output table, one after
    another: a stream started beside another would not see its names.
    """
    from scanpress.functions.markup import article_html
    from scanpress.streaming.names import with_names

    # Not a number by its form, so that partition inference keeps it a string.
    stream = "s" + hashlib.sha256(checkpoint_dir.encode()).hexdigest()[:16]
    replies = with_reply_status(_source(spark, source_dir, fmt, max_files_per_trigger))
    articles = with_headline_slug(extract_articles(replies))
    seed = spark.readStream.schema("file_name string").parquet(_seed(spark, out_dir, checkpoint_dir, stream))
    named = with_names(articles, seed).withColumn(
        "html", article_html("headline", "strapline", "author_name", "slug", "category", "body_html")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn("stream_checkpoint", F.lit(stream)).withColumn("batch_id", F.lit(batch_id).cast("long"))
        out = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy("stream_checkpoint", "batch_id").parquet(out_dir)

    writer = named.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    with _state_on_disk(spark):
        return _run(writer, processing_time)


def _source(spark: SparkSession, source_dir: str, fmt: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(RESPONSES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    replies = reader.json(source_dir) if fmt == "json" else reader.parquet(source_dir)
    # A micro-batch may be one file, which one task reads; the checks and the extraction after it need every core.
    return replies.repartition(spark.sparkContext.defaultParallelism)


def _seed(spark: SparkSession, out_dir: str, checkpoint_dir: str, stream: str) -> str:
    """The folder of the names that others wrote before this stream's first start, kept with its checkpoint."""
    folder = f"{checkpoint_dir.rstrip('/')}/names-before"
    if not _exists(spark, f"{folder}/_SUCCESS"):
        names = spark.createDataFrame([], "file_name string")
        if _exists(spark, out_dir):
            written = spark.read.parquet(out_dir)
            names = written.filter(F.col("stream_checkpoint") != stream).select("file_name")
        names.write.mode("overwrite").parquet(folder)
    return folder


@contextmanager
def _state_on_disk(spark: SparkSession):  # noqa: ANN202
    """Keyed state in RocksDB: it grows with all names and need not fit in the executors' memory."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS has no Python API
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)  # noqa: SLF001
