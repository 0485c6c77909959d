"""Keyed names and snapshots over many micro-batches."""

from __future__ import annotations

import glob
import os
import random

from pyspark.sql import functions as F

from scanpress.operators.cost import prices_frame
from scanpress.operators.naming import name_offset
from scanpress.plans import fixtures as fx
from scanpress.streaming import names
from scanpress.sources.commits import CommitTable
from scanpress.streaming.replies import SUMS, latest_costs, stream_articles, stream_cost, stream_named_articles

SF = "/root/testdata/sf0.001"
BASES = ["p_x", "p_x_1", "p_x_1_2", "p_x_2", "p_y", "p_y_10", "p_y_01"]


def test_family_names_as_the_batch_job_does(spark):
    rng = random.Random(3)
    before = [f"{b}{s}.html" for b in ("p_x", "p_x_1", "p_y") for s in ("", "_1", "_3", "_10")][::2]
    existing = list(before)
    families: dict[str, names.Family] = {}

    def root(text):
        import re

        return re.sub(names.COUNTERS, "", text)

    for written in before:
        families.setdefault(root(written[:-5]), names.Family()).take(written[:-5][len(root(written[:-5])) :])
    for _ in range(4):
        rows = [("p", base[2:], k) for k, base in enumerate(rng.choices(BASES, k=15))]
        df = spark.createDataFrame(rows, "page_id string, slug string, ordinal int")
        want = {(r.slug, r.ordinal): r.file_name for r in name_offset(df, spark.createDataFrame([(n,) for n in existing], "file_name string")).collect()}
        got = {}
        for key in {root(f"p_{slug}") for _, slug, _ in rows}:
            own = sorted((f"p_{slug}", k, slug) for _, slug, k in rows if root(f"p_{slug}") == key)
            held = names.Family(families[key].save() if key in families else None)
            for (base, k, slug), c in zip(own, held.assign([b[len(key) :] for b, _, _ in own]), strict=True):
                got[slug, k] = f"{base}_{c}.html" if c else f"{base}.html"
            families[key] = held
        assert got == want
        existing += want.values()


def _replies(spark):
    return fx.responses(fx.read_table(spark, SF, "pages"))


def test_named_stream_over_batches_bounded_by_files(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt"))
    for attempt in range(4):
        _replies(spark).withColumn("attempt", F.lit(attempt)).coalesce(1).write.mode("append").parquet(src)
    stream_named_articles(spark, src, out, ckpt, max_files_per_trigger=1)
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 4
    whole = name_offset(got.drop("file_name", "html"), None, order=("attempt", "ordinal"))
    assert sorted(map(tuple, got.select("file_name", "page_id", "ordinal", "attempt").collect())) == sorted(
        map(tuple, whole.select("file_name", "page_id", "ordinal", "attempt").collect())
    )
    # What is read of the output: nothing; the state store holds the names.
    assert glob.glob(f"{ckpt}/state/0/*/*.zip") or glob.glob(f"{ckpt}/state/0/*/*.changelog")
    out2 = os.path.join(tmp_dir, "articles")
    query = stream_articles(spark, src, out2, ckpt + "-plain", max_files_per_trigger=1)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert spark.read.parquet(out2).count() == got.count()


def test_snapshots_stay_near_the_number_of_models(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("usrc", "uout", "uckpt"))
    usage = fx.usage(fx.read_table(spark, SF, "conversations")).select("model", "input_tokens", "output_tokens")
    usage.repartition(6).write.parquet(src)
    stream_cost(spark, src, out, ckpt, max_files_per_trigger=1)
    table = CommitTable(spark, out, SUMS)
    assert len(table.commits()) == 2 and len(glob.glob(f"{out}/data-*")) == 2
    models = usage.select("model").distinct().count()
    assert latest_costs(spark, out, prices_frame(spark)).count() == models and table.read().count() <= 2 * models
    for marked in glob.glob(ckpt + "/commits/5") + glob.glob(ckpt + "/commits/.5.crc"):
        os.remove(marked)  # the last batch runs again
    before = sorted(map(str, latest_costs(spark, out, prices_frame(spark)).collect()))
    stream_cost(spark, src, out, ckpt, max_files_per_trigger=1)
    assert sorted(map(str, latest_costs(spark, out, prices_frame(spark)).collect())) == before


def test_a_batch_of_one_file_is_extracted_by_many_tasks(spark, tmp_dir):
    from scanpress.plans import fixtures as fx
    from scanpress.streaming.replies import _source

    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("<title>T</title><article><p>x</p></article>").alias("html"))
    fx.responses(pages).coalesce(1).write.parquet(f"{tmp_dir}/in")
    tasks = _source(spark, f"{tmp_dir}/in", "parquet", 1).select(F.spark_partition_id().alias("task"))
    tasks.writeStream.format("parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(
        availableNow=True
    ).start().awaitTermination()
    read = spark.read.parquet(f"{tmp_dir}/out")
    assert read.count() == 40 and read.distinct().count() == min(spark.sparkContext.defaultParallelism, 40)
