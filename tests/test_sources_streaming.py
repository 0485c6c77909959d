from __future__ import annotations

import os
import struct
import zlib

from pyspark.sql import functions as F

from scanpress.operators.cost import cost_by_model, prices_frame
from scanpress.plans import fixtures as fx
from scanpress.plans.articles import articles_from_replies
from scanpress.plans.corpus import corpus_rows
from scanpress.sources.files import list_article_names, read_article_html, read_scans
from scanpress.sources.sinks import write_article_docs, write_corpus
from scanpress.streaming.replies import USAGE, latest_costs, stream_articles, stream_cost

SF = "/root/testdata/sf0.001"


def _png(width: int, height: int, value: int) -> bytes:
    raw = b"".join(b"\x00" + bytes([value]) * width for _ in range(height))

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)

    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_read_article_html_recursive(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "a", "b"))
    docs = {"a/gazette_1001-001_x.html": "<html><head><meta name=\"title\" content=\"X\"/></head><body>one\ntwo</body></html>",
            "a/b/gazette_1001-002_y.html": "<html><head></head><body>y</body></html>", "a/notes.txt": "skip"}
    for name, text in docs.items():
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as fh:
            fh.write(text)
    df = read_article_html(spark, tmp_dir)
    got = {r.file_name: r.html for r in df.collect()}
    assert got == {"gazette_1001-001_x.html": docs["a/gazette_1001-001_x.html"], "gazette_1001-002_y.html": docs["a/b/gazette_1001-002_y.html"]}
    corpus = {r.filename: (r.issue, r.page, r.headline, r.txt) for r in corpus_rows(df).collect()}
    assert corpus["gazette_1001-001_x.html"] == ("1001", 2, "X", "one\n\ntwo")
    assert corpus["gazette_1001-002_y.html"] == ("1001", 3, "Untitled", "y")
    names = sorted(r.file_name for r in list_article_names(spark, tmp_dir).collect())
    assert names == ["gazette_1001-001_x.html", "gazette_1001-002_y.html", "notes.txt"]


def test_read_scans_flat_and_pruned(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "scans", "nested"))
    for name in ("gazette_1001-001.png", "gazette_1001-002.png", "nested/gazette_1001-003.png"):
        with open(os.path.join(tmp_dir, "scans", name), "wb") as fh:
            fh.write(_png(4, 3, 200))
    df = read_scans(spark, os.path.join(tmp_dir, "scans"), with_content=False)
    assert sorted(r.stem for r in df.collect()) == ["gazette_1001-001", "gazette_1001-002"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_a_store_arrow_cannot_open_is_listed_by_hadoop(spark, tmp_dir):
    names = ["a_1001-001_x.html", "d/b_1-2_x.html", "_c_1-3.html", "d/.e_1-4.txt", "d/_f/g/h_1-5.html"]
    for name in names:
        os.makedirs(os.path.dirname(os.path.join(tmp_dir, "t", name)), exist_ok=True)
        with open(os.path.join(tmp_dir, "t", name), "w") as fh:
            fh.write(name)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.shelf.link./data", f"file://{tmp_dir}/t")
    listed = sorted(r.file_name for r in list_article_names(spark, "viewfs://shelf/data").collect())
    assert listed == sorted(n.rsplit("/", 1)[-1] for n in names)
    assert [r.stem for r in read_scans(spark, "viewfs://shelf/data/d", with_content=False).collect() if r.stem[0] != "."] == ["b_1-2_x"]
    os.makedirs(os.path.join(tmp_dir, "t", "plain"))
    with open(os.path.join(tmp_dir, "t", "plain", "p_1-1_x.html"), "w") as fh:
        fh.write("p")
    assert [r.html for r in read_article_html(spark, "viewfs://shelf/data/plain").collect()] == ["p"]


def test_names_spark_takes_for_hidden_are_read_and_listed_once(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "a b%20c")
    names = ["_1001-001_x.html", ".1-2_y.html", "g_1001-001_x.html", "d/_k=1_1-1_z.html", "_d/e/é f_1-1_w.html",
             "d/e/f/_1-3_deep.html", "d/e/f/.notes", "_metadata_1-1_m.html", "_metadata/g_1-1_n.html"]
    for name in names:
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
            fh.write(f"<p>é {name}</p>")
    base = [n.rsplit("/", 1)[-1] for n in names]
    read = read_article_html(spark, folder)
    got = {r.file_name: r for r in read.collect()}
    assert read.count() == len(got) and sorted(got) == sorted(n for n in base if n.endswith(".html"))
    for name in names:
        if name.endswith(".html"):
            row = got[name.rsplit("/", 1)[-1]]
            assert row.html == f"<p>é {name}</p>"
            assert row.path.startswith("file:/") and "%2520" in row.path
    # bytes that are no UTF-8 stop neither reader
    for name in ("bad.html", "_bad.html"):
        with open(os.path.join(tmp_dir, name), "wb") as fh:
            fh.write(b"x\xff")
    assert read_article_html(spark, tmp_dir).filter("file_name LIKE '%bad.html' AND html LIKE 'x%'").count() == 2
    assert sorted(r.file_name for r in list_article_names(spark, folder).collect()) == sorted(base)
    scans = read_scans(spark, folder)
    assert sorted(r.stem for r in scans.collect()) == sorted(n[:-5] for n in names if "/" not in n)
    for row in scans.collect():
        assert bytes(row.content).decode() == f"<p>é {row.path.rsplit('/', 1)[-1]}</p>" and row.length == len(row.content)
        assert row.path.startswith("file:/") and "a b%20c" in row.path and row.mtime is not None


def test_corpus_sink_types(spark, tmp_dir):
    docs = fx.article_docs(fx.doc_articles(fx.read_table(spark, SF, "documents")))
    write_article_docs(docs, os.path.join(tmp_dir, "docs"))
    write_corpus(corpus_rows(spark.read.parquet(os.path.join(tmp_dir, "docs"))), os.path.join(tmp_dir, "corpus"))
    out = spark.read.parquet(os.path.join(tmp_dir, "corpus"))
    assert dict(out.dtypes)["page"] == "int"
    assert out.count() == docs.count()
    assert out.filter(F.col("filename").isNull()).count() == 0


def test_stream_articles_equals_batch_and_rerun_adds_nothing(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt"))
    replies = fx.responses(fx.read_table(spark, SF, "pages"))
    replies.repartition(3).write.parquet(src)
    query = stream_articles(spark, src, out, ckpt)
    observed = [p["observedMetrics"]["pages"] for p in query.recentProgress if p.get("observedMetrics")]
    assert sum(o["pages_done"] for o in observed) == replies.count()
    first = spark.read.parquet(out)
    batch = articles_from_replies(spark.read.parquet(src))
    cols = sorted(batch.columns)
    def key(df):
        return sorted(tuple(str(v) for v in r) for r in df.select(cols).collect())

    assert key(first) == key(batch)
    n = first.count()
    stream_articles(spark, src, out, ckpt)
    assert spark.read.parquet(out).count() == n


def test_stream_cost_equals_batch(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("usrc", "uout", "uckpt"))
    usage = fx.usage(fx.read_table(spark, SF, "conversations")).select("model", "input_tokens", "output_tokens")
    usage.repartition(2).write.parquet(os.path.join(src, "part1"))
    stream_cost(spark, src + "/*", out, ckpt)
    usage.limit(30).write.parquet(os.path.join(src, "part2"))
    stream_cost(spark, src + "/*", out, ckpt)
    streamed = {r.model: r for r in latest_costs(spark, out, prices_frame(spark)).collect()}
    both = spark.read.schema(USAGE).parquet(src + "/*")
    batch = {r.model: r for r in cost_by_model(both, prices_frame(spark)).collect()}
    assert streamed.keys() == batch.keys()
    for model, row in batch.items():
        assert (streamed[model].input_tokens, streamed[model].total_cost) == (row.input_tokens, row.total_cost)


def test_stream_named_articles_unique_across_batches_and_replay(spark, tmp_dir):
    from scanpress.streaming.replies import stream_named_articles

    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("nsrc", "nout", "nckpt"))
    replies = fx.responses(fx.read_table(spark, SF, "pages"))
    # The same replies twice, in two batches: the second batch must take new suffixes.
    replies.write.parquet(os.path.join(src, "a"))
    stream_named_articles(spark, src + "/*", out, ckpt)
    replies.write.parquet(os.path.join(src, "b"))
    stream_named_articles(spark, src + "/*", out, ckpt)
    got = spark.read.parquet(out)
    n = articles_from_replies(replies).count()
    assert got.count() == 2 * n
    assert got.select("file_name").distinct().count() == 2 * n
    assert got.select("batch_id").distinct().count() == 2
    # A second stream (its own checkpoint) into the same table: batch ids restart, names stay unique.
    stream_named_articles(spark, os.path.join(src, "a"), out, ckpt + "-2")
    again = spark.read.parquet(out)
    assert again.count() == 3 * n and again.select("file_name").distinct().count() == 3 * n


def test_named_stream_replay_replaces_a_partly_committed_batch(spark, tmp_dir):
    import glob

    from scanpress.streaming.replies import stream_named_articles

    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("rsrc", "rout", "rckpt"))
    replies = fx.responses(fx.read_table(spark, SF, "pages"))
    replies.write.parquet(os.path.join(src, "a"))
    stream_named_articles(spark, src + "/*", out, ckpt)
    before = sorted(r.file_name for r in spark.read.parquet(out).select("file_name").collect())
    # As after a loss of the driver: a few rows committed, the batch not marked as done.
    part = os.path.dirname(glob.glob(out + "/stream_checkpoint=*/batch_id=0/*.parquet")[0])
    kept = spark.createDataFrame(spark.read.parquet(part).limit(3).toPandas(), spark.read.parquet(part).schema)
    kept.write.mode("overwrite").parquet(part)
    for marked in glob.glob(ckpt + "/commits/*") + glob.glob(ckpt + "/commits/.*.crc"):
        os.remove(marked)
    assert spark.read.parquet(out).count() == 3
    stream_named_articles(spark, src + "/*", out, ckpt)
    assert sorted(r.file_name for r in spark.read.parquet(out).select("file_name").collect()) == before


def test_stream_articles_continuous_trigger(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("csrc", "cout", "cckpt"))
    replies = fx.responses(fx.read_table(spark, SF, "pages"))
    replies.write.parquet(os.path.join(src, "a"))
    query = stream_articles(spark, src + "/*", out, ckpt, processing_time="1 second")
    try:
        query.processAllAvailable()
        replies.write.parquet(os.path.join(src, "b"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == 2 * articles_from_replies(replies).count()


def test_many_small_article_files_are_read_by_few_tasks(spark, tmp_dir):
    import os

    from scanpress.sources.files import read_article_html

    os.makedirs(f"{tmp_dir}/many")
    for n in range(200):
        with open(f"{tmp_dir}/many/a_{n}-1_x.html", "w", encoding="utf-8") as fh:
            fh.write(f"<p>{n}</p>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4194304")  # a split a file
    try:
        files = read_article_html(spark, f"{tmp_dir}/many")
        hidden = 4 * spark.sparkContext.defaultParallelism  # at most: those of files Spark passes over
        assert files.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism + hidden < 200
        assert sorted(r.html for r in files.collect()) == sorted(f"<p>{n}</p>" for n in range(200))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
