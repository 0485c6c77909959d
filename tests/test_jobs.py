from __future__ import annotations

import os

from pyspark.sql import functions as F

from scanpress.plans import fixtures as fx
from scanpress.plans.articles import run_extraction, run_output
from scanpress.plans.corpus import build_corpus
from scanpress.plans.missing import missing_scan_report
from scanpress.sources.sinks import write_files

SF = "/root/testdata/sf0.001"


def test_extraction_job_and_rerun_keeps_names_unique(spark, tmp_dir):
    replies = os.path.join(tmp_dir, "replies")
    fx.responses(fx.read_table(spark, SF, "pages")).write.parquet(replies)
    first = run_extraction(spark, replies, os.path.join(tmp_dir, "run1"))
    arts1 = spark.read.parquet(first["articles"])
    n = arts1.count()
    assert n > 0 and arts1.select("file_name").distinct().count() == n
    summary = spark.read.parquet(first["summary"]).collect()[0]
    assert summary.articles == n
    assert summary.ok_replies + summary.failed_replies == summary.replies
    assert spark.read.parquet(first["quarantine"]).count() == summary.failed_replies
    per_model = spark.read.parquet(first["cost"])
    total = spark.read.parquet(first["total_cost"]).collect()[0]
    assert total.total_cost == per_model.agg(F.sum("total_cost")).collect()[0][0]

    # A second run into another folder: every name must avoid the first run's names.
    second = run_extraction(spark, replies, os.path.join(tmp_dir, "run2"), existing_names_path=first["articles"])
    names1 = {r.file_name for r in arts1.select("file_name").collect()}
    names2 = {r.file_name for r in spark.read.parquet(second["articles"]).select("file_name").collect()}
    assert len(names2) == n and not names1 & names2
    assert all(name.rsplit("_", 1)[-1].removesuffix(".html").isdigit() for name in names2)


def test_runs_accumulate_and_an_aborted_run_stays_invisible(spark, tmp_dir):
    from scanpress.sources.commits import CommitTable

    replies, out = os.path.join(tmp_dir, "replies"), os.path.join(tmp_dir, "out")
    fx.responses(fx.read_table(spark, SF, "pages")).limit(40).write.parquet(replies)
    first = run_extraction(spark, replies, out, run_id="monday")
    before = spark.read.parquet(first["articles"]).collect()
    second = run_extraction(spark, replies, out, run_id="tuesday")
    both = run_output(spark, out, "articles")
    assert both.count() == both.select("file_name").distinct().count() == 2 * len(before) > 0
    assert sorted(spark.read.parquet(first["articles"]).collect()) == sorted(before)
    assert {r.run_id for r in run_output(spark, out, "cost").collect()} == {"monday", "tuesday"}
    # A run that died after its articles: repeated under its id, it adds the rest and no second copy of them.
    for name in set(second) - {"articles"}:
        CommitTable(spark, f"{out}/{name}", both.schema).drop(["tuesday"])
    assert run_output(spark, out, "summary").count() == 1
    again = run_extraction(spark, replies, out, run_id="tuesday")
    assert again["articles"] == second["articles"] and run_output(spark, out, "articles").count() == 2 * len(before)
    assert run_output(spark, out, "summary").count() == 2
    # Rows without a commit are not seen.
    both.write.parquet(f"{out}/articles/data-aborted")
    assert run_output(spark, out, "articles").count() == 2 * len(before)
    assert run_output(spark, os.path.join(tmp_dir, "none"), "articles") is None


def test_corpus_job_with_sample_and_bad_names(spark, tmp_dir):
    docs = fx.article_docs(fx.doc_articles(fx.read_table(spark, SF, "documents")))
    bad = spark.createDataFrame([("gazette_1001.html", "<html><head></head><body>x</body></html>")], "file_name string, html string")
    folder = os.path.join(tmp_dir, "html")
    write_files(docs.select("file_name", "html").unionByName(bad), folder).write.format("noop").mode("overwrite").save()
    out, bad_out = os.path.join(tmp_dir, "corpus"), os.path.join(tmp_dir, "bad")
    build_corpus(spark, folder, out, bad_names_path=bad_out)
    assert spark.read.parquet(out).count() == docs.count()
    assert [r.file_name for r in spark.read.parquet(bad_out).collect()] == ["gazette_1001.html"]
    build_corpus(spark, folder, out, sample_size=25, seed=3)
    assert spark.read.parquet(out).count() == 25


def test_missing_scan_report(spark, tmp_dir):
    scans = spark.createDataFrame(
        [(f"gazette_1001-{i:03d}.jpg", b"\xff\xd8\xff") for i in (1, 2, 10)] + [("gazette_1002-001.jpg", b"\xff\xd8\xff")],
        "file_name string, content binary",
    )
    write_files(scans, os.path.join(tmp_dir, "scans"), "file_name", "content").write.format("noop").mode("overwrite").save()
    arts = spark.createDataFrame([("gazette_1001-001_a.html", "x"), ("gazette_1002-001_b_1.html", "y")], "file_name string, html string")
    write_files(arts, os.path.join(tmp_dir, "articles", "nested")).write.format("noop").mode("overwrite").save()
    got = [r.stem for r in missing_scan_report(spark, os.path.join(tmp_dir, "scans"), os.path.join(tmp_dir, "articles")).collect()]
    assert got == ["gazette_1001-002", "gazette_1001-010"]


def test_corpus_job_empty_folder_warns(spark, tmp_dir):
    import pytest

    os.makedirs(os.path.join(tmp_dir, "empty"))
    with open(os.path.join(tmp_dir, "empty", "notes.txt"), "w") as fh:
        fh.write("x")
    with pytest.warns(UserWarning, match="no"):
        build_corpus(spark, os.path.join(tmp_dir, "empty"), os.path.join(tmp_dir, "out"))
    assert not os.path.exists(os.path.join(tmp_dir, "out"))


def test_corpus_partitioned_by_issue_prunes(spark, tmp_dir):
    from scanpress.sources.files import read_corpus

    docs = fx.article_docs(fx.doc_articles(fx.read_table(spark, SF, "documents")))
    folder = os.path.join(tmp_dir, "html")
    write_files(docs.select("file_name", "html"), folder).write.format("noop").mode("overwrite").save()
    out = os.path.join(tmp_dir, "corpus")
    build_corpus(spark, folder, out, partition_by="issue")
    corpus = read_corpus(spark, out)
    assert dict(corpus.dtypes)["issue"] == "string" and dict(corpus.dtypes)["page"] == "int"
    assert corpus.count() == docs.count()
    one = corpus.filter(F.col("issue") == "1003")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(issue" in plan
    assert one.count() == docs.filter(F.col("file_name").startswith("gazette_1003-")).count()


def test_command_line_missing_report(spark, tmp_dir):
    from scanpress.__main__ import main

    scans = spark.createDataFrame([("gazette_1001-001.jpg", b"\xff\xd8\xff"), ("gazette_1001-002.jpg", b"\xff\xd8\xff")],
                                  "file_name string, content binary")
    write_files(scans, os.path.join(tmp_dir, "s"), "file_name", "content").write.format("noop").mode("overwrite").save()
    arts = spark.createDataFrame([("gazette_1001-001_a.html", "x")], "file_name string, html string")
    write_files(arts, os.path.join(tmp_dir, "a")).write.format("noop").mode("overwrite").save()
    out = os.path.join(tmp_dir, "missing")
    assert main(["missing", os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "a"), out]) == 0
    assert [r.stem for r in spark.read.parquet(out).collect()] == ["gazette_1001-002"]


def test_compact_article_html(spark, tmp_dir):
    from scanpress.sources.files import compact_article_html

    docs = fx.article_docs(fx.doc_articles(fx.read_table(spark, SF, "documents"))).select("file_name", "html")
    folder = os.path.join(tmp_dir, "html")
    write_files(docs, folder).write.format("noop").mode("overwrite").save()
    out = os.path.join(tmp_dir, "compact")
    compact_article_html(spark, folder, out, target_files=2)
    compact = spark.read.parquet(out)
    assert compact.count() == docs.count()
    assert compact.join(docs, ["file_name", "html"], "left_anti").count() == 0


def test_extraction_keeps_first_successful_attempt(spark, tmp_dir):
    from scanpress.schemas import RESPONSES

    ok = '{"finish_reason":"STOP"}'
    rows = [
        ("p1", "gemini-2.0", 0, 1, "ai", "<article><headline>Failed</headline></article>", '{"finish_reason":"MAX_TOKENS"}', 5, 5),
        ("p1", "claude-3.7", 1, 1, "ai", "<article><headline>Fallback</headline></article>", ok, 5, 5),
        ("p1", "gpt-4.1", 2, 1, "ai", "<article><headline>Later</headline></article>", ok, 5, 5),
        ("p2", "gemini-2.0", 0, 1, "ai", "<article><headline>Primary</headline></article>", ok, 5, 5),
    ]
    path = os.path.join(tmp_dir, "replies")
    spark.createDataFrame(rows, RESPONSES).write.parquet(path)
    out = run_extraction(spark, path, os.path.join(tmp_dir, "run"))
    got = sorted((r.page_id, r.headline) for r in spark.read.parquet(out["articles"]).collect())
    assert got == [("p1", "Fallback"), ("p2", "Primary")]
    assert spark.read.parquet(out["summary"]).collect()[0].replies == 4  # every attempt is counted and billed
    everything = run_extraction(spark, path, os.path.join(tmp_dir, "all"), first_success_only=False)
    assert spark.read.parquet(everything["articles"]).count() == 3
