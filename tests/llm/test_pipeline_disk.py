"""What the pipeline's stages leave on disk: no second copy of the texts, no table or shuffle that is no longer read."""

from __future__ import annotations

import os
import uuid
from collections import Counter

import corpus_pipeline
from scanpress import session
from scanpress.llm import common, dedup, jaccard, langid

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SF = "/root/testdata/sf0.001"


def _new_folders(spark, work) -> list[str]:
    base = os.path.join(session.ensure_checkpoint_dir(spark).removeprefix("file:"), "scanpress")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    work()
    return sorted(os.path.join(base, x) for x in set(os.listdir(base)) - before)


def _bytes(folder: str) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def _texts(spark, n: int = 60):
    rows = [(k, " ".join(f"{uuid.uuid4().hex} the" for _ in range(400)) if k % 20 else "12 !!", "en") for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").localCheckpoint()


def test_the_language_stage_writes_scores_and_no_text(spark):
    docs, kept = _texts(spark), []
    folders = _new_folders(spark, lambda: kept.append(langid.drop_unidentified(docs)))
    assert sum(map(_bytes, folders)) < 60_000  # the texts are 0.8 MB of random letters
    assert sorted(r.doc_id for r in kept[0].collect()) == [k for k in range(60) if k % 20]


def test_the_language_stage_goes_by_text_where_ids_repeat_or_are_null(spark):
    rows = [(k % 3 or None, t, "en") for k, t in enumerate(["one two", "??", None, "one two", "three four", "one two", "12", "six"])]
    df = spark.createDataFrame(rows * 3, "doc_id long, text string, lang string")
    kept = Counter(tuple(r) for r in langid.drop_unidentified(df).collect())
    assert kept == Counter(r for r in rows * 3 if r[1] and any(c.isalpha() for c in r[1]))


def test_texts_are_not_shuffled_to_drop_few_rows(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spark.conf.set(key, "-1")
    try:
        for stage in (langid.drop_unidentified, dedup.drop_duplicates, jaccard.keep_one_per_component):
            plan = stage(docs)._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set(key, before)


def test_the_join_leaves_its_result_alone(spark, monkeypatch):
    seen, written, before = [], common.materialize, spark.conf.get(KEY, None)
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: seen.append((name, spark.conf.get(KEY, None))) or written(df, name))
    df = spark.createDataFrame([(k, f"one two three four five {k % 3}") for k in range(9)], "doc_id long, text string")
    made = []
    folders = _new_folders(spark, lambda: made.append(jaccard.jaccard_components(df)))
    assert len(seen) > 5 and {on for _, on in seen} == {"true"} and spark.conf.get(KEY, None) == before
    assert [os.path.basename(f).partition("-")[0] for f in folders] == ["labelled"]
    assert Counter(r.component_id for r in made[0].collect()) == Counter({0: 3, 1: 3, 2: 3})


def test_release_spares_what_is_read_and_what_others_made(spark):
    other = common.materialize(spark.range(3), "other")
    with common.scratch_released(spark) as outer:
        first = common.materialize(spark.range(4), "first")
        with common.scratch_released(spark) as release:
            second = common.materialize(spark.range(5), "second")
            path = session.scratch_path(spark, "parts")
            spark.range(6).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(path)
            parts = spark.read.parquet(path)
            release(parts)
            assert not os.path.exists(os.path.dirname(second.inputFiles()[0].removeprefix("file://")))
        assert (other.count(), first.count(), parts.count()) == (3, 4, 6)
        outer()
    assert not os.path.exists(path.removeprefix("file:")) and path not in session._SCRATCH and other.count() == 3


def test_the_pipeline_leaves_its_last_table(spark):
    made = []
    folders = _new_folders(spark, lambda: made.append(corpus_pipeline.run(spark, SF)))
    assert [os.path.basename(f).rpartition("-")[0] for f in folders] == ["stage-packing"]
    assert made[0].count() > 0


def test_texts_are_read_and_sent_in_small_batches(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["n"])

    wide = common.materialize(spark.range(0, 1500, 1, 1).selectExpr("repeat('x', 20000) AS text"), "wide")
    with common.small_batches(spark):
        assert spark.conf.get(key) == "512"
        found = [r.n for r in wide.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 30_000_000 and max(found) < 2e6 and spark.conf.get(key) == before
