"""What the executor and its Python workers hold of the join's rows, whatever their number."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from scanpress.llm import common, jaccard

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def _peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_shingling_holds_little_text_and_few_words():
    texts = [" ".join(f"w{300 * k + i}" for i in range(300)).encode() for k in range(1500)]  # 450,000 words, 3.5 MB
    jaccard._HASHES.clear()

    def work():
        for own in jaccard.shingle_sets(texts):
            assert len(own) == 296

    assert _peak(work) < 40e6 and len(jaccard._HASHES) <= 1 << 17


def test_sets_are_views():
    column = pa.chunked_array([[np.arange(3, dtype="<u8").tobytes(), b""], [np.arange(5, dtype="<u8").tobytes()]], pa.binary())
    assert [x.tolist() for x in jaccard._as_sets(column)] == [[0, 1, 2], [], [0, 1, 2, 3, 4]]
    wide = pa.array([bytes(8_000_000)] * 3, pa.binary())
    assert _peak(lambda: jaccard._as_sets(wide)) < 1e6


def test_batches_are_bounded_by_bytes_and_the_setting_is_put_back(spark, monkeypatch):
    before, seen, written = spark.conf.get(KEY, None), [], common.materialize

    def spied(df, name="materialized"):
        seen.append(spark.conf.get(KEY, None))
        return written(df, name)

    monkeypatch.setattr(jaccard, "materialize", spied)
    df = spark.createDataFrame([(k, f"one two three four five {k % 3}") for k in range(9)], "doc_id long, text string")
    assert jaccard.jaccard_components(df).count() == 9
    assert seen and set(seen) == {str(common.BATCH_BYTES)} and spark.conf.get(KEY, None) == before

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["n"])

    wide = spark.range(0, 1500, 1, 1).selectExpr("repeat('x', 20000) AS text")
    with common.small_batches(spark):
        found = [r.n for r in wide.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 30_000_000 and max(found) < 10e6
