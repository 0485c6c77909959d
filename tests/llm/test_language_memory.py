"""What the executor and its Python workers hold of the language stage's rows, whatever their number."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from scanpress.llm import common, langid


def test_trigrams_of_a_batch_are_summed_as_they_come():
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefgh ", k=3000)) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([("en", "de")[k % 2] for k in range(1500)])], names=["t", "l"])
    counted = {}
    tracemalloc.start()
    counted.update(langid.trigram_counts(batch))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10e6
    for lang, k in (("en", 0), ("de", 1)):
        codes, counts = counted[lang]
        each = [langid.trigrams(t) for t in texts[k::2]]
        assert int(counts.sum()) == sum(int(n.sum()) for _, n in each) and (np.diff(codes) > 0).all()
        assert set(codes.tolist()) == {c for own, _ in each for c in own.tolist()}


def test_batches_of_the_language_stage_are_bounded_by_bytes(spark, monkeypatch):
    key, seen, written = "spark.sql.execution.arrow.maxBytesPerBatch", [], common.materialize
    before = spark.conf.get(key, None)
    monkeypatch.setattr(langid, "materialize", lambda df, name: seen.append(spark.conf.get(key, None)) or written(df, name))
    df = spark.createDataFrame([(k, f"one two three four five {k % 3}", "en") for k in range(9)], "doc_id long, text string, lang string")
    assert langid.drop_unidentified(df).count() == 9
    assert seen == [str(common.BATCH_BYTES)] and spark.conf.get(key, None) == before
