"""Word scores of op7 against brute force."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanpress.llm import wordlm


def _brute_word_scores(docs, targets, order=wordlm.ORDER, k=wordlm.SMOOTHING):
    lists = [["<s>"] * (order - 1) + (t or "").lower().split() for _, t in docs]
    grams = [[tuple(w[i - order + 1 : i + 1]) for i in range(order - 1, len(w))] for w in lists]

    def model(own):
        own = [g for gs in own for g in gs]
        return Counter(own), Counter(g[:-1] for g in own), Counter(g[-1] for g in own)

    background, target = model(grams), model([g for (d, _), g in zip(docs, grams, strict=True) if d in targets])

    def loss(m, g):
        p = (m[2][g[-1]] + 1) / (sum(m[2].values()) + len(background[2]))
        return -math.log((m[0][g] + k * p) / (m[1][g[:-1]] + k))

    for (doc, _), own in zip(docs, grams, strict=True):
        t, b = (sum(loss(m, g) for g in own) / len(own) if own else None for m in (target, background))
        yield (doc, len(own), t, b, t - b if own else None)


@pytest.mark.parametrize(("order", "chunk", "buckets"), [(2, 1 << 19, 32), (2, 3, 2), (3, 5, 7), (1, 4, 3)])
def test_word_scores_equal_brute_force(spark, order, chunk, buckets):
    docs = [(1, "Good text here and good text there"), (2, "bad bad text"), (3, None), (4, " \t"), (5, "É😀 emoji good"), (1, "repeated id text"), (None, "no id")]
    docs += [(k, "the common pair " * (k % 5) + f"w{k} good text") for k in range(10, 60)]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, extra string").repartition(3)
    ids = spark.createDataFrame([(1,), (1,), (5,), (12,), (None,)], "id long")
    out = wordlm.score_words(df, ids, order=order, chunk_words=chunk, buckets=buckets)
    assert out.columns == ["doc_id", "extra", *wordlm.FIELDS]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got = sorted((tuple(r) for r in out.drop("extra").collect()), key=key)
    for a, b in zip(got, sorted(_brute_word_scores(docs, {1, 5, 12}, order), key=key), strict=True):
        assert a[:2] == b[:2] and (a[2:] == pytest.approx(b[2:], abs=1e-8) if b[2] is not None else a == b)
    assert wordlm.score_words(df.limit(0), ids).count() == 0
    assert wordlm.score_words(df, ids.limit(0)).count() == len(docs)


def test_registered_query_scores_words_whose_counts_grow(spark):
    from scanpress.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter(F.col("quality") == 1).collect()}
    got = {r.doc_id: r for r in QUERIES["op7_lm_scoring"](spark, sf).collect()}
    for doc, n, _, _, score in _brute_word_scores(docs, good):
        assert got[doc].n_words == n and (got[doc].score == pytest.approx(score, abs=1e-8) if n else got[doc].score is None)
    # What is gathered follows the corpus: the keys of all documents far outnumber those of a tenth.
    split, keys = [(t or "").lower().split() for _, t in docs], []
    for part in (split[::10], split):
        known, numbers = np.unique(wordlm.word_hashes([w for own in part for w in own]), return_inverse=True)
        keys.append(len(wordlm.keys_of(known, numbers, np.array([len(own) for own in part]), wordlm.ORDER)[0]))
    assert keys[1] > 4 * keys[0]


def test_a_very_long_text_and_hot_words_are_scored_whole(spark):
    long = " ".join(f"w{k % 5000} the" for k in range(200_000))
    docs = [(1, long), (2, "the " * 50_000), *[(k, "the same copy") for k in range(3, 400)]]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    ids = spark.createDataFrame([(2,), (7,)], "id long")
    got = {r.doc_id: r for r in wordlm.score_words(df, ids, chunk_words=1000, buckets=64).collect()}
    for doc, n, t, b, score in _brute_word_scores(docs, {2, 7}):
        assert tuple(got[doc]) == (doc, n, pytest.approx(t, abs=1e-8), pytest.approx(b, abs=1e-8), pytest.approx(score, abs=1e-8))


def test_a_chunk_sends_no_row_for_buckets_it_does_not_touch(spark, tmp_dir):
    """Rows follow the keys, not chunks times buckets."""
    df = spark.createDataFrame([(k, "a b", False) for k in range(40)], "doc_id long, text string, t boolean").repartition(2)
    rows = df.mapInArrow(wordlm._asked(2, 10_000, 2, f"file://{tmp_dir}/chunks"), wordlm.ROW)
    assert rows.filter("docs IS NULL").groupBy("chunk").count().agg({"count": "max"}).first()[0] <= 5  # a, b, start, two grams
    assert rows.filter("docs IS NOT NULL").count() == 40
