"""Importance resampling against a plain recomputation."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from scanpress.llm import importance
from scanpress.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _grams(text, most):
    words = _words(text)
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def _brute(docs, target, most=1, buckets=10_000, percent=10, least=20, seed=2024):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, _grams(text, most)))
    for text in target:
        t.update(map(bucket, _grams(text, most)))
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        grams = _grams(text, most)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in map(bucket, grams))
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(_words(text)), len(grams), weight, score))
    may = sorted((-r[4], r[0] is None, r[0] or 0, r) for r in rows if r[1] >= least)
    drawn = [r for *_, r in may[: len(may) * percent // 100]]
    return Counter((*r, None) for r in rows) - Counter((*r, None) for r in drawn) + Counter((*r, k) for k, r in enumerate(drawn, 1))


def _docs(rng):
    word = lambda: rng.choice(["alpha", "Beta", "ÉTÉ", "日本語", "x1", "𝛼", "q" * 300, "mid-dle", "nul\x00l"])
    docs = [(k, rng.choice([" ", "\n", ", ", "\x7f"]).join(word() for _ in range(rng.choice([0, 1, 5, 19, 20, 21, 80])))) for k in range(300)]
    docs += [(1000 + k, "same words over and over " * 5) for k in range(150)]  # ties in weight
    return [*docs, (2000, None), (2001, ""), (2002, " \t"), (2003, "w " * 200_000), (2004, "z" * 70_000), (None, "beta " * 30), (7, docs[7][1])]


@pytest.mark.parametrize(("most", "piece"), [(1, importance.PIECE), (3, 61)])
def test_draw_equals_brute_force(spark, most, piece, monkeypatch):
    if piece < importance.PIECE:  # texts cut into small pieces
        monkeypatch.setattr(importance.hashed, "__defaults__", (piece,))
    docs = _docs(random.Random(8))
    docs = docs if most == 1 else [d for d in docs if d[0] != 2003] + [(2003, "a bc def " * 3000)]
    target = ["alpha beta", None, "", "the mid of été"]
    df = spark.createDataFrame([(*d, 5, "x") for d in docs], "doc_id long, text string, score int, buckets string").repartition(4)
    found = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), max_run=most)
    assert Counter(tuple(r) for r in found.collect()) == _brute(docs, target, most)


def test_small_bucket_numbers_and_no_rows(spark):
    docs = [(k, " ".join(random.Random(k).choices(["a", "b", "c", "dd"], k=25))) for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    found = importance.resample(df, none, percent=50, buckets=70_001)
    assert Counter(tuple(r) for r in found.collect()) == _brute(docs, [], buckets=70_001, percent=50)
    assert importance.resample(df.limit(0), none).count() == 0


def test_crcs_of_all_lengths():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in [*range(40), *range(30), 255, 256, 257, 5000]] + [b"again"] * 9
    offsets = np.cumsum([0, *map(len, words)])
    got = importance.crc_buckets(np.frombuffer(b"".join(words), np.uint8), offsets, 10_000)
    assert got.tolist() == [zlib.crc32(w) % 10_000 for w in words]


def test_registered_draw_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = Counter((r.doc_id, r.n_features, r.n_features, r.weight, r.score, r["rank"]) for r in QUERIES["op12_importance_resampling"](spark, SF).collect())
    assert got == _brute(docs, target)
