"""Top-k, packing, Jaccard join, mixing, dedup and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scanpress.llm import dedup, jaccard, langid, mixing, packing, sigtree, topk
from scanpress.llm.components import connected_components
from scanpress.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- top-k


def _brute_topk(rows, k):
    data = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    queries = {}
    for i, v in data:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in itertools.zip_longest(v, w, fillvalue=0)), i) for i, w in data if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize(("pivots", "block", "slice_rows"), [(4, 2, 7), (64, 2048, 8192)])
def test_topk_equals_brute_force(spark, pivots, block, slice_rows):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) + (i % 3) for _ in range(4)]) for i in range(400)]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(150)]  # one common vector, ties
    rows += [(7000, None), (7050, [1.0, None]), (7100, [float("nan")]), (7150, [float("inf")]), (None, [1.0]), (7200, [2.0, -3.0]), (7250, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cell string").repartition(3)
    exact = [(r.vec_id, r.embedding) for r in df.collect()]
    data = topk.quantised(df, "vec_id", "embedding")
    found = topk.voronoi_topk(data, data.filter("id % 50 = 0"), 5, pivots, block, slice_rows)
    assert {tuple(r) for r in found.collect()} == _brute_topk(exact, 5)


def test_topk_with_most_rows_in_one_cell(spark):
    rng = random.Random(9)
    rows = [(i, [1.0 + rng.uniform(0, 0.02), 1.0]) for i in range(3000)] + [(5000 + i, [rng.uniform(-9, 9), rng.uniform(-9, 9)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    data = topk.quantised(df, "vec_id", "embedding")
    found = topk.voronoi_topk(data, data.filter("id % 50 = 0"), 5, block=16, slice_rows=300, salt_rows=100)
    assert {tuple(r) for r in found.collect()} == _brute_topk(rows, 5)


def test_topk_pivots_grow_with_the_rows(spark):
    data = spark.range(10_000).select("id", F.array("id").alias("v"))
    assert len(topk._space(data, None).pivots) == 100
    assert len(topk._space(data.limit(10), None).pivots) == 10


def test_topk_of_few_and_no_rows(spark):
    df = spark.createDataFrame([(50, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    data = topk.quantised(df, "vec_id", "embedding")
    assert [tuple(r) for r in topk.voronoi_topk(data, data.filter("id = 50")).collect()] == [(50, 1, 3, 131072)]
    assert topk.voronoi_topk(data.limit(0), data.limit(0)).count() == 0
    assert topk.voronoi_topk(data, data.limit(0)).count() == 0


# ---------------------------------------------------------------- packing


def _padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= n) - n for n in lengths)


def _histogram(lengths):
    return np.unique(np.array(lengths, np.int64), return_counts=True)


def _least_padding(lengths, buckets):
    """The plain dynamic program, every pair of bounds tried."""
    tops, counts = _histogram(lengths)
    docs = np.concatenate([[0], np.cumsum(counts)])
    cost = [0] + [math.inf] * len(tops)
    for _ in range(buckets):
        cost = [0] + [min(cost[i] + int(tops[j - 1] * (docs[j] - docs[i])) for i in range(j)) for j in range(1, len(tops) + 1)]
    return cost[-1] - sum(lengths)


def test_bounds_are_optimal():
    rng = random.Random(1)
    for _ in range(40):
        lengths = [rng.randint(0, 30) for _ in range(rng.randint(1, 25))]
        k = rng.randint(1, 4)
        bounds = packing.optimal_bounds(*_histogram(lengths), k)
        tops = sorted(set(lengths))
        best = min(_padding(lengths, [*c, tops[-1]]) for c in itertools.combinations(tops, min(k, len(tops)) - 1))
        assert len(bounds) <= k and _padding(lengths, bounds) == best


def test_batches_hold_the_budget(spark):
    texts = [None, "", "  "] + ["w " * n for n in [1, 2, 3, 5, 8, 13, 40, 40, 41, 5000, 9000, 100_000] * 9]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, bucket string")
    packed = packing.pack(df, buckets=5, budget=100, cell=10).cache()
    rows = packed.collect()
    assert Counter(r.doc_id for r in rows) == Counter(range(len(texts)))
    assert all(r.n_tokens == len((texts[r.doc_id] or "").split()) for r in rows)
    by_batch = defaultdict(list)
    for r in rows:
        assert r.padding == r.bucket_tokens - r.n_tokens >= 0
        by_batch[r.batch_id].append(r)
    for own in by_batch.values():
        assert len({r.bucket_tokens for r in own}) == 1 and sorted(r.slot for r in own) == list(range(len(own)))
        assert len(own) == 1 or len(own) * own[0].bucket_tokens <= 100
    assert len({r.bucket_tokens for r in rows}) <= 5
    assert packing.batches(packed).agg(F.sum(F.size("doc_ids"))).first()[0] == len(texts)
    assert packing.pack(df.limit(0)).count() == 0


def test_registered_packing_has_the_least_padding(spark):
    rows = QUERIES["op3_packing"](spark, SF).collect()
    lengths = [r.n_tokens for r in rows]
    assert sum(r.padding for r in rows) == _least_padding(lengths, packing.BUCKETS)


def test_bounds_are_optimal_at_every_length(spark):
    lengths = [10_000] * 1000 + [10_111] + [5_000] * 10 + [20_000] * 10
    df = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "doc_id long, n long")
    packed = packing.pack(df, n_tokens=F.col("n"), buckets=4)
    assert packed.agg(F.sum("padding")).first()[0] == 0
    rng = np.random.default_rng(3)
    for spread in (20, 400, 1 << 40):
        lengths = [int(n) for n in rng.integers(4000, 4000 + spread, 300)]
        for k in (1, 2, 5, 16):
            bounds = packing.optimal_bounds(*_histogram(lengths), k)
            assert len(bounds) <= k and _padding(lengths, bounds) == _least_padding(lengths, k)


# ---------------------------------------------------------------- Jaccard join


def _shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def _brute_components(rows):
    sets, root = [_shingles(t) for _, t in rows], list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k][0])
    least = {r: min((i for i in own if i is not None), default=None) for r, own in groups.items()}
    return Counter((rows[k][0], len(sets[k]), least[find(k)]) for k in range(len(rows)))


def _near_copies(rng):
    word = lambda: "".join(rng.choice("abcdef") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []
    for base in range(8):  # chains: every copy edits the one before it
        words = [word() for _ in range(rng.choice([6, 40, 300]))] + (passage if base % 2 else [])
        for _ in range(rng.choice([2, 9, 30])):
            rows.append(" ".join(words))
            words = list(words)
            words[rng.randrange(len(words))] = word()
    rows += [" ".join(word() for _ in range(20)) + " " + " ".join(passage) for _ in range(60)]
    rows += [None, "", " \t", "one two", "ONE  two", "one two three", "É a b c d e", "é a b c d e", "z " * 50_000]
    return rows


def test_components_equal_brute_force(spark):
    rows = list(enumerate(_near_copies(random.Random(3)), 100))
    rows += [(None, rows[0][1]), (5, rows[0][1]), (5, rows[0][1]), (5, "another text of one id here")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, size int").repartition(3)
    assert Counter(tuple(r) for r in jaccard.jaccard_components(df).collect()) == _brute_components(rows)


def test_small_units_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "UNIT", 8)
    monkeypatch.setattr(jaccard, "SMALL_GROUP", 4)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    rows = list(enumerate(_near_copies(random.Random(4))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in jaccard.jaccard_components(df).collect()) == _brute_components(rows)


def test_one_row_of_each_component_stays(spark):
    rows = [(2, "a b c d e f"), (1, "A b c d e f"), (3, None), (4, ""), (5, "x"), (9, "x")]
    df = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, comp long")
    kept = jaccard.keep_one_per_component(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]
    repeated = jaccard.keep_one_per_component(df.unionByName(df))
    assert Counter(r.doc_id for r in repeated.collect()) == Counter([1, 3, 4, 5])
    assert jaccard.keep_one_per_component(df.limit(0)).count() == 0


def test_tree_drops_no_pair():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 90)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(120)]
    sets += [np.unique(np.delete(s, slice(0, len(s) // 12))) for s in sets[:60]]
    sigs, sizes = [sigtree.signature(s) for s in sets], np.array([len(s) for s in sets])
    slack = rng.choice([0.0, 0.1], len(sets))
    found = set(jaccard._tree_pairs(list(range(len(sets))), sigs, sizes, slack, list(range(len(sets))), 80, 8))
    for a, b in itertools.combinations(range(len(sets)), 2):
        both, either = sigtree.jaccard_parts(sets[a], sets[b])
        if both >= (0.8 - slack[a] - slack[b]) * either:
            assert (a, b) in found


def test_connected_components(spark):
    rng = random.Random(6)
    edges = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(30)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(50):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


# ---------------------------------------------------------------- mixing


def _docs(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, source string, text string, position int").repartition(3)


def test_mix_meets_the_repetition_limit(spark):
    rows = [(k, "big" if k % 3 else "small", "w " * (1 + k % 7)) for k in range(600)] + [(900, None, "a b"), (901, "empty", None), (902, "empty", "")]
    for limit in (1.5, 3.0):
        out = mixing.mix(_docs(spark, rows), max_repeats=limit, block=16).collect()
        tokens = Counter()
        for _, s, t in rows:
            tokens[s] += len((t or "").split())
        weight = {r.source: r.weight for r in out}
        size = max(tokens[s] / w for s, w in weight.items() if w)
        assert max(size * w / tokens[s] for s, w in weight.items() if w) == pytest.approx(limit, rel=1e-6)
        assert sum(weight.values()) == pytest.approx(1)
        taken, copies = Counter(), Counter(r.doc_id for r in out)
        for r in out:
            taken[r.source] += r.n_tokens
            assert 0 <= r.position <= 1
        for s, w in weight.items():
            assert w * size - 1e-6 <= taken[s] < w * size + 7 if w else taken[s] == 0
        assert set(copies) == {r[0] for r in rows} and max(copies.values()) <= math.ceil(limit)


def test_mix_meets_an_entropy_and_a_budget(spark):
    rows = [(k, "abbccccc"[k % 8], "w " * 5) for k in range(800)]
    out = mixing.mix(_docs(spark, rows), budget=1000.0, max_repeats=None, target_entropy=1.0).collect()
    weight = {r.source: r.weight for r in out}
    assert -sum(w * math.log(w) for w in weight.values()) == pytest.approx(1.0, abs=1e-6)
    assert sum(r.n_tokens for r in out) == pytest.approx(1000, abs=15)
    with pytest.raises(ValueError, match="limit"):
        mixing.mix(_docs(spark, rows), budget=1e6, max_repeats=2.0)


def test_mixed_rows_repeat_whole_rows(spark):
    rows = [(k, "b" if k % 4 else "s", f"t {k}") for k in range(100)] + [(1, "b", "t 1"), (None, None, None)]
    df = _docs(spark, rows)
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    counts = Counter(tuple(r)[:3] for r in out.collect())
    assert set(counts) == {tuple(r) for r in rows} and counts[(1, "b", "t 1")] == 2 and counts[(4, "s", "t 4")] == 2
    assert mixing.mixed_rows(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0


def test_registered_mix_keeps_every_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = QUERIES["op9_mixing"](spark, SF)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}


# ---------------------------------------------------------------- dedup


def _brute_dedup(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc, len(text or "")))
    return {body: (min(own, key=lambda x: (-x[1], x[0] is not None, x[0] or 0))[0], len(own)) for body, own in groups.items()}


@pytest.mark.parametrize("counters", [3, 1023])
def test_dedup_equals_brute_force(spark, counters):
    rng = random.Random(8)
    rows = [(k, rng.choice(["a b", "ab", "a\tb ", "c", "d", "", None, " ", "😀", f"u{k}", "x" * 50_000 + " "])) for k in range(300)]
    rows += [(1000 + k, "hot text") for k in range(200)] + [(None, "c")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, digest string").repartition(4)
    want = _brute_dedup(rows)
    got = dedup.exact_dedup(df, counters=counters).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        body = re.sub(r"[\x20\x09-\x0D]", "", texts[r.doc_id] or "")
        assert (r.keep_id, r.group_size) == want[body] and r.text_sha256 == hashlib.sha256(body.encode()).hexdigest()
        assert r.kept == (r.doc_id == r.keep_id)
    kept = dedup.drop_duplicates(df.filter("doc_id IS NOT NULL"), counters=counters)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, _ in _brute_dedup([r for r in rows if r[0] is not None]).values())


def test_dedup_of_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a "), (None, None)], "doc_id long, text string")
    assert Counter(tuple(r) for r in dedup.drop_duplicates(df).collect()) == Counter([(None, "a "), (1, "b"), (None, None)])
    assert sum(r.kept for r in dedup.exact_dedup(df).collect()) == 3
    assert dedup.exact_dedup(df.limit(0)).count() == 0 and dedup.drop_duplicates(df.limit(0)).count() == 0


def test_misra_gries_keeps_heavy_values():
    import pyarrow as pa

    values = ["hot"] * 400 + [f"v{k}" for k in range(600)]
    random.Random(1).shuffle(values)
    batches = [pa.RecordBatch.from_arrays([pa.array(values[k : k + 100])], names=["d"]) for k in range(0, 1000, 100)]
    held = dedup.misra_gries(iter(batches), 9)
    assert len(held) <= 9 and 400 - 1000 / 10 <= held["hot"] <= 400


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "123 !!", "en", "s", 6)], docs.schema)
    now, seen = docs.unionByName(odd), {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in now.collect()]
        now = stage(spark, now, SF).cache()
        after = now.collect()
        seen[name] = len(after)
        ids = [r.doc_id for r in after]
        if name != "packing":
            assert now.columns == docs.columns
        if name == "language_id":
            assert sorted(ids) == sorted(d for d, t, _ in before if t and any(c.isalpha() for c in t))
        elif name == "exact_dedup":
            assert sorted(ids) == sorted(k for k, _ in _brute_dedup([b[:2] for b in before]).values())
        elif name == "jaccard_join":
            assert sorted(ids) == sorted(c[0] for c in _brute_components([b[:2] for b in before]) if c[0] == c[2])
        elif name == "mixing":
            assert set(ids) == {b[0] for b in before} and max(Counter(ids).values()) <= 2
        else:
            assert Counter(ids) == Counter(b[0] for b in before)
    assert corpus_pipeline.run(spark, SF).count() > 0 and len(seen) == 5


def test_language_stage_keeps_all_identified(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert langid.drop_unidentified(df).count() == df.filter("text IS NOT NULL AND text RLIKE '\\\\p{L}'").count()
