from __future__ import annotations

from scanpress.operators import audit
from scanpress.operators.attempts import first_success, union_attempts


def test_missing_scans_ledger_l4_l5(spark):
    scans = spark.createDataFrame(
        [("d/gazette_1001-001.jpg", "gazette_1001-001"), ("d/a_b_c.jpg", "a_b_c"), ("d/a_b.jpg", "a_b"),
         ("d/nounder.jpg", "nounder"), ("d/gazette_1001-010.jpg", "gazette_1001-010"), ("d/gazette_1001-2.jpg", "gazette_1001-2")],
        "path string, stem string",
    )
    names = spark.createDataFrame([("gazette_1001-001_x.html",), ("a_b_c_x.html",), ("a_b.html",), ("nounder",)], "file_name string")
    got = [r.path for r in audit.natural_sort(audit.missing_scans(scans, names), "path").collect()]
    # a_b_c never matches (an article of it has key a_b); "nounder" is its own key; digits sort as numbers.
    assert got == ["d/a_b_c.jpg", "d/gazette_1001-2.jpg", "d/gazette_1001-010.jpg"]


def test_sample_n(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    a = [r.k for r in audit.sample_n(df, 10, 1, "k").collect()]
    b = [r.k for r in audit.sample_n(df, 10, 1, "k").collect()]
    assert a == b and len(set(a)) == 10
    assert audit.sample_n(df, 0, 1, "k").count() == 100
    assert audit.sample_n(df, 500, 1, "k").count() == 100


def test_first_success(spark):
    a0 = spark.createDataFrame([("p1", 0, "m0", False, "BAD_FINISH:MAX_TOKENS"), ("p2", 0, "m0", True, "OK"),
                                ("p3", 0, "m0", False, "NO_ARTICLES")], "page_id string, attempt int, model string, ok boolean, status string")
    a1 = spark.createDataFrame([("p1", 1, "m1", True, "OK"), ("p2", 1, "m1", True, "OK"), ("p3", 1, "m1", False, "BAD_FINISH:SAFETY")],
                               "page_id string, attempt int, model string, ok boolean, status string")
    got = {r.page_id: (r.chosen_attempt, r.chosen_model, r.status) for r in first_success(union_attempts(a0, a1)).collect()}
    assert got == {"p1": (1, "m1", "OK"), "p2": (0, "m0", "OK"), "p3": (None, None, "NO_ARTICLES")}


def test_run_summary_counts_failures(spark):
    df = spark.createDataFrame([("p1", "OK", 2, 1, 1), ("p1", "NO_ARTICLES", 0, None, None), ("p2", "BAD_FINISH:x", 0, 1, 1)],
                               "page_id string, status string, n_articles int, input_tokens long, output_tokens long")
    r = audit.run_summary(df).collect()[0]
    assert (r.pages_done, r.replies, r.ok_replies, r.failed_replies, r.articles, r.replies_without_usage) == (2, 3, 1, 2, 2, 1)


def test_sample_is_the_smallest_hashes_and_stays_spread(spark):
    import hashlib

    keys = [f"k{i}" for i in range(5000)] + ["same"] * 700 + [None] * 5
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int").repartition(7)
    ranked = sorted(hashlib.md5(f"{k}3".encode()).hexdigest() for k in keys if k)
    for n in (1, 16, 2500, 5699):
        picked = audit.sample_n(df, n, 3, "k")
        got = sorted(r.sample_key for r in picked.collect())
        assert got == ranked[:n], n
    at = ranked.index(hashlib.md5(b"same3").hexdigest())
    assert audit.sample_n(df, at + 300, 3, "k").count() == at + 300  # cut within the rows of one key
    assert audit.sample_n(df, 16, 3, "k").rdd.getNumPartitions() == 7
