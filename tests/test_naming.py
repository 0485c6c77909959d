from __future__ import annotations

from scanpress.operators.naming import name_offset, unique_names

ARTS = "page_id string, ordinal int, slug string"


def test_unique_names_ledger_l18_l19(spark):
    df = spark.createDataFrame([("s_1-2", 0, "x"), ("s_1-2", 1, "x"), ("s_1-2", 2, "x"), ("s_1-2", 3, ""), ("t_1-1", 0, "x")], ARTS)
    got = sorted((r.ordinal, r.page_id, r.file_name) for r in unique_names(df).collect())
    assert [g[2] for g in got if g[1] == "s_1-2"] == ["s_1-2_x.html", "s_1-2_x_1.html", "s_1-2_x_2.html", "s_1-2_.html"]
    assert ("t_1-1_x.html") in [g[2] for g in got]


def test_name_offset_fills_lowest_free_counter(spark):
    new = spark.createDataFrame([("s_1-2", i, "x") for i in range(4)] + [("s_1-2", 9, "y")], ARTS)
    # _0 (plain) and _2 are on disk; "s_1-2_x_9" is also a plain name of base "s_1-2_x_9".
    written = spark.createDataFrame([("s_1-2_x.html",), ("s_1-2_x_2.html",), ("other.txt",), ("s_1-2_y_01.html",)],
                                    "file_name string")
    got = {r.ordinal: r.file_name for r in name_offset(new, written).collect()}
    assert got == {0: "s_1-2_x_1.html", 1: "s_1-2_x_3.html", 2: "s_1-2_x_4.html", 3: "s_1-2_x_5.html", 9: "s_1-2_y.html"}


def test_name_offset_brute_force(spark):
    import random

    rng = random.Random(3)
    rows, written = [], set()
    for base in range(20):
        n_new = rng.randint(0, 6)
        rows += [(f"p_{base}-0", i, "s") for i in range(n_new)]
        for c in rng.sample(range(10), rng.randint(0, 5)):
            written.add(f"p_{base}-0_s" + ("" if c == 0 else f"_{c}") + ".html")
    new = spark.createDataFrame(rows, ARTS)
    got = {(r.page_id, r.ordinal): r.file_name for r in name_offset(new, spark.createDataFrame([(w,) for w in written], "file_name string")).collect()}
    taken = set(written)
    for page, ordinal, _ in sorted(rows):
        base = f"{page}_s"
        c = 0
        while (base + ("" if c == 0 else f"_{c}") + ".html") in taken:
            c += 1
        name = base + ("" if c == 0 else f"_{c}") + ".html"
        taken.add(name)
        assert got[(page, ordinal)] == name
    assert len(set(got.values())) == len(got)


def test_rank_within_hot_group_equals_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from scanpress.operators.ranking import rank_within, running_sum_within

    df = spark.range(20000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
            (F.col("id") % 50).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 20011).alias("o"), F.col("id"), (F.col("id") % 5).alias("v"))
    plain = df.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy("o", "id"))).withColumn(
        "s", F.sum("v").over(Window.partitionBy("g").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)))
    ranked = rank_within(df, ["g"], ["o", "id"], "r", partitions=6, hot_rows=1000)
    summed = running_sum_within(df, ["g"], ["o", "id"], F.col("v"), "t", partitions=6, materialized=False, hot_rows=1000)
    both = plain.join(ranked.select("id", "r"), "id").join(summed.select("id", "t"), "id")
    assert both.filter((F.col("p") != F.col("r")) | (F.col("s") != F.col("t"))).count() == 0
    assert both.count() == 20000


def test_same_named_scans_in_two_folders_ledger_l20(spark):
    df = spark.createDataFrame(
        [("gazette_1-1", "b/gazette_1-1.jpg", 0, "x"), ("gazette_1-1", "a/gazette_1-1.jpg", 0, "x")],
        "page_id string, path string, ordinal int, slug string",
    )
    got = {r.path: r.file_name for r in unique_names(df, order=("path", "ordinal")).collect()}
    assert got == {"a/gazette_1-1.jpg": "gazette_1-1_x.html", "b/gazette_1-1.jpg": "gazette_1-1_x_1.html"}


def _sequential(rows, written, shielded):
    """Names one by one, in order: the first counter whose name is neither taken nor another base's plain name."""
    taken, names = set(written), {}
    for stem, ordinal, slug in sorted(rows):
        base, c = f"{stem}_{slug}", 0
        while True:
            name = base + (f"_{c}" if c else "") + ".html"
            if name not in taken and (c == 0 or name not in shielded):
                break
            c += 1
        taken.add(name)
        names[(stem, ordinal, slug)] = name
    return names


def test_names_are_unique_across_bases(spark):
    rows = [("p", 0, "x"), ("p", 1, "x"), ("p", 2, "x"), ("p_x", 0, "1"), ("p_x", 1, "1"), ("p_x_1", 0, "1"), ("q", 0, "x")]
    plain = {f"{a}_{b}.html" for a, _, b in rows}
    new = spark.createDataFrame(rows, ARTS)
    got = {(r.page_id, r.ordinal, r.slug): r.file_name for r in unique_names(new).collect()}
    assert got == _sequential(rows, set(), plain)
    assert len(set(got.values())) == len(rows)
    written = {"p_x.html", "p_x_2.html", "p_x_1.html", "q_x_7.html"}
    old = spark.createDataFrame([(w,) for w in sorted(written)] * 2, "file_name string")
    for hot in (2, 2_000_000):
        got = {(r.page_id, r.ordinal, r.slug): r.file_name for r in name_offset(new, old, hot_rows=hot).collect()}
        assert got == _sequential(rows, written, plain)
        assert not written & set(got.values()) and len(set(got.values())) == len(rows)


def test_tied_and_null_rows_are_kept(spark):
    rows = [("s", 0, "x", "a")] * 2 + [("s", 0, "x", "b"), ("s", None, "x", "c"), (None, 0, "x", "d"), ("t", 0, "x", "e")]
    got = unique_names(spark.createDataFrame(rows, ARTS + ", body string")).collect()
    assert sorted(r.body for r in got) == ["a", "a", "b", "c", "d", "e"]
    assert sorted(r.file_name for r in got if r.page_id) == ["s_x.html", "s_x_1.html", "s_x_2.html", "s_x_3.html", "t_x.html"]
    assert [r.file_name for r in got if r.page_id is None] == [None]
