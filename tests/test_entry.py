from __future__ import annotations

import re

import duckdb

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ROWS_ONLY: set[str] = set()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"file_name", "html", "slug"} <= set(df.columns)


def test_every_query_has_oracle_or_is_rows_only():
    # The training-data queries, if installed, have their own tests.
    own = {name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name)}
    assert own - set(entry.oracle_sql()) == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_oracle_matches_on_smallest_scale(spark):
    con = duckdb.connect()
    for t in ("pages", "documents", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name in ["extract_articles", "article_html", "cost_by_model", "name_offset", "missing_scans", "corpus"]:
        df = queries[name](spark, SF)
        cols = sorted(df.columns)
        got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
        rel = con.sql(sqls[name])
        idx = [rel.columns.index(c) for c in cols]
        want = sorted(tuple(str(r[i]) for i in idx) for r in rel.fetchall())
        assert got == want, name
