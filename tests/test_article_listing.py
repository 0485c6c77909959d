from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from scanpress.sources import files as src


def _write(folder: str, contents: dict[str, bytes]) -> None:
    for name, content in contents.items():
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(content)


def _read(spark, folder: str) -> list[tuple]:
    rows = src.read_article_html(spark, folder).select("file_name", "path", F.col("html").cast("binary").alias("html"))
    return sorted((r.file_name, r.path, bytes(r.html)) for r in rows.collect())


def test_no_article_file_is_listed_by_the_driver(spark, tmp_dir):
    contents = {f"{n % 5}/a_{n}-1_x.html": f"<p>{n}</p>".encode() for n in range(300)}
    _write(tmp_dir, contents)
    files = src.read_article_html(spark, tmp_dir)
    # Spark's sources hold the status of every file they list; only the listing's part files may be held.
    held = files.inputFiles()
    assert len(held) <= spark.sparkContext.defaultParallelism and not [f for f in held if f.endswith(".html")]
    assert sorted(r.html.encode() for r in files.collect()) == sorted(contents.values())


def test_listing_and_reading_in_small_batches_lose_nothing(spark, tmp_dir, monkeypatch):
    contents = {f"{n % 3}/{n % 2}/a_{n}-1_x.html": b"x" * n for n in range(100)} | {f"b_{n}-1_x.html": b"y" * n for n in range(20)}
    _write(tmp_dir, contents)
    monkeypatch.setattr(src, "LISTED_AT_ONCE", 7)
    monkeypatch.setattr(src, "READ_AT_ONCE", 50)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        files = src.read_article_html(spark, tmp_dir)
        assert files.rdd.getNumPartitions() == 8  # 120 files of 16 KB and their 5,140 bytes
        got = [(r.file_name, r.html.encode()) for r in files.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted((name.rsplit("/", 1)[-1], content) for name, content in contents.items())


def test_odd_names_and_contents(spark, tmp_dir):
    names = ["a b.html", "é%20.html", "日本.html", "a+b=c&d;e@f,g$h!i~j'k(l)*m.html", 'q"#<>?[x]^`{|}.html', "b\\c.html",
             "nb\xa0sp.html", "tab\t.html", "😀.html", "d e/é/ü%41.html", "_d/x.html", ".h.html", "k=1/z.html", "dir.html/y.html"]
    contents = {f"r [1]/{name}": f"<p>{name}</p>".encode() for name in names}
    contents |= {"r [1]/bad.html": b"x\xff", "r [1]/bom.html": b"\xef\xbb\xbfa\r\nb", "r [1]/empty.html": b""}
    _write(tmp_dir, contents)
    _write(tmp_dir, {"r [1]/x.HTML": b"no", "r [1]/x.htm": b"no"})
    os.symlink(os.path.join(tmp_dir, "nothing"), os.path.join(tmp_dir, "r [1]/broken.html"))
    got = _read(spark, tmp_dir)
    assert [(n, c) for n, _, c in got] == sorted((name.rsplit("/", 1)[-1], content) for name, content in contents.items())
    # the paths are those of Spark's own source, which passes over hidden and empty files
    plain = spark.read.text(tmp_dir, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.html")
    expected = {r.file_path for r in plain.select("_metadata.file_path").collect()}
    assert len(expected) == len(contents) - 3
    assert {p for n, p, _ in got if n not in (".h.html", "x.html", "empty.html")} == expected


def test_folders_are_given_as_globs_files_or_uris(spark, tmp_dir):
    from pyspark.errors import AnalysisException

    _write(tmp_dir, {"r1/a.html": b"a", "r2/s/b.html": b"b", "r2/c.txt": b"c", "o/d.html": b"d"})
    for folder, names in {
        f"{tmp_dir}/r*": ["a.html", "b.html"], f"{tmp_dir}/{{o,r1}}/": ["a.html", "d.html"], f"file://{tmp_dir}/o": ["d.html"],
        f"{tmp_dir}/r1/a.html": ["a.html"], f"{tmp_dir}/*/*.html": ["a.html", "d.html"], f"{tmp_dir}/r2/c.txt": [],
    }.items():
        assert [n for n, _, _ in _read(spark, folder)] == names, folder
    os.makedirs(f"{tmp_dir}/none")
    assert _read(spark, f"{tmp_dir}/none") == []
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        src.read_article_html(spark, f"{tmp_dir}/missing")
