"""Scan files to documents: rounds, restart, accumulation, container checks."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import types as T

from scanpress.functions.containers import damage
from scanpress.operators.filters import valid_scans
from scanpress.plans import transcription as tr
from scanpress.plans.fixtures import image_files
from scanpress.sources.commits import CommitTable
from scanpress.sources.files import read_files, read_scans

REPLY = {"n_generations": 1, "message_type": "ai", "response_metadata": '{"finish_reason":"STOP"}', "input_tokens": 3, "output_tokens": 4}


def _scans(root, names):
    for name, data in names.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as fh:
            fh.write(data)


def _model(log, fails=()):
    def call(record):
        with open(f"{log}/{record['model']}", "a", encoding="utf-8") as fh:
            fh.write(record["path"].rsplit("/", 2)[1] + "/" + record["page_id"] + "\n")
        assert json.loads(record["request_json"])["model"] == record["model"]
        if any(record["model"] == m and record["page_id"].endswith(end) for m, end in fails):
            raise TimeoutError("no answer")
        text = f"<article><headline>Same</headline><main>{record['path'].rsplit('/', 2)[1]}</main></article>"
        return {**REPLY, "content": text}

    return call


def _calls(log):
    return {m: sorted(open(f"{log}/{m}", encoding="utf-8").read().split()) for m in sorted(os.listdir(log))}


def _job(spark, root, model, run, folders=("a", "b"), **sizes):
    return tr.scans_to_documents(
        spark, [f"{root}/{f}" for f in folders], f"{root}/out", model, ["m1", "m2"], "Read.", parallelism=2, calls_per_task=1, run_id=run, **sizes
    )


def test_rounds_ask_only_where_needed_and_folders_may_share_names(spark, tmp_dir):
    png = image_files()["png"]
    log = f"{tmp_dir}/log"
    os.makedirs(log)
    _scans(tmp_dir, {
        "a/p_1-1.png": png, "b/p_1-1.png": png, "a/p_1-2.png": png, "b/p_1-3.png": png[:-1], "b/_p_1-4.png": png, "b/odd [x] {y}.png": png,
    })
    out = _job(spark, tmp_dir, _model(log, [("m1", "1-1"), ("m1", "1-4"), ("m2", "1-4")]), "run-1")
    assert _calls(log) == {
        "m1": sorted(["a/p_1-1", "b/p_1-1", "a/p_1-2", "b/_p_1-4", "b/odd", "[x]", "{y}"]),
        "m2": ["a/p_1-1", "b/_p_1-4", "b/p_1-1"],
    }
    docs = {(r.path.rsplit("/", 2)[1], r.page_id): (r.file_name, r.attempt, r.model) for r in out["documents"].collect()}
    assert docs == {
        ("a", "p_1-1"): ("p_1-1_same.html", 1, "m2"), ("b", "p_1-1"): ("p_1-1_same_1.html", 1, "m2"),
        ("a", "p_1-2"): ("p_1-2_same.html", 0, "m1"), ("b", "odd [x] {y}"): ("odd [x] {y}_same.html", 0, "m1"),
    }
    failed = {(r.page_id, r.reason, r.attempts) for r in out["failed"].collect()}
    assert failed == {("p_1-3", "INVALID_SCAN:truncated", 1), ("_p_1-4", "MODEL_ERROR:TimeoutError", 2)}
    done = out["progress"].first()
    assert (done.pages_done, done.pages_failed, done.calls, done.pages_with_documents, done.documents) == (6, 2, 8, 4, 4)

    # A second run with a new folder adds to the first; nothing answered is asked again, unanswered pages neither.
    _scans(tmp_dir, {"c/p_1-1.png": png})
    out = _job(spark, tmp_dir, _model(log), "run-2", ("a", "b", "c"))
    assert [c for c in _calls(log)["m1"] if c.startswith("c/")] == ["c/p_1-1"] and len(_calls(log)["m1"]) == 8
    names = sorted(r.file_name for r in out["documents"].collect())
    assert names == sorted([*(n for n, _, _ in docs.values()), "p_1-1_same_2.html"])
    assert len(tr.documents(spark, f"{tmp_dir}/out").commits()) == 2


def test_restart_repeats_no_committed_call(spark, tmp_dir, monkeypatch):
    png = image_files()["png"]
    log = f"{tmp_dir}/log"
    os.makedirs(log)
    _scans(tmp_dir, {f"a/p_1-{k}.png": png for k in range(9)})
    whole = CommitTable.publish
    published = []

    def dies(self, key, data):
        if len(published) == 2:
            raise KeyboardInterrupt  # the rows of the third micro-batch are written, but not committed
        published.append(key)
        whole(self, key, data)

    monkeypatch.setattr(CommitTable, "publish", dies)
    with pytest.raises(KeyboardInterrupt):
        _job(spark, tmp_dir, _model(log), "run", ("a",))
    monkeypatch.setattr(CommitTable, "publish", whole)
    kept = {r.page_id for r in tr.ledger(spark, f"{tmp_dir}/out").read().collect()}
    before = _calls(log)["m1"]
    assert kept and kept < {c.split("/")[1] for c in before}
    out = _job(spark, tmp_dir, _model(log), "run", ("a",))
    again = sorted(_calls(log)["m1"])
    assert {c.split("/")[1] for c in again if again.count(c) > 1} == {c.split("/")[1] for c in before} - kept
    assert out["documents"].count() == 9 and out["progress"].first().calls == 9
    again = tr.write_documents(spark, f"{tmp_dir}/out", "run")  # a repeated run id writes nothing
    assert again.read().count() == 9


def test_round_is_planned_once_and_its_batches_are_bounded(spark, tmp_dir, monkeypatch):
    png = image_files()["png"]
    log = f"{tmp_dir}/log"
    os.makedirs(log)
    _scans(tmp_dir, {**{f"a/p_1-{k}.png": png for k in range(12)}, "a/p_1-x.png": png[:-1]})
    plans, sizes, whole = [], [], CommitTable.publish
    build = tr.build_requests
    monkeypatch.setattr(tr, "build_requests", lambda *a, **k: plans.append(1) or build(*a, **k))

    def counts(self, key, data):
        whole(self, key, data)
        if "/ledger" in self.root:
            sizes.append(self.read([key]).count())

    monkeypatch.setattr(CommitTable, "publish", counts)
    out = _job(spark, tmp_dir, _model(log, [("m1", "1-3")]), "run", ("a",))
    assert len(plans) == 2  # one per round, however many micro-batches it has
    assert len(sizes) > 4 and sum(sizes) == 14
    assert out["documents"].count() == 12 and out["progress"].first().calls == 13
    assert {(r.page_id, r.reason) for r in out["failed"].collect()} == {("p_1-x", "INVALID_SCAN:truncated")}


def test_stores_that_arrow_cannot_open_are_asked_batch_by_batch(spark, tmp_dir, monkeypatch):
    log = f"{tmp_dir}/log"
    os.makedirs(log)
    _scans(tmp_dir, {"a/p_1-1.png": image_files()["png"], "a/p_1-2.png": image_files()["png"][:-1]})
    monkeypatch.setattr(tr, "arrow_opens", lambda uri: False)
    out = _job(spark, tmp_dir, _model(log), "run", ("a",))
    assert out["documents"].count() == 1 and [r.reason for r in out["failed"].collect()] == ["INVALID_SCAN:truncated"]


def test_no_scans_and_commit_table(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/a")
    out = _job(spark, tmp_dir, _model(tmp_dir), "empty", ("a",))
    assert out["documents"].count() == 0 and out["failed"].count() == 0 and out["progress"].first().pages_done == 0
    table = CommitTable(spark, f"{tmp_dir}/t", T.StructType([T.StructField("x", T.LongType())]))
    assert table.read().count() == 0
    assert table.append(spark.range(3).toDF("x"), "a/b @1") and not table.append(spark.range(9).toDF("x"), "a/b @1")
    assert table.append(spark.range(5).toDF("x"), "2") and table.read().count() == 8
    spark.range(100).toDF("x").write.parquet(f"{tmp_dir}/t/data-aborted")  # an append that never committed
    assert table.read().count() == 8 and table.read(["2"]).count() == 5
    table.drop(["2"])
    assert table.read().count() == 3 and list(table.commits()) == ["a/b @1"]


def test_files_by_listed_paths(spark, tmp_dir):
    _scans(tmp_dir, {"x/a b+c%20.png": b"1", "x/.hid den.png": b"2", "x/{q}.png": b"3"})
    paths = [r.path for r in read_scans(spark, f"{tmp_dir}/x").collect()]
    assert len(paths) == 3
    assert sorted(bytes(r.content) for r in read_files(spark, [*paths, f"file:{tmp_dir}/x/gone.png"]).collect()) == [b"1", b"2", b"3"]
    assert {r.path for r in read_files(spark, paths).collect()} == set(paths)


@pytest.mark.parametrize("kind", ["png", "jpeg", "gif", "webp", "tiff", "bmp"])
def test_every_cut_file_is_damaged_and_no_bytes_raise(kind):
    whole = image_files()[kind]
    assert damage(kind, whole) is None and damage(kind, whole + b"trailing") is None
    for n in range(len(whole)):
        assert damage(kind, whole[:n]) is not None, n
    for at in range(len(whole)):
        for byte in (0, 0xFF, whole[at] ^ 1):
            damage(kind, whole[:at] + bytes([byte]) + whole[at + 1 :])
    assert damage("unknown", whole) == damage(kind, None) == "unknown format"


def test_valid_scans_names_the_damage(spark):
    rows = [(k, d) for k, d in image_files().items()] + [("cut", image_files()["png"][:-3]), ("sum", image_files()["png"].replace(b"\x00\x01\x00", b"\x00\x02\x00", 1)), ("none", None)]
    found = {r.k: (r.image_kind, r.valid, r.damage) for r in valid_scans(spark.createDataFrame(rows, "k string, content binary")).collect()}
    assert {k for k, (_, valid, _) in found.items() if valid} == {"png", "jpeg", "gif", "webp", "tiff", "bmp"}
    assert found["cut"] == ("png", False, "truncated") and found["sum"] == ("png", False, "check sum")
    assert found["unknown"] == ("unknown", False, "unknown format") and found["none"] == (None, False, "unknown format")
