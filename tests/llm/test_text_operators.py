"""Chat formatting, WARC bundles, token shards, language ID, LM scoring against brute force and round trips."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from scanpress.llm import chat, langid, lmscore, tokenids, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- chat


def test_chat_round_trip(spark):
    rows = [
        (1, 0, "user", "a </turn>\n<turn x"),
        (1, 1, "user", "<\\/turn> <part/> <\\\\part/>"),
        (1, 2, "assistant", None),
        (1, 3, "assistant", "<"),
        (1, 4, "assistant", "\\turn >"),
        (2, 1, None, "x" * 200_000),
        (2, 0, "we%ird>\n<role", "t"),
        (None, None, "assistant", "lost"),
        (3, 5, "assistant", "same"),
        (3, 5, "assistant", "same"),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in chat.read_chats(chat.format_chats(df)).collect()}
    for conv in (1, 2, None, 3):
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (-1 if r[1] is None else r[1]))
        assert [(t.role, t.text) for t in out[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        # An empty assistant text takes no code point.
        assert out[conv].loss_texts == [r[3] for r in own if r[2] == "assistant" and r[3]]
    assert out[1].formatted.count("<turn ") == 2  # adjacent turns of one role share a block


def test_chat_mask_spans_the_assistant_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "an<turn s")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(df).first()
    at, taken = 0, []
    for span in row.loss_mask:
        at += span.skip
        taken.append(row.formatted[at : at + span.take])
        at += span.take
    assert "".join(taken) == "an<\\turn s"


def test_chat_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_chats(chat.format_chats(df)).collect() == []


# ---------------------------------------------------------------- WARC


def test_warc_round_trip(spark, tmp_dir):
    big, other = "é" * 700, "b" * 1000
    rows = [(1, "http://x/ y", big), (5, None, big), (3, "u", big), (2, "u", other), (7, "u", None), (8, "u", "s"), (9, "u", "s"), (5, None, big), (None, "u", other)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, sha1 int").repartition(3)
    index = warc.write_warc(df, f"{tmp_dir}/w", frame_bytes=900)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_warc(index, f"{tmp_dir}/w").collect())
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "") == (html or "")]
        keep = max(same) if len(data) >= 1000 and same else page
        kind = "response" if keep == page else "revisit"
        want[(page, len(data), hashlib.sha1(data).hexdigest(), kind, None if keep == page else keep)] += 1
    assert got == want
    record = {r.page_id: bytes(r.record) for r in warc.fetch_records(index.filter("page_id IN (2, 5)"), f"{tmp_dir}/w").collect()}
    headers, block, end = warc.parse_record(record[2])
    assert headers["WARC-Record-ID"] == "<urn:page:2>" and block.endswith(other.encode()) and end == len(record[2])


def test_warc_reading_keeps_its_tasks(spark, tmp_dir):
    df = spark.createDataFrame([(k, "u", "x" * 5000 + str(k)) for k in range(64)], "page_id long, url string, html string")
    index = warc.write_warc(df, f"{tmp_dir}/w", frame_bytes=900)
    tasks = warc.read_tasks(index, 10_000)
    assert tasks >= 33  # 64 records of more than 5000 bytes
    used = warc.read_warc(index, f"{tmp_dir}/w", 10_000).groupBy(F.spark_partition_id()).count().count()
    assert used > tasks // 2


def test_warc_very_long_payload(spark, tmp_dir):
    df = spark.createDataFrame([(1, "u", "é" * 3_000_000), (2, "u", "é" * 3_000_000)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in warc.read_warc(warc.write_warc(df, f"{tmp_dir}/w"), f"{tmp_dir}/w").collect()}
    assert [(rows[k].payload_bytes, rows[k].record_type, rows[k].refers_to) for k in (1, 2)] == [(6_000_000, "revisit", 2), (6_000_000, "response", None)]


def test_warc_empty_table(spark, tmp_dir):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(warc.write_warc(df, f"{tmp_dir}/w"), f"{tmp_dir}/w").count() == 0


# ---------------------------------------------------------------- token shards


@pytest.mark.parametrize("bits", [8, 1])
def test_token_ids_equal_the_library(spark, tmp_dir, bits):
    from tokenizers import Tokenizer

    texts = ["Hello, World's <|endoftext|> x́ İI éA", None, "", "  ", "a\x0bb\x0c\x1cc\x85d\xa0e", "12 3,4.5 ok. Ok, it's", "été Straße ñ.", "word " * 30_000, "Hello, World's"]
    rows = [(10 - k, t, "x") for k, t in enumerate(texts)] + [(None, "null id", "x"), (3, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    index = tokenids.write_token_ids(df, f"{tmp_dir}/t", TOKENIZER, block_ids=1000, plane_bits=bits)
    got = [tuple(r) for r in tokenids.token_stream(index, f"{tmp_dir}/t").orderBy("start").collect()]
    library, start, want = Tokenizer.from_file(TOKENIZER), 0, []
    for doc, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_token_ids_empty_table(spark, tmp_dir):
    df = spark.createDataFrame([], "doc_id long, text string")
    index = tokenids.write_token_ids(df, f"{tmp_dir}/t", TOKENIZER)
    assert tokenids.token_stream(index, f"{tmp_dir}/t").count() == 0


# ---------------------------------------------------------------- language ID


def _direct_vector(text: str, dim: int) -> np.ndarray:
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    letters = f" {' '.join(letters.split())} "
    total = np.zeros(dim)
    for a, b, c in zip(letters, letters[1:], letters[2:], strict=False):
        va, vb, vc = (langid.letter_vector(ord(x), dim).astype(int) for x in (a, b, c))
        total += np.roll(va, 2) * np.roll(vb, 1) * vc
    return total


def test_language_prototypes_and_cosines_by_hand(spark):
    rows = [(1, "The cat, the DOG", "en"), (2, "le chat et le chien", "fr"), (3, "the end", "en"), (4, None, "fr"), (5, "x y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    prototypes = langid.train_prototypes(df, "text", "lang", 256)
    assert set(prototypes) == {"en", "fr"}
    want = _direct_vector(rows[0][1], 256) + _direct_vector(rows[2][1], 256)
    assert (prototypes["en"] == want).all()
    own, fr = _direct_vector("un chien", 256), prototypes["fr"]
    cosine = own @ fr / np.linalg.norm(own) / np.linalg.norm(fr)
    row = langid.identify(spark.createDataFrame([("un chien",)], "text string"), "text", prototypes, 256).first()
    assert row.lang_pred == "fr" and math.isclose(row.score, cosine, rel_tol=1e-5)


def test_language_edge_rows_and_held_out_accuracy(spark):
    odd = spark.createDataFrame([(1, None, "en"), (2, "12 !", "en"), (3, "", None), (None, "hello", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_documents(odd).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert langid.identify_documents(odd.limit(0)).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    both = langid.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in both) >= 0.95 * len(both)
    for r in langid.identify_documents(docs).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1


def test_unidentified_rows_go_and_columns_stay(spark):
    rows = [(k, t, "en", k) for k, t in enumerate(["hello there", None, "??", "more words here"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score long")
    kept = langid.drop_unidentified(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) in ([0, 3], [])  # [] when no training row falls outside the fold


def test_noise_goes_and_clean_rows_stay(spark):
    rng = np.random.default_rng(7)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    letters = list("abcdefghijklmnopqrstuvwxyz")
    noise = ["".join(rng.choice([*letters, " "] if k % 2 else letters, 1500)) for k in range(60)]
    rows = [(1_000_000 + k, t, None) for k, t in enumerate(noise)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in langid.drop_unidentified(both).select("doc_id").collect()}
    clean = {r.doc_id for r in docs.filter("text RLIKE '\\\\p{L}'").select("doc_id").collect()}
    assert kept == clean


# ---------------------------------------------------------------- LM scoring


def _brute_scores(docs, targets, order=lmscore.ORDER, k=lmscore.SMOOTHING):
    def units(text):
        data = (text or "").lower().encode("utf-16-le")
        return [data[i : i + 2] for i in range(0, len(data), 2)]

    def model(texts):
        gram, context, unit = Counter(), Counter(), Counter()
        for text in texts:
            own = [b"\0\0"] * (order - 1) + units(text)
            for i in range(order - 1, len(own)):
                gram[tuple(own[i - order + 1 : i + 1])] += 1
                context[tuple(own[i - order + 1 : i])] += 1
                unit[own[i]] += 1
        return gram, context, unit

    background, target = model([t for _, t in docs]), model([t for d, t in docs if d in targets])
    vocabulary = len(background[2])

    def loss(m, g):
        p = (m[2][g[-1]] + 1) / (sum(m[2].values()) + vocabulary)
        return -math.log((m[0][g] + k * p) / (m[1][g[:-1]] + k))

    out = []
    for doc, text in docs:
        own = [b"\0\0"] * (order - 1) + units(text)
        grams = [tuple(own[i - order + 1 : i + 1]) for i in range(order - 1, len(own))]
        if grams:
            t, b = (sum(loss(m, g) for g in grams) / len(grams) for m in (target, background))
            out.append((doc, len(grams), t, b, t - b))
        else:
            out.append((doc, 0, None, None, None))
    return out


@pytest.mark.parametrize("limit", [lmscore.BROADCAST_GRAMS, 0])
def test_scores_equal_brute_force(spark, limit):
    docs = [(1, "Good text here"), (2, "bad bad text"), (3, None), (4, ""), (5, "é😀 emoji"), (1, "repeated id"), (None, "no id")]
    df = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, score double").repartition(2)
    ids = spark.createDataFrame([(1,), (1,), (5,), (None,)], "id long")
    got = lmscore.score_documents(df, ids, broadcast_grams=limit).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(_brute_scores(docs, {1, 5}), key=key), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-8) if b[2] is not None else a == b


def test_scores_without_targets_or_documents(spark):
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    none = spark.createDataFrame([], "id long")
    assert lmscore.score_documents(df, none).first().score > 0
    assert lmscore.score_documents(df.limit(0), none).count() == 0


def test_unit_scores_of_a_table_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter(F.col("quality") == 1).collect()}
    ids = spark.createDataFrame([(d,) for d in good], "id long")
    got = {r.doc_id: r.score for r in lmscore.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), ids).collect()}
    for doc, _, _, _, score in _brute_scores(docs, good):
        assert got[doc] == pytest.approx(score, abs=1e-8)
