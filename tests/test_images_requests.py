from __future__ import annotations

import json
import os

import numpy as np

from scanpress.functions.images import image_base64, image_kind
from scanpress.operators.binarize import binarize, binarize_scans, read_images, sauvola_threshold
from scanpress.operators.requests import build_requests, observe_progress, transcribe_pages
from test_sources_streaming import _png


def _naive_threshold(img: np.ndarray, window: int, k: float) -> np.ndarray:
    h, w = img.shape
    half = window // 2
    padded = np.pad(img.astype(np.float64), half, mode="reflect")
    out = np.zeros((h, w))
    for i in range(h):
        for j in range(w):
            win = padded[i : i + window, j : j + window]
            m, s = win.mean(), win.std()
            out[i, j] = m * (1 + k * (s / 127.5 - 1))
    return out


def test_sauvola_matches_naive_window():
    rng = np.random.default_rng(1)
    for shape in [(30, 40), (7, 9), (26, 26)]:
        img = rng.integers(0, 256, size=shape, dtype=np.uint8)
        np.testing.assert_allclose(sauvola_threshold(img, 25, 0.2), _naive_threshold(img, 25, 0.2), rtol=1e-9, atol=1e-7)


def test_strips_meet_without_a_seam():
    rng = np.random.default_rng(4)
    for shape in [(1, 1), (1, 9), (9, 1), (3, 40), (61, 17), (130, 33)]:
        img = rng.integers(0, 256, size=shape, dtype=np.uint8)
        img[: shape[0] // 2] //= 8
        whole = binarize(img)
        assert (whole == (img > sauvola_threshold(img)) * 255).mean() > 0.999
        for strip in (1, 7, 25, 64):
            assert (binarize(img, strip=strip) == whole).all()
    flat = np.full((40, 40), 100, np.uint8)
    assert (binarize(flat, k=0.0) == 0).all()  # equal to the threshold: not brighter


def test_constant_image_is_white():
    img = np.full((10, 12), 200, dtype=np.uint8)
    assert (binarize(img) == 255).all()


def test_binarize_png_through_image_source(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "imgs")
    os.makedirs(folder)
    with open(os.path.join(folder, "g.png"), "wb") as fh:
        fh.write(_png(8, 5, 90))
    with open(os.path.join(folder, "bad.png"), "wb") as fh:
        fh.write(b"not an image")
    out = binarize_scans(read_images(spark, folder)).collect()
    assert len(out) == 1 and out[0].height == 5 and out[0].width == 8
    assert set(out[0].data) == {255}
    flagged = {r.image_id.rsplit("/", 1)[-1]: r.valid for r in read_images(spark, folder, keep_invalid=True).collect()}
    assert flagged == {"g.png": True, "bad.png": False}


def test_image_kind_and_base64(spark):
    df = spark.createDataFrame([(b"\xff\xd8\xff\xe0" + b"x" * 100,), (_png(2, 2, 0),), (b"<html>",)], "c binary")
    assert [r[0] for r in df.select(image_kind("c")).collect()] == ["jpeg", "png", "unknown"]
    b64 = df.select(image_base64("c")).collect()[0][0]
    assert "\n" not in b64 and len(b64) == 140


def test_requests_and_transcription_hook(spark):
    scans = spark.createDataFrame([("p1", b"\xff\xd8\xffabc"), ("p2", b"\xff\xd8\xffdef")], "page_id string, content binary")
    reqs = build_requests(scans, "Read it.", ["m1", "m2"], "sys")
    rows = reqs.collect()
    assert len(rows) == 4
    body = json.loads(rows[0].request_json)
    assert body["messages"][0] == {"role": "system", "content": "sys"}
    assert body["messages"][1]["content"][0]["image_url"]["url"].startswith("data:image/jpeg;base64,")

    def call(rec):
        if rec["model"] == "m2":
            raise RuntimeError("rate limited")
        return {"content": "<article/>", "response_metadata": "{}", "input_tokens": 1, "output_tokens": 2,
                "n_generations": 1, "message_type": "ai"}

    out = {(r.page_id, r.model): r for r in transcribe_pages(reqs, call, parallelism=2).collect()}
    assert out[("p1", "m1")].content == "<article/>" and out[("p1", "m1")].error is None
    assert out[("p1", "m2")].error == "RuntimeError: rate limited"
    observed, obs = observe_progress(spark.createDataFrame([("OK",), ("NO_ARTICLES",)], "status string"))
    observed.collect()
    assert obs.get == {"pages_done": 2, "pages_failed": 1}


def _rgb_png(width: int, height: int, rgb: tuple[int, int, int]) -> bytes:
    import struct
    import zlib

    raw = b"".join(b"\x00" + bytes(rgb) * width for _ in range(height))

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)

    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_colour_image_is_read_as_bgr_and_greyed_with_601_luma(spark, tmp_dir):
    from scanpress.operators.binarize import to_grey

    folder = os.path.join(tmp_dir, "rgb")
    os.makedirs(folder)
    with open(os.path.join(folder, "red.png"), "wb") as fh:
        fh.write(_rgb_png(3, 2, (255, 0, 0)))
    row = read_images(spark, folder).collect()[0]
    assert (row.height, row.width, row.n_channels) == (2, 3, 3)
    assert bytes(row.data[:3]) == b"\x00\x00\xff"  # blue, green, red
    grey = to_grey(bytes(row.data), row.height, row.width, row.n_channels)
    assert grey.shape == (2, 3) and (grey == 76).all()
