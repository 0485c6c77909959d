"""Image container check (FLT-3): the structure of a file from its first byte to its end marker.

Pixels are not decoded.  A file is whole when its container can be walked:

* PNG: chunks in bounds with right check sums, a header with a size, image data, the end chunk;
* JPEG: segments in bounds, a frame, a scan, the end marker;
* GIF: blocks in bounds, an image, the trailer;
* WebP: chunks in bounds of the RIFF size, an image chunk;
* TIFF: directories, their values and their strips or tiles in bounds, no cycle;
* BMP: headers, and for plain pixels all their rows.

Bytes after the end are ignored.  The walk is linear in the file and holds no copy of it.
"""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.functions.images import image_kind
from scanpress.functions.text import _c


class _Damaged(ValueError):
    """The reason why a container cannot be walked."""


def _need(ok: bool, reason: str) -> None:
    if not ok:
        raise _Damaged(reason)


def _png(data: memoryview) -> None:
    at, first, pixels = 8, True, False
    while True:
        _need(at + 12 <= len(data), "truncated")
        size, kind = struct.unpack_from(">I4s", data, at)
        _need(at + 12 + size <= len(data), "truncated")
        (crc,) = struct.unpack_from(">I", data, at + 8 + size)
        _need(zlib.crc32(data[at + 4 : at + 8 + size]) == crc, "check sum")
        if first:
            _need(kind == b"IHDR" and size == 13 and 0 not in struct.unpack_from(">II", data, at + 8), "header")
        first, pixels, at = False, pixels or kind == b"IDAT", at + 12 + size
        if kind == b"IEND":
            _need(pixels, "no image")
            return


def _jpeg(data: memoryview) -> None:
    raw, at, frame, scan = bytes(data), 2, False, False
    while True:
        _need(at + 2 <= len(raw), "truncated")
        _need(raw[at] == 0xFF, "marker")
        marker = raw[at + 1]
        if marker == 0xFF:  # fill byte
            at += 1
        elif marker == 0xD9:
            _need(frame and scan, "no image")
            return
        elif marker == 0x01 or 0xD0 <= marker <= 0xD8:
            at += 2
        else:
            _need(at + 4 <= len(raw), "truncated")
            (size,) = struct.unpack_from(">H", raw, at + 2)
            _need(size >= 2, "marker")
            _need(at + 2 + size <= len(raw), "truncated")
            frame = frame or (0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC))
            at += 2 + size
            if marker == 0xDA:
                scan = True
                while True:  # entropy-coded bytes up to the next marker
                    at = raw.find(b"\xff", at)
                    _need(0 <= at < len(raw) - 1, "truncated")
                    if raw[at + 1] != 0 and not 0xD0 <= raw[at + 1] <= 0xD7:
                        break
                    at += 2


def _sub_blocks(data: memoryview, at: int) -> int:
    while True:
        _need(at < len(data), "truncated")
        size, at = data[at], at + 1 + data[at]
        if not size:
            return at


def _gif(data: memoryview) -> None:
    _need(len(data) >= 13, "truncated")
    at, image = 13, False
    if data[10] & 0x80:
        at += 3 << (data[10] & 7) + 1
    while True:
        _need(at < len(data), "truncated")
        block = data[at]
        if block == 0x3B:
            _need(image, "no image")
            return
        if block == 0x21:
            at = _sub_blocks(data, at + 2)
        else:
            _need(block == 0x2C, "block")
            _need(at + 10 <= len(data), "truncated")
            colours = 3 << (data[at + 9] & 7) + 1 if data[at + 9] & 0x80 else 0
            at, image = _sub_blocks(data, at + 10 + colours + 1), True


def _webp(data: memoryview) -> None:
    _need(len(data) >= 12, "truncated")
    end = 8 + struct.unpack_from("<I", data, 4)[0]
    _need(end <= len(data), "truncated")
    at, image = 12, False
    while at + 8 <= end:
        kind, size = struct.unpack_from("<4sI", data, at)
        _need(at + 8 + size <= end, "truncated")
        image = image or kind in (b"VP8 ", b"VP8L", b"ANMF")
        at += 8 + size + (size & 1)
    _need(image, "no image")


# Bytes of each TIFF value type.
_TIFF_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}


def _tiff(data: memoryview) -> None:
    order = "<" if bytes(data[:2]) == b"II" else ">"
    _need(len(data) >= 8, "truncated")
    (at,) = struct.unpack_from(order + "I", data, 4)
    seen, image = set(), False
    while at:
        _need(at not in seen, "cycle")
        seen.add(at)
        _need(at + 2 <= len(data), "truncated")
        (n,) = struct.unpack_from(order + "H", data, at)
        _need(at + 2 + 12 * n + 4 <= len(data), "truncated")
        places: dict[int, tuple[int, int, int]] = {}
        for entry in range(at + 2, at + 2 + 12 * n, 12):
            tag, kind, count = struct.unpack_from(order + "HHI", data, entry)
            size = _TIFF_SIZES.get(kind, 0) * count
            where = entry + 8 if size <= 4 else struct.unpack_from(order + "I", data, entry + 8)[0]
            _need(where + size <= len(data), "truncated")
            places[tag] = (kind, count, where)
        for offsets, lengths in ((273, 279), (324, 325)):
            if offsets in places and lengths in places:
                starts, sizes = (
                    struct.unpack_from(f"{order}{count}{'H' if kind == 3 else 'I'}", data, where) if kind in (3, 4) else ()
                    for kind, count, where in (places[offsets], places[lengths])
                )
                _need(all(a + b <= len(data) for a, b in zip(starts, sizes)), "truncated")
                image = image or bool(starts)
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)
    _need(image, "no image")


def _bmp(data: memoryview) -> None:
    _need(len(data) >= 26, "truncated")
    pixels, header = struct.unpack_from("<II", data, 10)
    _need(14 + header <= len(data) and pixels <= len(data), "truncated")
    if header >= 40:
        _need(len(data) >= 34, "truncated")
        width, height, _, bits, packing = struct.unpack_from("<iiHHI", data, 18)
    else:
        width, height, _, bits = struct.unpack_from("<HHHH", data, 18)
        packing = 0
    _need(width > 0 and height != 0, "header")
    if packing in (0, 3):
        _need(pixels + (width * bits + 31) // 32 * 4 * abs(height) <= len(data), "truncated")


_WALKS = {"png": _png, "jpeg": _jpeg, "gif": _gif, "webp": _webp, "tiff": _tiff, "bmp": _bmp}


def damage(kind: str | None, data: bytes | None) -> str | None:
    """Why the container is not whole, or None where it is."""
    if data is None or kind not in _WALKS:
        return "unknown format"
    try:
        _WALKS[kind](memoryview(data))
    except _Damaged as reason:
        return str(reason)
    except Exception as error:  # noqa: BLE001 - a file never stops the others
        return type(error).__name__
    return None


@F.pandas_udf(T.StringType())
def _damage_udf(kinds: pd.Series, contents: pd.Series) -> pd.Series:
    return pd.Series([None if k is None else damage(k, c) for k, c in zip(kinds, contents, strict=True)], dtype=object)


def image_damage(content: Column | str, kind: Column | None = None) -> Column:
    """Why the bytes are no whole image, or null where they are; bytes of no known format are not sent to Python."""
    kind = image_kind(content) if kind is None else kind
    known = kind.isNotNull() & (kind != "unknown")
    walked = _damage_udf(F.when(known, kind), F.when(known, _c(content)))
    return F.when(known, walked).otherwise(F.lit("unknown format"))
