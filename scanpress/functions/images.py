"""Image byte functions: base64, data URLs, format check (SC-16, FLT-3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanpress.functions.text import _c


def image_base64(content: Column | str) -> Column:
    """Base64 of the bytes on one line (Spark's ``base64`` may wrap at 76 characters)."""
    return F.translate(F.base64(_c(content)), "\r\n", "")


def image_kind(content: Column | str) -> Column:
    """Image format from the leading magic bytes; ``unknown`` when none matches."""
    head = F.hex(F.substring(_c(content), 1, 12))
    return (
        F.when(_c(content).isNull(), F.lit(None))
        .when(head.startswith("FFD8FF"), F.lit("jpeg"))
        .when(head.startswith("89504E470D0A1A0A"), F.lit("png"))
        .when(head.startswith("474946383761") | head.startswith("474946383961"), F.lit("gif"))
        .when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250"), F.lit("webp"))
        .when(head.startswith("49492A00") | head.startswith("4D4D002A"), F.lit("tiff"))
        .when(head.startswith("424D"), F.lit("bmp"))
        .otherwise(F.lit("unknown"))
    )


def image_mime(content: Column | str) -> Column:
    kind = image_kind(content)
    return F.when(kind == "unknown", F.lit("application/octet-stream")).otherwise(
        F.concat(F.lit("image/"), kind)
    )


def image_data_url(content: Column | str, mime: Column | str | None = None) -> Column:
    """``data:<mime>;base64,<bytes>``; the MIME type follows the bytes unless given."""
    kind = image_mime(content) if mime is None else (F.lit(mime) if isinstance(mime, str) else mime)
    return F.concat(F.lit("data:"), kind, F.lit(";base64,"), image_base64(content))
