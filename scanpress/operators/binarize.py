"""Scan binarisation with a Sauvola local threshold (IMG-1).

Sauvola & Pietikaeinen (2000): ``T = m * (1 + k * (s / R - 1))`` with the
mean ``m`` and standard deviation ``s`` of a ``window x window`` neighbourhood
(reflected at the borders) and ``R`` half the grey range; a pixel brighter
than ``T`` becomes white (255), the others black (0).

An image is worked on in strips of ``STRIP`` rows with half a window of rows
above and below, so besides the image's bytes and its black and white copy a
task holds the sums of one strip, whatever the height of the scan.  Sums of
pixels and of their squares are integers, from integral images of the strip,
and the comparison is made in integers too: with the window's area ``A``, sum
``S`` and sum of squares ``Q``, and ``k = n / d``,

    pixel > T   if and only if   255 A (d A pixel - (d - n) S) > 2 n S sqrt(A Q - S^2)

so strips meet without a seam and the result depends on no rounding.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINARY_IMAGES = T.StructType([
    T.StructField("image_id", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
    T.StructField("black_pixels", T.LongType()),
])


def to_grey(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """uint8 grey pixels; colour input is BGR(A) as Spark's image source stores it (ITU-R 601-2 luma)."""
    pixels = np.frombuffer(data, dtype=np.uint8)
    if channels == 1:
        return pixels.reshape(height, width)
    px = pixels.reshape(height, width, channels).astype(np.uint32)
    b, g, r = px[..., 0], px[..., 1], px[..., 2]
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(np.uint8)


def sauvola_threshold(grey: np.ndarray, window: int = 25, k: float = 0.2) -> np.ndarray:
    """Per-pixel threshold of a 2-D uint8 image."""
    image = grey.astype(np.float64)
    half = window // 2
    padded = np.pad(image, ((half + 1, half), (half + 1, half)), mode="reflect")

    def window_sums(values: np.ndarray) -> np.ndarray:
        integral = values.cumsum(axis=0).cumsum(axis=1)
        w = window
        return integral[w:, w:] - integral[:-w, w:] - integral[w:, :-w] + integral[:-w, :-w]

    area = float(window * window)
    mean = window_sums(padded) / area
    mean_sq = window_sums(padded * padded) / area
    std = np.sqrt(np.clip(mean_sq - mean * mean, 0, None))
    dynamic_range = 0.5 * (255 - 0)
    return mean * (1 + k * ((std / dynamic_range) - 1))


STRIP = 256


def _reflected(first: int, last: int, n: int) -> np.ndarray:
    """Indices ``first`` to ``last`` of a row of ``n``, mirrored at its ends (which are not repeated)."""
    if n == 1:
        return np.zeros(last - first, np.int64)
    at = np.arange(first, last) % (2 * n - 2)
    return np.where(at < n, at, 2 * n - 2 - at)


def _white(grey: np.ndarray, sums: np.ndarray, squares: np.ndarray, area: int, k: Fraction) -> np.ndarray:
    """The integer comparison; where doubles cannot tell, with whole numbers of any size."""
    n, d = k.numerator, k.denominator
    left = 255 * area * (d * area * grey.astype(np.int64) - (d - n) * sums)
    spread = area * squares - sums * sums
    a, b = left.astype(np.float64) ** 2, 4.0 * n * n * sums.astype(np.float64) ** 2 * spread.astype(np.float64)
    if n >= 0:
        white = (left > 0) & (a > b)
    else:
        white = (left > 0) | (a < b)
    for at in zip(*np.nonzero(np.abs(a - b) <= 1e-12 * (a + b)), strict=True):
        x, y = int(left[at]), 2 * n * int(sums[at])
        exact = (x > 0) - (x < 0), (y > 0) - (y < 0)
        x2, y2 = exact[0] * x * x, exact[1] * y * y * int(spread[at])
        white[at] = x2 > y2
    return white


def binarize(grey: np.ndarray, window: int = 25, k: float = 0.2, strip: int = STRIP) -> np.ndarray:
    """Black and white copy of a 2-D uint8 image, strip by strip."""
    return binarize_rows(lambda first, last: grey[first:last], *grey.shape, window, k, strip)


def binarize_rows(rows, height: int, width: int, window: int = 25, k: float = 0.2, strip: int = STRIP) -> np.ndarray:  # noqa: ANN001
    """The same from ``rows(first, last)``, which gives grey rows; each row is asked for by two strips at most, or mirrored."""
    half, ratio = window // 2, Fraction(str(k))
    out = np.empty((height, width), np.uint8)
    columns = _reflected(-half, width + window - 1 - half, width)
    for first in range(0, height, strip):
        last = min(first + strip, height)
        wanted = _reflected(first - half, last + window - 1 - half, height)
        low = int(wanted.min())
        grey = rows(low, int(wanted.max()) + 1)
        padded = grey[wanted - low][:, columns].astype(np.int64)
        sums = []
        for values in (padded, padded * padded):
            integral = np.zeros((values.shape[0] + 1, values.shape[1] + 1), np.int64)
            np.cumsum(values.cumsum(axis=0), axis=1, out=integral[1:, 1:])
            sums.append(integral[window:, window:] - integral[:-window, window:] - integral[window:, :-window] + integral[:-window, :-window])
        out[first:last] = np.where(_white(grey[first - low : last - low], *sums, window * window, ratio), 255, 0)
    return out


def binarize_scans(images: DataFrame, window: int = 25, k: float = 0.2) -> DataFrame:
    """IMG-1 over rows ``(image_id, height, width, n_channels, data)``."""

    def run(batches):  # noqa: ANN001, ANN202
        for pdf in batches:
            out = []
            for rec in pdf.itertuples(index=False):
                height, width, row = int(rec.height), int(rec.width), int(rec.width) * int(rec.n_channels)

                def grey(first: int, last: int, rec=rec, width=width, row=row) -> np.ndarray:  # noqa: ANN001
                    return to_grey(memoryview(rec.data)[first * row : last * row], last - first, width, int(rec.n_channels))

                binary = binarize_rows(grey, height, width, window, k)
                out.append((rec.image_id, height, width, binary.tobytes(), int((binary == 0).sum())))
            yield pd.DataFrame(out, columns=BINARY_IMAGES.fieldNames())

    cols = images.select("image_id", "height", "width", "n_channels", "data")
    return cols.mapInPandas(run, BINARY_IMAGES)


def read_images(spark: SparkSession, folder: str, keep_invalid: bool = False) -> DataFrame:
    """Decoded images through Spark's ``image`` source.

    Files that do not decode are dropped, or with ``keep_invalid`` kept with
    ``valid = false`` (the source marks them with height -1) so each bad page
    is reported instead of stopping the job.
    """
    df = spark.read.format("image").option("dropInvalid", not keep_invalid).load(folder)
    out = df.select(
        F.col("image.origin").alias("image_id"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.data").alias("data"),
    )
    return out.withColumn("valid", F.col("height") >= 0) if keep_invalid else out


def bytes_as_images(df: DataFrame, id_col: str, content: str, width: int = 64) -> DataFrame:
    """Lay raw bytes out as grey images ``width`` pixels wide; the last row is padded with spaces."""
    size = F.octet_length(content)
    height = F.greatest(F.ceil(size / width), F.lit(1)).cast("int")
    padded = F.concat(F.col(content), F.expr("cast(repeat(' ', _pad) as binary)"))
    return df.withColumn("_pad", (height * width - size).cast("int")).select(
        F.col(id_col).cast("string").alias("image_id"),
        height.alias("height"),
        F.lit(width).alias("width"),
        F.lit(1).alias("n_channels"),
        padded.alias("data"),
    )
