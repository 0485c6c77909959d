"""Operator 12, resampling towards a target distribution by length-bucketed CRC matrices.

Features are runs of consecutive words, hashed into buckets by CRC-32; a
bucket's gain is its smoothed log ratio of target to source, and a document's
weight the sum of its features' gains.  Weights with Gumbel noise, the largest
kept, draw without replacement in proportion to the importance weights.

1. Tasks find the words of an Arrow column on its bytes: a lookup table marks
   word bytes, their edges are the words, and the words laid end to end (one
   space between) hold every feature as one slice.
2. The distinct features of a piece are grouped by length; those of equal
   length are a two-dimensional ``uint8`` array whose CRCs advance together,
   column by column.  The buckets are scattered back to the features' places.
   Every document becomes (id, words, features, buckets), two bytes a feature;
   texts are read once and never shuffled.
3. Tasks add up their bucket counts (at most ``buckets`` rows each), Spark adds
   up those; the gains (``buckets`` numbers, a parameter) go back to all tasks.
4. The scores are range-partitioned by (score, id) and written once; a row's
   rank is its place in its partition plus the rows of the partitions before,
   so no task holds all of them.

A piece is at most ``PIECE`` bytes of text plus one word; a longer text is cut
between words, and its features go on over the cut.

Defined results: a null or empty text has no words, weight 0 and no rank; a
null id has the noise of an empty one and comes last among ties; repeated rows
are rows of their own, in any order among themselves; an empty table gives an
empty result, an empty target only smoothed gains; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanpress.llm.common import materialize

PIECE = 1 << 20
LONGEST_COLUMNS = 256
HASHED = "position long, doc_id long, n_words long, n_features long, buckets binary"


def _crc_table() -> np.ndarray:
    """CRC-32 of every byte, from the reversed polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC_TABLE = _crc_table()
_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Words are of digits, lower-case letters and everything beyond ASCII.
IS_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the slices laid end to end, their n + 1 offsets)."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)], offsets


def crc_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int) -> np.ndarray:
    """CRC-32 modulo ``buckets`` of every slice of ``data``: distinct ones only, those of equal length as one matrix."""
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = column.dictionary_encode()
    _, at, held = coded.dictionary.buffers()
    at = np.frombuffer(at, np.int64)[: len(coded.dictionary) + 1]
    held = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    lengths, crcs = np.diff(at), np.empty(len(coded.dictionary), np.uint32)
    by_length = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[by_length], prepend=-1))
    for group in np.split(by_length, edges[1:]) if len(edges) else []:
        length = int(lengths[group[0]])
        if length > LONGEST_COLUMNS:  # few rows of many columns: one after the other
            crcs[group] = [zlib.crc32(held[at[g] : at[g + 1]]) for g in group]
            continue
        matrix = held[at[group][:, None] + np.arange(length)]
        crc = np.full(len(group), 0xFFFFFFFF, np.uint32)
        for column_bytes in matrix.T:
            crc = CRC_TABLE[(crc ^ column_bytes) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        crcs[group] = ~crc
    return (crcs % np.uint32(buckets))[coded.indices.to_numpy()]


def _words(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, lengths, rows) of the words of texts laid end to end; ``rows`` are their n + 1 offsets."""
    low = LOWER[data]
    mask = np.zeros(len(low) + 2, bool)
    mask[1:-1] = IS_WORD[low]
    cut = np.zeros(len(low) + 1, bool)
    cut[rows] = True
    starts = np.flatnonzero(mask[1:-1] & (~mask[:-2] | cut[:-1]))
    ends = np.flatnonzero(mask[1:-1] & (~mask[2:] | cut[1:])) + 1
    return low, starts, ends - starts, np.searchsorted(rows, starts, "right") - 1


def _features(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray, rows: np.ndarray, orders: range) -> Iterator[tuple]:
    """(slices laid end to end, offsets, rows) of the runs of each length in ``orders``."""
    spaced, at = _gather(np.append(low, np.uint8(32)), np.repeat(starts, 2) * np.tile([1, 0], len(starts)) + np.tile([0, len(low)], len(starts)),
                         np.stack([lengths, np.ones_like(lengths)], 1).ravel())
    begin, end = at[:-1:2], at[1::2]
    for n in orders:
        last = np.arange(n - 1, len(starts))
        first = last - (n - 1)
        same = rows[first] == rows[last]
        first, last = first[same], last[same]
        yield *_gather(spaced, begin[first], end[last] - begin[first]), rows[first]


def hash_texts(data: np.ndarray, rows: np.ndarray, buckets: int, orders: range) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(words of each text, and per run length the buckets and texts of its features)."""
    low, starts, lengths, owners = _words(data, rows)
    found = [(crc_buckets(d, o, buckets), r) for d, o, r in _features(low, starts, lengths, owners, orders)]
    return np.bincount(owners, minlength=len(rows) - 1), [f[0] for f in found], [f[1] for f in found]


def _long_text(text: np.ndarray, buckets: int, orders: range, piece: int) -> tuple[int, np.ndarray]:
    """(words, buckets) of one text, piece by piece; the last words of a piece begin the next, for runs over the cut."""
    words, out, at, carry = 0, [], 0, np.empty(0, np.uint8)
    keep = orders[-1] - 1
    while at < len(text):
        end = min(at + piece, len(text))
        while end < len(text):  # up to the next byte outside a word
            stop = np.flatnonzero(~IS_WORD[LOWER[text[end : end + piece]]])
            if len(stop):
                end += int(stop[0])
                break
            end = min(end + piece, len(text))
        part = np.concatenate([carry, text[at:end]])
        carried = len(_words(carry, np.array([0, len(carry)]))[1])
        low, starts, lengths, owners = _words(part, np.array([0, len(part)]))
        words += len(starts) - carried
        for n, (data, offsets, _) in zip(orders, _features(low, starts, lengths, owners, orders), strict=True):
            out.append(crc_buckets(data, offsets, buckets)[max(carried - n + 1, 0) :])  # runs of carried words alone are counted
        carry = part[starts[max(len(starts) - keep, 0)] :] if keep and len(starts) else np.empty(0, np.uint8)
        at = end
    return words, np.concatenate(out) if out else np.empty(0, np.uint32)


def _hash_column(column: pa.Array, buckets: int, orders: range, piece: int) -> tuple[list[int], list[bytes]]:
    """(words, little-endian buckets) of every text of a column."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")
    words: list[int] = []
    found: list[bytes] = []
    row = 0
    while row < len(column):
        if at[row + 1] - at[row] > piece:
            n, own = _long_text(data[at[row] : at[row + 1]], buckets, orders, piece)
            words.append(n)
            found.append(own.astype(kind).tobytes())
            row += 1
            continue
        upto = max(int(np.searchsorted(at, at[row] + piece, "right")) - 1, row + 1)
        counts, each, owners = hash_texts(data[at[row] : at[upto]], at[row : upto + 1] - at[row], buckets, orders)
        owner = np.concatenate(owners)
        own = np.concatenate(each)[np.argsort(owner, kind="stable")].astype(kind)
        edges = np.cumsum(np.bincount(owner, minlength=upto - row)) * kind.itemsize
        laid = own.tobytes()
        words += counts.tolist()
        found += [laid[a:b] for a, b in zip([0, *edges[:-1].tolist()], edges.tolist(), strict=True)]
        row = upto
    return words, found


def hashed(rows: DataFrame, id_col: str | None, text_col: str, buckets: int, orders: range, piece: int = PIECE) -> DataFrame:
    """(position, doc_id, n_words, n_features, buckets) of every row, written once."""
    width = 2 if buckets <= 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, found = _hash_column(batch.column(2), buckets, orders, piece)
            sizes = [len(f) // width for f in found]
            columns = [batch.column(0), batch.column(1), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["position", "doc_id", "n_words", "n_features", "buckets"])

    doc_id = F.col(id_col) if id_col else F.lit(None)
    narrow = rows.select(F.monotonically_increasing_id().alias("position"), doc_id.cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialize(narrow.mapInArrow(run, HASHED), "hashed")


def _blobs(batch: pa.RecordBatch, kind: np.dtype) -> list[np.ndarray]:
    return [np.frombuffer(b, kind) for b in batch.column(batch.schema.get_field_index("buckets")).to_pylist()]


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features of every bucket over all rows: one row per task and bucket, then one per bucket."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for own in _blobs(batch, kind):
                total += np.bincount(own, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    counts = rows.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():  # at most ``buckets`` rows
        out[row.bucket] = row.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio) of every bucket."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    ratio = [(t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _weighted(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    kind = np.dtype("<u2") if len(gains) <= 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = pa.array([int(gains[own].sum()) for own in _blobs(batch, kind)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], weights], names=["position", "doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, "position long, doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise), from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _ranked(rows: DataFrame) -> tuple[DataFrame, int]:
    """(rows with their place by falling score and rising id, number of rows): places of range partitions, shifted."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("position")]
    ranged = materialize(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    counts = sorted((r.part, r["count"]) for r in ranged.groupBy("part").count().collect())  # one row per partition
    before, offsets = 0, []
    for part, n in counts:
        offsets.append((part, before))
        before += n
    shifts = ranged.sparkSession.createDataFrame(offsets, "part int, before long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)).cast("long")
    placed = ranged.withColumn("place", place).join(F.broadcast(shifts), "part")  # as many rows as shuffle partitions
    return placed.withColumn("rank", F.col("place") + F.col("before")), before


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    max_run: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs``; ranks of the ``percent`` per cent drawn
    of those with at least ``min_words`` words, null for all others."""
    orders = range(1, max_run + 1)
    source = hashed(docs, doc_id, text, buckets, orders)
    wanted = hashed(target, None, target_text, buckets, orders)
    gains = bucket_gains(bucket_counts(source, buckets), bucket_counts(wanted, buckets))
    scored = materialize(_weighted(source, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scored")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked, n = _ranked(scored.filter(F.col("n_words") >= min_words))
    drawn = F.when(F.col("rank") <= n * percent // 100, F.col("rank")).alias("rank")
    short = scored.filter(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, drawn).unionByName(short)
