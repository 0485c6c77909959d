"""Cross-entropy difference over code units, for small tables of grams (operator 7 itself is ``wordlm``, over words).

Two n-gram models share one vocabulary, the UTF-16 code units of the lower-cased
background texts: the target model is counted on the documents of a target set
(by default those labelled of good quality), the background model on all
documents.  With ``order`` n the loss of a unit after its n - 1 predecessors is

    -log((N(gram) + K * p(unit)) / (N(context) + K)),  p(unit) = (N(unit) + 1) / (N + V)

with the same K and V in both models.  A document's score is its mean target
loss less its mean background loss, per unit: low means like the target.

Counts cover every text whole: tasks combine the grams of an Arrow batch, Spark
adds them up.  Contexts and units are aggregates of that table, joined to it.
The finished table (gram, both losses) goes to every task if it has at most
``BROADCAST_GRAMS`` rows (24 bytes each); beyond that the documents' distinct
grams are joined to it by shuffling.  Both ways give the same scores.

Defined results: texts that are null or empty have no unit, and null losses and
score; a text's first units follow ``order - 1`` start marks (code unit 0);
without any target document the target model is the smoothing alone; labels
repeat without effect; an empty table gives an empty result; extra columns are
ignored; rows that repeat an id are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.llm.common import materialize

ORDER, SMOOTHING = 4, 8.0
BROADCAST_GRAMS = 2_000_000
DIGITS = 9


def grams(text: str | None, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the distinct ``order``-grams: 16 bits per code unit, the last unit lowest."""
    units = np.frombuffer((text or "").lower().encode("utf-16-le", "surrogatepass"), "<u2").astype(np.uint64)
    if not len(units):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    units = np.concatenate([np.zeros(order - 1, np.uint64), units])
    codes = np.zeros(len(units) - order + 1, np.uint64)
    for k in range(order):
        codes = codes << np.uint64(16) | units[k : k + len(codes)]
    return np.unique(codes.view(np.int64), return_counts=True)


def gram_counts(df: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, background, target) of ``df(text, is_target)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, flags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first in range(0, len(texts), 2048):
                found = [grams(t, order) for t in texts[first : first + 2048]]
                codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                n = np.concatenate([c for _, c in found]).astype(np.float64)
                own = np.repeat(np.array(flags[first : first + 2048], np.float64), [len(c) for c, _ in found])
                sums = [np.bincount(at, weights=w, minlength=len(codes)).astype(np.int64) for w in (n, n * own)]
                yield pa.RecordBatch.from_arrays([pa.array(codes), *map(pa.array, sums)], names=["gram", "background", "target"])

    partial = df.mapInArrow(count, "gram long, background long, target long")
    return partial.groupBy("gram").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


def gram_losses(counts: DataFrame, order: int = ORDER, smoothing: float = SMOOTHING) -> DataFrame:
    """(gram, target_loss, background_loss), the two smoothed models."""
    kinds = ("background", "target")
    keyed = counts.withColumn("unit", F.col("gram").bitwiseAND(F.lit(0xFFFF))).withColumn("context", F.shiftrightunsigned("gram", 16))
    sums = lambda by, tag: keyed.groupBy(by).agg(*[F.sum(k).alias(f"{k}_{tag}") for k in kinds])
    units = materialize(sums("unit", "unit"), "units")
    all_units = units.agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"{k}_unit").alias(k) for k in kinds]).first()
    table = keyed.join(units, "unit").join(sums("context", "context"), "context")

    def loss(kind: str):
        p = (F.col(f"{kind}_unit") + 1) / F.lit(float((all_units[kind] or 0) + all_units.v or 1))
        return -F.log((F.col(kind) + smoothing * p) / (F.col(f"{kind}_context") + smoothing))

    return table.select("gram", *[loss(k).alias(f"{k}_loss") for k in reversed(kinds)])


MOST_TARGETS = 2_000_000  # ids (8 bytes each) that may be broadcast


def narrow_ids(ids: DataFrame) -> DataFrame:
    """Distinct ids, written once; broadcast if they are few enough, so that flagging the targets moves no text."""
    ids = materialize(ids, "target-ids")
    return F.broadcast(ids) if ids.count() <= MOST_TARGETS else ids


FIELDS = ("n_units", "loss_target", "loss_background", "score")


def score_documents(
    df: DataFrame,
    target_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    smoothing: float = SMOOTHING,
    broadcast_grams: int = BROADCAST_GRAMS,
    with_text: bool = False,
) -> DataFrame:
    """doc_id, n_units, loss_target, loss_background, score (and text); ``target_ids(id)`` names the target documents."""
    targets = narrow_ids(target_ids.select(F.col("id").alias("t_id")).filter("t_id IS NOT NULL").distinct())
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    flagged = docs.join(targets, docs["id"] == targets["t_id"], "left").select("text", F.col("t_id").isNotNull().alias("is_target"))
    counts = materialize(gram_counts(flagged, order), "gram-counts")
    losses = materialize(gram_losses(counts, order, smoothing), "gram-losses")
    if counts.count() <= broadcast_grams:
        return _scored_by_lookup(docs, losses, order, with_text)
    return _scored_by_join(docs, losses, order, with_text)


def _schema(docs: DataFrame, with_text: bool) -> T.StructType:
    return T.StructType(
        [
            T.StructField("doc_id", docs.schema["id"].dataType),
            T.StructField("n_units", T.LongType()),
            *[T.StructField(name, T.DoubleType()) for name in FIELDS[1:]],
            *[T.StructField("text", T.StringType())] * with_text,
        ]
    )


def _scored_by_lookup(docs: DataFrame, losses: DataFrame, order: int, with_text: bool) -> DataFrame:
    """The size-checked table of losses goes to every task."""
    spark, schema = docs.sparkSession, _schema(docs, with_text)
    rows = losses.orderBy("gram").toArrow()
    table = spark.sparkContext.broadcast([rows.column(c).to_numpy() for c in ("gram", "target_loss", "background_loss")])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, target, background = table.value
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                codes, n = grams(text, order)
                if not len(codes):
                    out.append((0, None, None, None))
                    continue
                at, total = np.searchsorted(known, codes), int(n.sum())
                t, b = float(n @ target[at]) / total, float(n @ background[at]) / total
                out.append((total, round(t, DIGITS), round(b, DIGITS), round(t - b, DIGITS)))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(columns[0], pa.int64()),
                    *[pa.array(c, pa.float64()) for c in columns[1:]],
                    *[batch.column(1)] * with_text,
                ],
                names=schema.names,
            )

    return docs.mapInArrow(score, schema)


def _scored_by_join(docs: DataFrame, losses: DataFrame, order: int, with_text: bool) -> DataFrame:
    """Distinct grams of each document joined to the table of losses."""
    numbered = materialize(docs.withColumn("rid", F.monotonically_increasing_id()), "numbered")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes, n = grams(text, order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rid] * len(codes), pa.int64()), pa.array(codes), pa.array(n.astype(np.int64))], names=["rid", "gram", "n"]
                )

    each = numbered.select("rid", "text").mapInArrow(split, "rid long, gram long, n long").join(losses, "gram")
    mean = lambda c: F.sum(F.col("n") * F.col(c)) / F.sum("n")
    found = each.groupBy("rid").agg(F.sum("n").alias("units"), mean("target_loss").alias("t"), mean("background_loss").alias("b"))
    return numbered.select("rid", "id", *["text"] * with_text).join(found, "rid", "left").select(
        F.col("id").alias("doc_id"),
        F.coalesce("units", F.lit(0)).cast("long").alias("n_units"),
        F.round("t", DIGITS).alias("loss_target"),
        F.round("b", DIGITS).alias("loss_background"),
        F.round(F.col("t") - F.col("b"), DIGITS).alias("score"),
        *["text"] * with_text,
    )
