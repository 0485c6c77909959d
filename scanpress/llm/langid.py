"""Operator 6, language identification by hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs, drawn from its code point.
The letter trigram abc is bound as ``P(P(a)) * P(b) * c`` with P a cyclic shift;
a text is the sum (bundle) of its trigrams' vectors, and a language's prototype
the bundle of all its training texts.  A text is given the language of the
prototype with the largest cosine.

Texts are lower-cased; every run of other characters than letters is one space,
which counts as a letter at word ends.  Bundling is linear, so training counts
trigrams per language (whole texts, all training rows, map-side combine) and
binds each distinct trigram once, in tasks; prototypes are exact integers and
do not depend on the order of rows.  What goes to every task is one vector per
language label.  Texts are scored in batches as they stand, without a shuffle.

Defined results: a null text, or one without letters, is ``und`` with score 0,
and so is any text when nothing was learned; the score is the cosine, 0 if
negative; ties go to the smaller label; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.llm.common import broadcast_ids, materialize, shuffles_released, small_batches

DIM = 1024
TAIL, CEILING = 0.001, 0.2  # floors of the scores of known languages, see score_floors
UNKNOWN = "und"
HELD_ROWS = 1 << 15  # trigram vectors kept per Python worker (DIM bytes each)
_IS_LETTER: list[np.ndarray] = []
_LETTERS: dict[int, np.ndarray] = {}


def _letters() -> np.ndarray:
    if not _IS_LETTER:
        _IS_LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _IS_LETTER[0]


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the text's distinct letter trigrams; three 21-bit code points per code."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    points = np.where(_letters()[points], points, 32) if len(points) else points
    points = np.concatenate([[32], points, [32]])
    points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
    if len(points) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique(points[:-2] << 42 | points[1:-1] << 21 | points[2:], return_counts=True)


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of several (codes, counts), counts added."""
    codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
    counts = np.bincount(at, weights=np.concatenate([n for _, n in found]), minlength=len(codes)).astype(np.int64)
    return codes, counts


def trigram_counts(batch: pa.RecordBatch) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Language label -> (codes, counts) over a batch of (text, label); trigrams of single texts are held for 256 at a time."""
    held: dict[str, list] = {}
    for first in range(0, batch.num_rows, 256):
        some, found = batch.slice(first, 256), {}
        for text, lang in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
            found.setdefault(lang, []).append(trigrams(text))
        for lang, own in found.items():
            held.setdefault(lang, []).append(_summed(own))
    return {lang: _summed(own) for lang, own in held.items()}


def letter_vector(point: int, dim: int) -> np.ndarray:
    key = point * 65536 + dim
    if key not in _LETTERS:
        _LETTERS[key] = (np.random.default_rng([point, dim]).integers(0, 2, dim, np.int8) * 2 - 1).astype(np.int8)
    return _LETTERS[key]


def bound_vectors(codes: np.ndarray, dim: int) -> np.ndarray:
    """One int8 row of signs per trigram code."""
    out = np.ones((len(codes), dim), np.int8)
    for shift, bits in ((2, 42), (1, 21), (0, 0)):
        points, at = np.unique(codes >> bits & 0x1FFFFF, return_inverse=True)
        out *= np.stack([np.roll(letter_vector(int(p), dim), shift) for p in points])[at] if len(points) else 1
    return out


class _Vectors:
    """Trigram vectors by code, at most ``HELD_ROWS`` kept."""

    def __init__(self, dim: int) -> None:
        self.dim, self.codes, self.rows = dim, np.empty(0, np.int64), np.empty((0, dim), np.int8)

    def of(self, codes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.codes, codes)
        known = np.zeros(len(codes), bool)
        inside = at < len(self.codes)
        known[inside] = self.codes[at[inside]] == codes[inside]
        return self.rows[at] if known.all() else self._with(codes, known)

    def _with(self, codes: np.ndarray, known: np.ndarray) -> np.ndarray:
        new = codes[~known]
        if len(self.codes) + len(new) > HELD_ROWS:
            return bound_vectors(codes, self.dim)
        self.codes = np.concatenate([self.codes, new])
        self.rows = np.concatenate([self.rows, bound_vectors(new, self.dim)])
        order = np.argsort(self.codes)
        self.codes, self.rows = self.codes[order], self.rows[order]
        return self.rows[np.searchsorted(self.codes, codes)]

    def learn(self, codes: np.ndarray) -> None:
        """Take in the codes of many texts at once."""
        missing = codes[~np.isin(codes, self.codes)]
        if len(missing) and len(self.codes) + len(missing) <= HELD_ROWS:
            self._with(missing, np.zeros(len(missing), bool))


_HELD: dict[int, _Vectors] = {}


def train_prototypes(df: DataFrame, text_col: str, lang_col: str, dim: int = DIM) -> dict[str, np.ndarray]:
    """Language label -> integer prototype (one vector per distinct label)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, (codes, counts) in trigram_counts(batch).items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], names=["lang", "code", "n"]
                )

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            codes, counts = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            for at in range(0, len(codes), 4096):
                part = slice(at, at + 4096)
                vectors = bound_vectors(codes[part], dim).astype(np.int64)
                for lang in set(langs[part]):
                    own = langs[part] == lang
                    sums[lang] = sums.get(lang, 0) + counts[part][own] @ vectors[own]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.int64()))], names=["lang", "v"]
        )

    rows = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, F.col(lang_col).cast("string"))
    grams = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    sums = grams.mapInArrow(bundle, "lang string, v array<long>").select("lang", F.posexplode("v").alias("i", "x"))
    sums = sums.groupBy("lang", "i").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
    return {r.lang: np.array([c.x for c in r.v], np.float64) for r in sums.orderBy("lang").collect()}


def identify(df: DataFrame, text_col: str, prototypes: dict[str, np.ndarray], dim: int = DIM) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``."""
    langs = sorted(prototypes)
    matrix = np.array([prototypes[x] / max(np.linalg.norm(prototypes[x]), 1e-300) for x in langs], np.float32)
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*df.schema.fields, *fields])
    at_text = df.columns.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _HELD.setdefault(dim, _Vectors(dim))
        for batch in batches:
            preds, scores = [], []
            for first in range(0, batch.num_rows, 256):
                found = [trigrams(t) for t in batch.column(at_text).slice(first, 256).to_pylist()]
                vectors.learn(np.unique(np.concatenate([c for c, _ in found])))
                for codes, counts in found:
                    if not len(codes) or not langs:
                        preds.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    own = np.zeros(dim, np.float32)
                    for a in range(0, len(codes), 4096):
                        own += counts[a : a + 4096].astype(np.float32) @ vectors.of(codes[a : a + 4096]).astype(np.float32)
                    cosines = matrix @ own / max(float(np.linalg.norm(own)), 1e-30)
                    best = int(cosines.argmax())
                    preds.append(langs[best])
                    scores.append(float(min(max(cosines[best], 0.0), 1.0)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=schema.names
            )

    return df.mapInArrow(predict, schema)


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3 (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3))


def identify_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from rows outside fold 1, predicted for all."""
    prototypes = train_prototypes(df.filter(fold(id_col) != 1), text_col, lang_col, dim)
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(fold(id_col) == 1, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return identify(rows, "text", prototypes, dim).drop("text")


def score_floors(scored: DataFrame, training: Column, tail: float = TAIL, ceiling: float = CEILING) -> dict[int, float]:
    """size -> least score of a known language: half the ``tail`` quantile of the training rows' scores, at most ``ceiling``.

    Sizes are powers of two of the letters (one row each, under 32); a size without training rows has no floor.
    """
    own = scored.filter(training & (F.col("__lang_pred") != UNKNOWN)).groupBy("__lang_size")
    rows = own.agg(F.percentile_approx("__lang_score", F.lit(tail), F.lit(100_000)).alias("low")).collect()
    return {r["__lang_size"]: min(r.low / 2, ceiling) for r in rows}


def drop_unidentified(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", tail: float = TAIL, ceiling: float = CEILING, dim: int = DIM
) -> DataFrame:
    """The rows whose language is known, all columns kept.

    A row goes if no letter is in its text (``und``) or its score lies below the floor of its size (:func:`score_floors`):
    short texts score low in any language, so floors are learned per size.  ``tail`` and the halving are set so that a
    clean text of a learned language stays.  Rows are scored once; what is written are their scores, without the texts.
    Rows go by id and hash of the text, of which the score is a function: ids may repeat or be null.  Without training
    rows (an empty table) nothing is known and nothing stays.
    """
    spark = df.sparkSession
    with small_batches(spark), shuffles_released(spark):  # training and scoring are run and written in here
        scored = _scored(df, id_col, text_col, lang_col, dim)
        floors = score_floors(scored, F.col("__lang_known"), tail, ceiling)
        least = F.lit(0.0)
        for size, low in floors.items():
            least = F.when(F.col("__lang_size") == size, F.lit(low)).otherwise(least)
        kept = (F.col("__lang_pred") != UNKNOWN) & (F.col("__lang_score") >= least)
        gone = broadcast_ids(scored.filter(~kept).select("__lang_id", "__lang_text"))
    on = df[id_col].eqNullSafe(gone["__lang_id"]) & F.xxhash64(df[text_col]).eqNullSafe(gone["__lang_text"])
    return df.join(gone, on, "left_anti")


def _scored(df: DataFrame, id_col: str, text_col: str, lang_col: str, dim: int) -> DataFrame:
    """``__lang_id``, ``__lang_text`` (its hash), ``__lang_known`` (a training row), ``__lang_pred``, ``__lang_score`` and
    ``__lang_size`` of every row, written once."""
    prototypes = train_prototypes(df.filter(fold(id_col) != 1), text_col, lang_col, dim)
    known = F.coalesce(fold(id_col) != 1, F.lit(False)) & F.col(lang_col).isNotNull()
    letters = F.regexp_count(text_col, F.lit(r"\p{L}"))
    rows = df.select(
        F.col(id_col).alias("__lang_id"),
        F.xxhash64(text_col).alias("__lang_text"),
        known.alias("__lang_known"),
        F.length(F.bin(F.coalesce(letters, F.lit(0)))).alias("__lang_size"),
        F.col(text_col).alias("__lang_of"),
    )
    marks = {"lang_pred": "__lang_pred", "score": "__lang_score"}
    return materialize(identify(rows, "__lang_of", prototypes, dim).drop("__lang_of").withColumnsRenamed(marks), "scored")
