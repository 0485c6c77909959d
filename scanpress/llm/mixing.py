"""Operator 9, mixing sources by temperature.

A source with share p of all tokens gets the weight ``p**a / sum(p**a)``.  The
exponent a in [0, 1] is found by sectioning: the smallest (most even mix)
whose most repeated source stays within ``max_repeats`` passes, or the one
whose mix has the entropy ``target_entropy`` (nats).  Each step evaluates a few
exponents in one aggregate over the table of sources, so sources are never
collected, however many.

Without ``budget`` the mix is as large as it must be for every source to be
taken whole at least once; with it, sources get their weight of that many
tokens.  A source's tokens are laid out in passes.  In every pass its documents
are permuted in blocks: a hash puts about ``BLOCK`` documents in a block, blocks
are ordered by a hash of (block, pass) and documents inside by one of (document,
pass).  A document is taken while its first token is inside the source's
budget, so a source misses its budget by less than one document.  Running
totals are taken per block and over blocks, so a source with most of the rows
is many tasks; only narrow rows are shuffled.

``position`` is the place of a document in its source's budget, 0 to 1; rows in
its order draw from all sources in proportion to the weights at every point.

Defined results: a null source is a source; null texts have no token; sources
without any token are taken once; rows equal in id, source and text are taken
together; an empty table gives an empty result; extra columns are ignored by
:func:`mix` and carried by :func:`mixed_rows`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanpress.llm.common import materialize
from scanpress.llm.packing import word_count

BLOCK = 2048
MAX_REPEATS = 2.0
SECTIONS, ROUNDS = 16, 8
CLOSE = 1e-9


@dataclass(frozen=True)
class Mix:
    """Exponent found, its normaliser, and the tokens of the whole mix."""

    exponent: float
    normaliser: float
    tokens: float


def _measures(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float, float, float]]:
    """Per exponent: normaliser, entropy, least and largest ratio of weight to share."""
    p = F.col("p")
    parts = []
    for k, a in enumerate(exponents):
        w = F.pow(p, F.lit(a))
        parts += [F.sum(w).alias(f"z{k}"), F.sum(w * F.log(p)).alias(f"l{k}")]
    row = sources.filter("p > 0").agg(*parts, F.min("p").alias("low"), F.max("p").alias("high")).first()
    out = []
    for k, a in enumerate(exponents):
        z = row[f"z{k}"]
        out.append((z, math.log(z) - a * row[f"l{k}"] / z, row.high ** (a - 1) / z, row.low ** (a - 1) / z))
    return out


def solve(sources: DataFrame, total: float, budget: float | None, max_repeats: float | None, target_entropy: float | None) -> Mix:
    """The exponent for a table of sources with shares ``p``."""

    def fits(measure: tuple[float, float, float, float]) -> bool:
        _, entropy, least, most = measure
        size = 1 / least if budget is None else budget / total
        return (max_repeats is None or most * size <= max_repeats + CLOSE) and (target_entropy is None or entropy <= target_entropy + CLOSE)

    low, high = 0.0, 1.0
    if fits(_measures(sources, [0.0])[0]):
        high = 0.0
    elif not fits(_measures(sources, [1.0])[0]):
        msg = "even the sources' own shares miss the target: raise the limit or lower the budget"
        raise ValueError(msg)
    else:
        for _ in range(ROUNDS):
            steps = [low + (high - low) * k / SECTIONS for k in range(1, SECTIONS + 1)]
            at = next(k for k, m in enumerate(_measures(sources, steps)) if k == SECTIONS - 1 or fits(m))
            low, high = (steps[at - 1] if at else low), steps[at]
    z, _, least, _ = _measures(sources, [high])[0]
    return Mix(high, z, total / least if budget is None else budget)


def _narrow(df: DataFrame, id_col: str, source_col: str, text_col: str, n_tokens: Column | None) -> DataFrame:
    n = word_count(F.col(text_col)) if n_tokens is None else n_tokens
    rows = df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("text"), n.cast("long").alias("n")
    )
    return materialize(rows.groupBy("id", "source", "text").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("copies")), "mix-rows")


def mix_sources(rows: DataFrame, budget: float | None, max_repeats: float | None, target_entropy: float | None) -> DataFrame | None:
    """source, tokens, docs, weight, budget, passes (real number) per source; None for an empty table."""
    sources = rows.groupBy("source").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    sources = materialize(sources, "sources")
    total = sources.agg(F.sum("tokens").alias("t")).first().t
    if total is None:
        return None
    sources = sources.withColumn("p", F.col("tokens") / F.lit(float(max(total, 1))))
    found = solve(sources, float(total), budget, max_repeats, target_entropy) if total else Mix(1.0, 1.0, 0.0)
    weight = F.when(F.col("p") > 0, F.pow("p", F.lit(found.exponent)) / found.normaliser).otherwise(0.0)
    sources = sources.withColumn("weight", weight).withColumn("budget", F.col("weight") * found.tokens)
    passes = F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens")).otherwise(1.0)
    whole = F.round(passes)
    return sources.withColumn("passes", F.when(F.abs(passes - whole) < 1e-6, whole).otherwise(passes)).drop("p")


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    n_tokens: Column | None = None,
    budget: float | None = None,
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    block: int = BLOCK,
    seed: int = 11,
) -> DataFrame:
    """One row per document and pass it is taken in: doc_id, source, pass, n_tokens, weight, position."""
    rows = _narrow(df, id_col, source_col, text_col, n_tokens)
    return _laid_out(rows, budget, max_repeats, target_entropy, block, seed).select(
        F.col("id").alias("doc_id"), "source", "pass", F.col("n").alias("n_tokens"), "weight", "position"
    )


def _laid_out(rows: DataFrame, budget, max_repeats, target_entropy, block: int, seed: int) -> DataFrame:
    sources = mix_sources(rows, budget, max_repeats, target_entropy)
    if sources is None:
        empty = rows.filter(F.lit(False))
        return empty.select("*", F.lit(0).alias("pass"), F.lit(0.0).alias("weight"), F.lit(0.0).alias("position"))
    sources = materialize(sources, "mix").withColumnRenamed("source", "of")
    laid = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    blocks = F.greatest(F.ceil(F.col("docs") / F.lit(block)), F.lit(1)).cast("long")
    laid = laid.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "id", "text"), blocks))
    last = F.greatest(F.ceil("passes") - 1, F.lit(0)).cast("int")
    laid = materialize(laid.withColumn("pass", F.explode(F.sequence(F.lit(0), last))), "passes")

    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    start = lambda n, w: F.coalesce(F.sum(n).over(upto(w)), F.lit(0))
    order = Window.partitionBy("source", "pass").orderBy(F.xxhash64(F.lit(seed), "block", "pass"), "block")
    heads = laid.groupBy("source", "pass", "block").agg(F.sum("n").alias("size")).withColumn("head", start("size", order))
    heads = heads.select(F.col("source").alias("of"), F.col("pass").alias("in"), F.col("block").alias("at"), "head")
    inside = Window.partitionBy("source", "pass", "block").orderBy(F.xxhash64(F.lit(seed), "id", "text", "pass"), "id", "text")
    laid = laid.withColumn("inside", start("n", inside))
    on = F.col("source").eqNullSafe(F.col("of")) & (F.col("pass") == F.col("in")) & (F.col("block") == F.col("at"))
    laid = laid.join(heads, on).withColumn("first", F.col("head") + F.col("inside"))
    taken = (F.col("pass") < F.floor("passes")) | (F.col("first") < (F.col("passes") - F.floor("passes")) * F.col("tokens"))
    span = F.col("passes") * F.col("tokens")
    position = F.when(span > 0, F.least((F.col("pass") * F.col("tokens") + F.col("first")) / span, F.lit(1.0))).otherwise(0.0)
    return laid.filter(taken).withColumn("position", position)


def mixed_rows(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    budget: float | None = None,
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    block: int = BLOCK,
    seed: int = 11,
) -> DataFrame:
    """The rows of ``df``, each as often as it is taken, with all columns."""
    rows = _narrow(df, id_col, source_col, text_col, None)
    laid = _laid_out(rows, budget, max_repeats, target_entropy, block, seed)
    times = laid.groupBy("id", "source", "text").agg(F.count(F.lit(1)).cast("int").alias("__mix_times"))
    times = times.select(F.col("id").alias("__mix_id"), F.col("source").alias("__mix_of"), F.col("text").alias("__mix_to"), "__mix_times")
    whole = df.withColumn("__mix_text", F.xxhash64(text_col))
    on = (
        whole[id_col].eqNullSafe(times["__mix_id"])
        & whole[source_col].eqNullSafe(times["__mix_of"])
        & (whole["__mix_text"] == times["__mix_to"])
    )
    repeated = whole.join(times, on).withColumn("__mix_pass", F.explode(F.sequence(F.lit(1), F.col("__mix_times"))))
    return repeated.select(*df.columns)
