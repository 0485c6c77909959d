"""Unique article names (WN-1) and names that avoid files already written (JN-3).

An article is written as ``<stem>_<slug>.html``; a repeat of the same stem and
slug gets ``_1``, ``_2``, ... in article order, skipping names that are taken.
Taken are the names already written and the plain names of all bases: the base
``p_x_1`` owns ``p_x_1.html``, so a repeat of ``p_x`` goes on with ``_2``.

The articles are evaluated once and written as a table; every later step reads
only the columns it needs of it.  One aggregate finds the bases that repeat (if
none does, every name is plain and nothing else runs).  Only the keys of those
are numbered (base and order, written as a narrow table); what is joined back to
the articles is the short table of suffixes, which AQE broadcasts while it is
small.  Beyond that, the join shuffles on base and order together, so a group
that holds much of the table stays spread out, and bodies move at most once.

Rows that tie in base and order are told apart by a window, only if there are any.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.operators.ranking import HOT_ROWS, materialize, plain_running_sum, running_sum_within


def _suffix(counter: Column) -> Column:
    return F.when(counter > 0, F.concat(F.lit("_"), counter.cast("string"))).otherwise(F.lit(""))


def article_base(stem: Column | str = "page_id", slug: Column | str = "slug") -> Column:
    stem = F.col(stem) if isinstance(stem, str) else stem
    slug = F.col(slug) if isinstance(slug, str) else slug
    return F.concat(stem, F.lit("_"), slug)


def _numbered(names: DataFrame, name: str = "file_name") -> DataFrame:
    """(base, counter) of names read as ``<base>_<counter>.html``."""
    n, pattern = F.col(name), r"^(.*)_([1-9][0-9]*)\.html$"
    rows = names.filter(n.rlike(pattern)).select(
        F.regexp_extract(n, pattern, 1).alias("base"),
        F.regexp_extract(n, pattern, 2).try_cast("long").alias("counter"),
    )
    return rows.filter(F.col("counter").isNotNull())


def used_counters(existing: DataFrame, name: str = "file_name") -> DataFrame:
    """(base, counter) pairs a written name occupies.

    ``X_3.html`` is counter 3 of ``X`` or counter 0 of ``X_3``; both readings
    are kept, so the join with new bases is exact.
    """
    n, pattern = F.col(name), r"^(.*)\.html$"
    as_plain = existing.filter(n.rlike(pattern)).select(
        F.regexp_extract(n, pattern, 1).alias("base"), F.lit(0).cast("long").alias("counter")
    )
    return _numbered(existing, name).unionByName(as_plain).distinct()


def _suffixes(
    staged: DataFrame, bases: DataFrame, existing: DataFrame | None, order: tuple[str, ...], hot_rows: int
) -> tuple[DataFrame, bool]:
    """(base, order, tie, counter) of the articles whose counter is not 0, and whether any rows tie.

    The r-th new article of a base takes the r-th free counter.  With used
    counters u_1 < u_2 < ..., the number of free counters below u_i is
    ``g_i = u_i - (i - 1)``, so the r-th free counter is
    ``r - 1 + #{i : g_i <= r - 1}`` - a running count over the union of new
    and used rows of one base, ordered by that key.
    """
    used = _numbered(bases.select(F.concat("_base", F.lit(".html")).alias("file_name")))
    repeats = bases.filter("_rows > 1").select("_base")
    if existing is not None:
        used = used.unionByName(used_counters(existing)).distinct()
    used = used.withColumnRenamed("base", "_base")
    if existing is not None:
        used = materialize(used.join(bases.select("_base"), "_base", "left_semi"), "used-names")
        repeats = repeats.unionByName(used.filter("counter = 0").select("_base")).distinct()
    # Only bases that need a counter are numbered; their keys are a narrow table of their own.
    own = staged.select("_base", *order).join(repeats, "_base", "left_semi")
    keys = materialize(own.groupBy("_base", *order).agg(F.count(F.lit(1)).alias("_n")), "name-keys")
    total, most = keys.agg(F.sum("_n"), F.max("_n")).first()
    used = used.join(keys.select("_base").distinct(), "_base", "left_semi")
    bound = 2 * (total or 0) + (used.count() if existing is not None else 0)

    def number(df: DataFrame, by: list[str], value: Column, name: str) -> DataFrame:
        if bound <= hot_rows:
            return plain_running_sum(df, ["_base"], by, value, name)
        return running_sum_within(df, ["_base"], by, value, name, hot_rows=hot_rows)

    ties = F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_tie")
    new = number(keys.select("_base", *order, ties), [*order, "_tie"], F.lit(1), "_r")
    used = number(used, ["counter"], F.lit(1), "_i").select(
        "_base", (F.col("counter") - F.col("_i") + 1).alias("_key"), F.lit(0).alias("_is_new")
    )
    both = new.withColumn("_key", F.col("_r") - 1).withColumn("_is_new", F.lit(1)).unionByName(used, allowMissingColumns=True)
    shifted = number(both, ["_key", "_is_new"], 1 - F.col("_is_new"), "_shift").filter("_is_new = 1")
    counted = shifted.withColumn("_counter", F.col("_r") - 1 + F.col("_shift")).filter("_counter > 0")
    return counted.select("_base", *order, "_tie", "_counter"), (most or 0) > 1


def name_offset(
    articles: DataFrame,
    existing: DataFrame | None,
    stem: str = "page_id",
    slug: str = "slug",
    order: tuple[str, ...] = ("ordinal",),
    out: str = "file_name",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """JN-3: like :func:`unique_names`, but names already written (``existing.file_name``) also count as taken."""
    plain_name = F.concat(F.col("_base"), F.lit(".html"))
    staged = materialize(articles.withColumn("_base", article_base(stem, slug)), "staged-articles")
    bases = staged.filter(F.col("_base").isNotNull()).groupBy("_base").agg(F.count(F.lit(1)).alias("_rows"))
    if existing is None and not bases.filter("_rows > 1").limit(1).count():
        return staged.withColumn(out, plain_name).drop("_base")
    suffixes, tied = _suffixes(staged, bases, existing, order, hot_rows)
    on, rows = ["_base", *order], staged
    if tied:
        plain = [f.name for f in articles.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        rows = rows.withColumn("_tie", F.row_number().over(Window.partitionBy(*on).orderBy(F.xxhash64(*plain))))
        on.append("_tie")
    suffixes = suffixes.select(*[F.col(c).alias(f"_s_{c}") for c in on], "_counter")
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in on])
    named = rows.join(suffixes, cond, "left")
    counter = F.coalesce("_counter", F.lit(0))
    named = named.withColumn(out, F.concat(F.col("_base"), _suffix(counter), F.lit(".html")))
    return named.drop("_base", "_tie", "_counter", *[f"_s_{c}" for c in on])


def unique_names(
    articles: DataFrame,
    stem: str = "page_id",
    slug: str = "slug",
    order: tuple[str, ...] = ("ordinal",),
    out: str = "file_name",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """WN-1: ``<stem>_<slug>[_<n>].html`` with n counting repeats of (stem, slug) in ``order``."""
    return name_offset(articles, None, stem, slug, order, out, hot_rows)
