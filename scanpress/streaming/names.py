"""Article names as keyed state (ST-1 with JN-3): what a micro-batch reads grows with the batch, not with its history.

Names that can meet form a family: all bases that are equal without trailing counters (``p_x``, ``p_x_1``, ``p_x_1_2``).
The state of a family is, for each base, how many counters are taken from 0 on without a gap (a new article always takes
the smallest free one), and the names that were there before the stream and leave gaps.  A batch loads the families of
its own articles from the state store (RocksDB, on the executors' disks and in the checkpoint), names their articles as
the batch job does, and writes those families back.

A family's articles of one micro-batch are held by one task, so ``max_files_per_trigger`` bounds what a task holds.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNTERS = r"(_[1-9][0-9]*)+$"
_LAST_COUNTER = re.compile(r"(.*)_([1-9][0-9]*)", re.DOTALL)
STATE = T.StructType([T.StructField("names", T.StringType())])


def family(base: Column) -> Column:
    """A base without its trailing counters."""
    return F.regexp_replace(base, COUNTERS, "")


class Family:
    """The taken names of one family, as what follows the family's own name."""

    def __init__(self, saved: str | None = None) -> None:
        held = json.loads(saved) if saved else {"next": {}, "others": []}
        self.next: dict[str, int] = held["next"]
        self.others: set[str] = set(held["others"])

    def save(self) -> str:
        return json.dumps({"next": self.next, "others": sorted(self.others)})

    def take(self, tail: str) -> None:
        """A name written by someone else."""
        self.others.add(tail)

    def taken(self, tail: str) -> bool:
        if tail in self.others or self.next.get(tail, 0) > 0:
            return True
        read = _LAST_COUNTER.fullmatch(tail)
        return read is not None and self.next.get(read[1], 0) > int(read[2])

    def assign(self, tails: list[str]) -> list[int]:
        """The counter of each article, given by its base; every base comes to its plain name before repeats are numbered."""
        plain = {tail for tail in tails if not self.next.get(tail) and not self.taken(tail)}
        for tail in tails:
            self.next.setdefault(tail, 1)
        counters = []
        for tail in tails:
            if tail in plain:
                plain.discard(tail)
                counters.append(0)
                continue
            at = self.next[tail]
            while self.taken(f"{tail}_{at}"):
                at += 1
            self.next[tail] = at + 1
            counters.append(at)
        return counters


def with_names(articles: DataFrame, seed: DataFrame, order: tuple[str, ...] = ("ordinal", "model", "attempt")) -> DataFrame:
    """Add ``file_name`` to a stream of articles (``page_id``, ``slug``); ``seed.file_name`` are names taken before it."""
    base = F.concat("page_id", F.lit("_"), F.col("slug"))
    # Python takes time by family and column, so the texts that naming does not read go through it as one.
    texts = [f.name for f in articles.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in order]
    packed = articles.select(*[c for c in articles.columns if c not in texts], F.array(*texts).alias("_texts"), base.alias("_base"))
    fields = [f for f in packed.schema.fields if f.name != "_base"]
    out = T.StructType([*fields, T.StructField("file_name", T.StringType())])
    columns, whole = [f.name for f in fields], [f.name for f in fields if isinstance(f.dataType, (T.IntegerType, T.LongType))]
    rows = packed.withColumn("_taken", F.lit(None).cast("string"))
    taken = seed.filter(F.col("file_name").endswith(".html")).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields],
        F.lit(None).cast("string").alias("_base"),
        F.expr("left(file_name, length(file_name) - 5)").alias("_taken"),
    )
    keyed = rows.unionByName(taken).withColumn("_family", family(F.coalesce("_base", "_taken")))

    def name(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        # Most families of a batch hold an article or two: every step on a frame that they need not take is left out.
        parts = list(frames)
        group = parts[0] if len(parts) == 1 else pd.concat(parts)
        taken = group["_taken"].tolist()
        new, others = group, [t for t in taken if t is not None]
        if others:
            new = group[group["_taken"].isna()]
        if len(new) > 1:
            new = new.sort_values(["_base", *order], kind="stable")
        bases = new["_base"].tolist()
        file_names = [None] * len(bases)
        if key[0] is not None:
            names = Family(state.get[0] if state.exists else None)
            for other in others:
                names.take(other[len(key[0]) :])
            counters = names.assign([b[len(key[0]) :] for b in bases])
            file_names = [f"{b}_{c}.html" if c else f"{b}.html" for b, c in zip(bases, counters, strict=True)]
            state.update((names.save(),))
        if bases:
            held = {c: new[c].astype("Int64") if c in whole else new[c] for c in columns}
            yield pd.DataFrame({**held, "file_name": pd.Series(file_names, index=new.index, dtype=object)})

    named = keyed.groupBy("_family").applyInPandasWithState(name, out, STATE, "append", "NoTimeout")
    unpacked = {c: F.get("_texts", F.lit(i)).alias(c) for i, c in enumerate(texts)}
    return named.select(*[unpacked.get(c, F.col(c)) for c in articles.columns], "file_name")
