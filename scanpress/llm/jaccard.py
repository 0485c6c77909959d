"""Operator 4, exact n-gram Jaccard join with signature trees.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a document's
set holds its distinct ``n``-word shingles (with fewer words, the whole
sequence as one), as 64-bit hashes.  Two documents link when
``100 * intersection >= percent * union``.  The result has the connected
components of those links, without listing the pairs inside dense groups.

Plan (every statistic covers all rows; nothing is sampled or capped):

1. *Order.*  A fixed-size table of hashed shingle counts puts common shingles
   last in one global order (any order is exact, this one is fast).
2. *Prefixes.*  Linked documents share a shingle among the first
   ``size - ceil(t * size) + 1`` of each.  Copies with equal sets are reduced to
   one; prefixes are shuffled by shingle and only shingles of two or more
   documents are kept.  From here on bitmaps (2 to 4 bits per shingle) travel,
   not sets: units propose pairs, and the sets of the documents in proposed
   pairs alone, written once at the start, are read again to decide them.
3. *Stars.*  Documents sharing their smallest such shingle form units of at
   most ``UNIT`` documents; inside, each becomes a centre or is proposed to the
   most similar centre; verified members have a known Jaccard distance to it.
   Centres meet again by two other shared shingles, which joins most stars of
   one large group of copies; the components so far are labelled.
4. *Centres.*  Per shingle only the distinct stars remain, and only where they
   are of several components.  Signature trees
   (:mod:`scanpress.llm.sigtree`) and a dual traversal find the pairs of centres
   that link, or that are near enough for members to link: Jaccard distance is
   a metric, so members link only if the centres are within
   ``1 - t + radius + radius``.  Larger groups are cut in slices, and every pair
   of slices is one unit, so no task holds more than ``UNIT`` sets.
5. *Members.*  Documents of near stars in different components first meet by
   two more shared shingles, each proposing its most similar partner; pairs of
   stars that are still apart are decided on those members the triangle
   inequality leaves.
6. Components of the links, by alternating stars.

Defined results: null and blank texts have no shingle and link with nothing;
equal texts are one component, repeated rows too; ids may repeat or be null (a
component's id is its smallest non-null id); an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.llm.common import BROADCAST_ROWS, broadcast_ids, materialize, scratch_released, shuffles_released, small_batches
from scanpress.llm.components import connected_components
from scanpress.llm.sigtree import SignatureTree, by_width, folded, jaccard_parts, signature

WORDS, PERCENT = 5, 80
UNIT = 1024
SMALL_GROUP = 64
SLOT_BITS, CHUNKS = 20, 64
TEXT_BYTES, WORDS_HELD = 1 << 20, 1 << 17  # per Python worker: text split at once, hashes of words kept
EPS = 1e-9
PAIRS = "u long, v long"


@dataclass
class _Corpus:
    """The sets (rid, set) and their bitmaps (rid, size, sig)."""

    sets: DataFrame
    signatures: DataFrame


# ---------------------------------------------------------------- shingles


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORDS_HELD:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingle_set(text: bytes | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``n``-word shingles."""
    return next(shingle_sets([text], n))


def shingle_sets(texts: list[bytes | None], n: int = WORDS) -> Iterator[np.ndarray]:
    """:func:`shingle_set` of every text, the words of many texts hashed and combined in one go."""
    first = 0
    while first < len(texts):
        last, held = first, 0
        while last < len(texts) and (held <= TEXT_BYTES or last == first):
            held += len(texts[last] or b"")
            last += 1
        words = [(t or b"").lower().split() for t in texts[first:last]]
        lengths = list(map(len, words))
        hashed = np.fromiter(map(_HASHES.__getitem__, chain.from_iterable(words)), np.uint64, sum(lengths))
        every, at = _combined(hashed, n), 0
        for length in lengths:
            own = every[at : at + length - n + 1] if length >= n else _combined(hashed[at : at + length], length)
            yield np.unique(own)
            at += length
        first = last


def _combined(hashed: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    if not n or len(hashed) < n:
        return np.empty(0, np.uint64)
    factor, out = 0x9E3779B97F4A7C15, np.full(len(hashed) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = (out ^ hashed[k : k + len(out)]) * np.uint64(factor + 2 * k)
            out ^= out >> np.uint64(29)
    return out


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def _as_sets(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """The column's sets, as views of its memory."""
    return [np.frombuffer(b.as_buffer(), "<u8") for b in column]


# ---------------------------------------------------------------- order, prefixes, sets


def _levels(sets: DataFrame) -> np.ndarray:
    """Rank class per hash slot: 0 for ordinary slots, rising with the logarithm of an outstanding count."""
    slots, per_chunk = 1 << SLOT_BITS, (1 << SLOT_BITS) // CHUNKS

    def emit(counts: dict[int, np.ndarray] | np.ndarray) -> pa.RecordBatch:
        parts = counts if isinstance(counts, dict) else dict(enumerate(counts.reshape(CHUNKS, per_chunk)))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(parts), pa.int32()), pa.array([p.astype("<u4").tobytes() for p in parts.values()], pa.binary())],
            names=["chunk", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for batch in (b.slice(k, 1000) for b in batches for k in range(0, b.num_rows, 1000)):
            own = np.concatenate(_as_sets(batch.column(0)))
            total += np.bincount((own >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=slots)
        yield emit(total.clip(max=np.iinfo(np.uint32).max))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(counts, "<u4").astype(np.int64)
                held[chunk] = held[chunk] + part if chunk in held else part
        yield emit({c: p.clip(max=np.iinfo(np.uint32).max) for c, p in held.items()})

    schema = "chunk int, counts binary"
    summed = sets.mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema)
    total = np.zeros(slots, np.int64)
    for row in summed.collect():  # the fixed-size table: CHUNKS rows
        total[row.chunk * per_chunk : (row.chunk + 1) * per_chunk] += np.frombuffer(row["counts"], "<u4")
    usual = max(2.0, 4 * total.mean())
    return np.floor(np.log2(1 + total / usual)).clip(0, 60).astype(np.uint8)


def _sets(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """doc_id, text_hash, set (its hashes), rid of every row, written once: every later step reads sets, never a text."""
    schema = T.StructType([df.schema[id_col], T.StructField("text_hash", T.LongType()), T.StructField("set", T.BinaryType())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                some = batch.slice(k, 500)
                data = [own.tobytes() for own in shingle_sets(some.column(2).to_pylist(), n)]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(data, pa.binary())], names=schema.names)

    rows = df.select(F.col(id_col), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("text"))
    split_rows = rows.mapInArrow(split, schema).withColumnRenamed(id_col, "doc_id")
    return materialize(split_rows.withColumn("rid", F.monotonically_increasing_id()), "sets")


def _signed(sets: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, rid, size, set_hash (null if empty), sig, keys (the prefix) of every row."""
    levels = sets.sparkSession.sparkContext.broadcast(_levels(sets.select("set")))
    schema = T.StructType(
        [
            *[sets.schema[c] for c in ("doc_id", "text_hash", "rid")],
            T.StructField("size", T.IntegerType()),
            T.StructField("set_hash", T.BinaryType()),
            T.StructField("sig", T.BinaryType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
        ]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        level = levels.value
        for batch in batches:
            sizes, hashes, sigs, keys = [], [], [], []
            for own in _as_sets(batch.column(3)):
                sizes.append(len(own))
                hashes.append(xxhash.xxh3_128_digest(own) if len(own) else None)
                sigs.append(signature(own) if len(own) else None)
                p = prefix_length(len(own), percent)
                rank = level[(own >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.uint64)
                order = (rank << np.uint64(58)) | (own >> np.uint64(6))
                first = np.argpartition(order, p - 1)[:p] if 0 < p < len(own) else slice(None)
                keys.append(own[first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(sizes, pa.int32()),
                    pa.array(hashes, pa.binary()),
                    pa.array(sigs, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return materialize(sets.select("doc_id", "text_hash", "rid", "set").mapInArrow(sign, schema), "signed")


def _narrow(df: DataFrame) -> DataFrame:
    """A written table of ids, broadcast if it has at most ``BROADCAST_ROWS`` rows, else joined by shuffling."""
    return broadcast_ids(df, BROADCAST_ROWS)


def _sent(corpus: _Corpus, places: DataFrame) -> DataFrame:
    """(rid, set, unit, head): the set of every document of ``places(rid, unit, head)``, in its units."""
    flat = materialize(places.select("rid", "unit", "head").distinct(), "places")
    return corpus.sets.join(_narrow(flat), "rid").select("rid", "set", "unit", "head")


def _verified(corpus: _Corpus, pairs: DataFrame) -> DataFrame:
    """(u, v, both, either) of ``pairs(u, v)`` on the sets.

    A unit is one ``u`` with a slice of its partners; each set is read once and sent to its units.
    """
    slices = _slices(F.count(F.lit(1)).over(Window.partitionBy("u")), UNIT // 2)
    cut = pairs.distinct().withColumn("n", slices).withColumn("unit", F.xxhash64("u", _slice_of("v", F.col("n"))))
    cut = materialize(cut.select("u", "v", "unit"), "pairs")
    places = cut.select(F.col("v").alias("rid"), "unit", F.lit(False).alias("head")).unionByName(
        cut.select(F.col("u").alias("rid"), "unit", F.lit(True).alias("head"))
    )
    sent = _sent(corpus, places)

    def compare(rows: pa.Table) -> pa.Table:
        rids, heads = rows.column("rid").to_pylist(), rows.column("head").to_pylist()
        own = _as_sets(rows.column("set"))
        # Units are hashes: should two coincide, every head meets every partner, and the join below keeps the pairs asked for.
        out = [
            (rids[h], rids[k], *jaccard_parts(own[h], own[k]))
            for h in range(len(rids)) if heads[h]
            for k in range(len(rids)) if not heads[k] and rids[k] != rids[h]
        ]
        return pa.table({c: pa.array([o[k] for o in out], pa.int64()) for k, c in enumerate(("u", "v", "both", "either"))})

    compared = sent.groupBy("unit").applyInArrow(compare, "u long, v long, both long, either long")
    return materialize(compared.join(cut.select("u", "v"), ["u", "v"], "left_semi").distinct(), "verified")


# ---------------------------------------------------------------- units


def _unit_of(rows: pa.Table) -> tuple[list[int], list[bytes], np.ndarray]:
    rows = rows.sort_by("rid").combine_chunks()
    sizes = np.array(rows.column("size").to_pylist(), np.int64)
    return rows.column("rid").to_pylist(), rows.column("sig").to_pylist(), sizes


def _pair_table(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"u": pa.array([p[0] for p in pairs], pa.int64()), "v": pa.array([p[1] for p in pairs], pa.int64())})


def _star_unit(percent: int):
    """Proposed stars of one unit (rid, size, sig) -> (u centre, v member), by estimated similarity.

    Documents nearest the unit's majority bitmap come first, so an original is centre before its edited copies.
    """

    def run(rows: pa.Table) -> pa.Table:
        rids, sigs, sizes = _unit_of(rows)
        out = []
        for words, own, _ in by_width(sigs, 1):
            bits = np.stack([folded(sigs[k], words) for k in own])
            usual = np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little").sum(axis=0) * 2 > len(own)
            usual = np.packbits(usual, bitorder="little").view(np.uint64)
            apart = np.bitwise_count(bits ^ usual).sum(axis=1, dtype=np.int64)
            centers = np.empty(0, np.int64)
            for k in np.lexsort((own, apart)).tolist():
                common = np.bitwise_count(bits[centers] & bits[k]).sum(axis=1, dtype=np.int64)
                share = -np.log1p(-np.minimum(common / (64.0 * words), 0.999)) * 64 * words
                total = sizes[own[centers]] + sizes[own[k]]
                like = share * (100 + percent) / (percent * total)
                best = int(np.argmax(like)) if len(like) else -1
                if best >= 0 and like[best] >= 0.99:
                    out.append((rids[own[centers[best]]], rids[own[k]]))
                else:
                    centers = np.append(centers, k)
        return _pair_table(out)

    return run


def _center_unit(percent: int):
    """Pairs of centres (rid, size, sig, radius, comp) of one unit and several components that may link, or whose
    members may -> (u, v)."""

    def run(rows: pa.Table) -> pa.Table:
        rids, sigs, sizes = _unit_of(rows)
        rows = rows.sort_by("rid")
        radius, comps = np.array(rows.column("radius").to_pylist()), rows.column("comp").to_pylist()
        # Thresholds reach down to 1 - 3 * (1 - t): as many times as wide the larger of two sets can be.
        least = max(percent / 100 - 2 * float(radius.max(initial=0)), 0.05)
        return _pair_table(_tree_pairs(rids, sigs, sizes, radius, comps, percent, 2 * int(1 / least + 1)))

    return run


def _tree_pairs(rids, sigs, sizes, slack, sides, percent: int, reach: int) -> list[tuple[int, int]]:
    """Pairs of different ``sides`` that may reach the threshold less both slacks."""
    sides, out = np.unique(sides, return_inverse=True)[1], []
    for words, own, wider in by_width(sigs, reach):
        rows = np.concatenate([own, wider])
        bits = np.stack([folded(sigs[k], words) for k in rows])
        # Pairs among the wider ones belong to their own width.
        groups = np.where(np.arange(len(rows)) < len(own), sides[rows], -1)
        tree = SignatureTree(bits, sizes[rows], slack[rows], groups)
        for a, b in tree.pairs(percent / 100):
            a, b = rows[a], rows[b]
            if sides[a] != sides[b]:
                out.append((rids[a], rids[b]) if rids[a] < rids[b] else (rids[b], rids[a]))
    return out


def _partner_unit(percent: int):
    """For each document (rid, size, sig, comp) the most similar one of another component, by estimate -> (u, v).

    At most one pair per document.
    """

    def run(rows: pa.Table) -> pa.Table:
        rids, sigs, sizes = _unit_of(rows)
        comps = np.array(rows.sort_by("rid").column("comp").to_pylist())
        out = set()
        for words, own, wider in by_width(sigs, 2):
            both = np.concatenate([own, wider])
            bits = np.stack([folded(sigs[k], words) for k in both])
            for i, k in enumerate(own):
                common = np.bitwise_count(bits & bits[i]).sum(axis=1, dtype=np.int64)
                share = -np.log1p(-np.minimum(common / (64.0 * words), 0.999)) * 64 * words
                like = np.where(comps[both] != comps[k], share * (100 + percent) / (percent * (sizes[both] + sizes[k])), 0)
                best = int(like.argmax())
                if like[best] >= 0.97:
                    out.add((min(rids[k], rids[both[best]]), max(rids[k], rids[both[best]])))
        return _pair_table(sorted(out))

    return run


def _member_unit(percent: int):
    """For each document (rid, set) that is no head, one head it links with, if there is any -> (u, v)."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rid")
        sets, heads = _as_sets(rows.column("set")), rows.column("head").to_pylist()
        sigs, sizes, found = [signature(x) for x in sets], np.array([len(x) for x in sets], np.int64), {}
        for a, b in _tree_pairs(list(range(len(sets))), sigs, sizes, np.zeros(len(sets)), heads, percent, 4):
            head, other = (a, b) if heads[a] else (b, a)
            if other not in found:
                both, either = jaccard_parts(sets[head], sets[other])
                if 100 * both >= percent * either:
                    found[other] = head
        rids = rows.column("rid").to_pylist()
        return _pair_table([(rids[h], rids[o]) for o, h in found.items()])

    return run


def _slices(count, per: int):
    return F.ceil(count / F.lit(per)).cast("long")


def _slice_of(col: str, slices):
    return F.pmod(F.xxhash64(col), slices)


def _with_signature(corpus: _Corpus, units: DataFrame) -> DataFrame:
    return corpus.signatures.join(_narrow(materialize(units, "units")), "rid")


def _linked(percent: int):
    return F.col("both") * 100 >= F.col("either") * percent


def _proposed_stars(corpus: _Corpus, keyed: DataFrame, percent: int) -> DataFrame:
    """Verified (u centre, v member, both, either) among rows of ``keyed(rid, key)`` with one key."""
    keyed = keyed.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("c > 1")
    units = keyed.select("key", _slice_of("rid", _slices(F.col("c"), UNIT)).alias("slice"), "rid")
    proposed = _with_signature(corpus, units).groupBy("key", "slice").applyInArrow(_star_unit(percent), PAIRS)
    return _verified(corpus, proposed).filter(_linked(percent))


def _stars(corpus: _Corpus, shared: DataFrame, percent: int) -> DataFrame:
    """(rid, center, dist) of every document that joined a centre it links with."""
    found = _proposed_stars(corpus, shared.groupBy("rid").agg(F.min("key").alias("key")), percent)
    dist = (1 - F.col("both") / F.col("either")).alias("dist")
    # A centre never is a member: each document is in one unit, and a unit's members are not its centres.
    return materialize(found.select(F.col("v").alias("rid"), F.col("u").alias("center"), dist), "stars-found")


def _center_links(corpus: _Corpus, shared: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """(u, v): links between centres that meet by other shared shingles than the smallest."""
    centers = shared.join(_narrow(stars.select("rid")), "rid", "left_anti")
    mixed = [F.min(F.xxhash64(F.lit(seed), "key")).alias(f"k{seed}") for seed in (1, 2)]
    keyed = centers.groupBy("rid").agg(*mixed).select("rid", F.explode(F.array("k1", "k2")).alias("key")).distinct()
    return materialize(_proposed_stars(corpus, keyed, percent).select("u", "v"), "center-links")


def _center_pairs(corpus: _Corpus, shared: DataFrame, stars: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(u, v, linked, dist) over centres of several components sharing a prefix shingle of any of their members."""
    of_key = Window.partitionBy("key")
    stars_of = (
        shared.join(stars.select("rid", "center"), "rid", "left")
        .select("key", F.coalesce("center", "rid").alias("rid"))
        .distinct()
        .join(labels.withColumnRenamed("node", "rid"), "rid", "left")
        .withColumn("comp", F.coalesce("component", "rid"))
        .withColumn("c", F.count(F.lit(1)).over(of_key))
        .withColumn("low", F.min("comp").over(of_key))
        .withColumn("high", F.max("comp").over(of_key))
        .filter("low <> high")
        .select("key", "rid", "c")
    )
    stars_of = materialize(stars_of, "stars-of-key")
    # Many shingles of one shared passage have the same stars: one unit for all of them.
    small = (
        stars_of.filter(F.col("c") <= SMALL_GROUP)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("rid")).alias("rids"))
        .select("rids")
        .distinct()
        .select(F.xxhash64("rids").alias("unit"), F.explode("rids").alias("rid"))
    )
    s, other = F.col("slice"), F.col("other")
    large = (
        stars_of.filter(F.col("c") > SMALL_GROUP)
        .withColumn("slices", _slices(F.col("c"), UNIT // 2))
        .withColumn("slice", _slice_of("rid", F.col("slices")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
        .select(F.xxhash64("key", F.least(s, other), F.greatest(s, other)).alias("unit"), "rid")
    )
    radius = stars.groupBy(F.col("center").alias("rid")).agg(F.max("dist").alias("radius"))
    units = small.unionByName(large).distinct().join(radius, "rid", "left")
    units = units.join(labels.withColumnRenamed("node", "rid"), "rid", "left")
    facts = (F.coalesce("radius", F.lit(0.0)).alias("radius"), F.coalesce("component", "rid").alias("comp"))
    units = _with_signature(corpus, units.select("unit", "rid", *facts))
    proposed = units.groupBy("unit").applyInArrow(_center_unit(percent), PAIRS)
    far = F.greatest(F.coalesce("r_u", F.lit(0.0)) + F.coalesce("r_v", F.lit(0.0)), F.lit(0.0))
    dist = 1 - F.col("both") / F.col("either")
    of = lambda c: radius.select(F.col("rid").alias(c), F.col("radius").alias(f"r_{c}"))
    pairs = _verified(corpus, proposed).join(of("u"), "u", "left").join(of("v"), "v", "left")
    near = (far > 0) & (dist <= 1 - percent / 100 + far + EPS)
    pairs = pairs.filter(_linked(percent) | near)
    return materialize(pairs.select("u", "v", _linked(percent).alias("linked"), dist.alias("dist")), "center-pairs")


def _partner_links(corpus: _Corpus, shared: DataFrame, near: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(u, v): links between documents of different near components that meet by a shared shingle."""
    comps = near.select(F.col("u_comp").alias("comp")).unionByName(near.select(F.col("v_comp").alias("comp"))).distinct()
    mixed = [F.min(F.xxhash64(F.lit(seed), "key")).alias(f"k{seed}") for seed in (3, 4)]
    comp = F.coalesce("component", "rid")
    rows = shared.join(labels.withColumnRenamed("node", "rid"), "rid", "left").withColumn("comp", comp).join(comps, "comp")
    keyed = rows.groupBy("rid", "comp").agg(*mixed).select("rid", "comp", F.explode(F.array("k3", "k4")).alias("key"))
    keyed = keyed.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("c > 1")
    units = keyed.select("key", _slice_of("rid", _slices(F.col("c"), UNIT)).alias("slice"), "rid", "comp")
    proposed = _with_signature(corpus, units).groupBy("key", "slice").applyInArrow(_partner_unit(percent), PAIRS)
    return materialize(_verified(corpus, proposed).filter(_linked(percent)).select("u", "v"), "partner-links")


def _member_links(corpus: _Corpus, near: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """(u, v): links between members of the near stars ``near(u, v, dist)``.

    The members of a star meet those of all its near stars at once, slice by slice.
    """
    gap = 1 - percent / 100 + EPS
    radius = stars.groupBy("center").agg(F.max("dist").alias("radius"), F.count(F.lit(1)).alias("n"))
    of = lambda c: radius.select(F.col("center").alias(c), F.col("radius").alias(f"r_{c}"), F.col("n").alias(f"n_{c}"))
    near = near.join(of("u"), "u", "left").join(of("v"), "v", "left").na.fill(0)
    # The larger star of a pair is the head.
    swap = F.col("n_v") > F.col("n_u")
    pick = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a))
    near = near.select(pick("u", "v").alias("u"), pick("v", "u").alias("v"), "dist", pick("r_u", "r_v").alias("r_u"), pick("r_v", "r_u").alias("r_v"))
    near = materialize(near, "near-pairs")
    centers = near.select(F.col("u").alias("center")).unionByName(near.select(F.col("v").alias("center"))).distinct()
    members = stars.select("rid", "center", F.col("dist").alias("own")).unionByName(
        centers.select(F.col("center").alias("rid"), "center", F.lit(0.0).alias("own"))
    )
    least = near.groupBy("u").agg(F.min(F.col("dist") - F.col("r_v")).alias("least"))
    heads = least.join(members.withColumnRenamed("center", "u"), "u").filter(F.col("own") >= F.col("least") - gap)
    others = near.join(members.withColumnRenamed("center", "v"), "v").filter(F.col("own") >= F.col("dist") - F.col("r_u") - gap)

    def sliced(rows: DataFrame) -> DataFrame:
        rows = rows.select("u", "rid").distinct()
        slices = _slices(F.count(F.lit(1)).over(Window.partitionBy("u")), UNIT // 2)
        return rows.withColumn("n", slices).withColumn("own", _slice_of("rid", F.col("n")))

    heads, others = sliced(heads), sliced(others)
    counts = lambda rows: rows.groupBy("u").agg(F.max("n").alias("m"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1))
    heads = heads.join(counts(others), "u").withColumn("that", each)
    others = others.join(counts(heads), "u").withColumn("that", each)
    places = heads.select("rid", F.xxhash64("u", "own", "that").alias("unit"), F.lit(True).alias("head")).unionByName(
        others.select("rid", F.xxhash64("u", "that", "own").alias("unit"), F.lit(False).alias("head"))
    )
    return _sent(corpus, places).groupBy("unit").applyInArrow(_member_unit(percent), PAIRS).distinct()


# ---------------------------------------------------------------- the join


def _apart(near: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (u, v, dist) whose stars are of different components, with those."""
    label = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_comp"))
    rows = near.join(label("u"), "u", "left").join(label("v"), "v", "left")
    rows = rows.withColumns({f"{c}_comp": F.coalesce(f"{c}_comp", c) for c in "uv"})
    return materialize(rows.filter("u_comp <> v_comp"), "near-stars")


def _joined(df: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """doc_id, text_hash, size, rid, comp (a rid), component_id per input row."""
    labelled = _grouped(df, id_col, text_col, n, percent)
    smallest = labelled.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return labelled.join(smallest, "comp")


def _grouped(df: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """doc_id, text_hash, size, rid, comp (a rid) per input row, written; what led there is deleted."""
    spark = df.sparkSession
    # Every step in Python is run and written in here.
    with small_batches(spark), shuffles_released(spark), scratch_released(spark) as release:
        labelled = _labelled(df, id_col, text_col, n, percent)
        release(labelled)
    return labelled


def _labelled(df: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    sets = _sets(df, id_col, text_col, n)
    signed = _signed(sets, percent)
    rows = signed.select("rid", "doc_id", "text_hash", "size", "set_hash")
    groups = rows.filter("size > 0").groupBy("set_hash").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("copies"))
    copied = rows.select("rid", "set_hash").join(groups.filter("copies > 1"), "set_hash").select("rid", "rep")
    copied = materialize(copied.filter("rid <> rep"), "copies")

    prefixes = signed.filter("size > 0").select("rid", "keys").join(_narrow(copied.select("rid")), "rid", "left_anti")
    by_key = Window.partitionBy("key")
    shared = prefixes.select("rid", F.explode("keys").alias("key")).withColumn("c", F.count(F.lit(1)).over(by_key))
    shared = materialize(shared.filter("c > 1").select("key", "rid"), "shared-keys")

    corpus = _Corpus(sets.select("rid", "set"), signed.select("rid", "size", "sig"))

    stars = _stars(corpus, shared, percent)
    links = stars.select(F.col("rid").alias("u"), F.col("center").alias("v"))
    links = links.unionByName(_center_links(corpus, shared, stars, percent))
    pairs = _center_pairs(corpus, shared, stars, connected_components(links), percent)
    links = links.unionByName(pairs.filter("linked").select("u", "v"))
    labels = connected_components(links)
    undecided = pairs.filter("not linked").groupBy("u", "v").agg(F.min("dist").alias("dist"))
    near = _apart(undecided, labels)
    if near.limit(1).count():
        links = links.unionByName(_partner_links(corpus, shared, near, labels, percent))
        labels = connected_components(links)
        near = _apart(undecided, labels).select("u", "v", "dist")
        more = materialize(_member_links(corpus, near, stars, percent), "member-links")
        if more.limit(1).count():
            labels = connected_components(links.unionByName(more))

    rows = rows.drop("set_hash").join(copied, "rid", "left").withColumn("rep", F.coalesce("rep", "rid"))
    labelled = rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return materialize(labelled.withColumn("comp", F.coalesce("component", "rep")).drop("component", "rep"), "labelled")


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    return _joined(df, id_col, text_col, n, percent).select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id"
    )


def keep_one_per_component(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``df`` with the smallest id of their component (of equal ids one row), all columns kept."""
    labelled = _grouped(df, id_col, text_col, n, percent)
    first = labelled.groupBy("comp").agg(F.min(F.struct("doc_id", "rid")).alias("first"))
    columns = df.columns
    if labelled.groupBy("doc_id").count().filter((F.col("count") > 1) | F.col("doc_id").isNull()).limit(1).count():
        stay = labelled.join(first, "comp").filter(F.col("rid") == F.col("first.rid"))
        stay = stay.select(F.col("doc_id").alias("__jac_id"), F.col("text_hash").alias("__jac_to"))
        rows = df.withColumn("__jac_hash", F.xxhash64(text_col))
        on = rows[id_col].eqNullSafe(stay["__jac_id"]) & (rows["__jac_hash"] == stay["__jac_to"])
        return rows.join(stay, on, "left_semi").dropDuplicates([id_col, "__jac_hash"]).select(*columns)
    gone = labelled.join(first, "comp").filter(F.col("rid") != F.col("first.rid")).select(F.col("doc_id").alias("__jac_id"))
    gone = _narrow(materialize(gone, "gone"))  # texts are not shuffled for few ids
    return df.join(gone, df[id_col] == gone["__jac_id"], "left_anti").select(*columns)
