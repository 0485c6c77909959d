"""Operator 11, conversation prefix trie by truncation peeling.

A node is a distinct sequence of first turns (role, text) of a conversation;
the root is the empty sequence.  Texts are read once and reduced to 128-bit
digests and lengths in the scan; a conversation is its path: the chained
digests of its prefixes (16 bytes a turn) and the lengths of its turns.

1. Conversations of equal paths become one leaf group (members counted, their
   ids hashed in ascending order).
2. Peeling starts at the greatest depth.  The frontier of a depth holds the
   groups that end there and the nodes that survived from below with their
   last turn stripped.  Regrouping it by prefix yields the finished nodes of
   that depth, all their sums at once: a survivor brings its members, leaves
   and saved tokens, and counts as one child.  Stripped, these nodes are the
   frontier of the next depth.
3. The sums are plain aggregates with map-side combine, so a prefix that a
   third of all conversations share is one row per task before the shuffle.
   Each depth is written to the shared folder, which cuts the lineage.

Conversations are mostly short, but a few may have hundreds of turns, and a
Spark job for each depth of a few rows would be waste.  While all paths
deeper than some depth fit in ``BAND_BYTES``, up to ``BAND`` depths are peeled
in one job: the frontier is grouped by its prefix at the band's floor, and a
task peels the subtree over that prefix in the same way.  The bound is checked
on the histogram of depths, so no group passes it; depths up to
``SHALLOW`` are always peeled by aggregates.

The parent's smallest member is looked up by the parent's prefix.  Parents
with very many children (at most ``MOST_HOT`` of them, by their definition)
are broadcast, so their children need no shuffle.

Defined results: turns are ordered by (turn with null first, digest of role
and text); a null role or text is empty; a null conversation id takes no part;
repeated rows are turns of their own; no conversations give no nodes; extra
columns are ignored.  Prefixes are equal when 128 bits of a SHA-256 chain are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanpress.llm.common import materialize

KEY = 16
BAND, BAND_BYTES, SHALLOW = 64, 32 << 20, 8
CHUNK_BITS = 8
MOST_HOT, LEAST_HOT = 100_000, 10_000
EMPTY = hashlib.sha256(b"").hexdigest()
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
GROUPS = "path binary, sizes array<int>, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, each a digest of (role, text) and its code points."""
    r, t = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    digest = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length(r).cast("string"), F.concat(r, t)), 256), 1, 2 * KEY))
    one = F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.length(t).alias("size"))
    known = rows.filter(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv_id"), one.alias("one"))
    turns = F.transform(F.sort_array(F.collect_list("one")), lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size")))
    return known.groupBy("conv_id").agg(turns.alias("turns"))


def with_shared_openings(convs: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Conversation c opens with the first h turns of conversation c - c % block, then come its own after its first h;
    h is crc32(c) % most."""
    own = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    )
    bases = convs.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("opening")
    )
    head = F.coalesce(F.slice("opening", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    tail = F.filter("turns", lambda _, i: i >= F.col("h"))
    return own.join(bases, "base", "left").select("conv_id", F.concat(head, tail).alias("turns"))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, path, sizes): the chained digests of all prefixes, laid end to end."""
    for batch in batches:
        paths = []
        for digests in batch.column(1).to_pylist():
            key, keys = b"", []
            for digest in digests:
                key = hashlib.sha256(key + digest).digest()[:KEY]
                keys.append(key)
            paths.append(b"".join(keys))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.binary()), batch.column(2)], names=["conv_id", "path", "sizes"])


def _joined_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, ends_sha256) of rows (path, chunk, ids) sorted by path and chunk; a hash is fed as its chunks stream by."""
    open_path, state = None, None
    for batch in batches:
        paths, hashes = [], []
        for path, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if path != open_path:
                if state is not None:
                    paths.append(open_path)
                    hashes.append(state.hexdigest())
                open_path, state = path, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(hashes, pa.string())], names=["path", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([open_path], pa.binary()), pa.array([state.hexdigest()])], names=["path", "ends_sha256"])


def _leaf_groups(convs: DataFrame) -> DataFrame:
    """One row per distinct path, its members counted and their ids hashed.

    Ids are gathered in chunks of neighbouring ids, so no group is larger than a chunk, and a path's chunks are hashed as
    a stream in ascending order."""
    narrow = convs.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.size").alias("sizes"))
    paths = materialize(narrow.mapInArrow(_paths, "conv_id long, path binary, sizes array<int>"), "paths")
    chunks = paths.groupBy("path", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    ordered = chunks.repartition("path").sortWithinPartitions("path", "chunk")
    hashes = ordered.mapInArrow(_joined_hashes, "path binary, ends_sha256 string")
    sums = paths.groupBy("path", "sizes").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    zero = F.lit(0).cast("long")
    groups = sums.join(hashes, "path").select(
        "path", "sizes", F.size("sizes").alias("depth"), "conv_id", "n_convs",
        zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"), "ends_sha256",
    )
    return materialize(groups.sortWithinPartitions("depth"), "leaf-groups")


def _key(path: Column, depth: Column) -> Column:
    """The prefix of ``depth`` turns: its chained digest, empty for the root."""
    return F.when(depth <= 0, F.lit(b"")).otherwise(F.substring(path, (depth - 1) * KEY + 1, F.lit(KEY)))


def _finished(frontier: DataFrame) -> DataFrame:
    """The nodes of one depth from its frontier."""
    nodes = frontier.groupBy("path", "sizes", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS], F.max("ends_sha256").alias("ends_sha256")
    )
    last = F.coalesce(F.get("sizes", F.col("depth") - 1), F.lit(0))
    return nodes.withColumn("n_leaves", F.greatest("n_leaves", F.lit(1).cast("long"))).withColumn(
        "saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * last
    )


def _stripped(nodes: DataFrame, depth: int) -> DataFrame:
    """The nodes of ``depth`` without their last turn, each a child of what they become part of."""
    return nodes.filter(F.col("depth") == depth).select(
        F.substring(F.col("path"), 1, (depth - 1) * KEY).alias("path"), F.slice("sizes", 1, depth - 1).alias("sizes"),
        F.lit(depth - 1).alias("depth"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
        "saved_tokens", F.lit(None).cast("string").alias("ends_sha256"),
    )


def _peel_band(floor: int):
    """Peels the subtree over one prefix of ``floor`` turns, down to the nodes of ``floor + 1`` turns."""

    def run(rows: pa.Table) -> pa.Table:
        by_depth: dict[int, dict[bytes, list]] = {}

        def add(depth: int, path: bytes, sizes: list, conv_id: int, sums: tuple, ends: str | None) -> None:
            node = by_depth.setdefault(depth, {}).setdefault(path, [sizes, conv_id, 0, 0, 0, 0, None])
            node[1] = min(node[1], conv_id)
            for at, value in enumerate(sums, 2):
                node[at] += value
            node[6] = ends or node[6]

        for row in rows.select(GROUP_NAMES).to_pylist():
            add(row["depth"], row["path"], row["sizes"], row["conv_id"], tuple(row[c] for c in SUMS), row["ends_sha256"])
        out = []
        for depth in range(max(by_depth, default=floor), floor, -1):
            for path, (sizes, conv_id, n, children, leaves, saved, ends) in by_depth.pop(depth, {}).items():
                leaves, saved = max(leaves, 1), saved + (n - 1) * sizes[depth - 1]
                kept = (path, sizes[:depth]) if depth == floor + 1 else (path[-2 * KEY :], None)
                out.append((*kept, depth, conv_id, n, children, leaves, saved, ends))
                if depth > floor + 1:
                    add(depth - 1, path[: (depth - 1) * KEY], sizes, conv_id, (n, 1, leaves, saved), None)
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * len(ARROW), ARROW, strict=True)], names=GROUP_NAMES)

    return run


GROUP_NAMES = [c.split()[0] for c in GROUPS.split(", ")]
ARROW = [pa.binary(), pa.list_(pa.int32()), pa.int32(), *[pa.int64()] * 5, pa.string()]


def _floors(depths: list[tuple[int, int]], band: int, band_bytes: int, shallow: int) -> list[int]:
    """Floors of the steps from the greatest depth to the root: a band where all deeper paths fit, else one depth."""
    deepest = max((d for d, _ in depths), default=-1)
    floors, at = [], deepest
    while at >= 0:
        floor = max(at - band, shallow)
        fits = sum(n * d * (KEY + 4) for d, n in depths if d > floor) <= band_bytes
        at = floor if fits and at > shallow else at - 1
        floors.append(at)
    return floors


def prefix_trie(convs: DataFrame, band: int = BAND, band_bytes: int = BAND_BYTES, shallow: int = SHALLOW) -> DataFrame:
    """key, parent_key, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every
    node of ``convs(conv_id, turns)``."""
    spark = convs.sparkSession
    leaves = _leaf_groups(convs)
    depths = [(r.depth, r["count"]) for r in leaves.groupBy("depth").count().collect()]  # one row per depth
    if not depths:
        return spark.createDataFrame([], "key binary, parent_key binary, depth int, conv_id long, parent_conv_id long, "
                                     "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    levels, above, at = [], None, max(d for d, _ in depths)
    for floor in _floors(depths, band, band_bytes, shallow):
        frontier = leaves.filter((F.col("depth") > floor) & (F.col("depth") <= at))
        if above is not None:
            frontier = frontier.unionByName(_stripped(above, at + 1))
        if at - floor == 1:
            nodes = _finished(frontier)
        else:
            nodes = frontier.groupBy(_key(F.col("path"), F.lit(floor)).alias("k")).applyInArrow(_peel_band(floor), GROUPS)
        above = materialize(nodes, f"depth-{at}")
        levels.append(above)
        at = floor
    return _with_parents(levels)


def _with_parents(levels: list[DataFrame]) -> DataFrame:
    """All nodes, with the smallest member of each one's parent."""
    held = (F.octet_length("path") / KEY).cast("int")  # the whole path's keys, or the last two
    key = _key(F.col("path"), held)
    above = F.when(F.col("depth") > 0, _key(F.col("path"), held - 1))
    ends = F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")
    nodes = reduce(
        DataFrame.unionByName, [x.select(key.alias("key"), above.alias("parent_key"), "depth", "conv_id", *SUMS, ends) for x in levels]
    )
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = max(LEAST_HOT, nodes.count() // MOST_HOT)
    many = parents.filter(F.col("n_children") > hot).drop("n_children").withColumnRenamed("parent_conv_id", "hot_id")
    few = parents.filter(F.col("n_children").between(1, hot)).drop("n_children")
    found = nodes.join(F.broadcast(many), "parent_key", "left")  # fewer than MOST_HOT rows: each has over nodes / MOST_HOT children
    rest = found.filter("hot_id IS NULL").drop("hot_id").join(few, "parent_key", "left")
    both = rest.unionByName(found.filter("hot_id IS NOT NULL").withColumnRenamed("hot_id", "parent_conv_id"))
    return both.select("key", "parent_key", "depth", "conv_id", "parent_conv_id", *SUMS, "ends_sha256")
