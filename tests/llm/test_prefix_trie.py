"""The prefix trie against a brute-force trie."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from scanpress.llm import prefixtrie
from scanpress.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string"
SF = "/root/testdata/sf0.001"


def _brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out = set()
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[p] for p in below) or 1
        saved[path] = sum(saved[p] for p in below) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
        ended = ",".join(map(str, sorted(ends.get(path, []))))
        up = min(members[path[:-1]]) if path else None
        out.add((min(members[path]), len(path), up, len(members[path]), len(below), leaves[path], saved[path], hashlib.sha256(ended.encode()).hexdigest()))
    return out


def _found(spark, rows, **steps):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(5)
    nodes = prefixtrie.prefix_trie(prefixtrie.with_shared_openings(prefixtrie.conversations(df)), **steps).collect()
    got = [(n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, n.n_leaves, n.saved_tokens, n.ends_sha256) for n in nodes]
    assert len(set(got)) == len(got) == len({n.key for n in nodes})
    return set(got)


def _rows(rng):
    rows = []
    for c in [*range(60), *range(95, 230, 3), *range(-130, -90, 4), 10_000, 70_001]:
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "été 𝛼"])) for t in range(rng.choice([1, 2, 3, 7]))]
    for c in range(300, 340):  # one very common opening of 40 turns, some conversations equal as a whole
        rows += [(c, t, "user", f"same {t}") for t in range(40)] + [(c, 40 + t, "user", str(c % 3)) for t in range(c % 4)]
    rows += [(500, t, None if t % 2 else "user", None) for t in range(3)]
    rows += [(501, None, "user", "first"), (501, 0, "user", "tie b"), (501, 0, "user", "tie a"), (501, 0, "user", "tie a")]
    rows += [(502, 0, "", "x" * 300_000), (None, 0, "user", "no conversation")]
    return rows


def test_trie_equals_brute_force_by_depths_and_by_bands(spark):
    rows = _rows(random.Random(4))
    want = _brute(rows)
    assert _found(spark, rows) == want
    assert _found(spark, rows, band=7, shallow=0) == want


def test_small_bounds_give_the_same_nodes(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "LEAST_HOT", 2)
    monkeypatch.setattr(prefixtrie, "MOST_HOT", 100)
    monkeypatch.setattr(prefixtrie, "CHUNK_BITS", 1)
    rows = [r for r in _rows(random.Random(5)) if r[0] is None or r[0] < 300]
    assert _found(spark, rows, band_bytes=0) == _brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(101, 130)]  # no conversation 100: openings are absent
    want = _brute(rows)
    assert any(d == 0 and e != prefixtrie.EMPTY for _, d, *_, e in want)
    assert _found(spark, rows) == want
    assert _found(spark, []) == set()


def test_floors_step_to_the_root():
    depths = [(2, 10**9), (300, 4), (399, 1)]
    floors = prefixtrie._floors(depths, 64, 32 << 20, 8)
    assert floors == [335, 271, 207, 143, 79, 15, 8, 7, 6, 5, 4, 3, 2, 1, 0, -1]
    assert prefixtrie._floors([(70, 10**9), (72, 1)], 64, 32 << 20, 8) == [*range(71, -2, -1)]
    assert prefixtrie._floors([], 64, 1, 8) == []


def test_registered_trie_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_prefix_trie"](spark, SF).collect()
    assert {tuple(r) for r in got} == _brute(rows)
