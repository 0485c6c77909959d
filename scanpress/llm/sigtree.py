"""Signature tree over the shingle sets of one bounded group.

A document's signature is a bitmap: bit ``shingle mod W`` is set for each of
its shingles.  A node holds the OR of its documents' bitmaps, their size range
and the largest number of shingles any of them hides in shared bits
(``size - popcount``).  Two documents below nodes X and Y share at most

    min(max size of X, max size of Y, popcount(X & Y) + min(hidden X, hidden Y))

shingles, so the dual traversal drops a node pair as soon as that is less than
the similarity asked for needs at the nodes' smallest sizes.  Leaves hold up to
``LEAF`` documents, compared as bitmaps in one numpy operation; the pairs that
remain are decided on the sets themselves, by the caller.

Bitmaps have 2 to 4 bits per shingle, a power of two, so bitmaps of different
widths compare after folding the wider one (OR of its halves).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF, FANOUT = 32, 4


def needed(threshold, sizes):
    """Least intersection (real) that two sets of ``sizes`` together need for ``threshold``: t / (1 + t) * sizes."""
    return threshold / (1 + threshold) * sizes - 1e-6


def hidden(bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Shingles that share their bit with another one of the same document."""
    return sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def signature(values: np.ndarray) -> bytes:
    """Bitmap of a shingle set, 64 bits or the power of two of at least 2 bits per shingle."""
    width = max(64, 1 << (2 * len(values) - 1).bit_length()) if len(values) else 64
    bits = np.zeros(width, bool)
    bits[(values & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(data: bytes, words: int) -> np.ndarray:
    bits = np.frombuffer(data, "<u8")
    while len(bits) > words:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def by_width(signatures: list[bytes], reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, documents of that width, documents up to ``reach`` times as wide) for every width."""
    words = np.array([len(s) // 8 for s in signatures], np.int64)
    for w in np.unique(words).tolist():
        yield w, np.flatnonzero(words == w), np.flatnonzero((words > w) & (words <= w * reach))


class SignatureTree:
    def __init__(self, bits: np.ndarray, sizes: np.ndarray, slack: np.ndarray, groups: np.ndarray) -> None:
        """``bits``: one row of words per document; ``slack``: how far below the threshold a document's pairs
        still count (its star's radius); ``groups``: pairs within one group are not asked for."""
        self.bits, self.sizes, self.slack, self.groups = bits, sizes, slack, groups
        self.hidden = hidden(bits, sizes)
        order = np.lexsort((self.sizes, groups))
        level = [self._leaf(order[k : k + LEAF]) for k in range(0, len(order), LEAF)]
        while len(level) > 1:
            level = [self._inner(level[k : k + FANOUT]) for k in range(0, len(level), FANOUT)]
        self.root = level[0] if level else None

    def _leaf(self, rows: np.ndarray) -> dict:
        own = self.groups[rows]
        return {
            "rows": rows, "below": None, "bits": np.bitwise_or.reduce(self.bits[rows], axis=0),
            "low": int(self.sizes[rows].min()), "high": int(self.sizes[rows].max()), "hidden": int(self.hidden[rows].max()),
            "slack": float(self.slack[rows].max()), "group": int(own[0]) if (own == own[0]).all() else None,
        }

    def _inner(self, nodes: list[dict]) -> dict:
        kinds = {n["group"] for n in nodes}
        return {
            "rows": None, "below": nodes, "bits": np.bitwise_or.reduce([n["bits"] for n in nodes], axis=0),
            "low": min(n["low"] for n in nodes), "high": max(n["high"] for n in nodes),
            "hidden": max(n["hidden"] for n in nodes), "slack": max(n["slack"] for n in nodes),
            "group": kinds.pop() if len(kinds) == 1 else None,
        }

    def _apart(self, x: dict, y: dict, threshold: float) -> bool:
        if x["group"] is not None and x["group"] == y["group"]:
            return True
        t = max(threshold - x["slack"] - y["slack"], 0.0)
        if x["high"] < t * y["low"] - 1e-6 or y["high"] < t * x["low"] - 1e-6:
            return True
        common = int(np.bitwise_count(x["bits"] & y["bits"]).sum())
        most = min(x["high"], y["high"], common + min(x["hidden"], y["hidden"]))
        return most < needed(t, x["low"] + y["low"])

    def pairs(self, threshold: float) -> Iterator[tuple[int, int]]:
        """Index pairs (a < b) of different groups that may reach ``threshold`` less both slacks."""
        stack = [(self.root, self.root)] if self.root else []
        while stack:
            x, y = stack.pop()
            if x is not y and self._apart(x, y, threshold):
                continue
            if x is y and x["group"] is not None:
                continue
            if x["below"] is None and y["below"] is None:
                yield from self._leaf_pairs(x["rows"], y["rows"], x is y, threshold)
            elif x is y:
                below = x["below"]
                stack.extend((below[i], below[j]) for i in range(len(below)) for j in range(i, len(below)))
            elif y["below"] is None or (x["below"] is not None and x["high"] >= y["high"]):
                stack.extend((child, y) for child in x["below"])
            else:
                stack.extend((x, child) for child in y["below"])

    def _leaf_pairs(self, a: np.ndarray, b: np.ndarray, same: bool, threshold: float) -> Iterator[tuple[int, int]]:
        common = np.bitwise_count(self.bits[a][:, None, :] & self.bits[b][None, :, :]).sum(axis=2, dtype=np.int64)
        most = common + np.minimum(self.hidden[a][:, None], self.hidden[b][None, :])
        most = np.minimum(most, np.minimum(self.sizes[a][:, None], self.sizes[b][None, :]))
        t = np.maximum(threshold - self.slack[a][:, None] - self.slack[b][None, :], 0.0)
        ok = most >= needed(t, self.sizes[a][:, None] + self.sizes[b][None, :])
        ok &= self.groups[a][:, None] != self.groups[b][None, :]
        if same:
            ok = np.triu(ok, 1)
        for i, j in np.argwhere(ok).tolist():
            yield int(min(a[i], b[j])), int(max(a[i], b[j]))


def jaccard_parts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    common = overlap(a, b)
    return common, len(a) + len(b) - common
