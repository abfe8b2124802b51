"""Operator 10: repeated byte strings, by deep-shallow sorting of suffixes.

A shard is the runs of bytes around one anchor (see ``repeats``). Its runs are
aligned at the anchor, and two arrays of suffixes are sorted: what follows the
anchors, and what precedes them, read backwards. Sorting is shallow first
(multikey quicksort, a byte at a time, down to SHALLOW bytes), then deep: the
groups that still agree go into blind tries, which look at the bytes where
strings part and compare whole strings once per insertion. Both give the
common prefixes of neighbours, and these say which strings of SIZE bytes around
the anchor occur at two places: those whose parts before and after it agree
with another run's for long enough.

Null and empty texts have no bytes and lose none. Repeated rows repeat each
other's strings. Texts shorter than SIZE bytes are kept whole. Removal may cut a
UTF-8 character; what is left is a string of bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from candela.llm import repeats, text as tx

SIZE = 200
GRAM = 24
SHALLOW = 8
#: Runs of a shard up to which all pairs are looked at one by one.
FEW = 6

_TABLE = np.random.default_rng(20240608).integers(0, 1 << 63, 256, dtype=np.uint64) * tx.U64(2) + tx.U64(1)
BYTES = repeats.Units(split=lambda text: text, hashes=lambda b: _TABLE[np.frombuffer(b, np.uint8)], pack=bytes, unpack=lambda b: b)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Strings in order, by insertion; inner nodes hold a depth and the children by the byte there (-1: the end)."""

    def __init__(self, first: int, strings: list[bytes]):
        self.strings = strings
        self.root: object = [first]

    def insert(self, i: int) -> None:
        strings, s = self.strings, self.strings[i]
        node = self.root
        while not isinstance(node, list):  # blind: only the bytes where others part are looked at
            depth, children = node
            byte = s[depth] if depth < len(s) else -1
            node = children.get(byte)
            if node is None:
                node = next(iter(children.values()))
        other = strings[node[0]]
        shared = common_prefix(s, other)
        if shared == len(s) == len(other):
            node.append(i)
            return
        parent, at, node = None, 0, self.root
        while not isinstance(node, list) and node[0] < shared:
            parent, at = node, s[node[0]]
            node = node[1][at]
        mine = s[shared] if shared < len(s) else -1
        if not isinstance(node, list) and node[0] == shared:
            node[1][mine] = [i]
            return
        theirs = other[shared] if shared < len(other) else -1
        new = (shared, {theirs: node, mine: [i]})
        if parent is None:
            self.root = new
        else:
            parent[1][at] = new

    def walk(self) -> tuple[list[int], list[int]]:
        """The strings in order, and how much each shares with the one before (the first: 0)."""
        order: list[int] = []
        shared: list[int] = []
        stack: list[tuple[object, int]] = [(self.root, 0)]
        while stack:
            node, first = stack.pop()
            if isinstance(node, list):
                whole = len(self.strings[node[0]])
                order.extend(node)
                shared.extend([first] + [whole] * (len(node) - 1))
                continue
            depth, children = node
            ordered = sorted(children)
            # children after the first one share this node's depth with what comes before
            stack.extend((children[b], depth) for b in reversed(ordered[1:]))
            stack.append((children[ordered[0]], first))
        return order, shared


def deep_shallow_sort(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """(order, common prefix of each with the one before it) of the strings."""
    order: list[int] = []
    shared: list[int] = []
    stack: list[tuple[list[int], int, int]] = [(list(range(len(strings))), 0, 0)]
    while stack:  # (group, depth to which it agrees, what its first shares with what comes before)
        group, depth, first = stack.pop()
        if len(group) == 1:
            order.append(group[0])
            shared.append(first)
            continue
        if depth >= SHALLOW:
            trie = BlindTrie(group[0], strings)
            for i in group[1:]:
                trie.insert(i)
            own, common = trie.walk()
            order.extend(own)
            shared.extend([first, *common[1:]])
            continue
        at = lambda i: strings[i][depth] if depth < len(strings[i]) else -1
        pivot = at(group[len(group) // 2])
        less, same, more = [], [], []
        for i in group:
            byte = at(i)
            (less if byte < pivot else more if byte > pivot else same).append(i)
        if pivot < 0:  # these end here, equal, before all that go on
            if more:
                stack.append((more, depth, depth))
            order.extend(same)
            shared.extend([first] + [len(strings[same[0]])] * (len(same) - 1))
            continue
        parts = [(g, d) for g, d in ((less, depth), (same, depth + 1), (more, depth)) if g]
        for k in range(len(parts) - 1, -1, -1):
            stack.append((*parts[k], first if k == 0 else depth))
    return order, shared


def _pairs(order: list[int], shared: list[int]) -> dict[tuple[int, int], int]:
    """Common prefix of each pair: the least between them in the order."""
    out = {}
    for i in range(len(order)):
        least = 1 << 60
        for j in range(i + 1, len(order)):
            least = min(least, shared[j])
            out[order[i], order[j]] = out[order[j], order[i]] = least
    return out


def repeated_windows(symbols: list[bytes], place: list[int], run: list[int], n: list[int]) -> list[np.ndarray]:
    """Flags of the windows of each run of a shard that occur at two places or more.

    A window that starts ``a`` bytes before the anchor occurs in another run
    too, if the two agree for ``a`` bytes before and SIZE - a bytes from the anchor on.
    """
    after = deep_shallow_sort([s[p:] for s, p in zip(symbols, place)])
    before = deep_shallow_sort([s[:p][::-1] for s, p in zip(symbols, place)])
    flags = [np.zeros(r, bool) for r in run]
    m = len(symbols)
    if m <= FEW:
        right, left = _pairs(*after), _pairs(*before)
        for x in range(m):
            for y in range(m):
                if x != y:  # a from SIZE - right to left, as far as x has such windows
                    high, low = min(left[x, y], place[x]), SIZE - right[x, y]
                    if low <= high:
                        flags[x][max(0, place[x] - high) : max(0, place[x] - low + 1)] = True
        return flags
    spot, length = np.array(place), np.array(run)
    sides = []
    for order, shared in (before, after):
        sides.append((np.array(order), np.array(shared)))
    for a in range(int(spot.max()) + 1):
        here = np.flatnonzero((a <= spot) & (spot - a < length))
        if not len(here):
            continue
        classes = []
        for (order, shared), depth in zip(sides, (a, SIZE - a)):
            name = np.empty(m, np.int64)
            name[order] = np.cumsum(shared < depth)
            classes.append(name)
        # every run that reaches a bytes back and SIZE - a on holds a window here, be it one of its own or not
        reach = np.flatnonzero((a <= spot) & (np.array([len(s) for s in symbols]) - spot >= SIZE - a))
        both = classes[0] * (m + 1) + classes[1]
        _, where, counts = np.unique(both[reach], return_inverse=True, return_counts=True)
        for x in reach[counts[where] > 1]:
            if 0 <= spot[x] - a < length[x]:
                flags[x][spot[x] - a] = True
    return flags


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and ``spans``: the spans of bytes (start, end) to remove, null for none."""
    rows = tx.keyed_rows(docs, id_col, text_col)
    spans = repeats.repeated_spans(rows, BYTES, SIZE, GRAM, repeated_windows)
    return rows.join(spans, "_key", "left").select("doc_id", "text", "spans")


def string_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of the bytes that stay."""

    def run(batch: pa.RecordBatch) -> dict:
        out = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for text, (start, end) in zip(tx.binary(batch.column(1)), repeats.span_edges(batch.column(2))):
            text = text or b""
            kept, removed, runs = text, 0, 0
            if len(start):
                gone = repeats.covered(len(text), start, end)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                removed = len(text) - len(kept)
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            for name, value in zip(out, (len(text), removed, runs, hashlib.sha256(kept).hexdigest())):
                out[name].append(value)
        return out | {"doc_id": batch.column(0)}

    return tx.map_batches(repeated_strings(docs, id_col, text_col), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", repeats.DOCS)


def op10_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
