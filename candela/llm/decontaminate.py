"""Operator 6: benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed (SEED words in a row) are
tiled: the longest common run of words that are not yet marked in either is
marked, again and again, down to runs of SEED words. Runs are found by running
Karp-Rabin: rolling hashes of the windows of a search length that is halved
until SEED. The share of the item's words that are marked is its coverage. Tiles
may lie in any order, so a passage whose parts were moved about is still found.

Words are lower-cased (A-Z) and cut at white space and ASCII punctuation.
The benchmark goes to the tasks in shards of at most SHARD_WORDS words, so what
a task holds is bounded however large the benchmark is; documents are read once
for each shard and never shuffled.

An item of fewer than SEED words is its own seed: it is found where all its words
stand in a row, as one tile.

Null texts, empty ones and those without words are never found and hold nothing. Repeated documents and items each give their own rows.
Empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candela.llm import text as tx

SEED = 5
COVERAGE = 0.8
#: Words of the benchmark that a task holds at a time.
SHARD_WORDS = 2_000_000
PUNCTUATION = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
BLANKS = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))
FILTER_BITS = 22


def normal_words(text: bytes | None) -> list[bytes]:
    return text.lower().translate(BLANKS).split() if text else []


def _free(marks: np.ndarray, size: int) -> np.ndarray:
    """Places where ``size`` unmarked words begin."""
    sums = np.concatenate(([0], np.cumsum(marks == 0)))
    return np.flatnonzero(sums[size:] - sums[:-size] == size)


def _segments(marks: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(place, words) of the unmarked stretches of at least ``size`` words."""
    edges = np.flatnonzero(np.diff(np.concatenate(([1], marks != 0, [1])).astype(np.int8)))
    return [(int(s), int(e - s)) for s, e in zip(edges[::2], edges[1::2]) if e - s >= size]


def _common_runs(a: tx.RollingHash, b: tx.RollingHash, marked_a: np.ndarray, marked_b: np.ndarray, size: int) -> dict[tuple[int, int], list[np.ndarray]]:
    """Longest common runs of unmarked words, ``size`` or more: (words, place in b) -> places in a.

    The windows of b are taken from the last to the first, with the runs that
    begin at each place of a in an array. So pairs of equal windows are held for one window
    of b at a time, and what is kept is a number for each run.
    """
    out: dict[tuple[int, int], list[np.ndarray]] = {}
    if min(a.n, b.n) < size:
        return out
    at_a, at_b = _free(marked_a, size), _free(marked_b, size)
    grams_a, grams_b = a.grams(size)[at_a], b.grams(size)[at_b]
    shared = np.isin(grams_a, grams_b)
    at_a, grams_a = at_a[shared], grams_a[shared]
    order = np.argsort(grams_a, kind="stable")  # equal windows by place
    at_a, grams_a = at_a[order].astype(np.int32), grams_a[order]
    low, high = np.searchsorted(grams_a, grams_b, "left"), np.searchsorted(grams_a, grams_b, "right")
    none = np.empty(0, np.int32)
    places = {int(j): at_a[x:y] for j, x, y in zip(at_b, low, high) if y > x}
    windows, begun, after = np.zeros(a.n + 2, np.int32), np.zeros(a.n + 2, bool), none
    for j in range(b.n - size, -1, -1):
        here = places.get(j, none)
        length = windows[here + 1] + 1
        windows[after] = 0
        windows[here] = length
        after = here
        if not len(here):
            continue
        before = places.get(j - 1, none)
        begun[before] = True
        first = ~begun[here - 1]  # before place 0 lies the last entry, which is never set
        begun[before] = False
        here, length = here[first], length[first]
        for n in np.unique(length):
            out.setdefault((int(n) + size - 1, j), []).append(here[length == n])
    return out


def tile(document: np.ndarray, item: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (place in the document, place in the item, words), longest first; ties by place in the item, then the document."""
    a, b = tx.RollingHash(document), tx.RollingHash(item)
    marked_a, marked_b = np.zeros(len(document), np.int8), np.zeros(len(item), np.int8)
    tiles: list[tuple[int, int, int]] = []
    size = max(least, len(item))
    while True:
        runs = _common_runs(a, b, marked_a, marked_b, size)
        heap = [(-n, j) for n, j in runs]
        heapq.heapify(heap)
        marks = np.concatenate(([0], np.cumsum(marked_a, dtype=np.int32)))

        def wait(n: int, j: int, at: np.ndarray) -> None:
            if (n, j) not in runs:
                heapq.heappush(heap, (-n, j))
            runs.setdefault((n, j), []).append(at)

        while heap:
            n, j = heapq.heappop(heap)
            n = -n
            at = runs.pop((n, j))
            at = np.unique(np.concatenate(at)) if len(at) > 1 else at[0]
            if marked_b[j : j + n].any():  # what the item has left of the run waits for its turn
                for s, m in _segments(marked_b[j : j + n], size):
                    wait(m, j + s, at + s)
                continue
            unmarked = np.flatnonzero(marks[at + n] == marks[at])
            if len(unmarked):  # the others end here: their words of the item are now marked
                i = int(at[unmarked[0]])
                tiles.append((i, j, n))
                marked_a[i : i + n] = marked_b[j : j + n] = 1
                marks = np.concatenate(([0], np.cumsum(marked_a, dtype=np.int32)))
                continue
            for i in at.tolist():  # all of them meet a tile, so they are few
                for s, m in _segments(marked_a[i : i + n], size):
                    wait(m, j + s, np.array([i + s], np.int32))
        if size == least:
            return tiles
        size = max(least, size // 2)


class Shard:
    """Seeds and words of some benchmark items."""

    def __init__(self, items: list[tuple[int | None, bytes | None]]):
        kept = [(item, tx.hash_words(normal_words(t))) for item, t in items]
        #: Items shorter than a seed: by number of words, hashes of the whole items in order, and their ids.
        self.short = {}
        for n in range(1, SEED):
            whole = sorted(((int(tx.RollingHash(h).grams(n)[0]), item) for item, h in kept if len(h) == n), key=lambda x: x[0])
            if whole:
                self.short[n] = np.array([x for x, _ in whole], tx.U64), [item for _, item in whole]
        kept = [(item, h) for item, h in kept if len(h) >= SEED]
        self.ids = [item for item, _ in kept]
        self.words = [h for _, h in kept]
        grams = [tx.RollingHash(h).grams(SEED) for h in self.words]
        seeds = np.concatenate(grams) if grams else np.empty(0, tx.U64)
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams]) if grams else np.empty(0, np.int64)
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner, self.place = seeds[order], owner[order], place[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.seeds >> tx.U64(64 - FILTER_BITS)).astype(np.int64)] = True

    def candidates(self, words: np.ndarray, coverage: float) -> list[int]:
        """Items whose words, as far as shared seeds cover them, reach the coverage: tiles lie within shared seeds."""
        grams = tx.RollingHash(words).grams(SEED)
        grams = np.unique(grams[self.filter[(grams >> tx.U64(64 - FILTER_BITS)).astype(np.int64)]])
        low, high = np.searchsorted(self.seeds, grams, "left"), np.searchsorted(self.seeds, grams, "right")
        hits = np.concatenate([np.arange(x, y) for x, y in zip(low, high) if y > x] or [np.empty(0, np.int64)])
        out = []
        for item in np.unique(self.owner[hits]):
            covered = np.zeros(len(self.words[item]), bool)
            for p in self.place[hits[self.owner[hits] == item]]:
                covered[p : p + SEED] = True
            if covered.sum() >= coverage * len(covered):
                out.append(int(item))
        return out

    def matches(self, text: bytes | None, coverage: float) -> Iterator[tuple[int | None, int, int, int]]:
        """(item, its words, marked words, tiles) for each item whose coverage reaches the threshold."""
        if not text:
            return
        words = tx.hash_words(normal_words(text))
        for n, (whole, ids) in self.short.items():
            for i in np.flatnonzero(np.isin(whole, tx.RollingHash(words).grams(n))):
                yield ids[i], n, n, 1
        if len(words) < SEED or not self.ids:
            return
        for i in self.candidates(words, coverage):
            tiles = tile(words, self.words[i])
            marked = sum(n for _, _, n in tiles)
            if marked >= coverage * len(self.words[i]):
                yield self.ids[i], len(self.words[i]), marked, len(tiles)


def shards(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> Iterator[Shard]:
    """The benchmark in parts of about ``shard_words`` words, one at a time on the driver.

    Bytes stand for words in the estimate (a word has one byte at least, and a blank after it).
    """
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // (2 * shard_words)))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        some = rows if n == 1 else rows.where(part == i)
        yield Shard([(r.item_id, r.text.encode() if r.text is not None else None) for r in some.collect()])


def find_contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """A row for each document and item whose coverage reaches the threshold."""
    spark = docs.sparkSession
    rows = tx.text_rows(docs, id_col, text_col)
    ddl = "doc_id long, item_id long, item_words long, covered_words long, tiles long"
    out = None
    for shard in shards(benchmark, shard_words=shard_words):
        shared = spark.sparkContext.broadcast(shard)

        def run(batch: pa.RecordBatch, shared=shared) -> dict:
            found = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), tx.binary(batch.column(1))) for m in shared.value.matches(t, coverage)]
            return dict(zip(("doc_id", "item_id", "item_words", "covered_words", "tiles"), map(list, zip(*found)) if found else [[]] * 5))

        part = tx.map_batches(rows, run, ddl)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("coverage", F.col("covered_words") / F.col("item_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents in which no item reaches the coverage, with all their columns."""
    place, schema = docs.columns.index(text_col), docs.schema
    for shard in shards(benchmark, shard_words=shard_words):
        shared = docs.sparkSession.sparkContext.broadcast(shard)

        def run(batches, shared=shared):
            for batch in batches:
                texts = tx.binary(batch.column(place).cast(pa.string()))
                yield batch.filter(pa.array([next(shared.value.matches(t, coverage), None) is None for t in texts], pa.bool_()))

        docs = tx.map_arrow(docs, run, schema)
    return docs


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
