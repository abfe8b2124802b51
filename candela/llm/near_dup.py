"""Operator 3: near-duplicates by an inverted join on MinHash coordinates.

1. A document is its set of word shingles. Documents with one set are one class,
   and go on as one.
2. A class is posted under each coordinate and value of its MinHash signature.
   Two sets of the wanted similarity agree on ``least_matches`` of the COORDINATES or
   more (they agree on fewer with a chance of MISS at most; 13 and 2e-7 at a similarity
   of 0.8), so they share one at least of the COORDINATES - matches + 1 rarest postings of
   either: only that prefix is posted, and a value that no other class has is left out.
3. Within a posting list collisions are counted: the long lists beyond the
   prefix are not merged but skipped to, by comparing signatures, and a pair
   holds with that many collisions. A list gives no pairs, only edges that span
   what hangs together by such pairs; their components are the groups.
4. In a group all pairs that still lie in different components and hold as many
   collisions are confirmed on the full sets. The links span the components.

Groups beyond GROUP_BYTES are dealt in blocks and every pair of blocks meets in
one task, so memory is bounded at any group size, and no link is lost.

Null or empty texts and texts without words have an empty set: they link with
nothing. Repeated rows fall into one class. A null doc_id counts in links but is
nobody's component id unless all of its component are null; it is kept if so.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candela.llm import text as tx
from candela.llm.components import components

COORDINATES = 32
#: Chance allowed that a pair of just the wanted similarity has too few collisions.
MISS = 1e-6
#: Bytes of shingle hashes that a block of a group holds.
GROUP_BYTES = 48 << 20

_RANDOM = np.random.default_rng(20240607)
#: Odd multipliers of the hash functions; fixed by the seed.
MULTIPLIERS = _RANDOM.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * tx.U64(2) + tx.U64(1)


def least_matches(percent: int) -> int:
    """Collisions that two sets of this similarity have but for a chance of MISS, by the binomial law."""
    p, below = percent / 100, 0.0
    for n in range(COORDINATES + 1):
        below += math.comb(COORDINATES, n) * p**n * (1 - p) ** (COORDINATES - n)
        if below > MISS:
            break
    if not 0 < n or not 0 < percent <= 100:
        raise ValueError(f"{COORDINATES} coordinates miss pairs of {percent} percent with a chance over {MISS}")
    return n


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Hashes of the distinct shingles, ascending. Fewer words than ``size``: the whole sequence as one."""
    tokens = tx.lower_words(text)
    if not tokens:
        return np.empty(0, tx.U64)
    rolled = tx.RollingHash(tx.hash_words(tokens))
    grams = rolled.grams(size)
    return np.unique(grams) if len(grams) else rolled.slices(np.zeros(1, np.int64), np.array([len(tokens)]))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of COORDINATES minima for each set; none may be empty."""
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), COORDINATES), tx.U64)
    for c in range(COORDINATES):
        x = flat * MULTIPLIERS[c]
        x ^= x >> tx.U64(29)
        x *= MULTIPLIERS[c]
        out[:, c] = np.minimum.reduceat(x, starts)
    return out


def sketch(rows: DataFrame, size: int) -> DataFrame:
    """doc_id, doc_key, n_shingles, ``class`` (fingerprint of the set) and its signature, both null for an empty set."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = tx.binary(batch.column("text"))
        at = 0
        while at < len(texts):
            sets, end, held = [], at, 0
            while end < len(texts) and held < 2_000_000:
                sets.append(shingle_set(texts[end], size))
                held += len(sets[-1])
                end += 1
            full = [s for s in sets if len(s)]
            rows_of = iter(signatures(full).view(np.int64).tolist() if full else [])
            yield {
                "doc_id": batch.column("doc_id").slice(at, end - at),
                "doc_key": batch.column("doc_key").slice(at, end - at),
                "n_shingles": [len(s) for s in sets],
                "class": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "signature": [next(rows_of) if len(s) else None for s in sets],
            }
            at = end

    return tx.map_batches(rows, run, "doc_id long, doc_key long, n_shingles long, class binary, signature array<long>")


def spanning_edges(signature: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Edges that span the components of pairs with ``least`` collisions: each new member looks at those not yet reached."""
    left = np.arange(len(signature))
    edges: list[tuple[int, int]] = []
    while len(left) > 1:
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            hit = (signature[left] == signature[x]).sum(axis=1) >= least
            if hit.any():
                found = left[hit]
                edges.extend((x, int(y)) for y in found)
                frontier.extend(int(y) for y in found)
                left = left[~hit]
    return edges


def collisions(classes: DataFrame, least: int) -> DataFrame:
    """Edges (a, b) between classes that span all pairs with ``least`` collisions. ``classes``: class, signature."""
    posted = classes.select("class", "signature", F.posexplode("signature").alias("coordinate", "value"))
    key = F.xxhash64("coordinate", "value").alias("posting")
    lists = posted.select("class", key).groupBy("posting").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    own = posted.select("class", key).join(lists, "posting")
    # A value that no other class has is rarer than all others: with a whole prefix of them a class has no pair.
    ranked = own.withColumn("rank", F.row_number().over(Window.partitionBy("class").orderBy("length", "posting"))).withColumn("shared", F.count(F.lit(1)).over(Window.partitionBy("class")))
    prefix = ranked.where(F.col("rank") <= F.col("shared") - F.lit(least - 1)).select("class", "posting")
    # Eight bits of each coordinate are enough to count collisions; they only ever add some.
    bits = F.transform("signature", lambda v: (F.pmod(v, F.lit(251)) - 125).cast("tinyint"))
    members = prefix.join(classes.select("class", bits.alias("bits")), "class").select("posting", "class", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in tx.groups(batches):
            names = [c for p in parts for c in p.column(1).to_pylist()]
            if len(names) < 2:
                continue
            seen = np.concatenate([p.column(2).flatten().to_numpy() for p in parts]).reshape(len(names), COORDINATES)
            edges = spanning_edges(seen, least)
            if edges:
                yield pa.RecordBatch.from_pydict({"a": [names[i] for i, _ in edges], "b": [names[j] for _, j in edges]})

    ordered = members.repartition("posting").sortWithinPartitions("posting")
    return tx.map_arrow(ordered, run, "a binary, b binary")


class Links:
    """Union-find over the members of a group; confirms pairs on their sets."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes = np.array([len(s) for s in sets])
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        values, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.distinct = len(values)
        self.signature = signatures(sets)
        self.percent, self.least = percent, least_matches(percent)

    def of(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of the others that are linked to x."""
        a, b = self.sizes[x], self.sizes[others]
        others = others[100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)]
        if len(others):
            others = others[(self.signature[others] == self.signature[x]).sum(axis=1) >= self.least]
        if not len(others):
            return others
        mine = np.zeros(self.distinct, bool)
        mine[self.flat[self.starts[x] : self.starts[x + 1]]] = True
        spans = [self.flat[self.starts[y] : self.starts[y + 1]] for y in others]
        both = np.add.reduceat(mine[np.concatenate(spans)].astype(np.int64), np.concatenate(([0], np.cumsum(self.sizes[others])[:-1])))
        return others[100 * both >= self.percent * (a + self.sizes[others] - both)]

    def spanning(self) -> Iterator[tuple[int, int]]:
        left = np.arange(len(self.sizes))
        while len(left) > 1:
            frontier, left = [int(left[0])], left[1:]
            while frontier and len(left):
                x = frontier.pop()
                found = self.of(x, left)
                if len(found):
                    yield from ((x, int(y)) for y in found)
                    frontier.extend(int(y) for y in found)
                    left = np.setdiff1d(left, found, assume_unique=True)


def confirm(rows: DataFrame, classes: DataFrame, groups: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between classes, confirmed on their full sets, that span the components within each group.

    ``rows``: doc_id, text; ``classes``: class, doc_key (one document of the class), n_shingles;
    ``groups``: node, component.
    """
    total = Window.partitionBy("group")
    wanted = groups.select(F.col("node").alias("class"), F.col("component").alias("group")).join(classes.select("class", "doc_key", "n_shingles"), "class")
    wanted = wanted.withColumn("blocks", F.ceil(F.sum("n_shingles").over(total) * 8 / F.lit(GROUP_BYTES)).cast("int"))
    wanted = wanted.withColumn("block", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("class"), F.col("blocks"))).otherwise(F.lit(0)).cast("int"))
    texts = rows.select("doc_key", "text").join(wanted, "doc_key")

    def sets(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            yield {n: part.column(n) for n in ("group", "class", "blocks", "block")} | {"shingles": [shingle_set(t, size).tobytes() for t in tx.binary(part.column("text"))]}

    held = tx.map_batches(texts.select("text", "group", "class", "blocks", "block"), sets, "group binary, class binary, blocks int, block int, shingles binary")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    met = held.select(F.explode(pair).alias("pair"), "group", "class", "shingles").select(F.xxhash64("group", "pair").alias("task"), "class", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in tx.groups(batches):
            members = dict(zip((c for p in parts for c in p.column(1).to_pylist()), (s for p in parts for s in p.column(2).to_pylist())))
            if len(members) < 2:
                continue
            names = list(members)
            links = list(Links([np.frombuffer(members[n], tx.U64) for n in names], percent).spanning())
            if links:
                yield pa.RecordBatch.from_pydict({"a": [names[i] for i, _ in links], "b": [names[j] for _, j in links]})

    ordered = met.repartition("task").sortWithinPartitions("task")
    return tx.map_arrow(ordered, run, "a binary, b binary")


def label(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """doc_id, doc_key, n_shingles, ``component`` (a class, null for an empty set) and component_id of each document."""
    rows = tx.keyed_rows(docs, id_col, text_col).withColumnRenamed("_key", "doc_key")
    sketched = tx.write_table(sketch(rows, size), "sketch")
    found = sketched.where("class is not null")
    per_class = found.groupBy("class").agg(F.min("doc_id").alias("first_id"), F.min("doc_key").alias("doc_key"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    classes = tx.write_table(per_class, "classes")
    groups = components(collisions(classes.select("class", "signature"), least_matches(percent)))
    links = components(confirm(rows, classes, groups, size, percent))
    linked = classes.select("class", "first_id").join(links.select(F.col("node").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = linked.select("class", "component").join(smallest, "component")
    out = sketched.select("doc_id", "doc_key", "n_shingles", "class").join(named, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "doc_key", "n_shingles", "component", own.alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each document.

    Links two documents if 100 * |intersection| >= percent * |union| of their sets of ``size``-word shingles.
    A percent that the coordinates don't carry (under 36) is an error.
    """
    out = label(docs, id_col, text_col, size, percent)
    return out.select("doc_id", "n_shingles", "component_id").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all its columns: the one of the smallest id. Documents without words stay."""
    labelled = tx.write_table(label(docs, id_col, text_col, size, percent), "labelled")
    first = labelled.where("component is not null").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "doc_key")).alias("first"))
    stays = first.select(F.col("first.doc_key").alias("_stays")).unionByName(labelled.where("component is null").select(F.col("doc_key").alias("_stays")).distinct())
    columns = docs.columns
    name = "_doc_key"
    while name in columns:
        name += "_"
    key = F.xxhash64(F.col(id_col).cast("long").cast("string"), F.lit("|"), F.col(text_col).cast("string"))
    kept = docs.withColumn(name, key).join(stays.withColumnRenamed("_stays", name), name, "left_semi")
    repeated = labelled.where("component is not null").groupBy("doc_key").count().where("count > 1")
    if not repeated.isEmpty():  # of rows with one id and text, the first by the JSON of all columns stays, in any run
        twice = repeated.select(F.col("doc_key").alias(name))
        row = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
        chosen = kept.join(twice, name, "left_semi").groupBy(name).agg(F.min_by(row, F.to_json(row)).alias("row"))
        several = chosen.select(name, *(F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)))
        kept = kept.join(twice, name, "left_anti").unionByName(several)
    return kept.select(*(F.col(f"`{c}`") for c in columns))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
