"""Operator 11: hard negatives by tiled integer products and mergeable heaps.

1. Vectors become whole numbers, floor(scale * x), and are written once with a
   key for each row, so that equal rows stay two.
2. Anchors are dealt in blocks of ANCHORS rows, candidates in blocks of
   CANDIDATES rows, and every block of anchors meets every block of candidates
   in one task: the stated query set against all rows, in blocks.
3. A tile of scores is a product of two int64 matrices by Strassen's recursion,
   odd sides padded with zeros, seven products instead of eight at each level.
   Additions are exact: integers modulo 2**64 are a ring, so only a score
   itself has to fit a long. A task whose scores might not raises OverflowError.
4. First pass: rows of the anchor's own label go into its heap of positives.
   Second pass: for each positive, rows of other labels whose score lies in its
   window go into the window's heap. A heap keeps its k best entries and two heaps
   merge by keeping the k best of both, so tiles, tasks and blocks may be merged
   in any order; Spark merges those of the tasks by the same order.

Higher scores come first, equal ones by smaller id, null ids last, then by key.

Rows with a null label, a null vector or a null or non-finite component take no
part. A vector shorter than another counts as filled up with zeros, an empty one
scores 0 with all. Null ids are candidates; they are anchors only if the anchor
condition is true for them. A row that is in the table twice is two rows: each is a
candidate for the other. Without anchors, positives or rows in a window there are no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candela.llm import text as tx

#: Rows of a block. A task holds one block of each, and multiplies tiles of them.
ANCHORS, CANDIDATES = 4096, 4096
TILE = 512
#: Sides up to which a product is taken plainly.
LEAF = 32


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices, modulo 2**64."""
    (m, k), n = a.shape, b.shape[0]
    if min(m, k, n) <= LEAF:
        return np.einsum("ik,jk->ij", a, b)
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, n % 2), (0, k % 2)))
        return strassen(a, b)[:m, :n]
    i, j, h = m // 2, n // 2, k // 2
    a11, a12, a21, a22 = a[:i, :h], a[:i, h:], a[i:, :h], a[i:, h:]
    b11, b21, b12, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]  # of the transposed right side
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((m, n), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out


def fits(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all scores certainly fit a long."""
    if not a.size or not b.size:
        return True
    high = [np.abs(x.astype(float)) for x in (a, b)]
    if high[0].max() * high[1].max() * a.shape[1] < 2.0**62:
        return True
    return float((high[0] @ high[1].T).max()) < 2.0**63 * (1 - 1e-9)


class Heaps:
    """The k best entries of each owner: by score descending, then by place. ``add`` merges."""

    def __init__(self, k: int):
        self.k = k
        self.owner = self.place = self.score = np.empty(0, np.int64)

    def add(self, owner: np.ndarray, place: np.ndarray, score: np.ndarray) -> None:
        owner, place, score = (np.concatenate(x) for x in ((self.owner, owner), (self.place, place), (self.score, score)))
        order = np.lexsort((place, ~score, owner))
        owner = owner[order]
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else owner
        rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        kept = rank < self.k
        self.owner, self.place, self.score = owner[kept], place[order][kept], score[order][kept]

    def add_tile(self, owners: np.ndarray, places: np.ndarray, scores: np.ndarray, allowed: np.ndarray) -> None:
        """A tile's allowed entries. Places ascend; entries below a row's k-th of the tile needn't be sorted."""
        if scores.shape[1] > self.k:
            held = np.where(allowed, scores, np.iinfo(np.int64).min)
            at = scores.shape[1] - self.k
            allowed = allowed & (scores >= np.partition(held, at, axis=1)[:, at : at + 1])
        rows, columns = np.nonzero(allowed)
        self.add(owners[rows], places[columns], scores[rows, columns])


def windows(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest n with low * positive <= 100 * n <= high * positive."""
    def part(share: int, up: int) -> np.ndarray:
        whole, rest = np.divmod(positive, 100)
        return share * whole + (share * rest + up) // 100

    return part(low, 99), part(high, 0)


class Block:
    """Rows of one block, ordered by id (nulls last) and key."""

    def __init__(self, table: pa.Table, width: int | None = None):
        known = np.array(table.column("id").is_valid())
        ids = np.array(table.column("id").fill_null(0))
        key = np.array(table.column("key"))
        order = np.lexsort((key, ids, ~known))
        table = table.take(pa.array(order))
        self.table, self.key, self.ids = table, key[order], table.column("id")
        self.label = np.array(table.column("label"))
        lists = table.column("vector").combine_chunks()
        lengths = np.array(lists.value_lengths(), dtype=np.int64)
        self.width = int(lengths.max(initial=0))
        self.values, self.lengths = np.array(lists.flatten(), dtype=np.int64), lengths

    def matrix(self, width: int) -> np.ndarray:
        out = np.zeros((len(self.lengths), width), np.int64)
        out[np.arange(width) < self.lengths[:, None]] = self.values
        return out


def _matrices(left: Block, right: Block) -> tuple[np.ndarray, np.ndarray]:
    width = max(left.width, right.width)
    a, b = left.matrix(width), right.matrix(width)
    if not fits(a, b):
        raise OverflowError("an inner product of two vectors doesn't fit 64 bits: choose a smaller scale")
    return a, b


def _tiles(n: int) -> list[slice]:
    return [slice(i, min(n, i + TILE)) for i in range(0, n, TILE)]


POSITIVES = "key long, score long, positive_id long, positive_key long"
NEGATIVES = "key long, anchor_id long, slot int, positive_id long, positive_score long, score long, negative_id long, negative_key long"


def positives_of(k: int):
    """A task of the first pass: the positive heaps of a block of anchors against a block of candidates."""
    schema = tx.arrow_schema(POSITIVES)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        anchors, rows = Block(left), Block(right)
        a, b = _matrices(anchors, rows)
        heaps = Heaps(k)
        for label in np.intersect1d(anchors.label, rows.label):
            mine, own = np.flatnonzero(anchors.label == label), np.flatnonzero(rows.label == label)
            for s in _tiles(len(mine)):
                for t in _tiles(len(own)):
                    other = anchors.key[mine[s]][:, None] != rows.key[own[t]][None, :]
                    heaps.add_tile(mine[s], own[t], strassen(a[mine[s]], b[own[t]]), other)
        return pa.table([
            pa.array(anchors.key[heaps.owner]), pa.array(heaps.score),
            rows.ids.take(pa.array(heaps.place)), pa.array(rows.key[heaps.place]),
        ], schema=schema)

    return run


def negatives_of(k: int, low: int, high: int):
    """A task of the second pass: the window heaps of a block of anchors against a block of candidates."""
    schema = tx.arrow_schema(NEGATIVES)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        anchors, rows = Block(left), Block(right)
        a, b = _matrices(anchors, rows)
        lists = anchors.table.column("positives").combine_chunks()
        found = np.array(lists.value_lengths(), dtype=np.int64)
        flat = lists.flatten()
        slots, scores = np.array(flat.field("slot")), np.array(flat.field("score"))
        first = np.concatenate(([0], np.cumsum(found)))
        least, most = windows(scores, low, high)
        heaps = Heaps(k)
        for s in _tiles(len(a)):
            for t in _tiles(len(b)):
                tile = strassen(a[s], b[t])
                differs = anchors.label[s, None] != rows.label[None, t]
                for slot in range(int(found[s].max())):
                    has = np.flatnonzero(found[s] > slot)
                    entry = first[s.start + has] + slot
                    allowed = differs[has] & (tile[has] >= least[entry, None]) & (tile[has] <= most[entry, None])
                    heaps.add_tile(entry, np.arange(t.start, t.stop), tile[has], allowed)
        at = np.repeat(np.arange(len(a)), found)[heaps.owner]
        return pa.table([
            pa.array(anchors.key[at]), anchors.ids.take(pa.array(at)), pa.array(slots[heaps.owner]),
            flat.field("id").take(pa.array(heaps.owner)), pa.array(scores[heaps.owner]),
            pa.array(heaps.score), rows.ids.take(pa.array(heaps.place)), pa.array(rows.key[heaps.place]),
        ], schema=schema)

    return run


def whole_vectors(df: DataFrame, anchor: Column, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(key, id, label, vector, anchor) of the rows that take part, written once."""
    x = F.col("x")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("x"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).filter(F.col("label").isNotNull() & sound)
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))))
    return tx.write_table(rows.select(F.monotonically_increasing_id().alias("key"), "id", "label", whole.alias("vector"), "anchor"), "vectors")


def hard_negatives(df: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """For each anchor and each of its best ``positives``: the best ``negatives`` of other labels whose score is
    between ``low`` and ``high`` per cent of the positive's. ``anchor`` is a condition on ``df``'s columns."""
    spark = df.sparkSession
    tx.ship(spark)
    rows = whole_vectors(df, anchor, id_col, label_col, vector_col, scale)
    size = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    many, blocks = max(1, math.ceil(size.anchors / ANCHORS)), max(1, math.ceil(size.rows / CANDIDATES))

    def dealt(of: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        """Each row in one of its own ``n`` blocks, once for each of the other side's ``m``."""
        placed = of.withColumn(own, F.pmod(F.xxhash64("key"), F.lit(n)).cast("long"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))).drop("anchor")

    candidates = dealt(rows, "b", blocks, "g", many).groupBy("g", "b")
    anchors = rows.filter("anchor")

    def met(left: DataFrame, run, schema: str) -> DataFrame:
        return dealt(left, "g", many, "b", blocks).groupBy("g", "b").cogroup(candidates).applyInArrow(run, schema)

    def merged(found: DataFrame, owner: list[str], k: int, rank: str) -> DataFrame:
        other = "positive" if rank == "slot" else "negative"
        best = Window.partitionBy(*owner).orderBy(F.desc("score"), F.asc_nulls_last(f"{other}_id"), f"{other}_key")
        return found.withColumn(rank, F.row_number().over(best)).filter(F.col(rank) <= k)

    heaps = merged(met(anchors, positives_of(positives), POSITIVES), ["key"], positives, "slot")
    lists = heaps.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("slot", F.col("positive_id").alias("id"), "score"))).alias("positives"))
    lists = tx.write_table(lists, "positives")
    with_lists = anchors.join(lists, "key").select(*[F.col(c).alias(c) for c in [*anchors.columns, "positives"]])  # columns of its own
    negative = met(with_lists, negatives_of(negatives, low, high), NEGATIVES)
    return merged(negative, ["key", "slot"], negatives, "rank").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"),
        F.col("slot").alias("positive_rank"), F.col("key").alias("anchor_row"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    df = df.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    found = hard_negatives(df, F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
