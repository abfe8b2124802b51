"""Operator 1: a hierarchical Pitman-Yor language model, sampled in parallel.

Restaurants. Each word is a context with a restaurant of its own; so is the
beginning of a text. All of them share one parent, the restaurant of single
tokens, whose base is uniform over the V training tokens and one for all others.
(``train`` can be told a share of the training tokens that a context must make
up; tokens after rarer words then sit in the parent directly.) Contexts grow with
the corpus: the numbers of customers and tables of each are kept in the bucket of
the context's word, added up there and sent to the buckets that hold a customer
of it; nothing that grows is collected or broadcast.

Files. Texts are split once, into what each block of them asks of each bucket. These
questions are packed and written by bucket; a bucket's customers are read from them,
and they are answered when the model is there. Whoever works on a bucket reads its
files: only totals and sums move between rounds, in an order that both ends know.

Sampling. A bucket holds all customers of its words in all restaurants. A sweep
seats every customer of each (context, word) anew: the number of tables is drawn
from its exact distribution given the customers, where a table of k weighs
(1 - d)(2 - d) ... (k - 1 - d) times a new table's weight, in proportion to the
parent's probability. Tables are the parent's customers, seated likewise. Buckets
run side by side with the totals of the last round; a first round's totals feed
the second, whose samples are averaged. The totals of the averages close the
model, so its probabilities sum to one.

Discounts come from the numbers of pairs and words seen once and twice. Random
numbers depend on the seed, the round and the bucket only: a task that runs again
gives the same seating.

Texts are words, lower-cased (A-Z), and one end. Null and empty texts are just
the end. Repeated rows are scored one by one; a null doc_id counts as an empty id
for the hold-out. An empty table, or one with no training document, gives a model
without customers: every token then has the uniform base's probability.
"""

from __future__ import annotations

import math
import posixpath
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from candela.llm import text as tx

#: Strengths of the context restaurants and of their parent.
STRENGTH = (1.0, 10.0)
BURN_IN = 3
SAMPLES = 4
SEED = 20240609
#: Tokens that a worker gathers before it sorts them, and that a bucket of words stands for.
BLOCK_TOKENS = 1_000_000
BLOCK_DOCS = 60_000
BUCKET_TOKENS = 3_000_000
LEAST_BUCKETS = 12
#: Cells of up to so many customers draw from a table of arrangements; for others it is computed for each, on a path of so many points.
TABULATED = 512
PATH = 192
#: Pairs that a worker seats at a time.
CELLS = 250_000
#: While a table is written: its shuffles are dropped when it is there, and workers get few texts at a time.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "500"}
#: White space is in no word, so this is nobody's hash but the end's.
END = tx.hash_words([b"\n"])[0]
#: Likewise; stands for the context of tokens that sit in the parent directly.
NONE = tx.hash_words([b" "])[0]


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


@dataclass
class Block:
    """Tokens of some documents, one after another, each with its end."""

    ids: list
    sizes: np.ndarray
    tokens: np.ndarray
    held: np.ndarray

    @property
    def training(self) -> np.ndarray:
        return np.repeat(~self.held, self.sizes)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    ids, parts, held = [], [], 0

    def out() -> Block:
        sizes = np.array([len(p) for p in parts])
        return Block(ids, sizes, np.concatenate(parts), np.array([held_out(i) for i in ids]))

    for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
        for doc_id, text in zip(batch.column(0).to_pylist(), tx.binary(batch.column(1))):
            words = tx.lower_words(text)
            parts.append(np.append(tx.hash_words(words), END))
            ids.append(doc_id)
            held += len(words) + 1
            if held >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCS:
                block, ids, parts, held = out(), [], [], 0
                yield block
                del block
    if ids:
        yield out()


def token_counts(rows: DataFrame) -> DataFrame:
    """(word, c): how often each token occurs in the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            words, counts = np.unique(block.tokens[block.training], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], names=["word", "c"])

    return tx.map_arrow(rows, run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def training_tokens(rows: DataFrame) -> int:
    """How many tokens the training documents have."""
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    return rows.where(~held).agg(F.sum((words + 1).cast("long")).alias("n")).first().n or 0


def _bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    return (tx.mix(words) % tx.U64(buckets)).astype(np.int64)


def _place(contexts: np.ndarray, context: np.ndarray) -> np.ndarray:
    """1 + the place of each context in an ascending list; 0 for those that are not in it."""
    if not len(contexts):
        return np.zeros(len(context), np.int64)
    at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
    return np.where(contexts[at] == context, at + 1, 0)


def pack(values: np.ndarray) -> bytes:
    """First bytes of all values, then the second ones and so on, compressed."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T) if len(values) else np.empty(0, np.uint8)
    return planes.size.to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def unpack(data: bytes, kind: str) -> np.ndarray:
    size, item = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not size:
        return np.empty(0, kind)
    planes = np.frombuffer(pa.Codec("zstd").decompress(memoryview(data)[8:], size), np.uint8)
    return np.ascontiguousarray(planes.reshape(item, -1).T).reshape(-1).view(kind)


def pack_ascending(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)).astype(values.dtype.newbyteorder("<")))


def unpack_ascending(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def pack_runs(values: np.ndarray, sizes: np.ndarray) -> bytes:
    """Values that ascend in each of some runs."""
    step = np.diff(values, prepend=0)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    step[starts] = values[starts]
    return pack(step.astype("<u4"))


def unpack_runs(data: bytes, sizes: np.ndarray) -> np.ndarray:
    step = unpack(data, "<u4").astype(np.int64)
    upto = np.cumsum(step)
    some = sizes[sizes > 0]
    starts = np.cumsum(some) - some
    return (upto - np.repeat(upto[starts] - step[starts], some)).astype(np.int32)


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in WRITING}
    try:
        for name, value in WRITING.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def stored(df: DataFrame, name: str) -> str:
    """Writes rows to a folder for each bucket and gives the folder of these; ``rows_of`` reads them where the bucket is worked on."""
    path = tx.output_folder(df.sparkSession, name)
    with writing(df.sparkSession):
        df.write.partitionBy("bucket").option("compression", "uncompressed").parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    with writing(df.sparkSession):
        return tx.write_table(df, name)


def rows_of(folder: str, bucket: int) -> Iterator[dict]:
    """The rows of a bucket that ``stored`` wrote."""
    from pyarrow import fs

    system, path = tx.open_folder(folder)
    found = system.get_file_info(fs.FileSelector(f"{path}/bucket={bucket}", allow_not_found=True))
    for info in sorted(found, key=lambda i: i.path):
        if posixpath.basename(info.path)[0] in "._":
            continue
        with system.open_input_file(info.path) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=4, use_threads=False):
                for row in batch.to_pylist():
                    yield row | {"bucket": bucket}


def row_of(folder: str, bucket: int) -> dict | None:
    return next(rows_of(folder, bucket), None)


def every_bucket(spark: SparkSession, buckets: int) -> DataFrame:
    return spark.range(0, buckets, 1, buckets).select(F.col("id").cast("int").alias("bucket"))


def by_bucket(df: DataFrame, buckets: int, *order: str) -> DataFrame:
    """A task for each bucket, its rows in order."""
    return df.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", *order)


#: Customers of a bucket's words: words in ascending order, pairs of each, the contexts of all (ascending), each pair's place among them and count.
COUNTS = "bucket int, words binary, pairs binary, contexts binary, place binary, count binary"


@dataclass
class Counts:
    """``owner``: the place of each pair's word; pairs are ordered by word and context."""

    words: np.ndarray
    owner: np.ndarray
    contexts: np.ndarray
    place: np.ndarray
    count: np.ndarray

    def row(self, bucket: int) -> dict:
        pairs = np.bincount(self.owner, minlength=len(self.words))
        return {"bucket": bucket, "words": pack_ascending(self.words), "pairs": pack(pairs.astype("<u4")), "contexts": pack_ascending(self.contexts), "place": pack_runs(self.place, pairs), "count": pack(self.count.astype("<i8"))}

    @classmethod
    def of(cls, row: dict) -> Counts:
        words, pairs = unpack_ascending(row["words"], "<u8"), unpack(row["pairs"], "<u4").astype(np.int64)
        return cls(words, np.repeat(np.arange(len(words), dtype=np.int32), pairs), unpack_ascending(row["contexts"], "<u8"), unpack_runs(row["place"], pairs), unpack(row["count"], "<i8"))

    @property
    def placed(self) -> np.ndarray:
        """The contexts that have a restaurant."""
        return self.contexts[self.contexts != NONE]


def _merged(read: list[Counts]) -> Counts:
    """Several as one. Empties the list."""
    words, word = _coded(np.concatenate([r.words for r in read]))
    contexts, context = _coded(np.concatenate([r.contexts for r in read]))
    word_at, context_at = (np.cumsum([0, *map(len, x)]) for x in ([r.words for r in read], [r.contexts for r in read]))
    wide = max(len(contexts), 1)
    key = np.concatenate([word[w : w + len(r.words)][r.owner] * np.int64(wide) + context[c : c + len(r.contexts)][r.place] for w, c, r in zip(word_at, context_at, read)])
    count = np.concatenate([r.count for r in read])
    read.clear()
    order = np.argsort(key, kind="stable")  # runs in order, which are merged
    key = key[order]
    count = count[order]
    del order
    first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
    key, count = key[first], np.add.reduceat(count, first) if len(first) else count
    return Counts(words, (key // wide).astype(np.int32), contexts, (key % wide).astype(np.int32), count)


def _trained(row: dict, frequent: np.ndarray | None) -> Counts:
    """The training tokens among a block's questions; contexts other than ``frequent`` become NONE."""
    q = Question(row)
    count = np.bincount(q.pair, weights=np.where(q.held[q.doc], 0, q.count), minlength=len(q.owner)).astype(np.int64)
    some = count > 0
    owner, place, count = q.owner[some], q.place[some], count[some]
    words, owner = _coded(owner)
    context = q.contexts if frequent is None else np.where(np.isin(q.contexts, frequent), q.contexts, NONE)
    used, place = _coded(place)
    contexts, again = _coded(context[used])
    return Counts(q.words[words], owner, contexts, again[place], count)


def customers(spark: SparkSession, asked: str, frequent, buckets: int) -> DataFrame:
    """The training tokens of stored questions as customers, a row for each bucket of words."""
    schema = tx.arrow_schema(COUNTS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket in batch.column(0).to_pylist():
                levels: list[list[Counts]] = []
                for row in rows_of(asked, bucket):
                    if row["kind"] != 2:
                        continue
                    part, level = _trained(row, frequent.value), 0
                    while True:  # a few at a time: what is held is little more than the result
                        if level == len(levels):
                            levels.append([])
                        levels[level].append(part)
                        if len(levels[level]) < 8:
                            break
                        part, levels[level] = _merged(levels[level]), []
                        level += 1
                left, levels = [c for level in levels for c in level], []
                if left and len((all_ := _merged(left)).words):
                    yield pa.RecordBatch.from_pylist([all_.row(bucket)], schema)

    return tx.map_arrow(every_bucket(spark, buckets), merge, COUNTS)


@dataclass
class Totals:
    """Customers and tables of some contexts (ascending; place 0 is no context), and what all buckets share: those of the parent, and the model's numbers."""

    contexts: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    parent_customers: float
    parent_tables: float
    vocabulary: int
    tokens: int
    discounts: tuple[float, float]

    @property
    def base(self) -> float:
        return 1.0 / (self.vocabulary + 1)

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The parent's probability of words with so many customers and tables there."""
        d, s = self.discounts[1], STRENGTH[1]
        return (customers - d * tables + (s + d * self.parent_tables) * self.base) / (s + self.parent_customers)

    @property
    def back_off(self) -> np.ndarray:
        """Each context's weight of the parent; 1 for place 0, which stands for no context."""
        d, s = self.discounts[0], STRENGTH[0]
        out = (s + d * self.tables) / (s + self.customers)
        out[0] = 1.0
        return out


@lru_cache(4)
def _arrangements(discount: float) -> list[np.ndarray]:
    """For n customers, the log of the number of seatings at 1, 2, ... n tables, each weighted by (1 - d)(2 - d) ... of its sizes."""
    out = [np.empty(0), np.zeros(1)]
    for n in range(1, TABULATED):
        stay = np.append(out[n] + np.log(n - discount * np.arange(1, n + 1)), -np.inf)
        out.append(np.logaddexp(stay, np.append(-np.inf, out[n])))
    return out


def _few_tables(n: int, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Draws for cells of n customers each, n up to TABULATED."""
    ways, t, out = _arrangements(discount)[n], np.arange(1, n + 1), np.empty(len(weight), np.int64)
    step = max(1, (1 << 20) // n)
    for at in range(0, len(weight), step):
        odds = ways + np.log(weight[at : at + step, None]) * t
        upto = np.cumsum(np.exp(odds - odds.max(1, keepdims=True)), axis=1)
        out[at : at + step] = 1 + (upto[:, :-1] < rng.random((len(upto), 1)) * upto[:, -1:]).sum(1)
    return out


def table_odds(n: int, weight: float, discount: float) -> tuple[int, np.ndarray]:
    """(t, probabilities of t, t + 1, ...) of a cell of many customers; they are within 1e-6 of the exact ones.

    With m = weight / d, tables are m^t / t! times the chance that t sizes of
    the law q(k) = d (1 - d) ... (k - 1 - d) / k! add up to n. That chance is the
    coefficient of z^n in (1 - (1 - z)^d)^t, an integral over z = exp(-y) on a path
    that crosses the real axis near the saddle: the vertical line where that
    decays at once, else a hyperbola around the cut of negative y.
    """
    d, m = discount, weight / discount
    low, high = -80.0, 80.0  # of log y: n customers are expected if sizes are weighted by exp(-y k)
    for _ in range(60):
        mid = (low + high) / 2
        y = math.exp(mid)
        if math.log(m * d) - y + (d - 1) * math.log(-math.expm1(-y)) > math.log(n):
            low = mid
        else:
            high = mid
    cross = max(math.exp(low), 1.0 / n)
    share = -math.expm1(d * math.log(-math.expm1(-cross)))
    mean = m * share
    if n * cross > 100:
        r = math.exp(-cross)
        spread = math.sqrt(n * (1 + (1 - d) * r / (1 - r)))  # of the sum, for a free number of tables
        spread = min(spread, math.sqrt(max(n * (1 + (1 - d) * r / (1 - r)) - n * n / mean, 0.25)))
        u, step = np.linspace(0.0, min(math.pi, 12.0 / spread), PATH, retstep=True)
        y, slope = cross + 1j * u, np.full(PATH, 1j)
    else:
        tilt = math.radians(20)
        u, step = np.linspace(0.0, math.acosh(1.0 + 160.0 / (n * cross)) + 1.0, PATH, retstep=True)
        scale = cross / (1 - math.sin(tilt))
        y = scale * (1 - math.sin(tilt) * np.cosh(u) + 1j * math.cos(tilt) * np.sinh(u))
        slope = scale * (1j * math.cos(tilt) * np.cosh(u) - math.sin(tilt) * np.sinh(u))
    slope[0] /= 2
    if n * cross > 100 and u[-1] == math.pi:
        slope[-1] /= 2
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        log_f = np.log(1 - np.exp(d * np.log(-np.expm1(-y)))) - math.log(share)
    half = 7.5 * math.sqrt(mean) + 20.0
    first, last = max(1, int(mean - half)), min(n, int(mean + half) + 1)
    chance = np.empty(last - first + 1)
    for at in range(first, last + 1, 2048):
        t = np.arange(at, min(at + 2048, last + 1))
        power = np.empty((len(t), PATH), complex)
        power[0], power[1:] = np.exp(at * log_f + n * (y - cross)) * slope, np.exp(log_f)
        chance[at - first : at - first + len(t)] = np.multiply.accumulate(power, axis=0).imag.sum(1) * step
    t = np.arange(first, last + 1)
    odds = t * math.log(mean) - np.cumsum(np.log(t)) + np.log(np.maximum(chance, 1e-300))
    odds = np.exp(odds - odds.max())
    return first, odds / odds.sum()


def _alike(customers: np.ndarray) -> list[np.ndarray]:
    """Cells of two or more customers, by their number."""
    some = np.flatnonzero(customers > 1)
    order = some[np.argsort(customers[some], kind="stable")]
    return np.split(order, np.flatnonzero(np.diff(customers[order])) + 1) if len(order) else []


def draw_tables(customers: np.ndarray, alike: list[np.ndarray], weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of cells, each from its exact distribution given its customers and its ``weight`` of a new table."""
    tables = np.minimum(customers, 1)
    for cells in alike:
        n = int(customers[cells[0]])
        if n <= TABULATED:
            tables[cells] = _few_tables(n, weight[cells], discount, rng)
            continue
        for cell in cells:
            first, odds = table_odds(n, float(weight[cell]), discount)
            tables[cell] = first + min(int(np.searchsorted(np.cumsum(odds), rng.random(), "right")), len(odds) - 1)
    return tables


class Seating:
    """Customers and tables of cells (a word in a restaurant).

    Given the tables of a cell, the sizes matter to nothing else: they are
    integrated out, and in the books all but one table have one customer.
    """

    def __init__(self, customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator):
        """Seats all customers. ``weight``: of a new table in each cell."""
        self.customers, self.discount, self.rng = customers, discount, rng
        self.alike = _alike(customers)
        self.sweep(weight)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.customers)), self.tables)

    @property
    def sizes(self) -> np.ndarray:
        out = np.ones(int(self.tables.sum()), np.int64)
        some = self.tables > 0
        out[(np.cumsum(self.tables) - self.tables)[some]] += (self.customers - self.tables)[some]
        return out

    def resize(self, customers: np.ndarray) -> None:
        """The parent's cells follow their children."""
        self.customers, self.alike = customers, _alike(customers)
        self.tables = np.clip(self.tables, np.minimum(customers, 1), customers)

    def sweep(self, weight: np.ndarray) -> None:
        """All customers of every cell leave and are seated again."""
        self.tables = draw_tables(self.customers, self.alike, weight, self.discount, self.rng)


def sample(words: np.ndarray, owner: np.ndarray, context: np.ndarray, count: np.ndarray, totals: Totals, rng: np.random.Generator, samples: int) -> tuple[np.ndarray, ...]:
    """Averages over the samples: tables of each pair (``context``: its place in the totals), and the parent's customers and tables of each word."""
    placed = context > 0
    direct = np.bincount(owner[~placed], weights=count[~placed], minlength=len(words)).astype(np.int64)
    (d, d_parent), (s, s_parent) = totals.discounts, STRENGTH
    parent_weight = np.full(len(words), (s_parent + d_parent * totals.parent_tables) * totals.base)
    parent_customers = direct + np.bincount(owner[placed], minlength=len(words))
    parent_p = totals.parent(parent_customers, np.minimum(parent_customers, 1))
    some = np.flatnonzero(placed & (count > 1))  # the others have one customer and one table, or sit in the parent
    always = direct + np.bincount(owner[placed & (count == 1)], minlength=len(words))
    cell_owner, room = owner[some], (s + d * totals.tables)[context[some]]
    pairs = Seating(count[some], room * parent_p[cell_owner], d, rng)
    parent_customers = always + np.bincount(cell_owner, weights=pairs.tables, minlength=len(words)).astype(np.int64)
    parent = Seating(parent_customers, parent_weight, d_parent, rng)
    sums = [np.zeros(len(some)), np.zeros(len(words)), np.zeros(len(words))]
    for step in range(BURN_IN + samples):
        parent_p = totals.parent(parent_customers, parent.tables)
        pairs.sweep(room * parent_p[cell_owner])
        tables = pairs.tables
        parent_customers = always + np.bincount(cell_owner, weights=tables, minlength=len(words)).astype(np.int64)
        parent.resize(parent_customers)
        parent.sweep(parent_weight)
        if step >= BURN_IN:
            for total, now in zip(sums, (tables, parent_customers, parent.tables)):
                total += now
    out = placed.astype(float)
    out[some] = sums[0] / samples
    return out, sums[1] / samples, sums[2] / samples


#: What the model adds to a bucket's customers: each pair's tables, and each word's customers and tables in the parent.
SEATS = "bucket int, tables binary, parent_customers binary, parent_tables binary"
#: Contexts of bucket ``bucket`` that bucket ``source`` has customers of.
LINKS = "bucket long, source int, contexts binary, customers binary"
#: A bucket's contexts (ascending), the customers of each, and which of them each source has: sources, contexts of each, their places.
BOOKS = "bucket int, contexts binary, customers binary, sources binary, sizes binary, places binary"
#: Customers and tables of a source's contexts, by the bucket ``home`` of these, in their order there. Home -1: nothing, or all of a bucket's own contexts.
TOTALS = "bucket int, home int, customers binary, tables binary"


def _homes(contexts: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """The buckets of some contexts, in order, and the places of the contexts of each."""
    home = _bucket(contexts, buckets)
    order = np.argsort(home, kind="stable")
    return [(int(home[mine[0]]), mine) for mine in np.split(order, np.flatnonzero(np.diff(home[order])) + 1)] if len(order) else []


def books(spark: SparkSession, counted: str, buckets: int) -> DataFrame:
    """The contexts of each bucket and who has customers of them; the rounds then send numbers in this order, without the contexts."""
    links, schema = tx.arrow_schema(LINKS), tx.arrow_schema(BOOKS)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket in batch.column(0).to_pylist():
                for row in rows_of(counted, bucket):
                    counts = Counts.of(row)
                    customers = np.bincount(counts.place, weights=counts.count, minlength=len(counts.contexts))[counts.contexts != NONE]
                    contexts = counts.placed
                    out = [{"bucket": home, "source": bucket, "contexts": pack_ascending(contexts[mine]), "customers": pack(customers[mine].astype("<i8"))} for home, mine in _homes(contexts, buckets)]
                    yield pa.RecordBatch.from_pylist(out, links)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in tx.groups(batches):
            rows = [row for p in parts for row in p.to_pylist()]
            read = [unpack_ascending(row["contexts"], "<u8") for row in rows]
            sizes = np.array([len(r) for r in read])
            names, place = np.unique(np.concatenate(read), return_inverse=True)
            customers = np.bincount(place, weights=np.concatenate([unpack(row["customers"], "<i8") for row in rows]))
            yield pa.RecordBatch.from_pylist([{
                "bucket": rows[0]["bucket"], "contexts": pack_ascending(names), "customers": pack(customers.astype("<i8")), "sources": pack(np.array([row["source"] for row in rows], "<u4")),
                "sizes": pack(sizes.astype("<u4")), "places": pack_runs(place, sizes),
            }], schema)

    sent = tx.map_arrow(every_bucket(spark, buckets), link, LINKS)
    return tx.map_arrow(by_bucket(sent, buckets, "source"), gather, BOOKS)


def _local(parts: list[dict], contexts: np.ndarray, shared: Totals, buckets: int) -> Totals:
    """``shared`` with ``contexts``, those of one bucket's customers, from what their homes sent."""
    read = {p["home"]: (unpack(p["customers"], "<i8"), unpack(p["tables"], "<f8")) for p in parts if p["home"] >= 0}
    customers, tables = np.zeros(len(contexts) + 1), np.zeros(len(contexts) + 1)
    for home, mine in _homes(contexts, buckets):
        customers[mine + 1], tables[mine + 1] = read[home]
    return replace(shared, contexts=contexts, customers=customers, tables=tables)


def _word_ranges(owner: np.ndarray, words: int) -> Iterator[tuple[slice, slice]]:
    """Words that have about CELLS pairs together, and their pairs."""
    upto = np.searchsorted(owner, np.arange(words + 1))
    at = 0
    while at < words:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + CELLS, "right")) - 1)
        yield slice(at, end), slice(int(upto[at]), int(upto[end]))
        at = end


def seat(spark: SparkSession, counted: str, booked: str, sums: DataFrame, totals: Totals, buckets: int, round_: int, samples: int, only_sums: bool = False) -> DataFrame:
    """The model, or only its sums, made by the workers that seat it."""
    shared = spark.sparkContext.broadcast(totals)
    schema = tx.arrow_schema(SUMS if only_sums else SEATS)
    met = context_totals(sums, booked, buckets).unionByName(every_bucket(spark, buckets).withColumn("home", F.lit(-1)), allowMissingColumns=True)
    met = by_bucket(met, buckets, "home").withColumn("bucket", F.col("bucket").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in tx.groups(batches):
            bucket = parts[0].column(0)[0].as_py()
            row = row_of(counted, bucket)
            if row is None:
                continue
            counts = Counts.of(row)
            rng = np.random.default_rng([SEED, round_, bucket])
            local = _local([r for p in parts for r in p.to_pylist()], counts.placed, shared.value, buckets)
            context = _place(local.contexts, counts.contexts)
            found = [np.zeros(len(counts.owner), "<f4"), np.zeros(len(counts.words)), np.zeros(len(counts.words))]
            for mine, pairs in _word_ranges(counts.owner, len(counts.words)):  # words are seated independently of one another
                part = sample(counts.words[mine], counts.owner[pairs] - mine.start, context[counts.place[pairs]], counts.count[pairs], local, rng, samples)
                for all_, at, x in zip(found, (pairs, mine, mine), part):
                    all_[at] = x
            if only_sums:
                yield pa.RecordBatch.from_pylist(_sum_rows(bucket, counts, found, buckets), schema)
            else:
                yield pa.RecordBatch.from_pylist([{"bucket": bucket} | {n: pack(x) for n, x in zip(("tables", "parent_customers", "parent_tables"), found)}], schema)

    return tx.map_arrow(met, run, SUMS if only_sums else SEATS)


#: Tables of the contexts of bucket ``bucket`` in bucket ``source``, in the order of the books. ``up``, once for each source:
#: the parent's customers, tables, words seen once and twice, then pairs seen once and twice.
SUMS = "bucket long, source int, tables binary, up array<double>"


def _sum_rows(bucket: int, counts: Counts, found: list | None, buckets: int) -> list[dict]:
    """``found``: the tables, the parent's customers and its tables. Before the first seating every pair has one table."""
    named = counts.contexts != NONE
    placed = named[counts.place]
    if found is not None:
        tables = np.where(placed, found[0], 0.0)
        up = [float(found[1].sum()), float(found[2].sum()), 0.0, 0.0]
    else:
        tables = placed.astype(float)
        sent = np.bincount(counts.owner, weights=np.where(placed, 1, counts.count), minlength=len(counts.words))
        up = [float(sent.sum()), float(len(counts.words)), float((sent == 1).sum()), float((sent == 2).sum())]
    up += [float((placed & (counts.count == n)).sum()) for n in (1, 2)]
    tables = np.bincount(counts.place, weights=tables, minlength=len(named))[named]
    out = [{"bucket": -1, "source": bucket, "tables": b"", "up": up}]
    return out + [{"bucket": home, "source": bucket, "tables": pack(tables[mine]), "up": None} for home, mine in _homes(counts.placed, buckets)]


def _sums(spark: SparkSession, counted: str, seated: str | None, buckets: int) -> DataFrame:
    schema = tx.arrow_schema(SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket in batch.column(0).to_pylist():
                for row in rows_of(counted, bucket):
                    yield pa.RecordBatch.from_pylist(_sum_rows(bucket, Counts.of(row), _seats(row_of(seated, bucket)) if seated else None, buckets), schema)

    return tx.map_arrow(every_bucket(spark, buckets), run, SUMS)


def _seats(row: dict) -> list[np.ndarray]:
    return [unpack(row[n], kind) for n, kind in (("tables", "<f4"), ("parent_customers", "<f8"), ("parent_tables", "<f8"))]


def context_totals(sums: DataFrame, booked: str, buckets: int, home: bool = False) -> DataFrame:
    """Totals of contexts over all buckets, sent to the buckets that hold a customer of them (``home``: and to the bucket of the context's own word)."""
    schema = tx.arrow_schema(TOTALS)
    met = by_bucket(sums.where("bucket >= 0").select("bucket", "source", "tables"), buckets, "source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in tx.groups(batches):
            bucket = parts[0].column(0)[0].as_py()
            book = row_of(booked, bucket)
            customers, sizes = unpack(book["customers"], "<i8"), unpack(book["sizes"], "<u4").astype(np.int64)
            sources = unpack(book["sources"], "<u4").tolist()
            places = dict(zip(sources, np.split(unpack_runs(book["places"], sizes), np.cumsum(sizes)[:-1])))
            tables = np.zeros(len(customers))
            for p in parts:
                for row in p.to_pylist():
                    tables[places[row["source"]]] += unpack(row["tables"], "<f8")
            for source in sources:
                at = places[source]
                yield pa.RecordBatch.from_pylist([{"bucket": source, "home": bucket, "customers": pack(customers[at]), "tables": pack(tables[at])}], schema)
            if home:
                yield pa.RecordBatch.from_pylist([{"bucket": bucket, "home": -1, "customers": pack(customers), "tables": pack(tables)}], schema)

    return tx.map_arrow(met, run, TOTALS)


def _totals(sums: DataFrame, vocabulary: int | None, tokens: int, discounts: tuple[float, float] | None) -> Totals:
    """What all buckets share, without contexts. Before the first seating each word has one table in the parent: they are the vocabulary."""
    up = sums.where("bucket < 0").agg(*(F.sum(F.get("up", F.lit(i))).alias(f"c{i}") for i in range(6))).first()
    up = [x or 0.0 for x in up]
    vocabulary = int(up[1]) if vocabulary is None else vocabulary
    if discounts is None:
        share = lambda once, twice: float(np.clip(once / (once + 2 * twice), 0.05, 0.95)) if once else 0.5
        discounts = (share(up[4], up[5]), share(up[2], up[3]))
    return Totals(np.empty(0, tx.U64), np.zeros(1), np.zeros(1), up[0], up[1], vocabulary, tokens, discounts)


@dataclass
class Model:
    """Folders of the customers, the seats, the contexts and the questions of the texts that it was trained with."""

    spark: SparkSession
    shared: Totals
    buckets: int
    counted: str
    seated: str
    booked: str
    asked: str
    sums: DataFrame

    @property
    def table(self) -> DataFrame:
        """A row for each bucket: its customers and seats."""
        read = lambda schema, path: self.spark.read.schema(schema).parquet(path)
        return read(COUNTS, self.counted).join(read(SEATS, self.seated), "bucket")

    @cached_property
    def totals(self) -> Totals:
        """All contexts on the driver: for small models and tests; scoring does without."""
        sent = {r.bucket: r for r in context_totals(self.sums, self.booked, self.buckets, home=True).where("home < 0").collect()}
        read = [(unpack_ascending(b.contexts, "<u8"), unpack(b.customers, "<i8"), unpack(sent[b.bucket].tables, "<f8")) for b in self.spark.read.schema(BOOKS).parquet(self.booked).collect()]
        names, customers, tables = (np.concatenate([np.empty(0, t), *(r[k] for r in read)]) for k, t in enumerate((tx.U64, float, float)))
        order = np.argsort(names)
        return replace(self.shared, contexts=names[order], customers=np.append(0.0, customers[order]), tables=np.append(0.0, tables[order]))


def train(rows: DataFrame, context_share: float = 0.0) -> Model:
    """``rows``: doc_id, text. ``context_share``: of the training tokens, that a word must make up to be a context."""
    spark = rows.sparkSession
    n = training_tokens(rows)
    contexts = None
    if context_share > 0:
        counts = written(token_counts(rows), "tokens")
        frequent = counts.where(F.col("c") >= F.lit(context_share * n)).select("word").collect()  # 1 / context_share at most
        contexts = np.unique(np.append(np.array([r.word for r in frequent], np.int64).view(tx.U64), END))
    buckets = max(LEAST_BUCKETS, -(-n // BUCKET_TOKENS))
    asked = stored(by_bucket(ask(rows, buckets), buckets, "kind", "block"), "questions")
    counted = stored(customers(spark, asked, spark.sparkContext.broadcast(contexts), buckets), "customers")
    booked = stored(books(spark, counted, buckets), "contexts")
    sums = written(_sums(spark, counted, None, buckets), "sums")
    totals = _totals(sums, None, n, None)
    sums = written(seat(spark, counted, booked, sums, totals, buckets, 1, 1, only_sums=True), "sums")
    first = _totals(sums, totals.vocabulary, n, totals.discounts)
    seated = stored(seat(spark, counted, booked, sums, first, buckets, 2, SAMPLES), "model")
    sums = written(_sums(spark, counted, seated, buckets), "sums")
    return Model(spark, _totals(sums, totals.vocabulary, n, totals.discounts), buckets, counted, seated, booked, asked, sums)


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in ascending order, and the place of each value among them."""
    coded = pa.array(values).dictionary_encode()
    found = coded.dictionary.to_numpy()
    order = np.argsort(found)
    rank = np.empty(len(found), np.int32)
    rank[order] = np.arange(len(found), dtype=np.int32)
    return found[order], rank[coded.indices.to_numpy()]


def _counted(key: np.ndarray, is_sorted: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs. Sorts the keys in place."""
    if not is_sorted:
        key.sort()
    first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
    return key[first], np.diff(first, append=len(key)).astype(np.uint32)


#: What a block asks of a bucket (kind 2): its words, pairs of each, the contexts of all pairs and each pair's place among them, documents of each pair
#: and how often. Kind 1: the block's documents, on their way through some bucket; which are held out comes with both. Kind 0: the bucket itself.
#: Kind -1: totals of contexts.
ASKED = "bucket int, kind int, block long, words binary, pairs binary, contexts binary, place binary, entries binary, doc binary, count binary, held binary"


def ask(rows: DataFrame, buckets: int) -> DataFrame:
    schema = tx.arrow_schema(ASKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for serial, block in enumerate(blocks(batches)):
            name = part << 24 | serial
            words, place = _coded(block.tokens)
            block.tokens = None
            # words by bucket: pairs of a bucket lie side by side
            bucket = _bucket(words, buckets)
            order = np.argsort(bucket, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            key = rank[place]
            key *= len(words)
            key[1:] += place[:-1]  # each text ends, so all contexts are among the words
            key[0] += np.searchsorted(words, END)
            key <<= 16
            key |= np.repeat(np.arange(len(block.sizes), dtype=np.uint16), block.sizes)
            del place
            key, count = _counted(key)
            doc = (key & 0xFFFF).astype("<u2")
            key >>= 16
            pair, per_pair = _counted(key, is_sorted=True)
            del key
            owner, context = (pair // len(words)).astype(np.int32), (pair % len(words)).astype(np.int32)
            del pair
            entry_at = np.append(np.uint32(0), np.cumsum(per_pair, dtype=np.uint32))
            ids = np.array([i if i is not None else 0 for i in block.ids], np.int64)
            null = np.array([i is None for i in block.ids])
            held = pack(block.held)
            out = [{"bucket": name % buckets, "kind": 1, "block": name, "words": pack(ids.astype("<i8")), "pairs": pack(block.sizes.astype("<i8")), "contexts": pack(null), "held": held}]
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            pair_ends = np.searchsorted(owner, ends.astype(owner.dtype))
            for b in np.flatnonzero(np.diff(ends)):
                mine = slice(pair_ends[b], pair_ends[b + 1])
                entries = slice(entry_at[mine.start], entry_at[mine.stop])
                contexts, at = _coded(context[mine])
                pairs = np.bincount(owner[mine] - ends[b], minlength=ends[b + 1] - ends[b])
                out.append({
                    "bucket": int(b), "kind": 2, "block": name, "words": pack_ascending(words[order[ends[b] : ends[b + 1]]]), "pairs": pack(pairs.astype("<u4")), "contexts": pack_ascending(words[contexts]),
                    "place": pack_runs(at, pairs), "entries": pack(per_pair[mine].astype("<u4")), "doc": pack(doc[entries]), "count": pack(count[entries].astype("<u4")), "held": held,
                })
                if len(out) == 50:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return tx.map_arrow(rows, run, ASKED)


class Question:
    """A block's pairs in one bucket, and the documents of each."""

    def __init__(self, row: dict):
        self.words, pairs = unpack_ascending(row["words"], "<u8"), unpack(row["pairs"], "<u4").astype(np.int64)
        self.owner = np.repeat(np.arange(len(self.words), dtype=np.int32), pairs)
        self.contexts, self.place = unpack_ascending(row["contexts"], "<u8"), unpack_runs(row["place"], pairs)
        self.pair = np.repeat(np.arange(len(self.owner)), unpack(row["entries"], "<u4").astype(np.int64))
        self.doc, self.count, self.held = unpack(row["doc"], "<u2"), unpack(row["count"], "<u4"), unpack(row["held"], "?")


#: Sums of a block's documents over one bucket: documents, known tokens, base and model scores. bucket -1: the documents themselves.
ANSWERED = "block long, bucket int, doc binary, known binary, base binary, score binary"


class Bucket:
    """Looks up a bucket's words."""

    def __init__(self, row: dict | None, totals: Totals):
        self.totals = totals
        if row is None:
            self.words = np.empty(0, tx.U64)
            self.key = self.extra = np.empty(0)
            return
        counts = Counts.of(row)
        self.words = counts.words
        tables, *parent = _seats(row)
        self.seen = np.bincount(counts.owner, weights=counts.count, minlength=len(self.words))
        self.parent = totals.parent(*parent)
        context = _place(totals.contexts, counts.contexts).astype(np.int32)[counts.place]
        placed = context > 0
        context = context[placed]
        self.key = counts.owner[placed].astype(np.int64)
        self.key <<= 32
        self.key |= context
        self.extra = tables[placed].astype(float)
        self.extra *= -totals.discounts[0]
        self.extra += counts.count[placed]
        self.extra /= STRENGTH[0] + totals.customers[context]

    def look_up(self, words: np.ndarray, owner: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For pairs (contexts by their places in the totals): whether the word is known, and its base and model log10 probabilities."""
        t = self.totals
        unknown = t.parent(np.zeros(1), np.zeros(1))[0]
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            known = self.words[at] == words
            seen, parent = np.where(known, self.seen[at], 0.0), np.where(known, self.parent[at], unknown)
        else:
            at, known = np.zeros(len(words), np.int64), np.zeros(len(words), bool)
            seen, parent = np.zeros(len(words)), np.full(len(words), unknown)
        p = t.back_off[context] * parent[owner]
        if len(self.key):
            key = at[owner].astype(np.int64) << 32 | context
            place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            p += np.where((self.key[place] == key) & known[owner], self.extra[place], 0.0)
        base = np.log10((seen + 0.5) / (t.tokens + 0.5 * (t.vocabulary + 1)))
        return known[owner], base[owner], np.log10(p)


def answer(asked: DataFrame | None, model: Model) -> DataFrame:
    """Sums for each block and bucket, where the questions of a bucket (None: those of the training) meet its words and the totals of their contexts."""
    spark, buckets = model.spark, model.buckets
    shared, schema = spark.sparkContext.broadcast(model.shared), tx.arrow_schema(ANSWERED)
    counted, seated, booked = model.counted, model.seated, model.booked
    own = model.asked if asked is None else None
    met = context_totals(model.sums, booked, buckets, home=True).withColumn("kind", F.lit(-1)).unionByName(every_bucket(spark, buckets).withColumn("kind", F.lit(0)), allowMissingColumns=True)
    if asked is not None:
        met = met.unionByName(asked, allowMissingColumns=True)
    met = by_bucket(met, buckets, "kind", *(() if asked is None else ("block",)))

    def start(bucket: int, parts: list[dict]) -> Bucket:
        row = row_of(counted, bucket)
        contexts = Counts.of(row).placed if row else np.empty(0, tx.U64)
        local = _local(parts, contexts, shared.value, buckets)
        for p in parts:
            if p["home"] < 0:  # the contexts that are this bucket's words
                names = np.append(local.contexts, unpack_ascending(row_of(booked, bucket)["contexts"], "<u8"))
                names, first = np.unique(names, return_index=True)
                customers, tables = (np.append(0.0, np.append(a[1:], unpack(p[n], kind))[first]) for a, n, kind in ((local.customers, "customers", "<i8"), (local.tables, "tables", "<f8")))
                local = replace(local, contexts=names, customers=customers, tables=tables)
        return Bucket(row and row | row_of(seated, bucket), local)

    def reply(row: dict, bucket: Bucket, weight: np.ndarray) -> dict:
        if row["kind"] == 1:
            ids, sizes, null, held = (unpack(row[n], kind) for n, kind in (("words", "<i8"), ("pairs", "<i8"), ("contexts", "?"), ("held", "?")))
            return {"block": row["block"], "bucket": -1, "doc": ids.tobytes(), "known": sizes.tobytes(), "base": null.tobytes(), "score": held.tobytes()}
        q, contexts = Question(row), bucket.totals.contexts
        context = _place(contexts, q.contexts)[q.place]
        known, base, score = bucket.look_up(q.words, q.owner, context)
        # Each token of a text is the context of another one (its end: of the first). The bucket of the context's word
        # adds the weight of the parent, so that of contexts without a pair here is not needed.
        score += weight[_place(contexts, q.words)][q.owner] - weight[context]
        docs, count = np.flatnonzero(np.bincount(q.doc)), q.count.astype(float)
        sums = [np.bincount(q.doc, weights=count * x[q.pair])[docs] for x in (known.astype(float), base, score)]
        return {"block": row["block"], "bucket": row["bucket"], "doc": pack_ascending(docs.astype("<u2")), "known": pack(sums[0].astype("<u4")), "base": sums[1].tobytes(), "score": sums[2].tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, bucket, weight = [], None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["kind"] < 0:
                    parts.append(row)
                elif row["kind"] == 0:  # a bucket's totals come before it, its questions after
                    bucket, parts = start(row["bucket"], parts), []
                    weight = np.log10(bucket.totals.back_off)
                    for question in rows_of(own, row["bucket"]) if own else ():
                        yield pa.RecordBatch.from_pylist([reply(question, bucket, weight)], schema)
                else:
                    yield pa.RecordBatch.from_pylist([reply(row, bucket, weight)], schema)

    return tx.map_arrow(met, run, ANSWERED)


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(rows: DataFrame | None, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document. ``rows``: None for those given to ``train``, held-out ones too."""
    answered = answer(None if rows is None else ask(rows, model.buckets), model).repartition(model.buckets, "block").sortWithinPartitions("block", "bucket")
    tokens, schema = model.shared.tokens, tx.arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in tx.groups(batches):
            head, sums = None, None
            for p in parts:
                for row in p.to_pylist():
                    if row["bucket"] < 0:  # the block's documents come first
                        head = row
                        ids = np.frombuffer(row["doc"], "<i8")
                        sums = np.zeros((3, len(ids)))
                        continue
                    docs = unpack_ascending(row["doc"], "<u2")
                    for k, values in enumerate((unpack(row["known"], "<u4"), np.frombuffer(row["base"], "<f8"), np.frombuffer(row["score"], "<f8"))):
                        sums[k][docs] += values
            columns = [
                pa.array(ids, mask=np.frombuffer(head["base"], bool)),
                pa.array(np.frombuffer(head["score"], bool)),
                pa.array(np.frombuffer(head["known"], "<i8")),
                pa.array(sums[0].astype(np.int64)),
                pa.array(np.full(len(ids), tokens, np.int64)),
                pa.array(sums[1]),
                pa.array(sums[2]),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return tx.map_arrow(answered, run, RESULT)


def perplexity(scored: DataFrame) -> DataFrame:
    """held_out, tokens, base_perplexity and perplexity over all documents of each side."""
    per = lambda column: F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("tokens"), per("base_score").alias("base_perplexity"), per("score").alias("perplexity"))


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tx.text_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    return score(None, train(rows))
