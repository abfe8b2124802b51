"""Operator 13: ranked lexical search by the Best Position Algorithm.

1. Documents are indexed in segments of up to SEGMENT_DOCS documents or
   SEGMENT_POSTINGS postings, without a shuffle: a segment is an Arrow file in the
   shared folder with its own dictionary and, for each term, its documents and
   frequencies. Rows name these files; what they hold goes through no row of Spark's.
2. Numbers of documents, terms and documents of a term are sums over segments;
   the last only of terms that an item has.
3. Items are dealt in blocks, segments in buckets, and each block meets each
   bucket in one task, which reads one segment after the other: the stated query
   set against all rows, in blocks.
4. There a term has an impact list: its documents of the segment by impact,
   greatest first. The lists of an item are read side by side in steps; a
   document met in one list is looked up in all others (direct access), which gives its
   whole score and marks its positions there as seen. The best position of a list is
   the last up to which all are seen, by either kind of access. A document not
   seen yet lies beyond it in every list, so its score is at most the sum of the
   impacts at the best positions, which is less than at the positions last read.
   Reading stops once that sum is strictly below the k-th score found, in this
   segment or one before: so equal scores at the k-th place are all seen.
5. The best of the tasks are merged; equal scores by ascending id, null ids last.

Terms are runs of letters and digits of ASCII and of all other characters beyond
it; only A-Z are lower-cased. A null or empty text, or one without terms, is no
document and no query: such items have no rows, like those whose terms no document has.
Repeated documents are documents each, repeated items queries each (``item`` tells
them apart). An empty table of either kind gives no rows; other columns play no part.
A segment's tables of positions are built for slices of documents, so that memory does
not grow with the number of terms that a block of items has.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData, SparkSession, Window, functions as F

from candela.llm import text as tx

SEGMENT_DOCS, SEGMENT_POSTINGS = 4096, 1 << 20
#: Segments that a task reads, and items.
BUCKET, ITEMS = 4, 256
#: Partitions of the tasks; a partition has several where there are more.
PARTITIONS = 1 << 13
#: Entries of a table of positions.
TABLE = 1 << 24
#: Positions of each list that the first step reads; every step doubles them.
STEP = 16
SALTS = 16
#: Bytes of texts that are cut into terms at once.
PIECE = 1 << 22

# Fixed values of the score: m is 100 - B + B * n * N / L, impacts are w * (SCALE * tf) div (1000 * tf + 8 * m).
B, SCALE = 90, 1_000_000_000

#: A byte that ends a term becomes a blank, A-Z become lower-case.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: bytes | None) -> set[bytes]:
    """Distinct terms of a text."""
    return set((text or b"").translate(_TERM_BYTES).split())


SEGMENT = (
    "segment long, n_docs long, n_terms long, doc_id array<long>, length array<long>, "
    "term array<binary>, df array<long>, doc array<int>, tf array<int>"
)
#: A row of the index: what a segment's file is called, and its totals.
LISTED = "segment long, n_docs long, n_terms long, file string"


class _Segment:
    """Postings of documents that come one after another, counted PIECE bytes at a time."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.ids, self.parts, self.postings = [], [], 0
        self.waiting, self.bytes = [], 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        clean = (text or b"").translate(_TERM_BYTES).strip()
        if not clean:
            return
        doc, at = len(self.ids), 0
        self.ids.append(doc_id)
        while at < len(clean):
            end = clean.find(b" ", at + PIECE)
            end = len(clean) if end < 0 else end
            self.waiting.append((doc, clean[at:end]))
            self.bytes += end - at
            at = end
            if self.bytes >= PIECE:
                self.count()

    def count(self) -> None:
        """Counts terms of the waiting texts by document."""
        if not self.waiting:
            return
        words = pc.split_pattern(pa.array([x for _, x in self.waiting], pa.large_binary()), " ")
        doc = np.repeat([d for d, _ in self.waiting], np.array(words.value_lengths()))
        flat = words.flatten()
        full = pc.greater(pc.binary_length(flat), 0)
        encoded = flat.filter(full).dictionary_encode()
        distinct = encoded.dictionary.to_pylist()
        key, tf = np.unique(doc[np.array(full)] * len(distinct) + np.array(encoded.indices), return_counts=True)
        number = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        self.parts.append((key // len(distinct), number[key % len(distinct)], tf))
        self.postings += len(key)
        self.waiting, self.bytes = [], 0

    @property
    def full(self) -> bool:
        return len(self.ids) >= SEGMENT_DOCS or self.postings >= SEGMENT_POSTINGS

    def row(self, key: int) -> dict:
        self.count()
        doc, number, tf = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((doc, number))
        doc, number, tf = doc[order], number[order], tf[order]
        first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (number[1:] != number[:-1]))))
        doc, number, tf = doc[first], number[first], np.add.reduceat(tf, first)  # a long text has several parts
        length = np.zeros(len(self.ids), np.int64)
        np.add.at(length, doc, tf)
        return {
            "segment": [key], "n_docs": [len(self.ids)], "n_terms": [int(length.sum())], "doc_id": [self.ids], "length": [length],
            "term": [list(self.numbers)], "df": [np.bincount(number, minlength=len(self.numbers))], "doc": [doc], "tf": [tf],
        }


def write_segment(folder: str, row: pa.RecordBatch) -> str:
    """Writes a segment to a file and gives its name, which no other attempt of the task has."""
    system, root = tx.open_folder(folder)
    name = f"{row.column(0)[0]}-{uuid.uuid4().hex[:12]}.arrow"
    with system.open_output_stream(f"{root}/{name}") as sink:
        with pa.ipc.new_file(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as file:
            file.write_batch(row)
    return f"{folder}/{name}"


def read_segment(file: str, *names: str) -> dict[str, pa.Array]:
    """The named columns of a segment; no others are read."""
    folder, _, name = file.rpartition("/")
    system, root = tx.open_folder(folder)
    with system.open_input_file(f"{root}/{name}") as source:
        columns = pa.ipc.open_file(source).schema
        wanted = pa.ipc.IpcReadOptions(use_threads=False, included_fields=sorted(columns.get_field_index(x) for x in names))
        row = pa.ipc.open_file(source, options=wanted).get_batch(0)
        return {x: row.column(row.schema.get_field_index(x))[0].values for x in names}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The segments of a table of documents, written; a row for each file."""
    schema, listed = tx.arrow_schema(SEGMENT), tx.arrow_schema(LISTED)
    folder = tx.output_folder(docs.sparkSession, "lexical-segments")

    def write(key: int, segment: _Segment) -> pa.RecordBatch:
        row = segment.row(key)
        file = write_segment(folder, pa.RecordBatch.from_pydict(row, schema=schema))
        return pa.RecordBatch.from_pydict({x: row[x] for x in listed.names[:-1]} | {"file": [file]}, schema=listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, segment = TaskContext.get().partitionId() << 32, _Segment()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), tx.binary(batch.column(1))):
                segment.add(doc_id, text)
                if segment.full:
                    yield write(made, segment)
                    made, segment = made + 1, _Segment()
        if segment.ids:
            yield write(made, segment)

    rows = tx.map_arrow(tx.text_rows(docs, id_col, text_col), run, LISTED)
    # few files: for each one that Spark writes to a local folder, the executor's JVM starts a process
    return tx.write_table(rows.hint("rebalance", "segment"), "lexical-index")


def document_counts(files: DataFrame) -> DataFrame:
    """(term, df) of all segments, a row for each term of each."""
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for file in batch.column(0).to_pylist():
            yield read_segment(file, "term", "df")

    return tx.map_batches(files, run, "term binary, df long")


def queries(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term) of all items, written: a row for each distinct term."""
    def run(batch: pa.RecordBatch) -> dict:
        found = [sorted(terms(text)) for text in tx.binary(batch.column(2))]
        sizes = [len(x) for x in found]
        at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        return {"item": batch.column(0).take(at), "item_id": batch.column(1).take(at), "term": [t for x in found for t in x]}

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return tx.write_table(tx.map_batches(rows, run, "item long, item_id long, term binary"), "lexical-items")


class ImpactLists:
    """Impact lists of some terms over documents ``low`` up to ``high`` of a segment."""

    def __init__(self, starts: np.ndarray, doc: np.ndarray, tf: np.ndarray, m: np.ndarray, low: int, high: int):
        own = (doc >= low) & (doc < high)
        lists = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[own]
        doc, tf = doc[own], tf[own].astype(np.int64)
        value = (SCALE * tf) // (1000 * tf + 8 * m[doc])
        order = np.lexsort((-value, lists))  # stable: equal impacts stay in the order of documents
        self.doc, self.value = doc[order] - low, value[order]
        self.start = np.searchsorted(lists, np.arange(len(starts)))
        self.size = np.diff(self.start)
        self.docs = high - low
        self.place = np.full((len(starts) - 1, self.docs), -1, np.int32)
        self.place[lists, self.doc] = np.arange(len(lists)) - self.start[lists]


def best_positions(lists: ImpactLists, own: np.ndarray, weight: np.ndarray, k: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores, among them all that may be of the ``k`` best and have a score of ``bound`` or more.

    ``own`` are the lists of the item's terms.
    """
    start, size = lists.start[own], lists.size[own]
    offset = np.concatenate(([0], np.cumsum(size)))
    seen = np.zeros(offset[-1], bool)
    best = np.zeros(len(own), np.int64)
    known = np.zeros(lists.docs, bool)
    found, scores = [], np.empty(0, np.int64)
    depth, step = 0, STEP
    while depth < size.max(initial=0):
        at = np.arange(depth, depth + step)
        read = (start[:, None] + at)[at < size[:, None]]  # sorted access: the next positions of every list
        docs = lists.doc[read]
        new = np.unique(docs[~known[docs]])
        known[new] = True
        place = lists.place[own[:, None], new]  # direct access: all lists
        row, column = np.nonzero(place >= 0)
        place = place[row, column]
        seen[offset[row] + place] = True
        score = np.zeros(len(new), np.int64)
        np.add.at(score, column, weight[row] * lists.value[start[row] + place])
        good = score >= bound
        found.append(new[good])
        scores = np.concatenate((scores, score[good]))
        depth, step = depth + step, step * 2
        for i in range(len(own)):
            if best[i] < size[i]:
                rest = seen[offset[i] + best[i] : offset[i + 1]]
                gap = int(rest.argmin())
                best[i] = size[i] if rest[gap] else best[i] + gap
        if len(scores) >= k:
            bound = max(bound, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        open_ = best < size
        if int((weight[open_] * lists.value[start[open_] + best[open_] - 1]).sum()) < bound:
            break
    return np.concatenate(found) if found else np.empty(0, np.int64), scores


FOUND = "item long, item_id long, doc_id long, score long"


def _order(entry: tuple) -> tuple:
    score, doc_id, _ = entry
    return -score, doc_id is None, doc_id or 0


def searcher(k: int, documents: int, all_terms: int):
    """A task: the best of a bucket of segments for each item of a block."""
    schema = tx.arrow_schema(FOUND)

    def run(key, items: pa.Table, segments: pa.Table) -> pa.Table:
        if not items.num_rows or not segments.num_rows:
            return schema.empty_table()
        items = items.sort_by([("item", "ascending"), ("term", "ascending")])
        item, weight = np.array(items.column("item")), np.array(items.column("weight"))
        distinct = pc.unique(items.column("term"))
        number = np.array(pc.index_in(items.column("term"), value_set=distinct))
        edges = [0, *(np.flatnonzero(item[1:] != item[:-1]) + 1).tolist(), len(item)]
        spans = list(zip(edges[:-1], edges[1:]))
        heaps: list[list[tuple]] = [[] for _ in spans]
        for i, file in enumerate(segments.column("file").to_pylist()):
            segment = read_segment(file, "doc_id", "length", "term", "df", "doc", "tf")
            at = np.array(pc.index_in(distinct, value_set=segment["term"]).fill_null(-1))
            present = np.flatnonzero(at >= 0)
            if not len(present):
                continue
            df = np.array(segment["df"])
            ends = np.cumsum(df)
            sizes = df[at[present]]
            starts = np.concatenate(([0], np.cumsum(sizes)))
            postings = np.repeat(ends[at[present]] - df[at[present]] - starts[:-1], sizes) + np.arange(starts[-1])
            doc, tf = np.array(segment["doc"])[postings], np.array(segment["tf"])[postings]
            m = 100 - B + (B * np.array(segment["length"]) * documents) // all_terms
            place = np.full(len(distinct), -1)
            place[present] = np.arange(len(present))
            ids = segment["doc_id"].to_pylist()
            slice_ = max(1, TABLE // len(present))
            for low in range(0, len(ids), slice_):
                lists = ImpactLists(starts, doc, tf, m, low, min(len(ids), low + slice_))
                for heap, (first, last) in zip(heaps, spans):
                    own, w = place[number[first:last]], weight[first:last]
                    there = (own >= 0) & (w > 0)
                    bound = heap[-1][0] if len(heap) == k else 1
                    docs, scores = best_positions(lists, own[there], w[there], k, bound)
                    if len(scores) > k:
                        kept = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        docs, scores = docs[kept], scores[kept]
                    heap.extend((s, ids[low + d], i) for s, d in zip(scores.tolist(), docs.tolist()))
                    heap.sort(key=_order)
                    del heap[k:]
                del lists  # before the next tables are made
        counts = [len(h) for h in heaps]
        rows = pa.array(np.repeat([first for first, _ in spans], counts))
        return pa.table([
            items.column("item").take(rows), items.column("item_id").take(rows),
            pa.array([e[1] for h in heaps for e in h], pa.int64()), pa.array([e[0] for h in heaps for e in h], pa.int64()),
        ], schema=schema)

    return run


def search(index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    asked = queries(items, id_col, text_col)
    total = index.agg(F.count("*").alias("segments"), F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    docs, all_terms = total.docs or 0, total.terms or 1
    buckets = max(1, math.ceil(total.segments / BUCKET))
    blocks = max(1, math.ceil((asked.agg(F.count_distinct("item")).first()[0]) / ITEMS))

    counted = document_counts(index.select("file").repartition(min(buckets, PARTITIONS)))
    counted = counted.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000) * F.ln(F.lit(2 * docs + 2) / (F.col("df") * 2 + 1)))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))  # a term may be of a third of all items
    weights = counted.select("term", weight.alias("weight"), salts.alias("salt"))
    salted = asked.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS)).cast("int"))
    weighted = salted.join(weights, ["term", "salt"]).select("item", "item_id", "term", "weight")

    def all_of(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    partitions = min(blocks * buckets, PARTITIONS)

    def dealt(rows: DataFrame) -> GroupedData:
        # their bytes say nothing of the work, so partitions are not left to Spark
        rows = rows.withColumn("task", F.col("block") * F.lit(buckets) + F.col("bucket"))
        rows = rows.withColumn("part", F.pmod("task", F.lit(partitions)).cast("int"))
        return rows.repartitionById(partitions, F.col("part")).groupBy("part", "task")

    left = weighted.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("long")).withColumn("bucket", all_of(buckets))
    right = index.withColumn("bucket", F.pmod(F.xxhash64("segment"), F.lit(buckets)).cast("long")).withColumn("block", all_of(blocks))
    found = dealt(left).cogroup(dealt(right)).applyInArrow(searcher(k, docs, all_terms), FOUND)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item", "item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("item_id", "rank", "doc_id", "score")
