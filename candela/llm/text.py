"""Shared helpers: words, rolling hashes, Arrow mapping, scratch files."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from candela.session import scratch_path

U64 = np.uint64
#: Odd multiplier of the polynomial hashes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: bytes.split() cuts at just those six bytes."""
    return text.split() if text else []


def lower_words(text: bytes | None) -> list[bytes]:
    """The same after lower-casing A-Z only."""
    return text.lower().split() if text else []


def hash_words(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=U64, count=len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads each input bit over the word."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x ^= x >> U64(27)
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS[kind]
    if len(have) < n:
        step = U64(BASE if kind == "up" else BASE_INVERSE)
        full = np.full(max(n, 2 * len(have)), step, U64)
        full[0] = 1
        have = _POWERS[kind] = np.multiply.accumulate(full)
    return have[:n]


class RollingHash:
    """Polynomial hash of any slice of a sequence of 64-bit symbols, from one prefix sum."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.prefix = np.zeros(n + 1, U64)
        np.cumsum(symbols * _powers("up", n), out=self.prefix[1:])
        self.n = n

    def grams(self, k: int) -> np.ndarray:
        """Hash of each run of k symbols."""
        if self.n < k:
            return np.empty(0, U64)
        return mix((self.prefix[k:] - self.prefix[:-k]) * _powers("down", self.n - k + 1))

    def slices(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        raw = (self.prefix[start + length] - self.prefix[start]) * _powers("down", self.n + 1)[start]
        return mix(raw + length.astype(U64))


def binary(column: pa.Array) -> list[bytes | None]:
    """A string column's values as bytes, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's code to the application once, so that workers can import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    packed = f"{tempfile.mkdtemp(prefix='candela-code-')}/candela-{context.applicationId}.zip"
    with zipfile.ZipFile(packed, "w") as file:  # code on the driver's disk, which Spark serves to the executors
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    context.addPyFile(packed)
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict] | dict | None], schema: str, rows: int | None = None) -> DataFrame:
    """``mapInArrow`` over a function from a batch to dicts of columns.

    ``schema`` is Spark DDL; columns are cast to it by Arrow. With ``rows``, the function gets that many at a time.
    """
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows) if rows else (0,):
                out = fn(batch.slice(at, rows))
                for part in [out] if isinstance(out, dict) else out or ():
                    yield pa.RecordBatch.from_arrays([_column(part[f.name], f.type) for f in target], schema=target)

    return map_arrow(df, run, schema)


def _column(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        return values if values.type == kind else values.cast(kind)
    if isinstance(values, np.ndarray) and values.dtype == U64 and kind == pa.int64():
        values = values.view(np.int64)
    return pa.array(values, type=kind)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Runs of rows with one value of the first column (a long), from rows ordered by it."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges[:-1], edges[1:]):
            if held and key[start] != now:
                yield held
                held = []
            now = key[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield held


def text_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Just the id and the text, under fixed names: whatever else the table holds cannot clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def keyed_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds ``_key``: equal for repeated rows only, never null.

    Two rows of one id and different texts have different keys; a row twice in
    the table is two documents with one key, and so with one result.
    """
    rows = text_rows(df, id_col, text_col)
    return rows.withColumn("_key", F.xxhash64(F.col("doc_id").cast("string"), F.lit("|"), F.col("text")))


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes to the shared folder and reads back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def output_folder(spark: SparkSession, name: str) -> str:
    path = scratch_path(spark, name)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def open_folder(uri: str):
    """(filesystem, path) of a folder that driver and executors share."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    system.create_dir(path, recursive=True)
    return system, path


def temporary_name(name: str) -> str:
    return f".{name}.{uuid.uuid4().hex[:8]}"


def one_task_each(spark: SparkSession, files: list[tuple], schema: str) -> DataFrame:
    """A row per written file, spread one to a task."""
    rows = spark.createDataFrame(files, schema)
    return rows.repartitionByRange(max(1, len(files)), rows.columns[0])
