"""Windows that occur more than once in a corpus: routing of their surroundings, and removal.

Used by the two substring deduplicators, which differ in their symbols (words,
bytes) and in how a shard decides what repeats.

Equal windows of ``size`` symbols choose the same anchor: the gram of ``gram``
symbols with the smallest key in them, leftmost if equal. Windows side by side
with one anchor form a run, and a run goes to the shard of its anchor's gram, as
a fingerprint first. Shards with a single run hold no repeat. Where all runs of
a shard are equal, all their windows repeat. Elsewhere the text of each distinct
run is fetched once, and the shard decides. So what repeats is found at the cost
of about two rows for each ``size - gram`` symbols of the corpus, and text moves
only for shards that can hold a repeat.

A shard beyond SHARD_SYMBOLS is not gathered but divided. Its runs are cut into
parts whose windows start at nearly the same distance before the anchor. All
windows of a part share a core around the anchor, equal windows have equal cores,
and so a part goes to the shard of its core. Equal parts become one with their
number before they meet. Shards that are still too large are divided again by
longer cores; at last a part is one window, its core the window itself, and its
shard one row.

A row that is in the table more than once counts as two, however many there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from candela.llm import text as tx

#: Documents of a batch that are held as Python objects at a time.
DOCS = 500
#: Symbols of a document that are looked at at a time.
CHUNK = 1 << 20
#: Symbols of a shard's distinct runs beyond which it is divided.
SHARD_SYMBOLS = 60_000
#: Into how many ranges of distances a large shard is divided at a time.
FAN = 4
_LOW = tx.U64((1 << 24) - 1)


@dataclass(frozen=True)
class Units:
    """What a document is a sequence of."""

    #: Bytes of a text -> its symbols (one slice of them is one run's content).
    split: Callable[[bytes], object]
    #: Symbols -> 64-bit hashes.
    hashes: Callable[[object], np.ndarray]
    #: A slice of the symbols -> bytes, and back.
    pack: Callable[[object], bytes]
    unpack: Callable[[bytes], object]


def anchors(hashes: np.ndarray, size: int, gram: int) -> dict[str, np.ndarray]:
    """The runs of a document: shard, content (fingerprint), start, run (windows), place (of the anchor in the run)."""
    n_windows = len(hashes) - size + 1
    if n_windows < 1:
        return {}
    parts = []
    rolled = tx.RollingHash(hashes)
    grams = rolled.grams(gram)
    width = size - gram + 1
    for at in range(0, n_windows, CHUNK):
        end = min(at + CHUNK, n_windows)
        own = grams[at : end + width - 1]
        best = (tx.mix(own) & ~_LOW) | np.arange(len(own), dtype=tx.U64)
        span = 1
        while 2 * span <= width:  # minima over 1, 2, 4 ... grams
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        if span < width:
            best = np.minimum(best[: end - at], best[width - span : width - span + end - at])
        parts.append((best[: end - at] & _LOW).astype(np.int64) + at)
    place = np.concatenate(parts)
    starts = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
    runs = np.diff(np.concatenate((starts, [n_windows])))
    anchor = place[starts]
    return {"shard": grams[anchor], "content": rolled.slices(starts, runs + size - 1), "start": starts, "run": runs, "place": anchor - starts}


KEY = ("shard", "content", "run", "place")


def once_each(found: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Equal runs of a document as one, ``starts`` (offsets and values) listing where: a periodic text has a row for each place else."""
    n = len(found["start"])
    order = np.lexsort((found["start"], found["place"], found["run"], found["content"], found["shard"]))
    new = np.zeros(n, bool)
    new[0] = True
    for name in KEY:
        column = found[name] = found[name][order]
        new[1:] |= column[1:] != column[:-1]
    at = np.flatnonzero(new)
    return {name: found[name][at] for name in KEY} | {"starts": found["start"][order], "counts": np.diff(np.append(at, n))}


def runs(rows: DataFrame, units: Units, size: int, gram: int) -> DataFrame:
    """All runs of all documents: the key's columns, starts and _key; a document's equal runs are one row. ``rows``: _key, text."""
    names = (*KEY, "starts", "counts", "_key")

    def out(held: dict[str, list]) -> dict:
        flat = {n: np.concatenate(v) for n, v in held.items()}
        offsets = np.concatenate(([0], np.cumsum(flat.pop("counts"))))
        return flat | {"starts": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat["starts"], pa.int32()))}

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        held: dict[str, list] = {n: [] for n in names}
        size_now = 0
        for key, text in zip(batch.column(0).to_pylist(), tx.binary(batch.column(1))):
            found = anchors(units.hashes(units.split(text)), size, gram) if text else None
            if found:
                found = once_each(found)
                found["_key"] = np.full(len(found["shard"]), key, np.int64)
                for n in names:
                    held[n].append(found[n])
                size_now += len(found["starts"])
                if size_now > 100_000:
                    yield out(held)
                    held, size_now = {n: [] for n in names}, 0
        if size_now:
            yield out(held)

    return tx.map_batches(rows.select("_key", "text"), run, "shard long, content long, run int, place int, starts array<int>, _key long", DOCS)


def shared_runs(found: DataFrame) -> DataFrame:
    """Runs whose shard has others; ``mixed``: these are not all equal."""
    shard = Window.partitionBy("shard")
    counted = found.select("*", F.sum(F.size("starts")).over(shard).alias("n"), F.min("content").over(shard).alias("low"), F.max("content").over(shard).alias("high"))
    return counted.where("n > 1").select(*KEY, "starts", "_key", (F.col("low") != F.col("high")).alias("mixed"))


def contents(rows: DataFrame, distinct: DataFrame, units: Units, size: int) -> DataFrame:
    """The text of one occurrence of each distinct run: the key's columns, n, symbols (bytes), large."""
    wanted = distinct.groupBy("_key").agg(F.collect_list(F.struct(*KEY, "start", "n", "large")).alias("runs"))
    joined = rows.select("_key", "text").join(wanted, "_key").select("text", "runs")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {n: [] for n in (*KEY, "n", "symbols", "large")}
        held = 0
        for text, wanted in zip(tx.binary(batch.column(0)), batch.column(1).to_pylist()):
            symbols = units.split(text)
            for r in wanted:
                for n in (*KEY, "n", "large"):
                    out[n].append(r[n])
                out["symbols"].append(units.pack(symbols[r["start"] : r["start"] + r["run"] + size - 1]))
                held += len(out["symbols"][-1])
            if held > 4 << 20:
                yield out
                out, held = {n: [] for n in out}, 0
        if held:
            yield out

    return tx.map_batches(joined, run, "shard long, content long, run int, place int, n long, symbols binary, large boolean", DOCS)


def spans_of(hit: np.ndarray, size: int) -> list[int]:
    """Window flags -> symbols covered, as start, end, start, end ..."""
    starts = np.flatnonzero(hit)
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > size)
    firsts, lasts = starts[np.concatenate(([0], cut + 1))], starts[np.concatenate((cut, [len(starts) - 1]))]
    return np.column_stack((firsts, lasts + size)).ravel().tolist()


#: (contents, places of the anchor, windows, counts) of a shard's distinct runs -> flags of each run's windows.
Decide = Callable[[list, list[int], list[int], list[int]], list[np.ndarray]]


def decide(fetched: DataFrame, units: Units, size: int, method: Decide) -> DataFrame:
    """The key's columns and ``spans`` of each distinct run with a repeat."""
    schema = tx.arrow_schema("shard long, content long, run int, place int, spans array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

        for parts in tx.groups(batches):
            shard, seen = parts[0].column(0)[0].as_py(), {}
            for p in parts:
                content, length, place, n, data = (p.column(i).to_pylist() for i in range(1, 6))
                for row in zip(content, length, place, n, data):
                    seen[row[:3]] = row
            members = list(seen.values())
            length, place, n = ([m[i] for m in members] for i in (1, 2, 3))
            if len(members) > 1:
                flags = method([units.unpack(m[4]) for m in members], place, length, n)
            else:
                flags = [np.zeros(length[0], bool)]
            for m, hit in zip(members, flags):
                found = spans_of(np.ones(m[1], bool) if m[3] > 1 else hit, size)
                if found:
                    rows.append((shard, m[0], m[1], m[2], found))
            if len(rows) > 5000:
                yield out()
                rows = []
        if rows:
            yield out()

    ordered = fetched.repartition("shard").sortWithinPartitions("shard")
    return tx.map_arrow(ordered, run, "shard long, content long, run int, place int, spans array<int>")


def parts(hot: DataFrame, units: Units, size: int, width: int) -> DataFrame:
    """Runs cut where the distance from a window's start to the anchor passes a multiple of ``width``.

    The run's key as run_shard, run_content ..., ``first`` (the part's first window in the run), and the part's key, n and symbols.
    """
    names = (*(f"run_{k}" for k in KEY), "first", *KEY, "n", "symbols")

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {n: [] for n in names}
        held = 0
        for *key, n, data in zip(*(batch.column(i).to_pylist() for i in range(6))):
            shard, _, run, place = key
            symbols = units.unpack(data)
            rolled = tx.RollingHash(units.hashes(symbols))
            near = np.arange(max(0, place - run + 1) // width, place // width + 1) * width  # least distance of each part
            first = np.maximum(0, place - near - width + 1)
            windows = np.minimum(run - 1, place - near) - first + 1
            core = rolled.slices(place - near, np.full(len(near), size - width + 1))
            shards = tx.mix(core + tx.mix(near.astype(tx.U64) + np.array([shard]).view(tx.U64))).view(np.int64)
            contents = rolled.slices(first, windows + size - 1).view(np.int64)
            for row in zip(shards.tolist(), contents.tolist(), windows.tolist(), (place - first).tolist(), first.tolist()):
                packed = units.pack(symbols[row[4] : row[4] + row[2] + size - 1])
                for name, value in zip(names, (*key, row[4], *row[:4], n, packed)):
                    out[name].append(value)
                held += len(packed)
            if held > 4 << 20:
                yield out
                out, held = {n: [] for n in names}, 0
        if held:
            yield out

    schema = "run_shard long, run_content long, run_run int, run_place int, first int, shard long, content long, run int, place int, n long, symbols binary"
    return tx.map_batches(hot.select(*KEY, "n", "symbols"), cut, schema)


def too_large(keys: DataFrame, size: int) -> DataFrame:
    """``shard`` of those beyond SHARD_SYMBOLS, written. ``keys``: the key's columns, repeated or not."""
    symbols = keys.select(*KEY).distinct().groupBy("shard").agg(F.sum(F.col("run") + F.lit(size - 1)).alias("symbols"))
    return tx.write_table(symbols.where(F.col("symbols") > SHARD_SYMBOLS).select("shard"), "large")


def decide_large(hot: DataFrame, units: Units, size: int, width: int, method: Decide) -> DataFrame:
    """The same as ``decide`` for shards that one task should not hold; a run may have several rows.

    ``hot``: their distinct runs, whose windows start at ``width`` distances from the anchor or fewer in each shard.
    """
    width = -(-width // FAN)
    cut = tx.write_table(parts(hot, units, size, width), "parts")
    merged = cut.groupBy(*KEY).agg(F.sum("n").alias("n"), F.first("symbols").alias("symbols"))
    large = too_large(cut, size)
    if width == 1 or large.isEmpty():  # one distance: all runs of a shard are one window
        found = decide(merged, units, size, method)
    else:
        found = decide(merged.join(large, "shard", "left_anti").select(*KEY, "n", "symbols"), units, size, method)
        found = found.unionByName(decide_large(merged.join(large, "shard", "left_semi"), units, size, width, method))
    whole = cut.select(*(f"run_{k}" for k in KEY), "first", *KEY).join(found, list(KEY))
    return whole.select(*(F.col(f"run_{k}").alias(k) for k in KEY), F.transform("spans", lambda s: s + F.col("first")).alias("spans"))


def counted_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """_key and text twice over: with rows that the table repeats there twice, and once."""
    rows = rows.select("_key", "text")
    repeated = tx.write_table(rows.groupBy("_key").count().where("count > 1").select("_key"), "repeated")
    if repeated.isEmpty():
        return rows, rows
    one = tx.write_table(rows.join(repeated, "_key", "left_semi").groupBy("_key").agg(F.first("text").alias("text")), "one")
    once = rows.join(repeated, "_key", "left_anti").unionByName(one)
    return once.unionByName(one), once


def repeated_spans(rows: DataFrame, units: Units, size: int, gram: int, method: Decide) -> DataFrame:
    """_key and ``spans`` (structs of start and end in symbols): what windows that occur elsewhere too cover."""
    counted, once = counted_rows(rows)
    shared = tx.write_table(shared_runs(runs(counted, units, size, gram)), "runs")
    mixed = shared.where("mixed").drop("mixed")
    first = mixed.groupBy(*KEY).agg(F.sum(F.size("starts")).alias("n"), F.min(F.struct("_key", F.get("starts", F.lit(0)).alias("start"))).alias("first"))
    large = too_large(mixed, size)
    distinct = first.join(large.withColumn("large", F.lit(True)), "shard", "left").select(*KEY, "n", "first._key", "first.start", F.coalesce("large", F.lit(False)).alias("large"))
    fetched = contents(once, distinct, units, size)
    if large.isEmpty():
        decided = decide(fetched.drop("large"), units, size, method)
    else:
        fetched = tx.write_table(fetched, "fetched")
        decided = decide(fetched.where("not large").drop("large"), units, size, method)
        decided = decided.unionByName(decide_large(fetched.where("large"), units, size, size - gram + 1, method))
    pairs = F.transform(F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2)), lambda i: F.struct(F.get("spans", i).alias("from"), F.get("spans", i + 1).alias("to")))
    at = lambda start, first, last: F.struct((start + first).alias("start"), (start + last).alias("end"))
    within = F.flatten(F.transform("starts", lambda s: F.transform("pairs", lambda p: at(s, p["from"], p["to"]))))
    some = mixed.join(decided.withColumn("pairs", pairs), list(KEY)).select("_key", within.alias("spans"))
    whole = shared.where("not mixed").select("_key", F.transform("starts", lambda s: at(s, F.lit(0), F.col("run") + F.lit(size - 1))).alias("spans"))
    return some.unionByName(whole).groupBy("_key").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def span_edges(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of each row's spans, none for null; no span becomes a Python object."""
    at = column.offsets.to_numpy()
    start, end = (column.values.field(i).to_numpy() for i in range(2))
    for i, gone in enumerate(column.is_null().to_pylist()):
        own = slice(0, 0) if gone else slice(at[i], at[i + 1])
        yield start[own], end[own]


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Flags of the symbols that the spans cover."""
    edge = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0
