"""Operators 11 to 13 against plain versions, on small tables with every awkward case."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candela.llm import hard_negatives as hn, lexical_search as ls, mixture as mx, text as tx

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


# ---------------------------------------------------------------- 11: hard negatives

def vectors(seed: int = 3, n: int = 230) -> list[tuple]:
    """(vec_id, label, embedding, id): near labels, copies, ties, short and empty vectors, rows that take no part."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(9)] for _ in range(4)]
    rows = [(i, i % 4 if i % 3 else 0, [x + rng.gauss(0, 0.05) for x in centres[rng.choice([i % 4, 0])]], "x") for i in range(n)]
    rows += [(100, 1, [0.5] * 9, "x"), (100, 1, [0.5] * 9, "x"), (300, 2, [0.25] * 3, "x"), (400, 3, [], "x"), (500, 9, [0.1] * 9, "x")]
    rows += [(600 + i, 0, [0.3] * 9, "x") for i in range(40)]
    rows += [(None, 0, [0.4] * 9, "x"), (None, 2, [0.3] * 12, "x"), (700, None, [0.1] * 9, "x"), (800, 1, None, "x")]
    rows += [(900, 1, [0.1, None, 0.2], "x"), (1000, 1, [0.1, NAN], "x"), (1100, 1, [INF, 0.1], "x"), (-200, 1, [-0.2] * 9, "x")]
    return rows


def mined(rows: list[tuple], positives: int = 5, negatives: int = 10) -> list[tuple]:
    kept = [
        (i, label, [math.floor(256 * x) for x in v]) for i, label, v, _ in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (anchor, label, v) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), i, other) for b, (i, other, w) in enumerate(kept) if b != a]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        for p, i, _ in [x for x in scored if x[2] == label][:positives]:
            window = [(n, j) for n, j, other in scored if other != label and 30 * p <= 100 * n <= 90 * p]
            out += [(anchor, i, rank + 1, j, p, n) for rank, (n, j) in enumerate(window[:negatives])]
    return out


VECTORS = "vec_id long, label int, embedding array<float>, id string"


def _as_float(rows):
    return [(i, label, v and [x if x is None else float(np.float32(x)) for x in v], s) for i, label, v, s in rows]


def _found(df):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


@pytest.mark.parametrize("blocks", [(4096, 4096, 512), (2, 32, 8)])
def test_op11_equals_brute_force(spark, monkeypatch, blocks):
    for name, value in zip(("ANCHORS", "CANDIDATES", "TILE"), blocks):
        monkeypatch.setattr(hn, name, value)
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = _found(hn.hard_negatives(df, F.col("vec_id") % 100 == 0))
    want = sorted(mined(_as_float(rows)), key=repr)
    assert len(want) > 100 and got == want


def test_op11_empty_and_without_anchors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert _found(hn.hard_negatives(empty, F.col("vec_id") % 100 == 0)) == []
    rows = [(1, 1, [0.5], "x"), (2, 2, [0.5], "x")]
    assert _found(hn.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0)) == []
    alone = [(100, 1, [0.5], "x"), (2, 2, [0.4], "x")]  # no positive
    assert _found(hn.hard_negatives(spark.createDataFrame(alone, VECTORS), F.col("vec_id") % 100 == 0)) == []


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 33), (65, 100, 70), (128, 33, 129), (200, 257, 40), (5, 0, 7)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(4)
    a, b = rng.integers(-(2**28), 2**28, (m, k)), rng.integers(-(2**28), 2**28, (n, k))
    assert np.array_equal(hn.strassen(a, b), (a.astype(object) @ b.T.astype(object)).astype(np.int64) if k else np.zeros((m, n), np.int64))


def test_strassen_halves_a_level(monkeypatch):
    calls = []
    plain = np.einsum
    monkeypatch.setattr(hn.np, "einsum", lambda *x: calls.append(1) or plain(*x))
    hn.strassen(np.ones((128, 128), np.int64), np.ones((128, 128), np.int64))
    assert len(calls) == 49  # seven products a level, two levels


def test_scores_beyond_a_long_are_refused():
    big = np.full((2, 4), 2**31)
    assert not hn.fits(big, big) and hn.fits(big // 4, big // 4)


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(8)
    entries = [(rng.integers(0, 6, 50), rng.integers(0, 10**6, 50), rng.integers(0, 9, 50)) for _ in range(7)]
    results = []
    for order in (range(7), [3, 1, 6, 0, 2, 5, 4]):
        heaps = hn.Heaps(5)
        for i in order:
            heaps.add(*entries[i])
        results.append(list(zip(heaps.owner, heaps.place, heaps.score)))
    everything = sorted(zip(*(np.concatenate(x) for x in zip(*entries))), key=lambda e: (e[0], -e[2], e[1]))
    want = [e for o in range(6) for e in [x for x in everything if x[0] == o][:5]]
    assert results[0] == results[1] == want


def test_windows_are_exact():
    p = np.array([-7, 0, 1, 3, 333, 10**18 // 3])
    low, high = hn.windows(p, 30, 90)
    for x, a, b in zip(p.tolist(), low.tolist(), high.tolist()):
        assert a == -((-30 * x) // 100) and b == (90 * x) // 100


# ---------------------------------------------------------------- 12: mixing

def corpus() -> list[tuple]:
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([1, 3, 10, 40, rng.randint(1, 200)]), rng.choice(["a", "a", "a", "b", "é", "Z", None]), "x") for i in range(900)]
    rows += [(1000, "same text here", "a", "x")] * 57 + [(1001, None, "b", "x"), (1002, "", None, "x"), (1003, " \t\n", "a", "x")]
    rows += [(None, "no id at all", "b", "x"), (None, "no id at all", "b", "y"), (1004, "tiny", "small", "x"), (1005, "big " * 3000, "Z", "x")]
    return rows


DOCS = "doc_id long, text string, source string, size string"


def targets(rows: list[tuple], weights=(1, 2, 3), cap: int = 3) -> tuple[dict, dict]:
    sizes = Counter()
    for _, text, source, _ in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        left = sum(weight[s] for s in order if s not in full)
        new = {s for s in order if s not in full and weight[s] * rest > cap * sizes[s] * left}
        if not new:
            return {s: float(cap * sizes[s]) if s in full else weight[s] * rest / left for s in order}, sizes
        full |= new


@pytest.mark.parametrize("block", [128, 4])
def test_op12_targets_and_bounds(spark, monkeypatch, block):
    monkeypatch.setattr(mx, "BLOCK", block)
    monkeypatch.setattr(mx, "RUN", 10)
    rows = corpus()
    want, sizes = targets(rows)
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    found = mx.per_row(mx.allocation(docs)).select("source", "id", "size", "source_size", "target", "copies").collect()
    assert sorted((r.source or "", r.id or -1, r.size) for r in found) == sorted(
        (s or "", i or -1, len((t or "").split())) for i, t, s, _ in rows)
    taken, largest = Counter(), Counter()
    for r in found:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12) and r.source_size == sizes[r.source] and 0 <= r.copies <= 3
        each = want[r.source] / sizes[r.source]
        assert r.size == 0 or r.copies in (math.floor(each), math.ceil(each))
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    assert want["small"] == 3.0  # stopped at its cap
    for source in want:
        assert abs(taken[source] - want[source]) < largest[source] + 1e-6


def test_op12_reruns_agree_and_mixture_repeats_rows(spark):
    rows = corpus()
    one = mx.per_row(mx.allocation(spark.createDataFrame(rows, DOCS).repartition(3))).collect()
    two = mx.per_row(mx.allocation(spark.createDataFrame(rows[::-1], DOCS).repartition(9))).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, two))
    mixed = mx.mixture(spark.createDataFrame(rows, DOCS))
    assert mixed.columns == ["doc_id", "text", "source", "size"]
    got = Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    want = defaultdict(int)
    for r in one:
        want[(r.id, r.source, r.size)] += r.copies
    texts = {(i, s, len((t or "").split())): t for i, t, s, _ in rows}
    assert got == Counter({(k[0], texts[k], k[1]): n for k, n in want.items() if n})


def test_op12_expected_copies(spark):
    """Over many seeds a document is copied as often as its share says."""
    rows = [(i, "w " * (i % 5 + 1), "ab"[i % 2], "x") for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    want, sizes = targets(rows)
    items = mx.documents_by_key(docs, "doc_id", "text", "source").cache()
    total = Counter()
    p = {s: want[s] / sizes[s] % 1 for s in want}
    share = F.when(F.col("source") == "a", p["a"]).otherwise(p["b"])
    many = items.select("source", F.explode(F.sequence(F.lit(1), F.lit(400))).alias("run"), "item")
    many = many.select(F.concat_ws("-", "source", "run").alias("source"), "item", share.alias("p"), F.lit(1).cast("long").alias("blocks"))
    for r in mx.rounded(many, 5).filter("up").select("item.id").collect():
        total[r.id] += 1
    for i, _, s, _ in rows:
        assert abs(total[i] / 400 - p[s]) < 0.13


def test_op12_empty_table_and_empty_texts(spark):
    assert mx.per_row(mx.allocation(spark.createDataFrame([], DOCS))).collect() == []
    rows = mx.per_row(mx.allocation(spark.createDataFrame([(1, None, None, ""), (2, "", "a", "")], DOCS))).collect()
    assert [(r.size, r.target, r.copies) for r in rows] == [(0, 0.0, 0)] * 2


def test_op12_plan_has_no_python(spark):
    plan = mx.per_row(mx.allocation(spark.read.parquet(f"{SF}/documents.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- 13: lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def searched(docs: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    counts = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t, *_ in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text, *_ in items:
        asked = set(TERM.findall((text or "").translate(UPPER)))
        scored = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if score > 0:
                scored.append((score, i))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, rank + 1, i, s) for rank, (s, i) in enumerate(scored[:k])]
    return out


def library() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(6)
    vocabulary = [f"t{i}" for i in range(60)] + ["Über", "ÜBER", "naïve", "x y", "12", "İ"]
    docs = [(i, " ".join(rng.choices(vocabulary, weights=[200 / (j + 1) for j in range(66)], k=rng.randint(1, 60))), "x") for i in range(400)]
    docs += [(500 + i, "t5 t9 t30, t31; T40!", "x") for i in range(30)] + [(900, None, "x"), (901, "", "x"), (902, "... !?", "x")]
    docs += [(None, "t5 t9 t30 t31 t40", "x"), (903, "t1 " * 5000, "x"), (7, "t59 t58", "x"), (7, "t59 t58", "x")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25))), "x") for i in range(25)]
    items += [(100, "T5 t9 t30 t31 t40 t40", "x"), (101, None, "x"), (102, "", "x"), (103, "unknown words", "x"), (104, "t59-T58", "x"), (None, "t59", "x")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"SEGMENT_DOCS": 40, "BUCKET": 2, "ITEMS": 4, "TABLE": 1 << 9, "PIECE": 64, "STEP": 1}])
def test_op13_equals_brute_force(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ls, name, value)
    docs, items = library()
    index = ls.build_index(spark.createDataFrame(docs, "doc_id long, text string, term string").repartition(3))
    found = ls.search(index, spark.createDataFrame(items, "item_id long, text string, doc_id string"))
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()]
    want = searched(docs, items)
    assert len(want) > 200 and sorted(got, key=repr) == sorted(want, key=repr)


def test_op13_empty_tables(spark):
    docs, items = (spark.createDataFrame(x, "id long, text string") for x in ([(1, "a b")], []))
    nothing = spark.createDataFrame([], "id long, text string")
    assert ls.search(ls.build_index(docs, "id"), nothing, id_col="id").collect() == []
    assert ls.search(ls.build_index(nothing, "id"), docs, id_col="id").collect() == []
    assert items.count() == 0


def test_op13_repeated_items_are_queries_each(spark):
    docs = spark.createDataFrame([(i, f"word{i % 3} other") for i in range(9)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "word1"), (1, "word1")], "item_id long, text string")
    rows = ls.search(ls.build_index(docs), items, k=2).collect()
    assert len({r["item"] for r in rows}) == 2 and sorted((r["rank"], r.doc_id) for r in rows) == [(1, 1), (1, 1), (2, 4), (2, 4)]


def test_op13_postings_are_in_files_and_in_no_rows(spark):
    """F1: rows of whole segments took an executor's JVM to 2.5 GB."""
    docs, items = library()
    index = ls.build_index(spark.createDataFrame(docs, "doc_id long, text string, term string").repartition(3))
    assert index.dtypes == [("segment", "bigint"), ("n_docs", "bigint"), ("n_terms", "bigint"), ("file", "string")]
    listed = index.collect()
    assert len(listed) == len({r.segment for r in listed}) == len({r.file for r in listed}) == 3
    read = [ls.read_segment(r.file, "term", "df", "doc", "length") for r in listed]
    df = Counter()
    for r, segment in zip(listed, read):
        assert len(segment["doc"]) == sum(segment["df"].to_pylist())
        assert len(segment["length"]) == r.n_docs and sum(segment["length"].to_pylist()) == r.n_terms
        df.update(dict(zip(segment["term"].to_pylist(), segment["df"].to_pylist())))
    want = Counter(t.encode() for _, text, _ in docs for t in set(TERM.findall((text or "").translate(UPPER))))
    assert df == want
    counted = ls.document_counts(index.select("file")).groupBy("term").sum("df").collect()
    assert {bytes(r[0]): r[1] for r in counted} == want


def test_op13_partitions_of_several_tasks(spark, monkeypatch):
    for name, value in {"BUCKET": 1, "ITEMS": 4, "PARTITIONS": 5}.items():
        monkeypatch.setattr(ls, name, value)
    docs, items = library()
    index = ls.build_index(spark.createDataFrame(docs, "doc_id long, text string, term string").repartition(3))
    found = ls.search(index, spark.createDataFrame(items, "item_id long, text string, doc_id string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("shufflepartitionidpassthrough(direct_shuffle_partition_id") == 2  # dealt once, by number
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(searched(docs, items), key=repr)


def test_op13_a_task_holds_one_segment_at_a_time(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    docs = [(i, " ".join(f"w{rng.randrange(4000)}" for _ in range(60))) for i in range(8000)]
    items = [(0, "w1 w2 w3 w4"), (1, "w77 w78"), (2, "nothing")]
    schema, files = tx.arrow_schema(ls.SEGMENT), []
    for key in range(8):
        segment = ls._Segment()
        for doc_id, text in docs[key * 1000 : key * 1000 + 1000]:
            segment.add(doc_id, text.encode())
        row = pa.RecordBatch.from_pydict(segment.row(key), schema=schema)
        files += [ls.write_segment(f"file://{tmp_path}", row) for _ in range(1 + (key == 0))]
    assert len(set(files)) == 9  # a second attempt of a task writes another file
    size, held, read = row.nbytes, [], ls.read_segment
    del row, segment

    def reading(*args):
        held.append(pa.total_allocated_bytes())
        return read(*args)

    monkeypatch.setattr(ls, "read_segment", reading)
    df = Counter(t for _, text in docs for t in set(text.split()))
    asked = [(i, t, math.floor(1000 * math.log((2 * 8000 + 2) / (2 * df[t] + 1)))) for i, text in items for t in text.split() if df[t]]
    block = pa.table({"item": [i for i, *_ in asked], "item_id": [i for i, *_ in asked], "term": pa.array([t.encode() for _, t, _ in asked], pa.binary()), "weight": [w for *_, w in asked]})
    found = ls.searcher(10, 8000, 60 * 8000)((0, 0), block, pa.table({"file": files[1:]}))
    assert len(held) == 8 and max(held) - held[0] < 1.5 * size
    got = sorted((r["item"], -r["score"], r["doc_id"]) for r in found.to_pylist())
    assert got == [(i, -s, d) for i, _, d, s in searched(docs, items)]


def test_best_positions_stop_early_and_lose_nothing():
    """Few documents lead in every list: reading stops long before the lists end."""
    rng = np.random.default_rng(5)
    n, lists = 4000, 6
    tf = rng.integers(1, 4, (lists, n))
    tf[:, rng.choice(n, 25, replace=False)] = 60
    docs = np.tile(np.arange(n), lists)
    made = ls.ImpactLists(np.arange(lists + 1) * n, docs, tf.ravel(), np.full(n, 100), 0, n)
    looked = []

    place = made.place
    made.place = type("P", (), {"__getitem__": lambda self, key: looked.append(len(key[1])) or place[key]})()
    found, scores = ls.best_positions(made, np.arange(lists), np.full(lists, 7), 10, 1)
    whole = (7 * made.value[made.start[:-1, None] + place]).sum(0)
    best = sorted(zip(-whole, range(n)))[:10]
    assert sorted(zip(-scores, found))[:10] == best and sum(looked) < n / 4
