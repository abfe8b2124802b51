"""The pipeline's stages against brute force, at sf0.001."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

import corpus_pipeline
from candela.llm import decontaminate, queries, text as tx
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = tx.write_table(stage(spark, docs, SF), "stage")
        rows = {r.doc_id: r for r in out.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        if name == "quality_rules":
            assert set(rows) == {i for i, r in before.items() if brute.quality(r.text)["kept"]}
        elif name == "near_dedup":
            labels = brute.near_duplicates([(i, r.text) for i, r in before.items()], k=5)
            assert set(rows) == {i for i, (_, _, kept) in labels.items() if kept}
        elif name == "decontamination":
            items = [w for w in (decontaminate.normal_words(b.encode()) for b in bench) if len(w) >= 5]
            hit = set()
            for i, r in before.items():
                text = b" " + b" ".join(decontaminate.normal_words(r.text.encode())) + b" "
                if any(b" " + b" ".join(w) + b" " in text for w in items):
                    hit.add(i)
            assert not hit & set(rows)
            assert len(before) - len(rows) <= len(hit) + 2
        elif name == "redact_pii":
            assert set(rows) == set(before)
            for i, r in rows.items():
                assert not brute.base_pii(r.text)
                if not brute.base_pii(before[i].text) and "<" not in r.text:
                    assert r.text == before[i].text
        else:
            for i, r in rows.items():
                assert r.decoded_sha256 == hashlib.sha256(before[i].text.encode()).hexdigest()
        docs, before = out, rows


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    df, rel = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    listed = lambda columns, rows: sorted(repr([r[columns.index(c)] for c in sorted(columns)]) for r in rows)
    assert listed(df.columns, [tuple(r) for r in df.collect()]) == listed(rel.columns, rel.fetchall())
