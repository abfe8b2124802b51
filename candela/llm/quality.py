"""Operator 7: quality rules as a short-circuit cascade.

Each rule has a cost and a rejection rate, both estimated on a bounded sample;
the cascade runs the rules in descending order of rejections per second and
stops at a document's first failure. The order changes the time only: a
document is kept if and only if it passes every rule.

Null and empty texts have no words and fail ``few_words``. Repeated rows are
judged one by one, alike. An empty table gives an empty result, and the rules
then keep their given order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candela.llm import text as tx

SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
UPPER = bytes(range(ord("A"), ord("Z") + 1))
LETTERS = UPPER + UPPER.lower()
#: Rows, and bytes of a row, of the sample that orders the rules. Bounds on the estimate, not on what is judged.
SAMPLE_ROWS = 500
SAMPLE_BYTES = 100_000


class Measures:
    """What the rules look at, each computed once and only when asked for."""

    def __init__(self, text: bytes | None):
        self.text = text or b""

    @cached_property
    def words(self) -> list[bytes]:
        return tx.words(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).translate(None, CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.text.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words covered by 5-word windows that occur twice or more in the text."""
        n = self.n_words
        if n < 6:
            return 0
        grams = tx.RollingHash(tx.hash_words(self.words)).grams(5)
        order = np.argsort(grams, kind="stable")
        same = grams[order[1:]] == grams[order[:-1]]
        if not same.any():
            return 0
        starts = np.union1d(order[1:][same], order[:-1][same])
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + 5, -1)
        return int((np.cumsum(edge)[:n] > 0).sum())

    @cached_property
    def n_letters(self) -> int:
        return len(self.text) - len(self.text.translate(None, LETTERS))

    @cached_property
    def n_upper(self) -> int:
        return len(self.text) - len(self.text.translate(None, UPPER))

    @property
    def base_failed(self) -> bool:
        return self.n_words < 10 or 100 * self.n_repeat_words > 20 * self.n_words


#: Rule name -> whether a document fails it. Whole-number tests, so any engine agrees.
RULES: dict[str, Callable[[Measures], bool]] = {
    "few_words": lambda m: m.n_words < 10,
    "repeated_passages": lambda m: 100 * m.n_repeat_words > 20 * m.n_words,
    "symbols": lambda m: 10 * m.n_symbols > m.n_words,
    "capitals": lambda m: 2 * m.n_upper > m.n_letters,
    "duplicate_lines": lambda m: 100 * m.n_dup_lines > 30 * len(m.lines),
    "word_length": lambda m: not 2 * m.n_words <= m.word_chars <= 15 * m.n_words,
}


def estimate(docs: DataFrame, text_col: str = "text", rules: dict | None = None, sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, seconds, rejection rate) on a sample of at most ``sample_rows`` texts of at most SAMPLE_BYTES.

    Every rule sees every sampled text with nothing computed yet, so its cost
    holds what it needs. Only as many partitions are read as give the sample.
    """
    text = F.col(text_col).cast("string")
    sample = docs.where(text.isNull() | (F.octet_length(text) <= SAMPLE_BYTES)).select(text.alias("text")).take(sample_rows)
    out = []
    for name, rule in (rules or RULES).items():
        began = time.perf_counter()
        failed = sum(bool(rule(Measures(r.text.encode() if r.text is not None else None))) for r in sample)
        if sample:
            out.append((name, (time.perf_counter() - began) / len(sample), failed / len(sample)))
    return out


def order_rules(estimates: list[tuple[str, float, float]], rules: dict | None = None) -> list[str]:
    """Rules by rejections per second; those without an estimate keep their place at the end."""
    known = {name: rejected / max(seconds, 1e-9) for name, seconds, rejected in estimates}
    return sorted(rules or RULES, key=lambda name: -known.get(name, -1.0))


def judge(measures: Measures, order: list[str], rules: dict | None = None) -> str | None:
    """The first rule in the order that fails, or None."""
    rules = rules or RULES
    return next((name for name in order if rules[name](measures)), None)


def quality_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict | None = None) -> DataFrame:
    """doc_id, the base measures, ``base_failed`` and the cascade's verdict ``kept`` for each document."""
    rules = rules or RULES
    order = order_rules(estimate(docs, text_col, rules), rules)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batch: pa.RecordBatch) -> dict:
        out: dict = {n: [] for n in (*names, "base_failed", "kept")}
        for value in tx.binary(batch.column(1)):
            m = Measures(value)
            out["kept"].append(judge(m, order, rules) is None and not m.base_failed)
            out["base_failed"].append(m.base_failed)
            for n in names:
                out[n].append(getattr(m, n))
        return out | {"doc_id": batch.column(0)}

    ddl = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean"
    return tx.map_batches(tx.text_rows(docs, id_col, text_col), run, ddl)


def quality_filter(docs: DataFrame, text_col: str = "text", rules: dict | None = None) -> DataFrame:
    """The documents that pass every rule, with all their columns. Reads each text once and shuffles nothing."""
    rules = rules or RULES
    order = order_rules(estimate(docs, text_col, rules), rules)
    schema, place = docs.schema, docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = tx.binary(batch.column(place).cast(pa.string()))
            yield batch.filter(pa.array([judge(Measures(t), order, rules) is None for t in texts], pa.bool_()))

    return tx.map_arrow(docs, run, schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_measures(spark.read.parquet(f"{sf_dir}/documents.parquet"))
