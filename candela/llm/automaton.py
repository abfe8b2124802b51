"""Operator 8: repeated passages of words, by suffix automata and matching statistics.

A reference shard is the runs of words around one anchor (see ``repeats``). Its
automaton holds all its distinct runs with the number of places each string
occurs at. Streaming a run through it gives, word by word, the longest string
that ends there and occurs at two places or more; where that reaches the
threshold, the window before it repeats. Spans are maximal: what such windows
cover, joined.

The reference is the corpus itself, so automata are built where their shard's
runs meet instead of being sent to all tasks: sending every shard to every
document would take time in the square of the corpus.

Null and empty texts have no words and lose none. Repeated rows repeat each
other's windows. Texts shorter than a window are kept whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from candela.llm import repeats, text as tx

SIZE = 35
GRAM = 11

WORDS = repeats.Units(split=tx.words, hashes=tx.hash_words, pack=b" ".join, unpack=bytes.split)


class SuffixAutomaton:
    """Of several sequences, with the number of places of each state's strings."""

    def __init__(self):
        self.step: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.places = [0]

    def add(self, sequence: list, weight: int = 1) -> None:
        """Appends a sequence; it starts anew at the root, so no string runs from one into the next."""
        step, link, length, places = self.step, self.link, self.length, self.places
        last = 0
        for c in sequence:
            there = step[last].get(c)
            if there is not None:
                if length[there] == length[last] + 1:
                    last = there
                else:
                    last = self._split(last, there, c)
                places[last] += weight
                continue
            new = len(step)
            step.append({})
            length.append(length[last] + 1)
            places.append(weight)
            link.append(0)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p >= 0:
                q = step[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, q, c)
            last = new

    def _split(self, p: int, q: int, c) -> int:
        """Divides state q: strings up to the length by way of p get a state of their own."""
        step, link, length = self.step, self.link, self.length
        clone = len(step)
        step.append(dict(step[q]))
        length.append(length[p] + 1)
        self.places.append(0)
        link.append(link[q])
        link[q] = clone
        while p >= 0 and step[p].get(c) == q:
            step[p][c] = clone
            p = link[p]
        return clone

    def count(self) -> None:
        """Passes the numbers of places on to shorter strings, longest first."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.places[self.link[state]] += self.places[state]

    def matching(self, sequence: list, least: int = 2) -> list[int]:
        """For each place, the length of the longest string that ends there and has ``least`` places or more."""
        step, link, length, places = self.step, self.link, self.length, self.places
        state, n, out = 0, 0, []
        for c in sequence:
            there = step[state].get(c)
            while (there is None or places[there] < least) and state > 0:
                state = link[state]
                n = length[state]
                there = step[state].get(c)
            if there is None or places[there] < least:
                state, n = 0, 0
            else:
                state, n = there, n + 1
            out.append(n)
        return out


def repeated_windows(symbols: list, place: list[int], run: list[int], n: list[int]) -> list[np.ndarray]:
    """Flags of the windows of each run of a shard that occur at two places or more."""
    shard = SuffixAutomaton()
    for words, weight in zip(symbols, n):
        shard.add(words, weight)
    shard.count()
    return [np.array(shard.matching(words)[SIZE - 1 :]) >= SIZE for words in symbols]


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and ``spans``: the maximal spans of words (start, end) to remove, null for none."""
    rows = tx.keyed_rows(docs, id_col, text_col)
    spans = repeats.repeated_spans(rows, WORDS, SIZE, GRAM, repeated_windows)
    return rows.join(spans, "_key", "left").select("doc_id", "text", "spans")


def passage_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of the words that stay, joined by one space."""

    def run(batch: pa.RecordBatch) -> dict:
        out = {n: [] for n in ("n_words", "n_removed", "kept_sha256")}
        for text, (start, end) in zip(tx.binary(batch.column(1)), repeats.span_edges(batch.column(2))):
            words = tx.words(text)
            gone = repeats.covered(len(words), start, end)
            kept = [w for w, g in zip(words, gone.tolist()) if not g] if len(start) else words
            out["n_words"].append(len(words))
            out["n_removed"].append(int(gone.sum()))
            out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return out | {"doc_id": batch.column(0)}

    return tx.map_batches(repeated_passages(docs, id_col, text_col), run, "doc_id long, n_words long, n_removed long, kept_sha256 string", repeats.DOCS)


def op8_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
