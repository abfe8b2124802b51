"""Operator 4: token ids as Arrow files of equal-length sequences.

Documents are dealt by ranges of their id, so the files in the order of their
names hold the ids in ascending order of documents. A file is an Arrow IPC file
(the stream format with an index of its batches): each batch holds fixed-size
lists of LENGTH ids and of as many mask bits, false only where the last sequence
of a file is filled up. Sequence i lies at a known place, and a memory map of a
local file gives it without a copy. Beside it lies a file with the documents'
ids and token counts, in the same order.

Null texts are empty: they have the end id alone. A null doc_id sorts before all
others; rows of one id follow each other in the order of their texts. An empty
table writes no file and gives no row.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from candela.llm import text as tx

LENGTH = 2048
SEQUENCES_PER_BATCH = 256
END_ID = 2
#: Words in each of the two generations that a worker remembers; a word that is met again moves to the younger one.
KEPT_WORDS = 400_000
#: Kinds of bytes, by byte: white space, the signs of WordEncoder, ASCII letters and digits, all others.
OTHER, SPACE, SIGN, PLAIN = range(4)
WHITE = [b"\t", b"\n", b"\v", b"\f", b"\r", b" "]


def _runs(where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true begin, and where they are over."""
    padded = np.zeros(len(where) + 2, bool)
    padded[1:-1] = where
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    return edges[::2], edges[1::2]


class WordEncoder:
    """A tokenizer that lower-cases and whose pre-tokenizer never joins words, with the ids of words remembered.

    Its normalizer works within words and its special tokens hold no white
    space, so the ids of a text are those of its words in turn. Within a word,
    trailing signs are a piece of their own if a letter or digit stands before
    them, so the word and the signs are looked up apart. Texts are split many at
    a time, as one array of bytes, and each distinct word of them is looked up
    once. Pieces of letters alone are encoded many at a time, as one text: where
    the model marks the last token of a piece and there are as many marks as
    pieces, the marks part them.
    """

    #: Signs that neither compose with a letter nor begin a contraction.
    SIGNS = b".,;:!?*#$%&|"
    #: Pieces of letters in one text.
    JOINED = 100
    #: Bytes split at once; a longer text is cut at white space.
    TOGETHER = 4_000_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        vocabulary, mark = self.tokenizer.get_vocab(), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        #: For each id, whether it ends a piece; nothing where the model marks no ends.
        self.marked = np.zeros(max(vocabulary.values(), default=-1) + 1 if mark else 0, bool)
        if mark:
            self.marked[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        #: Special tokens are found before the text is lower-cased.
        self.special = {t.content.encode("utf-8").lower() for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _stem(self, word: bytes) -> bytes:
        """The word without its trailing signs, or the word itself where they might not be a piece of their own."""
        stem = word.rstrip(self.SIGNS)
        if not stem or len(stem) == len(word) or b"<|" in word:
            return word
        if stem[-1:].isalnum():  # ASCII: nothing composes into it
            return stem
        last = unicodedata.normalize("NFC", stem.decode("utf-8")).lower()[-1]
        return stem if unicodedata.category(last)[0] in "LN" else word

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.width).tobytes() for e in found]

    def _keep(self, pieces: list[bytes]) -> None:
        """Encodes pieces and keeps them among the young."""
        young, step, size = self.young, self.JOINED, self.width.itemsize
        texts = [w.decode("utf-8") for w in pieces]
        alone = range(len(pieces))
        if len(self.marked):
            letters = [i for i, x in enumerate(texts) if x.isalpha()]
            alone = [i for i, x in enumerate(texts) if not x.isalpha()]
            rows = [letters[at : at + step] for at in range(0, len(letters), step)]
            found = self.tokenizer.encode_batch_fast([" ".join([texts[i] for i in row]) for row in rows], add_special_tokens=False)
            for row, e in zip(rows, found):
                ids = np.array(e.ids, self.width)
                ends = (size * (np.flatnonzero(self.marked[ids]) + 1)).tolist()
                raw = ids.tobytes()
                if len(ends) != len(row) or ends[-1] != len(raw):
                    alone += row
                    continue
                start = 0
                for i, end in zip(row, ends):
                    young[pieces[i]] = raw[start:end]
                    start = end
        young.update(zip([pieces[i] for i in alone], self._ids([texts[i] for i in alone])))

    def _learn(self, words: list[bytes]) -> None:
        young, old, signs = self.young, self.old, self.SIGNS
        stems: dict[bytes, bytes] = {}
        pieces = set()
        for w in words:
            ids = old.get(w)
            if ids is not None:
                young[w] = ids
            elif w[-1] in signs and (stem := self._stem(w)) is not w:
                stems[w] = stem
            else:
                pieces.add(w)
        pieces.update(p for w, stem in stems.items() for p in (stem, w[len(stem) :]) if p not in young and p not in old)
        some = list(pieces)
        for at in range(0, len(some), 20_000):
            self._keep(some[at : at + 20_000])
        for w, stem in stems.items():
            tail = w[len(stem) :]
            young[w] = (young.get(stem) or old.get(stem, b"")) + (young.get(tail) or old.get(tail, b""))

    def _split(self, raw: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The words, ASCII letters and digits parted from trailing signs; where each word begins, and its first piece."""
        low = raw.lower()
        parted = not any(s in low for s in self.special)
        raw = low if parted else raw
        kinds = np.frombuffer(raw.translate(KINDS), np.uint8)
        starts, ends = _runs(kinds != SPACE)
        first_sign, after_signs = _runs(kinds == SIGN)
        cut = np.flatnonzero(kinds[ends - 1] == SIGN) if parted else ends[:0]
        stems = first_sign[np.searchsorted(after_signs, ends[cut])]
        inner = (stems > starts[cut]) & (kinds[stems - 1] == PLAIN)
        cut, stems = cut[inner], stems[inner]
        pieces = np.ones(len(starts), np.int64)
        pieces[cut] = 2
        pieces, sizes = np.cumsum(pieces), np.cumsum(ends - starts)
        offsets = np.zeros(len(starts) + len(cut) + 1, np.int32)
        offsets[pieces] = sizes
        offsets[pieces[cut] - 1] = sizes[cut] - (ends[cut] - stems)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw.translate(None, b"\t\n\v\f\r "))]
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers), starts, np.append(0, pieces)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.young) > KEPT_WORDS:
            self.young, self.old = {}, self.young
        pieces, starts, first = self._split(b"\n".join(texts))
        pieces = pieces.dictionary_encode()
        distinct, young = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), self.young
        known = list(map(young.get, distinct))
        if new := [i for i, found in enumerate(known) if found is None]:
            self._learn([distinct[i] for i in new])
            for i in new:
                known[i] = young[distinct[i]]
        ids = np.frombuffer(b"".join(known), self.width)
        counts = np.fromiter(map(len, known), np.int64, len(known)) // self.width.itemsize
        at, which = np.cumsum(counts) - counts, pieces.indices.to_numpy()
        sizes = counts[which]
        after = np.cumsum(sizes)
        ids = ids[np.repeat(at[which] - after + sizes, sizes) + np.arange(int(sizes.sum()))]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        bounds = np.append(0, after)[first[np.searchsorted(starts, begins)]].tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def _spans(self, text: bytes) -> Iterator[bytes]:
        """The text cut at white space, in spans of at most TOGETHER bytes but for longer words."""
        at = 0
        while len(text) - at > self.TOGETHER:
            end = max(text.rfind(x, at + 1, at + self.TOGETHER) for x in WHITE)
            if end < 0:
                found = re.search(rb"[\x20\x09-\x0D]", memoryview(text)[at + self.TOGETHER :])
                end = at + self.TOGETHER + found.start() if found else len(text)
            yield text[at:end]
            at = end
        yield text[at:]

    def encode(self, texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        some, size = [], 0
        for text in texts:
            text = text or b""
            if some and size + len(text) > self.TOGETHER:
                yield from self._encode(some)
                some, size = [], 0
            if len(text) > self.TOGETHER:
                yield np.concatenate([self._encode([span])[0] for span in self._spans(text)])
            else:
                some.append(text)
                size += len(text)
        if some:
            yield from self._encode(some)


KINDS = bytes(SPACE if bytes([i]) in WHITE else SIGN if i in WordEncoder.SIGNS else PLAIN if bytes([i]).isalnum() else OTHER for i in range(256))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _schema(width: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(width), length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Packs ids into sequences and writes them batch by batch; holds one batch."""

    def __init__(self, sink, width: np.dtype, length: int = LENGTH):
        self.schema, self.length = _schema(width, length), length
        self.buffer, self.filled = np.zeros(length * SEQUENCES_PER_BATCH, width), 0
        self.file = pa.ipc.new_file(sink, self.schema)

    def write(self, ids: np.ndarray) -> None:
        while len(ids):
            n = min(len(ids), len(self.buffer) - self.filled)
            self.buffer[self.filled : self.filled + n] = ids[:n]
            self.filled, ids = self.filled + n, ids[n:]
            if self.filled == len(self.buffer):
                self._flush()

    def _flush(self) -> None:
        rows = -(-self.filled // self.length)
        mask = np.arange(rows * self.length) < self.filled
        ids = np.where(mask, self.buffer[: rows * self.length], 0).astype(self.buffer.dtype)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.filled = 0

    def close(self) -> None:
        if self.filled:
            self._flush()
        self.file.close()


class SequenceFile:
    """Random access to a file's sequences; nothing is copied from a mapped file."""

    def __init__(self, source):
        self.reader = pa.ipc.open_file(source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.per_batch, self.last = 0, (-1, None)
        if self.reader.num_record_batches:
            self.per_batch = self.reader.get_batch(0).num_rows

    def _ids(self, batch: int) -> np.ndarray:
        if self.last[0] != batch:
            column = self.reader.get_batch(batch).column(0)
            self.last = (batch, column.values.to_numpy(zero_copy_only=True))
        return self.last[1]

    def sequence(self, i: int) -> np.ndarray:
        at = i % self.per_batch * self.length
        return self._ids(i // self.per_batch)[at : at + self.length]

    def mask(self, i: int) -> np.ndarray:
        column = self.reader.get_batch(i // self.per_batch).column(1)
        return column[i % self.per_batch].values.to_numpy(zero_copy_only=False)

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from a place on, as views batch by batch."""
        size = self.per_batch * self.length
        while n > 0:
            ids = self._ids(start // size)[start % size :][:n]
            yield ids
            start, n = start + len(ids), n - len(ids)


def write_sequences(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID, length: int = LENGTH) -> list[tuple[str, int, int, int]]:
    """Writes the files; (name, first id, documents, ids) of each comes back, one row for each file.

    Files get their names when they are whole, so tasks may be run again.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():06d}"
        system, root = tx.open_folder(folder)
        docs_schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
        code = encoder(path)
        end = np.array([end_id], code.width)
        sinks, count, total = None, 0, 0
        hidden = [f"{root}/{tx.temporary_name(name)}{suffix}" for suffix in (".arrow", ".docs.arrow")]
        for batch in batches:
            if sinks is None and batch.num_rows:
                sinks = [system.open_output_stream(x) for x in hidden]
                out, listed = SequenceWriter(sinks[0], code.width, length), pa.ipc.new_file(sinks[1], docs_schema)
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sizes = []
                for ids in code.encode(tx.binary(part.column(1))):
                    out.write(ids)
                    out.write(end)
                    sizes.append(len(ids) + 1)
                listed.write_batch(pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64())], schema=docs_schema))
                count, total = count + len(sizes), total + sum(sizes)
        if sinks is not None:
            for closing in (out, listed, *sinks):
                closing.close()
            for x, suffix in zip(hidden, (".arrow", ".docs.arrow")):
                system.move(x, f"{root}/{name}{suffix}")
            yield pa.RecordBatch.from_pydict({"file": [name], "docs": [count], "ids": [total]})

    ordered = tx.text_rows(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = sorted((r.file, r.docs, r.ids) for r in tx.map_arrow(ordered, write, "file string, docs long, ids long").collect())
    first, out = 0, []
    for name, count, total in files:
        out.append((name, first, count, total))
        first += total
    return out


def read_sequences(spark: SparkSession, folder: str, files: list[tuple[str, int, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone; one file to a task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = tx.open_folder(folder)
        local = system.type_name == "local"
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source, listed = (
                    pa.memory_map(f"{root}/{name}{x}") if local else system.open_input_file(f"{root}/{name}{x}")
                    for x in (".arrow", ".docs.arrow")
                )
                with source, listed:
                    sequences, index, at = SequenceFile(source), pa.ipc.open_file(listed), 0
                    for i in range(index.num_record_batches):
                        rows = index.get_batch(i)
                        starts, sums = [], []
                        for n in rows.column(1).to_pylist():
                            crc = 0
                            for ids in sequences.span(at, n):
                                crc = zlib.crc32(ids.astype("<u4"), crc)
                            starts.append(first + at)
                            sums.append(crc)
                            at += n
                        yield pa.RecordBatch.from_arrays([pa.array(rows.column(0).to_pylist(), pa.int64()), pa.array(starts, pa.int64()), pa.array(rows.column(1).to_pylist(), pa.int64()), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    listed = tx.one_task_each(spark, files, "file string, first long, docs long, ids long")
    return tx.map_arrow(listed, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tx.output_folder(spark, "sequences")
    files = write_sequences(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_sequences(spark, folder, files)
