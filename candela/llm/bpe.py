"""Operator 2: byte-level BPE through a lazily determinised finite-state transducer.

A byte sequence's encoding ends in exactly one token for each of its prefixes,
and a token may follow another if and only if the two, joined, encode to just
that pair. So the merges compile to a nondeterministic machine that guesses
token ends: a hypothesis is the last token so far and a place in the trie of the
vocabulary. The transducer runs all live hypotheses at once. Its deterministic
states (the sets of hypotheses) and its arcs are made when first needed and kept,
and no hypothesis outlives the longest vocabulary entry. Each state emits the
last token of the prefix that leads to it; the tokens of the piece are read off
from its end, each as many bytes before the next one's end as that is long. The
states that are kept are bounded: once they are full, all but the one that the
piece has come to are dropped and made anew as they are needed, so every piece
goes through the transducer, however long it is.

Decoding is a machine over tokens: its state is the bytes of an unfinished
UTF-8 character, an arc is a token, and the arcs are made when first needed.

Null texts encode to no tokens, as empty ones do. Repeated rows are encoded one by one.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache
from itertools import accumulate
from operator import getitem

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candela.llm import text as tx

#: Deterministic states that are kept, and words in each of the two generations whose tokens are remembered; results do not depend on them.
KEPT_STATES = 190_000
KEPT_WORDS = 120_000
#: Pairs of tokens whose test is remembered.
KEPT_PAIRS = 300_000


class Vocabulary:
    """Ranks, the trie of the entries, and which entries may stand side by side."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in file if line.strip())}
        self.words = {rank: word for word, rank in self.ranks.items()}
        #: trie: node -> byte -> node; ends: the token that ends at a node, or -1. Node 0 is the root.
        leaf: dict[int, int] = {}
        self.trie: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for word, rank in self.ranks.items():
            node = 0
            for byte in word:
                below = self.trie[node].get(byte)
                if below is None:
                    if self.trie[node] is leaf:
                        self.trie[node] = {}
                    below = self.trie[node][byte] = len(self.trie)
                    self.trie.append(leaf)
                    self.ends.append(-1)
                node = below
            self.ends[node] = rank
        self.pairs: dict[int, bool] = {}
        #: A rank beyond all.
        self.beyond = 1 + max(self.words, default=0)
        self.parts: dict[int, tuple] = {}

    def edges(self, token: int) -> tuple[list[tuple[bytes, int]], ...]:
        """The parts at an entry's left and right edge from single bytes up, each with the rank of the merge that ends its life (no merge: a rank beyond all).

        Entries that their own bytes do not merge into are never emitted and have none.
        """
        known = self.parts.get(token)
        if known is None:
            word, known = self.words[token], ()
            if len(word) == 1:
                known = ([(word, self.beyond)],) * 2
            else:
                halves = self.merge(word, keep=2)
                if len(halves) == 2 and self.ranks.get(halves[0] + halves[1]) == token:
                    outer = self.edges(self.ranks[halves[0]]), self.edges(self.ranks[halves[1]])
                    if all(outer):
                        known = tuple([*of[side][:-1], (of[side][-1][0], token), (word, self.beyond)] for side, of in enumerate(outer))
            self.parts[token] = known
        return known

    def merge(self, word: bytes, keep: int = 1) -> list[bytes]:
        """The definition: merge the adjacent pair of the lowest rank, leftmost first, until none is left (or ``keep`` parts are)."""
        parts = [word[i : i + 1] for i in range(len(word))]
        ranks = self.ranks
        while len(parts) > keep:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the two, joined, encode to just this pair. left < 0: the start."""
        if left < 0:
            return bool(self.edges(right))
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = bool(self.edges(right)) and self._holds(left, right)
        return known

    def _holds(self, left: int, right: int) -> bool:
        """Replays both merges side by side: the pair holds unless the parts that meet at the seam would merge first."""
        ours, theirs, i, j, ranks = self.edges(left)[1], self.edges(right)[0], 0, 0, self.ranks
        while True:
            (a, a_ends), (b, b_ends) = ours[i], theirs[j]
            seam = ranks.get(a + b)
            # At equal rank the leftmost merge goes first: ours before the seam, the seam before theirs.
            if seam is not None and seam < a_ends and seam <= b_ends:
                return False
            if i + 1 == len(ours) and j + 1 == len(theirs):
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1


class State(dict):
    """A deterministic state: byte -> state. An arc is made when first taken."""

    __slots__ = ("machine", "number", "token")

    def __init__(self, machine: Transducer, number: int, token: int):
        self.machine, self.number, self.token = machine, number, token

    def __missing__(self, byte: int) -> State:
        return self.machine.make(self, byte)


class Transducer:
    """Bytes in, tokens out.

    A state is a row of hypotheses, 64-bit numbers that are kept as bytes: the
    last token (or -1) and the trie node since. Exactly one hypothesis has just ended a token,
    so the states along a word tell the last token of each of its prefixes; read
    from the end, each token says where the one before it ends.
    """

    #: Bits of a trie node in a hypothesis; the number above them is 1 + the last token.
    NODE = 32
    LOW = (1 << NODE) - 1
    START = array("q", [0]).tobytes()

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.sizes = {rank: len(word) for rank, word in vocabulary.words.items()}
        self.restarts = -1
        self.nodes: list[State] = []
        self.restart(self.START)

    def restart(self, state: bytes, node: State | None = None) -> None:
        """Drops all states but the start and this one."""
        self.restarts += 1
        for dropped in self.nodes:
            dropped.clear()
        self.states: list[bytes] = [self.START] if state == self.START else [self.START, state]
        #: The token that each state has just ended.
        self.ended: list[int] = [(array("q", s)[-1] >> self.NODE) - 1 for s in self.states]
        self.nodes = [State(self, i, token) for i, token in enumerate(self.ended)]
        if node is not None:
            node.number = len(self.nodes) - 1
            self.nodes[-1] = node
        self.numbers: dict[bytes, State] = dict(zip(self.states, self.nodes))

    def make(self, node: State, byte: int) -> State:
        """Determinises one arc."""
        hypotheses = self.states[node.number]
        if len(self.states) > KEPT_STATES:
            self.restart(hypotheses, node)
        v, moved, ended, bits, low = self.vocabulary, [], -1, self.NODE, self.LOW
        trie, ends, pairs = v.trie, v.ends, v.pairs
        for hypothesis in array("q", hypotheses):
            at = hypothesis & low
            below = trie[at].get(byte)
            if below is None:
                continue
            if ended < 0:
                token = ends[below]
                if token >= 0:
                    last = (hypothesis >> bits) - 1
                    holds = pairs.get(last << 32 | token) if last >= 0 else None
                    if v.may_follow(last, token) if holds is None else holds:
                        ended = token
            if trie[below]:
                moved.append(hypothesis - at + below)
        moved.append(ended + 1 << bits)
        target = array("q", moved).tobytes()
        found = self.numbers.get(target)
        if found is None:
            found = self.numbers[target] = State(self, len(self.states), ended)
            self.nodes.append(found)
            self.states.append(target)
            self.ended.append(ended)
        node[byte] = found
        return found

    def arc(self, state: int, byte: int) -> int:
        return self.nodes[state][byte].number

    def run(self, word: bytes) -> list[int]:
        path = list(accumulate(word, getitem, initial=self.nodes[0]))
        out, at, sizes = [], len(word), self.sizes
        while at:
            token = path[at].token
            out.append(token)
            at -= sizes[token]
        out.reverse()
        return out


#: The first bytes of UTF-8 characters, as (low, high, following bytes, range of the first of these).
UTF8_LEADS = (
    (0xC2, 0xDF, 1, 0x80, 0xBF),
    (0xE0, 0xE0, 2, 0xA0, 0xBF),
    (0xE1, 0xEC, 2, 0x80, 0xBF),
    (0xED, 0xED, 2, 0x80, 0x9F),
    (0xEE, 0xEF, 2, 0x80, 0xBF),
    (0xF0, 0xF0, 3, 0x90, 0xBF),
    (0xF1, 0xF3, 3, 0x80, 0xBF),
    (0xF4, 0xF4, 3, 0x80, 0x8F),
)
_LEAD = {byte: (n, low, high) for a, b, n, low, high in UTF8_LEADS for byte in range(a, b + 1)}


def utf8_step(pending: bytes, data: bytes) -> tuple[str, bytes]:
    """The UTF-8 machine: what ``data`` after ``pending`` completes, and the bytes of the character left open.

    Each longest valid beginning of a character that cannot go on becomes U+FFFD.
    """
    buffer, at, out = pending + data, 0, []
    size = len(buffer)
    while at < size:
        lead = buffer[at]
        if lead < 0x80:
            out.append(chr(lead))
            at += 1
            continue
        if lead not in _LEAD:
            out.append("�")
            at += 1
            continue
        follow, low, high = _LEAD[lead]
        value, taken = lead & (0x3F >> follow), 1
        while taken <= follow and at + taken < size and low <= buffer[at + taken] <= high:
            value = value << 6 | buffer[at + taken] & 0x3F
            taken, low, high = taken + 1, 0x80, 0xBF
        if taken > follow:
            out.append(chr(value))
        elif at + taken == size:
            return "".join(out), buffer[at:]
        else:
            out.append("�")
        at += taken
    return "".join(out), b""


class StreamDecoder:
    """Tokens in, text out, token by token; state 0 is between characters."""

    def __init__(self, vocabulary: Vocabulary):
        self.words = vocabulary.words
        self.arcs: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}
        #: The texts of the arcs from state 0 to itself, which are taken together; None for others.
        self.whole = np.full(1 + max(self.words, default=0), None, object)

    def decode(self, ids: np.ndarray | list[int]) -> str:
        texts = self.whole[np.asarray(ids, np.int64)]
        try:
            return "".join(texts.tolist())
        except TypeError:  # an arc of another kind, or one that is not made yet
            return self._steps(np.asarray(ids).tolist())

    def _steps(self, ids: list[int]) -> str:
        out, pending = [], b""
        arcs = self.arcs[b""]
        for token in ids:
            step = arcs.get(token)
            if step is None:
                step = arcs[token] = utf8_step(pending, self.words[token])
                if not pending and not step[1]:
                    self.whole[token] = step[0]
            text, after = step
            out.append(text)
            if after != pending:
                pending = after
                arcs = self.arcs.setdefault(pending, {})
        return "".join(out) + ("�" if pending else "")


class Splitter:
    """Matches of a pattern. Texts of Latin-1 characters use the standard library, others the regex module.

    The fast form has the pattern's character classes spelt out for code points
    up to 255, so both give the same matches.
    """

    CLASSES = {r"\p{L}": r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"\p{N}": r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\s": r"\t-\r \x85\xa0"}
    LATIN1 = re.compile(r"[^\x00-\xff]")

    def __init__(self, pattern: str):
        import regex

        self.full = regex.compile(pattern)
        plain = pattern
        for name, spelt in self.CLASSES.items():
            plain = re.sub(rf"(?<!\[)(\[\^[^\]]*)?{re.escape(name)}", lambda m, s=spelt: f"{m[1]}{s}" if m[1] else f"[{s}]", plain)
        while any(name in plain for name in self.CLASSES):
            for name, spelt in self.CLASSES.items():
                plain = plain.replace(name, spelt)
        self.fast = re.compile(plain.replace(r"\S", f"[^{self.CLASSES[chr(92) + 's']}]"))

    def split(self, text: str) -> list[str]:
        return (self.full if self.LATIN1.search(text) else self.fast).findall(text)


class Pieces(dict):
    """Piece -> ids as bytes. A piece that is in no generation goes through the transducer."""

    __slots__ = ("transducer", "old", "long")

    def __init__(self, transducer: Transducer, old: dict[str, bytes]):
        self.transducer, self.old, self.long = transducer, old, []

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("i", self.transducer.run(piece.encode())).tobytes()
        self[piece] = ids
        if len(piece) >= 64:  # remembered for the rest of its text
            self.long.append(piece)
        return ids


class Codec:
    """Encodes each match of the pattern on its own; decodes token streams."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path)
        self.transducer = Transducer(self.vocabulary)
        self.splitter = Splitter(pattern)
        self.decoder = StreamDecoder(self.vocabulary)
        #: The ids of pieces as 32-bit numbers; a piece that is met again moves to the younger generation.
        self.young = Pieces(self.transducer, {})

    @property
    def old(self) -> dict[str, bytes]:
        return self.young.old

    def encode(self, text: str) -> np.ndarray:
        if len(self.young) > KEPT_WORDS:
            self.young = Pieces(self.transducer, dict(self.young))
        young = self.young
        ids = np.frombuffer(b"".join(map(young.__getitem__, self.splitter.split(text))), np.int32)
        while young.long:
            del young[young.long.pop()]
        return ids

    def decode(self, ids: np.ndarray | list[int]) -> str:
        return self.decoder.decode(ids)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One for each Python worker."""
    return Codec(path, pattern)


def _defaults(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ``ids`` (the tokens of the whole text) and ``decoded`` (the text that the tokens decode to)."""
    path, pattern = _defaults(path, pattern)

    def run(batch: pa.RecordBatch):
        c = codec(path, pattern)
        ids_out, text_out, at, size = [], [], 0, 0
        for i, value in enumerate(batch.column(1).to_pylist()):
            ids = c.encode(value or "")
            ids_out.append(pa.array(ids))
            text_out.append(c.decode(ids))
            size += len(ids)
            if size > 2_000_000:
                yield {"doc_id": batch.column(0).slice(at, i + 1 - at), "ids": _lists(ids_out), "decoded": text_out}
                ids_out, text_out, at, size = [], [], i + 1, 0
        if ids_out:
            yield {"doc_id": batch.column(0).slice(at, len(ids_out)), "ids": _lists(ids_out), "decoded": text_out}

    return tx.map_batches(tx.text_rows(docs, id_col, text_col), run, "doc_id long, ids array<int>, decoded string")


def _lists(parts: list[pa.Array]) -> pa.Array:
    offsets = [0]
    for p in parts:
        offsets.append(offsets[-1] + len(p))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(parts))


def digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
