"""The ten operators against plain versions, on small tables with every awkward case."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from candela.llm import automaton, bpe, decontaminate, near_dup, pii, pitman_yor, quality, repeats, sequences, suffix_sort, text as tx, warc
from candela.llm.components import components
from tests.llm import brute

DOCS = "doc_id long, text string, kept string, n_words string, Spans string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "Über", "naïve", "lorem", "ipsum", "dolor", "sit", "amet", "x1", "y2"]) + rng.choice(["", "", ".", "s"]) for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls, empty and blank texts, repeated rows, near copies, shared passages, a very long text, periodic texts."""
    passage = prose(1, 60)
    long_ = prose(2, 6000)
    base = prose(3, 200).split(" ")
    near = [list(base) for _ in range(6)]
    for i, words in enumerate(near):
        words[10 * i] = f"edit{i}"
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r"),
        (4, "one"),
        (5, "two words"),
        (6, "two\nWORDS"),
        (7, passage),
        (8, prose(4, 80) + "\n" + passage + " " + prose(5, 50)),
        (9, prose(6, 30) + " " + passage.upper()),
        (10, long_),
        (11, "tail " + long_),
        (12, "a " * 300),
        (13, "a b " * 150),
        (None, prose(7, 50)),
        (None, None),
        (14, prose(8, 90)),
        (14, prose(8, 90)),
        (14, prose(9, 90)),
        (15, "é中😀 \x85 \x1c\x00 é 'll 12½ " * 20),
        (16, "line one is here\nline one is here\n\n  \nline two " + prose(10, 20)),
        (-17, "#*$ %&|<> " + prose(11, 15)),
    ]
    rows += [(20 + i, " ".join(words)) for i, words in enumerate(near)]
    return [(i, t, "clash", "clash", "clash") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(awkward(), DOCS).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def test_op7_measures_and_filter(docs, none):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    want = Counter()
    for doc_id, text, *_ in awkward():
        q = brute.quality(text)
        want[(doc_id, *(q[n] for n in names))] += 1
    assert rows_of(quality.quality_measures(docs), "doc_id", *names) == want
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text") == Counter((r[0], r[1]) for r in awkward() if brute.quality(r[1])["kept"])
    assert quality.quality_measures(none).collect() == []


def test_op7_order_changes_no_verdict():
    for _, text, *_ in awkward():
        data = text.encode() if text is not None else None
        names = list(quality.RULES)
        verdicts = {quality.judge(quality.Measures(data), order) is None for order in (names, names[::-1])}
        assert len(verdicts) == 1
    assert quality.order_rules([("few_words", 1.0, 0.5), ("symbols", 0.1, 0.5)])[:2] == ["symbols", "few_words"]


PERSONAL = [
    "mail a.b%c@d-e.f.g.co.uk, a@b.c%x@d.e and a@b not @x.y",
    "1.2.3.4.5.6.7.8 and 300.1.1.1 and 255.255.255.255 and 0001.02.3.4",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111111111111111 5500 0000 0000 0004 12",
    "call +1 (415) 555-2671 or +1234 or +49 30 1234567890 +44.20.7946.0958-",
    "DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 and DE89 3704 0044 0532 0130 01",
    '987-65-4321 first, ssn 123-45-6789 token = "0123456789abcdef0123"',
    "é😀 x@y.zz 😀 10.0.0.1",
    "9" * 5000 + " " + "a." * 5000 + "@" + "b." * 3000 + "c " + "1.1." * 3000 + "+1" + " (" * 3000 + "9",
]


def test_op9_spans(spark, docs, none):
    rows = [(100 + i, t) for i, t in enumerate(PERSONAL)]
    some = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    want = Counter()
    for doc_id, text in rows + [(r[0], r[1]) for r in awkward()]:
        found = brute.base_pii(text)
        kinds = Counter(k for k, _, _ in found)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        want[(doc_id, *(kinds[k] for k in ("email", "ip", "card", "phone")), hashlib.sha256(listed.encode()).hexdigest())] += 1
    out = pii.pii_report(some)
    assert rows_of(out, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want
    spans = {r.doc_id: r.spans for r in out.where("doc_id between 100 and 110").collect()}
    assert "iban:0:27,iban:32:54" in spans[104] and "iban:59" not in spans[104]
    assert spans[105] == "ssn:23:34,secret:35:65"
    assert pii.pii_report(none).collect() == []


def test_op9_redacts(spark, docs):
    rows = spark.createDataFrame([(1, "to é a@b.cc and 1.2.3.4!", "x"), (2, None, "x"), (3, "", "x"), (4, "+1 415 555 26711111", "x")], "doc_id long, text string, spans string")
    out = pii.redact(rows)
    assert out.columns == rows.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "to é <EMAIL> and <IP>!", 2: None, 3: "", 4: "<PHONE>"}


def test_op9_text_of_many_spans(spark):
    """Chunks of any size give what the patterns give; context words are found over several spans and gaps."""
    rng = random.Random(19)
    parts, want, at = [], [], 0
    for i in range(6000):
        gap = rng.choice((" ", " mail ", " \U0001f600 no word of it ", "; contact: ", " 1 2 "))
        address = f"u{i}@ex{i % 7}.org"
        at += len(gap)
        want.append((at, at + len(address)))
        parts += [gap, address]
        at += len(address)
    text = "".join(parts)
    spans = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    emails = [s for s in spans if s.kind == "email"]
    assert [(s.start, s.end) for s in emails] == want
    for s in emails:
        near = re.search(r"\b(mail|contact|write)", text[max(0, s.start - 40) : s.start].lower()) is not None
        assert s.score == (1.0 if near else 0.7)
    clean = pii.redact(spark.createDataFrame([(1, text), (2, None), (3, "none")], "doc_id long, text string"))
    assert {r.doc_id: r.text for r in clean.collect()} == {1: "".join(g if i % 2 == 0 else "<EMAIL>" for i, g in enumerate(parts)), 2: None, 3: "none"}


def test_op9_has_no_python(docs):
    plan = pii.pii_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_op5_round_trip(spark):
    pages = [(1, "http://a.b/c d\r\nX: y", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "http://a.b", "<p>é</p>"), (5, "x", "alone\r\n\r\n"), (None, "n", "<p>é</p>"), (None, "n", "other"), (6, "r", "twice"), (6, "r", "twice"), (7, "l", "z" * 300_000)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, payload_bytes string")
    want = Counter()
    for page_id, _, html in pages:
        data = (html or "").encode()
        top = max((p for p, _, h in pages if (h or "") == (html or "") and p is not None), default=None)
        main = top is None or page_id == top
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[(page_id, len(data), digest, "response" if main else "revisit", None if main else top)] += 1
    assert rows_of(warc.capture_report(df), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == want
    full = {r.page_id: r for r in warc.round_trip(df).collect() if r.page_id is not None}
    assert bytes(full[5].response.payload) == b"alone\r\n\r\n" and full[4].request.head.startswith("GET / HTTP/1.1")
    assert full[1].response.uri.startswith("http://a.b/c%20d%0D%0AX") and full[1].response.warc_type == "revisit"
    assert warc.capture_report(df.limit(0)).collect() == []


@pytest.fixture(scope="module")
def codec():
    import public_tokenizers as P

    return bpe.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def reference_encoding():
    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op2_like_the_library(docs, none, reference_encoding):
    want = Counter()
    for doc_id, text, *_ in awkward():
        ids = reference_encoding.encode_ordinary(text or "")
        want[(doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert rows_of(bpe.digests(bpe.encode_decode(docs)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert bpe.digests(bpe.encode_decode(none)).collect() == []


def test_op2_transducer_keeps_or_makes_its_states_anew(codec, reference_encoding, monkeypatch):
    rng = random.Random(5)
    alphabet = "aabbé ß\n\t  \x1c\x85\xa0²½ªº'sll'ré9٣中文😀　​{}-_=+__   ABCthe ing \x00"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["a" * 3000, "=-" * 500, " " * 700 + "x"]
    for kept in (bpe.KEPT_STATES, 40, 0):
        monkeypatch.setattr(bpe, "KEPT_STATES", kept)
        transducer = bpe.Transducer(codec.vocabulary)
        for text in texts:
            ids = [t for piece in codec.splitter.split(text) for t in transducer.run(piece.encode())]
            assert ids == reference_encoding.encode_ordinary(text)
            assert codec.decode(ids) == text
            assert len(transducer.states) <= max(kept + 1, 3)  # two stay when states are dropped, and the next is made
        assert (transducer.restarts > 0) == (kept <= 40)


def test_op2_states_tell_the_last_token_of_each_prefix(codec, reference_encoding):
    rng = random.Random(15)
    transducer = bpe.Transducer(codec.vocabulary)
    for _ in range(300):
        word = "".join(rng.choices("eaitnrshoul", k=rng.randint(1, 14)))
        state = 0
        for i, byte in enumerate(word.encode()):
            state = transducer.arc(state, byte)
            assert transducer.ended[state] == reference_encoding.encode_ordinary(word[: i + 1])[-1]
            assert all(isinstance(hypothesis, int) for hypothesis in transducer.states[state])
        assert transducer.run(word.encode()) == reference_encoding.encode_ordinary(word)


def test_op2_pieces_are_remembered_in_two_generations(codec, reference_encoding, monkeypatch):
    runs, run = [], bpe.Transducer.run
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    monkeypatch.setattr(bpe.Transducer, "run", lambda self, word: runs.append(word) or run(self, word))
    for at in range(40):
        text = "common " + " ".join(f"w{chr(97 + at // 26)}{chr(97 + at % 26)}{chr(97 + i)}" for i in range(20)) + " " + "=" * 80
        assert list(codec.encode(text)) == reference_encoding.encode_ordinary(text)
        assert len(codec.young) <= 100 and not any(len(p) >= 64 for p in codec.young)
    assert runs.count(b"common") == 1


def test_op2_pieces_of_a_large_corpus_go_through_the_transducer_once(reference_encoding, monkeypatch):
    import public_tokenizers as P

    runs, run = Counter(), bpe.Transducer.run
    monkeypatch.setattr(bpe.Transducer, "run", lambda self, word: runs.update([word]) or run(self, word))
    codec = bpe.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    letters = "abcdefghijkl"
    words = ["".join(w) for w in itertools.islice(itertools.product(letters, repeat=5), 115_000)]
    texts = [" " + " ".join(words[at : at + 2000]) for at in range(0, len(words), 2000)]
    for text in texts * 2:
        codec.encode(text)
    assert len(runs) == len(words) and max(runs.values()) == 1
    assert codec.transducer.restarts == 0
    for text in (texts[-1], "whole words", "a 😀 in parts", "\x00é"):
        for _ in range(2):  # arcs are made, then taken together
            ids = codec.encode(text)
            assert ids.tolist() == reference_encoding.encode_ordinary(text) and codec.decode(ids) == text


def test_op2_pairs_by_definition(codec):
    v, rng = codec.vocabulary, random.Random(6)
    for _ in range(2000):
        left, right = rng.randrange(len(v.words)), rng.randrange(300 if rng.random() < 0.5 else len(v.words))
        assert v.may_follow(left, right) == (v.merge(v.words[left] + v.words[right]) == [v.words[left], v.words[right]])


def test_op2_utf8_machine():
    rng = random.Random(7)
    for _ in range(2000):
        data = bytes(rng.choice([rng.randrange(256), 0xE4, 0xB8, 0xAD, 0xF0, 0x9F, 0x98, 0x80, 65]) for _ in range(12))
        cut = sorted(rng.randrange(13) for _ in range(2))
        out, pending = "", b""
        for part in (data[: cut[0]], data[cut[0] : cut[1]], data[cut[1] :]):
            text, pending = bpe.utf8_step(pending, part)
            out += text
        assert out + ("�" if pending else "") == data.decode("utf-8", "replace")


def test_op4_letters_are_encoded_together():
    import public_tokenizers as P

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    rng = random.Random(16)
    letters = ["".join(rng.choices("eaitnrshéßΣςﬁª中각ǅ", k=rng.randint(1, 9))) for _ in range(2000)]
    odd = ["İstanbul", "ΟΔΟΣ", "a1b2", "it's", "x<|endoftext|>y", "a\xa0b", "\u0301a", "e\u0301", "½", "</w>", "a</w>", "\x1c", "😀", "o.k.", "#", "end.", "é.,"]
    texts = [" ".join(rng.sample(letters + odd * 20, 60)) for _ in range(100)]
    encoder = sequences.WordEncoder(P.path("word_bpe_49k.json"))
    tokenizer, encoder.tokenizer = encoder.tokenizer, Counted(encoder.tokenizer)
    found = [ids.tolist() for ids in encoder.encode([t.encode() for t in texts])]
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.tokenizer.texts < 200 and len(set(" ".join(texts).lower().split())) > 1500  # the dotted I is two pieces: its hundred go alone

    # without marks, or where they don't part the pieces, each is a text of its own
    for marked in (np.zeros(0, bool), np.zeros_like(encoder.marked), np.ones_like(encoder.marked)):
        plain = sequences.WordEncoder(P.path("word_bpe_49k.json"))
        plain.marked = marked
        assert [ids.tolist() for ids in plain.encode([t.encode() for t in texts])] == found


def test_op4_words_are_looked_up_once():
    import public_tokenizers as P

    class Counted(dict):
        looked_up = 0

        def get(self, key, default=None):
            self.looked_up += 1
            return super().get(key, default)

        def __getitem__(self, key):
            self.looked_up += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            self.looked_up += 1
            return super().__contains__(key)

    rng = random.Random(17)
    words = ["".join(rng.choices("abcdefghij", k=6)) + str(i) for i in range(200)]
    signs = ["", ".", ",", "!!", "?", ";", ":", "***", "#", "&&"]
    texts = [" ".join(rng.choice(words) + rng.choice(signs) for _ in range(500)) for _ in range(40)]
    encoder = sequences.WordEncoder(P.path("word_bpe_49k.json"))
    encoder.young = young = Counted()
    found = [ids.tolist() for ids in encoder.encode([t.encode() for t in texts])]
    assert found == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    # 20,000 words, 2,000 distinct, of 200 stems and nine runs of signs
    assert young.looked_up < 1000 and len(young) < 250
    pieces, starts, first = encoder._split(b" ab" + b"#!" * 1_000_000 + b"\n...\xc3\xa9. ..")
    assert [len(p.as_py()) for p in pieces] == [2, 2_000_000, 6, 2] and first.tolist() == [0, 2, 3, 4]


def test_op4_odd_texts(monkeypatch):
    import public_tokenizers as P

    rng = random.Random(18)
    odd = ["<|endoftext|>", "<|ENDOFTEXT|>", "A<|EndOfText|>.", "x<|startoftext|>..", "Y<|STARTOFTEXT|>9!", "<|", "T|>", "END.", "É.,", "1.2.", "...", ".a", "a.", "×.", "it's.", "'S!", "\u212a.", "e\u0301!", "a\x1c.", "\u2003.", "\x85,"]
    plain = ["the", "The.", "\n\n", "\t", "#"]
    texts = [" ".join(rng.choices(plain + odd * (i % 2), k=rng.randint(0, 40))) for i in range(60)] + ["", " ", "\x0b\x0c\r", " a", "b ", "." * 300, "a" * 300, "ab. " * 100, " " * 300]
    for together in (1, 7, 64, 1000, 4_000_000):
        encoder = sequences.WordEncoder(P.path("word_bpe_49k.json"))
        encoder.TOGETHER = together
        found = [ids.tolist() for ids in encoder.encode([t.encode() for t in texts])]
        assert found == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(encoder.encode([])) == [] and [len(ids) for ids in encoder.encode([None, b"", None])] == [0, 0, 0]

    # what was remembered in two generations gives the same ids
    monkeypatch.setattr(sequences, "KEPT_WORDS", 5)
    encoder.TOGETHER = 200
    for _ in range(2):
        assert [ids.tolist() for ids in encoder.encode([t.encode() for t in texts])] == found


def test_op4_files(spark, docs, none, tmp_path):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    folder = f"file://{tmp_path}/files"
    files = sequences.write_sequences(docs, folder, length=64)
    want, start = Counter(), 0
    ordered = sorted(((r[0], r[1]) for r in awkward()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for doc_id, text in ordered:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want[(doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        start += len(ids)
    assert rows_of(sequences.read_sequences(spark, folder, files), "doc_id", "start", "n_tokens", "ids_crc32") == want
    import pyarrow as pa

    with pa.memory_map(f"{tmp_path}/files/{files[0][0]}.arrow") as source:
        file = sequences.SequenceFile(source)
        assert not file.sequence(0).flags.owndata and len(file.sequence(0)) == len(file.mask(0)) == 64
        last = -(-files[0][3] // 64) - 1
        assert int(file.mask(last).sum()) == files[0][3] - 64 * last
    assert sequences.write_sequences(none, f"file://{tmp_path}/none") == []


def test_op4_no_files_no_rows(spark, none, monkeypatch):
    folder = tx.output_folder(spark, "none")
    assert sequences.read_sequences(spark, folder, sequences.write_sequences(none, folder)).collect() == []


def plain_tiles(doc, item, least):
    return sum(n for *_, n in plain_tile_list(doc, item, least))


def plain_tile_list(doc, item, least):
    """Greedy string tiling by definition: the longest unmarked common run first, ties by place in the item, then the document."""
    used_d, used_i, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and not used_d[i + n] and not used_i[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        for k in range(n):
            used_d[i + k] = used_i[j + k] = True
        tiles.append((i, j, n))


def test_op6_tiling_by_definition():
    rng = random.Random(8)
    for _ in range(150):
        item = [rng.randrange(6) for _ in range(rng.randint(0, 25))]
        doc = [rng.randrange(6) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5 and len(item) > 8:
            doc[5:5] = item[6:] + [9] + item[:6]
        arrays = [np.array(x, np.uint64) * tx.U64(7919) + tx.U64(1) for x in (doc, item)]
        tiles = decontaminate.tile(*arrays, least=3)
        assert sum(n for *_, n in tiles) == plain_tiles(doc, item, 3)
        for side in (0, 1):
            marked = [p for t in tiles for p in range(t[side], t[side] + t[2])]
            assert len(marked) == len(set(marked))
        assert all(doc[i : i + n] == item[j : j + n] for i, j, n in tiles)


def test_op6_tiles_in_the_order_of_the_definition():
    rng = random.Random(18)
    for _ in range(150):
        letters = rng.choice((2, 3, 6))
        item = [rng.randrange(letters) for _ in range(rng.randint(0, 30))]
        doc = [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
        arrays = [np.array(x, np.uint64) * tx.U64(7919) + tx.U64(1) for x in (doc, item)]
        assert decontaminate.tile(*arrays, least=3) == plain_tile_list(doc, item, 3)


def test_op6_periodic_text_stays_small():
    """A million words of period seven against an item of the same words: 8,000,000 pairs of windows and more."""
    import tracemalloc

    text = np.tile(np.arange(1, 8, dtype=np.uint64) * tx.U64(7919), 150_000)
    item = np.tile(text[:7], 9)[:60]
    tracemalloc.start()
    tiles = decontaminate.tile(text, item)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tiles == [(0, 0, 60)]
    assert peak < 500_000_000


def test_op6_finds_reordered_passages(spark, docs, none):
    item = prose(30, 40)
    words = item.split(" ")
    moved = re.sub("[a-z]", lambda m: m[0].upper(), " ".join(words[20:] + ["between"] + words[:20])).replace(" ", ", ")
    rows = [(1, f"before {item} after", "c"), (2, moved, "c"), (3, " ".join(words[:20]), "c"), (4, None, "c"), (5, "", "c"), (6, prose(31, 400), "c"), (None, item, "c")]
    some = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([(10, item, "x"), (11, None, "x"), (12, "too few", "x"), (13, prose(32, 50), "x"), (14, " ... ", "x")], "item_id long, text string, doc_id string")
    for shard_words in (decontaminate.SHARD_WORDS, 20):
        found = decontaminate.find_contamination(some, benchmark, shard_words=shard_words)
        assert rows_of(found, "doc_id", "item_id") == Counter({(1, 10): 1, (2, 10): 1, (None, 10): 1})
        kept = decontaminate.drop_contaminated(some, benchmark, shard_words=shard_words)
        assert kept.columns == some.columns and rows_of(kept, "doc_id") == Counter({(3,): 1, (4,): 1, (5,): 1, (6,): 1})
    assert decontaminate.find_contamination(some, benchmark.limit(0)).collect() == []
    assert decontaminate.find_contamination(none, benchmark).collect() == []


def test_op6_items_shorter_than_a_seed(spark):
    items = [(1, "Alpha, beta gamma"), (2, "delta"), (3, "alpha gamma"), (4, ""), (5, "one two three four"), (5, "one two three four"), (6, "one two three four five")]
    texts = [(1, "x alpha beta GAMMA y"), (2, "alpha"), (3, "delta"), (4, "gamma delta alpha beta"), (5, None), (6, ""), (7, "zero one two three four five six"), (8, "one two three, four")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, text in texts:
        words = [w.decode() for w in decontaminate.normal_words((text or "").encode())]
        for i, item in items[:5]:
            whole = [w.decode() for w in decontaminate.normal_words(item.encode())]
            if whole and any(words[k : k + len(whole)] == whole for k in range(len(words))):
                want.add((d, i))
    want.add((7, 6))
    for shard_words in (decontaminate.SHARD_WORDS, 4):
        found = decontaminate.find_contamination(docs, benchmark, shard_words=shard_words)
        got = rows_of(found, "doc_id", "item_id")
        assert set(got) == want and got[(7, 5)] == got[(8, 5)] == 2  # a repeated item has rows of its own
        kept = decontaminate.drop_contaminated(docs, benchmark, shard_words=shard_words)
        assert rows_of(kept, "doc_id") == Counter((d,) for d, _ in texts if d not in {x for x, _ in want})


def labels(rows, size, percent=80):
    """doc -> (set size, component id) for rows with any ids; equal ids are told apart by place."""
    sets = [brute.shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [r[0] for k, r in enumerate(rows) if find(k) == find(i) and r[0] is not None]
        component = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out, [find(i) for i in range(len(rows))], sets


def test_op3_components(docs, none):
    want, _, _ = labels([(r[0], r[1]) for r in awkward()], 4)
    assert rows_of(near_dup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == Counter(want)
    assert near_dup.near_duplicates(none).collect() == []


def family(seed: int, n: int) -> list[str]:
    """Near copies around the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(120)] = f"e{rng.randrange(10_000)}"
        out.append(" ".join(words))
    return out


def test_op3_family_in_blocks(spark, monkeypatch):
    rows = list(enumerate(family(1, 70) + family(2, 30) + [prose(40 + i, 100) for i in range(20)]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, _, _ = labels(rows, 4)
    for size in (near_dup.GROUP_BYTES, 20_000):
        monkeypatch.setattr(near_dup, "GROUP_BYTES", size)
        assert rows_of(near_dup.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept") == Counter(want)


def test_op3_one_of_each_stays(docs):
    rows = [(r[0], r[1]) for r in awkward()]
    _, roots, sets = labels(rows, 5)
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = rows_of(kept, "doc_id", "text")
    empty = Counter(rows[i] for i, s in enumerate(sets) if not s)
    groups = {roots[i] for i, s in enumerate(sets) if s}
    assert sum(got.values()) == sum(empty.values()) + len(groups)
    assert all(got[r] == n for r, n in empty.items())


@pytest.mark.parametrize("percent", [45, 65, 95])
def test_op3_any_percent(spark, percent):
    """Pairs just at or above the threshold: no link is lost."""
    rng = random.Random(percent)
    rows = []
    for _ in range(150):
        words = [f"w{rng.randrange(10**6)}" for _ in range(123)]  # 120 shingles; a new tail of k words leaves 120 - k
        common = -(-2 * 120 * percent // (100 + percent)) + rng.randint(0, 1)
        tail = 120 - common
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[: 123 - tail] + [f"t{rng.randrange(10**6)}" for _ in range(tail)]))]
    want, roots, _ = labels(rows, 4, percent)
    assert len(set(roots)) == 150
    assert rows_of(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent), "doc_id", "n_shingles", "component_id", "kept") == Counter(want)


def test_op3_refuses_what_the_coordinates_do_not_carry(spark):
    assert near_dup.least_matches(80) == 13
    for percent in (0, 20, 35, 101):
        with pytest.raises(ValueError):
            near_dup.least_matches(percent)


def test_op3_same_row_stays_in_any_run(spark):
    text = prose(3, 40)
    rows = [(1, text, v, {"k": v}) for v in ("c", "a", None, "b")] + [(2, text, "x", None), (3, None, "y", None)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, Row string, c0 map<string,string>").repartition(3)
        got = {(r[0], r[2], (r[3] or {}).get("k")) for r in near_dup.drop_near_duplicates(df).collect()}
        assert got == {(1, "a", "a"), (3, "y", None)}


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40) if i % 10 != 9] + [(5, 5), (None, 3), (100, 50)]
    found = dict((r.node, r.component) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: i // 10 * 10 for i in range(40)} | {40: 40, 39: 30} | {50: 50, 100: 50} if 40 in found else {i: i // 10 * 10 for i in range(40)} | {50: 50, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def repeats_of(rows, split, size):
    parts = [split(t) for _, t in rows]
    return list(zip(rows, parts, brute.repeated(parts, size)))


def test_op8_passages(docs, none):
    want = Counter()
    for (doc_id, _), words, hit in repeats_of([(r[0], r[1]) for r in awkward()], brute.words, 35):
        kept = " ".join(w for w, h in zip(words, hit) if not h)
        want[(doc_id, len(words), sum(hit), hashlib.sha256(kept.encode()).hexdigest())] += 1
    assert sum(k[2] for k in want) > 0
    assert rows_of(automaton.passage_report(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert automaton.passage_report(none).collect() == []


def test_op10_strings(docs, none):
    want = Counter()
    for (doc_id, _), data, hit in repeats_of([(r[0], r[1]) for r in awkward()], lambda t: (t or "").encode(), 200):
        kept = bytes(b for b, h in zip(data, hit) if not h)
        spans = sum(h and (i == 0 or not hit[i - 1]) for i, h in enumerate(hit))
        want[(doc_id, len(data), sum(hit), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert sum(k[2] for k in want) > 0
    assert rows_of(suffix_sort.string_report(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_sort.string_report(none).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_op8_op10_shared_middles(spark, seed, monkeypatch):
    """Many runs in a shard: a passage in many surroundings, by either way of deciding."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(45)]
    rows = []
    for i in range(14):
        side = lambda: [f"s{rng.randrange(6)}" for _ in range(rng.randint(0, 50))]
        cut = rng.randint(30, 45)
        rows.append((i, " ".join(side() + passage[:cut] + side())))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (repeats.SHARD_SYMBOLS, 100):
        monkeypatch.setattr(repeats, "SHARD_SYMBOLS", limit)
        want = Counter((d, sum(h)) for (d, _), _, h in repeats_of(rows, brute.words, 35))
        assert rows_of(automaton.passage_report(df), "doc_id", "n_removed") == want
        want = Counter((d, sum(h)) for (d, _), _, h in repeats_of(rows, lambda t: t.encode(), 200))
        assert rows_of(suffix_sort.string_report(df), "doc_id", "n_removed") == want


def test_op8_op10_large_shards_are_not_gathered(spark, monkeypatch):
    """A shard beyond the limit never meets in one task; repeated rows of a document do not count twice."""
    rng = random.Random(16)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{' '.join(f's{rng.randrange(10**6)}' for _ in range(40))} {passage} {' '.join(f's{rng.randrange(10**6)}' for _ in range(40))}") for i in range(12)]
    rows += [rows[0], (50, " ".join(f"alone{i}" for i in range(60)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    limit, gathered, decide = 2000, [], repeats.decide

    def watched(fetched, units, size, method):
        gathered.append(fetched.groupBy("shard").agg(F.sum(F.col("run") + size - 1).alias("n")).agg(F.max("n")).first()[0] or 0)
        return decide(fetched, units, size, method)

    monkeypatch.setattr(repeats, "decide", watched)
    monkeypatch.setattr(repeats, "SHARD_SYMBOLS", limit)
    for report, split, size in ((automaton.passage_report, brute.words, 35), (suffix_sort.string_report, lambda t: t.encode(), 200)):
        for now in (limit, 300):
            monkeypatch.setattr(repeats, "SHARD_SYMBOLS", now)
            want = Counter((d, sum(h)) for (d, _), _, h in repeats_of(rows, split, size))
            assert rows_of(report(df), "doc_id", "n_removed") == want
            assert gathered.pop() <= now


def test_op8_op10_row_repeated_very_often(spark):
    """A row many times in the table goes through as two."""
    long_, alone = prose(50, 300), prose(51, 120)
    rows = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(long_).alias("text"))
    rows = rows.unionByName(spark.createDataFrame([(2, alone)], "doc_id long, text string"))
    counted, once = repeats.counted_rows(tx.keyed_rows(rows, "doc_id", "text"))
    assert (counted.count(), once.count()) == (3, 2)
    found = rows_of(automaton.passage_report(rows), "doc_id", "n_words", "n_removed")
    assert found == Counter({(1, 300, 300): 20_000, (2, len(alone.split()), 0): 1})
    found = rows_of(suffix_sort.string_report(rows), "doc_id", "n_bytes", "n_removed")
    assert found == Counter({(1, len(long_.encode()), len(long_.encode())): 20_000, (2, len(alone.encode()), 0): 1})


def test_deep_shallow_sort():
    rng = random.Random(9)
    for t in range(600):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 20))]
        if t % 3 == 0:
            strings = [b"ab" * 10 + s for s in strings]
        order, shared = suffix_sort.deep_shallow_sort(strings)
        assert [strings[i] for i in order] == sorted(strings)
        assert all(shared[i] == suffix_sort.common_prefix(strings[order[i - 1]], strings[order[i]]) for i in range(1, len(order)))


def test_automaton_matching():
    rng = random.Random(10)
    for _ in range(150):
        texts = [[rng.choice("ab") for _ in range(rng.randint(0, 15))] for _ in range(3)]
        machine = automaton.SuffixAutomaton()
        for t in texts:
            machine.add(t)
        machine.count()
        places = Counter(tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1))
        for t in texts:
            want = [max((n for n in range(i + 2) if n == 0 or places[tuple(t[i + 1 - n : i + 1])] > 1)) for i in range(len(t))]
            assert machine.matching(t) == want


def test_anchors_cover_all_windows():
    rng = np.random.default_rng(11)
    for n in (0, 34, 35, 36, 500):
        found = repeats.anchors(rng.integers(0, 1 << 63, n, dtype=np.uint64), 35, 11)
        if n < 35:
            assert found == {}
            continue
        assert int(found["run"].sum()) == n - 34 and found["start"][0] == 0
        assert (found["start"][1:] == found["start"][:-1] + found["run"][:-1]).all()
        assert ((0 <= found["place"]) & (found["place"] - found["run"] + 1 + 11 <= 35)).all()


def test_op1_scores(spark, docs, none):
    rows = tx.text_rows(docs, "doc_id", "text")
    tokens = [(r[0], brute.words(brute.lower(r[1])) + ["\n"]) for r in awkward()]
    out_of = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    counts = Counter(t for i, ts in tokens if not out_of(i) for t in ts)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, ts in tokens:
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        want[(i, out_of(i), len(ts), sum(counts[t] > 0 for t in ts), n, round(base, 6))] += 1
    model = pitman_yor.train(rows, context_share=0.02)
    scored = pitman_yor.score(rows, model)
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored.collect())
    assert got == want
    assert all(r.score < 0 for r in scored.collect())
    assert pitman_yor.score(tx.text_rows(none, "doc_id", "text"), pitman_yor.train(tx.text_rows(none, "doc_id", "text"))).collect() == []


def test_op1_probabilities_sum_to_one(spark, docs):
    rows = tx.text_rows(docs, "doc_id", "text")
    model = pitman_yor.train(rows, context_share=0.02)
    assert len(model.totals.contexts) > 5
    sums = np.full(len(model.totals.contexts) + 1, model.totals.parent(np.zeros(1), np.zeros(1))[0]) * model.totals.back_off
    for row in model.table.collect():
        bucket = pitman_yor.Bucket(row.asDict(), model.totals)
        k = len(sums)
        owner = np.repeat(np.arange(len(bucket.words)), k)
        context = np.tile(np.arange(k), len(bucket.words))
        _, _, score = bucket.look_up(bucket.words, owner, context)
        sums += np.bincount(context, weights=10.0**score, minlength=k)
    assert np.allclose(sums, 1.0, atol=1e-5)


def test_op1_learns_what_follows(spark):
    rng = random.Random(12)
    rows = []
    for i in range(150):
        words = []
        for _ in range(40):
            w = rng.randrange(8)
            words += [f"w{w}", f"follows{w}"]
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pitman_yor.train(df)
    out = {r.held_out: r for r in pitman_yor.perplexity(pitman_yor.score(df, model)).collect()}
    assert out[True].perplexity < 0.4 * out[True].base_perplexity
    again = {r.doc_id: r.score for r in pitman_yor.score(df, pitman_yor.train(df)).collect()}
    assert again == {r.doc_id: r.score for r in pitman_yor.score(df, model).collect()}


def test_op1_every_word_is_a_context(spark):
    """Also words that make up less than 1e-4 of the tokens, and each with all of its customers."""
    rng = random.Random(14)
    rows = [(i, " ".join([f"w{rng.randrange(30)}" for _ in range(100)] + [f"rare{i % 90}", f"after{i % 90}"])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pitman_yor.train(df)
    want, words = Counter(), set()
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            tokens = ["\n", *text.split(), "\n"]
            want.update(tokens[:-1])
            words.update(tokens)
    assert min(want.values()) < 1e-4 * sum(want.values())
    hashes = dict(zip(tx.hash_words([w.encode() for w in words]).tolist(), words))
    got = {hashes[c]: n for c, n in zip(model.totals.contexts.tolist(), model.totals.customers[1:].tolist())}
    assert got == want
    # what follows a rare word is known from its restaurant, and its probabilities sum to one
    at = 1 + int(np.flatnonzero(model.totals.contexts == tx.hash_words([b"rare7"])[0])[0])
    total, found = model.totals.parent(np.zeros(1), np.zeros(1))[0] * model.totals.back_off[at], 0.0
    for row in model.table.collect():
        bucket = pitman_yor.Bucket(row.asDict(), model.totals)
        n = len(bucket.words)
        p = 10.0 ** bucket.look_up(bucket.words, np.arange(n), np.full(n, at))[2]
        total += p.sum()
        found += p[bucket.words == tx.hash_words([b"after7"])[0]].sum()
    assert abs(total - 1.0) < 1e-5 and found > 0.3


def test_op1_scoring_needs_no_list_of_contexts(spark, docs):
    """Documents that the model was not trained on: the sums over buckets equal a look-up in one place."""
    rows = tx.text_rows(docs, "doc_id", "text")
    model = pitman_yor.train(rows)
    text = "the a the unseen-word a a the"
    got = pitman_yor.score(spark.createDataFrame([(5, text)], "doc_id long, text string"), model).first().score
    tokens = tx.hash_words([*text.encode().split(), b"\n"])
    place = pitman_yor._place(model.totals.contexts, np.concatenate([tx.hash_words([b"\n"]), tokens[:-1]]))
    tables = {r.bucket: r.asDict() for r in model.table.collect()}
    want = 0.0
    for word, at in zip(tokens, place):
        bucket = pitman_yor.Bucket(tables.get(int(pitman_yor._bucket(np.array([word]), model.buckets)[0])), model.totals)
        want += bucket.look_up(np.array([word]), np.zeros(1, int), np.array([at]))[2][0]
    assert abs(got - want) < 1e-9


def test_op1_training_tokens_are_counted_without_the_words(spark, docs, none):
    want = sum(len(brute.words(t or "")) + 1 for i, t, *_ in awkward() if not pitman_yor.held_out(i))
    assert pitman_yor.training_tokens(tx.text_rows(docs, "doc_id", "text")) == want
    assert pitman_yor.training_tokens(tx.text_rows(none, "doc_id", "text")) == 0


def test_op1_scoring_reads_the_texts_once(spark, docs):
    rows = tx.text_rows(docs, "doc_id", "text")
    scored = pitman_yor.score(rows, pitman_yor.train(rows, context_share=0.02))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 4  # questions, totals, answers, sums


def test_op1_questions_are_asked_once(spark, docs):
    """Scoring the texts of the training takes what was written for it, held-out texts included."""
    rows = tx.text_rows(docs, "doc_id", "text")
    model = pitman_yor.train(rows)
    scored = pitman_yor.score(None, model)
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 3  # totals, answers, sums
    assert Counter(map(tuple, scored.collect())) == Counter(map(tuple, pitman_yor.score(rows, model).collect()))


def test_op1_files_are_small(spark):
    """Questions and customers take a few bytes for each pair, and shuffles end with the table that they were for."""
    rng = random.Random(16)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(400))) for i in range(300)]
    pairs = sum(len(set(zip(["\n", *t.split()], [*t.split(), "\n"]))) for _, t in rows)
    model = pitman_yor.train(spark.createDataFrame(rows, "doc_id long, text string"))
    size = lambda uri: sum(p.stat().st_size for p in Path(uri.removeprefix("file://")).rglob("*.parquet"))
    assert size(model.asked) < 6 * pairs
    assert size(model.counted) + size(model.seated) + size(model.booked) < 8 * pairs
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_op1_packing():
    rng = np.random.default_rng(17)
    for n in (0, 1, 2, 1000):
        for kind in ("<u8", "<i8", "<u4", "<u2", "<f4", "<f8", "?"):
            values = rng.integers(0, 200, n).astype(kind)
            assert (pitman_yor.unpack(pitman_yor.pack(values), kind) == values).all()
        wide = np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        assert (pitman_yor.unpack_ascending(pitman_yor.pack_ascending(wide), "<u8") == wide).all()
        sizes = rng.integers(0, 4, n)
        runs = np.concatenate([np.empty(0, int), *(np.sort(rng.choice(5000, k, replace=False)) for k in sizes)])
        assert (pitman_yor.unpack_runs(pitman_yor.pack_runs(runs, sizes), sizes) == runs).all()


def test_op1_tables_of_large_cells():
    """Tables after one sweep, against the exact distribution by the recursion over customers."""
    d, most, keep = 0.7, 400, (10, 100, 1000, 10_000, 100_000)
    t = np.arange(most + 1)
    ways, exact = np.where(t == 1, 0.0, -np.inf), {}
    with np.errstate(invalid="ignore"):
        for n in range(1, keep[-1]):
            ways = np.logaddexp(ways + np.log(np.maximum(n - d * t, 1e-300)), np.append(-np.inf, ways[:-1]))
            if n + 1 in keep:
                exact[n + 1] = ways
    for n in keep:
        for weight in (0.05, 3.0, 60.0):
            odds = np.where(t <= n, exact[n] + t * np.log(weight), -np.inf)
            odds = np.exp(odds - odds.max())
            odds /= odds.sum()
            mean, spread = (odds * t).sum(), math.sqrt((odds * t * t).sum() - (odds * t).sum() ** 2)
            draws = 400
            seating = pitman_yor.Seating(np.full(draws, n), np.full(draws, weight), d, np.random.default_rng([15, n]))
            seating.sweep(np.full(draws, weight))
            assert abs(seating.tables.mean() - mean) < 5 * spread / math.sqrt(draws) + 1e-3, (n, weight)
            if n > pitman_yor.TABULATED:
                first, got = pitman_yor.table_odds(n, weight, d)
                assert np.abs(got - odds[first : first + len(got)]).sum() < 1e-5


def test_op1_seating_keeps_its_books():
    rng = np.random.default_rng(13)
    customers = np.array([0, 1, 2, 5, 40, 1000, 50_000])
    weight = np.full(7, 3.0)
    seating = pitman_yor.Seating(customers, weight, 0.6, rng)
    for step in range(20):
        seating.sweep(weight)
        assert (np.bincount(seating.owner, weights=seating.sizes, minlength=7) == customers).all()
        assert (seating.sizes > 0).all() and (np.diff(seating.owner) >= 0).all()
        assert (seating.tables[1:] >= 1).all() and seating.tables[0] == 0
        customers = np.maximum(customers + rng.integers(-2, 3, 7), [0, 1, 1, 1, 2, 3, 4])
        customers[0] = 0
        seating.resize(customers)
        assert (np.bincount(seating.owner, weights=seating.sizes, minlength=7) == customers).all()
