"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPACE.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def quality(text):
    ws = words(text)
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    grams = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    hit = {j for i in range(len(ws) - 4) if grams[tuple(ws[i : i + 5])] > 1 for j in range(i, i + 5)}
    n = len(ws)
    out = {
        "n_words": n,
        "word_chars": sum(map(len, ws)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(hit),
    }
    out["base_failed"] = n < 10 or 100 * len(hit) > 20 * n
    upper = sum("A" <= c <= "Z" for c in text or "")
    letters = upper + sum("a" <= c <= "z" for c in text or "")
    out["kept"] = not (
        out["base_failed"]
        or 10 * out["n_symbols"] > n
        or 2 * upper > letters
        or 100 * out["n_dup_lines"] > 30 * len(lines)
        or not 2 * n <= out["word_chars"] <= 15 * n
    )
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_pii(text):
    """(kind, start, end) of the base kinds."""
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def warc(pages):
    """page_id -> (bytes, digest, type, refers_to) for rows (page_id, html)."""
    best = defaultdict(list)
    for page_id, html in pages:
        best[html or ""].append(page_id)
    out = {}
    for page_id, html in pages:
        data = (html or "").encode()
        top = max(best[html or ""])
        out[page_id] = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if page_id == top else "revisit", None if page_id == top else top)
    return out


def shingles(text, k=4):
    ws = words(lower(text))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1)))


def near_duplicates(docs, k=4, percent=80):
    """doc_id -> (n_shingles, component_id, kept)."""
    sets = {d: shingles(t, k) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    r, s = sorted((find(a), find(b)))
                    parent[s] = r
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def repeated(sequences, size):
    """For each sequence, which places are covered by a window that starts elsewhere too."""
    counts = Counter(tuple(s[i : i + size]) if not isinstance(s, bytes) else s[i : i + size] for s in sequences for i in range(len(s) - size + 1))
    out = []
    for s in sequences:
        hit = [False] * len(s)
        end = 0
        for i in range(len(s) - size + 1):
            if counts[tuple(s[i : i + size]) if not isinstance(s, bytes) else s[i : i + size]] > 1:
                for j in range(max(i, end), i + size):
                    hit[j] = True
                end = i + size
        out.append(hit)
    return out
