"""Operator 9: personal data, by DataFrame expressions only.

Regular expressions propose spans, checksums (Luhn for card numbers, modulus 97
for account numbers) confirm them, and words just before a span adjust its
score. Positions are code points with an exclusive end. Matches of a kind are
leftmost and do not overlap; a match that fails its check is dropped without a
second try.

The patterns find the plain forms in the comments, in linear time: a run is
entered at its start or where the last match ended, since a match that starts
later in a run implies one at its start, and possessive repeats keep the
matcher off the stack on very long texts. Matches are walked in chunks (the
square root of their number), so a text of very many spans is not copied for each.

Null and empty texts have no spans. Repeated rows get the same result each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candela.llm import text as tx


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A cheap test that every text with a match passes.
    hint: str
    score: float
    #: Words that raise the score by CONTEXT_BONUS within CONTEXT_CHARS before the span.
    context: str
    check: str = ""


LABELS = r"[A-Za-z0-9-]"
LOCAL = r"[A-Za-z0-9._%+-]"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
THRESHOLD = 0.5

BASE_KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABELS}++(?:\.{LABELS}++)++", "@", 0.7, "mail|contact|write"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]", 0.5, "ip|host|address", "ip"),
    # [0-9]([\x20-]?[0-9])+, 13 to 19 digits passing Luhn
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"(?:[0-9][\x20-]?){13}", 0.8, "card|visa|master|pay", "luhn"),
    # \+[0-9][\x20().0-9-]+[0-9], 9 to 15 digits
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, "phone|tel|call|mobile", "phone"),
)
ADDED_KINDS = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}", 0.8, "iban|account|bank", "mod97"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-", 0.3, "ssn|social security"),
    Kind("secret", r"(?i)(?<![a-z0-9])(?:token|secret|password|api[_-]?key)\x20?[:=]\x20?[\x22'][A-Za-z0-9_/+-]{16,256}+[\x22']", "(?i)token|secret|password|key", 0.6, "login|auth"),
)
KINDS = BASE_KINDS + ADDED_KINDS


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 1, (c.cast("int") * 2).cast("int")).otherwise(c.cast("int")),
    )
    total = F.aggregate(doubled, F.lit(0), lambda acc, v: acc + F.when(v > 9, v - 9).otherwise(v))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (two letters, two digits, the rest) leaves 1 modulo 97, letters as 10 to 35."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + c.try_cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def _confirmed(kind: Kind, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind.check == "ip":
        return match.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind.check == "luhn":
        return n.between(13, 19) & F.when(n.between(13, 19), luhn(_digits(match))).otherwise(False)
    if kind.check == "phone":
        return n.between(9, 15)
    if kind.check == "mod97":
        return mod97(match)
    return F.lit(True)


def _chunks(array: Column) -> Column:
    """An array cut into about the square root of its length many arrays, so that walks copy each element that often at most."""
    step = F.greatest(F.ceil(F.sqrt(F.size(array))).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(array) - 1, F.lit(0)), step), lambda at: F.slice(array, at + 1, step))


def _pairs(kind: Kind, text: Column) -> Column:
    """All matches as (gap, tail, match): the length and the last characters of what lies between a match and the one before it."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.split(text, kind.pattern, -1)
    gaps = F.transform(F.slice(pieces, 1, F.size(matches)), lambda p: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(CONTEXT_CHARS)).alias("tail")))
    found = F.zip_with(gaps, matches, lambda g, m: F.struct(g["gap"].alias("gap"), g["tail"].alias("tail"), m.alias("match")))
    return F.when(text.rlike(kind.hint), found).otherwise(F.array().cast("array<struct<gap:int,tail:string,match:string>>"))


def _proposed(pairs: Column) -> Column:
    """All matches with their places: gaps and matches alternate, so lengths add up to places, within chunks and then over them."""
    empty = F.array().cast("array<struct<start:int,match:string>>")

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        found = F.concat(acc["found"], F.array(F.struct(start.alias("start"), p["match"].alias("match"))))
        return F.struct((start + F.length(p["match"])).alias("at"), found.alias("found"))

    def join(acc: Column, chunk: Column) -> Column:
        moved = F.transform(chunk["found"], lambda m: F.struct((m["start"] + acc["at"]).alias("start"), m["match"].alias("match")))
        return F.struct((acc["at"] + chunk["at"]).alias("at"), F.concat(acc["found"], moved).alias("found"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))
    walked = F.transform(_chunks(pairs), lambda chunk: F.aggregate(chunk, start, step))
    return F.aggregate(walked, start, join)["found"]


def _scored(kind: Kind, found: Column, pairs: Column) -> Column:
    """Confirmed matches as (kind, start, end, score)."""
    base = kind in BASE_KINDS
    numbered = F.transform(found, lambda m, i: F.struct(m["start"].alias("start"), m["match"].alias("match"), i.alias("i")))

    def span(m: Column) -> Column:
        # A match has two characters or more, so half of CONTEXT_CHARS matches and what lies between reach as far.
        past = F.transform(
            F.sequence(F.greatest(m["i"] - CONTEXT_CHARS // 2, F.lit(0)), m["i"]),
            lambda k: F.concat(F.get(pairs, k)["tail"], F.when(k < m["i"], F.get(pairs, k)["match"]).otherwise("")),
        )
        before = F.lower(F.right(F.array_join(past, ""), F.lit(CONTEXT_CHARS)))
        score = F.lit(kind.score) + F.when(before.rlike(rf"\b(?:{kind.context})"), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
        return F.struct(
            F.lit(kind.name).alias("kind"),
            m["start"].cast("long").alias("start"),
            (m["start"] + F.length(m["match"])).cast("long").alias("end"),
            F.least(score, F.lit(1.0)).alias("score"),
        )

    spans = F.transform(F.filter(numbered, lambda m: _confirmed(kind, m["match"])), span)
    return spans if base else F.filter(spans, lambda s: s["score"] >= THRESHOLD)


def _unused(prefix: str, columns: list[str]) -> str:
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def find_pii(docs: DataFrame, text_col: str = "text", spans_col: str = "spans", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Adds ``spans_col``, array<struct<kind, start, end, score>>, by kind as listed and then by start."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    columns = docs.columns
    prefix = _unused("_pii", columns)
    staged = docs.withColumn(f"{prefix}_text", text)
    staged = staged.withColumns({f"{prefix}_pairs_{k.name}": _pairs(k, F.col(f"{prefix}_text")) for k in kinds})
    staged = staged.withColumns({f"{prefix}_{k.name}": _proposed(F.col(f"{prefix}_pairs_{k.name}")) for k in kinds})
    spans = F.concat(*(_scored(k, F.col(f"{prefix}_{k.name}"), F.col(f"{prefix}_pairs_{k.name}")) for k in kinds))
    return staged.withColumn(f"{prefix}_spans", spans).select(*(F.col(f"`{c}`") for c in columns if c != spans_col), F.col(f"{prefix}_spans").alias(spans_col))


def redact(docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The documents with each span replaced by its kind in angle brackets; all columns stay.

    Overlapping spans become one replacement named after the first. Null texts stay null.
    Spans are replaced chunk by chunk, each in its own part of the text.
    """
    name = _unused("_pii_found", docs.columns)
    text = F.col(text_col)
    by_place = lambda a, b: F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(F.when(a["end"] > b["end"], -1).when(a["end"] < b["end"], 1).otherwise(0))
    found = find_pii(docs, text_col, name, kinds)
    found = found.withColumn(name, F.array_sort(F.col(name), by_place))
    found = found.withColumn(name, _chunks(F.col(name)))
    zero = F.lit(0).cast("long")

    def part(begin: Column, end: Column, of: Column) -> Column:
        return F.substring(of, (begin + 1).cast("int"), (end - begin).cast("int"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(acc["out"], part(acc["at"] - acc["base"], s["start"] - acc["base"], acc["block"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        out = F.when(s["start"] >= acc["at"], piece).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"), acc["base"].alias("base"), acc["block"].alias("block"))

    def join(acc: Column, chunk: Column) -> Column:
        last = F.greatest(acc["at"], F.coalesce(F.array_max(F.transform(chunk, lambda s: s["end"])), zero))
        begin = F.struct(F.lit("").alias("out"), acc["at"].alias("at"), acc["at"].alias("base"), part(acc["at"], last, text).alias("block"))
        return F.aggregate(chunk, begin, step, lambda done: F.struct(F.concat(acc["out"], done["out"]).alias("out"), done["at"].alias("at")))

    rest = lambda acc: F.concat(acc["out"], part(acc["at"], F.length(text).cast("long"), text))
    clean = F.when(F.size(F.get(F.col(name), F.lit(0))) > 0, F.aggregate(F.col(name), F.struct(F.lit("").alias("out"), zero.alias("at")), join, rest)).otherwise(text)
    return found.select(*((clean if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns))


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a count for each base kind, the digest of the base spans and all spans as text."""
    found = find_pii(tx.text_rows(docs, id_col, text_col), "text")
    base = [k.name for k in BASE_KINDS]
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
