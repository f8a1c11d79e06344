"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acreage.llm.common import slices, whole_text

TEXT_BYTES = 8 << 20

#: Order of the kinds in results; the first four are the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id")

# Digit runs are matched possessively: a run that fails from its start fails from every later place, so work stays linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[\x20]?[A-Z0-9])")
_MORE = re.compile(r"[\x20]?[A-Z0-9]")
_ALNUM = re.compile(r"[A-Za-z0-9]")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[a-z]+")

# Characters of a bank account number by country, from the registry of ISO 13616.
IBAN_LENGTH = {
    k[:2]: int(k[2:])
    for k in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 "
        "GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 "
        "MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 "
        "TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}
# Words that speak for a kind when they stand near, and words that speak against any.
NEAR = {
    "email": ("email", "mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "telefono"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta", "bic"),
    "national_id": ("ssn", "social", "security", "insurance"),
}
AGAINST = ("example", "sample", "test", "version", "isbn", "order", "serial")
#: Score of a confirmed proposal, what a word nearby adds or takes, and the least score that further kinds need.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "national_id": 0.4}
STEP, LEAST, WINDOW = 0.2, 0.6, 40


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """The check sum of card numbers: every second digit from the right is doubled."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check sum of bank account numbers: the first four characters go last, letters count 10 to 35."""
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = at + 1
        if start < at and (m := _DOMAIN.match(text, end)):
            yield start, m.end()
            done = end = m.end()
        at = text.find("@", end)


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """Numbers of the length of their country; codes that the table lacks are tried at every end from the longest. A failed start
    is passed by its own four characters only, so that what follows it can be a number."""
    at = 0
    while m := _IBAN.search(text, at):
        at, n, ends = m.end(), 4, []
        while n < 34 and (c := _MORE.match(text, c.end() if n > 4 else m.end())):
            n += 1
            if n >= 15 and not _ALNUM.match(text, c.end()):
                ends.append((n, c.end()))
        length = IBAN_LENGTH.get(m[0][:2])
        for size, end in reversed(ends):
            if length in (None, size) and mod97(text[m.start() : end].replace(" ", "")):
                yield m.start(), end
                at = end
                break


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans whose form and check sum are right, kind after kind."""
    if "@" in text:
        for s, e in _emails(text):
            yield "email", s, e
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(_byte(p) for p in m[0].split(".")):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span()
    for s, e in _accounts(text):
        yield "iban", s, e
    for m in _NATIONAL.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "national_id", *m.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """Prior of the kind, raised by its own words within ``WINDOW`` characters and lowered by words that speak against."""
    around = set(_WORD.findall(f"{text[max(0, start - WINDOW) : start]} {text[end : end + WINDOW]}".lower()))
    value = PRIOR[kind] + STEP * any(w in around for w in NEAR[kind]) - STEP * any(w in around for w in AGAINST)
    return round(min(1.0, max(0.0, value)), 2)


def find(text: str) -> list[Span]:
    """All spans, by kind and start. Base kinds stay whatever their score; further kinds need ``LEAST`` and may not overlap one."""
    out = [Span(k, s, e, score(text, k, s, e)) for k, s, e in _proposals(text)]
    base = sorted((x.start, x.end) for x in out if x.kind in BASE_KINDS)
    ends = [0]
    for _, e in base:
        ends.append(max(ends[-1], e))

    def free(x: Span) -> bool:
        return ends[bisect_left(base, (x.end, 0))] <= x.start

    return [x for x in out if x.kind in BASE_KINDS or (x.score >= LEAST and free(x))]


def redact(text: str, spans: list[Span]) -> str:
    """The text with every stretch of spans replaced by the kind that starts it; spans that overlap become one."""
    out, done = [], 0
    for x in sorted(spans, key=lambda x: (x.start, -x.end)):
        if x.start >= done:
            out += [text[done : x.start], f"<{x.kind.upper()}>"]
        done = max(done, x.end)
    return "".join([*out, text[done:]])


SPAN_TYPE = "array<struct<kind: string, start: int, end: int, score: double>>"


def _each(docs: DataFrame, text: str, work, schema: str) -> DataFrame:
    """Rows of ``docs`` with ``work(columns, names, texts)`` applied to slices of bounded size, where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            for i, j in slices(b, text, TEXT_BYTES):
                part = b.slice(i, j - i)
                columns, made = work(list(part.columns), names, [t or "" for t in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays(columns, names=made)

    return docs.withColumn(text, F.col(text).cast("string")).mapInArrow(run, schema)


def _schema(docs: DataFrame, text: str) -> str:
    return ", ".join(f"`{f.name}` {'string' if f.name == text else f.dataType.simpleString()}" for f in docs.schema.fields)


def annotate(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii_spans``: kind, start and end in code points, and score of each span.

    A null text counts as empty. Nothing is shuffled, repeated rows are treated alike, an empty table stays empty, and an
    input column of that name is replaced.
    """
    docs = docs.drop("pii_spans")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def work(columns, names, texts):
        return [*columns, pa.array([[vars(x) for x in find(t)] for t in texts], type=kind)], [*names, "pii_spans"]

    return _each(docs, text, work, f"{_schema(docs, text)}, pii_spans {SPAN_TYPE}")


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind, such as <EMAIL>; a null text becomes empty."""

    def work(columns, names, texts):
        at = names.index(text)
        clean = pa.array([redact(t, s) if (s := find(t)) else t for t in texts], type=pa.string())
        return [*columns[:at], clean, *columns[at + 1 :]], names

    return _each(docs, text, work, _schema(docs, text))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{x.kind}:{x.start}:{x.end}" for x in sorted(spans, key=lambda x: (KINDS.index(x.kind), x.start)))


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, SHA-256 of the base spans, and all spans as text, for every row."""
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in slices(b, "t", TEXT_BYTES):
                part = b.slice(i, j - i)
                found = [find(t) for t in part.column("t").to_pylist()]
                base = [[x for x in s if x.kind in BASE_KINDS] for s in found]
                counts = [pa.array([sum(x.kind == k for x in s) for s in base], pa.int64()) for k in BASE_KINDS]
                sha = pa.array([hashlib.sha256(_joined(s).encode()).hexdigest() for s in base], pa.string())
                spans = pa.array([_joined(s) for s in found], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("k"), *counts, sha, spans], names=["k", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans"])

    own = docs.select(F.col(key).alias("k"), whole_text(text).alias("t"))
    schema = f"k {kind.simpleString()}, {', '.join(f'n_{k} bigint' for k in BASE_KINDS)}, base_sha256 string, spans string"
    return own.mapInArrow(run, schema).withColumnRenamed("k", key)
