"""Operator 6: personal data, proposed by patterns, confirmed by checksums,
weighed by nearby words.

Base kinds (they always stay): e-mail addresses, IPv4 addresses, card numbers
(13 to 19 digits that pass Luhn) and international phone numbers. The method
adds ``iban`` (known country, its length, and the mod-97 check) and ``national_id`` (nine digits as
3-2-4; only with a context word near by, for it has no checksum).

Every span gets a score: a start value for its kind, more if a checksum
confirms it, more for a context word of its kind within ``CONTEXT`` code points
before or after it, less for a word that speaks against it.

Patterns run over whole texts. Each pattern is tried only at places where a
match can start and never backs up over a run, so the time is linear also in
texts that are one long run of digits or letters.

Defined results: null counts as empty; a text without findings gives zero
counts, the hash of the empty string and an empty span list; repeated rows are
scanned alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table

CONTEXT = 48
KINDS = ("email", "ip", "card", "phone", "iban", "national_id")
BASE = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")

#: Start score, and context words for and against, by kind.
START = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.6, "iban": 0.4, "national_id": 0.2}
FOR = {
    "email": r"e-?mail|contact|write|correo|courriel",
    "ip": r"ip|host|server|address|client|login",
    "card": r"card|visa|master|credit|debit|payment|tarjeta|carte|karte",
    "phone": r"phone|tel|call|mobile|fax|cell|tel[eé]fono|t[eé]l[eé]phone|telefon",
    "iban": r"iban|account|bank|transfer|konto|cuenta|compte",
    "national_id": r"ssn|social|security|insurance|passport",
}
AGAINST = r"version|release|order|invoice|isbn|serial|example|test"
#: Length of account numbers by country (fixed values of the public registry).
IBAN_LENGTH = {
    x[:2]: int(x[2:])
    for x in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 "
        "HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 "
        "QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}
CHECKED = {"card": 0.3, "iban": 0.5}
_WORDS = {k: re.compile(rf"(?i)(?<![^\W_])(?:{v})(?![^\W_])") for k, v in FOR.items()}
_NOT = re.compile(rf"(?i)(?<![^\W_])(?:{AGAINST})(?![^\W_])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Account number check: the first four characters go last, letters count from 10."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of
    ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from their @."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1  # no match can hold this @; a later one starts after it
        at = text.find("@", free)


def digits_of(text: str, a: int, b: int) -> str:
    return "".join(c for c in text[a:b] if "0" <= c <= "9")


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind, then start; code points, end exclusive."""
    found: list[tuple[str, int, int]] = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                d = digits_of(text, m.start(), m.end())
                if 13 <= len(d) <= 19 and luhn(d):
                    found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(text, m.start(), m.end())) <= 15]
        found += [("iban", m.start(), m.end()) for m in _IBAN.finditer(text) if len(s := m[0].replace(" ", "")) == IBAN_LENGTH.get(s[:2]) and mod97(s)]
        if "-" in text:
            found += [("national_id", m.start(), m.end()) for m in _NATIONAL.finditer(text)]
    out = []
    for kind, a, b in found:
        near = f"{text[max(0, a - CONTEXT) : a]} \n {text[b : b + CONTEXT]}"
        context = bool(_WORDS[kind].search(near))
        score = START[kind] + CHECKED.get(kind, 0) + 0.3 * context - 0.2 * bool(_NOT.search(near))
        if kind != "national_id" or context:
            out.append((kind, a, b, round(min(1.0, max(0.0, score)), 2)))
    return out


_SPANS = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, scores array<double>"


def _task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(pa.float64())]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = spans(text.as_py() or "")
            names = [f"{k}:{a}:{b}" for k, a, b, _ in found]
            base = ",".join(n for n, f in zip(names, found) if f[0] in BASE)
            rows.append((doc_id, *(sum(f[0] == k for f in found) for k in BASE), hashlib.sha256(base.encode()).hexdigest(), ",".join(names), [f[3] for f in found]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [x.split()[0] for x in _SPANS.split(", ")])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, and a score per span."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_task, _SPANS)


def masked(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` (doc_id, text) with every span of ``threshold`` or more replaced
    by its kind in brackets; of overlapping spans the longest counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(1).to_pylist():
                if text:
                    parts, at = [], 0
                    for kind, a, b, score in sorted(spans(text), key=lambda f: (f[1], -f[2])):
                        if score >= threshold and a >= at:
                            parts += [text[at:a], f"[{kind}]"]
                            at = b
                    text = "".join(parts) + text[at:]
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, text string")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
