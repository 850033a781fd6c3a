"""Personal data: patterns propose, checksums confirm, nearby words adjust the score.

Spans are code points, end exclusive.  Email, IP, card and phone spans follow fixed
rules and always stay; the method adds bank accounts (mod 97), shorter card numbers
(Luhn) and social security numbers where their words stand nearby.

Defined results: null text counts as empty and has no spans; rows are independent, so
ties and repeats need nothing; extra columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone", "iban", "short_card", "ssn")
BASE = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Starting score of each kind, and the words that raise it when they stand within NEAR.
SCORE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.7, "short_card": 0.3, "ssn": 0.3}
CONTEXT = {
    "email": re.compile(r"mail|contact|write", re.I),
    "ip": re.compile(r"\bip\b|address|server|host", re.I),
    "card": re.compile(r"card|visa|credit|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax", re.I),
    "iban": re.compile(r"iban|account|bank|konto|compte|cuenta", re.I),
    "short_card": re.compile(r"card|amex|credit|karte|carte|tarjeta", re.I),
    "ssn": re.compile(r"ssn|social security", re.I),
}
NEAR, RAISE, ACCEPT = 40, 0.3, 0.5


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def mod97(account: str) -> bool:
    rest = 0
    for c in account[4:] + account[:4]:
        rest = int(f"{rest}{int(c, 36)}") % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` backwards so that long words cost no more."""
    done, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and text[low - 1] in _LOCAL:
            low -= 1
        domain = _DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            yield low, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans as (kind, start, end, score), by kind in the order of KINDS, then start."""
    found: list[tuple[str, int, int, float]] = []

    def add(kind: str, low: int, high: int) -> None:
        score = SCORE[kind]
        near = CONTEXT[kind]
        if near.search(text, max(0, low - NEAR), low) or near.search(text, high, high + NEAR):
            score = min(1.0, score + RAISE)
        if kind in BASE or score >= ACCEPT:
            found.append((kind, low, high, score))

    for low, high in _emails(text):
        add("email", low, high)
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            add("ip", *m.span())
    runs = [(m.span(), _digits(m[0])) for m in _CARD.finditer(text)]
    for span, digits in runs:
        if 16 <= len(digits) <= 19 and luhn(digits):
            add("card", *span)
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                add("phone", *m.span())
    taken = [(low, high) for _, low, high, _ in found]
    free = lambda low, high: all(high <= a or low >= b for a, b in taken)
    for m in _IBAN.finditer(text):
        account = m[0].replace(" ", "")
        if 15 <= len(account) <= 34 and mod97(account) and free(*m.span()):
            add("iban", *m.span())
    for span, digits in runs:
        if 13 <= len(digits) <= 15 and len(set(digits)) > 2 and luhn(digits) and free(*span):
            add("short_card", *span)
    for m in _SSN.finditer(text):
        if free(*m.span()):
            add("ssn", *m.span())
    return found


def spelled(spans: list[tuple[str, int, int, float]]) -> str:
    return ",".join(f"{kind}:{low}:{high}" for kind, low, high, _ in spans)


def redact(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets."""
    parts, done = [], 0
    for kind, low, high, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if low >= done:
            parts += [text[done:low], f"[{kind.upper()}]"]
        done = max(done, high)
    return "".join([*parts, text[done:]])


_ADDED = {
    **{f"n_{kind}": pa.int64() for kind in BASE},
    "base_sha256": pa.string(),
    "spans": pa.string(),
    "scores": pa.list_(pa.float64()),
    "redacted": pa.string(),
}


def _scan(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made: dict[str, list] = {name: [] for name in _ADDED}
        for value in batch.column("text"):
            text = value.as_py() or ""
            spans = find_spans(text)
            for kind in BASE:
                made[f"n_{kind}"].append(sum(s[0] == kind for s in spans))
            base = spelled([s for s in spans if s[0] in BASE])
            made["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
            made["spans"].append(spelled(spans))
            made["scores"].append([s[3] for s in spans])
            made["redacted"].append(redact(text, spans) if spans else value.as_py())
        columns = [
            pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name).cast(f.type)
            for f in schema
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Adds counts per base kind, the span lists with scores and the redacted text.

    Row by row, without a shuffle; a null text stays null in ``redacted``.
    """
    from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema
    from pyspark.sql.types import StructField, StructType

    kept = [f for f in docs.schema if f.name not in _ADDED]
    added = [StructField(n, from_arrow_type(t)) for n, t in _ADDED.items()]
    schema = StructType([*kept, *added])
    arrow = to_arrow_schema(schema)
    return docs.mapInArrow(lambda batches: _scan(batches, arrow), schema)
