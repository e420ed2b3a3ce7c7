"""Operator 2, personal data: regular expressions propose spans, checksums confirm, context words adjust the score.

``find_spans(text)`` returns (kind, start, end, score) with code-point offsets, end exclusive. The four base
kinds are proposed leftmost and non-overlapping per kind; a span that fails its check is dropped and the
search goes on behind it. Every span is scored: pattern weight, plus the weight of what its check or shape confirms,
plus ``RAISE`` for a context word of its kind and minus ``LOWER`` for a word that marks placeholders, looked for within
``CONTEXT`` characters before the span and ``AFTER`` behind it. Added kinds are kept from ``KEEP`` on; base spans stay
whatever their score. A secret is a token of a known form, the header of a private key, or the value assigned to a
name such as ``api_key`` (with = or :, blanks and quotes as they come); the span is the value, of any length.

Defined results: null or empty text has no spans; texts of any length are scanned in linear time (no
backtracking over long runs); rows are rated one by one, so ties, repeated rows, null ids, extra columns and
empty tables need no special care.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import arrow_batches

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
CONTEXT, AFTER = 40, 20
KEEP = 0.6
RAISE, LOWER = 0.3, 0.4
# Context words that raise the score of a kind (lower case).
WORDS = {
    "email": ("mail", "contact", "reach", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "whatsapp"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta", "bic", "swift"),
    "ssn": ("ssn", "social security", "security number", "tax id", "taxpayer"),
    "secret": ("login", "user", "credential", "auth", "bearer", "header", "env", "config", "aws"),
}
# Words that lower the score of any kind: what follows is no real value.
PLACEHOLDER = ("example", "placeholder", "dummy", "sample", "your_", "your-", "<your", "changeme", "xxxx", "redacted")
# Length of an IBAN by country (fixed values of the registry's most used countries).
IBAN_LENGTH = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24,
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always takes a whole run of digits, so runs are matched possessively and only from their start.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_NAMED = re.compile(
    r"(?i)(?<![a-z0-9])(?:[a-z0-9]{1,20}[_-]){0,3}(?:password|passwd|passphrase|pwd|secret|token|api[ _-]?key|apikey|"
    r"access[ _-]?key|secret[ _-]?key|private[ _-]?key|credentials?)[\"'`]?[ \t]{0,4}(?::=|=>|[=:])[ \t]{0,4}"
    r"(?:\"([^\"\r\n]++)\"|'([^'\r\n]++)'|([^\s\"'`,;<>()]++))")
_FORM = re.compile(
    r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36,}+|"
    r"(?:sk|pk|rk)[-_](?:live[-_]|test[-_])?[A-Za-z0-9]{20,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35}|"
    r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{4,}+)|-----BEGIN (?:[A-Z]{2,10} ){0,2}PRIVATE KEY-----")
_LEAST = 6                       # characters of an assigned value
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        v = ord(ch) - 48
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Equals the leftmost non-overlapping matches of the address pattern, without its quadratic scan."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _score(text: str, start: int, end: int, kind: str, weight: float) -> float:
    """``weight`` moved by the words around a span, between 0 and 1."""
    near = text[max(0, start - CONTEXT):start].lower()
    behind = text[end:end + AFTER].lower()
    up = any(w in near for w in WORDS[kind])
    down = any(w in near or w in behind for w in PLACEHOLDER)
    return round(min(1.0, max(0.0, weight + RAISE * up - LOWER * down)), 2)


def _looks_random(value: str) -> float:
    """The weight of an assigned value's shape: mixed kinds of characters, as words and plain numbers are not."""
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    if any(w in value.lower() for w in PLACEHOLDER) or len(set(value)) < 4 or kinds < 2 or " " in value:
        return 0.0
    return 0.5 if len(value) >= 16 else 0.3


def _secrets(text: str) -> Iterator[tuple[int, int, float]]:
    last = 0
    found = [(m.start(), m.end(), 0.8) for m in _FORM.finditer(text)]
    if "=" in text or ":" in text:
        for m in _NAMED.finditer(text):
            a, b = m.span(m.lastindex)
            if b - a >= _LEAST:
                found.append((a, b, 0.3 + _looks_random(text[a:b])))
    for a, b, weight in sorted(found, key=lambda f: (f[0], -f[2], -f[1])):
        if a >= last and (score := _score(text, a, b, "secret", weight)) >= KEEP:
            yield a, b, score
            last = b


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of a text, by kind as in ``KINDS``, then by start."""
    out: list[tuple[str, int, int, float]] = []
    if not text:
        return out

    def add(kind: str, a: int, b: int, weight: float, fixed: bool = True) -> None:
        score = _score(text, a, b, kind, weight)
        if fixed or score >= KEEP:
            out.append((kind, a, b, score))
    if "@" in text:
        for a, b in _emails(text):
            add("email", a, b, 0.7)
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.groups()):
            add("ip", m.start(), m.end(), 0.5)
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            add("card", m.start(), m.end(), 0.7)
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
                add("phone", m.start(), m.end(), 0.6)
    for m in _IBAN.finditer(text):
        code = m.group().replace(" ", "")
        # spaced text may run on: the registry length of the country says where the number ends
        n, end = IBAN_LENGTH.get(code[:2], len(code)), m.end()
        if n < len(code):
            left = n
            for k, ch in enumerate(m.group()):
                left -= ch != " "
                if not left:
                    end, code = m.start() + k + 1, code[:n]
                    break
        if len(code) == n and mod97(code):               # an unknown country needs a context word
            add("iban", m.start(), end, 0.7 if code[:2] in IBAN_LENGTH else 0.4, False)
    for m in _SSN.finditer(text):
        a, b, c = m.groups()
        if a not in ("000", "666") and a < "900" and b != "00" and c != "0000":
            add("ssn", m.start(), m.end(), 0.4, False)
    out += [("secret", *s) for s in _secrets(text)]
    return out


SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("score", pa.float64())]))
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


def detect(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` columns and ``spans``, an array of (kind, start, end, score)."""
    arrow_batches(docs.sparkSession)
    source = docs.select(*keep, docs[text].alias("__text"))

    def run(batches):
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e, "score": v} for k, s, e, v in find_spans(t)]
                     for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(spans, SPAN_TYPE)], [*b.schema.names[:-1],
                                                                                            "spans"])

    kept = source.drop("__text").schema.fields
    return source.mapInArrow(run, T.StructType([*kept, T.StructField("spans", SPANS)]))
