"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby move their score."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.shared import fresh, ship, whole_text

#: Kinds in the order of their spans.
KINDS = ("email", "ip", "card", "phone", "iban")
SPANS = "array<struct<kind: string, start: bigint, end: bigint, score: double, base: boolean>>"

# Patterns. A run of digits is matched from its first digit on and never given back, which finds the same
# leftmost matches as the plain pattern in one pass over the text.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_DIGITS = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9+A-Za-z.])\(?[0-9]{2,5}\)?[ ./-][0-9]{3,5}(?:[ .-][0-9]{2,5})?(?![0-9A-Za-z])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?=\x20?[A-Z0-9])")

_ACCOUNT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")

# Lengths of international account numbers by country (public ISO 13616 registry).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
    "YE": 30,
}
# Words that make a kind likelier or less likely when they stand close to a span.
LIKELIER = {
    "email": ("mail", "contact", "write", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "client"),
    "card": ("card", "credit", "visa", "mastercard", "amex", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "telefono", "téléphone", "teléfono", "whatsapp"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta", "transfer"),
}
LESS_LIKELY = ("version", "isbn", "issn", "order", "serial", "figure", "section", "page", "build", "release")

#: Score that a checked pattern has by itself.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "short card": 0.3, "local phone": 0.3}
#: What a likelier or less likely word adds or takes, how many characters around a span it may stand, and the least
#: score of spans other than base ones.
STEP, NEAR, LEAST = 0.3, 40, 0.6

_WORDS = re.compile(r"[^\W\d_]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float
    base: bool


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mod97(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with a domain behind it and the longest run of local characters before it, from the last match on."""
    free, at = 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at + 1)
        if found:
            begin = free + len(text[free:at].rstrip(_LOCAL))
            if begin < at:
                yield begin, found.end()
                free, at = found.end(), found.end() - 1
        free = max(free, at + 1)
        at = text.find("@", at + 1)


def _base(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in _emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield "ip", *m.span()
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdecimal() for c in m[0]) <= 15:
                yield "phone", *m.span()


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """Each account number of its country's length that checks; the search goes on behind it, or behind the letters of one that fails."""
    at = 0
    while m := _IBAN.search(text, at):
        at, size, end = m.start() + 2, IBAN_LENGTHS.get(m[1], 0), m.start()
        while size and end < len(text):
            end += text[end] == " " and end > m.start() + 3 and text[end - 1] != " "
            if text[end : end + 1] not in _ACCOUNT:
                break
            size, end = size - 1, end + 1
        if not size and m[1] in IBAN_LENGTHS and not text[end : end + 1].isalnum() and mod97(text[m.start() : end].replace(" ", "")):
            yield m.start(), end
            at = end


def _proposals(text: str) -> Iterator[tuple[str, str, int, int]]:
    """What the base patterns don't cover: kind, what its prior goes by, start, end."""
    for start, end in _accounts(text):
        yield "iban", "iban", start, end
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 15 and luhn(d):
            yield "card", "short card", *m.span()
    for m in _LOCAL_PHONE.finditer(text):
        if 7 <= sum(c.isdecimal() for c in m[0]) <= 12:
            yield "phone", "local phone", *m.span()


def _moved(text: str, kind: str, start: int, end: int) -> float:
    around = {w.lower() for w in _WORDS.findall(text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR // 2])}
    return STEP * (any(w in around for w in LIKELIER[kind]) - any(w in around for w in LESS_LIKELY))


def find(text: str) -> list[Span]:
    """All spans of a text by kind, then start; offsets are code points, ends exclusive.

    Base spans stay whatever their score is; others need the score LEAST and must not touch a base span or one found before them (accounts, cards, then phones).
    """
    has_digits = re.search("[0-9]", text)
    if not has_digits and "@" not in text:
        return []
    spans = [Span(k, a, b, round(min(1.0, PRIOR[k] + _moved(text, k, a, b)), 2), True) for k, a, b in _base(text)]
    if has_digits:
        taken = _merged(spans)
        for kind, prior, start, end in _proposals(text):
            score = round(min(1.0, PRIOR[prior] + _moved(text, kind, start, end)), 2)
            if score >= LEAST and not _touches(taken, start, end):
                spans.append(Span(kind, start, end, score, False))
                insort(taken, (start, end, kind))
    return sorted(spans, key=lambda s: (KINDS.index(s.kind), s.start, s.end))


def _merged(spans: list[Span]) -> list[tuple[int, int, str]]:
    """The stretches that spans cover, in order, each with the kind of its first span."""
    found: list[tuple[int, int, str]] = []
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if found and s.start < found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], s.end), found[-1][2])
        else:
            found.append((s.start, s.end, s.kind))
    return found


def _touches(taken: list[tuple[int, int, str]], start: int, end: int) -> bool:
    i = bisect_left(taken, (end,))
    return i > 0 and taken[i - 1][1] > start


def redact(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    out, done = [], 0
    for start, end, kind in _merged(find(text)):
        out += [text[done:start], f"<{kind.upper()}>"]
        done = end
    return "".join([*out, text[done:]])


def _span_arrays(texts: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))
    return pa.array([[s._asdict() for s in find(t.as_py())] for t in texts], kind)


def _redacted(texts: pa.Array) -> pa.Array:
    return pa.array([redact(t.as_py()) for t in texts], pa.string())


def spans(docs: DataFrame) -> DataFrame:
    """docs with a column `spans` (instead of one they may have): kind, start, end, score and base of every span.

    A null or empty text has none; every row is looked at by itself.
    """
    ship(docs.sparkSession)
    find_spans = F.arrow_udf(_span_arrays, SPANS)
    return docs.withColumn("spans", find_spans(whole_text()))


def redacted(docs: DataFrame) -> DataFrame:
    """docs with personal data in `text` replaced by `<KIND>`, and `n_chars`, if there is one, counted anew.

    A null text stays null; texts without spans, rows and other columns stay as they are.
    """
    ship(docs.sparkSession)
    clean = F.arrow_udf(_redacted, "string")
    (name,) = fresh(docs, "clean_text")
    out = docs.withColumn(name, clean(whole_text()))
    text: Column = F.when(F.col("text").isNotNull(), F.col(f"`{name}`"))
    if "n_chars" in docs.columns:
        changed = ~text.eqNullSafe(F.col("text"))
        counted = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, counted).otherwise(F.col("n_chars")))
    return out.withColumn("text", text).select(*[f"`{c}`" for c in docs.columns])


def spans_digest(found: DataFrame) -> DataFrame:
    """Counts of base spans, the digest of these and all spans as text."""

    def listed(kinds: Column) -> Column:
        return F.concat_ws(",", F.transform(kinds, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [number(kind) for kind in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
