"""Personal data: base spans against the plain patterns, checksums, context, redaction."""

import hashlib
import random
import re
import time

import pytest

from basketlens.llm import pii
from documents import ODD, frame


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and plain_luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def base(text):
    return [tuple(s[:3]) for s in pii.find(text) if s.base]


@pytest.mark.parametrize("alphabet", ["ab.@@.-_%+ 0123456789 .-()+1é", "a@.", "0123456789 -", "12.256.", "+1 ()-.5"])
def test_base_spans_are_those_of_the_plain_patterns(alphabet):
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert base(text) == plain_base(text), text


def test_long_texts_take_linear_time():
    begun = time.time()
    for text in ("a" * 10**6, "1" * 10**6, "a@" * 10**5, "+1 ((" * 10**5, "1.1." * 10**5, "DE12" * 10**5, "a.b@c.de " * 50_000):
        pii.find(text)
    assert time.time() - begun < 30


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")


@pytest.mark.parametrize(
    "text, found",
    [
        ("IBAN DE89 3704 0044 0532 0130 00 please", [("iban", 5, 32)]),
        ("IBAN DE88 3704 0044 0532 0130 00 please", []),
        ("my card is 3782 822463 10005 ok", [("card", 11, 28)]),
        ("the number 3782 822463 10005 ok", []),
        ("call 030 1234 5678 now", [("phone", 5, 18)]),
        ("order 030 1234 5678 call", []),
        ("size 030 1234 5678 now", []),
    ],
)
def test_checked_and_likely_spans_are_added(text, found):
    assert [tuple(s[:3]) for s in pii.find(text) if not s.base] == found


def test_context_moves_the_score():
    near, far, less = (pii.find(f"{w} 10.0.0.1")[0].score for w in ("server", "xyz", "version"))
    assert near > far > less


def test_redaction():
    assert pii.redact("a 4111 1111 1111 1111, x@y.org; 1.2.3.4 +49 30 1234567.") == "a <CARD>, <EMAIL>; <IP> <PHONE>."
    assert pii.redact("10.0.0.1@host.example.com") == "<EMAIL>"
    assert pii.redact("nothing here") == "nothing here"


def test_queries_columns(spark, documents):
    docs = documents.select("doc_id", "text").union(spark.createDataFrame([(i + 10**6, t) for i, t in ODD], "doc_id long, text string"))
    found = {r.doc_id: r for r in pii.spans_digest(pii.spans(docs)).collect()}
    for row in docs.collect():
        expected, got = plain_base(row.text or ""), found[row.doc_id]
        assert [got.n_email, got.n_ip, got.n_card, got.n_phone] == [sum(k == kind for k, *_ in expected) for kind in pii.KINDS[:4]]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in expected)
        assert got.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(got.spans.split(","))


def test_redacted_table(spark):
    docs = frame(spark, [*ODD, *ODD])
    out = pii.redacted(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[0].text is None and by_id[1].text == ""
    assert by_id[9].text == "mail me at <EMAIL> or <IP>" and by_id[9].n_chars == len(by_id[9].text)
    assert by_id[5].text == dict(ODD)[5]
    assert pii.redacted(docs.limit(0)).count() == 0


def account(country, body):
    """An account number whose checksum holds."""
    rest = int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    return f"{country}{98 - rest:02d}{body}"


def test_each_account_of_a_row_is_found():
    accounts = ["DE89370400440532013000", "FR1420041010050500013M02606", "GB29NWBK60161331926819", "NL91ABNA0417164300"]
    for texts in (accounts, accounts[::-1], [" ".join(a[i : i + 4] for i in range(0, len(a), 4)) for a in accounts]):
        text = "IBAN " + " ".join(texts)
        assert [text[s.start : s.end] for s in pii.find(text) if s.kind == "iban"] == texts
    text = "PO10 IBAN DE89370400440532013000, DE88 FR1420041010050500013M02606"
    assert [text[s.start : s.end] for s in pii.find(text) if s.kind == "iban"] == [accounts[0], accounts[1]]


@pytest.mark.parametrize("country", ["SA", "UA", "RS", "LC", "BR", "RU"])
def test_accounts_of_further_countries_are_found(country):
    text = account(country, ("7" * 33)[: pii.IBAN_LENGTHS[country] - 4])
    assert [s.kind for s in pii.find(f"IBAN {text}.") if s.kind == "iban"] == ["iban"]
    assert not [s for s in pii.find(f"IBAN {text}7.") if s.kind == "iban"]
