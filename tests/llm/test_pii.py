import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskpipe.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, found):
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    spans = [
        (m.start(), list(PATTERNS).index(kind), kind, m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if passes(kind, m[0])
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def base_of(text):
    return [s for s in pii.find_spans(text) if s[0] in pii.BASE]


@settings(max_examples=400, deadline=None)
@given(st.text("0123456789.+-() @ab%_\n", max_size=60))
def test_base_spans_equal_a_search(text):
    assert base_of(text) == base_spans(text)


@pytest.mark.parametrize(
    "text",
    [
        "4111 1111 1111 1111, 4111111111111112 and 1.2.3.4.5 256.1.1.1 1.1.1.256.2.2.2.2",
        "a@b.co@c.de x@y +1 (017) 555-7713 +12 +1 2-",
        "9" * 6000 + "." + "1.1.1",
        "ä@b.de \U0001f600 +49 30 1234567",
    ],
)
def test_base_spans_of_examples(text):
    assert base_of(text) == base_spans(text)


def test_report_equals_a_search(documents, edge_docs, no_docs):
    for docs in (documents, edge_docs):
        expected = Counter()
        for r in docs.collect():
            spans = base_spans(r["text"] or "")
            kinds = Counter(s[0] for s in spans)
            joined = ",".join(":".join(map(str, s)) for s in spans)
            expected[
                r["doc_id"], *(kinds[k] for k in pii.BASE), hashlib.sha256(joined.encode()).hexdigest()
            ] += 1
        got = pii.pii_report(docs).collect()
        assert Counter(tuple(r)[:6] for r in got) == expected
    assert pii.pii_report(no_docs).count() == 0


def test_added_kinds():
    text = (
        'token = "186661156f3f9905942d70850a01cbf23a203f82" see https://user@host.example.org:80/a?b=1. '
        "IBAN DE89 3704 0044 0532 0130 00, müller@exämple.de; a token of thanks, x://"
    )
    found = {kind: text[a:b] for kind, a, b in pii.find_spans(text) if kind not in ("card", "ip")}
    assert found == {
        "secret": "186661156f3f9905942d70850a01cbf23a203f82",
        "url": "https://user@host.example.org:80/a?b=1",
        "email": "user@host.example.org",
        "account": "DE89 3704 0044 0532 0130 00",
        "email_intl": "müller@exämple.de",
    }
    clean = "A plain line, 12 of 34 words + more: no secret here.\nSecond @ line."
    assert pii.find_spans(clean) == [] and pii.redact_text(clean) == clean


def test_redaction(edge_docs):
    assert pii.redact_text("to a@b.co, 10.0.0.1!") == "to [EMAIL], [IP]!"
    out = pii.redacted(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["text"] is None and rows[1]["rank"] == [1.5]
    assert "10.0.0.1" not in rows[4]["text"] and "[IP]" in rows[4]["text"]
    assert rows[None]["text"] == "no id at all"
