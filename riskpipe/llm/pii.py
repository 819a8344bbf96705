"""Personal data in texts, found from anchors.

An Aho-Corasick automaton reports, in one pass over a text, every place where personal data can
hang: at-signs, plus signs, digits, URL schemes and cues such as ``token``. From each anchor a small
deterministic parser expands to both sides, finds the bounds and validates what lies between.

The four base kinds are what a left-to-right search for their patterns finds: an email, an IP
address, a card number, a phone number. A candidate that fails its check is dropped and the search
goes on behind it. Further kinds: ``url`` with a well-formed host, ``secret`` (the value after a
cue), ``account`` (an IBAN with valid check digits) and ``email_intl`` (an address with letters
outside ASCII, where no base email was found).

A null text is empty and has no spans; rows are never joined, so repeated rows and ids stay.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpipe.llm.shared import map_columns, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "secret", "account", "email_intl")
CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "private_key")
SPANS = "array<struct<kind:string,start:int,end:int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HOST = re.compile(r"(?:[\w.~%!$&'()*+,;=-]*@)?([\w-]+(?:\.[\w-]+)+|localhost)(?::[0-9]{1,5})?")
_URL_REST = re.compile(r"[^\s<>\"'`{}|\\^\[\]]*")
_VALUE = re.compile(r"\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9_./+=-]{12,})")
_IBAN = re.compile(r"[:\s]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_INTL_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)+")


@functools.cache
def anchors() -> ahocorasick.Automaton:
    """The automaton; each word's value is its kind and length."""
    automaton = ahocorasick.Automaton()
    for word, kind in [("@", "@"), ("+", "+"), ("://", ":"), *((str(d), "0") for d in range(10))]:
        automaton.add_word(word, (kind, len(word)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
            automaton.add_word(form, ("cue", len(form)))
    for form in ("IBAN", "iban", "Iban"):
        automaton.add_word(form, ("iban", len(form)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    twice = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(twice[d] for d in values[1::2])) % 10 == 0


def _mod97(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text, sorted by start and kind; positions count code points."""
    found: list[tuple[str, int, int]] = []
    email_end = ip_end = card_end = phone_end = url_end = secret_end = 0
    for last, (kind, length) in anchors().iter(text):
        at = last - length + 1
        if kind == "0":
            if at >= card_end:
                run = _CARD.match(text, at)
                card_end = run.end() if run else at + 1
                if run and len(run[0]) >= 12:
                    digits = run[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        found.append(("card", at, card_end))
            if at >= ip_end:
                ip_end = _DIGITS.match(text, at).end()
                if text[ip_end : ip_end + 1] == "." and (address := _IP.match(text, at)):
                    ip_end = address.end()
                    if all(map(_octet, address.groups())):
                        found.append(("ip", at, ip_end))
        elif kind == "@":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            domain = _DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                email_end = domain.end()
                found.append(("email", start, email_end))
            elif span := _international(text, at, email_end):
                found.append(("email_intl", *span))
        elif kind == "+":
            if at >= phone_end and (number := _PHONE.match(text, at)):
                phone_end = number.end()
                if 9 <= sum(c.isdigit() for c in number[0]) <= 15:
                    found.append(("phone", at, phone_end))
        elif kind == ":":
            if at >= url_end and (span := _url(text, at, url_end)):
                url_end = span[1]
                found.append(("url", *span))
        elif at >= secret_end:
            value = (_VALUE if kind == "cue" else _IBAN).match(text, last + 1)
            if value and (kind == "cue" or _mod97(value[1].replace(" ", ""))):
                secret_end = value.end(1)
                found.append(("secret" if kind == "cue" else "account", value.start(1), secret_end))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _url(text: str, colon: int, floor: int) -> tuple[int, int] | None:
    start = colon
    while start > floor and text[start - 1].isascii() and text[start - 1].isalpha():
        start -= 1
    host = _HOST.match(text, colon + 3)
    if start == colon or not host:
        return None
    rest = _URL_REST.match(text, host.end())
    end = rest.end()
    while end > host.end() and text[end - 1] in ".,;:!?)":
        end -= 1
    return start, end


def _international(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and (text[start - 1] in _LOCAL or text[start - 1].isalpha()):
        start -= 1
    domain = _INTL_DOMAIN.match(text, at + 1)
    return (start, domain.end()) if start < at and domain else None


def redact_text(text: str) -> str:
    """The text with each span, overlapping ones together, replaced by its kind in brackets."""
    parts, at, pending = [], 0, None
    for kind, start, end in find_spans(text):
        if pending and start < pending[2]:
            pending = (pending[0], pending[1], max(end, pending[2]))
            continue
        if pending:
            parts += [text[at : pending[1]], f"[{pending[0].upper()}]"]
            at = pending[2]
        pending = (kind, start, end)
    if pending:
        parts += [text[at : pending[1]], f"[{pending[0].upper()}]"]
        at = pending[2]
    return "".join(parts) + text[at:]


def pii_spans(df: DataFrame) -> DataFrame:
    """``doc_id`` and the ``spans`` of its text."""
    return map_columns(
        texts(df),
        lambda keys, rows: [
            (k, [dict(zip(("kind", "start", "end"), s, strict=True)) for s in find_spans(t)])
            for k, t in zip(keys, rows, strict=True)
        ],
        "doc_id",
        f"spans {SPANS}",
    )


def redacted(df: DataFrame) -> DataFrame:
    """``df`` with the personal data in ``text`` replaced; all other columns, and nulls, as they are."""
    rest = [c for c in df.columns if c != "text"]
    packed = df.select(
        F.struct(*(df[c] for c in rest)).alias("rest"), df["text"].alias("text")
    )
    done = map_columns(
        packed,
        lambda keys, rows: [
            (k, None if t is None else redact_text(t)) for k, t in zip(keys, rows, strict=True)
        ],
        "rest",
        "text string",
    )
    return done.select(
        *(F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in df.columns)
    )


def pii_report(df: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    joined = (
        "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    )
    base = "filter(spans, s -> s.kind in ({}))".format(", ".join(f"'{k}'" for k in BASE))
    counts = [
        F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}")
        for k in BASE
    ]
    return pii_spans(df).select(
        "doc_id",
        *counts,
        F.sha2(F.expr(joined.format(base)), 256).alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )
