"""Byte-level BPE by the tiktoken library and a rank file.

Long texts are cut before the library's pattern sees them, at places where a match ends whatever
stands around it: between a character that is no white space and one that is. No alternative of the
pattern crosses such a place, and its one lookahead only looks at the end of a run of white space.
A run of white space that is too long for the pattern's engine is one match but for its last
character, so it is merged as one piece.

Null texts are empty, empty texts have no ids; rows are never joined, so repeated rows and ids stay.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpipe.llm.shared import map_columns, texts

RANKS = "byte_bpe_50k.tiktoken"
#: Longest piece of text given to the library's pattern, where a safe boundary allows it.
SEGMENT_CHARS = 1 << 16
#: Runs of white space from this length on are merged without the pattern.
LONG_BLANK = 1 << 10

#: White space of the pattern's engine; Python's also holds the four separators 1C to 1F.
_BLANK = re.compile(r"[^\S\x1c-\x1f]{%d,}" % LONG_BLANK)
_SAFE = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[^\S\x1c-\x1f])")


@functools.cache
def encoding(ranks: str) -> tiktoken.Encoding:
    """The encoding of a rank file; once in each Python worker."""
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
    )


def segments(text: str) -> list[tuple[bool, str]]:
    """Consecutive parts of a text that can be encoded on their own; True: one piece as it is."""
    if len(text) <= SEGMENT_CHARS:
        blank = _BLANK.search(text) if len(text) >= LONG_BLANK else None
        if not blank:
            return [(False, text)]
    parts, at = [], 0
    for blank in _BLANK.finditer(text):
        end = blank.end() - (blank.end() < len(text))
        parts += _cut(text, at, blank.start())
        parts.append((True, text[blank.start() : end]))
        at = end
    return parts + _cut(text, at, len(text))


def _cut(text: str, at: int, end: int) -> list[tuple[bool, str]]:
    parts = []
    while end - at > SEGMENT_CHARS:
        place = _SAFE.search(text, at + SEGMENT_CHARS, end)
        if not place or place.start() >= end:
            break
        parts.append((False, text[at : place.start()]))
        at = place.start()
    return [*parts, (False, text[at:end])] if at < end else parts


def encode_text(text: str, ranks: str) -> bytes:
    """The ids of a text as little-endian unsigned 32-bit integers."""
    coder = encoding(ranks)
    return b"".join(
        np.asarray(
            coder._encode_single_piece(part) if whole else coder.encode_ordinary(part), "<u4"
        ).tobytes()
        for whole, part in segments(text)
    )


def decode_ids(ids: bytes, ranks: str) -> bytes:
    """The raw bytes behind ids; a cut inside a character is no error."""
    return encoding(ranks).decode_bytes(np.frombuffer(ids, "<u4").tolist())


def encode(df: DataFrame, ranks: str) -> DataFrame:
    """``doc_id`` and the ``ids`` of its text (binary, four bytes an id)."""
    return map_columns(
        texts(df),
        lambda keys, rows: [(k, encode_text(t, ranks)) for k, t in zip(keys, rows, strict=True)],
        "doc_id",
        "ids binary",
    )


def decode(df: DataFrame, ranks: str) -> DataFrame:
    """``doc_id``, ``ids`` and the bytes they stand for."""
    return map_columns(
        df.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")),
        lambda keys, rows: [(k, i, decode_ids(i, ranks)) for k, i in zip(keys, rows, strict=True)],
        "doc_id",
        "ids binary, decoded binary",
    )


def round_trip(df: DataFrame, ranks: str) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts."""

    def rows(keys: list, bodies: list[str]) -> list[tuple]:
        ids = [encode_text(text, ranks) for text in bodies]
        return [(k, i, decode_ids(i, ranks)) for k, i in zip(keys, ids, strict=True)]

    return map_columns(texts(df), rows, "doc_id", "ids binary, decoded binary")


def token_digests(df: DataFrame, ranks: str) -> DataFrame:
    """Number of ids and digests of ids and decoded bytes for every row."""
    return round_trip(df, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
