import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskpipe.llm import byte_bpe, packing

RANKS = public_tokenizers.path(byte_bpe.RANKS)
WORDS = public_tokenizers.path(packing.TOKENIZER)


LIBRARY = Tokenizer.from_file(WORDS)


def word_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("which", ["documents", "edge_docs"])
def test_byte_bpe_equals_the_library(request, which):
    docs = request.getfixturevalue(which)
    coder = byte_bpe.encoding(RANKS)
    expected = Counter()
    for r in docs.collect():
        text = r["text"] or ""
        ids = np.array(coder.encode_ordinary(text), "<u4").tobytes()
        expected[
            r["doc_id"],
            len(ids) // 4,
            hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        ] += 1
    assert Counter(map(tuple, byte_bpe.token_digests(docs, RANKS).collect())) == expected


@pytest.mark.parametrize(
    "text",
    [
        "ab " * 90_000,
        "x" * 150_000 + " y" + "\n" * 3000 + "z",
        "a" + " " * 2000,
        " " * 2000 + "a\u3000b" * 40_000,
        ("word\u00a0" + "\x1c" * 3 + " \t") * 30_000,
        "'s 're" * 40_000,
    ],
)
def test_segments_do_not_change_ids(text):
    coder = byte_bpe.encoding(RANKS)
    parts = byte_bpe.segments(text)
    assert "".join(p for _, p in parts) == text and len(parts) > 1 or len(text) < 100_000
    assert byte_bpe.encode_text(text, RANKS) == np.array(
        coder.encode_ordinary(text), "<u4"
    ).tobytes()


def test_a_million_blanks_are_encoded():
    ids = byte_bpe.encode_text("a" + " " * 1_000_000 + "b", RANKS)
    assert byte_bpe.decode_ids(ids, RANKS) == b"a" + b" " * 1_000_000 + b"b"


def test_encode_then_decode(edge_docs, no_docs):
    back = byte_bpe.decode(byte_bpe.encode(edge_docs, RANKS), RANKS).collect()
    assert Counter(bytes(r["decoded"]) for r in back) == Counter(
        (r["text"] or "").encode() for r in edge_docs.collect()
    )
    assert byte_bpe.token_digests(no_docs, RANKS).count() == 0


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.text("aAzZ09'.,!éÉßÿ÷×ªµÄ\u0301\u0130\u03a3|<>endoftext\u00a0\u4e2d\U0001f600", max_size=12),
        max_size=8,
    ).map(" ".join)
)
def test_word_ids_equal_the_library(text):
    got = np.frombuffer(packing.token_bytes(text, WORDS), "<u4").tolist()
    assert got == word_ids(text)


def test_word_ids_survive_forgetting(monkeypatch, documents):
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    known = packing.WordIds(WORDS)
    monkeypatch.setattr(packing, "_word_ids", lambda path: known)
    for r in documents.limit(20).collect():
        got = np.frombuffer(packing.token_bytes(r["text"], WORDS), "<u4").tolist()
        assert got == word_ids(r["text"])
    assert len(known) <= 50


@pytest.mark.parametrize("which", ["documents", "edge_docs"])
def test_packing_places_every_id_once(request, which):
    docs = request.getfixturevalue(which)
    expected = Counter()
    for r in docs.collect():
        ids = word_ids(r["text"])
        for at in range(0, len(ids), packing.CAPACITY):
            part = ids[at : at + packing.CAPACITY]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            expected[r["doc_id"], at // packing.CAPACITY, at, len(part), crc] += 1
    rows = packing.pack(docs, WORDS).collect()
    assert Counter(tuple(r)[:5] for r in rows) == expected
    check_places(rows)
    total = sum(r["length"] for r in rows)
    # no worse than one sequence and a few hundredths above the least conceivable number
    assert len({r["sequence_id"] for r in rows}) <= 1 + 1.02 * total / packing.CAPACITY + 0.5


def check_places(rows, capacity=packing.CAPACITY):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs, WORDS).count() == 0


def test_one_hot_length_and_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_ROWS", 50)
    rows = [(i, 0, 700 if i % 3 else i % 900 + 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long")
    got = packing.placed(df).collect()
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in got) == Counter(rows)
    check_places(got)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(1)
    counts = Counter(np.minimum(rng.lognormal(6, 1, 50_000).astype(int) + 1, 2048).tolist())
    rows = packing.plan(dict(counts))
    ends = Counter()
    for length, first, last, *_ in rows:
        ends[length] += last - first
    assert ends == counts
    n = max(sequence + (last - first) // copies for _, first, last, sequence, _, copies in rows)
    assert n <= 1.005 * sum(k * v for k, v in counts.items()) / 2048
    assert len(rows) < 60_000


def test_sequences_hold_the_ids(edge_docs):
    docs = edge_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    placement = packing.pack(docs, WORDS)
    made = packing.sequences(docs, placement, WORDS).collect()
    ids = [np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in made]
    assert all(len(s) <= packing.CAPACITY for s in ids)
    assert Counter(i for s in ids for i in s) == Counter(
        i for r in docs.collect() for i in word_ids(r["text"])
    )
