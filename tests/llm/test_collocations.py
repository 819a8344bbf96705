import random
import re
from collections import Counter

import numpy as np
import pytest

from riskpipe.llm import collocations as c


def brute_force(rows, least, top):
    counts, totals = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in rows:
        lang = r["lang"] if r["lang"] is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r["text"] or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    frequent = {k: n for k, n in counts.items() if n >= least}
    around = Counter()
    for (lang, g), n in frequent.items():
        for size in range(2, len(g)):
            for i in range(len(g) - size + 1):
                key = lang, g[i : i + size]
                around[key] = max(around[key], n)
    found = {}
    for (lang, g), a in frequent.items():
        if len(g) < 2 or 100 * around[lang, g] >= 80 * a:
            continue
        cuts = [(counts[lang, g[:k]], counts[lang, g[k:]]) for k in range(1, len(g))]
        score, k = min((2_000_000 * a // (left + right), k) for k, (left, right) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), *cuts[k]))
    return Counter(
        (lang, rank, p.decode(), -a, left, right, totals[lang], -s)
        for lang, rows_ in found.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_)[:top], 1)
    )


def results(df, **how):
    return Counter(map(tuple, c.collocations(df, **how).collect()))


@pytest.fixture(scope="module")
def some_docs(documents):
    return documents.filter("doc_id < 120").cache()


@pytest.mark.parametrize("head", [c.HEAD, 64, 1])
def test_equals_brute_force_whatever_the_heads_hold(some_docs, head):
    expected = brute_force(some_docs.collect(), 4, 150)
    assert len(expected) > 200
    assert results(some_docs, least=4, top=150, head=head) == expected


def test_edge_documents(edge_docs, no_docs):
    assert results(edge_docs) == brute_force(edge_docs.collect(), c.LEAST, c.TOP)
    assert results(edge_docs, least=1) == brute_force(edge_docs.collect(), 1, c.TOP)
    assert results(no_docs) == Counter()


def test_langs_ties_and_pieces(spark):
    rows = [("x", "New York, new york. a b\ta b"), (None, "new york"), ("und", "NEW york"), ("x", "é É é É . É é"), ("x", "..")]
    docs = spark.createDataFrame(rows * 2, "lang string, text string")
    for top in (1, 2, 50):
        assert results(docs, least=2, top=top) == brute_force(docs.collect(), 2, top)


def test_tiles_equal_plain_counting():
    random_ = np.random.default_rng(3)
    dense = random_.integers(0, 300, (200_000, 2))
    sparse = random_.integers(0, c.HEAD, (50_000, 2))
    pairs = np.concatenate([dense, sparse, sparse[:1000]])
    codes = pairs[:, 0] << c.HEAD_POWER | pairs[:, 1]
    found, n = c.tile_counts(codes)
    assert dict(zip(found.tolist(), n.tolist(), strict=True)) == Counter(codes.tolist())
    assert [len(x) for x in c.tile_counts(codes[:0])] == [0, 0]
    rows, n = c.coordinate_counts(pairs)
    assert dict(zip(map(tuple, rows.tolist()), n.tolist(), strict=True)) == Counter(map(tuple, pairs.tolist()))


def test_packing_ids_is_a_round_trip():
    ids = np.array([c.BREAK, 0, 5, c.HEAD - 1, 1 << 62, (1 << 63) - 1, c.BREAK])
    assert (c.unpacked_ids(c.packed_ids(ids)) == ids).all()


def test_head_tells_phrases_by_their_words():
    words = np.array([[1, 2], [2, 1], [1 << 62, 3]])
    head = c.Head(words, None)
    sought = [np.array([2, 1, 1, -1, 1 << 62]), np.array([1, 2, 3, 2, 3])]
    assert head.find(sought).tolist() == [1, 0, -1, -1, 2]
    full = np.full(c.SIEVE_BITS // 8, 255, np.uint8)
    assert c.Head(words, full).find(sought).tolist() == [1, 0, -2, -1, 2]


def test_sieve_holds_every_phrase(spark):
    random.seed(1)
    rows = [([random.randrange(1 << 62), random.randrange(9)],) for _ in range(500)]
    marks = c.sieve(spark.createDataFrame(rows, "words array<long>").repartition(3))
    columns = [np.array([r[0][k] for r in rows]) for k in range(2)]
    assert c.in_sieve(marks, c.names(columns)).all()
    assert np.unpackbits(marks).sum() <= 500


def test_floor_keeps_within_the_bound(spark):
    counts = [100] * 5 + [40] * 20 + [3] * 100
    df = spark.createDataFrame([(n,) for n in counts], "n long")
    for bound in (4, 5, 24, 25, 124, 125, 1000):
        floor = c.head_floor(df, bound)
        kept = sum(n >= floor for n in counts)
        assert kept <= bound and kept == max(k for k in (0, 5, 25, 125) if k <= bound)
