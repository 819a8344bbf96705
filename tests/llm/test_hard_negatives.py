import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskpipe.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, cell int"


def brute_force(rows):
    kept = []
    for r in rows:
        v = r["embedding"]
        if r["label"] is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * float(x)) for x in v]
        if sum(x * x for x in ints) > hn.MAX_SQUARES:
            continue
        label = (r["label"] + 1) % 10 if r["vec_id"] is not None and r["vec_id"] % 7 == 0 else r["label"]
        kept.append((r["vec_id"], label, ints))
    found = Counter()
    for i, (anchor, label, v) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), ident is None, ident or 0, ident, other != label, j)
            for j, (ident, other, w) in enumerate(kept)
        )
        positives = [s for s in scored if not s[4] and s[5] != i][:5]
        for p in positives:
            inside = [n for n in scored if n[4] and -80 * p[0] <= -100 * n[0] <= -100 * p[0]][:5]
            for rank, n in enumerate(inside, 1):
                found[anchor, p[3], rank, n[3], -p[0], -n[0]] += 1
    return found


def results(df):
    return Counter(map(tuple, hn.from_embeddings(df).collect()))


def test_equals_brute_force(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    expected = brute_force(df.collect())
    assert len(expected) > 50
    assert results(df) == expected


@pytest.fixture(scope="module")
def edge_vectors(spark):
    random = np.random.default_rng(5)

    def near(*v):
        return [float(x + e) for x, e in zip(v, random.normal(0, 0.2, len(v)), strict=True)]

    rows = [(100 * k, near(1, 1, 0.5), k % 3) for k in range(8)]
    rows += [(1000 + k, near(1, 0.9, 0.4), k % 4) for k in range(60)]
    rows += [(100, near(1, 1, 1), 1), (100, [1.0, 1.0, 0.5], 1), (100, [1.0, 1.0, 0.5], 1)]  # one id, three rows
    rows += [(2000 + k, [0.5, 0.5, 0.5], k % 2) for k in range(30)]  # equal scores
    rows += [(3001, [0.7], 1), (3002, [], 2), (3003, [0.9, 0.9, 0.9, 0.9], 2), (300, [], 1)]  # other widths
    rows += [
        (None, [1.0, 1.0, 0.5], 2),
        (400, None, 1),
        (500, [1.0, None, 1.0], 1),
        (600, [1.0, float("nan"), 1.0], 1),
        (700, [1.0, float("-inf"), 1.0], 1),
        (800, [1.0, 1.0, 1.0], None),
        (900, [3e38, 1.0, 1.0], 1),
        (901, [-1.0, -1.0, -1.0], 1),
        (1100, [-1.0, 0.0, -1.0], 7),  # no other row of its label
    ]
    return spark.createDataFrame([(*r, "v", 3) for r in rows], SCHEMA)


def test_edge_rows(edge_vectors):
    assert results(edge_vectors) == brute_force(edge_vectors.collect())
    assert results(edge_vectors.limit(0)) == Counter()
    assert results(edge_vectors.filter("vec_id = 400")) == Counter()


def test_cells_and_tiles_change_nothing(edge_vectors, monkeypatch):
    # the functions of cells are shipped with the module's own values, so only the grid can be forced here
    for name, value in (("BLOCK_NUMBERS", 12), ("ANCHOR_NUMBERS", 8), ("LEAST_BLOCKS", 3)):
        monkeypatch.setattr(hn, name, value)
    assert results(edge_vectors) == brute_force(edge_vectors.collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(0, 2**32), st.integers(1, 9))
def test_strassen_is_exact(m, k, n, seed, leaf):
    random = np.random.default_rng(seed)
    a, b = random.integers(-(2**30), 2**30, (m, k)), random.integers(-(2**28), 2**28, (n, k))
    expected = a.astype(object) @ b.astype(object).T
    assert (hn.strassen(a, b, leaf) == expected.astype(np.int64)).all()


def test_heaps_merge_in_any_order():
    random = np.random.default_rng(1)
    parts = [
        tuple(np.array(c) for c in zip(*[(random.integers(3), random.integers(4), random.integers(50)) for _ in range(9)]))
        for _ in range(6)
    ]
    whole = sorted((int(k), -int(s), int(i)) for p in parts for k, s, i in zip(*p))
    expected = [x for key in range(3) for x in [w for w in whole if w[0] == key][:4]]
    for order in ([0, 1, 2, 3, 4, 5], [5, 3, 1, 0, 2, 4]):
        heap = hn._no_heap()
        for k in order:
            heap = hn.merged(heap, parts[k], 4)
        assert [(int(k), -int(s), int(i)) for k, s, i in zip(*heap)] == expected


def test_window_bounds_do_not_overflow():
    for high in (0, 1, 5, 99, 100, 12_345, 2**62, 2**63 - 1):
        assert hn.lowest_score(np.array([high]))[0] == -(-80 * high // 100)
