import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskpipe.llm import linking, near_dedup
from riskpipe.llm.oracle import NEAR_SQL


def shingles(text):
    words = bytes(text or "", "utf8").lower().split()
    n = max(1, len(words) - 4) if words else 0
    return {tuple(words[i : i + 5]) for i in range(n)}


def brute_force(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    result = Counter()
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for d in groups[find(i)] if d is not None]
        result[doc_id, len(sets[i]), min(ids, default=None) if sets[i] else doc_id] += 1
    return result


def made_up(n=60, seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(50))
    rows, base = [], [word() for _ in range(120)]
    for i in range(n):
        words = list(base) if i % 3 else [word() for _ in range(rng.randrange(1, 60))]
        for _ in range(i % 7):
            words[rng.randrange(len(words))] = word()
        rows.append((1000 - i, rng.choice([" ", "\n", "\t "]).join(words).title()))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_made_up_documents(spark, seed):
    rows = made_up(seed=seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.classes(docs).collect()
    assert Counter(map(tuple, got)) == brute_force(rows)


@pytest.mark.parametrize("percent", [80, 83])
def test_a_lower_threshold(spark, percent):
    rows = made_up(seed=5)
    expected = brute_force(rows, percent)
    assert expected != brute_force(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, near_dedup.classes(docs, percent).collect())) == expected


def test_bands_are_laid_out_for_the_threshold():
    assert near_dedup.layout() == near_dedup.layout(100) == (44, 8)
    for percent in range(near_dedup.LEAST_PERCENT, near_dedup.PERCENT + 1):
        bands, rows = near_dedup.layout(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= near_dedup.MISSED


def test_edge_rows(edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    got = near_dedup.near_duplicates(edge_docs).collect()
    assert Counter(tuple(r)[:3] for r in got) == brute_force(rows)
    assert {r["doc_id"]: r["kept"] for r in got}[None] is True
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_equals_sql(documents, sf_dir):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
        expected = db.execute(NEAR_SQL).fetchall()
    assert Counter(map(tuple, near_dedup.near_duplicates(documents).collect())) == Counter(expected)


def test_one_row_of_each_group_stays(spark, edge_docs):
    rows = [*made_up(), (5, None), (None, "a b c d e f g"), (None, "A b c d e f g"), (2000, made_up()[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = near_dedup.deduplicated(docs)
    expected = {c for _, n, c in brute_force(rows) if n and c is not None}
    got = Counter(r["doc_id"] for r in left.collect())
    assert got == Counter([*expected, 5, None])
    kept = near_dedup.deduplicated(edge_docs)
    assert kept.columns == edge_docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, 4, 5, 8, 9, None])


def test_blocks_give_the_same_groups(spark, monkeypatch):
    """Near copies around the threshold, with blocks of three and chunks of five columns."""
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 3)
    monkeypatch.setattr(near_dedup, "CHUNK_COLUMNS", 5)
    monkeypatch.setattr(linking, "ROUNDS", 1)
    rows = made_up(n=90, seed=9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_force(rows)
    assert len({c for *_, c in expected}) > 40
    assert Counter(map(tuple, near_dedup.classes(docs).collect())) == expected


def test_block_links_connect_what_links_connect():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 200)
    sets = []
    for _ in range(40):
        keep = base.copy()
        keep[rng.integers(0, 200, rng.integers(0, 40))] = rng.integers(0, 1 << 62, 1)
        sets.append(np.unique(keep))
    sketches = np.array([near_dedup.odd_sketch(near_dedup.minhashes(s.view(np.uint64))) for s in sets])
    ids = np.arange(40)
    found = near_dedup.block_links(ids, ids, ids % 2, sketches, sets, 85, near_dedup.most_flips())
    true = [
        (i, j) for i in ids for j in ids[i + 1 :] if (i + j) % 2
        and 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
    ]

    def parts(edges):
        group = list(range(40))
        for a, b in edges:
            group = [group[b] if g == group[a] else g for g in group]
        return {frozenset(i for i in ids if group[i] == g) for g in group}

    assert set(found) <= set(true) and len(found) < len(true)
    assert parts(found) == parts(true)


def test_chains_are_followed(spark):
    """Groups equal those of all bucket pairs, whatever links hold: a path through one bucket."""
    members = linking.checkpointed(
        spark.range(200).select((F.col("id") % 3).alias("bucket"), F.col("id").alias("node"))
    )
    tested = []

    def test(pairs):
        links = pairs.filter("b - a = 3 and a % 30 < 24")
        tested.append(pairs.count())
        return links

    roots = dict(map(tuple, linking.grouped(members, test).collect()))
    for i in range(200):
        low = i
        while low >= 3 and (low - 3) % 30 < 24:
            low -= 3
        assert roots.get(i, i) == low


def test_a_group_of_near_copies_is_not_listed_pair_by_pair(spark):
    members = linking.checkpointed(
        spark.range(3000).select(F.explode(F.array(F.lit(1), F.lit(2))).alias("bucket"), F.col("id").alias("node"))
    )
    tested = []

    def test(pairs):
        tested.append(pairs.count())
        return pairs

    assert linking.grouped(members, test).agg(F.max("root"), F.count("*")).first() == (0, 2999)
    assert sum(tested) < 3 * 3000


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    for overlap in (0.95, 0.85, 0.7):
        both = rng.integers(0, 1 << 63, int(2000 * overlap), np.uint64)
        rest = [rng.integers(0, 1 << 63, int(1000 * (1 - overlap)), np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([both, r])) for r in rest)
        like = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = (near_dedup.odd_sketch(near_dedup.minhashes(s)) for s in (a, b))
        flips = sum(bin(int(v) & (1 << 64) - 1).count("1") for v in x ^ y)
        assert abs(near_dedup.estimated(flips) - like) < 0.07
        assert like < 0.85 or flips <= near_dedup.most_flips()
