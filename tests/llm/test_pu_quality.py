import zlib
from collections import Counter

import numpy as np
import pytest

from riskpipe.llm import pu_quality as pu


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    return read("documents"), read("labels")


def test_held_out_accuracy(tables):
    docs, labels = tables
    rows = {r["doc_id"]: r for r in pu.scored(docs, labels).collect()}
    assert len(rows) == docs.count()
    for doc_id, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    test = [(r["quality"], rows[r["doc_id"]]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    good = np.array([r["score"] for q, r in test if q])
    bad = np.array([r["score"] for q, r in test if not q])
    assert (good[:, None] > bad).mean() > 0.93
    assert np.mean([r["predicted"] == q for q, r in test]) > 0.93


def test_held_out_labels_change_nothing(tables):
    docs, labels = tables
    base = pu.scored(docs, labels).collect()
    turned = labels.selectExpr(
        "doc_id",
        "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) as quality",
    )
    assert turned.join(labels, ["doc_id", "quality"]).count() < labels.count()
    assert pu.scored(docs, turned).collect() == base


def test_prior_and_risk_on_known_mixtures(spark):
    rng = np.random.default_rng(2)
    for prior in (0.3, 0.7):
        def draw(n, share):
            side = rng.random(n) < share
            x = rng.normal(0, 1, (n, pu.N_MEASURES))
            x[:, 0] += np.where(side, 2.5, -2.5)
            return x, side
        positive, _ = draw(1500, 1.0)
        unlabelled, _ = draw(4000, prior)
        net = pu.ranking(positive[::2], unlabelled[::2])
        rows = spark.createDataFrame([(x.tolist(),) for x in unlabelled], "measures array<double>").repartition(3)
        scores = np.sort(net.margin(positive[1::2]))[::50]
        above, n = pu.counts_above(rows, net, scores)
        margins = net.margin(unlabelled)
        assert n == 4000 and above.tolist() == [int((margins >= s).sum()) for s in scores]
        found = pu.estimated_prior(net.margin(positive[1::2]), lambda s: pu.counts_above(rows, net, s))
        assert abs(found - prior) < 0.08
        net = pu.train(positive, unlabelled, found)
        x, side = draw(2000, 0.5)
        assert ((net.margin(x) > 0) == side).mean() > 0.95


def test_edge_rows_and_no_labels(edge_docs, no_docs, tables):
    _, labels = tables
    rows = pu.scored(edge_docs, labels.filter("quality = 0")).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in edge_docs.collect())
    assert {r["score"] for r in rows} == {0.5}
    assert not {r["doc_id"]: r for r in rows}[None]["held_out"]
    some = labels.limit(0).unionByName(
        edge_docs.selectExpr("doc_id", "1 as quality", "0 as toxic").limit(8)
    )
    again = pu.scored(edge_docs, some).collect()
    assert all(0 <= r["score"] <= 1 for r in again)
    assert pu.scored(no_docs, labels).count() == 0
