import random
from collections import Counter

import numpy as np

from riskpipe.llm import toxicity as tox


def made_up(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice("abcdefgh") * rng.randrange(1, 4) + str(rng.randrange(40)) for _ in range(60)]
        quality = int(rng.random() < 0.8)
        toxic = int(rng.random() < 0.3)
        if not quality:
            words += ["buynow"] * 3
        if toxic:
            words += [f"vilestem{rng.randrange(500)}" for _ in range(rng.randrange(1, 12))]
        rng.shuffle(words)
        rows.append((i, " ".join(words), quality, toxic))
    return rows


def test_held_out_rows(spark):
    rows = made_up(900, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(r[0], r[2], r[3]) for r in rows if r[0] < 600], "doc_id long, quality int, toxic int"
    )
    got = {r["doc_id"]: r for r in tox.toxicity(docs, labels).collect()}
    assert len(got) == 900
    held = [(r, got[r[0]]) for r in rows[600:]]
    # stems are learned: no held-out form need have been seen
    assert np.mean([g["predicted"] == r[3] for r, g in held]) > 0.97
    assert np.mean([(g["low_quality"] > 0.5) == (r[2] == 0) for r, g in held]) > 0.97
    severe = [g["severe"] for r, g in held if r[3]]
    assert np.mean(severe) > 5 * np.mean([g["severe"] for r, g in held if not r[3]])


def test_later_models_see_earlier_categories():
    rng = np.random.default_rng(0)
    first = rng.integers(0, 2, 400)
    rows = tox.Rows([tox.features("signal word" if f else "plain word") for f in first])
    models = tox.fit_chain(rows, np.stack([first, first], axis=1).astype(float))
    assert [len(m.dense) for m in models] == [1, 2] and models[1].dense[0] > 0
    found = tox.chain_probabilities(models, rows)
    assert ((found > 0.5) == first[:, None]).all()


def test_edge_rows(edge_docs, no_docs, spark):
    labels = edge_docs.selectExpr(
        "doc_id", "cast(doc_id % 2 as int) as quality", "cast(doc_id % 3 = 0 as int) as toxic"
    ).unionByName(spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"))
    rows = tox.toxicity(edge_docs, labels).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in edge_docs.collect())
    assert all(0 <= r[c] <= 1 for r in rows for c in tox.CATEGORIES)
    unlearned = tox.toxicity(edge_docs, labels.limit(0)).collect()
    assert {r["toxic"] for r in unlearned} == {0.0} and len(unlearned) == len(rows)
    assert tox.toxicity(no_docs, labels).count() == 0
