import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskpipe.llm import fingerprints as fp


def texts_of(rows):
    return {(r["doc_id"], r["text"] or "") for r in rows}


def brute_force(df):
    """Edited texts by plain Python; ties under one id are ordered by Spark's hash of the text."""
    hashed = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "tie", F.xxhash64("text")
    )
    rows = sorted(
        {(r["doc_id"], r["tie"], r["text"]) for r in hashed.collect()},
        key=lambda r: (r[0] is None, -(r[0] or 0), r[1]),
    )
    found = {}
    for i, (doc_id, _, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][2]
        half = len(text) // 2
        found[doc_id, text] = (text[: len(text) - half] + following[:half], following)
    return found


@pytest.mark.parametrize("which", ["documents", "edge_docs"])
def test_edited_texts_and_prints(request, which, monkeypatch):
    docs = request.getfixturevalue(which)
    expected = brute_force(docs)
    rows = fp.with_next(docs).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(
        (r["doc_id"], r["text"] or "") for r in docs.collect()
    )
    prints = {}
    for r in rows:
        edited, following = expected[r["doc_id"], r["text"]]
        assert r["edited"] == edited
        assert prints.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]
        assert prints.setdefault(following, r["next_print"]) == r["next_print"]
    report = fp.fingerprint_report(docs).collect()
    digests = Counter(
        (doc, len(text), hashlib.sha256(expected[doc, text][0].encode()).hexdigest())
        for doc, text in ((r["doc_id"], r["text"] or "") for r in docs.collect())
    )
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in report) == digests
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in report)


def reference_print(hashes):
    """The fingerprint of a set of 63-bit hashes, from the description."""
    bins = [None] * fp.BINS
    for h in hashes:
        i = h >> 63 - fp.BIN_BITS
        bins[i] = h if bins[i] is None else min(bins[i], h)
    return bins


def test_prints_equal_the_description(spark):
    rng = random.Random(5)
    bodies = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(n)) for n in
              (1, 3, 5, 6, 40, 300, 900)]
    docs = spark.createDataFrame([(b,) for b in bodies], "text string")
    probes = spark.range(fp.BINS).select(
        *(fp._visit(F.col("id").cast("int"), F.lit(t)).alias(f"t{t}") for t in range(fp.BINS))
    )
    visit = [tuple(r) for r in probes.collect()]
    assert all(sorted(v) == list(range(fp.BINS)) for v in visit)
    rows = docs.select(fp.shingle_hashes(F.col("text")).alias("h"), fp.fingerprint(F.col("text")).alias("p"))
    for r in rows.collect():
        bins = reference_print(r["h"])
        full = [b if b is not None else next(bins[j] for j in visit[i] if bins[j] is not None)
                for i, b in enumerate(bins)]
        low = bytes(v & 255 for v in full)
        expected = [int.from_bytes(low[i : i + 8], "little", signed=True) for i in range(0, 128, 8)]
        assert r["p"] == expected


def test_likeness_estimates_similarity(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(1500)]
    pairs = []
    for part in (0, 100, 500, 1500):
        other = [f"x{rng.randrange(10**6)}" for _ in range(part)] + words[part:]
        a, b = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (words, other))
        pairs.append((" ".join(words), " ".join(other), len(a & b) / len(a | b)))
    pairs += [("", " \n", 1.0), ("a b", "", 0.0), ("a b c", "a b c", 1.0)]
    df = spark.createDataFrame(pairs, "a string, b string, truth double")
    got = df.select(
        "truth", fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("like")
    )
    for r in got.collect():
        assert abs(r["truth"] - r["like"]) < 0.16
        assert r["truth"] not in (0, 1) or r["like"] < 0.06 or r["like"] == 1


def test_one_document_and_none(spark, no_docs):
    one = spark.createDataFrame([(7, "a b c d")], "doc_id long, text string")
    (row,) = fp.with_next(one).collect()
    assert row["edited"] == "a b " + "a b" and row["next_print"] == row["fingerprint"]
    assert fp.fingerprint_report(no_docs).count() == 0


def test_texts_are_shuffled_once(spark, documents):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = fp.fingerprint_report(documents)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ReusedExchange" in plan
