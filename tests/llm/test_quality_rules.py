import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from riskpipe.llm import quality_rules as q
from riskpipe.llm.oracle import RULES_SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    base = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = sum(map(text.count, "#*$%&|<>"))
    return (
        len(words),
        sum(map(len, words)),
        symbols,
        len(lines) - len(set(lines)),
        len(covered),
        base,
    )


@pytest.mark.parametrize("which", ["documents", "edge_docs"])
def test_measures_equal_brute_force(request, which):
    docs = request.getfixturevalue(which)
    expected = Counter((r["doc_id"], *measures(r["text"])) for r in docs.collect())
    got = q.rule_report(docs).collect()
    assert Counter(tuple(r)[:7] for r in got) == expected
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_report_equals_sql(documents, sf_dir):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
        expected = db.execute(RULES_SQL).fetchall()
    assert Counter(map(tuple, q.rule_report(documents).collect())) == Counter(expected)


def test_kept_keeps_columns_and_agrees_with_the_report(documents, edge_docs):
    for docs in (documents, edge_docs):
        left = q.kept(docs)
        assert left.columns == docs.columns
        report = q.rule_report(docs).filter("kept")
        assert Counter(r["doc_id"] for r in left.collect()) == Counter(
            r["doc_id"] for r in report.collect()
        )


def test_order_is_rejection_per_cost(spark):
    docs = spark.createDataFrame([("x " * 30,)] * 50 + [("x",)] * 50, "text string")
    rare = q.Rule("rare", lambda t: F.length(t) < 0)
    often = q.Rule("often", lambda t: F.length(t) < 5)
    order = q.estimate(docs, [rare, often])
    assert [e.rule.name for e in order] == ["often", "rare"]
    assert 0 < order[0].rejected < 1 and order[1].rejected == 0


def test_later_rules_are_not_evaluated(spark):
    docs = spark.createDataFrame([("a",), ("b",)], "text string")
    raises = q.Rule("raises", lambda t: F.raise_error(t).cast("boolean"))
    everything = q.Rule("everything", lambda t: F.length(t) > 0)
    got = docs.select(q.first_failed([everything, raises], F.col("text")).alias("f")).collect()
    assert [r["f"] for r in got] == ["everything"] * 2


def test_nothing_in_nothing_out(no_docs):
    assert q.rule_report(no_docs).count() == 0
    assert q.judged(no_docs).columns == [*no_docs.columns, "failed_rule"]
