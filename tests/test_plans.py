"""What the physical plans must look like for the operators to hold at scale."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from riskpipe.operators import (
    column_stats,
    distinct_counts,
    drop_duplicate_rows,
    impute_mode,
    label_dictionary,
    modes,
    to_double,
    train_flag,
)
from riskpipe.plans import clean
from verification.tables import DIRTY, dirty_events, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(text):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


def test_statistics_read_only_their_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    assert scanned(plan(column_stats(lines, ["l_tax"]))) == [{"l_tax"}]
    assert scanned(plan(modes(lines, ["l_returnflag"]))) == [{"l_returnflag"}]
    assert scanned(plan(distinct_counts(lines, ["l_tax", "l_suppkey"]))) == [{"l_tax"}, {"l_suppkey"}]


def test_counts_combine_before_they_are_shuffled(spark, sf_dir):
    for df in (
        modes(table(spark, sf_dir, "lineitem"), ["l_returnflag"]),
        drop_duplicate_rows(table(spark, sf_dir, "orders")),
    ):
        text = plan(df)
        below = text[text.rindex("Exchange hashpartitioning") :]
        assert "HashAggregate" in below or "partial" in below


def test_row_wise_operators_do_not_shuffle(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    assert "Exchange" not in plan(impute_mode(orders, ["o_orderpriority"]))
    assert "Exchange" not in plan(orders.filter(train_flag(["o_orderkey"])))


def test_pruned_filters_reach_the_scan(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity > 10").select("l_tax")
    text = plan(lines)
    assert "GreaterThan(l_quantity,10.0)" in text
    assert scanned(text) == [{"l_quantity", "l_tax"}]


def test_casts_are_pruned(spark, sf_dir):
    """Of 23 cast columns the scan reads the one that is used."""
    lines = table(spark, sf_dir, "lineitem")
    wide = lines.select("*", *[F.col("l_shipdate").cast("string").alias(f"n{i}") for i in range(20)])
    cast = to_double(wide, [f"n{i}" for i in range(20)] + ["l_orderkey", "l_partkey", "l_suppkey"])
    assert scanned(plan(cast.select("l_partkey"))) == [{"l_partkey"}]


def test_clean_results_outlast_the_work(spark, sf_dir, tmp_path):
    """Counts are settled: no later reading, no change when the path is cleaned again."""
    path = str(tmp_path / "clean")
    done = clean(dirty_events(spark, sf_dir), DIRTY, path, error=0)
    assert scanned(plan(done.counts)) == scanned(plan(done.report)) == []
    before = done.report.collect()
    clean(dirty_events(spark, sf_dir).limit(10), DIRTY, path, error=0)
    assert done.report.collect() == before


def test_only_results_stay_in_the_shared_folder(spark, sf_dir, tmp_path):
    root = Path(spark.conf.get("spark.checkpoint.dir")) / "riskpipe" / spark.sparkContext.applicationId
    kept = lambda: {p for p in root.iterdir()} if root.exists() else set()
    before = kept()
    clean(dirty_events(spark, sf_dir), DIRTY, str(tmp_path / "clean"), error=0)
    assert kept() == before
    label_dictionary(table(spark, sf_dir, "orders"), ["o_orderstatus"], window_rows=1).count()
    (result,) = kept() - before
    assert [p.name for p in result.iterdir()] == ["table"]


def test_clean_table_is_scanned_as_it_is(spark, sf_dir):
    done = clean(dirty_events(spark, sf_dir), DIRTY, error=0)
    assert scanned(plan(done.table)) == [set(done.table.columns)]
