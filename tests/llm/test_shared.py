import time
from pathlib import Path

from pyspark.sql import functions as F

from riskpipe.llm import near_dedup
from riskpipe.llm.shared import about, checkpointed, release, shared_folder


def checkpoints(spark):
    root = Path(shared_folder(spark).removeprefix("file:"))
    return {p.name for p in root.glob("rdd-*") if any(p.glob("part-*"))}


def gone(spark, names):
    """Whether the checkpoints go once nothing refers to them; the cleaner works in the background."""
    for _ in range(40):
        release(spark)
        if not names & checkpoints(spark):
            return True
        time.sleep(0.5)
    return False


def test_a_checkpoint_goes_with_its_frame(spark):
    before = checkpoints(spark)
    df = checkpointed(spark.range(100).selectExpr("id * 2 AS x"))
    twice = df.filter("x > 50")
    new = checkpoints(spark) - before
    assert len(new) == 1
    del df
    release(spark)
    assert twice.count() == 74 and new <= checkpoints(spark)
    del twice
    assert gone(spark, new)


def test_an_operator_leaves_nothing_behind(spark, documents):
    before = checkpoints(spark)
    rows = near_dedup.near_duplicates(documents)
    assert rows.count() == documents.count()
    left = checkpoints(spark) - before
    del rows
    assert gone(spark, left)


def test_a_sample_is_as_large_in_any_number_of_partitions(spark):
    df = spark.range(20_000)
    for parts in (1, 40):
        assert abs(about(df.repartition(parts), 1000, "id").count() - 1000) < 150
    assert about(df, 20_000, "id").count() == 20_000
    assert about(df.limit(0), 10, "id").count() == 0


def test_release_drops_shuffles_at_once(spark, tmp_path):
    files = lambda: {
        f.getName()
        for f in [every.apply(i) for every in [_all_files(spark)] for i in range(every.size())]
        if f.getName().startswith("shuffle_")
    }
    release(spark)
    time.sleep(2)
    before = files()
    df = spark.range(20000).groupBy((F.col("id") % 999).alias("k")).count()
    df.write.parquet(str(tmp_path / "t"))
    assert files() - before
    del df
    release(spark)
    time.sleep(1.5)  # for Spark's cleaner
    assert not files() - before


def _all_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
