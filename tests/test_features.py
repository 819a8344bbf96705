import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskpipe.operators import (
    TableIndexer,
    category_indexer,
    classification_metrics,
    confusion,
    featurize,
    fit_features,
    forest,
    index_by_join,
    label_dictionary,
    load_model,
    risk_profile,
    save_model,
    score,
    split,
    target_labels,
    with_label,
)
from riskpipe.operators.features import check_target, wide_columns
from riskpipe.plans import train
from riskpipe.spec import DatasetSpec
from riskpipe.streaming import write_stream

NAN = float("nan")
SPEC = DatasetSpec("t", "y", categorical=("c d",), numeric=("a", "k"))


def toy(spark):
    return spark.createDataFrame(
        [
            (1.0, 7.0, "u", 0),
            (2.0, 7.0, "v", 1),
            (3.0, 7.0, "u", 1),
            (None, 7.0, "u", 1),
            (NAN, 7.0, "u", 0),
            (4.0, 7.0, None, 1),
            (5.0, 7.0, "u", None),
        ],
        "a double, k double, `c d` string, y int",
    )


def test_features_are_scaled_and_incomplete_rows_skipped(spark):
    df = toy(spark)
    model = fit_features(df, SPEC)
    got = featurize(df, SPEC, model)
    assert got.columns == ["label", "features"]
    rows = [(r[0], *r[1]) for r in got.select("label", vector_to_array("features")).collect()]
    a = [1.0, 2.0, 3.0, 4.0]  # rows with all features and a target
    mean, std = 2.5, (sum((x - 2.5) ** 2 for x in a) / 3) ** 0.5
    index = [0.0, 1.0, 0.0, 2.0]  # u is most frequent, a null category takes the last index
    imean = sum(index) / 4
    istd = (sum((x - imean) ** 2 for x in index) / 3) ** 0.5
    for row, x, i, y in zip(sorted(rows, key=lambda r: r[1]), a, index, [0.0, 1.0, 1.0, 1.0]):
        assert row == pytest.approx((y, (x - mean) / std, 0.0, (i - imean) / istd))


def test_unseen_and_null_categories_take_the_last_index(spark):
    df = toy(spark)
    model = category_indexer(["c d"]).fit(df)
    other = spark.createDataFrame([("u",), ("v",), ("new",), (None,)], "`c d` string")
    got = [r[0] for r in model.transform(other).select("`c d_idx`").collect()]
    assert got == [0.0, 1.0, 2.0, 2.0]


def test_text_target_has_exactly_its_own_classes(spark):
    df = spark.createDataFrame(
        [("Low",), ("High",), ("High",), ("Medium",), (None,)], "Level string"
    ).withColumn("a", F.lit(1.0) + F.monotonically_increasing_id())
    spec = DatasetSpec("t", "Level", numeric=("a",), target_type="string")
    labelled = with_label(df, spec)
    assert labelled.count() == 4
    assert labelled.schema["label"].metadata["ml_attr"]["vals"] == ["High", "Low", "Medium"]
    model = fit_features(df, spec)
    assert target_labels(model) == ["High", "Low", "Medium"]
    # Scoring rows carry no target at all.
    assert model.transform(df.drop("Level")).count() == 5


def test_numeric_target_is_cast(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "y int")
    assert [r["label"] for r in with_label(df, DatasetSpec("t", "y")).collect()] == [1.0, 0.0]


@pytest.mark.parametrize("hot_share", [0, 0.05, 1])
def test_join_index_equals_indexer(spark, hot_share):
    """Also with a hot value, nulls, and values on both sides of the broadcast limit."""
    df = spark.range(600).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE 'v' || id % 40 END AS `c d`"
    )
    by_join = index_by_join(df, "c d", hot_share)
    assert by_join.columns == ["id", "c d", "c d_idx"]
    by_model = category_indexer(["c d"]).fit(df).transform(df)
    assert sorted(map(tuple, by_join.collect()), key=lambda r: r[0]) == sorted(
        map(tuple, by_model.collect()), key=lambda r: r[0]
    )


def test_dictionary_equals_indexer_labels(spark):
    df = spark.range(3000).selectExpr("string(id * id % 97) AS v")
    rows = label_dictionary(df, ["v"]).orderBy("label_index").collect()
    model = category_indexer(["v"]).fit(df)
    assert [r["value"] for r in rows] == list(model.labelsArray[0])


def test_wide_columns_are_told_by_a_sketch_and_wide_targets_refused(spark):
    df = spark.range(1000).selectExpr("string(id) AS v", "string(id % 9) AS `c d`", "'x' AS y")
    assert wide_columns(df, ["v", "c d"], 100) == ["v"]
    assert wide_columns(df, [], 100) == []
    with pytest.raises(ValueError, match="classes"):
        check_target(df, DatasetSpec("t", "v", target_type="string"), limit=100)


def wide_toy(spark):
    """A hot value, many rare ones, nulls, and a narrow category beside it; with extra columns."""
    return spark.range(4000).selectExpr(
        "double(id % 2) AS y",
        "double(id % 17) AS a",
        "double(id % 5) AS k",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 41 = 0 THEN NULL ELSE 'v' || id % 700 END AS `c d`",
        "string(id % 3) AS few",
        "id AS value",
        "'x' AS column_name",
    )


WIDE = DatasetSpec("t", "y", categorical=("c d", "few"), numeric=("a", "k"))


def test_a_wide_category_gives_the_same_features(spark):
    df = wide_toy(spark)
    narrow, wide = fit_features(df, WIDE), fit_features(df, WIDE, max_labels=100)
    kinds = [type(s).__name__ for s in wide.stages]
    assert kinds[:2] == ["StringIndexerModel", "TableIndexerModel"]
    keep = ["value", "column_name"]
    both = [sorted(map(tuple, featurize(df, WIDE, m, keep).collect()), key=lambda r: r[2]) for m in (narrow, wide)]
    assert both[0] == both[1] and len(both[0]) == 4000


def test_a_wide_category_is_saved_loaded_and_scored(spark, tmp_path):
    df = wide_toy(spark)
    model = train(df, WIDE, classifier=forest(trees=3, depth=3), max_labels=100).model
    path = str(tmp_path / "model")
    save_model(model, path)
    again = load_model(path, WIDE)
    save_model(again, path)  # over the table it reads from
    again = load_model(path, WIDE)
    records = df.union(spark.sql("SELECT 0D, 1D, 2D, 'never seen', NULL, 5000L, 'x'"))
    both = risk_profile(records, {"before": model, "after": again}, keep=["value"], pivot=True)
    assert both.count() == both.filter("before = after AND before.error IS NULL").count() == 4001
    assert again.pipeline.stages[1].getOrDefault("sizes") == [model.pipeline.stages[1].dictionary.count()]


def test_a_wide_category_in_a_stream_equals_the_table(spark, tmp_path):
    df = wide_toy(spark)
    model = train(df, WIDE, classifier=forest(trees=3, depth=3), max_labels=100).model
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    write_stream(
        score(stream, {"t": model}, keep=["value"]), str(tmp_path / "progress"), "parquet", out, every=None
    ).awaitTermination()
    streamed = spark.read.parquet(out)
    batch = score(df, {"t": model}, keep=["value"])
    assert streamed.count() == 4000 and streamed.exceptAll(batch).count() == 0


def test_an_empty_wide_table_knows_no_value(spark):
    df = wide_toy(spark)
    model = TableIndexer(["c d"], ["i"]).fit(df.limit(0))
    assert {r["i"] for r in model.transform(df).select("i").distinct().collect()} == {0.0}
    assert TableIndexer(["c d"], ["i"], hotShare=0.5).fit(df).getOrDefault("hotShare") == 0.5


def judged(spark):
    return spark.range(500).selectExpr(
        "double(id % 3) AS label", "double((id * 7 + id % 5) % 4) AS prediction"
    )


def test_metrics_equal_the_evaluator(spark):
    df = judged(spark)
    ours = classification_metrics(confusion(df)).first()
    for mine, theirs in (
        ("accuracy", "accuracy"),
        ("precision", "weightedPrecision"),
        ("recall", "weightedRecall"),
        ("f1_score", "f1"),
    ):
        evaluator = MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="prediction", metricName=theirs
        )
        assert ours[mine] == pytest.approx(evaluator.evaluate(df), abs=1e-12)
    assert ours["n_rows"] == 500


def test_hash_split_ignores_partitioning_and_covers_all_rows(spark):
    df = spark.range(2000).selectExpr("id", "double(id % 7) AS x")
    parts = []
    for n in (2, 7):
        train, test = split(df.repartition(n), ["id", "x"])
        a, b = ({r["id"] for r in part.collect()} for part in (train, test))
        assert not a & b and len(a | b) == 2000
        parts.append(a)
    assert parts[0] == parts[1]
    assert 0.77 < len(parts[0]) / 2000 < 0.83


def test_random_split_is_sparks_own(spark):
    df = spark.range(500)
    ours = [part.count() for part in split(df)]
    assert ours == [part.count() for part in df.randomSplit([0.8, 0.2], seed=42)]
