"""Training, saving, scoring and streaming on the same records."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from riskpipe.operators import (
    forest,
    load_model,
    project_for,
    risk_profile,
    save_model,
    score,
    score_errors,
    top_features,
)
from riskpipe.plans import evaluation_report, featurize_all, train, train_all
from riskpipe.plans.learning import side_by_side, training_parts
from riskpipe.sources import read_stream, stage, write_table
from riskpipe.spec import RECORD_FIELDS, RECORD_SCHEMA, SPECS
from riskpipe.streaming import fan_out, load_models, start_scoring, write_stream
from verification import queries, tables
from verification.synthetic import synthesize_patients
from verification.tables import training_rows

COLUMNS = ["patient_id", "timestamp", "dataset", "risk", "probability", "error"]


@pytest.fixture(scope="module")
def records(spark):
    return stage(synthesize_patients(spark, 300))


@pytest.fixture(scope="module")
def clean_root(spark, records, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clean"))
    for name in SPECS:
        write_table(training_rows(records, name), f"{root}/{name}")
    return root


@pytest.fixture(scope="module")
def results(spark, clean_root, tmp_path_factory):
    root = tmp_path_factory.mktemp("models")
    results = train_all(
        spark, SPECS, clean_root, str(root), str(root / "report"), classifier=forest(8, 4)
    )
    return results, root


@pytest.fixture(scope="module")
def models(results):
    return {name: r.model for name, r in results[0].items()}


def rows(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


def test_record_schema_and_domains(records):
    assert records.dtypes == [(f.name, f.dataType.simpleString()) for f in RECORD_SCHEMA]
    assert len(RECORD_SCHEMA) == 56
    assert sum(isinstance(f.dataType, DoubleType) for f in RECORD_SCHEMA) == 49
    assert sum(isinstance(f.dataType, StringType) for f in RECORD_SCHEMA) == 7
    found = records.agg(
        *[F.min(f.name).alias(f"{f.name}_lo") for f in RECORD_FIELDS],
        *[F.max(f.name).alias(f"{f.name}_hi") for f in RECORD_FIELDS],
    ).first()
    for f in RECORD_FIELDS:
        low, high = found[f"{f.name}_lo"], found[f"{f.name}_hi"]
        if f.choices:
            assert {low, high} <= set(f.choices)
        else:
            assert f.low / f.scale <= low < high <= f.high / f.scale
    assert records.filter("patient_id RLIKE '^PAT-[A-Z][a-z]+-[A-Z][a-z]+-[0-9]+$'").count() == 300
    assert records.agg(F.max("timestamp")).first()[0] == "2024-01-01 00:24:55"


def test_every_input_has_a_record_field():
    fields = {f.name for f in RECORD_SCHEMA}
    for spec in SPECS.values():
        assert {spec.record_field(name) for name in spec.inputs} <= fields
    assert [len(s.numeric) for s in SPECS.values()] == [21, 21, 5, 23]


def test_records_do_not_depend_on_partitioning(spark, records):
    again = synthesize_patients(spark.range(300).repartition(7))
    assert sorted(map(str, again.collect())) == sorted(map(str, records.collect()))


def test_training_report(spark, results, clean_root):
    report = {r["disease"]: r for r in evaluation_report(spark, results[0]).collect()}
    assert list(report) == list(SPECS)
    for row in report.values():
        assert row["train_rows"] + row["test_rows"] == 300
        assert all(0 <= row[m] <= 1 for m in ("accuracy", "precision", "recall", "f1_score"))
    assert len(list((results[1] / "report").glob("part-*.csv"))) == 1


def test_feature_tables(spark, clean_root, tmp_path):
    featurize_all(spark, SPECS, clean_root, str(tmp_path))
    for name in SPECS:
        df = spark.read.parquet(str(tmp_path / name))
        assert df.columns == ["label", "features", "is_train", "row_hash"] and df.count() == 300


def test_fit_on_training_rows_and_random_split(spark, clean_root):
    df = spark.read.parquet(f"{clean_root}/stroke")
    result = train(df, SPECS["stroke"], "train", "random", forest(4, 3))
    assert result.train_rows + result.test_rows == 300
    with pytest.raises(ValueError):
        train(df, SPECS["stroke"], "some")


def test_rows_without_target_are_counted(spark, clean_root):
    df = spark.read.parquet(f"{clean_root}/lungcancer")
    gone = df.withColumn("Level", F.expr("IF(Age = 3, NULL, Level)"))
    result = train(gone, SPECS["lungcancer"], classifier=forest(3, 3))
    assert result.rows_without_target == df.filter("Age = 3").count() > 0
    assert result.model.forest.numClasses == 3


def test_important_features_are_named(spark, models):
    top = top_features(spark, models["stroke"]).collect()
    assert len(top) == 5
    weights = [r["importance"] for r in top]
    assert weights == sorted(weights, reverse=True)
    assert {r["feature"] for r in top} <= set(SPECS["stroke"].features)


def test_scores_are_sound(records, models):
    got = score(records, models)
    assert got.columns == COLUMNS
    assert got.count() == 1200
    bad = got.filter("error IS NOT NULL OR risk IS NULL OR abs(aggregate(probability, 0D, (a, x) -> a + x) - 1) > 1e-9")
    assert bad.count() == 0
    sizes = {r[0]: r[1] for r in got.selectExpr("dataset", "size(probability)").distinct().collect()}
    assert sizes == {"heart": 2, "diabetes": 2, "stroke": 2, "lungcancer": 3}


def test_scoring_equals_transforming_each_dataset(records, models):
    """The side-by-side pass gives what each pipeline gives alone."""
    wide = risk_profile(records, models, pivot=True)
    for name, model in models.items():
        alone = model.pipeline.transform(project_for(records, SPECS[name]))
        a = alone.select("patient_id", vector_to_array("probability")).collect()
        b = wide.select("patient_id", f"{name}.probability").collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_plan_reads_the_records_once(records, models):
    plan = score(records, models)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_saved_model_predicts_the_same(spark, records, models, results):
    again = load_models(str(results[1]), SPECS)
    assert rows(score(records, again)) == rows(score(records, models))
    assert load_model(str(results[1] / "lungcancer"), SPECS["lungcancer"]).labels == models[
        "lungcancer"
    ].labels
    save_model(models["heart"], str(results[1] / "heart"))  # overwrites


def test_missing_inputs_become_errors_of_their_dataset_only(records, models):
    gaps = records.withColumns(
        {"Snoring": F.lit(None).cast("double"), "bmi_stroke": F.lit(float("nan"))}
    ).drop("HighBP")
    got = score(gaps, models)
    errors = {(r["dataset"], r["error"]) for r in got.select("dataset", "error").distinct().collect()}
    assert errors == {
        ("heart", "missing: HighBP"),
        ("diabetes", "missing: HighBP"),
        ("stroke", "missing: bmi_stroke"),
        ("lungcancer", "missing: Snoring"),
    }
    assert got.filter("risk IS NOT NULL OR probability IS NOT NULL").count() == 0
    zero = score(gaps, models, missing="zero")
    assert {r[0] for r in zero.filter("error IS NOT NULL").select("dataset").collect()} == {"stroke"}
    with pytest.raises(ValueError):
        score(records, models, missing="maybe")


def test_null_category_scores_as_unseen(records, models):
    null = records.withColumn("work_type", F.lit(None).cast("string"))
    odd = records.withColumn("work_type", F.lit("never heard of"))
    stroke = {"stroke": models["stroke"]}
    assert rows(score(null, stroke)) == rows(score(odd, stroke))
    assert score_errors(null, SPECS["stroke"]).filter("error IS NOT NULL").count() == 0


def write_json(records, path, files=3):
    records.repartition(files).write.json(str(path))


def test_stream_equals_batch_and_does_not_repeat(spark, records, models, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    write_json(records, source)

    def run():
        query = start_scoring(
            spark, source, models, progress, "parquet", out, every=None, max_files_per_trigger=1
        )
        query.awaitTermination()
        return spark.read.parquet(out)

    assert rows(run()) == rows(score(records, models))
    more = synthesize_patients(spark.range(1000, 1040))
    more.coalesce(1).write.mode("append").json(source)
    assert run().count() == 4 * 340
    assert run().count() == 4 * 340  # nothing new: nothing written


def test_absent_json_fields_are_errors(spark, models, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.json").write_text(json.dumps({"patient_id": "P", "timestamp": "t", "BMI": 20.0}))
    stream = score(read_stream(spark, str(source)), models)
    write_stream(
        stream, str(tmp_path / "progress"), "parquet", str(tmp_path / "out"), every=None
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) == 4 and all(r["error"].startswith("missing: ") for r in got)


def test_a_forest_does_not_depend_on_files_or_cores(spark, records):
    rows = stage(training_rows(records, "stroke"))
    grown = [
        train(part, SPECS["stroke"], classifier=forest(trees=5, depth=4))
        for part in (rows.coalesce(1), rows.repartition(7))
    ]
    found = [
        sorted((r["label"], round(r["probability"][1], 9)) for r in g.predictions.collect()) for g in grown
    ]
    assert found[0] == found[1] and len(found[0]) > 20


def test_deep_forests_keep_the_nodes_of_rows_and_grow_the_same_trees(spark, records):
    assert forest().getCacheNodeIds() and not forest(20, 6).getCacheNodeIds()
    rows = stage(training_rows(records, "lungcancer"))
    deep = forest(trees=6, depth=9)
    grown = [
        train(rows, SPECS["lungcancer"], classifier=deep.copy({deep.cacheNodeIds: kept})).model.forest
        for kept in (False, True)
    ]
    trees = [[tree.toDebugString.split("\n", 1)[1] for tree in one.trees] for one in grown]
    assert trees[0] == trees[1] and max(tree.depth for tree in grown[1].trees) > 6


def test_the_stream_and_the_batch_share_records_in_even_files(spark, models, tmp_path, monkeypatch):
    spark.range(1, 601).selectExpr("id AS c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    made = []

    def counted(*given):
        made.append(tables.gappy_patients(*given))
        return made[-1]

    monkeypatch.setattr(queries, "gappy_patients", counted)
    monkeypatch.setattr(queries, "_models", lambda *given: models)
    found = queries.stream_matches_batch(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [(name, 600, 600) for name in sorted(SPECS)]
    assert len(made) == 1 and all(len(made[0].inputFiles()) % cores == 0 for cores in (6, 8, 12, 16))


def test_parts_follow_from_the_rows_alone():
    assert [training_parts(n, 21) for n in (0, 1, 1000, 1001, 12_000, 10**6)] == [1, 1, 1, 2, 12, 32]
    for rows, features in ((10**9, 21), (10**11, 200)):
        assert rows / training_parts(rows, features) * (features + 1) * 8 <= 128 << 20


@pytest.mark.parametrize("size", [1, 12])
def test_a_forest_does_not_depend_on_cores(size, tmp_path):
    """The same table on two and on four cores: the same parts, the same forest, noted when saved."""
    code = f"""
import re, sys
from pyspark.sql import SparkSession
from riskpipe.operators import forest, load_model, save_model
from riskpipe.plans import train
from riskpipe.spec import SPECS
from verification.synthetic import synthesize_patients
from verification.tables import training_rows
spark = (SparkSession.builder.master(f"local[{{sys.argv[1]}}]").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[2]).getOrCreate())
rows = training_rows(synthesize_patients(spark, {size} * 400), "heart")
done = train(rows, SPECS["heart"], classifier=forest(4, 4), partitions=None)
save_model(done.model, sys.argv[2] + "/model")
again = load_model(sys.argv[2] + "/model", SPECS["heart"])
# the scaler's sums, and so the last digits of thresholds, may differ
trees = re.sub(r"-?[0-9]+[.][0-9]+(E-?[0-9]+)?", lambda m: format(float(m[0]), ".6f"), again.forest.toDebugString)
print("FOREST", again.parts, again.train_rows == done.train_rows, hash(trees.split(chr(10), 1)[1]))
"""
    found = []
    for cores in (2, 4):
        ran = subprocess.run(
            [sys.executable, "-c", code, str(cores), str(tmp_path / str(cores))],
            capture_output=True, text=True, timeout=300, cwd=Path(__file__).parents[1],
            env={**os.environ, "PYTHONHASHSEED": "0"},
        )
        found.append([x for x in ran.stdout.splitlines() if x.startswith("FOREST")])
    assert found[0] == found[1] and len(found[0]) == 1, ran.stderr[-2000:]
    assert found[0][0].split()[1:3] == [{1: "1", 12: "4"}[size], "True"]


def test_console_prints_every_result(spark, models, records, tmp_path, capsys):
    write_json(records.limit(30), tmp_path / "in", 1)
    with pytest.raises(ValueError, match="path"):
        start_scoring(spark, str(tmp_path / "in"), models, str(tmp_path / "progress"))
    query = start_scoring(
        spark, str(tmp_path / "in"), models, str(tmp_path / "progress"), "console", every=None
    )
    query.awaitTermination()
    printed = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert len(printed) == 120 and len({(p["patient_id"], p["dataset"]) for p in printed}) == 120


def test_batches_fan_out_and_empty_ones_are_skipped(spark, models, records, tmp_path):
    write_json(records.limit(20), tmp_path / "in", 2)
    seen = []
    sink = fan_out(
        lambda batch, i: seen.append((i, batch.count())),
        lambda batch, i: batch.write.mode("append").parquet(str(tmp_path / "copy")),
    )
    query = start_scoring(
        spark, str(tmp_path / "in"), models, str(tmp_path / "progress"), sink, every=None
    )
    query.awaitTermination()
    assert [n for _, n in seen if n] == [n for _, n in seen]
    assert sum(n for _, n in seen) == 80
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 80
    fan_out(lambda batch, i: seen.append("never"))(spark.range(0), 9)
    assert "never" not in seen


def test_long_running_query_processes_new_files(spark, models, records, tmp_path):
    source = tmp_path / "in"
    write_json(records.limit(5), source, 1)
    query = start_scoring(
        spark, str(source), models, str(tmp_path / "progress"), "parquet", str(tmp_path / "out"),
        every="1 second",
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        assert sum(p["numInputRows"] for p in query.recentProgress) == 5
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_datasets_are_trained_side_by_side_and_a_failure_leaves_the_others(
    spark, clean_root, results, tmp_path
):
    """Heart's table is missing; the others are saved and reported, with the same predictions."""
    broken = {**SPECS, "lost": SPECS["heart"]}
    with pytest.raises(ExceptionGroup, match="lost") as caught:
        train_all(
            spark, broken, clean_root, str(tmp_path), str(tmp_path / "report"), classifier=forest(8, 4), at_once=3
        )
    assert len(caught.value.exceptions) == 1
    report = spark.read.option("header", True).csv(str(tmp_path / "report"))
    assert [r["disease"] for r in report.collect()] == list(SPECS)
    for name, spec in SPECS.items():
        again = load_model(str(tmp_path / name), spec).forest
        assert again.toDebugString.split("\n", 1)[1] == results[0][name].model.forest.toDebugString.split("\n", 1)[1]


def test_tasks_run_in_threads_and_inherit_the_callers_properties(spark):
    from threading import Barrier, get_ident

    spark.sparkContext.setLocalProperty("mine", "kept")
    together = Barrier(2, timeout=60)

    def task():
        together.wait()  # passes only if both run at the same time
        context = spark.sparkContext
        return context.getLocalProperty("mine"), context.getLocalProperty("spark.scheduler.pool"), get_ident()

    def fails():
        raise KeyError("no")

    done, failed = side_by_side(spark, {"a": task, "b": task, "c": fails}, at_once=2)
    assert [d[:2] for d in done.values()] == [("kept", "a"), ("kept", "b")]
    assert list(done) == ["a", "b"] and done["a"][2] != done["b"][2]
    assert list(failed) == ["c"] and isinstance(failed["c"], KeyError)
    spark.sparkContext.setLocalProperty("mine", None)
