"""The jobs end to end, from a raw CSV table to scored JSON records."""

from pyspark.ml import PipelineModel

from riskpipe.__main__ import main
from riskpipe.spec import SPECS
from verification.synthetic import synthesize_patients
from verification.tables import training_rows


def test_clean_train_and_score(spark, tmp_path):
    at = {n: str(tmp_path / n) for n in ("raw", "clean", "features", "models", "in", "out", "ckpt")}
    reports = str(tmp_path / "quality"), str(tmp_path / "evaluation")
    rows = training_rows(synthesize_patients(spark, 400), "stroke").selectExpr(
        "monotonically_increasing_id() AS id",
        *[c if c != "bmi" else "IF(bmi > 45, 'N/A', string(bmi)) AS bmi" for c in SPECS["stroke"].columns],
    )
    rows.write.option("header", True).csv(at["raw"])

    only = ["--datasets", "stroke"]
    main([*only, "clean", "--raw", f"stroke={at['raw']}", "--clean", at["clean"], "--report", reports[0]])
    cleaned = spark.read.parquet(f"{at['clean']}/stroke")
    assert set(cleaned.columns) == set(SPECS["stroke"].columns)
    assert cleaned.filter("bmi IS NULL").count() == 0
    report = spark.read.option("header", True).csv(reports[0]).first()
    assert int(report["original_rows"]) == 400 and int(report["final_rows"]) == cleaned.count()

    main([*only, "features", "--clean", at["clean"], "--features", at["features"]])
    assert spark.read.parquet(f"{at['features']}/stroke").count() == cleaned.count()

    main([*only, "train", "--clean", at["clean"], "--models", at["models"], "--report", reports[1]])
    evaluation = spark.read.option("header", True).csv(reports[1]).first()
    assert int(evaluation["train_rows"]) + int(evaluation["test_rows"]) == cleaned.count()

    # from what the features job wrote: the same forest, and scores of the same form
    by_features = str(tmp_path / "models2")
    main([*only, "train", "--features", at["features"], "--models", by_features])
    forests = [
        PipelineModel.load(f"{root}/stroke").stages[-1].toDebugString for root in (at["models"], by_features)
    ]
    assert forests[0].split("\n")[1:] == forests[1].split("\n")[1:]

    synthesize_patients(spark, 50).write.json(at["in"])
    main(
        [*only, "score", "--input", at["in"], "--models", at["models"], "--checkpoint", at["ckpt"]]
        + ["--sink", "parquet", "--output", at["out"], "--every", "once", "--files-per-trigger", "0"]
    )
    main(
        [*only, "score", "--input", at["in"], "--models", by_features, "--checkpoint", at["ckpt"] + "2"]
        + ["--output", at["out"] + "2", "--every", "once"]
    )
    key = ["patient_id", "risk", "probability"]
    both = [sorted(map(str, spark.read.parquet(p).select(key).collect())) for p in (at["out"], at["out"] + "2")]
    assert both[0] == both[1]
    scored = spark.read.parquet(at["out"])
    assert scored.count() == 50
    assert scored.filter("risk IN ('LOW', 'MEDIUM', 'HIGH') AND error IS NULL").count() == 50
