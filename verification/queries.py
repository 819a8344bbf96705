"""One function per registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.functions import class_probability, missing_cells, risk_band, risk_from_label
from riskpipe.operators import (
    RiskModel,
    assembler,
    category_indexer,
    classification_metrics,
    column_stats,
    confusion,
    continuous_columns,
    distinct_counts,
    drop_duplicate_rows,
    drop_ids,
    drop_sparse_rows,
    featurize,
    fit_features,
    forest,
    impute_median,
    impute_mode,
    index_by_join,
    label_dictionary,
    load_model,
    modes,
    project_for,
    quantile_table,
    remove_outliers,
    risk_profile,
    save_model,
    scaler,
    score,
    score_errors,
    to_double,
    top_features,
    train_flag,
    validate_schema,
    with_label,
)
from riskpipe.plans import (
    TrainResult,
    add_evaluation,
    clean,
    evaluation_of_parts,
    evaluation_report,
    feature_columns,
    train,
    train_all,
)
from riskpipe.plans.cleaning import REPORT_COLUMNS
from riskpipe.plans.learning import side_by_side
from riskpipe.sources import (
    read_raw,
    read_stream,
    read_table,
    stage,
    staging_dir,
    write_report,
    write_table,
)
from riskpipe.spec import SPECS, DatasetSpec
from riskpipe.streaming import batch_table, start_scoring, with_quarantine, write_stream
from riskpipe.streaming.quarantine import CORRUPT
from verification.synthetic import synthesize_patients
from verification.tables import (
    DIRTY,
    FILES,
    LINES,
    ORDERS,
    WIDE_FROM,
    WIDE_ORDERS,
    dirty_events,
    gappy_patients,
    patients,
    table,
    training_rows,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINEITEM_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
QUARTILES = (0.25, 0.5, 0.75)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _typed_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_double(drop_ids(dirty_events(spark, sf_dir), DIRTY), DIRTY.numeric)


def _complete_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_sparse_rows(_typed_dirty(spark, sf_dir))


# --- projections and predicates ------------------------------------------------------------------


@query
def lenient_cast(spark, sf_dir):
    return to_double(dirty_events(spark, sf_dir), DIRTY.numeric).select(
        "event_id", *DIRTY.numeric
    )


@query
def missing_count_hist(spark, sf_dir):
    df = _typed_dirty(spark, sf_dir)
    return df.groupBy(missing_cells(df).cast("long").alias("n_missing")).agg(
        F.count("*").alias("n_rows")
    )


@query
def drop_sparse(spark, sf_dir):
    return _complete_dirty(spark, sf_dir)


# --- statistics ----------------------------------------------------------------------------------


@query
def quantiles_by_column(spark, sf_dir):
    lines = quantile_table(table(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC, QUARTILES, 0)
    return lines.unionByName(
        quantile_table(table(spark, sf_dir, "events"), ["value", "user_id"], QUARTILES, 0)
    )


@query
def approx_medians_within_error(spark, sf_dir):
    """Whether the default one-pass medians lie within their stated rank error."""
    df = table(spark, sf_dir, "lineitem")
    found = quantile_table(df, LINEITEM_NUMERIC, [0.5], 0.01).collect()
    checks = []
    for row in found:
        name, value = row["column_name"], row["value"]
        below = F.count_if(F.col(name) < value) / F.count("*")
        upto = F.count_if(F.col(name) <= value) / F.count("*")
        checks.append(
            F.struct(
                F.lit(name).alias("column_name"),
                ((below <= 0.51) & (upto >= 0.49)).alias("within_error"),
            )
        )
    return df.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


@query
def distinct_counts_by_column(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    dirty = distinct_counts(_typed_dirty(spark, sf_dir), [*DIRTY.numeric, "event_type", "flag"])
    return distinct_counts(df, df.columns).unionByName(dirty)


@query
def modes_by_column(spark, sf_dir):
    orders = modes(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])
    return orders.unionByName(modes(dirty_events(spark, sf_dir), ["event_type"]))


@query
def column_stats_by_column(spark, sf_dir):
    stats = column_stats(table(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC)
    return stats.select(
        "column_name", "n_values", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")
    )


@query
def label_dictionary_by_column(spark, sf_dir):
    return label_dictionary(
        table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"]
    )


# --- cleaning ------------------------------------------------------------------------------------


@query
def median_imputation(spark, sf_dir):
    return impute_median(_complete_dirty(spark, sf_dir), DIRTY.numeric, error=0)


@query
def mode_imputation(spark, sf_dir):
    return impute_mode(_complete_dirty(spark, sf_dir), DIRTY.categorical)


@query
def continuous_column_flags(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    cols = [*LINEITEM_NUMERIC, "l_linenumber", "l_suppkey"]
    found = continuous_columns(df, cols)
    # One row per column with its flag and how many rows it was judged on.
    flags = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(name in found).alias("is_continuous"),
                F.count(name).alias("n_rows"),
            )
            for name in cols
        ]
    )
    return df.agg(flags.alias("flags")).select(F.inline("flags"))


@query
def outliers_sequential(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id", "value", F.expr("value * value").alias("squared"), "user_id"
    )
    return remove_outliers(df, ["value", "squared", "user_id"], error=0)


@query
def outliers_independent(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id", "value", F.expr("value * value").alias("squared"), "user_id"
    )
    return remove_outliers(df, ["value", "squared", "user_id"], sequential=False, error=0)


@query
def exact_dedup(spark, sf_dir):
    return drop_duplicate_rows(_typed_dirty(spark, sf_dir))


@query
def clean_chain(spark, sf_dir):
    return clean(dirty_events(spark, sf_dir), DIRTY, error=0).table


@query
def clean_stage_counts(spark, sf_dir):
    return clean(dirty_events(spark, sf_dir), DIRTY, error=0).counts


@query
def quality_report(spark, sf_dir):
    return clean(dirty_events(spark, sf_dir), DIRTY, error=0).report


# --- sources and sinks ---------------------------------------------------------------------------


@query
def csv_round_trip(spark, sf_dir):
    path = f"{staging_dir(spark)}/orders"
    table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    return read_raw(spark, path).select(
        F.col("o_orderkey").cast("long"),
        F.col("o_custkey").cast("long"),
        "o_orderstatus",
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("o_orderdate"),
        "o_orderpriority",
    )


@query
def csv_spec_scan(spark, sf_dir):
    """Dirty rows through a CSV file, read with the schema the spec implies."""
    path = f"{staging_dir(spark)}/dirty"
    dirty_events(spark, sf_dir).write.option("header", True).csv(path)
    return to_double(drop_ids(read_raw(spark, path, DIRTY), DIRTY), DIRTY.numeric)


@query
def parquet_round_trip(spark, sf_dir):
    path = f"{staging_dir(spark)}/lineitem"
    write_table(table(spark, sf_dir, "lineitem"), path)
    return read_table(spark, path)


@query
def report_round_trip(spark, sf_dir):
    path = f"{staging_dir(spark)}/report"
    report = clean(dirty_events(spark, sf_dir), DIRTY, error=0).report.select(*REPORT_COLUMNS)
    write_report(report, path)
    return read_raw(spark, path, schema=report.schema)


@query
def json_stream_source(spark, sf_dir):
    """Records through JSON files and a stream that takes what is there, then stops."""
    work = staging_dir(spark)
    patients(spark, sf_dir).write.json(f"{work}/in")
    stream = read_stream(spark, f"{work}/in", max_files_per_trigger=4)
    write_stream(stream, f"{work}/progress", "parquet", f"{work}/out", every=None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{work}/out")


@query
def quarantined_records(spark, sf_dir):
    """Records through a stream, some of them cut off, some no object, some with words for numbers:
    how many reach the score's check of inputs, and how many are listed for which reason."""
    work = staging_dir(spark)
    records = patients(spark, sf_dir)
    rows = records.select(
        F.element_at(F.split("patient_id", "-"), -1).cast("long").alias("key"),
        F.to_json(F.struct(*records.columns)).alias("line"),
    )
    broken = (
        F.when(F.col("key") % 10 == 1, F.expr("left(line, length(line) - 1)"))
        .when(F.col("key") % 10 == 2, F.lit('"no record"'))
        .when(F.col("key") % 10 == 3, F.regexp_replace("line", '"BMI":[0-9.]+', '"BMI":"high"'))
        .otherwise(F.col("line"))
    )
    rows.select(broken.alias("line")).repartition(4).write.text(f"{work}/in")
    write = with_quarantine(
        lambda sound: score_errors(sound, SPECS["stroke"]),
        batch_table(f"{work}/sound"),
        batch_table(f"{work}/broken"),
    )
    stream = read_stream(spark, f"{work}/in", max_files_per_trigger=2, corrupt=CORRUPT)
    write_stream(stream, f"{work}/progress", write, every=None).awaitTermination()
    sound = spark.read.parquet(f"{work}/sound").select(
        F.lit("sound").alias("kind"), F.col("error").isNull().alias("told")
    )
    listed = spark.read.parquet(f"{work}/broken").select(
        F.col("reason").alias("kind"), F.col("file").contains(f"{work}/in/").alias("told")
    )
    return sound.unionAll(listed).groupBy("kind").agg(
        F.count("*").alias("n_rows"), F.count_if("told").alias("n_told")
    )


@query
def synthetic_patients(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return synthesize_patients(orders, id_column="o_orderkey")


# --- features ------------------------------------------------------------------------------------


@query
def numeric_label(spark, sf_dir):
    spec = DatasetSpec("labels", "quality", numeric=("toxic",))
    return with_label(table(spark, sf_dir, "labels"), spec).select("doc_id", "quality", "label")


@query
def label_dispatch(spark, sf_dir):
    return with_label(table(spark, sf_dir, "orders"), ORDERS).select(
        "o_orderkey", "o_orderstatus", "label"
    )


@query
def index_categories(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    cols = ["o_orderstatus", "o_orderpriority"]
    return category_indexer(cols).fit(df).transform(df).select(
        "o_orderkey", "o_orderstatus_idx", "o_orderpriority_idx"
    )


@query
def index_unseen_categories(spark, sf_dir):
    """Indices fitted on finished orders, applied to all: other priorities and nulls go last."""
    df = table(spark, sf_dir, "orders").withColumn(
        "priority", F.expr("IF(o_orderstatus = 'P', NULL, o_orderpriority)")
    )
    seen = df.filter("o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'")
    return category_indexer(["priority"]).fit(seen).transform(df).select(
        "o_orderkey", "priority_idx"
    )


@query
def index_wide_category(spark, sf_dir):
    """Customer keys as a category, indexed by a join instead of a driver-side dictionary."""
    return index_by_join(table(spark, sf_dir, "orders"), "o_custkey").select(
        "o_orderkey", "o_custkey_idx"
    )


@query
def index_skewed_category(spark, sf_dir):
    """The same for a column with hot values; only those above a hundredth are broadcast."""
    return index_by_join(table(spark, sf_dir, "events"), "user_id", hot_share=0.01).select(
        "event_id", "user_id_idx"
    )


@query
def assembled_vectors(spark, sf_dir):
    df = to_double(dirty_events(spark, sf_dir), DIRTY.numeric)
    values = vector_to_array("features_raw")
    return assembler(DIRTY.numeric).transform(df).select(
        "event_id", *[values[i].alias(f"f{i}") for i in range(len(DIRTY.numeric))]
    )


@query
def scaled_features(spark, sf_dir):
    df = to_double(table(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC).withColumn(
        "constant", F.lit(1.0)
    )
    names = [*LINEITEM_NUMERIC, "constant"]
    scaled = Pipeline(stages=[assembler(names), scaler()]).fit(df).transform(df)
    values = vector_to_array("features")
    return scaled.select(
        "l_orderkey",
        "l_linenumber",
        *[F.round(values[i], 5).alias(name) for i, name in enumerate(names)],
    )


@query
def feature_table(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    features = featurize(df, ORDERS, fit_features(df, ORDERS))
    return feature_columns(features, ORDERS).select(
        "label", *[F.round(name, 5).alias(name) for name in ORDERS.features]
    )


@query
def wide_feature_table(spark, sf_dir):
    """Features with a category that a joined table indexes instead of the model's labels."""
    df = table(spark, sf_dir, "orders")
    features = featurize(df, WIDE_ORDERS, fit_features(df, WIDE_ORDERS, max_labels=WIDE_FROM))
    return feature_columns(features, WIDE_ORDERS).select(
        "label", *[F.round(name, 5).alias(name) for name in WIDE_ORDERS.features]
    )


@query
def wide_category_scores(spark, sf_dir):
    """Orders scored by a model with a wide category: sound results, and how many of them a reloaded
    model and a stream repeat."""
    rows = table(spark, sf_dir, "orders")
    result = train(rows, WIDE_ORDERS, classifier=_small(), split_key=["o_orderkey"], max_labels=WIDE_FROM)
    work = staging_dir(spark)
    save_model(result.model, f"{work}/model")
    again = load_model(f"{work}/model", WIDE_ORDERS)
    rows.repartition(FILES).write.parquet(f"{work}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{work}/in")
    keep = ["o_orderkey"]
    scored = score(stream, {"orders": again}, keep)
    write_stream(scored, f"{work}/progress", "parquet", f"{work}/out", every=None).awaitTermination()
    streamed = spark.read.schema(scored.schema).parquet(f"{work}/out").select(*keep, "risk", "probability")
    both = risk_profile(rows, {"before": result.model, "after": again}, keep, pivot=True)
    p = F.col("before.probability")
    total = F.aggregate(p, F.lit(0.0), lambda total, one: total + one)
    sound = (F.size(p) == 3) & (F.abs(total - 1) < 1e-9) & F.col("before.error").isNull()
    # what the models say is compared here, so that one's results go into the join, and not both
    told = both.select(
        *keep, sound.alias("sound"), (F.col("before") == F.col("after")).alias("same"), p.alias("p"), "before.risk"
    ).withColumnRenamed("risk", "told")
    return told.join(streamed, keep).agg(
        F.count("*").alias("n_rows"),
        F.count_if("sound").alias("n_sound"),
        F.count_if("same").alias("n_reloaded"),
        F.count_if((F.col("p") == F.col("probability")) & (F.col("told") == F.col("risk"))).alias("n_streamed"),
    )


# --- training and evaluation ---------------------------------------------------------------------


@query
def hash_split_counts(spark, sf_dir):
    flag = train_flag(["o_orderkey"])
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderstatus", flag.alias("is_train"))
        .agg(F.count("*").alias("n_rows"))
    )


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").selectExpr(
        "doc_id", "double(quality) AS label", "double(1 - toxic) AS prediction"
    )


@query
def confusion_counts(spark, sf_dir):
    return confusion(_judged(spark, sf_dir))


@query
def metrics_of_labels(spark, sf_dir):
    return _rounded_metrics(classification_metrics(confusion(_judged(spark, sf_dir))))


@query
def metrics_of_many_classes(spark, sf_dir):
    judged = table(spark, sf_dir, "lineitem").selectExpr(
        "double(l_linenumber) AS label", "double(l_linenumber % 5 + l_suppkey % 2) AS prediction"
    )
    return _rounded_metrics(classification_metrics(confusion(judged)))


def _rounded_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        *[F.round(n, 9).alias(n) for n in ("accuracy", "precision", "recall", "f1_score")],
        "n_rows",
    )


@query
def evaluation_by_parts(spark, sf_dir):
    """The report of two judges of orders, evaluated in four parts each, one of them twice."""
    root = staging_dir(spark)
    for name, key in (("by_customer", "o_custkey"), ("by_order", "o_orderkey")):
        judged = table(spark, sf_dir, "orders").selectExpr(
            "o_orderkey % 4 AS part",
            "double(locate(o_orderstatus, 'FOP') - 1) AS label",
            f"double({key} % 3) AS prediction",
        )
        for part in (0, 1, 2, 3, 1):
            some = judged.filter(F.col("part") == part)
            add_evaluation(some, root, name, f"part-{part}", train_rows=10 + part)
    return evaluation_of_parts(spark, root).select(
        "disease",
        *[F.round(n, 9).alias(n) for n in ("accuracy", "precision", "recall", "f1_score")],
        "train_rows",
        "test_rows",
    )


@query
def trained_side_by_side(spark, sf_dir):
    """Orders and lines trained at once: rows of both parts, and whether the report, the kept counts,
    the saved models and the probabilities of the predictions agree with each other."""
    work = staging_dir(spark)
    specs = {"orders": ORDERS, "lines": LINES}
    keys = {"orders": "string(o_orderkey)", "lines": "l_orderkey || '-' || l_linenumber"}
    for name, source in (("orders", "orders"), ("lines", "lineitem")):
        rows = table(spark, sf_dir, source).selectExpr(*specs[name].columns, f"{keys[name]} AS row_key")
        write_table(rows, f"{work}/{name}")
    results = train_all(
        spark,
        specs,
        work,
        f"{work}/models",
        f"{work}/report",
        classifier=_small(),
        split_key=["row_key"],
        evaluations=f"{work}/kept",
    )
    written = read_raw(spark, f"{work}/report", schema=evaluation_report(spark, results).schema)
    kept = evaluation_of_parts(spark, f"{work}/kept")
    checks = []
    for name, result in results.items():
        again = load_model(f"{work}/models/{name}", specs[name])
        first = class_probability(F.col("probability"), 0)
        rows = again.predict(result.predictions.drop("rawPrediction", "probability", "prediction"))
        sums = [
            r.agg(F.round(F.sum(first), 6), F.count_if(F.col("prediction") == F.col("label"))).first()
            for r in (rows, result.predictions)
        ]
        checks.append((name, tuple(sums[0]) == tuple(sums[1]), sums[0][1]))
    told = spark.createDataFrame(checks, "disease string, same_when_loaded boolean, hits long")
    close = F.lit(True)
    for metric in ("accuracy", "precision", "recall", "f1_score"):
        close &= F.abs(F.col(f"w.{metric}") - F.col(f"k.{metric}")) < 1e-12
    return (
        written.alias("w")
        .join(kept.alias("k"), "disease")
        .join(told, "disease")
        .select(
            "disease",
            "w.train_rows",
            "w.test_rows",
            (close & (F.col("w.test_rows") == F.col("k.test_rows"))).alias("same_when_kept"),
            "same_when_loaded",
            (F.abs(F.col("hits") / F.col("w.test_rows") - F.col("w.accuracy")) < 1e-9).alias("accuracy_counted"),
        )
    )


_TRAINED: dict[tuple[str, str], dict[str, TrainResult]] = {}


def trained(spark: SparkSession, sf_dir: str) -> dict[str, TrainResult]:
    """The four models, trained once per application and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        records = stage(patients(spark, sf_dir))
        tasks = {
            name: partial(train, training_rows(records, name), spec) for name, spec in SPECS.items()
        }
        _TRAINED[key], failures = side_by_side(spark, tasks)
        if failures:
            raise ExceptionGroup("not trained", list(failures.values()))
    return _TRAINED[key]


def _models(spark: SparkSession, sf_dir: str) -> dict[str, RiskModel]:
    return {name: result.model for name, result in trained(spark, sf_dir).items()}


_ORDERS: dict[tuple[str, str], TrainResult] = {}


def _on_orders(spark: SparkSession, sf_dir: str) -> TrainResult:
    """A forest on ``orders``, split by the order's key so that SQL knows both parts."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ORDERS:
        rows = table(spark, sf_dir, "orders")
        _ORDERS[key] = train(rows, ORDERS, classifier=_small(), split_key=["o_orderkey"])
    return _ORDERS[key]


def _small():
    return forest(trees=20, depth=6)


@query
def forest_on_orders(spark, sf_dir):
    """Rows of both parts, sound predictions, metrics as the confusion gives them, and whether the
    same table in another number of files gives the same model."""
    result = _on_orders(spark, sf_dir)
    p = vector_to_array("probability")
    sound = (
        (F.abs(F.aggregate(p, F.lit(0.0), lambda total, one: total + one) - 1) < 1e-9)
        & F.forall(p, lambda one: (one >= 0) & (one <= 1))
        & (F.get(p, F.col("prediction").cast("int")) == F.array_max(p))
    )
    counted = result.predictions.agg(
        F.count("*").alias("test_rows"),
        F.count_if(sound).alias("n_sound"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
    )
    again = train(
        table(spark, sf_dir, "orders").repartition(7), ORDERS, classifier=_small(), split_key=["o_orderkey"]
    )
    first = F.round(F.avg(F.get(p, F.lit(0))), 9).alias("first")
    sides = [
        sorted(map(tuple, r.predictions.groupBy("label", "prediction").agg(F.count("*"), first).collect()))
        for r in (result, again)
    ]
    same = sides[0] == sides[1]
    in_range = all(0 <= value <= 1 for value in result.metrics.values())
    agree = F.abs(F.col("accuracy") - result.metrics["accuracy"]) < 1e-12
    return counted.select(
        F.lit(result.train_rows).cast("long").alias("train_rows"),
        "test_rows",
        "n_sound",
        (agree & F.lit(in_range)).alias("metrics_agree"),
        F.lit(same).alias("same_when_dealt_anew"),
    )


@query
def forest_test_labels(spark, sf_dir):
    return _on_orders(spark, sf_dir).predictions.groupBy("label").agg(F.count("*").alias("n_rows"))


@query
def importances_on_orders(spark, sf_dir):
    """The features by name, whether they come in falling order, and the sum of all importances."""
    top = top_features(spark, _on_orders(spark, sf_dir).model)
    rows = [(r["feature"], r["importance"]) for r in top.collect()]
    ordered = rows == sorted(rows, key=lambda r: (-r[1], r[0]))
    total = round(sum(weight for _, weight in rows), 9)
    return top.select("feature", F.lit(ordered).alias("ordered"), F.lit(total).alias("total"))


@query
def schema_check(spark, sf_dir):
    rows = to_double(table(spark, sf_dir, "orders").drop("o_orderpriority"), ORDERS.numeric)
    return validate_schema(rows, ORDERS)


@query
def triggered_stream(spark, sf_dir):
    """Records through a stream that looks every second and is stopped when all are through."""
    work = staging_dir(spark)
    patients(spark, sf_dir).write.json(f"{work}/in")
    stream = read_stream(spark, f"{work}/in", max_files_per_trigger=None)
    running = write_stream(stream, f"{work}/progress", "parquet", f"{work}/out", every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(stream.schema).parquet(f"{work}/out")


@query
def forest_predictions(spark, sf_dir):
    result = trained(spark, sf_dir)["stroke"]
    return result.predictions.select(
        "label", "prediction", class_probability(F.col("probability"), 1).alias("p1")
    )


@query
def most_important_features(spark, sf_dir):
    result = trained(spark, sf_dir)["stroke"]
    return top_features(spark, result.model)


@query
def evaluation_of_all(spark, sf_dir):
    return evaluation_report(spark, trained(spark, sf_dir))


@query
def model_round_trip(spark, sf_dir):
    """How many predictions a saved and reloaded model repeats."""
    model = _models(spark, sf_dir)["lungcancer"]
    path = f"{staging_dir(spark)}/model"
    save_model(model, path)
    again = load_model(path, model.spec)
    records = stage(patients(spark, sf_dir))
    both = risk_profile(records, {"before": model, "after": again}, pivot=True)
    return both.agg(
        F.count("*").alias("n_rows"), F.expr("count_if(before = after)").alias("n_identical")
    )


# --- scoring -------------------------------------------------------------------------------------


@query
def risk_bands(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", risk_band(F.col("value") / 100).alias("risk")
    )


@query
def risk_from_labels(spark, sf_dir):
    labels = ["Low", "High", "Medium"]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        risk_from_label((F.col("o_custkey") % 4).cast("double"), labels).alias("risk"),
    )


@query
def rename_stroke(spark, sf_dir):
    return project_for(patients(spark, sf_dir), SPECS["stroke"])


@query
def rename_lung(spark, sf_dir):
    return project_for(patients(spark, sf_dir), SPECS["lungcancer"])


@query
def score_validity(spark, sf_dir):
    records = gappy_patients(spark, sf_dir)
    rows = None
    for name, spec in SPECS.items():
        one = score_errors(records, spec).withColumn("dataset", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows.select("patient_id", "timestamp", "dataset", "error")


@query
def zero_filled_inputs(spark, sf_dir):
    """Missing measurements scored as zero, the alternative to an error."""
    return project_for(gappy_patients(spark, sf_dir), SPECS["stroke"], missing="zero")


@query
def batch_scores(spark, sf_dir):
    return score(gappy_patients(spark, sf_dir), _models(spark, sf_dir))


@query
def risk_profiles(spark, sf_dir):
    profiles = risk_profile(gappy_patients(spark, sf_dir), _models(spark, sf_dir), pivot=True)
    return profiles.select(
        "patient_id",
        "timestamp",
        *[
            F.col(f"{name}.{part}").alias(f"{name}_{part}")
            for name in SPECS
            for part in ("risk", "probability", "error")
        ],
    )


@query
def score_invariants(spark, sf_dir):
    """Per dataset: rows, errors, and how many results are sound.

    Sound is: probabilities of all classes, in range, summing to one, and the risk they imply.
    """
    models = _models(spark, sf_dir)
    scores = score(gappy_patients(spark, sf_dir), models)
    p = F.col("probability")
    total = F.aggregate(p, F.lit(0.0), lambda total, one: total + one)
    classes = {n: len(m.labels) if m.labels else 2 for n, m in models.items()}
    size = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])[F.col("dataset")]
    labels = models["lungcancer"].labels
    # the rules of the risk, written out: by the likeliest class's name, or by the second probability
    likeliest = F.array(*[F.lit(label) for label in labels])[
        (F.array_position(p, F.array_max(p)) - 1).cast("int")
    ]
    named = F.when(likeliest == "High", "HIGH").when(likeliest == "Medium", "MEDIUM").otherwise("LOW")
    second = F.get(p, F.lit(1))
    banded = F.when(second > 0.6, "HIGH").when(second > 0.3, "MEDIUM").otherwise("LOW")
    implied = F.when(F.col("dataset") == "lungcancer", named).otherwise(banded)
    sound = (
        (F.size(p) == size)
        & (F.abs(total - 1) < 1e-9)
        & F.forall(p, lambda one: (one >= 0) & (one <= 1))
        & (F.col("risk") == implied)
    )
    return scores.groupBy("dataset").agg(
        F.count("*").alias("n_rows"),
        F.count("error").alias("n_errors"),
        F.count_if(sound).alias("n_sound"),
    )


def _streamed(spark: SparkSession, sf_dir: str, gappy: DataFrame) -> DataFrame:
    work = staging_dir(spark)
    # NaN is no JSON number, so the records keep their other gaps only.
    records = gappy.withColumn("avg_glucose_level", F.expr("nanvl(avg_glucose_level, NULL)"))
    records.write.json(f"{work}/in")
    start_scoring(
        spark,
        f"{work}/in",
        _models(spark, sf_dir),
        f"{work}/progress",
        sink="parquet",
        output_path=f"{work}/out",
        every=None,
        max_files_per_trigger=4,
    ).awaitTermination()
    schema = "patient_id string, timestamp string, dataset string, risk string, "
    return spark.read.schema(schema + "probability array<double>, error string").parquet(
        f"{work}/out"
    )


@query
def stream_scores(spark, sf_dir):
    return _streamed(spark, sf_dir, gappy_patients(spark, sf_dir))


@query
def stream_matches_batch(spark, sf_dir):
    """Per dataset: streamed rows, and how many of them the batch path gives as well."""
    gappy = gappy_patients(spark, sf_dir)
    streamed = _streamed(spark, sf_dir, gappy).withColumn("side", F.lit(1))
    batch = score(gappy, _models(spark, sf_dir)).withColumn("side", F.lit(-1))
    same = (
        streamed.unionByName(batch)
        .groupBy("patient_id", "timestamp", "dataset", "risk", "probability", "error")
        .agg(F.sum("side").alias("surplus"), F.expr("count_if(side = 1)").alias("streamed"))
    )
    return same.groupBy("dataset").agg(
        F.sum("streamed").alias("n_rows"),
        F.sum(F.when(F.col("surplus") == 0, F.col("streamed")).otherwise(0)).alias("n_equal"),
    )

