"""Sinks that are written once, and records that do not parse."""

import json

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from riskpipe.operators import project_for
from riskpipe.sources import read_stream
from riskpipe.spec import SPECS
from riskpipe.streaming import (
    batch_table,
    broken_records,
    fan_out,
    once,
    sound_records,
    with_quarantine,
    write_stream,
)
from riskpipe.streaming.quarantine import CORRUPT, NOT_JSON, NOT_OBJECT, WRONG_TYPE
from verification import queries, tables


def stream_of(spark, tmp_path, n_files=4, n_rows=5):
    for i in range(n_files):
        spark.range(i * n_rows, (i + 1) * n_rows).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    return spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))


def test_a_batch_that_is_run_again_is_in_no_sink_twice(spark, tmp_path):
    """The second sink fails once, in the middle of the stream; the batch is then run again."""
    stream = stream_of(spark, tmp_path)
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    failing = [2]

    def appended(batch, batch_id):
        batch.write.mode("append").parquet(first)

    def fragile(batch, batch_id):
        batch_table(second)(batch, batch_id)  # written, and then the driver dies
        if batch_id in failing:
            failing.remove(batch_id)
            raise RuntimeError("lost")

    sink = fan_out(appended, fragile, progress=str(tmp_path / "sinks"))

    def run():
        write_stream(stream, str(tmp_path / "progress"), sink, every=None).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    assert spark.read.parquet(first).count() == 15
    run()
    for path in (first, second):
        assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(20))


def test_without_progress_every_sink_sees_a_batch_again(spark):
    seen = []
    sink = fan_out(lambda batch, i: seen.append(("a", i)), lambda batch, i: seen.append(("b", i)))
    for _ in range(2):
        sink(spark.range(3), 7)
    assert seen == [("a", 7), ("b", 7)] * 2


def test_a_finished_batch_is_skipped_and_a_failed_one_is_not(spark, tmp_path):
    calls = []

    def sink(batch, batch_id):
        calls.append(batch_id)
        if calls.count(batch_id) == 1 and batch_id == 1:
            raise ValueError("once")

    write = once(sink, str(tmp_path / "marks"))
    write(spark.range(1), 0)
    write(spark.range(1), 0)
    with pytest.raises(ValueError):
        write(spark.range(1), 1)
    write(spark.range(1), 1)
    write(spark.range(1), 1)
    assert calls == [0, 1, 1]


def test_a_batch_table_replaces_a_batch(spark, tmp_path):
    write = batch_table(str(tmp_path / "t"))
    for rows, batch_id in ((3, 0), (5, 1), (4, 0)):
        write(spark.range(rows), batch_id)
    counts = spark.read.parquet(str(tmp_path / "t")).groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in counts} == {0: 4, 1: 5}


LINES = {
    "good": json.dumps({"patient_id": "P1", "timestamp": "t", "BMI": 20.5, "gender": "Male"}),
    "sparse": "{}",
    "number as category": json.dumps({"patient_id": "P2", "gender": 7}),
    "cut": '{"patient_id": "P3", "BMI": 2',
    "text": '"P4"',
    "number": "17",
    "words": json.dumps({"patient_id": "P5", "BMI": "high", "Age": True, "Sex": 1}),
    "nested": json.dumps({"patient_id": "P6", "BMI": {"value": 3}}),
    "null": json.dumps({"patient_id": "P7", "BMI": None}),
}


def test_broken_records_are_listed_with_file_and_reason(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i, line in enumerate(LINES.values()):
        (source / f"{i}.json").write_text(line + "\n")
    stream = read_stream(spark, str(source), max_files_per_trigger=4, corrupt=CORRUPT)
    sound, broken = str(tmp_path / "sound"), str(tmp_path / "broken")
    write = with_quarantine(
        lambda rows: project_for(rows, SPECS["stroke"], keep=["patient_id"]), batch_table(sound), batch_table(broken)
    )
    write_stream(stream, str(tmp_path / "progress"), write, every=None).awaitTermination()
    listed = {r["record"]: (r["reason"], r["file"].rsplit("/", 1)[1]) for r in spark.read.parquet(broken).collect()}
    place = {name: f"{i}.json" for i, name in enumerate(LINES)}
    assert listed == {
        LINES["cut"]: (NOT_JSON, place["cut"]),
        LINES["text"]: (NOT_OBJECT, place["text"]),
        LINES["number"]: (NOT_OBJECT, place["number"]),
        LINES["words"]: (WRONG_TYPE + "BMI, Age", place["words"]),
        LINES["nested"]: (WRONG_TYPE + "BMI", place["nested"]),
    }
    kept = sorted(str(r["patient_id"]) for r in spark.read.parquet(sound).collect())
    assert kept == ["None", "P1", "P2", "P7"]


def test_a_broken_record_is_parsed_once_for_all_its_fields(spark):
    batch = spark.createDataFrame([(LINES["words"], "f")], f"{CORRUPT} string, file string")
    broken = broken_records(batch)
    assert [r["reason"] for r in broken.collect()] == [WRONG_TYPE + "BMI, Age"]
    plan = broken._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1


def test_records_are_made_by_as_many_tasks_as_their_number_needs(spark, tmp_path, monkeypatch):
    spark.sql("SELECT explode(array(1L, 2L, 2L, NULL, NULL, 7L, 8L, 9L)) AS c_custkey").coalesce(1).write.parquet(
        str(tmp_path / "customer.parquet")
    )
    whole = sorted(map(str, tables.patients(spark, str(tmp_path)).collect()))
    assert len(whole) == 8
    monkeypatch.setattr(tables, "TASK_RECORDS", 2, raising=False)
    dealt = tables.patients(spark, str(tmp_path))
    assert dealt.rdd.getNumPartitions() == 4
    assert sorted(map(str, dealt.collect())) == whole


def test_a_batch_without_broken_records_lists_nothing(spark, tmp_path):
    wider = StructType([StructField("patient_id", StringType()), StructField(CORRUPT, StringType()), StructField("file", StringType())])
    seen = []
    write = with_quarantine(
        lambda rows: rows, lambda b, i: seen.append(b.collect()), lambda b, i: seen.append("never")
    )
    batch = spark.createDataFrame([("P", None, "f")], wider)
    write(batch, 0)
    assert [[tuple(r) for r in b] for b in seen] == [[("P",)]]
    assert sound_records(batch).columns == ["patient_id"] and broken_records(batch).count() == 0


def test_the_stream_of_wide_category_scores_has_work_for_many_tasks(spark, tmp_path, monkeypatch):
    rows = [(i, i % 40, "FOP"[i % 3], float(i * 37 % 1000), f"{i % 5}-X") for i in range(400)]
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "sf" / "orders.parquet"))
    monkeypatch.setattr(queries, "staging_dir", lambda spark: str(tmp_path / "work"))
    counts = queries.wide_category_scores(spark, str(tmp_path / "sf")).first()
    assert tuple(counts) == (400, 400, 400, 400)
    assert len(list((tmp_path / "work" / "in").glob("part-*"))) > 12  # cores of the cluster
