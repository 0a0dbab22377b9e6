import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import classification, scorecard
from tidemark.plans import queries
from tidemark.sources.alert_log import read_alerts
from tidemark.streaming import outcomes, performance, scoring, sources

START = dt.datetime(2024, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


def write_files(df, path, n):
    """One file per slice, in time order, so that the stream sees several batches."""
    for i, part in enumerate(df.collect()[k::n] for k in range(n)):
        df.sparkSession.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(path)


def test_scores_match_the_batch_and_are_written_once(spark, tmp_path):
    people = spark.range(200).selectExpr(
        "concat('C', id) customer_id", "int(id % 72) tenure_months", "double(id) monthly_charges",
        "'One year' contract_type", "'Credit card' payment_method", "'DSL' internet_service",
    )
    write_files(people, f"{tmp_path}/people.parquet", 3)
    schema = "customer_id string, tenure_months int, monthly_charges double, contract_type string, payment_method string, internet_service string"
    scorer = lambda d: scorecard.score(d).select("customer_id", "churn_probability")
    for _ in range(2):  # the second run finds nothing new
        stream = sources.table_stream(spark, str(tmp_path), "people", schema, files_per_batch=1)
        scoring.score_stream(stream, scorer, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, scorer(people).collect()))


def test_outcomes_attach_within_the_bound(spark, tmp_path):
    predictions = [(f"P{i}", at(i)) for i in range(48)] + [("END", at(500))]
    decided = [("P0", 1, at(2)), ("P1", 0, at(30)), ("P2", 1, at(2 + 24)), ("P3", 1, at(1)), ("NONE", 1, at(5)), ("END", 0, at(501))]
    spark.createDataFrame(predictions, "prediction_id string, prediction_timestamp timestamp").coalesce(1).write.parquet(f"{tmp_path}/p.parquet")
    spark.createDataFrame(decided, "prediction_id string, actual_outcome int, outcome_timestamp timestamp").coalesce(1).write.parquet(f"{tmp_path}/o.parquet")
    p = sources.table_stream(spark, str(tmp_path), "p", "prediction_id string, prediction_timestamp timestamp")
    o = sources.table_stream(spark, str(tmp_path), "o", "prediction_id string, actual_outcome int, outcome_timestamp timestamp")
    attached = outcomes.attach_outcomes(p, o, within="1 day", delay="1 hour")
    outcomes.write_attached(attached, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(120)
    rows = spark.read.parquet(f"{tmp_path}/out")
    got = {r.prediction_id: r.actual_outcome for r in rows.collect()}
    # P1 came too late and P3 before its prediction; both are emitted without an outcome
    assert {k: v for k, v in got.items() if v is not None} == {"P0": 1, "P2": 1, "END": 0}
    assert got["P1"] is None and got["P3"] is None and len(got) == 49
    late = outcomes.late_outcomes(spark.read.parquet(f"{tmp_path}/o.parquet"), rows)
    assert sorted(r.prediction_id for r in late.collect()) == ["NONE", "P1", "P3"]


def test_the_sink_holds_the_latest_outcome_of_each_prediction(spark, tmp_path):
    """Outcomes of one prediction come in several batches, out of order and twice; the stream itself keeps the latest."""
    predictions = [(f"P{i}", f"C{i}", at(i)) for i in range(30)] + [("OPEN", "C", at(499)), ("END", "C", at(500))]
    decided = [("P0", 1, at(2)), ("P0", 0, at(5)), ("P0", 1, at(4)), ("P1", 1, at(30)), ("P2", 0, at(3)), ("P2", 1, at(3)), ("P3", 1, at(1))]
    decided += [("P4", 1, at(6)), ("P4", 1, at(6)), ("OPEN", 1, at(499.5)), ("END", 0, at(501)), ("NONE", 1, at(5))]
    p_schema, o_schema = "prediction_id string, customer_id string, prediction_timestamp timestamp", "prediction_id string, actual_outcome int, outcome_timestamp timestamp"
    write_files(spark.createDataFrame(predictions, p_schema), f"{tmp_path}/p.parquet", 1)
    write_files(spark.createDataFrame(decided, o_schema), f"{tmp_path}/o.parquet", 4)
    p = sources.table_stream(spark, str(tmp_path), "p", p_schema)
    o = sources.table_stream(spark, str(tmp_path), "o", o_schema, files_per_batch=1)
    for _ in range(2):  # the second run finds nothing new
        latest = outcomes.latest_outcomes(p, o, within="1 day", delay="300 hours")
        outcomes.write_attached(latest, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(120)
    rows = spark.read.parquet(f"{tmp_path}/out")
    got = {r.prediction_id: (r.customer_id, r.actual_outcome, r.outcome_timestamp) for r in rows.collect()}
    assert rows.count() == len(got) == 30  # OPEN and END are not over
    expected = {"P0": (0, at(5)), "P2": (1, at(3)), "P4": (1, at(6))}
    assert got == {f"P{i}": (f"C{i}", *expected.get(f"P{i}", (None, None))) for i in range(30)}
    lost = outcomes.outcomes_out_of_time(spark.read.parquet(f"{tmp_path}/o.parquet"), rows, within="1 day")
    assert sorted((r.prediction_id, r.outcome_timestamp) for r in lost.collect()) == [("P1", at(30)), ("P3", at(1))]


def test_a_prediction_with_two_outcomes_gets_the_latest(spark):
    rows = [("A", 1, at(1)), ("A", 0, at(2)), ("B", None, None)]
    attached = spark.createDataFrame(rows, "prediction_id string, actual_outcome int, outcome_timestamp timestamp")
    got = sorted(map(tuple, outcomes.latest_attached(attached).collect()))
    assert got == [("A", 0, at(2)), ("B", None, None)]


def test_both_halves_of_the_stream_are_returned(spark):
    """Fails where predictions closed without an outcome are dropped."""
    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    rows = queries.QUERIES["streamed_outcomes_whole"](spark, sf).collect()
    assert {r.actual_outcome is None for r in rows} == {True, False}
    assert len({r.prediction_id for r in rows}) == len(rows)


def test_daily_checks_and_alerts(spark, tmp_path):
    rows = []
    for day, (hits, misses) in enumerate([(9, 1), (3, 7), (10, 0)]):
        rows += [("v1", 1, int(i < hits), at(24 * day + i % 24)) for i in range(hits + misses)]
    rows.append(("v1", 0, 0, at(24 * 4)))  # closes the days before it
    schema = "model_version string, actual_outcome int, predicted_class int, outcome_timestamp timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/o.parquet")
    stream = sources.table_stream(spark, str(tmp_path), "o", schema)
    performance.watch_performance(stream, f"{tmp_path}/e", f"{tmp_path}/a", f"{tmp_path}/ck").awaitTermination(120)
    days = {r.period_start: r.recall for r in spark.read.parquet(f"{tmp_path}/e").where("n_samples > 0").collect()}
    assert days == {at(0): 0.9, at(24): pytest.approx(0.3), at(48): 1.0}
    alerts = read_alerts(spark, f"{tmp_path}/a").collect()
    assert [(a.model_version, a.timestamp) for a in alerts] == [("v1", at(48))]


def test_windows_have_an_exact_auc(spark, tmp_path):
    """Ties, rows without a score and windows of one class, over several batches; as an evaluation of all rows has it."""
    rows = [("v1" if i % 4 else "v2", i * 7 % 5 % 2, i % 2, [None, float("nan"), 0.1, 0.1, 0.9, 0.4][i * 5 % 6], at(24 * (i % 3) + i % 20)) for i in range(150)]
    rows += [("v3", 1, 1, 0.5, at(3)), ("v1", 0, 0, 0.5, at(24 * 20))]
    schema = "model_version string, actual_outcome int, predicted_class int, prediction double, outcome_timestamp timestamp"
    df = spark.createDataFrame(rows, schema)
    write_files(df, f"{tmp_path}/o.parquet", 3)
    stream = sources.table_stream(spark, str(tmp_path), "o", schema, files_per_batch=1)
    performance.watch_performance(stream, f"{tmp_path}/e", f"{tmp_path}/a", f"{tmp_path}/ck", delay="200 hours").awaitTermination(300)
    got = {(r.model_version, r.period_start): (r.tp, r.n_samples, r.n_unscored, round(r.roc_auc, 9)) for r in spark.read.parquet(f"{tmp_path}/e").collect()}
    days = df.where(F.col("outcome_timestamp") < F.lit(at(72))).withColumn("day", F.date_trunc("day", "outcome_timestamp"))
    batch = classification.evaluate(days, "actual_outcome", "prediction", "predicted_class", ["model_version", "day"]).collect()
    assert len(got) == len(batch) == 7 and any(r.n_unscored for r in batch)
    for r in batch:
        assert got[r.model_version, r.day] == (r.tp, r.n_samples, r.n_unscored, round(r.roc_auc, 9))


def test_a_single_file_is_a_stream_too(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/raw")
    part = next((tmp_path / "raw").glob("part-*.parquet"))
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.parquet").write_bytes(part.read_bytes())
    (tmp_path / "t" / "y.parquet").write_bytes(part.read_bytes())
    stream = sources.table_stream(spark, str(tmp_path / "t"), "x", "id bigint")
    query = stream.writeStream.format("memory").queryName("single_file").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/ck").start()
    query.awaitTermination(60)
    assert spark.table("single_file").agg(F.count("*")).first()[0] == 5
