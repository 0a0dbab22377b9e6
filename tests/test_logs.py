import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.errors import TableCheckError
from tidemark.operators import alerts, outcomes
from tidemark.sources import alert_log, commits, customers
from tidemark.sources import prediction_log as pl


def at_ten():
    return F.to_timestamp(F.lit("2024-03-01 10:00:00"))
SCHEMA = "customer_id string, model_version string, prediction double, predicted_class int, actual_outcome int"
ROWS = [("1", "v1", 0.75, 1, 1), ("2", "v1", 0.25, 0, 0), ("3", "v1", 0.60, 1, None), ("4", "v2", 0.80, 1, 1)]


def later(hours):
    return F.to_timestamp(F.lit(f"2024-03-01 {10 + hours}:00:00"))


@pytest.fixture
def log(spark, tmp_path):
    store = pl.PredictionLog(spark, str(tmp_path / "log"))
    store.append(spark.createDataFrame(ROWS, SCHEMA), at_ten())
    return store


def test_statistics(spark, log):
    row = outcomes.log_statistics(log.current()).first()
    assert (row.total_predictions, row.predictions_with_outcomes, row.predictions_without_outcomes, row.accuracy) == (4, 3, 1, 1.0)
    empty = outcomes.log_statistics(pl.PredictionLog(spark, "/tmp/no-such-log").current()).first()
    assert empty.total_predictions == 0 and empty.accuracy is None


def test_rows(log):
    rows = {r.customer_id: r for r in log.current().collect()}
    assert rows["1"].prediction_id.startswith("PRED_1_v1_20240301_100000_000000_")
    assert rows["1"].outcome_timestamp is not None and rows["3"].outcome_timestamp is None
    assert rows["1"].features == "{}" and rows["1"].prediction_date == dt.date(2024, 3, 1)


def test_a_batch_written_twice_is_logged_once(spark, log):
    again = spark.createDataFrame(ROWS, SCHEMA)
    log.append(again, at_ten())
    log.append(again.union(again), later(1))
    assert log.predictions().count() == 8


def test_every_row_of_a_batch_is_logged_or_reported(spark, log):
    batch = [("5", "v1", 0.2, 0, None), ("5", "v1", 0.3, 0, None), ("5", "v1", 0.3, 0, None), ("6", "v1", 2.0, 1, None)]
    held = log.append(spark.createDataFrame([*batch, ROWS[0]], SCHEMA), at_ten(), on_problem="quarantine")
    assert log.predictions().where("customer_id = '5'").count() == 2
    assert sorted((r.customer_id, r.problems[0]) for r in held.collect()) == [
        ("1", "already in the log"),
        ("5", "the batch has another row with this id"),
        ("6", "prediction must be between 0 and 1"),
    ]
    given = spark.createDataFrame([("X", "7", "v1", 0.1, 0), ("X", "8", "v1", 0.9, 1)], "prediction_id string, customer_id string, model_version string, prediction double, predicted_class int")
    held = log.append(given, later(1))
    assert [r.customer_id for r in held.collect()] == ["8"] and log.predictions().where("prediction_id = 'X'").count() == 1


def test_values_outside_the_domain(spark, log):
    bad = spark.createDataFrame([("9", "v1", 1.5, 1, None), ("8", "v1", 0.5, 2, None), ("7", "v1", 0.5, 1, None)], SCHEMA)
    with pytest.raises(TableCheckError, match="between 0 and 1|0 or 1"):
        log.append(bad, at_ten())
    assert log.predictions().count() == 4
    assert log.append(bad, at_ten(), on_problem="quarantine").count() == 2
    assert log.predictions().count() == 5


def test_outcomes_arrive_later(spark, log):
    missing = outcomes.retrieve(log.current(), has_outcome=False).collect()
    assert [r.customer_id for r in missing] == ["3"]
    assert log.record_outcome(missing[0].prediction_id, 0, later(1))
    assert log.record_outcome(missing[0].prediction_id, 1, later(2))
    assert not log.record_outcome("PRED_nobody", 1)
    with pytest.raises(ValueError, match="0 or 1"):
        log.record_outcome(missing[0].prediction_id, 2)
    row = outcomes.retrieve(log.current(), customer_id="3").first()
    assert row.actual_outcome == 1 and row.outcome_timestamp.hour == 12
    assert outcomes.log_statistics(log.current()).first().accuracy == 1.0


def test_unknown_outcomes_are_reported(spark, log):
    events = spark.createDataFrame([("X", 1, "2024-03-02 00:00:00")], "prediction_id string, actual_outcome int, t string")
    log.append_outcomes(events.withColumn("outcome_timestamp", F.to_timestamp("t")))
    assert [r.prediction_id for r in log.unknown_outcomes().collect()] == ["X"]
    with pytest.raises(TableCheckError, match="0 or 1"):
        log.append_outcomes(events.withColumn("actual_outcome", F.lit(5)).withColumn("outcome_timestamp", F.to_timestamp("t")))


def test_a_killed_write_is_not_seen_and_can_be_repeated(spark, log, monkeypatch):
    batch = spark.createDataFrame([("9", "v1", 0.5, 1, None)], SCHEMA)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(commits.Commits, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            log.append(batch, later(1))
        with pytest.raises(KeyboardInterrupt):
            log.append_outcomes(spark.createDataFrame([("X", 1)], "prediction_id string, actual_outcome int").withColumn("outcome_timestamp", later(1)))
        with pytest.raises(KeyboardInterrupt):
            log.compact(f"{log.commits.root}-compact")
    assert log.predictions().count() == 4 and log.outcomes().isEmpty()
    assert pl.PredictionLog(spark, f"{log.commits.root}-compact").predictions().isEmpty()
    assert log.append(batch, later(1)).isEmpty() and log.predictions().count() == 5
    assert log.compact(f"{log.commits.root}-compact").predictions().count() == 5
    with pytest.raises(FileExistsError):
        log.compact(f"{log.commits.root}-compact")


def test_two_appends_at_once_log_an_id_once(spark, log):
    """Both have looked at the log before either commits."""
    batch = spark.createDataFrame([("9", "v1", 0.5, 1, None), ("8", "v1", 0.5, 1, None)], SCHEMA)
    gate, held = threading.Barrier(2), []

    def append(rows):
        store = pl.PredictionLog(spark, log.commits.root)
        write = store.commits.write

        def waiting(*args):
            name = write(*args)
            store.commits.write = write  # the one that loses comes back alone
            gate.wait(100)
            return name

        store.commits.write = waiting
        held.append(store.append(rows, later(2)).count())

    threads = [threading.Thread(target=append, args=(b,)) for b in (batch, batch.union(spark.createDataFrame(ROWS[:1], SCHEMA)))]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert sorted(held) == [0, 2]
    ids = [r.prediction_id for r in log.predictions().collect()]
    assert len(ids) == len(set(ids)) == 4 + 3


def test_commits_do_not_replace_each_other(spark, tmp_path):
    c = commits.Commits(spark, str(tmp_path / "c"))
    assert c.current() == (0, {})
    c.commit(0, {"t": ["a"]})
    with pytest.raises(commits.Conflict):
        c.commit(0, {"t": ["b"]})
    c.add(t=["d"], u=["e"])
    assert c.current() == (2, {"t": ["a", "d"], "u": ["e"]})
    assert sorted(p.name for p in (tmp_path / "c" / "_commits").iterdir() if not p.name.startswith(".")) == ["000000000001", "000000000002"]


def test_outcomes_of_a_day_are_read_from_the_files_of_the_day(spark, tmp_path):
    store = pl.PredictionLog(spark, str(tmp_path / "log"))
    for day in (1, 2, 3):
        store.append(spark.createDataFrame([(str(day), "v1", 0.5, 1, None)], SCHEMA), F.to_timestamp(F.lit(f"2024-03-0{day} 10:00:00")))
    ids = {r.customer_id: r.prediction_id for r in store.predictions().collect()}
    events = [(ids["1"], 1), (ids["2"], 0), (ids["3"], 1), ("waits", 1)]
    store.append_outcomes(spark.createDataFrame(events, "prediction_id string, actual_outcome int").withColumn("outcome_timestamp", F.to_timestamp(F.lit("2024-04-01"))))
    day = store.current(first_day="2024-03-02", last_day="2024-03-02")
    assert [(r.customer_id, r.actual_outcome) for r in day.collect()] == [("2", 0)]
    assert [r.customer_id for r in store.current(first_day="2024-03-02").orderBy("customer_id").collect()] == ["2", "3"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("prediction_date" in line[line.index("PartitionFilters") : line.index("PushedFilters")] for line in scans)
    late = spark.createDataFrame([("w", "waits", "v1", 0.5, 1, None)], "customer_id string, prediction_id string, model_version string, prediction double, predicted_class int, actual_outcome int")
    store.append(late, F.to_timestamp(F.lit("2024-03-02 11:00:00")))
    assert {r.customer_id: r.actual_outcome for r in store.current("2024-03-02", "2024-03-02").collect()} == {"2": 0, "w": 1}


def test_newest_rows_read_the_newest_days(spark, tmp_path, monkeypatch):
    store = pl.PredictionLog(spark, str(tmp_path / "log"))
    batch = spark.createDataFrame([(str(i), "v1" if i % 9 else "v2", 0.5, 1, None, i) for i in range(40)], SCHEMA + ", n int")
    store.append(batch, F.to_timestamp(F.lit("2024-03-01 10:00:00")) + F.make_dt_interval(F.col("n") % 10))
    assert store.days()[0] == "2024-03-10" and len(store.days()) == 10
    read, current = [], store.current
    monkeypatch.setattr(store, "current", lambda **k: read.append(k.get("first_day")) or current(**k))
    same = lambda n, **k: [r.prediction_id for r in store.newest(n, **k).collect()] == [
        r.prediction_id for r in outcomes.retrieve(current(), limit=n, **k).collect()
    ]
    assert same(3) and read == ["2024-03-10"]
    read.clear()
    assert same(7) and read == ["2024-03-10", "2024-03-09"]
    read.clear()
    assert same(4, model_version="v2") and read[-1] is not None
    assert same(1000) and same(2, customer_id="nobody")
    assert pl.PredictionLog(spark, str(tmp_path / "none")).newest(5).isEmpty()


def test_retrieval(spark, log):
    log.append(spark.createDataFrame(ROWS[:2], SCHEMA), later(3))
    get = lambda **k: [r.customer_id for r in outcomes.retrieve(log.current(), **k).collect()]
    assert get(customer_id="1") == ["1", "1"]
    assert get(model_version="v2") == ["4"]
    assert get(limit=2) == ["1", "2"]
    assert len(get(start=dt.datetime(2024, 3, 1, 10), end=dt.datetime(2024, 3, 1, 10))) == 4
    assert get(start=dt.datetime(2024, 3, 1, 12), has_outcome=True) == ["1", "2"]
    assert get(customer_id="nobody") == []


def test_date_bounds_prune_partitions(log):
    found = outcomes.retrieve(log.predictions(), start=dt.datetime(2024, 3, 2), model_version="v1")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "prediction_date" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "EqualTo(model_version,v1)" in plan


def test_compaction(spark, log, tmp_path):
    log.record_outcome(log.current().where("customer_id = '3'").first().prediction_id, 0, later(1))
    compact = log.compact(str(tmp_path / "compact"))
    same = lambda d: sorted(map(str, d.collect()))
    assert same(compact.predictions()) == same(log.current()) and compact.outcomes().isEmpty()
    early = spark.createDataFrame([("not logged yet", 1)], "prediction_id string, actual_outcome int")
    log.append_outcomes(early.withColumn("outcome_timestamp", later(1)))
    again = log.compact(str(tmp_path / "again"))
    assert [r.prediction_id for r in again.outcomes().collect()] == ["not logged yet"]


def test_features_are_kept_as_json(spark, tmp_path):
    store = pl.PredictionLog(spark, str(tmp_path / "log"))
    df = spark.createDataFrame(ROWS[:1], SCHEMA).withColumn("features", F.create_map(F.lit("a"), F.lit("1")))
    store.append(df, at_ten())
    assert store.current().first().features == '{"a":"1"}'


def test_csv_log(spark, log, tmp_path):
    path = str(tmp_path / "csv")
    pl.write_log_csv(log.current().withColumn("features", F.lit('{"a": "x, y"}')), path)
    back = {r.customer_id: r for r in pl.read_log_csv(spark, path).collect()}
    assert len(back) == 4 and back["3"].actual_outcome is None and back["1"].features == {"a": "x, y"}
    assert back["1"].prediction_timestamp == dt.datetime(2024, 3, 1, 10)
    assert pl.read_log_csv(spark, str(tmp_path / "none")).isEmpty()


EVALUATION = "model_version string, recall double, precision double, f1_score double, accuracy double, roc_auc double, d string"


def evaluations(spark):
    rows = [("v1", 0.75, 0.8, 0.77, 0.8, 0.9, "2024-01-01"), ("v2", 0.9, 0.8, 0.85, 0.8, 0.9, "2024-01-02"), ("v1", 0.5, 0.8, 0.6, 0.8, 0.9, "2024-01-03")]
    return spark.createDataFrame(rows, EVALUATION).withColumn("evaluation_date", F.to_timestamp("d"))


def test_alerts(spark, tmp_path):
    path = str(tmp_path / "alerts")
    assert alert_log.read_alerts(spark, path).isEmpty()
    raised = alerts.raise_alerts(evaluations(spark))
    alert_log.append_alerts(raised, path)
    logged = alert_log.read_alerts(spark, path)
    newest = alerts.newest_alerts(logged, limit=1).first()
    assert logged.count() == 2 and newest.metrics["recall"] == 0.5 and newest.severity == "high"
    assert newest.message == (
        "Model performance degradation detected for version v1. "
        "Recall: 0.5000 (threshold: 0.8500), Precision: 0.8000, F1-Score: 0.6000"
    )
    assert newest.timestamp == dt.datetime(2024, 1, 3) and newest.alert_id == "ALERT_20240103_000000_v1"
    assert alerts.newest_alerts(logged, model_version="v2").isEmpty()
    assert alerts.raise_alerts(evaluations(spark), threshold=0.4).isEmpty()


def test_broken_alert_lines_are_skipped(spark, tmp_path):
    (tmp_path / "alerts.json").write_text('{"alert_id": "A", "model_version": "v"}\n{broken\n')
    assert [r.alert_id for r in alert_log.read_alerts(spark, str(tmp_path / "alerts.json")).collect()] == ["A"]


def test_customer_csv(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(
        "tenure_months,monthly_charges,total_charges,contract_type,payment_method,internet_service,churn,extra\n"
        "3,20.5,NA,One year,null,No,1,z\n,NaN,10,Two year,Credit card,DSL,0,\n"
    )
    a, b = customers.read_csv(spark, str(path)).collect()
    assert (a.tenure_months, a.total_charges, a.payment_method, a.internet_service, a.extra) == (3, None, None, "No", "z")
    assert b.tenure_months is None and b.monthly_charges is None and b.churn == 0
    with pytest.raises(FileNotFoundError):
        customers.read_csv(spark, str(tmp_path / "none.csv"))


def test_fractions_in_integer_columns_are_errors(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("tenure_months,monthly_charges\n3.0,1.5\n3.7,2\n")
    with pytest.raises(Exception, match="tenure_months: not a whole number: 3.7"):
        customers.read_csv(spark, str(path)).collect()


def test_generator_does_not_depend_on_partitions(spark):
    one = sorted(map(str, customers.generate(spark, 300, 7).collect()))
    before = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        assert sorted(map(str, customers.generate(spark, 300, 7).collect())) == one
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism") if before is None else spark.conf.set("spark.sql.leafNodeDefaultParallelism", before)


def test_generator(spark, tmp_path):
    df = customers.generate(spark, 4000, 1).persist()
    s = df.agg(
        F.min("tenure_months"), F.max("tenure_months"), F.min("monthly_charges"), F.max("monthly_charges"), F.avg("churn"),
        F.count_distinct("customer_id"), F.avg(F.when(F.col("contract_type") == "Month-to-month", 1).otherwise(0)),
    ).first()
    assert s[0] >= 1 and s[1] <= 72 and s[2] >= 20 and s[3] <= 120 and 0.25 < s[4] < 0.5
    assert s[5] == 4000 and abs(s[6] - 0.5) < 0.05
    ratio = F.col("total_charges") / (F.col("tenure_months") * F.col("monthly_charges"))
    assert df.where(~ratio.between(0.89, 1.11)).isEmpty()
    customers.write_table(df, str(tmp_path / "csv"), "csv")
    assert customers.read_csv(spark, str(tmp_path / "csv")).count() == 4000
    df.unpersist()
