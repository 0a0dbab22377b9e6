import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import settings
from tidemark.errors import ParameterError, TableCheckError, UnknownVersionError
from tidemark.operators import attribution, explanations, scoring, training
from tidemark.plans import training_run
from tidemark.sources import customers
from tidemark.sources.prediction_log import PredictionLog
from tidemark.sources.registry import ModelRegistry, scan_metadata

PARAMS = {**settings.DEFAULT_PARAMS, "n_estimators": 4, "max_depth": 3, "learning_rate": 0.3}


def at_ten():
    return F.to_timestamp(F.lit("2024-03-01 10:00:00"))


@pytest.fixture(scope="module")
def people(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("data") / "people")
    customers.write_table(customers.generate(spark, 1500, 42), path)
    return customers.read_parquet(spark, path)


@pytest.fixture(scope="module")
def model(people):
    return training.train(people, params=PARAMS)


@pytest.fixture(scope="module")
def leaves(spark, model):
    return attribution.leaf_table(spark, model.classifier)


def test_full_width_is_21(model):
    assert len(model.feature_names) == 21 == model.classifier.numFeatures
    assert model.feature_names[:3] == settings.NUMERIC_FEATURES
    assert model.feature_names[11] == "contract_type_Month-to-month"


def test_weight_comes_from_the_class_balance(people, model):
    counts = {r.churn: r["count"] for r in people.groupBy("churn").count().collect()}
    assert model.params["scale_pos_weight"] == pytest.approx(7.5 * counts[0] / counts[1])


def test_training_arguments(spark, people):
    with pytest.raises(ParameterError, match="learning_rate"):
        training.train(people, params={**PARAMS, "learning_rate": 2})
    with pytest.raises(ValueError, match="Training data is empty"):
        training.train(people.limit(0), params=PARAMS)


def test_parameter_translation():
    with pytest.warns(UserWarning, match="eval_metric.*reg_alpha"):
        out = training.classifier_settings({**settings.DEFAULT_PARAMS, "colsample_bytree": 1.0})
    assert (out["maxDepth"], out["maxIter"], out["stepSize"], out["featureSubsetStrategy"]) == (6, 300, 0.03, "all")


@pytest.mark.parametrize("params", [{"max_depth": 0}, {"max_depth": 64}, {"objective": "reg:gamma"}, {"booster": "gblinear"}])
def test_what_the_library_cannot_do_is_refused(params):
    with pytest.raises(ParameterError, match="only"):
        training.classifier_settings(params)


def test_scores_are_probabilities_in_one_narrow_stage(model, people):
    scored = scoring.score(model, people)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    bad = scored.where(~F.col("churn_probability").between(0, 1) | F.exists("feature_values", lambda v: v.isNull() | F.isnan(v)))
    assert bad.isEmpty() and scored.count() == 1500
    link = scored.select(F.abs(F.col("churn_probability") - 1 / (1 + F.exp(-F.col("margin")))).alias("e"))
    assert link.agg(F.max("e")).first()[0] < 1e-12


def test_missing_values_and_unseen_categories_are_scored(spark, model):
    rows = [
        {"customer_id": "a", "tenure_months": 5, "monthly_charges": None, "total_charges": float("nan"), "contract_type": None,
         "payment_method": "Carrier pigeon", "internet_service": "No"},
    ]
    row = scoring.predict(model, scoring.records_table(spark, rows), "v1", at_ten(), check=True).first()
    assert 0 <= row.churn_probability <= 1 and row.top_features is None


def test_results(spark, model, leaves, people):
    out = scoring.predict(model, people, "v1", at_ten(), threshold=0.9, leaves=leaves, explain=True)
    row = out.first()
    assert row.model_version == "v1" and len(row.top_features) == 5
    assert row.is_high_risk == (row.churn_probability >= 0.9)
    sizes = [abs(t.shap_value) for t in row.top_features]
    assert sizes == sorted(sizes, reverse=True) and all(t.feature in model.feature_names for t in row.top_features)
    flat = scoring.flat_results(out).first()
    assert flat.prediction_timestamp == "2024-03-01T10:00:00.000000" and len(json.loads(flat.top_features)) == 5


def test_result_arguments(spark, model, people):
    with pytest.raises(ValueError, match="leaf table"):
        scoring.predict(model, people, "v1", at_ten(), explain=True)
    with pytest.raises(TableCheckError, match="Missing required features"):
        scoring.predict(model, people.drop("contract_type"), "v1", at_ten())
    with pytest.raises(TableCheckError, match="must have 'customer_id'"):
        scoring.records_table(spark, [{"tenure_months": 1}])
    with pytest.raises(ValueError, match="exceeds"):
        scoring.predict(model, people, "v1", at_ten(), max_rows=1000)


def test_one_record(spark, model, leaves):
    record = {"customer_id": "T1", "tenure_months": 3, "monthly_charges": 90.0, "total_charges": 270.0,
              "contract_type": "Month-to-month", "payment_method": "Electronic check", "internet_service": "Fiber optic"}
    row = scoring.predict_one(spark, model, record, "v1", leaves=leaves, explain=True)
    assert row.customer_id == "T1" and len(row.top_features) == 5
    with pytest.raises(TableCheckError, match="non-empty string"):
        scoring.predict_one(spark, model, {**record, "customer_id": " "}, "v1")


def test_attributions_add_up(model, leaves, people):
    table = scoring.explain_table(model, leaves, people)
    check = explanations.additivity_check(table, "shap", "base_value", "margin", 1e-9).first()
    assert check.n_violations == 0 and check.n_rows == 1500
    assert len(table.first().shap) == 21


def test_evaluation_of_versions(model, people):
    rows = scoring.compare_versions({"a": model, "b": model}, people).collect()
    assert {r.model_version for r in rows} == {"a", "b"} and rows[0].recall == rows[1].recall
    assert all(r.tn + r.fp + r.fn + r.tp == 1500 for r in rows)


def test_gain_importance(spark, model):
    rows = training.feature_importance(spark, model).collect()
    gains = [r.importance for r in rows]
    assert len(rows) == 10 and gains == sorted(gains, reverse=True)


def test_registry_round_trip(spark, model, leaves, people, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    with pytest.raises(UnknownVersionError):
        reg.latest()
    assert reg.versions().isEmpty() and reg.deployed() is None
    reg.save(model, "v1.0.0", {"metrics": {"recall": 0.9}, "timestamp": "2024-01-01T00:00:00.000000", "description": "first", "author": "me", "training_samples": 5, "nested": {"a": [1]}})
    reg.save(model, "v2.0.0", {"metrics": {"recall": 0.8}, "timestamp": "2024-02-01T00:00:00.000000"})
    assert [r.version for r in reg.versions().collect()] == ["v2.0.0", "v1.0.0"] and reg.latest() == "v2.0.0"
    meta = reg.metadata("v1.0.0")
    assert (meta["author"], meta["training_samples"], meta["nested"]) == ("me", 5, {"a": [1]}) and meta["params"]["max_depth"] in (3, "3")
    assert meta["n_features"] == 21 and meta["description"] == "first" and meta["metrics"] == {"recall": 0.9}

    assert reg.load()[0] == "v2.0.0"
    reg.deploy("v1.0.0")
    version, loaded = reg.load()
    assert version == reg.deployed() == "v1.0.0" and loaded.feature_names == model.feature_names
    before, after = scoring.score(model, people), scoring.score(loaded, people)
    a = np.array([r[0] for r in before.orderBy("customer_id").select("churn_probability").collect()])
    b = np.array([r[0] for r in after.orderBy("customer_id").select("churn_probability").collect()])
    assert (a == b).all()
    assert reg.leaves("v1.0.0").base == pytest.approx(leaves.base)

    with pytest.raises(ValueError, match="currently deployed"):
        reg.delete("v1.0.0")
    reg.delete("v2.0.0")
    assert [r.version for r in reg.versions().collect()] == ["v1.0.0"]
    for call in (reg.load, reg.deploy, reg.delete, reg.metadata):
        with pytest.raises(UnknownVersionError):
            call("v2.0.0")


def test_default_version_name(spark, model, tmp_path):
    name = ModelRegistry(spark, str(tmp_path / "reg")).save(model)
    assert len(name) == 17 and name.startswith("v_2")


def test_metadata_scan_skips_what_it_cannot_read(spark, tmp_path):
    for folder, text in {"v1": '{"version": "v1", "timestamp": "t1", "metrics": {"recall": 0.5}}', "v2": "{broken",
                         ".hidden": '{"version": "h"}', "v3": "{}"}.items():
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "metadata.json").write_text(text)
    rows = {r.version: r for r in scan_metadata(spark, f"{tmp_path}/*/metadata.json").collect()}
    assert set(rows) == {"v1", "v3"} and rows["v3"].n_features == 0 and rows["v3"].metrics == {}
    assert scan_metadata(spark, f"{tmp_path}/none/*/metadata.json").isEmpty()


def test_training_run_and_its_gate(spark, people, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    with pytest.raises(ValueError, match="minimum recall"):
        training_run.training_run(people, reg, PARAMS, threshold=1.01)
    assert reg.versions().isEmpty()
    version, _, metrics = training_run.training_run(people, reg, PARAMS, "v1", threshold=0.0)
    assert reg.metadata(version)["metrics"]["recall"] == pytest.approx(metrics["recall"])
    assert metrics["n_samples"] == pytest.approx(300, abs=1)
    with pytest.warns(UserWarning, match="minimum recall"):
        assert not training_run.check_recall({"recall": 0.1}, on_fail="warn")


def test_full_run(spark, people, tmp_path):
    reg, log = ModelRegistry(spark, str(tmp_path / "reg")), PredictionLog(spark, str(tmp_path / "log"))
    test = customers.generate(spark, 400, 43)
    customers.write_table(test, str(tmp_path / "test"))
    test = customers.read_parquet(spark, str(tmp_path / "test"))
    run = training_run.full_run(spark, people, test, reg, log, at_ten(), PARAMS, explain_rows=50, version="v1")
    assert run.predictions.count() == 400 == log.current().count()
    explained = run.explained.collect()
    assert len(explained) == 50 and all(len(r.top_features) == 5 for r in explained)
    row = run.evaluation.first()
    assert row.n_samples == 400 and row.recall == pytest.approx(run.training_metrics["recall"])


def test_text_that_cannot_be_read_is_refused_or_listed(spark):
    rows = [("a", {"tenure_months": "3", "monthly_charges": " 2.5 ", "contract_type": "One year"}), ("b", {"tenure_months": "x3", "monthly_charges": ""}), ("c", {})]
    df = spark.createDataFrame(rows, "customer_id string, features map<string,string>")
    with pytest.raises(Exception, match="'tenure_months' cannot be read from 'x3'"):
        scoring.records_from_maps(df).collect()
    typed = {r.customer_id: (r.tenure_months, r.monthly_charges, r.contract_type) for r in scoring.records_from_maps(df, on_unreadable="null").collect()}
    assert typed == {"a": (3, 2.5, "One year"), "b": (None, None, None), "c": (None, None, None)}
    assert [tuple(r) for r in scoring.unreadable_records(df).collect()] == [("b", "tenure_months", "x3")]
    with pytest.raises(ValueError, match="on_unreadable"):
        scoring.records_from_maps(df, on_unreadable="skip")
