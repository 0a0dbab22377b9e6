import pytest

from tidemark.errors import ParameterError
from tidemark.operators import rules
from tidemark.plans import queries

CASES = [
    ({"learning_rate": 0.1, "max_depth": 6, "n_estimators": 100}, 0),
    ({"learning_rate": 0}, 1),
    ({"learning_rate": -0.1}, 1),
    ({"learning_rate": 1}, 0),
    ({"learning_rate": 1.5}, 1),
    ({"max_depth": 0}, 0),
    ({"max_depth": -1}, 1),
    ({"max_depth": 3.5}, 1),
    ({"max_depth": True}, 0),
    ({"n_estimators": 0}, 1),
    ({"n_estimators": 1}, 0),
    ({"subsample": 0.0}, 1),
    ({"subsample": 1.0}, 0),
    ({"colsample_bytree": 1.1}, 1),
    ({"gamma": 0}, 0),
    ({"gamma": -1}, 1),
    ({"reg_alpha": -0.5, "reg_lambda": -0.5}, 2),
    ({"scale_pos_weight": 0}, 1),
    ({"scale_pos_weight": 7.5}, 0),
    ({"random_state": "42"}, 1),
    ({"random_state": -7}, 0),
    ({"objective": "binary:logistic", "booster": "dart", "tree_method": "hist"}, 0),
    ({"objective": "binary:nonsense"}, 1),
    ({"eval_metric": "auc", "grow_policy": "sideways"}, 1),
    ({"learning_rate": None, "objective": None}, 0),
    ({"not_a_parameter": "whatever"}, 0),
    ({"learning_rate": float("nan")}, 0),
    ({"learning_rate": -1, "max_depth": -1, "n_estimators": 0, "booster": "x"}, 4),
    ({"learning_rate": "fast"}, 1),
    ({}, 0),
]


@pytest.mark.parametrize(("params", "n"), CASES)
def test_one_configuration(params, n):
    errors = rules.param_errors(params)
    assert len(errors) == n
    if n:
        with pytest.raises(ParameterError) as e:
            rules.check_params(params)
        assert all(x in str(e.value) for x in errors)
    else:
        assert rules.check_params(params)


def test_tables_agree_with_single_checks(spark):
    configs = {str(i): c for i, (c, _) in enumerate(CASES)}
    grouped = rules.violations_per_config(rules.to_long(spark, configs)).collect()
    found = {r.config_id: sorted(r.errors) for r in grouped}
    for i, (params, _) in enumerate(CASES):
        if params:
            assert found[str(i)] == sorted(rules.param_errors(params)), params


def test_not_a_dictionary():
    with pytest.raises(ParameterError, match="must be a dictionary"):
        rules.check_params([("learning_rate", 0.1)])


def test_rule_join_broadcasts_the_rules(spark):
    configs = rules.to_long(spark, {"a": {"gamma": 1}})
    plan = rules.rule_violations(configs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_choices_and_texts_are_not_made_anew_for_every_row(spark):
    """Fails where the values to try are one expression of every order, and the text of an error is made to see whether there is one."""
    plan = queries.rule_violations_of_all(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "format_string" not in plan
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert not any("Expected" in line or "Invalid value" in line for line in filters)
