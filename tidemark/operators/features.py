"""Derived customer features.

Every feature is a SQL expression, so the same text serves DataFrame projections and the
persisted ``SQLTransformer`` stage of a trained model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import nan_to_null, sql_double, sql_name
from tidemark.functions.ranks import exact_quantiles

DERIVED_FEATURES = [
    "tenure_years",
    "is_new_customer",
    "is_long_term_customer",
    "avg_monthly_spend",
    "current_to_avg_ratio",
    "total_spend_ratio",
    "service_count",
    "is_high_value",
]


def derived_expressions(columns: list[str], monthly_median: str | None = None) -> dict[str, str]:
    """SQL for each feature whose inputs exist. ``monthly_median`` is a SQL expression."""
    have = set(columns)
    out: dict[str, str] = {}
    if "tenure_months" in have:
        out["tenure_years"] = "tenure_months / 12.0D"
        out["is_new_customer"] = "int(coalesce(tenure_months <= 12, false))"
        out["is_long_term_customer"] = "int(coalesce(tenure_months >= 36, false))"
    if {"monthly_charges", "total_charges"} <= have:
        if "tenure_months" in have:
            average = "try_divide(total_charges, double(tenure_months + 1))"
            out["avg_monthly_spend"] = average
            out["current_to_avg_ratio"] = f"try_divide(monthly_charges, {average} + 0.01D)"
        out["total_spend_ratio"] = "try_divide(monthly_charges, total_charges + 0.01D)"
    services = [c for c in columns if "service" in c.lower() and c not in DERIVED_FEATURES]
    if services:
        out["service_count"] = " + ".join(f"int({sql_name(c)} is not null)" for c in services)
    if monthly_median is not None and {"contract_type", "monthly_charges"} <= have:
        out["is_high_value"] = f"int(coalesce(monthly_charges > {monthly_median}, false))"
    return out


def median_charge(df: DataFrame) -> DataFrame:
    """Exact median of the known monthly charges, as one row."""
    return exact_quantiles(df.select("monthly_charges"), "monthly_charges", {"median": 0.5})


def fit_median_charge(df: DataFrame) -> float | None:
    """The median as a number, to be kept with a model and reused when scoring."""
    return median_charge(nan_to_null(df.select("monthly_charges"))).first()["median"]


def add_features(df: DataFrame, monthly_median: float | None = None) -> DataFrame:
    """Add the derived features.

    With ``monthly_median`` the stored training value decides ``is_high_value``, so a customer
    gets the same features in any batch. Without it the median of ``df`` itself is used.
    """
    df = nan_to_null(df)
    needs_median = {"contract_type", "monthly_charges"} <= set(df.columns)
    if not needs_median:
        return df.withColumns({n: F.expr(e) for n, e in derived_expressions(df.columns).items()})
    if monthly_median is not None:
        exprs = derived_expressions(df.columns, sql_double(monthly_median))
        return df.withColumns({n: F.expr(e) for n, e in exprs.items()})
    exprs = derived_expressions(df.columns, "__median")
    return (
        df.withColumn("__median", median_charge(df).scalar())
        .withColumns({n: F.expr(e) for n, e in exprs.items()})
        .drop("__median")
    )
