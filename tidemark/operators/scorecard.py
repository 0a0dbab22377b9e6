"""Rule scorecards: a base rate plus points for matching conditions, clipped to a range."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import flag, key_uniform, sql_double
from tidemark.settings import HIGH_RISK_THRESHOLD, ID_COLUMN


@dataclass(frozen=True)
class Scorecard:
    base: float
    rules: tuple[tuple[str, float], ...]
    low: float = 0.05
    high: float = 0.85

    def expression(self) -> str:
        terms = [sql_double(self.base)] + [
            f"CASE WHEN {condition} THEN {sql_double(points)} ELSE 0.0D END" for condition, points in self.rules
        ]
        return f"least(greatest({' + '.join(terms)}, {sql_double(self.low)}), {sql_double(self.high)})"

    def column(self) -> Column:
        return F.expr(self.expression())


# Attrition propensity by tenure, contract, payment method, charges and service.
ATTRITION_CARD = Scorecard(
    base=0.15,
    rules=(
        ("tenure_months < 6", 0.30),
        ("tenure_months >= 6 AND tenure_months < 12", 0.20),
        ("tenure_months >= 36", -0.15),
        ("contract_type = 'Month-to-month'", 0.25),
        ("contract_type = 'Two year'", -0.20),
        ("payment_method = 'Electronic check'", 0.15),
        ("payment_method = 'Credit card'", -0.10),
        ("monthly_charges > 80", 0.15),
        ("internet_service = 'Fiber optic'", 0.10),
    ),
)


def score(df: DataFrame, card: Scorecard = ATTRITION_CARD, output: str = "churn_probability") -> DataFrame:
    return df.withColumn(output, F.round(card.column(), 6))


def high_risk(probability: Column, threshold: float = HIGH_RISK_THRESHOLD) -> Column:
    return probability >= F.lit(float(threshold))


def draw_label(df: DataFrame, probability: str, seed: int, key: str = ID_COLUMN, output: str = "churn") -> DataFrame:
    """Bernoulli draw with the given probability, reproducible by key."""
    return df.withColumn(output, flag(key_uniform(key, seed) < F.col(probability)))


def threshold_sweep(df: DataFrame, probability: str, thresholds: list[float]) -> DataFrame:
    """High-risk counts at each threshold: one pass and one aggregation, whatever their number."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_scored"),
        *[
            F.count_if(F.col(probability) >= F.lit(float(t))).alias(f"__t{i}")
            for i, t in enumerate(thresholds)
        ],
    )
    rows = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(f"__t{i}").alias("n_high_risk"))
            for i, t in enumerate(thresholds)
        ]
    )
    return counts.select("n_scored", F.explode(rows).alias("r")).select("r.*", "n_scored")
