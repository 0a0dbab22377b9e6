"""Reading, writing and generating customer tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import settings
from tidemark.functions.columns import key_uniform, nan_to_null
from tidemark.operators.scorecard import ATTRITION_CARD, draw_label, score
from tidemark.sources.storage import exists

# Text cells that mean "missing" in a customer file. 'No' is a real category.
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv(spark: SparkSession, path: str, schema: T.StructType = settings.CUSTOMER_SCHEMA) -> DataFrame:
    """Customers from CSV with a header, by column name; absent columns are left out.

    Cells are read as text and cast, so that every spelling of a missing value becomes NULL. A
    number cell that is not a number, or an integer cell with a fraction, is an error rather than
    a silent gap or another number.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"Data file not found: {path}")
    raw = spark.read.option("header", True).csv(path)
    wanted = [f for f in schema.fields if f.name in raw.columns]

    def typed(f: T.StructField) -> Column:
        text = F.when(~F.trim(F.col(f.name)).isin(MISSING_TEXT), F.col(f.name))
        if isinstance(f.dataType, T.IntegerType):
            number = text.cast("double")  # "3.0" is how a gap makes integers look
            fraction = F.concat(F.lit(f"{f.name}: not a whole number: "), text)
            whole = F.when(number == F.floor(number), number.cast(f.dataType))
            return F.when(number.isNull() | F.isnan(number) | whole.isNotNull(), whole).otherwise(
                F.raise_error(fraction).cast(f.dataType)
            ).alias(f.name)
        return text.cast(f.dataType).alias(f.name)

    return raw.select(*[typed(f) for f in wanted], *[c for c in raw.columns if c not in schema.names])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(f"Data file not found: {path}")
    return nan_to_null(spark.read.parquet(path))


def write_table(df: DataFrame, path: str, file_format: str = "parquet", mode: str = "overwrite") -> None:
    """Write one file per task."""
    writer = df.write.mode(mode)
    if file_format == "csv":
        writer.option("header", True).csv(path)
    elif file_format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format '{file_format}'")


def customer_key(number: Column) -> Column:
    """A readable key from a row's own number."""
    return F.format_string("CUST_%04d", number)


def _weighted(uniform: Column, choices: list[tuple[str, float]]) -> Column:
    """One of the choices by cumulative weight."""
    out = F.lit(choices[-1][0])
    upper = sum(w for _, w in choices)
    for name, weight in reversed(choices):
        out = F.when(uniform < upper, F.lit(name)).otherwise(out)
        upper -= weight
    return out


# Category weights of generated customers.
CONTRACTS = [("Month-to-month", 0.5), ("One year", 0.3), ("Two year", 0.2)]
PAYMENTS = [("Electronic check", 0.35), ("Mailed check", 0.25), ("Bank transfer", 0.2), ("Credit card", 0.2)]
SERVICES = [("DSL", 0.4), ("Fiber optic", 0.4), ("No", 0.2)]


def generate(spark: SparkSession, n: int = 1000, seed: int = settings.RANDOM_SEED) -> DataFrame:
    """n customers with the usual shape: half of them new (exponential tenure, mean 12 months),
    half long-standing (normal tenure, mean 48), charges around 50, and a label drawn from the
    attrition scorecard. Rows are made where they are needed; nothing passes the driver. Every draw
    depends on the row's number and the seed only, so a seed gives the same customers on any cluster."""

    def draw(i: int) -> Column:
        return key_uniform("id", seed + i)

    def normal(i: int) -> Column:  # from two uniform draws
        return F.sqrt(-2.0 * F.log(1.0 - draw(i))) * F.cos(2.0 * math.pi * draw(i + 100))

    tenure = F.when(draw(0) < 0.5, -12.0 * F.log(1.0 - draw(1))).otherwise(48.0 + 20.0 * normal(2))
    rows = spark.range(n).select(
        customer_key(F.col("id") + 1).alias(settings.ID_COLUMN),
        F.least(F.greatest(tenure, F.lit(1.0)), F.lit(72.0)).cast("int").alias("tenure_months"),
        F.round(F.least(F.greatest(50.0 + 20.0 * normal(3), F.lit(20.0)), F.lit(120.0)), 2).alias("monthly_charges"),
        (0.9 + 0.2 * draw(4)).alias("__factor"),
        _weighted(draw(5), CONTRACTS).alias("contract_type"),
        _weighted(draw(6), PAYMENTS).alias("payment_method"),
        _weighted(draw(7), SERVICES).alias("internet_service"),
    )
    priced = rows.withColumn(
        "total_charges", F.round(F.col("tenure_months") * F.col("monthly_charges") * F.col("__factor"), 2)
    )
    labelled = draw_label(score(priced, ATTRITION_CARD, "__p"), "__p", seed)
    return labelled.select(*settings.CUSTOMER_SCHEMA.names)
