"""The alert log: JSON lines, appended per check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.storage import empty, exists

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("severity", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Append one line per alert. Alerts are few: one per failing model version and check."""
    alerts.select(*ALERT_SCHEMA.names).coalesce(1).write.mode("append").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ).json(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All readable alerts; broken lines are skipped and an absent log is empty."""
    if not exists(spark, path):
        return empty(spark, ALERT_SCHEMA)
    return (
        spark.read.schema(ALERT_SCHEMA)
        .option("mode", "DROPMALFORMED")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
        .json(path)
        .where(F.col("alert_id").isNotNull())
    )
