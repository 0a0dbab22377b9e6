"""The prediction log: append-only predictions and outcome events in committed batches.

Both tables are partitioned by the date of the prediction. An outcome learns that date when it is appended; one whose prediction
is not logged yet waits without a date. What belongs to the predictions of some days is therefore in the files of those
days, and in the waiting ones, however long the log is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import TableCheckError
from tidemark.operators.outcomes import current_state, prediction_key, retrieve, unmatched_outcomes
from tidemark.operators.validation import log_row_problems, raise_on_problems, split_on_problems
from tidemark.sources.commits import Commits, Conflict
from tidemark.sources.scratch import new_folder
from tidemark.sources.storage import empty, exists, names_in, remove

LOG_SCHEMA = T.StructType(
    [
        T.StructField("prediction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("predicted_class", T.IntegerType()),
        T.StructField("actual_outcome", T.IntegerType()),
        T.StructField("prediction_timestamp", T.TimestampType()),
        T.StructField("outcome_timestamp", T.TimestampType()),
        T.StructField("features", T.StringType()),
    ]
)
OUTCOME_SCHEMA = T.StructType(
    [
        T.StructField("prediction_id", T.StringType()),
        T.StructField("actual_outcome", T.IntegerType()),
        T.StructField("outcome_timestamp", T.TimestampType()),
    ]
)
_DATED_LOG = T.StructType([*LOG_SCHEMA.fields, T.StructField("prediction_date", T.DateType())])
_DATED_OUTCOMES = T.StructType([*OUTCOME_SCHEMA.fields, T.StructField("prediction_date", T.DateType())])


def log_rows(df: DataFrame, at: Column) -> DataFrame:
    """Rows in log form from scored rows; optional columns are filled in.

    An outcome timestamp is set only together with an outcome. ``features`` may be a map, a
    struct or JSON text.
    """
    have = dict(df.dtypes)
    outcome = F.col("actual_outcome").cast("int") if "actual_outcome" in have else F.lit(None).cast("int")
    if "features" not in have:
        features = F.lit("{}")
    elif have["features"] == "string":
        features = F.coalesce("features", F.lit("{}"))
    else:
        features = F.coalesce(F.to_json("features"), F.lit("{}"))
    given = F.col("prediction_id") if "prediction_id" in have else F.lit(None).cast("string")
    # two predictions of a customer in one batch differ in what was predicted or from what
    content = F.xxhash64(F.col("prediction").cast("double"), F.col("predicted_class").cast("int"), features)
    key = F.concat_ws("_", prediction_key(F.col("customer_id"), F.col("model_version"), at), F.lower(F.hex(content)))
    return df.select(
        F.coalesce(given, key).alias("prediction_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        "model_version",
        F.col("prediction").cast("double").alias("prediction"),
        F.col("predicted_class").cast("int").alias("predicted_class"),
        outcome.alias("actual_outcome"),
        at.alias("prediction_timestamp"),
        F.when(outcome.isNotNull(), at).alias("outcome_timestamp"),
        features.alias("features"),
    )


class PredictionLog:
    """A log under one root folder. All methods take and return tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.commits = Commits(spark, root)

    def append(self, rows: DataFrame, at: Column, on_problem: str = "raise") -> DataFrame:
        """Append scored rows and return the rows that were held back.

        ``on_problem='raise'`` refuses the whole batch if a row is outside the domain;
        ``'quarantine'`` writes the good rows. An id is the same for rows that are alike in
        customer, version, time, result and features, so a batch that is run twice with the same
        ``at`` is logged once. Every row of the batch is either written or returned with the
        reason: out of the domain, a second row with an id of the batch, or already in the log.
        The checked batch is kept in the scratch folder, which the returned rows are read from.

        The rows are seen all at once, when their batch is committed. If another writer commits first, what it has
        added is looked through as well, so that an id is logged once whoever writes it.
        """
        if on_problem not in ("raise", "quarantine"):
            raise ValueError("on_problem must be 'raise' or 'quarantine'")
        path = new_folder(self.spark, "log-batch")
        checked = log_row_problems(log_rows(rows, at))
        checked.write.parquet(path)
        checked = self.spark.read.schema(checked.schema).parquet(path)
        if on_problem == "raise":
            raise_on_problems(checked)
        good, bad = split_on_problems(checked)
        # rows that are alike collapse before the shuffle, so that an id repeated very often does no harm
        alike = good.groupBy(*LOG_SCHEMA.names).agg(F.count(F.lit(1)).alias("__copies"))
        order = Window.partitionBy("prediction_id").orderBy(*LOG_SCHEMA.names[3:], "customer_id", "model_version")
        ranked = alike.withColumn("__rank", F.row_number().over(order))
        again = ranked.withColumn("__copies", F.col("__copies") - (F.col("__rank") == 1).cast("int")).where("__copies > 0")
        again = again.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
        held = [bad, self._held(again, "the batch has another row with this id")]
        fresh = ranked.where("__rank = 1").withColumn("prediction_date", F.to_date("prediction_timestamp")).select(*_DATED_LOG.names)
        span = None
        looked = set()
        while True:
            seen, state = self.commits.current()
            news = [b for b in state.get("predictions", []) if b not in looked]
            if news:
                # only the date partitions that this batch falls into are read back
                span = span or fresh.agg(F.min("prediction_date").alias("first"), F.max("prediction_date").alias("last")).first()
                logged = self.commits.read("predictions", _DATED_LOG, news).select("prediction_id", "prediction_date")
                logged = logged.where(F.col("prediction_date").between(span["first"], span["last"]))
                known = new_folder(self.spark, "log-known")
                fresh.join(logged, ["prediction_date", "prediction_id"], "left_semi").select(*_DATED_LOG.names).write.parquet(known)
                known = self.spark.read.schema(fresh.schema).parquet(known)
                held.append(self._held(known, "already in the log"))
                fresh = fresh.join(known, ["prediction_date", "prediction_id"], "left_anti").select(*_DATED_LOG.names)
                looked.update(news)
            batch = self.commits.write(fresh, "predictions", "prediction_date")
            try:
                self.commits.commit(seen, state | {"predictions": [*state.get("predictions", []), batch]})
            except Conflict:
                remove(self.spark, f"{self.commits.root}/predictions/batch={batch}")
                continue
            return reduce(DataFrame.unionByName, held)

    @staticmethod
    def _held(rows: DataFrame, reason: str) -> DataFrame:
        return rows.select(*LOG_SCHEMA.names, F.array(F.lit(reason)).alias("problems"))

    def append_outcomes(self, outcomes: DataFrame) -> None:
        """Append (prediction_id, actual_outcome, outcome_timestamp) events; outcomes must be 0 or 1."""
        wrong = outcomes.where(~F.coalesce(F.col("actual_outcome").isin(0, 1), F.lit(False))).head()
        if wrong is not None:
            raise TableCheckError(f"Actual outcome must be 0 or 1, got {wrong.actual_outcome}")
        given = outcomes.select(*[F.col(f.name).cast(f.dataType) for f in OUTCOME_SCHEMA.fields])
        self.commits.add(outcomes=[self.commits.write(self._dated(given), "outcomes", "prediction_date")])

    def _dated(self, outcomes: DataFrame) -> DataFrame:
        """Outcomes with the date of their prediction, NULL while it is not logged."""
        dates = self.predictions().select("prediction_id", "prediction_date")
        return outcomes.join(dates, "prediction_id", "left").select(*_DATED_OUTCOMES.names)

    def predictions(self) -> DataFrame:
        return self.commits.read("predictions", _DATED_LOG)

    def outcomes(self) -> DataFrame:
        return self.commits.read("outcomes", _DATED_OUTCOMES)

    def current(self, first_day: object | None = None, last_day: object | None = None) -> DataFrame:
        """Every prediction, or those of some days (inclusive), with its latest outcome. Days that are not wanted are not read:
        neither their predictions nor the outcomes of these."""
        _, state = self.commits.current()
        log = self.commits.read("predictions", _DATED_LOG, state.get("predictions", []))
        events = self.commits.read("outcomes", _DATED_OUTCOMES, state.get("outcomes", []))
        day, wanted = F.col("prediction_date"), F.lit(True)
        if first_day is not None:
            wanted = wanted & (day >= F.lit(first_day).cast("date"))
        if last_day is not None:
            wanted = wanted & (day <= F.lit(last_day).cast("date"))
        if first_day is not None or last_day is not None:
            log, events = log.where(wanted), events.where(wanted | day.isNull())
        return current_state(log, events.drop("prediction_date"))

    def days(self) -> list[str]:
        """The days that have predictions, newest first, from the names of their folders."""
        found = set()
        for batch in self.commits.current()[1].get("predictions", []):
            for name in names_in(self.spark, f"{self.commits.root}/predictions/batch={batch}"):
                key, _, day = name.partition("=")
                if key == "prediction_date" and day[:1].isdigit():
                    found.add(day)
        return sorted(found, reverse=True)

    def newest(self, limit: int, **conditions) -> DataFrame:
        """The newest predictions that meet the conditions of ``retrieve``, newest first. Days are read from the newest back, twice
        as many in every step, until there are enough rows."""
        if limit < 1:
            raise ValueError("limit must be positive")
        days, take = self.days(), 1
        while take < len(days):
            found = retrieve(self.current(first_day=days[take - 1]), limit=limit, **conditions)
            if found.count() >= limit:
                return found
            take *= 2
        return retrieve(self.current(), limit=limit, **conditions)

    def unknown_outcomes(self) -> DataFrame:
        return unmatched_outcomes(self.predictions(), self.outcomes())

    def record_outcome(self, prediction_id: str, actual_outcome: int, at: Column | None = None) -> bool:
        """Record one outcome; False if the prediction is not in the log."""
        if actual_outcome not in (0, 1):
            raise ValueError(f"Actual outcome must be 0 or 1, got {actual_outcome}")
        found = self.predictions().where(F.col("prediction_id") == F.lit(prediction_id)).head()
        if found is None:
            return False
        event = self.spark.range(1).select(
            F.lit(prediction_id).alias("prediction_id"),
            F.lit(actual_outcome).alias("actual_outcome"),
            (F.current_timestamp() if at is None else at).alias("outcome_timestamp"),
        )
        self.append_outcomes(event)
        return True

    def compact(self, root: str) -> PredictionLog:
        """Write log and outcomes merged into a log under a new root, which has it all at once or not at all. Outcomes whose
        prediction is not in the log yet stay outcome events."""
        target = PredictionLog(self.spark, root)
        if target.commits.current()[0]:
            raise FileExistsError(f"There is a log in {root} already")
        merged = self.current().select(*_DATED_LOG.names)
        waiting = self.unknown_outcomes().withColumn("prediction_date", F.lit(None).cast("date")).select(*_DATED_OUTCOMES.names)
        state = {"predictions": [target.commits.write(merged, "predictions", "prediction_date")]}
        if not waiting.isEmpty():
            state["outcomes"] = [target.commits.write(waiting, "outcomes", "prediction_date")]
        target.commits.commit(0, state)
        return target


def _known_text(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def parse_log_text(raw: DataFrame) -> DataFrame:
    """Typed log rows from text columns: blanks become NULL, features become a map, and rows
    without an id are skipped."""
    return raw.select(
        *[
            (
                F.from_json(F.coalesce(_known_text(f.name), F.lit("{}")), "map<string,string>")
                if f.name == "features"
                else _known_text(f.name).cast(f.dataType)
            ).alias(f.name)
            for f in LOG_SCHEMA.fields
        ]
    ).where(F.col("prediction_id").isNotNull())


def read_log_csv(spark: SparkSession, path: str) -> DataFrame:
    """A log kept as CSV with a header; an absent file is an empty log."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in LOG_SCHEMA.names])
    if not exists(spark, path):
        return parse_log_text(empty(spark, text))
    return parse_log_text(spark.read.schema(text).option("header", True).option("escape", '"').csv(path))


def write_log_csv(log: DataFrame, path: str, mode: str = "append") -> None:
    """Log rows as CSV text with ISO timestamps."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    features = F.col("features") if dict(log.dtypes)["features"] == "string" else F.to_json("features")
    log.select(*LOG_SCHEMA.names).withColumns(
        {
            "features": F.coalesce(features, F.lit("{}")),
            "prediction_timestamp": F.date_format("prediction_timestamp", iso),
            "outcome_timestamp": F.date_format("outcome_timestamp", iso),
        }
    ).write.mode(mode).option("header", True).option("escape", '"').csv(path)
