"""Binary-classification metrics from one aggregation.

Labels and predicted classes are 0/1 columns. Everything below the confusion counts is
arithmetic on the counts, so it adds no job and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import settings
from tidemark.functions.columns import ratio, ratio_or_zero
from tidemark.functions.ranks import running_totals

COUNTS = ["tn", "fp", "fn", "tp"]


def _count_columns(label: str, predicted: str) -> dict[str, Column]:
    y, p = F.col(label), F.col(predicted)
    return {
        "tn": F.count_if((y == 0) & (p == 0)),
        "fp": F.count_if((y == 0) & (p == 1)),
        "fn": F.count_if((y == 1) & (p == 0)),
        "tp": F.count_if((y == 1) & (p == 1)),
    }


def confusion_counts(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp per group; all four even if only one class occurs."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in _count_columns(label, predicted).items()])


def with_matrix(counts: DataFrame) -> DataFrame:
    """Add the counts as [[tn, fp], [fn, tp]]."""
    return counts.withColumn("confusion_matrix", F.array(F.array("tn", "fp"), F.array("fn", "tp")))


def _precision() -> Column:
    return ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fn"))


def _f1() -> Column:
    return ratio_or_zero(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def _n() -> Column:
    return F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")


def with_metrics(counts: DataFrame) -> DataFrame:
    """Add precision, recall, F1 (zero when undefined), accuracy and the number of rows."""
    return counts.withColumns(
        {
            "precision": _precision(),
            "recall": _recall(),
            "f1_score": _f1(),
            "accuracy": ratio_or_zero(F.col("tn") + F.col("tp"), _n()),
            "n_samples": _n(),
        }
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Add the four rates of the confusion matrix."""
    negatives, positives = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    return counts.withColumns(
        {
            "tnr": ratio_or_zero(F.col("tn"), negatives),
            "fpr": ratio_or_zero(F.col("fp"), negatives),
            "tpr": ratio_or_zero(F.col("tp"), positives),
            "fnr": ratio_or_zero(F.col("fn"), positives),
        }
    )


def _doubles() -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(c).cast("double") for c in COUNTS)  # products of counts overflow a long


def with_matthews(counts: DataFrame) -> DataFrame:
    tn, fp, fn, tp = _doubles()
    spread = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return counts.withColumn("matthews", ratio_or_zero(tp * tn - fp * fn, spread))


def with_kappa(counts: DataFrame) -> DataFrame:
    """Cohen's kappa; NULL when chance agreement is already complete."""
    tn, fp, fn, tp = _doubles()
    n = tn + fp + fn + tp
    chance = ratio((tn + fp) * (tn + fn) + (fn + tp) * (fp + tp), n * n)
    return counts.withColumn("kappa", ratio(ratio(tn + tp, n) - chance, 1 - chance))


def classification_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per class, then accuracy, macro and weighted averages, from confusion counts."""
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    classes = {}
    for name, hit, false_alarm, missed in (("0", tn, fn, fp), ("1", tp, fp, fn)):
        classes[name] = (
            ratio_or_zero(hit, hit + false_alarm),
            ratio_or_zero(hit, hit + missed),
            ratio_or_zero(2 * hit, 2 * hit + false_alarm + missed),
            hit + missed,
        )
    n = _n()

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    rows = [row(name, *values) for name, values in classes.items()]
    accuracy = ratio_or_zero(tn + tp, n)
    rows.append(row("accuracy", accuracy, accuracy, accuracy, n))
    pairs = list(zip(*classes.values()))
    rows.append(row("macro avg", *[(a + b) / 2 for a, b in pairs[:3]], n))
    (s0, s1) = pairs[3]
    rows.append(row("weighted avg", *[ratio_or_zero(a * s0 + b * s1, n) for a, b in pairs[:3]], n))
    return counts.select(*by, F.inline(F.array(*rows)))


def auc_from_totals(positives: Column, negatives: Column, area: Column) -> Column:
    """0 when one of the classes is missing."""
    return ratio_or_zero(area, positives.cast("double") * negatives.cast("double"))


def _area() -> Column:
    """Pairs (positive, negative) ranked rightly, ties counting half, at one distinct score."""
    above = (F.col("pos_total") - F.col("pos_before") - F.col("pos")).cast("double")
    return F.col("neg") * (above + F.col("pos") / 2.0)


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by rank sums over distinct scores; exact with ties."""
    ranked = running_totals(
        df, score, {"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)}, by
    )
    return ranked.groupBy(*by).agg(
        F.coalesce(auc_from_totals(F.sum("pos"), F.sum("neg"), F.sum(_area())), F.lit(0.0)).alias("roc_auc")
    )


def _with_present_score(df: DataFrame, score: str, output: str) -> tuple[DataFrame, Column]:
    """The table with 0 for missing scores (NULL or NaN), and whether a row has a score of its own."""
    kind = dict(df.dtypes)[score]
    missing = F.col(score).isNull()
    if kind in ("double", "float"):
        missing = missing | F.isnan(score)
    filled = df.withColumns({output: F.when(missing, F.lit(0).cast(kind)).otherwise(F.col(score)), "__scored": ~missing})
    return filled, F.col("__scored")


def _score_measures(label: str, predicted: str, scored: Column) -> dict[str, Column]:
    y = F.col(label)
    return _count_columns(label, predicted) | {
        "pos": F.count_if(scored & (y == 1)),
        "neg": F.count_if(scored & (y == 0)),
        "unscored": F.count_if(~scored),
    }


def score_counts(df: DataFrame, label: str, score: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """What an evaluation needs to know per group and distinct score (column ``__score``): all that a stream has to keep of
    an open period. Rows without a score are with those of score 0, but counted apart."""
    filled, scored = _with_present_score(df, score, "__score")
    measures = _score_measures(label, predicted, scored)
    return filled.groupBy(*by, "__score").agg(*[m.alias(n) for n, m in measures.items()])


def _evaluated(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    summed = totals.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS],
        F.coalesce(F.sum("unscored"), F.lit(0)).alias("n_unscored"),
        F.coalesce(auc_from_totals(F.sum("pos"), F.sum("neg"), F.sum(_area())), F.lit(0.0)).alias("roc_auc"),
    )
    return with_metrics(summed).select(
        *by, *COUNTS, "precision", "recall", "f1_score", "accuracy", "roc_auc", "n_samples", "n_unscored"
    )


def evaluate(
    df: DataFrame, label: str, score: str, predicted: str, by: Sequence[str] = ("model_version",)
) -> DataFrame:
    """The full evaluation row per group: counts, metrics, AUC, number of rows, and how many of them have
    no score.

    One scan and one shuffle on (group, score) feed the confusion counts and the ranks. Rows whose score is
    missing (NULL or NaN) have no place in the AUC, but their predicted class counts like any other.
    """
    filled, scored = _with_present_score(df, score, "__score")
    return _evaluated(running_totals(filled, "__score", _score_measures(label, predicted, scored), by), by)


def evaluate_score_counts(counts: DataFrame, by: Sequence[str] = ("model_version",)) -> DataFrame:
    """``evaluate`` from the rows of ``score_counts``, which may come in parts."""
    names = [*COUNTS, "pos", "neg", "unscored"]
    return _evaluated(running_totals(counts, "__score", {n: F.sum(n) for n in names}, by), by)


def evaluation_rows(df: DataFrame, label: str, score: str, predicted: str, evaluated_at: Column) -> DataFrame:
    """``evaluate`` by model version, with the date of the evaluation; an unset version is 'unknown'."""
    versioned = df.withColumn("model_version", F.coalesce("model_version", F.lit("unknown")))
    return evaluate(versioned, label, score, predicted).withColumn("evaluation_date", evaluated_at)


def meets_recall(evaluation: DataFrame, threshold: float = settings.MIN_RECALL) -> DataFrame:
    return evaluation.withColumn("meets_threshold", F.col("recall") >= F.lit(float(threshold)))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share). The total is a sum over the classes, of which there are few."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", ratio_or_zero(F.col("n"), F.sum("n").over(Window.partitionBy(F.lit(0)))))


def positive_weight(df: DataFrame, label: str, boost: float = settings.POSITIVE_WEIGHT_BOOST) -> DataFrame:
    """Positive-class weight (negatives / positives) x boost; NULL when there are no positives."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("n_negative"), F.count_if(F.col(label) == 1).alias("n_positive")
    ).withColumn("scale_pos_weight", ratio(F.col("n_negative"), F.col("n_positive")) * F.lit(float(boost)))


def retention_summary(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Actual retention rate and predicted high-risk rate."""
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_customers"),
        ratio(F.count_if(F.col(label) == 0), n).alias("retention_rate"),
        ratio(F.count_if(F.col(score) >= F.lit(float(threshold))), n).alias("high_risk_rate"),
    )


def trend_summary(evaluations: DataFrame, threshold: float = settings.MIN_RECALL) -> DataFrame:
    """First and last recall, their difference, and the earliest date below the threshold."""
    return evaluations.agg(
        F.min_by("recall", "evaluation_date").alias("first_recall"),
        F.max_by("recall", "evaluation_date").alias("last_recall"),
        F.min(F.when(F.col("recall") < F.lit(float(threshold)), F.col("evaluation_date"))).alias("first_breach"),
        F.count(F.lit(1)).alias("n_evaluations"),
    ).withColumn("recall_drop", F.col("first_recall") - F.col("last_recall"))
