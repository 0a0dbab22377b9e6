"""Reproducible splits and samples driven by a hash of the key.

The hash depends on the key and the seed only, so a lost task recomputes the same split and the
number of partitions does not matter. Keys should be unique; equal keys stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import hash_below, key_hash
from tidemark.settings import ID_COLUMN, RANDOM_SEED, TEST_FRACTION

_DIGITS = (4, 8)  # of the hash, by which the last test row is narrowed down in two steps
_CLASSES = (0, 1)


def split_by_hash(
    df: DataFrame, key: str = ID_COLUMN, fraction: float = TEST_FRACTION, seed: int = RANDOM_SEED
) -> DataFrame:
    """Add ``is_test`` with about the given share in every class; no shuffle at all."""
    return df.withColumn("is_test", hash_below(key, seed, fraction))


def stratified_split(
    df: DataFrame, label: str, key: str = ID_COLUMN, fraction: float = TEST_FRACTION, seed: int = RANDOM_SEED
) -> DataFrame:
    """Add ``is_test`` with exactly round(fraction x n) rows of each class of a 0/1 label.

    Per class, the rows with the smallest hashes form the test set. Counting rows per leading
    digits of the hash finds the bucket that holds the last test row, in two steps; only that
    bucket (1 in 2**32 of a class) is ranked. All results are one row, so the table itself is
    neither joined nor shuffled. Unlabelled rows are never test rows.
    """
    hashed = df.withColumn("__hash", key_hash(key, seed))
    keys = hashed.select(F.col(label).alias("__class"), F.col(key).alias("__key"), "__hash").where(
        F.col("__class").isin(*_CLASSES)
    )

    def by_class(which: str, struct: str, name: str):
        picked = F.when(F.col(which) == _CLASSES[0], F.col(struct)[f"{name}{_CLASSES[0]}"])
        return picked.otherwise(F.col(struct)[f"{name}{_CLASSES[1]}"])

    def inside_of(places, digits: int) -> DataFrame:
        """The rows of the bucket found so far, with the number of test rows in it."""
        rows = keys.withColumn("__at", places).withColumn("__rest", by_class("__class", "__at", "rest"))
        return rows.where(F.substring("__hash", 1, digits) == by_class("__class", "__at", "bucket"))

    def located(rows: DataFrame, digits: int, wanted):
        """One row: per class the bucket that holds the wanted row, and its place there. There are at
        most 65536 buckets per class."""
        counts = rows.groupBy("__class", "__rest", F.substring("__hash", 1, digits).alias("__bucket")).agg(
            F.count(F.lit(1)).alias("n")
        )
        running = Window.partitionBy("__class").orderBy("__bucket")
        found = (
            counts.withColumn("upto", F.sum("n").over(running))
            .withColumn("wanted", wanted)
            .where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted")))
        )
        rest = F.col("wanted") - F.col("upto") + F.col("n")
        return found.agg(
            F.struct(
                *[F.max(F.when(F.col("__class") == c, F.col("__bucket"))).alias(f"bucket{c}") for c in _CLASSES],
                *[F.max(F.when(F.col("__class") == c, rest)).alias(f"rest{c}") for c in _CLASSES],
            )
        ).scalar()

    total = F.sum("n").over(Window.partitionBy("__class"))
    share = F.round(total * F.lit(float(fraction))).cast("bigint")
    places = located(keys.withColumn("__rest", F.lit(0).cast("bigint")), _DIGITS[0], share)
    places = located(inside_of(places, _DIGITS[0]), _DIGITS[1], F.col("__rest"))
    inside = (
        inside_of(places, _DIGITS[1])
        .groupBy("__class", "__hash", "__key", "__rest")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(
            "__upto", F.sum("n").over(Window.partitionBy("__class").orderBy("__hash", "__key"))
        )
        .where(F.col("__upto") >= F.col("__rest"))
    )
    place = F.struct(F.col("__hash").alias("h"), F.col("__key").alias("k"))
    cuts = inside.agg(
        F.struct(*[F.min(F.when(F.col("__class") == c, place)).alias(f"cut{c}") for c in _CLASSES])
    ).scalar()
    here = F.struct(F.col("__hash").alias("h"), F.col(key).alias("k"))
    return (
        hashed.withColumn("__cuts", cuts)
        .withColumn("is_test", F.coalesce(F.col(label).isin(*_CLASSES) & (here <= by_class(label, "__cuts", "cut")), F.lit(False)))
        .drop("__hash", "__cuts")
    )


def train_and_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(~F.col("is_test")).drop("is_test"), df.where("is_test").drop("is_test")


def sample_rows(df: DataFrame, n: int, key: str = ID_COLUMN, seed: int = RANDOM_SEED) -> DataFrame:
    """n random rows without replacement: the n smallest hashes, kept per task and then merged."""
    order = key_hash(key, seed)
    return df.orderBy(order, key).limit(n)


def first_rows(df: DataFrame, n: int, key: str = ID_COLUMN) -> DataFrame:
    """The first n rows by key; a table has no positions to slice by."""
    return df.orderBy(key).limit(n)
