"""Atomic commits for a folder of batches.

Data is written first, into a folder of its own for each batch, which nobody reads yet. One small file then names all batches
that count. Its name is the next number, and it appears whole or not at all and never replaces another, so that of two
writers who start from the same state one has to look at what the other has added and try again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.storage import create_once, empty, names_in, read_text

State = dict[str, list[str]]


class Conflict(Exception):
    """Another writer has committed first."""


class Commits:
    """The commits under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = f"{self.root}/_commits"

    def current(self) -> tuple[int, State]:
        """The number of the last commit (0: none) and the batches of every table that it names."""
        numbers = [int(n) for n in names_in(self.spark, self.folder) if n.isdigit()]
        if not numbers:
            return 0, {}
        return max(numbers), json.loads(read_text(self.spark, f"{self.folder}/{max(numbers):012d}"))

    def commit(self, seen: int, state: State) -> None:
        """Make a state the current one, if ``seen`` still is the last commit."""
        if not create_once(self.spark, f"{self.folder}/{seen + 1:012d}", json.dumps(state)):
            raise Conflict(f"commit {seen + 1} of {self.root} is taken")

    def add(self, **batches: list[str]) -> None:
        """Add batches that no other writer's can be at odds with."""
        while True:
            seen, state = self.current()
            try:
                return self.commit(seen, state | {t: state.get(t, []) + new for t, new in batches.items()})
            except Conflict:
                continue

    def write(self, df: DataFrame, table: str, by: str) -> str:
        """The name of a new batch with these rows, partitioned by a date. It is not seen before it is committed."""
        batch = uuid.uuid4().hex
        # rows of a date together, in files of the advised size: adaptive execution splits a date that holds a large share of them
        df.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(f"{self.root}/{table}/batch={batch}")
        return batch

    def read(self, table: str, schema: T.StructType, batches: list[str] | None = None) -> DataFrame:
        """The rows of the committed batches of a table, or of the named ones."""
        if batches is None:
            batches = self.current()[1].get(table, [])
        if not batches:
            return empty(self.spark, schema)
        paths = [f"{self.root}/{table}/batch={b}" for b in batches]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths).select(*schema.names)

