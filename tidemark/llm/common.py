"""What several of the operators share: opening tables, batches of bounded size, staged tables, digests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import new_folder
from tidemark.sources.storage import remove

BATCH_BYTES = 4 << 20  # of text that a Python task holds as one piece of work; a longer text is a piece of its own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema(table: DataFrame, rest: str, key: str = "doc_id") -> T.StructType:
    """The key column of a table, whatever its type, and further columns in DDL."""
    return T.StructType([T.StructField(key, table.schema[key].dataType), *T.StructType.fromDDL(rest).fields])


def whole_rows(table: DataFrame) -> Column:
    """All columns as one struct, for operators that give back the key they were given."""
    return F.struct(*(F.col(f"`{c}`") for c in table.columns))


def as_bytes(text: str) -> Column:
    """The UTF-8 bytes of a text column, so that tasks need not decode and encode."""
    return F.col(text).cast("binary")


_HELD: dict[str, Callable[[], None]] = {}  # what this Python worker keeps from task to task, and how to let go


def hold(holder: str, release: Callable[[], None]) -> None:
    """Keep something in this worker until an operator of another name works in it."""
    _HELD[holder] = release


def pieces(batches: Iterator[pa.RecordBatch], text: int = 1, limit: int = BATCH_BYTES, holder: str = "") -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose column ``text`` has about ``limit`` bytes at most, but one row at least.
    What other operators hold in this worker goes."""
    for name in [n for n in _HELD if n != holder]:
        _HELD.pop(name)()
    for batch in batches:
        start, total = 0, 0
        for i, n in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
            if i > start and total + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n or 0
        if batch.num_rows > start:
            yield batch.slice(start)


# While a table is staged: its shuffle files go with the end of the write, as nothing reads them again, and
# batches for Python are small, as a row may be a long text.
WHILE_STAGING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def _write(df: DataFrame, path: str) -> None:
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in WHILE_STAGING}
    try:
        for k, v in WHILE_STAGING.items():
            conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The table written to the shared folder and opened again: lineage ends here, and a lost executor
    costs no recomputation of what came before. The files stay until the folder is cleaned, as later
    lazy reads need them."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    _write(df, path)
    return spark.read.schema(df.schema).parquet(path)


class Staging:
    """Staged tables that go when they are no longer needed."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def put(self, df: DataFrame, purpose: str) -> DataFrame:
        path = new_folder(self.spark, purpose)
        _write(df, path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path, table
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            remove(self.spark, self.paths.pop(id(table))[0])


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Whether the CRC32 of a key as text has the remainder; a null key is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
