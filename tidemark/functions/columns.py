"""Small column expressions used by several operators. All of them stay JVM-side."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_DIGITS = 15
HASH_BITS = 4 * HASH_DIGITS


def flag(condition: Column) -> Column:
    """0/1 flag in which an unknown condition counts as false."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL instead of raising on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in the floating-point columns (all of them by default)."""
    floating = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (columns is None or f.name in columns)
    ]
    if not floating:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def key_hash(key: str | Column, seed: int) -> Column:
    """Hash of a key and a seed as fixed-width hexadecimal text, the same on every engine that has
    md5. Its text order is its numeric order, so ranking by it needs no conversion."""
    key = F.col(key) if isinstance(key, str) else key
    return F.substring(F.md5(F.concat(key.cast("string"), F.lit(str(seed)))), 1, HASH_DIGITS)


def hash_below(key: str | Column, seed: int, fraction: float) -> Column:
    """Whether the hash falls into the lowest ``fraction`` of its range: no row at 0, every row at 1."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be between 0 and 1")
    if fraction == 1.0:  # the bound would have one digit more than the hash
        return F.lit(True)
    return key_hash(key, seed) < F.lit(format(math.ceil(fraction * (1 << HASH_BITS)), f"0{HASH_DIGITS}x"))


def key_uniform(key: str | Column, seed: int) -> Column:
    """Reproducible uniform number in [0, 1) that depends on the key only, not on partitioning."""
    return F.conv(key_hash(key, seed), 16, 10).cast("bigint") / F.lit(float(1 << HASH_BITS))


def right_closed_bin(value: Column, inner_edges: list[float | Column]) -> Column:
    """Index of the bin (edge[i-1], edge[i]]: the number of inner edges strictly below the value."""
    below = F.lit(0)
    for edge in inner_edges:
        below = below + ((edge if isinstance(edge, Column) else F.lit(float(edge))) < value).cast("int")
    return below


def interpolate(low: Column, high: Column, weight: Column) -> Column:
    """Linear interpolation that is exact when both ends are equal and symmetric in its ends."""
    step = high - low
    return F.when(weight >= 0.5, high - step * (1 - weight)).otherwise(low + step * weight)


def sql_string(value: str) -> str:
    """A string literal for a SQL expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_double(value: float) -> str:
    """A double literal for a SQL expression."""
    return f"{float(value)!r}D"


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
