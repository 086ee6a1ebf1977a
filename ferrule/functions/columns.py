"""Column-level helpers: schema selection, NaN handling, safe division, hashing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of numeric columns, schema order (the ``select_dtypes('number')`` rule)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in skip]


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN is the missing marker in array-land; Spark aggregates only skip NULL."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    targets = [c for c in (cols or df.columns) if c in fl]
    return df.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in targets})


def safe_div(num, den) -> Column:
    """Division that yields NULL on a zero denominator instead of raising under ANSI."""
    return F.try_divide(col(num), col(den))


def div_or(num, den, fallback: float = 0.0) -> Column:
    """num/den, ``fallback`` when den is 0 (the ``if d != 0 else 0`` rule)."""
    return F.coalesce(safe_div(num, den), F.lit(fallback))


def portable_hash(c, seed: int | str = 42) -> Column:
    """First 32 bits of md5(str(id) || seed) as BIGINT; reproducible in DuckDB as
    ``('0x'||substr(md5(cast(id as varchar)||seed),1,8))::BIGINT``."""
    s = F.concat(col(c).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def rounded(c, digits: int = 6) -> Column:
    return F.round(col(c).cast("double"), digits)


def round_all(df: DataFrame, digits: int = 6, cols: Iterable[str] | None = None) -> DataFrame:
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    targets = [c for c in (cols or df.columns) if c in dbl]
    return df.withColumns({c: F.round(F.col(c), digits) for c in targets})
