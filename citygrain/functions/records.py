"""Frame-wide projections: published columns, types, JSON records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from citygrain.functions.numbers import finite, to_number


def project_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The listed columns that the frame has, in the listed order."""
    return df.select(*[F.col(f"`{name}`") for name in columns if name in df.columns])


def normalize_types(df: DataFrame, strings: Iterable[str] = (), numbers: Iterable[str] = ()) -> DataFrame:
    """Ids as strings, measures as doubles; what is not a number becomes NULL."""
    changes = {name: F.col(name).cast("string") for name in strings if name in df.columns}
    changes |= {name: to_number(F.col(name).cast("string")) for name in numbers if name in df.columns}
    return df.withColumns(changes) if changes else df


def nan_to_null(df: DataFrame) -> DataFrame:
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({name: finite(F.col(name)) for name in floating}) if floating else df


def to_records_json(df: DataFrame, name: str = "record") -> DataFrame:
    """One JSON object per row; missing values are written as null."""
    clean = nan_to_null(df)
    return clean.select(F.to_json(F.struct(*clean.columns), {"ignoreNullFields": "false"}).alias(name))


def distinct_options(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns).dropDuplicates()


def where_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose code starts with the prefix; NULL codes are dropped."""
    return df.where(F.col(column).startswith(prefix))
