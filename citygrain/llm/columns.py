"""Operators that hand on all columns of a table work under names that can't clash."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.session import estimated_bytes


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def plain_names(docs: DataFrame, needed: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but the needed ones renamed by number, and what gives the names back."""
    names = [(name, name if name in needed else f"_column_{place}") for place, name in enumerate(docs.columns)]
    plain = docs.select(*(F.col(quoted(name)).alias(other) for name, other in names))
    return plain, lambda frame: frame.select(*(F.col(other).alias(name) for name, other in names))


def text_volume(docs: DataFrame) -> int:
    """About how many bytes ``docs`` takes: Spark's estimate for files, else the bytes of its texts."""
    estimate = estimated_bytes(docs)
    if estimate < 1 << 55:  # Spark's default for what it can't tell lies above
        return estimate
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
