"""Folders that are replaced as a whole: each version is a folder of its own, and the last complete one counts.

Spark marks a folder that it has written to the end. So a reader finds the old rows or the new ones, whenever it
looks; the version before stays until the next one is complete, for those that are reading it still.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DONE = "_SUCCESS"


def _system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the complete folders ``prefix=<number>`` under ``folder``, rising."""
    system, path = _system(spark, folder)
    if not system.exists(path):
        return []
    make = spark._jvm.org.apache.hadoop.fs.Path
    named = [entry.getPath() for entry in system.listStatus(path) if entry.getPath().getName().startswith(f"{prefix}=")]
    done = [child.getName() for child in named if system.exists(make(child, DONE))]
    return sorted(int(name.removeprefix(f"{prefix}=")) for name in done)


def drop(spark: SparkSession, folder: str, prefix: str, upto: int) -> None:
    """Delete the complete folders with numbers up to ``upto``."""
    system, _ = _system(spark, folder)
    for number in numbers(spark, folder, prefix):
        if number <= upto:
            system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}={number}"), True)


def replace(df: DataFrame, folder: str, prefix: str = "version") -> str:
    """Write a new version of ``folder``; the one before it stays, older ones go."""
    spark = df.sparkSession
    known = numbers(spark, folder, prefix)
    target = f"{folder}/{prefix}={known[-1] + 1 if known else 0}"
    df.write.mode("overwrite").parquet(target)
    if known:
        drop(spark, folder, prefix, known[-1] - 1)
    return target


def latest(spark: SparkSession, folder: str, prefix: str = "version") -> str | None:
    known = numbers(spark, folder, prefix)
    return f"{folder}/{prefix}={known[-1]}" if known else None
