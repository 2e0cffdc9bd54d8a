"""Published tables, feature collections and documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citygrain.operators import sales
from citygrain.plans.catalog import DOCUMENTS, FEATURE_COLLECTIONS, TABLES
from citygrain.session import staged
from citygrain.sources import versions

INSERT_BATCH = 1000
FEATURE_FIELDS = ("feature_index", "geometry")

#: Keys that the published sales of a grain are in order of.
GRAIN_ORDER = {
    "sales": sales.DISTRICT_KEYS,
    "sales_quartier": sales.QUARTIER_KEYS,
    "sales_iris": sales.IRIS_KEYS,
    "sales_street": sales.STREET_KEYS,
    "sales_building": sales.BUILDING_KEYS,
}


@dataclass(frozen=True)
class Store:
    """Where results live: parquet folders under ``root``, or tables of ``database`` in the catalog."""

    spark: SparkSession
    root: str | None = None
    database: str | None = None

    def _target(self, name: str) -> str:
        if self.root is not None:
            return f"{self.root.rstrip('/')}/{name}"
        return f"{self.database}.{name}" if self.database else name

    def write(self, name: str, df: DataFrame) -> str:
        """Replace a whole table; returns where it went."""
        target = self._target(name)
        if self.root is not None:
            df.write.mode("overwrite").parquet(target)
        else:
            df.write.mode("overwrite").saveAsTable(target)
        return target

    def replace(self, name: str, df: DataFrame) -> str:
        """Replace a table that others are reading: they see the rows of before or the new ones."""
        return versions.replace(df, self._target(name)) if self.root is not None else self.write(name, df)

    def write_ordered(self, name: str, df: DataFrame, *order: str) -> str:
        """Replace a whole table by files in order: each holds a range of the keys, and its rows are sorted.

        No task sees all rows; a reader of the files one by one, by name, sees the whole order. The rows are staged
        first: the ranges come from a sample, which would work them all out a second time.
        """
        return self.write(name, staged(df, "unordered").repartitionByRange(*order).sortWithinPartitions(*order))

    def read_ordered(self, name: str, position: str = "position") -> DataFrame:
        """A table of files with the place of every row, from 0, in the order of files and of rows in them."""
        rows = self.read(name).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
        before = Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
        starts = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
        return rows.join(F.broadcast(starts), "_file").withColumn(position, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")

    def read(self, name: str) -> DataFrame:
        target = self._target(name)
        if self.root is None:
            return self.spark.table(target)
        return self.spark.read.parquet(versions.latest(self.spark, target) or target)

    def exists(self, name: str) -> bool:
        if self.root is None:
            return self.spark.catalog.tableExists(self._target(name))
        try:
            self.read(name)
        except AnalysisException:
            return False
        return True

    def write_features(self, name: str, df: DataFrame) -> str:
        """Replace a feature collection: index, geometry, properties, time of writing."""
        properties = [column for column in df.columns if column not in (*FEATURE_FIELDS, "rings", "parts")]
        return self.write(
            name,
            df.select(*FEATURE_FIELDS, F.struct(*properties).alias("properties"), F.current_timestamp().alias("updated_at")),
        )

    def read_features(self, name: str) -> DataFrame:
        """Features in their order, properties as columns."""
        return self.read(name).select(*FEATURE_FIELDS, "properties.*").orderBy("feature_index")


def write_jdbc(df: DataFrame, url: str, name: str, **properties: str) -> str:
    """Replace a table of a relational database, in insert batches."""
    df.write.mode("overwrite").option("batchsize", INSERT_BATCH).jdbc(url, name, properties=dict(properties))
    return name


def read_jdbc(spark: SparkSession, url: str, name: str, **properties: str) -> DataFrame:
    return spark.read.jdbc(url, name, properties=dict(properties))


def publish_all(store: Store, outputs: dict[str, DataFrame]) -> dict[str, str]:
    """Write every published output; returns dataset name to target.

    ``outputs`` is keyed by gold name. A silver table holds the rows of its gold twin: it is
    copied from the written twin, so nothing is worked out twice. Sales by a grain lie in order of its keys.
    """
    def put(name: str, target: str, df: DataFrame) -> None:
        keys = GRAIN_ORDER.get(name.split("_", 1)[1])
        targets[name] = store.write_ordered(target, df, *keys) if keys else store.write(target, df)

    targets: dict[str, str] = {}
    for name, target in TABLES.items():
        if name.startswith("gold_"):
            put(name, target, outputs[name])
    for name, target in TABLES.items():
        if name.startswith("silver_"):
            put(name, target, store.read(TABLES["gold_" + name.removeprefix("silver_")]))
    for name, target in FEATURE_COLLECTIONS.items():
        targets[name] = store.write_features(target, outputs[name])
    for name, target in DOCUMENTS.items():
        targets[name] = store.write(target, outputs[name])
    return targets
