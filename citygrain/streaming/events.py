"""Sales as a stream of JSON events, and the sales aggregate kept up to date from it.

A micro-batch adds its new events to a table, and the figures of the groups it touched are worked
out from that table by the very operator that serves the batch side; the table is partitioned by
group, so other groups are not read. Medians cannot be updated from partial results, and one district
may hold a third of all events: the batch operator copes with both, while a streaming aggregate would
hold every value of a district in the state of one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citygrain.operators.medians import HOT_GROUP_ROWS
from citygrain.operators.sales import DISTRICT_KEYS, sales_metrics
from citygrain.sources import versions
from citygrain.sources.store import Store

# Keys that every event must have, in the order they are written.
EVENT_FIELDS = {
    "arrondissement": "int",
    "year": "int",
    "transaction_id": "string",
    "price_per_m2": "double",
    "sale_value_eur": "double",
    "built_surface_m2": "double",
    "rooms": "double",
    "Type local": "string",
}
EVENT_SCHEMA = ", ".join(f"`{name}` {kind}" for name, kind in EVENT_FIELDS.items())
STREAM_TABLE = "stream_sales_yearly"
#: Column that orders the records of a stream by arrival.
ARRIVAL = "_arrival"
#: Groups that a micro-batch may name one by one to prune the table; more of them are joined.
LISTED_GROUPS = 2000
#: Folders of single micro-batches at most, before they are rewritten as one.
MOST_BATCHES = 16


def to_event_records(sales: DataFrame, limit: int | None = None) -> DataFrame:
    """Sales as (key, value) records; a limit takes the first ones in transaction order."""
    events = sales.select(*[F.col(f"`{name}`") for name in EVENT_FIELDS])
    if limit is not None:
        events = events.orderBy("transaction_id", *[f"`{name}`" for name in EVENT_FIELDS]).limit(limit)
    return events.select(
        F.col("arrondissement").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(f"`{name}`") for name in EVENT_FIELDS]), {"ignoreNullFields": "false"}).alias("value"),
    )


def read_event_stream(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """A stream of ``value`` and ``_arrival``: ``kafka`` from the earliest offset, or text files.

    Records arrive by partition and offset, or by age and name of their file and line in it.
    """
    reader = spark.readStream.format(source).options(**options)
    if source == "kafka":
        reader = reader.option("startingOffsets", options.get("startingOffsets", "earliest"))
        arrival = F.struct("partition", "offset").alias(ARRIVAL)
        return reader.load().select(F.col("value").cast("string").alias("value"), "timestamp", arrival)
    lines = reader.load().select(
        "value",
        F.col("_metadata.file_modification_time").alias("age"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    # A task reads a piece of a file from its start: a running number keeps the order of its lines.
    counted = lines.mapInArrow(_with_line, "value string, age timestamp, file string, block bigint, line bigint")
    return counted.select("value", F.struct("age", "file", "block", "line").alias(ARRIVAL))


def _with_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = 0
    for batch in batches:
        line = pa.array(range(first, first + batch.num_rows), pa.int64())
        first += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, line], names=[*batch.schema.names, "line"])


def parse_events(records: DataFrame) -> DataFrame:
    """Typed events; one that lacks a key is refused, one whose key holds null is not."""
    keys = F.json_object_keys("value")
    complete = F.size(F.array_except(F.array(*[F.lit(name) for name in EVENT_FIELDS]), keys)) == 0
    others = [name for name in records.columns if name != "value"]
    return (
        records.where(complete)
        .select(*others, F.from_json("value", EVENT_SCHEMA).alias("_e"))
        .select(*others, "_e.*")
    )


def dedupe_events(events: DataFrame, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """First arrival per transaction. Without a delay ids, and their first events, are kept for ever.

    The event that is first in ``_arrival`` stays, inside a micro-batch as well; without that column,
    or among equal ones, the event least in its other columns does. An id was seen before if its first event is
    older than the micro-batch. With an event time and a delay, an id is forgotten once the watermark
    has passed it: the state stays bounded, a copy that comes later than that counts as new, and of
    copies inside one micro-batch any may stay.
    """
    if event_time and delay:
        return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["transaction_id"])
    others = [F.col(f"`{name}`") for name in events.columns if name not in ("transaction_id", ARRIVAL)]
    order = F.col(ARRIVAL) if ARRIVAL in events.columns else F.lit(0)
    first = F.min(F.struct(order.alias("order"), F.struct(*others).alias("event")))
    # One time per micro-batch, the same when it is run again.
    now = F.current_timestamp()
    ids = events.withColumn("_now", now).groupBy("transaction_id").agg(first.alias("_first"), F.min("_now").alias("_seen"))
    return ids.where(F.col("_seen") == now).select("transaction_id", "_first.event.*")


def accept(records: DataFrame, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    return dedupe_events(parse_events(records), event_time, delay).select(*[F.col(f"`{name}`") for name in EVENT_FIELDS])


def accepted_events(spark: SparkSession, folder: str) -> DataFrame:
    """All events accepted so far, with the ``batch_id`` that brought each."""
    merged = versions.numbers(spark, folder, "merged")
    upto = merged[-1] if merged else -1
    newer = [number for number in versions.numbers(spark, folder, "batch_id") if number > upto]
    schema = f"{EVENT_SCHEMA}, batch_id bigint"
    parts = []
    if merged:
        parts.append(spark.read.schema(schema).parquet(f"{folder}/merged={upto}"))
    if newer or not merged:
        reader = spark.read.schema(schema).option("basePath", folder)
        parts.append(reader.parquet(*([f"{folder}/batch_id={number}" for number in newer] or [f"{folder}/batch_id=*"])))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _compact(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Rewrite the events of all batches before this one as one part per group, once there are MOST_BATCHES of them.

    Only the last batch may be run again, so the ones before it don't change any more. The folders that the
    rewriting before this one took in go now, when nobody reads them.
    """
    merged = versions.numbers(spark, folder, "merged")
    upto = merged[-1] if merged else -1
    old = [number for number in versions.numbers(spark, folder, "batch_id") if upto < number < batch_id]
    if len(old) < MOST_BATCHES:
        return
    rows = accepted_events(spark, folder).where(F.col("batch_id") <= old[-1])
    rows.hint("rebalance", *DISTRICT_KEYS).write.mode("overwrite").partitionBy(*DISTRICT_KEYS).parquet(f"{folder}/merged={old[-1]}")
    versions.drop(spark, folder, "batch_id", upto)
    versions.drop(spark, folder, "merged", upto - 1)


def stream_metrics(spark: SparkSession, folder: str, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """The sales aggregate over all events accepted so far."""
    return sales_metrics(accepted_events(spark, folder), DISTRICT_KEYS, hot_rows=hot_rows)


def _group() -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in DISTRICT_KEYS])


def _update(store: Store, folder: str, batch: DataFrame, batch_id: int) -> None:
    """Add a micro-batch to the accepted events and publish its groups anew, the others as they were."""
    spark = batch.sparkSession
    part = f"{folder}/batch_id={batch_id}"
    _compact(spark, folder, batch_id)
    batch.hint("rebalance", *DISTRICT_KEYS).write.mode("overwrite").partitionBy(*DISTRICT_KEYS).parquet(part)
    accepted = accepted_events(spark, folder)
    touched = accepted.where(F.col("batch_id") == batch_id).select(_group().alias("_touched")).distinct()
    listed = [row[0] for row in touched.limit(LISTED_GROUPS + 1).collect()]
    if not listed:
        return
    published = store.read(STREAM_TABLE) if store.exists(STREAM_TABLE) else None
    if len(listed) <= LISTED_GROUPS:  # a filter on partitions: nothing else is read
        inside = _group().isin(listed)
        again, kept = accepted.where(inside), published and published.where(~inside)
    else:
        same = _group() == F.col("_touched")
        again = accepted.join(touched, same, "left_semi")
        kept = published and published.join(touched, same, "left_anti")
    fresh = sales_metrics(again, DISTRICT_KEYS)
    if kept is not None:
        fresh = kept.unionByName(fresh)
    # Read from the version before, so written beside it; a reader in between finds that one whole.
    store.replace(STREAM_TABLE, fresh)


def start_stream(
    events: DataFrame,
    store: Store,
    folder: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    max_events: int | None = None,
) -> StreamingQuery:
    """Accept events and publish ``stream_sales_yearly`` after every micro-batch.

    How many events a micro-batch holds is set at the source (``maxOffsetsPerTrigger`` or
    ``maxFilesPerTrigger``). A batch that is run again replaces its own part of the table, so
    nothing is counted twice. ``max_events`` is where accepting ends, over all micro-batches; the last
    ones are taken by a limit, which one task ends.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        if max_events is not None:
            before = 0
            if batch_id > 0:
                before = accepted_events(batch.sparkSession, folder).where(F.col("batch_id") < batch_id).count()
            batch = batch.limit(max(max_events - before, 0))
        _update(store, folder, batch, batch_id)

    writer = events.writeStream.outputMode("update").foreachBatch(publish).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def run_bounded(
    events: DataFrame, store: Store, folder: str, checkpoint: str, max_events: int | None = None, timeout: int = 600
) -> bool:
    """Take everything that is there, publish a last time and stop; True when it ended in time."""
    query = start_stream(events, store, folder, checkpoint, {"availableNow": True}, max_events)
    ended = query.awaitTermination(timeout)
    if not ended:
        query.stop()
    return ended
