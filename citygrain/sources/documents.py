"""Features of one large GeoJSON document, read by many tasks.

A document is cut at every closing brace, wherever that stands, so that any split of the file can be read
alone. Whether a cut lies inside a string, how deep it lies, and how many features end before it, are prefix
sums over the cuts: of quotes, of brackets outside strings, and of returns to the depth of the feature
list. The sums are associative, so they run inside the pieces of the file and over the totals of the pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citygrain.session import staged

#: Depth of the list of features: the document, then the list.
LIST_DEPTH = 2

c = F.col


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _with_sum(chunks: DataFrame, value: Column, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over all chunks of the file before each one."""
    valued = chunks.withColumn("_value", value)
    inside = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    pieces = valued.groupBy("file", "block").agg(F.sum("_value").alias("_total"))  # one row per piece of a file
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("file", "block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    summed = valued.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    joined = summed.join(F.broadcast(starts), ["file", "block"])
    return joined.withColumn(name, c("_start") + c("_inside")).drop("_value", "_inside", "_start")


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, text): every object of the list ``features`` of each document, in its order."""
    raw = spark.read.option("lineSep", "}").text(path)
    place = (c("_metadata.file_path").alias("file"), c("_metadata.file_block_start").alias("block"))
    chunks = staged(raw.select(*place, F.monotonically_increasing_id().alias("line"), c("value").alias("text")), "chunks")
    # Escaped characters end no string.
    plain = F.regexp_replace("text", r"(?s)\\.", "")
    quoted = _with_sum(chunks.withColumn("_plain", plain), _count(c("_plain"), '"'), "_quotes")
    # What is outside strings: the start of a chunk may be the rest of a string, its end the start of one.
    outside = F.when(c("_quotes") % 2 == 1, F.concat(F.lit('"'), c("_plain"))).otherwise(c("_plain"))
    outside = F.regexp_replace(outside, r'(?s)"[^"]*("|$)', "")
    closes = (c("_quotes") + _count(c("_plain"), '"')) % 2 == 0  # the brace behind the chunk is outside strings
    bare = quoted.select("file", "block", "line", "text", outside.alias("_outside"), closes.alias("_closes"))
    deeper = F.length(F.translate("_outside", "]}", "")) - F.length(F.translate("_outside", "]}[{", ""))
    higher = F.length(F.translate("_outside", "[{", "")) - F.length(F.translate("_outside", "]}[{", ""))
    bare = staged(bare.select("file", "block", "line", "text", "_closes", (deeper - higher - c("_closes").cast("int")).alias("_change")), "depths")
    deep = _with_sum(bare, c("_change"), "_depth")
    ends = c("_closes") & (c("_depth") + c("_change") == LIST_DEPTH)
    counted = _with_sum(deep.withColumn("_ends", ends), c("_ends").cast("int"), "place")
    piece = F.struct("block", "line", "text", "_depth")
    whole = counted.groupBy("file", "place").agg(F.sort_array(F.collect_list(piece)).alias("_pieces"), F.bool_or("_ends").alias("_whole"))
    text = F.concat(F.array_join(F.transform("_pieces", lambda one: one["text"]), "}"), F.lit("}"))
    objects = whole.where("_whole").select("file", "place", c("_pieces")[0]["_depth"].alias("_depth"), text.alias("_text"))
    # Inside the list an object follows a comma; the first one follows the name of the list.
    follows = F.regexp_extract("_text", r"(?s)^[\s,]*(\{.*)$", 1)
    listed = F.regexp_extract("_text", r'(?s)^.*?"features"\s*:\s*\[\s*(\{.*)$', 1)
    text = F.when((c("_depth") == LIST_DEPTH) & (follows != ""), follows).otherwise(listed)
    return objects.select("file", "place", text.alias("text")).where("text <> ''")
