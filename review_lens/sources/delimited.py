"""Delimited files with line breaks in their fields, split among tasks.

Whether a line begins a record depends on all quotes before it in its file. Their parity is counted
for each split, summed over the splits before, and then carried along the lines of a
split; records that take several lines, the others are complete as they are, are put
together by their number. A quote in a field must be doubled and the field quoted.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, split, place and text of every line; places grow along a split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _quotes(text: str) -> Column:
    return F.length(text) - F.length(F.replace(F.col(text), F.lit('"'), F.lit("")))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, record (numbered from 1 in each file) and value: the records as text.

    Lines are dealt out by split, and sorted within, twice: to count and to number. What is
    gathered in one place is a row a split, to sum parities and counts, and a record's own lines.
    """
    lines = _lines(spark, path).withColumn("odd", _quotes("value") % 2 == 1)
    along = Window.partitionBy("file", "split").orderBy("place")
    # Quotes of the split up to a line and before it. A split is what one task reads.
    upto = F.sum(F.col("odd").cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    placed = lines.withColumn("after", upto % 2).withColumn("before", (F.col("after") + F.col("odd").cast("int")) % 2)
    # A line begins a record where an even number of quotes stands before it: in the split itself, or
    # with an odd number before the split, the other way round.
    splits = placed.groupBy("file", "split").agg(
        F.sum(F.col("odd").cast("int")).alias("odds"),
        F.count_if(F.col("before") == 0).alias("even_starts"),
        F.count_if(F.col("before") == 1).alias("odd_starts"),
    )
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    turned = splits.withColumn("turn", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("turn") == 0, F.col("even_starts")).otherwise(F.col("odd_starts"))
    known = turned.withColumn("starts", starts).withColumn("first", F.coalesce(F.sum("starts").over(earlier), F.lit(0)))
    joined = placed.join(F.broadcast(known.select("file", "split", "turn", "first")), ["file", "split"])
    begins = F.col("before") == F.col("turn")
    ends = F.col("after") == F.col("turn")
    number = F.col("first") + F.sum(begins.cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    numbered = joined.select("file", number.alias("record"), "split", "place", "value", (begins & ends).alias("whole"))
    alone = numbered.where("whole").select("file", "record", "value")
    parts = numbered.where("NOT whole").groupBy("file", "record")
    # The lines of one record.
    parts = parts.agg(F.array_sort(F.collect_list(F.struct("split", "place", "value"))).alias("lines"))
    merged = parts.select("file", "record", F.array_join(F.col("lines.value"), "\n").alias("value"))
    return alone.union(merged).withColumn("value", F.regexp_replace("value", "\r(?=\n|$)", ""))


def read_split_csv(spark: SparkSession, path: str, schema: StructType, options: dict) -> DataFrame:
    """The rows of delimited files with a header, with `file` and `place`, which follow their order."""
    kept = {k: v for k, v in options.items() if k != "header"}
    records = read_records(spark, path).where((F.col("record") > 1) & (F.trim("value") != ""))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("value", fields, kept).alias("row")
    parsed = records.select("file", F.col("record").alias("place"), row)
    return parsed.select(*(f"row.{name}" for name in schema.fieldNames()), "file", "place")
