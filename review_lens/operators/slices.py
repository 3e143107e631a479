"""Cutting an ordered table into numbered slices, as a feed sends it."""

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_lens.schema import SLICE_ROWS
from review_lens.session import scratch_dir


def slice_rows(rows: DataFrame, row_index="row_index", size=SLICE_ROWS) -> DataFrame:
    """Add `slice`, the number of the run of `size` rows that a row falls into."""
    return rows.withColumn("slice", F.expr(f"cast(`{row_index}` AS BIGINT) div {size}"))


def replay(sliced: DataFrame, cycles: int) -> DataFrame:
    """Send all slices `cycles` times: `tick` counts on while the slices wrap round.

    The number of slices is one aggregate over the table, joined back as a
    scalar subquery.
    """
    slices = sliced.select((F.max("slice") + 1).alias("n")).scalar()
    ticked = sliced.withColumn("cycle", F.explode(F.sequence(F.lit(0), F.lit(cycles - 1))))
    return ticked.withColumn("tick", F.col("cycle") * slices + F.col("slice")).drop("cycle")


def number_rows(rows: DataFrame, *order: str, path=None) -> DataFrame:
    """Add `row_index`, the position of each row in a unique order, from 0.

    A global `row_number` would sort the table in one task. Here the rows are
    ranged and sorted into files whose names follow the order; each row knows
    its place in its file, and a file's offset is the row count of the files
    before it. Only those counts, one per file, meet in one task. The table is
    written once, so a task that is run again cannot see another numbering. It is
    read when the result is: a caller that gives the `path` can delete it after that.
    """
    spark = rows.sparkSession
    path = path or scratch_dir(spark, "row-numbers")
    ranged = rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    ranged.write.option("maxRecordsPerFile", 0).parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    placed = stored.select(
        *rows.columns,
        F.expr(r"cast(regexp_extract(_metadata.file_name, r'^part-(\d+)', 1) AS INT)").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    counts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    # One row per file: bounded by the partition count of the write above.
    return (
        placed.join(F.broadcast(offsets), "_file")
        .withColumn("row_index", F.col("_offset") + F.col("_place"))
        .select("row_index", *rows.columns)
    )


def feed_records(sliced: DataFrame) -> DataFrame:
    """Give each outgoing row its record id and its time of sending.

    The ids are random: write the result once and read it back from there.
    """
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return sliced.withColumns({"id": F.uuid(), "date_time": now})


def feed_namespace(feed: str) -> uuid.UUID:
    """The name space of the ids of a publication."""
    return uuid.uuid5(uuid.NAMESPACE_URL, feed)


def derived_id(feed: str, *content: str, row_index="row_index") -> Column:
    """A version 5 UUID from a row's position and content: the same whenever it is published."""
    told = F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in content))
    name = F.concat(F.col(row_index).cast("string"), F.lit(":"), told)
    space = F.unhex(F.lit(feed_namespace(feed).hex))
    digits = F.sha1(F.concat(space, F.encode(name, "UTF-8")))
    part = lambda start, length: F.substring(digits, start, length)
    variant = F.conv(part(17, 1), 16, 10).cast("int") % 4
    return F.concat(
        part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"),
        F.element_at(F.array(*map(F.lit, "89ab")), variant + 1), part(18, 3), F.lit("-"), part(21, 12),
    )


def derived_records(sliced: DataFrame, feed: str) -> DataFrame:
    """Outgoing rows with ids that a second publication would give them too."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return sliced.withColumns({"id": derived_id(feed, "comment", "n_star", "label"), "date_time": now})
