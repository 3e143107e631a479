"""JSON records in and out of topics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.schema import WIRE_SCHEMA


def parse_records(messages: DataFrame, stamp="ingestion_timestamp") -> DataFrame:
    """Parse a `value` column into reviews, keeping the raw text and a `reason`.

    `reason` is null for a usable record and otherwise says why the record must
    be set aside. Fields of the wrong type come out null, the others survive.
    """
    # Through `inline`, so that the text is parsed once per row: a filter on a
    # parsed field cannot slip below it and parse again.
    fields = [F.col(f.name).cast("string") for f in WIRE_SCHEMA.fields]
    reason = (
        F.when(F.coalesce(*fields).isNull(), F.lit("unparsable"))
        .when(F.col("id").isNull(), F.lit("missing id"))
        .when(F.col("comment").isNull(), F.lit("missing comment"))
    )
    value = messages.select(F.col("value").cast("string").alias("value"))
    parsed = value.select("value", F.inline(F.array(F.from_json("value", WIRE_SCHEMA))))
    return parsed.withColumns(
        {
            "reason": reason,
            "date_time": F.col("date_time").try_cast("timestamp"),
            stamp: F.current_timestamp(),
        }
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("value", "reason")


def rejected(parsed: DataFrame, stamp="ingestion_timestamp") -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason", stamp)


def as_messages(rows: DataFrame, key=None) -> DataFrame:
    """One (key, value) message per row, the value being the row as JSON.

    Times in a message have milliseconds, as Spark's JSON writer cuts them.
    """
    key_column = F.col(key).cast("string") if key else F.lit(None).cast("string")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return rows.select(key_column.alias("key"), F.to_json(F.struct(*columns)).alias("value"))


def from_messages(messages: DataFrame, schema, *keep: str) -> DataFrame:
    """Decode JSON values written by `as_messages`; `keep` names columns to keep beside."""
    return messages.select(*keep, F.from_json("value", schema).alias("data")).select(*keep, "data.*")
