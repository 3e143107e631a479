"""Lists that follow their topics: the newest predictions, and metrics without repeats."""

import json
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from review_lens.functions.records import from_messages
from review_lens.operators.views import (
    METRICS_HISTORY,
    METRICS_VIEW,
    PREDICTION_VIEW,
    RECENT_PREDICTIONS,
)
from review_lens.schema import METRICS_SCHEMA, PREDICTION_SCHEMA
from review_lens.session import children, remove, write_text
from review_lens.sources.files import read_or_empty
from review_lens.sources.topics import Topic, stream_messages

#: Groups of ids that each keep a list of their own; they meet when the list is read.
SHARDS = 16
#: Bytes of an Arrow batch that a worker is given, a longer row aside.
BATCH_BYTES = 8 << 20
#: Newest batches of the list that stay for readers.
KEPT = 3

_LIST = "shard INT, id STRING, at BIGINT, label STRING, body STRING"
_BODY = "comment STRING, n_star INT, label STRING, predicted_label STRING"
# Stands for no time at all, older than any.
_NEVER = -(1 << 62)


def _newest_rows(rows: pd.DataFrame, limit: int) -> pd.DataFrame:
    """The newest row of each id; of those the newest `limit`, by time, then id."""
    known = rows.assign(told=rows["label"].notna(), text=rows["label"].fillna(""))
    once = known.sort_values(["at", "told", "text"], kind="stable").drop_duplicates("id", keep="last")
    first = once.assign(back=-once["at"]).sort_values(["back", "id"], kind="stable").head(limit)
    return first[["id", "at", "label", "body"]].astype({"at": "int64"})


def _newest(rows: pa.Table, limit: int) -> np.ndarray:
    """Places of the rows that `_newest_rows` would keep of each shard; bodies aren't looked at."""
    slim = rows.select(["shard", "id", "at", "label"]).to_pandas()
    known = slim.assign(told=slim["label"].notna(), text=slim["label"].fillna(""))
    once = known.sort_values(["at", "told", "text"], kind="stable").drop_duplicates(["shard", "id"], keep="last")
    first = once.assign(back=-once["at"]).sort_values(["shard", "back", "id"], kind="stable")
    return first.groupby("shard", sort=False).head(limit).index.to_numpy()


def _fewer(limit: int):
    def fewer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What one task's rows can add to the lists: each shard's newest `limit`, cut down after every batch."""
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            held = rows.take(_newest(rows, limit)).combine_chunks()
        if held is not None:
            yield from held.to_batches()

    return fewer


def _fold(limit: int):
    def fold(key, frames, state: GroupState):
        """One shard: what it held and what came, cut down after every block of rows."""
        columns = ["id", "at", "label", "body"]
        held = pd.DataFrame(json.loads(state.get[0]) if state.exists else [], columns=columns)
        for frame in frames:
            came = _newest_rows(frame[columns], limit)
            held = came if held.empty else _newest_rows(pd.concat([held, came], ignore_index=True), limit)
        rows = held.astype(object).where(held.notna(), None)
        state.update((json.dumps(rows.values.tolist()),))
        yield rows.assign(shard=key[0])[["shard", *columns]].astype({"shard": "int32", "at": "int64"})

    return fold


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in children(spark, path) if n.isdigit() and "_SUCCESS" in children(spark, f"{path}/{n}"))


def start_recent(
    spark: SparkSession,
    topic: Topic,
    path: str,
    checkpoint: str,
    limit=RECENT_PREDICTIONS,
    shards=SHARDS,
    trigger=None,
):
    """Keep the newest predictions of a topic as a list under `path`.

    Each shard of ids keeps its newest `limit` in the stream's state, one row per review, so repeated
    and late messages change nothing that they shouldn't and the state is bounded.
    Every micro-batch writes the lists of all shards anew, `shards` * `limit` rows at most.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = from_messages(stream_messages(spark, topic), PREDICTION_SCHEMA).where("id IS NOT NULL")
    body = F.to_json(F.struct("comment", "n_star", "label", "predicted_label"))
    slim = rows.select(
        F.pmod(F.hash("id"), F.lit(shards)).cast("int").alias("shard"),
        "id",
        F.coalesce(F.unix_micros("processing_timestamp"), F.lit(_NEVER)).alias("at"),
        F.col("predicted_label").alias("label"),
        body.alias("body"),
    )
    # Only what may be on a list is shuffled; a worker holds a small batch of texts besides.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    slim = slim.mapInArrow(_fewer(limit), slim.schema)
    lists = slim.groupBy("shard").applyInPandasWithState(
        _fold(limit), _LIST, "held STRING", "update", GroupStateTimeout.NoTimeout
    )

    def write(changed: DataFrame, batch_id: int):
        before = [n for n in _versions(spark, path) if n < batch_id]
        changed.persist()
        try:
            if before:
                held = spark.read.schema(_LIST).parquet(f"{path}/{before[-1]}")
                touched = [r.shard for r in changed.select("shard").distinct().collect()]
                changed = changed.union(held.where(~F.col("shard").isin(touched)))
            changed.coalesce(1).write.mode("overwrite").parquet(f"{path}/{batch_id}")
        finally:
            changed.unpersist()
        for old in before[: -(KEPT - 1)]:
            remove(spark, f"{path}/{old}")

    writer = lists.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def recent(spark: SparkSession, path: str, limit=RECENT_PREDICTIONS) -> DataFrame:
    """The list as of the last micro-batch, in the columns of `views.recent_predictions`."""
    found = _versions(spark, path)
    rows = read_or_empty(spark, f"{path}/{found[-1] if found else 'none'}", _LIST)
    newest = rows.orderBy(F.col("at").desc(), "id").limit(limit)
    time = F.when(F.col("at") != _NEVER, F.timestamp_micros("at")).alias("processing_timestamp")
    return newest.select(time, F.from_json("body", _BODY).alias("b")).select(
        *(c if c == "processing_timestamp" else f"b.{c}" for c in PREDICTION_VIEW)
    )


class _LateRows(StreamingQueryListener):
    """Notes how many rows each micro-batch of one query came behind its watermark."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        if progress.name == self.name and late:
            said = json.dumps({"run": str(progress.id), "batch": progress.batchId, "rows": late})
            write_text(self.spark, f"{self.path}/{progress.id}-{progress.batchId}", said)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def start_history(
    spark: SparkSession, topic: Topic, path: str, late: str, checkpoint: str, patience="1 hour", trigger=None
):
    """Follow a metrics topic without repeats: of a stream's batch that is measured more than once
    within `patience` the first measurement is kept, under `path`.

    State is held for `patience` behind the newest stamp. What comes later than that can't be told
    from a repeat any more: it's left out, and counted in the folder `late`.
    """
    rows = from_messages(stream_messages(spark, topic), METRICS_SCHEMA, "key")
    stamped = rows.withColumn("stamp", F.col("timestamp").try_cast("timestamp"))
    # A message without a stamp has none to be late by; it counts as old as can be.
    stamped = stamped.withColumn("stamp", F.coalesce("stamp", F.timestamp_seconds(F.lit(0))))
    named = stamped.withColumn("key", F.coalesce("key", F.lit("")))
    once = named.withWatermark("stamp", patience).dropDuplicatesWithinWatermark(["key", "batch_id"])
    name = f"history-{uuid.uuid4().hex}"
    spark.streams.addListener(_LateRows(spark, name, late))

    def write(batch: DataFrame, batch_id: int):
        batch.drop("stamp").write.mode("overwrite").parquet(f"{path}/trigger={batch_id}")

    writer = once.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def history(spark: SparkSession, path: str, limit=METRICS_HISTORY) -> DataFrame:
    """The newest metrics rows of a followed topic."""
    rows = read_or_empty(spark, path, f"key STRING, {_ddl(METRICS_SCHEMA)}")
    newest = rows.orderBy(F.col("timestamp").desc(), F.col("batch_id").desc()).limit(limit)
    return newest.select(*METRICS_VIEW)


def late_rows(spark: SparkSession, late: str) -> DataFrame:
    """(run, batch, rows): how many rows came too late, by micro-batch."""
    schema = "run STRING, batch BIGINT, rows BIGINT"
    if not children(spark, late):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(late)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
