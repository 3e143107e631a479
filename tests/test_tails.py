"""Lists that follow their topics against the batch views, after every batch."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from review_lens.functions.records import as_messages, from_messages
from review_lens.operators import views as V
from review_lens.schema import METRICS_SCHEMA, PREDICTION_SCHEMA
from review_lens.sinks.topics import file_outlet, publish
from review_lens.sources.topics import read_messages, record_topic
from review_lens.streaming import tails

START = dt.datetime(2024, 1, 1)


def scored(draw, count, at):
    return [
        (
            draw.choice([None, *(f"r{k}" for k in range(90))]),
            draw.choice([None, "", "é漢 text"]),
            draw.choice([None, 1, 5]),
            START,
            "{PRICE#Positive};",
            draw.choice([None, "", "{PRICE#Positive};", "{OTHERS};"]),
            draw.choice([None, START + dt.timedelta(seconds=at + draw.randint(-9, 9))]) if draw.random() < 0.1
            else START + dt.timedelta(seconds=at + draw.randint(-9, 9)),
        )
        for _ in range(count)
    ]


def test_the_live_list_equals_the_view_after_every_batch(spark, tmp_path):
    draw = random.Random(4)
    sent, shown, state = (str(tmp_path / n) for n in ("sent", "shown", "state"))
    assert tails.recent(spark, shown).count() == 0
    for start in range(2):
        topic = record_topic(sent, f"{state}-journal", max_per_trigger=None)
        query = tails.start_recent(spark, topic, shown, state, limit=20, shards=3, trigger={"processingTime": "0 seconds"})
        for step in range(2 * start, 2 * start + 2):
            rows = spark.createDataFrame(scored(draw, 60, 5 * step), PREDICTION_SCHEMA)
            publish(as_messages(rows, key="id"), file_outlet(sent), "a", step)
            query.processAllAvailable()
            whole = from_messages(read_messages(spark, sent), PREDICTION_SCHEMA)
            # A tie of time and label leaves the batch view free to take either text.
            names = ["processing_timestamp", "predicted_label"]
            expected = [tuple(r) for r in V.recent_predictions(whole, 20).select(*names).collect()]
            assert [tuple(r) for r in tails.recent(spark, shown, 20).select(*names).collect()] == expected
        query.stop()
    assert tails.recent(spark, shown).columns == list(V.PREDICTION_VIEW)


def metrics(spark, rows):
    known = {"accuracy_per_label": 0.5, "exact_match_accuracy": 0.5, "f1_macro": 0.5, "f1_micro": 0.5}
    made = [(0.5, b, 0.5, 0.5, 0.5, (START + dt.timedelta(minutes=at)).isoformat() if at is not None else None, n) for b, at, n in rows]
    assert len(known) == 4
    return as_messages(spark.createDataFrame(made, METRICS_SCHEMA)).withColumn("key", F.lit("run"))


def test_repeats_are_dropped_and_late_rows_counted(spark, tmp_path):
    sent, shown, late, state = (str(tmp_path / n) for n in ("sent", "shown", "late", "state"))
    topic = record_topic(sent, f"{state}-journal", max_per_trigger=None)
    query = tails.start_history(spark, topic, shown, late, state, patience="10 minutes", trigger={"processingTime": "0 seconds"})

    def send(batch, *rows):
        publish(metrics(spark, rows), file_outlet(sent), "a", batch)
        query.processAllAvailable()

    send(0, (0, 0, 10), (1, 1, 11), (1, 2, 11))
    send(1, (1, 5, 99), (2, 6, 12))
    send(2, (3, 60, 13))
    # By now the watermark is at 50 minutes: these come too late, repeated or not.
    send(3, (0, 3, 10), (4, 4, 14), (5, 55, 15))
    deadline = time.time() + 60
    while time.time() < deadline and tails.late_rows(spark, late).count() == 0:
        time.sleep(0.2)
    query.stop()
    shown_rows = tails.history(spark, shown)
    assert [(r.batch_id, r.total_records) for r in shown_rows.collect()] == [(3, 13), (5, 15), (2, 12), (1, 11), (0, 10)]
    assert tails.late_rows(spark, late).agg(F.sum("rows")).first()[0] == 2
    assert query.lastProgress is None or all(op.numRowsTotal <= 6 for op in query.lastProgress.stateOperators)


def test_a_task_sends_only_what_may_be_listed():
    """Cutting each task's rows down first leaves the list as it is, whatever the batches."""
    import random

    import pyarrow as pa

    from review_lens.streaming import tails

    draw = random.Random(1)
    rows = [
        {"shard": draw.randrange(3), "id": str(draw.randrange(40)), "at": draw.randrange(30), "label": draw.choice(["x", "y", None])}
        for _ in range(400)
    ]
    for r in rows:
        r["shard"], r["body"] = int(r["id"]) % 3, f"{r['id']} {r['at']} {r['label']}"
    schema = pa.schema([("shard", pa.int32()), ("id", pa.string()), ("at", pa.int64()), ("label", pa.string()), ("body", pa.string())])
    batches = [pa.RecordBatch.from_pylist(rows[k : k + 37], schema) for k in range(0, 400, 37)]
    sent = [b for part in (batches[:5], batches[5:]) for b in tails._fewer(4)(part)]
    assert sum(b.num_rows for b in sent) <= 2 * 3 * 4
    for shard in range(3):
        whole, cut = (pa.Table.from_batches(x).to_pandas() for x in (batches, sent))
        whole, cut = (tails._newest_rows(x[x["shard"] == shard], 4).reset_index(drop=True) for x in (whole, cut))
        assert whole.equals(cut)


def test_a_large_row_group_is_read_in_steps(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from review_lens.sources import record_topic

    folder = tmp_path / "run=r" / "batch_id=3"
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"key": [str(k) for k in range(3000)], "value": [f"v{k}" for k in range(3000)]}), folder / "f.parquet")
    reader = record_topic.CommittedReader({"path": str(tmp_path), "journal": "j"})
    got = list(reader.read(record_topic.Slice("run=r/batch_id=3/f.parquet", 700, 1900)))
    assert max(b.num_rows for b in got) <= 512
    assert [v for b in got for v in b.column(1).to_pylist()] == [f"v{k}" for k in range(700, 2600)]
