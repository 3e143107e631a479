"""Records on the wire."""

import datetime as dt
import json

from review_lens.functions.records import (
    accepted,
    as_messages,
    from_messages,
    parse_records,
    rejected,
)
from review_lens.schema import METRICS_SCHEMA, PREDICTION_SCHEMA, WIRE_SCHEMA
from review_lens.sinks.topics import file_outlet, kafka_outlet, publish, write_record_files
from review_lens.sources.reviews import CSV_FORMAT, read_review_csv
from review_lens.sources.topics import file_topic, kafka_topic, read_messages, stream_topic

GOOD = {"id": "1", "comment": "ok", "n_star": 4, "date_time": "2024-01-02T03:04:05.678901", "label": "{OTHERS};"}


def wire(spark, *records):
    values = [(r if isinstance(r, str) or r is None else json.dumps(r),) for r in records]
    return spark.createDataFrame(values, "value STRING")


def parse_one(spark, **changes):
    return parse_records(wire(spark, {**GOOD, **changes})).first()


def test_a_good_record(spark):
    row = parse_records(wire(spark, GOOD)).first()
    assert (row.id, row.comment, row.n_star, row.label, row.reason) == ("1", "ok", 4, "{OTHERS};", None)
    assert row.date_time == dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert row.ingestion_timestamp is not None


def test_binary_payloads_are_text(spark):
    frame = spark.createDataFrame([(bytearray(json.dumps(GOOD).encode()),)], "value BINARY")
    assert parse_records(frame).first().comment == "ok"


def test_fields_of_the_wrong_type_are_null_and_the_rest_survives(spark):
    for bad in (5.5, "5", 5.0):
        row = parse_one(spark, n_star=bad)
        assert (row.n_star, row.comment, row.reason) == (None, "ok", None)
    assert parse_records(wire(spark, '{"id":"1","comment":"ok","n_star":NaN}')).first().n_star is None
    assert parse_one(spark, id=7).id == "7"
    assert parse_one(spark, extra=[1, 2]).comment == "ok"


def test_bad_times_are_null(spark):
    for bad in ("soon", None, ""):
        assert parse_one(spark, date_time=bad).date_time is None


def test_useless_records_are_set_aside_with_a_reason(spark):
    no_id = {k: v for k, v in GOOD.items() if k != "id"}
    no_comment = {k: v for k, v in GOOD.items() if k != "comment"}
    parsed = parse_records(wire(spark, GOOD, "not json", "", None, "{}", no_id, no_comment, '{"id":'))
    reasons = sorted(r.reason for r in rejected(parsed).collect())
    assert reasons == ["missing comment", "missing id"] + ["unparsable"] * 5
    assert [r.id for r in accepted(parsed).collect()] == ["1"]
    raw = {r.value for r in rejected(parsed).collect() if r.reason == "unparsable"}
    assert {"not json", "", None} <= raw


def test_text_is_parsed_once(spark, plan_of):
    parsed = parse_records(wire(spark, GOOD))
    assert plan_of(accepted(parsed)).count("from_json(") == 1


def test_messages_leave_nulls_out_and_come_back(spark):
    rows = spark.sql("SELECT 1 AS id, 'a\"\n' AS comment, cast(NULL AS INT) AS n_star")
    message = as_messages(rows, key="id").first()
    assert message.key == "1" and json.loads(message.value) == {"id": 1, "comment": 'a"\n'}
    assert as_messages(rows).first().key is None


def test_metrics_fields_are_in_alphabetical_order():
    names = METRICS_SCHEMA.fieldNames()
    assert names == sorted(names)


def test_predictions_round_trip(spark, tmp_path):
    rows = spark.sql(
        "SELECT 'x' AS id, 'c' AS comment, 3 AS n_star, TIMESTAMP'2024-01-01 00:00:00' AS date_time, "
        "'' AS label, '{OTHERS};' AS predicted_label, TIMESTAMP'2024-01-02 00:00:00.123' AS processing_timestamp"
    )
    outlet = file_outlet(str(tmp_path / "p"))
    publish(as_messages(rows, key="id"), outlet, "run", 3)
    publish(as_messages(rows, key="id"), outlet, "run", 3)
    back = from_messages(read_messages(spark, str(tmp_path / "p")), PREDICTION_SCHEMA)
    assert back.collect() == rows.collect()


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    rows = [('say "hi",\nbye ', 5, "2024-01-01", "{OTHERS};"), ("đẹp, tốt", 1, "x", None)]
    frame = spark.createDataFrame(rows, "comment STRING, n_star INT, date_time STRING, label STRING")
    frame.coalesce(1).write.options(**CSV_FORMAT).csv(str(tmp_path / "c"))
    assert sorted(map(tuple, read_review_csv(spark, str(tmp_path / "c")).collect())) == sorted(rows)


def test_csv_written_by_another_program(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text('comment,n_star,date_time,label\n"a ""b""\nc",4,2021,{CAMERA#Positive};\n', "utf-8")
    assert tuple(read_review_csv(spark, str(path)).first()) == ('a "b"\nc', 4, "2021", "{CAMERA#Positive};")


def test_kafka_options():
    topic = kafka_topic("broker:9092", "reviews", starting="latest", max_per_trigger=7)
    assert topic.format == "kafka"
    assert topic.options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "reviews",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "7",
    }
    assert kafka_topic("b", "t").options["maxOffsetsPerTrigger"] == "1024"
    outlet = kafka_outlet("broker:9092", "predictions")
    assert outlet.options["topic"] == "predictions" and outlet.options["kafka.acks"] == "all"


def test_files_stand_in_for_a_topic(spark, tmp_path):
    write_record_files(wire(spark, GOOD), str(tmp_path / "t"))
    stream = stream_topic(spark, file_topic(str(tmp_path / "t")))
    assert stream.isStreaming and stream.columns == ["value"]


def test_wire_schema_is_all_nullable():
    assert all(f.nullable for f in WIRE_SCHEMA.fields)
