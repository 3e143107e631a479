"""The whole round on files: feed, land, retrain, score, look at the results."""

import csv

import pytest
from pyspark.sql import functions as F

from review_lens import cli
from review_lens.functions.records import as_messages, from_messages
from review_lens.operators import models as M
from review_lens.schema import WIRE_SCHEMA
from review_lens.sinks.topics import file_outlet, publish
from review_lens.sources.reviews import in_file_order, read_landed, read_review_csv
from review_lens.sources.topics import kafka_history, newest_messages, read_messages
from review_lens.streaming import jobs
from tests.test_streams import record


def arguments(command, **options):
    words = [command]
    for name, value in options.items():
        words += [f"--{name.replace('_', '-')}", str(value)]
    return cli.parser().parse_args(words)


def run(spark, command, **options):
    query = cli.start(spark, arguments(command, **options))
    if query is not None:
        query.processAllAvailable()
        query.stop()


def write_csv(path, n):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(["comment", "n_star", "date_time", "label"])
        for i in range(n):
            r = record(i)
            writer.writerow([f"{r['comment']}\n{i}", r["n_star"], "", r["label"]])


def test_rows_of_a_file_are_published_in_order(spark, tmp_path):
    write_csv(tmp_path / "reviews.csv", 500)
    rows = in_file_order(read_review_csv(spark, str(tmp_path)))
    jobs.publish_rows(rows, file_outlet(str(tmp_path / "sent")), "file", "place", size=200)
    sent = from_messages(read_messages(spark, str(tmp_path / "sent")), WIRE_SCHEMA, "batch_id").collect()
    slices = {s: {int(r.comment.split("\n")[1]) for r in sent if r.batch_id == s} for s in (0, 1, 2)}
    assert slices == {0: set(range(200)), 1: set(range(200, 400)), 2: set(range(400, 500))}
    assert len({r.id for r in sent}) == 500


def test_line_files_split(spark, tmp_path):
    (tmp_path / "lines.csv").write_text("comment,n_star,date_time,label\n" + "x,1,,\n" * 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = read_review_csv(spark, str(tmp_path), multi_line=False)
        assert rows.rdd.getNumPartitions() > 1 and rows.count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_the_whole_round(spark, tmp_path, capsys):
    write_csv(tmp_path / "reviews.csv", 60)
    run(spark, "feed", csv=tmp_path / "reviews.csv", to=tmp_path / "train", size=25)
    sent = {r.batch_id: r["count"] for r in read_messages(spark, str(tmp_path / "train")).groupBy("batch_id").count().collect()}
    assert sent == {0: 25, 1: 25, 2: 10}

    places = {"table": tmp_path / "t", "quarantine": tmp_path / "q"}
    run(spark, "define", name="round_reviews", table=places["table"])
    run(spark, "ingest", topic=tmp_path / "train", checkpoint=tmp_path / "c1", every="1 second", name="round_reviews", **places)
    assert read_landed(spark, str(places["table"])).count() == 60 == spark.table("round_reviews").count()

    assert jobs.retrain(spark, str(places["table"]), str(tmp_path / "m"), max_iter=5).training_rows == 45
    run(
        spark, "score", topic=tmp_path / "train", models=tmp_path / "m", predictions=tmp_path / "p",
        metrics=tmp_path / "x", checkpoint=tmp_path / "c2", every="1 second", **places,
    )
    assert read_messages(spark, str(tmp_path / "p")).count() == 60
    assert read_landed(spark, str(places["table"])).where("source = 'test'").count() == 60
    run(spark, "compact", table=places["table"])
    assert read_landed(spark, str(places["table"])).count() == 60
    assert M.load(spark, str(tmp_path / "m")).version == 0

    capsys.readouterr()
    run(spark, "recent", predictions=tmp_path / "p")
    run(spark, "history", metrics=tmp_path / "x")
    shown = capsys.readouterr().out
    assert "predicted_label" in shown and "f1_macro" in shown
    # Whole values: comments and times are longer than twenty characters.
    assert "..." not in shown


def test_only_the_newest_batches_are_read(spark, tmp_path):
    path = str(tmp_path / "p")
    for run_, count in (("a", 6), ("b", 2)):
        for batch in range(count):
            rows = spark.range(3).selectExpr(
                f"concat('{run_}', {batch}, '-', id) AS id",
                f"timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, {10 * batch + (25 if run_ == 'b' else 0)}, id) AS processing_timestamp",
            )
            publish(as_messages(rows), file_outlet(path), run_, batch)
    messages = read_messages(spark, path)
    stamp = F.get_json_object("value", "$.processing_timestamp").cast("timestamp")
    newest = lambda m, n: [r.i for r in m.orderBy(stamp.desc()).limit(n).selectExpr("get_json_object(value, '$.id') AS i").collect()]
    for wanted in (1, 3, 4, 9, 24, 50):
        read = newest_messages(messages, stamp, lambda m, n=wanted: m.count() >= n)
        assert newest(read, wanted) == newest(messages, wanted)
        assert read.count() < 24 or wanted > 9


def test_a_folder_refuses_what_it_cannot_do():
    for options in ({"starting": "latest"}, {"per_trigger": 5}):
        with pytest.raises(SystemExit, match="folder"):
            cli.topic("/some/folder", **options)
    options = kafka_history("a:9092", "out")
    assert (options["startingOffsets"], options["endingOffsets"]) == ("earliest", "latest")


def test_topic_names():
    source = cli.topic("kafka:a:9092,b:9092/reviews", "latest", 9)
    assert source.options["kafka.bootstrap.servers"] == "a:9092,b:9092"
    assert source.options["subscribe"] == "reviews" and source.options["startingOffsets"] == "latest"
    assert cli.outlet("kafka:a:9092/out").options["topic"] == "out"
    assert cli.topic("/some/folder", "earliest").format == "parquet"
    a = arguments("retrain", table="t", models="m", checkpoint="c")
    assert a.every == "300 seconds"
