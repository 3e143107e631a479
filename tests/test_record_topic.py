"""Streams by record over published folders: start, cap, stop and restart; whole commits."""

import json

import pytest
from pyspark.sql import functions as F

from review_lens import cli
from review_lens.sinks.topics import commit_file, file_outlet, publish
from review_lens.sources.topics import read_messages, record_topic, stream_topic


def send(spark, path, batch, first, count, files=1, run="a"):
    rows = spark.range(first, first + count, 1, files).select(
        F.lit(None).cast("string").alias("key"), F.format_string("%05d", "id").alias("value")
    )
    publish(rows, file_outlet(path), run, batch)


class Follower:
    """A stream that notes the values of each micro-batch."""

    def __init__(self, spark, path, state, **options):
        self.batches = []
        rows = stream_topic(spark, record_topic(path, f"{state}-journal", **options))
        writer = rows.writeStream.foreachBatch(self.take).option("checkpointLocation", state)
        self.query = writer.start()

    def take(self, rows, number):
        self.batches.append(sorted(r.value for r in rows.collect()))

    def catch_up(self):
        self.query.processAllAvailable()
        return [b for b in self.batches if b]

    def stop(self):
        found = self.catch_up()
        self.query.stop()
        return found


def values(first, count):
    return [f"{k:05d}" for k in range(first, first + count)]


def test_a_cap_within_one_file_and_over_files(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    send(spark, path, 0, 0, 25)
    send(spark, path, 1, 25, 12, files=4)
    first = Follower(spark, path, state, max_per_trigger=10).stop()
    assert [len(b) for b in first] == [10, 10, 10, 7]
    assert sum(first, []) == values(0, 37)
    # A stream that starts again loses nothing and repeats nothing.
    send(spark, path, 2, 37, 5)
    again = Follower(spark, path, state, max_per_trigger=10)
    assert again.catch_up() == [values(37, 5)]
    send(spark, path, 3, 42, 11)
    assert again.stop() == [values(37, 5), values(42, 10), values(52, 1)]
    idle = Follower(spark, path, state, max_per_trigger=10)
    assert idle.stop() == []


def test_a_start_at_the_end(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    send(spark, path, 0, 0, 5)
    late = Follower(spark, path, state, starting="latest", max_per_trigger=None)
    assert late.catch_up() == []
    send(spark, path, 1, 5, 3)
    assert late.stop() == [values(5, 3)]
    send(spark, path, 2, 8, 2)
    assert Follower(spark, path, state, starting="latest").stop() == [values(8, 2)]


def test_a_batch_run_again_is_seen_once(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    send(spark, path, 0, 0, 4)
    follower = Follower(spark, path, state)
    assert follower.catch_up() == [values(0, 4)]
    send(spark, path, 0, 0, 4)
    send(spark, path, 0, 0, 3, run="b")
    assert follower.stop() == [values(0, 4), values(0, 3)]
    assert read_messages(spark, path).count() == 7


def test_what_a_failed_batch_left_is_not_seen(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    send(spark, path, 0, 0, 2)
    # Files without a commit, as after a driver that died in between; then one task fails.
    left = spark.range(3).selectExpr("'k' AS key", "'left' AS value", "'a' AS run", "1L AS batch_id")
    left.write.mode("append").partitionBy("run", "batch_id").parquet(path)
    bad = spark.range(0, 40, 1, 4).select(
        F.lit("k").alias("key"),
        F.when(F.col("id") == 39, F.raise_error(F.lit("killed"))).otherwise(F.lit("half")).alias("value"),
    )
    with pytest.raises(Exception, match="killed"):
        publish(bad, file_outlet(path), "a", 2)
    follower = Follower(spark, path, state)
    assert follower.catch_up() == [values(0, 2)]
    send(spark, path, 1, 2, 2)
    send(spark, path, 2, 4, 1)
    assert sorted(sum(follower.stop()[1:], [])) == values(2, 3)
    assert sorted(r.value for r in read_messages(spark, path).collect()) == values(0, 5)


def test_commits_name_files_and_records(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 30, 1, 3).selectExpr("'k' AS key", "string(id) AS value", "id % 2 AS slice")
    publish(rows, file_outlet(path), "r", "slice")
    for number in (0, 1):
        said = json.loads(open(commit_file(path, "r", number)).read())
        assert said["batch_id"] == number and sum(f["records"] for f in said["files"]) == 15
    send(spark, path, 5, 0, 0)
    assert read_messages(spark, path).count() == 30


def test_command_line(tmp_path):
    source = cli.topic("/some/folder", "latest", 9, journal="/j")
    assert source.options == {"path": "/some/folder", "journal": "/j", "starting": "latest", "limit": "9"}
    a = cli.parser().parse_args(["ingest", "--topic", "t", "--table", "t", "--quarantine", "q", "--checkpoint", "c/"])
    assert cli.journal(a) == "c-journal"
