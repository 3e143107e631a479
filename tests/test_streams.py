"""The continuous jobs, run until their feed is used up."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from review_lens.functions.records import from_messages, parse_records
from review_lens.operators import models as M
from review_lens.operators import views as V
from review_lens.operators.matrix import aspect_matrix, landed_matrix
from review_lens.schema import ASPECTS, METRICS_SCHEMA, PREDICTION_SCHEMA
from review_lens.sinks.topics import file_outlet
from review_lens.sources.reviews import (
    read_landed,
    read_quarantine,
    read_reviews,
    without_old_versions,
)
from review_lens.sources.topics import clock, file_topic, message_topic, read_messages, stream_topic
from review_lens.streaming import jobs
from tests.test_models import TEXTS, matrix_of

NOW = {"availableNow": True}


def record(i):
    label = ["{BATTERY#Positive};", "{CAMERA#Negative};{OTHERS};", "", "{PRICE#Neutral};"][i % 4]
    return {"id": str(i), "comment": TEXTS[i % 5] + f" {i % 7}", "n_star": 1 + i % 5, "date_time": "2024-01-01T00:00:00", "label": label}


def write_feed(folder, start, stop, files=3, extra=()):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps(record(i)) for i in range(start, stop)] + list(extra)
    for f in range(files):
        (folder / f"{start:05d}-{f}.txt").write_text("\n".join(lines[f::files]) + "\n")


def ingest(spark, base):
    query = jobs.start_ingest(
        spark, file_topic(str(base / "feed")), str(base / "t"), str(base / "q"), str(base / "state"), trigger=NOW
    )
    query.awaitTermination()
    return query


def test_streamed_ingestion_equals_batch(spark, tmp_path):
    write_feed(tmp_path / "feed", 0, 100, extra=["junk", '{"comment":"no id"}'])
    ingest(spark, tmp_path)
    columns = ["id", "comment", "n_star", "date_time", "label"]
    batch = parse_records(spark.read.text(str(tmp_path / "feed"))).where("reason IS NULL")
    landed = read_landed(spark, str(tmp_path / "t"))
    assert sorted(landed.select(*columns).collect()) == sorted(batch.select(*columns).collect())
    assert landed.select("batch_id").distinct().count() == 3
    reasons = [r.reason for r in read_quarantine(spark, str(tmp_path / "q")).collect()]
    assert sorted(reasons) == ["missing id", "unparsable"]


def test_ingestion_goes_on_where_it_stopped(spark, tmp_path):
    write_feed(tmp_path / "feed", 0, 30)
    ingest(spark, tmp_path)
    write_feed(tmp_path / "feed", 30, 60)
    ingest(spark, tmp_path)
    ids = [r.id for r in read_landed(spark, str(tmp_path / "t")).collect()]
    assert sorted(ids, key=int) == [str(i) for i in range(60)]


def test_a_failed_batch_is_run_again_without_loss_or_doubles(spark, tmp_path, monkeypatch):
    write_feed(tmp_path / "feed", 0, 60)
    real, calls = jobs.land, []

    def failing(rows, path, source, run, batch_id):
        real(rows, path, source, run, batch_id)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "land", failing)
    with pytest.raises(Exception, match="lost"):
        ingest(spark, tmp_path)
    ingest(spark, tmp_path)
    assert calls == [0, 1, 1, 2]
    ids = [r.id for r in read_landed(spark, str(tmp_path / "t")).collect()]
    assert sorted(ids, key=int) == [str(i) for i in range(60)]


@pytest.fixture(scope="module")
def model_root(spark, tmp_path_factory):
    models = M.train(matrix_of(spark), max_iter=20)
    models.version = 0
    root = str(tmp_path_factory.mktemp("models") / "m")
    M.publish(spark, models, root)
    return root


def score(spark, base, root):
    query = jobs.start_scoring(
        spark,
        file_topic(str(base / "feed")),
        root,
        str(base / "t"),
        str(base / "q"),
        file_outlet(str(base / "predictions")),
        file_outlet(str(base / "metrics")),
        str(base / "state"),
        trigger=NOW,
    )
    query.awaitTermination()


def test_scoring_publishes_feeds_back_and_measures(spark, tmp_path, model_root):
    write_feed(tmp_path / "feed", 0, 90, extra=["junk"])
    score(spark, tmp_path, model_root)
    messages = read_messages(spark, str(tmp_path / "predictions"))
    assert sorted((r.key for r in messages.collect()), key=int) == [str(i) for i in range(90)]
    predicted = from_messages(messages, PREDICTION_SCHEMA)

    # The same reviews scored in one batch.
    models = M.load(spark, model_root)
    reviews = parse_records(spark.read.text(str(tmp_path / "feed"))).where("reason IS NULL")
    expected = M.with_predicted_label(M.score(models, reviews)).select("id", "predicted_label")
    assert sorted(predicted.select("id", "predicted_label").collect()) == sorted(expected.collect())

    fed_back = read_landed(spark, str(tmp_path / "t"))
    assert {(r.source, r.n) for r in fed_back.groupBy("source").agg(F.count("*").alias("n")).collect()} == {("test", 90)}
    assert read_quarantine(spark, str(tmp_path / "q")).count() == 1

    metrics = from_messages(read_messages(spark, str(tmp_path / "metrics")), METRICS_SCHEMA).collect()
    assert sorted(m.batch_id for m in metrics) == [0, 1, 2]
    assert sum(m.total_records for m in metrics) == 90
    for m in metrics:
        assert m.f1_micro == pytest.approx(m.accuracy_per_label)
        assert 0 <= m.exact_match_accuracy <= m.accuracy_per_label <= 1
        assert len(m.timestamp) == len("2024-01-01T00:00:00.000000")


def test_a_failed_scoring_batch_is_run_again(spark, tmp_path, model_root, monkeypatch):
    write_feed(tmp_path / "feed", 0, 40, files=2)
    real, calls = jobs.metrics_messages, []

    def failing(metrics):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return real(metrics)

    monkeypatch.setattr(jobs, "metrics_messages", failing)
    with pytest.raises(Exception, match="lost"):
        score(spark, tmp_path, model_root)
    score(spark, tmp_path, model_root)
    keys = [r.key for r in read_messages(spark, str(tmp_path / "predictions")).collect()]
    assert sorted(keys, key=int) == [str(i) for i in range(40)]
    assert read_landed(spark, str(tmp_path / "t")).count() == 40


def test_reviews_wait_for_the_first_models(spark, tmp_path, model_root):
    write_feed(tmp_path / "feed", 0, 10, files=2, extra=["junk"])
    models = str(tmp_path / "models")
    score(spark, tmp_path, models)
    assert not (tmp_path / "predictions").exists()
    # Fed back and set aside in any case.
    assert read_landed(spark, str(tmp_path / "t")).count() == 10
    assert read_quarantine(spark, str(tmp_path / "q")).count() == 1
    M.publish(spark, M.load(spark, model_root), models)
    # A start finds them, even if nothing new comes in.
    score(spark, tmp_path, models)
    messages = read_messages(spark, str(tmp_path / "predictions"))
    assert sorted(r.key for r in messages.collect()) == sorted(str(i) for i in range(10))
    assert messages.select("run", "batch_id").distinct().count() == 2
    write_feed(tmp_path / "feed", 10, 13, files=1)
    score(spark, tmp_path, models)
    assert read_messages(spark, str(tmp_path / "predictions")).count() == 13
    assert read_landed(spark, str(tmp_path / "t")).count() == 13
    metrics = from_messages(read_messages(spark, str(tmp_path / "metrics")), METRICS_SCHEMA)
    assert metrics.agg(F.sum("total_records")).first()[0] == 13


def test_a_second_checkpoint_replaces_nothing(spark, tmp_path):
    for name, ids in (("one", (0, 10)), ("two", (10, 13)), ("two", (10, 13))):
        base = tmp_path / name
        base.mkdir(exist_ok=True)
        write_feed(base / "feed", *ids)
        query = jobs.start_ingest(
            spark, file_topic(str(base / "feed")), str(tmp_path / "t"), str(tmp_path / "q"), str(base / "state"), trigger=NOW
        )
        query.awaitTermination()
    assert read_landed(spark, str(tmp_path / "t")).count() == 13


def test_old_generations_are_retired(spark, tmp_path, model_root):
    root = str(tmp_path / "m")
    models = M.load(spark, model_root)
    for version in range(4):
        models.version = version
        M.publish(spark, models, root)
    models.version = 3
    M.publish(spark, models, root)
    M.retire(spark, root, keep=2)
    left = [p.name for p in (tmp_path / "m").iterdir() if p.name.startswith("generation")]
    # Two trainers that took the same number don't touch each other's folder.
    assert len(left) == 2 and M.load(spark, root).folder in left
    assert M.load(spark, root).training_rows == models.training_rows


def test_training_leaves_no_scratch_behind(spark, tmp_path):
    from pathlib import Path

    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(base.glob("training-*"))
    write_feed(tmp_path / "feed", 0, 40)
    ingest(spark, tmp_path)
    jobs.retrain(spark, str(tmp_path / "t"), str(tmp_path / "m"), max_iter=3)
    assert set(base.glob("training-*")) == before


def test_the_landed_matrix_is_that_of_the_keyed_view(spark, tmp_path):
    write_feed(tmp_path / "feed", 0, 60)
    ingest(spark, tmp_path)
    landed = read_landed(spark, str(tmp_path / "t"))
    later = landed.where("id % 3 = 0").withColumns(
        {"label": F.lit("{CAMERA#Positive};"), "ingestion_timestamp": F.expr("ingestion_timestamp + INTERVAL 1 HOUR")}
    )
    both = landed.union(later)
    expected = aspect_matrix(without_old_versions(both))
    found = landed_matrix(both).select(*expected.columns)
    assert sorted(found.collect()) == sorted(expected.collect())


def test_retraining_reads_what_was_landed(spark, tmp_path):
    write_feed(tmp_path / "feed", 0, 40)
    ingest(spark, tmp_path)
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    query = jobs.start_retraining(
        spark, str(tmp_path / "t"), str(tmp_path / "m"), str(tmp_path / "clock"), ticks, trigger=NOW, max_iter=5
    )
    query.awaitTermination()
    models = M.load(spark, str(tmp_path / "m"))
    assert models.version == 0 and set(models.classifiers) == set(ASPECTS)
    rows = spark.read.parquet(str(tmp_path / "m" / "published")).first().training_rows
    assert rows == aspect_matrix(read_reviews(spark, str(tmp_path / "t"))).count()
    again = jobs.retrain(spark, str(tmp_path / "t"), str(tmp_path / "m"), max_iter=5)
    assert again.version == 1 and M.load(spark, str(tmp_path / "m"), models).version == 1


def test_retraining_without_reviews_publishes_nothing(spark, tmp_path):
    places = str(tmp_path / "t"), str(tmp_path / "m")
    assert jobs.retrain(spark, *places) is None
    write_feed(tmp_path / "feed", 0, 0, files=1, extra=["junk"])
    ingest(spark, tmp_path)
    assert jobs.retrain(spark, *places) is None
    assert M.load(spark, places[1]) is None


def test_views_wait_for_their_topics(spark, tmp_path):
    nothing = read_messages(spark, str(tmp_path / "none"))
    assert V.recent_predictions(from_messages(nothing, PREDICTION_SCHEMA)).count() == 0
    assert V.metrics_history(from_messages(nothing, METRICS_SCHEMA)).count() == 0


def test_readers_follow_published_messages(spark, tmp_path, model_root):
    write_feed(tmp_path / "feed", 0, 10, files=1)
    score(spark, tmp_path, model_root)
    stream = from_messages(
        stream_topic(spark, message_topic(str(tmp_path / "predictions"))), PREDICTION_SCHEMA
    )
    query = stream.writeStream.format("memory").queryName("followed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("followed").count() == 10


def test_the_clock_is_a_stream(spark):
    assert clock(spark).isStreaming


def test_state_survives_a_copy_of_the_checkpoint(spark, tmp_path):
    write_feed(tmp_path / "feed", 0, 20)
    ingest(spark, tmp_path)
    shutil.copytree(tmp_path / "state", tmp_path / "copy")
    query = jobs.start_ingest(
        spark, file_topic(str(tmp_path / "feed")), str(tmp_path / "t"), str(tmp_path / "q"), str(tmp_path / "copy"), trigger=NOW
    )
    query.awaitTermination()
    assert read_landed(spark, str(tmp_path / "t")).count() == 20
