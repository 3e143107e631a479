"""Publications that can be resumed, and classes by frequency."""

import json
import random
import uuid

import pytest

from review_lens.operators.models import frequent_labels
from review_lens.operators.slices import feed_namespace
from review_lens.sinks import topics
from review_lens.sinks.topics import committed, file_outlet
from review_lens.sources.topics import read_messages
from review_lens.streaming import jobs

RUN = f"feed-{feed_namespace('f')}"


def sent(spark, path):
    return sorted((r.batch_id, json.loads(r.value)["id"], json.loads(r.value)["comment"]) for r in read_messages(spark, path).collect())


def expected(count, size):
    name = lambda k: f"{k}:text {k}\x1f{k % 5}\x1f"
    return sorted((k // size, str(uuid.uuid5(feed_namespace("f"), name(k))), f"text {k}") for k in range(count))


@pytest.fixture
def rows(spark):
    return spark.range(25).selectExpr("id AS place", "concat('text ', id) AS comment", "int(id % 5) AS n_star", "string(null) AS label").repartition(3)


def test_a_stopped_publication_goes_on_after_its_last_slice(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert jobs.publish_feed(rows, file_outlet(path), "f", "place", size=10, most=1) == 1
    first = sent(spark, path)
    assert [b for b, _, _ in first] == [0] * 10
    assert jobs.publish_feed(rows, file_outlet(path), "f", "place", size=10) == 3
    assert jobs.publish_feed(rows, file_outlet(path), "f", "place", size=10) == 3
    assert sent(spark, path) == expected(25, 10) and sent(spark, path)[:10] == first


def test_slices_without_a_commit_are_replaced(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")

    def dies(*_):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patched:
        patched.setattr(topics, "commit", dies)
        with pytest.raises(RuntimeError):
            jobs.publish_feed(rows, file_outlet(path), "f", "place", size=10, most=2)
    assert committed(spark, file_outlet(path), RUN) == []
    assert jobs.publish_feed(rows, file_outlet(path), "f", "place", size=10) == 3
    assert sent(spark, path) == expected(25, 10)


def test_frequent_labels(spark):
    draw = random.Random(9)
    labels = [None] * 30 + ["b", "a"] * 50 + [f"rare {draw.randrange(400)}" for _ in range(300)] + ["often"] * 80
    draw.shuffle(labels)
    frame = spark.createDataFrame([(x,) for x in labels], "processed_label string").repartition(7)
    counts = {x: labels.count(x) for x in labels if x is not None}
    order = sorted(counts, key=lambda x: (-counts[x], x))
    assert frequent_labels(frame, 20) == order[:20] and frequent_labels(frame, 10_000) == order
    # With few counters those with a large share are still found, counted exactly.
    assert frequent_labels(frame, 3, tracked=64) == ["often", "a", "b"]
