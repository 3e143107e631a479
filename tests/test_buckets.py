"""Folding under readers, and training examples that follow what lands."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from review_lens.operators import examples
from review_lens.operators.features import COUNTS, term_counts
from review_lens.operators.matrix import comment_digest, landed_matrix
from review_lens.schema import ASPECTS
from review_lens.session import children
from review_lens.sinks import buckets as B
from review_lens.sinks.tables import fold, land_reviews
from review_lens.sources.reviews import (
    folded_store,
    landed_files,
    read_landed,
    read_reviews,
)

SCHEMA = "id STRING, comment STRING, n_star INT, date_time TIMESTAMP, label STRING, ingestion_timestamp TIMESTAMP"
START = dt.datetime(2024, 1, 1)


def review(i, comment="c", label="{PRICE#Positive};", at=0):
    return (i, comment, 3, START, label, START + dt.timedelta(seconds=at))


def land(spark, path, rows, batch=0):
    land_reviews(spark.createDataFrame(rows, SCHEMA), path, "train", "r", batch)


def seen(rows):
    return {r.id: r.comment for r in rows.collect()}


def test_readers_keep_what_they_began_with(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    assert fold(spark, path) is None
    land(spark, path, [review(str(i), f"a{i}") for i in range(150)])
    first = read_reviews(spark, path)
    fold(spark, path, buckets=8)
    land(spark, path, [review("3", "b3", at=9), review("x", "bx", at=9), review(None, "no id")], batch=1)
    second, landed = read_reviews(spark, path), read_landed(spark, path)
    fold(spark, path)
    # What landed is in both places by now, and counts once.
    third = read_reviews(spark, path)
    assert "Exchange" not in plan_of(third) and "Bucketed: true" in plan_of(third)
    assert "Exchange" not in plan_of(third.groupBy("id").agg(F.max("n_star")))
    assert seen(first) == {str(i): f"a{i}" for i in range(150)}
    assert seen(second) == seen(third) == seen(first) | {"3": "b3", "x": "bx"}
    assert landed.count() == 153 and read_landed(spark, path).count() == 151
    # An older version that comes late, and a batch run again, change nothing.
    land(spark, path, [review("3", "old", at=1)], batch=2)
    land(spark, path, [review("3", "b3", at=9), review("x", "bx", at=9)], batch=1)
    assert seen(read_reviews(spark, path)) == seen(third)
    fold(spark, path)
    assert seen(read_reviews(spark, path)) == seen(third)


def test_only_touched_buckets_are_rewritten_and_old_files_go(spark, tmp_path):
    path = str(tmp_path / "t")
    store = folded_store(path)
    land(spark, path, [review(str(i)) for i in range(80)])
    before = fold(spark, path, buckets=8, keep=2).tables["reviews"]
    assert len(before) == 8 and len(landed_files(spark, path)) > 0
    mine = spark.createDataFrame([("5",)], "id STRING").select(B.bucket_of("id", 8).alias("b")).first().b
    land(spark, path, [review("5", "new", at=5)], batch=1)
    after = fold(spark, path, keep=2).tables["reviews"]
    assert {b for b in after if after[b] != before[b]} == {mine} and len(after[mine]) == 1
    # The first batch is in both kept snapshots by now, the second in one.
    assert all("batch_id=1" in f for f in landed_files(spark, path)) and B.versions(spark, store) == [0, 1]
    land(spark, path, [review("5", "newer", at=6)], batch=2)
    fold(spark, path, keep=2)
    assert B.versions(spark, store) == [1, 2]
    assert not children(spark, f"{store}/{before[mine][0]}")
    assert children(spark, f"{store}/{after[mine][0]}")
    assert fold(spark, path, keep=2).version == 2
    assert seen(read_reviews(spark, path))["5"] == "newer"


def test_layers_are_merged_beyond_their_limit(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    for k in range(4):
        land(spark, path, [review("1", f"v{k}", at=k), review(f"n{k}")], batch=k)
        held = fold(spark, path, buckets=2, layers=3)
        assert max(len(layers) for layers in held.tables["reviews"].values()) <= 3
        rows = read_reviews(spark, path)
        assert seen(rows)["1"] == f"v{k}" and len(seen(rows)) == k + 2 and "Exchange" not in plan_of(rows)


def test_of_two_writers_one_fails(spark, tmp_path):
    store = str(tmp_path / "s")
    B.publish(spark, store, B.Snapshot(0, 4))
    with pytest.raises(Exception, match="already exists"):
        B.publish(spark, store, B.Snapshot(0, 4))
    assert B.newest(spark, store) == B.Snapshot(0, 4)


def as_rows(frame):
    names = [f"`{a}`" for a in ASPECTS]
    return sorted(tuple(map(str, r)) for r in frame.select(F.hex("digest"), *names, F.col(COUNTS).cast("string")).collect())


def whole(spark, path):
    rows = term_counts(landed_matrix(read_landed(spark, path)))
    return as_rows(rows.withColumn("digest", comment_digest()).withColumn(COUNTS, F.unwrap_udt(COUNTS)))


@pytest.mark.parametrize("seed", [1, 2])
def test_examples_follow_the_landed_table(spark, tmp_path, seed):
    """Corrections, late versions, shared comments, batches run again, folding in between."""
    draw = random.Random(seed)
    path = str(tmp_path / "t")
    labels = ["", None, "{PRICE#Positive};", "{PRICE#Negative};{SCREEN#Neutral};", "{OTHERS};", "{DESIGN#Odd};", "junk", "{SER&ACC#Neutral};"]
    batches = []
    for k in range(5):
        rows = [
            review(
                draw.choice([None, *map(str, range(12))]),
                draw.choice([None, "", "same words", *(f"text {n}" for n in range(8))]),
                draw.choice(labels),
                at=draw.choice([k, k, k - 2, 40 - k]),
            )
            for _ in range(15)
        ]
        batches.append(rows)
        land(spark, path, rows, batch=k)
        if k in (2, 4):
            land(spark, path, batches[k - 1], batch=k - 1)
        if k == 3:
            fold(spark, path, buckets=3, keep=1)
        examples.update(spark, path, buckets=3, layers=2, keep=2)
        assert as_rows(examples.examples(spark, path)) == whole(spark, path)
    held = examples.update(spark, path)
    assert held.version == 4 and len(B.versions(spark, examples.examples_store(path))) == 2


def test_an_update_reads_new_partitions_alone(spark, tmp_path):
    path = tmp_path / "t"
    assert examples.examples(spark, str(path)).count() == 0
    land(spark, str(path), [review("1", "one"), review("2", "two")])
    examples.update(spark, str(path), buckets=2)
    for file in (path / "source=train").rglob("*.parquet"):
        file.write_bytes(b"not to be read")
    land(spark, str(path), [review("2", "three", "{PRICE#Negative};", at=5)], batch=1)
    examples.update(spark, str(path))
    rows = examples.examples(spark, str(path)).select(F.hex("digest").alias("d"), "PRICE").collect()
    digest = lambda t: spark.range(1).select(F.upper(F.sha2(F.lit(t), 256))).first()[0]
    assert {r.d: r.PRICE for r in rows} == {digest("one"): 3, digest("three"): 1}


def test_folding_leaves_what_the_examples_have_not_taken(spark, tmp_path):
    path = str(tmp_path / "t")
    land(spark, path, [review("1", "one")])
    examples.update(spark, path, buckets=2)
    land(spark, path, [review("2", "two")], batch=1)
    fold(spark, path, buckets=2, keep=1)
    assert all("batch_id=1" in f for f in landed_files(spark, path))
    examples.update(spark, path)
    assert as_rows(examples.examples(spark, path)) == whole(spark, path)
    fold(spark, path, keep=1)
    assert landed_files(spark, path) == [] and len(seen(read_reviews(spark, path))) == 2
