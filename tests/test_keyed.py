"""Upserts and slices."""

import datetime as dt
import random

from pyspark.sql import functions as F

from review_lens.operators.keyed import latest_per_key
from review_lens.operators.slices import feed_records, number_rows, replay, slice_rows
from review_lens.sinks import tables
from review_lens.sinks.tables import compact, create_review_table, land_reviews
from review_lens.sources.reviews import read_landed, read_reviews

START = dt.datetime(2024, 1, 1)
SCHEMA = (
    "id STRING, comment STRING, n_star INT, date_time TIMESTAMP, label STRING, "
    "ingestion_timestamp TIMESTAMP"
)


def review(i, comment="c", at=0, n_star=1):
    return (i, comment, n_star, START, "{OTHERS};", START + dt.timedelta(seconds=at))


def land(spark, path, rows, source="train", batch=0, run="stream", name=None):
    land_reviews(spark.createDataFrame(rows, SCHEMA), path, source, run, batch, name)


def test_latest_per_key_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.4 else str(rng.randrange(50)), i % 97, i) for i in range(3000)]
    rows.append((None, 5, 5))
    frame = spark.createDataFrame(rows, "k STRING, at INT, v INT").repartition(8)
    got = {r.k: (r.at, r.v) for r in latest_per_key(frame, "k", "at", "v").collect()}
    expected = {}
    for k, at, v in rows:
        if k is not None:
            expected[k] = max(expected.get(k, (at, v)), (at, v))
    assert got == expected


def test_hot_keys_are_cut_down_before_the_shuffle(spark, plan_of):
    frame = spark.range(10).selectExpr("id % 2 AS k", "id AS at")
    plan = plan_of(latest_per_key(frame, "k", "at"))
    before = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_replays_replace_their_own_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in (0, 1, 1, 0):
        land(spark, path, [review(f"{batch}-{i}") for i in range(5)], batch=batch)
    land(spark, path, [review("0-0", at=9)], source="test", batch=0)
    assert read_landed(spark, path).count() == 11
    assert read_reviews(spark, path).count() == 10


def test_the_newest_version_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    land(spark, path, [review("1", "old", at=1), review("2", "only", at=1)])
    land(spark, path, [review("1", "new", at=2)], source="test")
    land(spark, path, [review("1", "late arrival of an old one", at=0)], batch=1)
    assert {r.id: r.comment for r in read_reviews(spark, path).collect()} == {"1": "new", "2": "only"}


def test_streams_do_not_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    land(spark, path, [review(str(i)) for i in range(10)], run="first")
    land(spark, path, [review(str(i)) for i in range(10, 13)], run="second")
    assert read_landed(spark, path).count() == 13
    land(spark, path, [review(str(i)) for i in range(10, 13)], run="second")
    assert read_landed(spark, path).count() == 13


def test_compaction_in_place_keeps_the_keyed_view(spark, tmp_path):
    path = str(tmp_path / "t")
    land(spark, path, [review(str(i), at=i) for i in range(20)])
    land(spark, path, [review(str(i), "again", at=90_000) for i in range(0, 20, 3)], batch=1)
    columns = SCHEMA.replace(",", "").split()[::2]
    before = sorted(read_reviews(spark, path).select(*columns).collect())
    compact(spark, path)
    landed = read_landed(spark, path)
    assert sorted(landed.select(*columns).collect()) == before
    assert {r.source for r in landed.select("source").distinct().collect()} == {"compacted"}
    assert not (tmp_path / "t" / "source=train").exists()
    assert {str(r.day) for r in landed.select("day").distinct().collect()} == {"2024-01-01", "2024-01-02"}
    compact(spark, path)
    assert sorted(read_reviews(spark, path).select(*columns).collect()) == before
    compact(spark, str(tmp_path / "nothing"))


def test_a_batch_that_lands_during_compaction_stays(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    land(spark, path, [review("1"), review("2")])
    real = tables.land_reviews

    def meanwhile(rows, *places):
        land(spark, path, [review("2", "newer", at=5), review("3")], batch=1)
        real(rows, *places)

    monkeypatch.setattr(tables, "land_reviews", meanwhile)
    compact(spark, path)
    assert {r.id: r.comment for r in read_reviews(spark, path).collect()} == {"1": "c", "2": "newer", "3": "c"}


def test_a_defined_table_shows_what_lands(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    land(spark, path, [review("0")], batch=7)
    create_review_table(spark, "defined_reviews", path)
    create_review_table(spark, "defined_reviews", path)
    assert spark.table("defined_reviews").count() == 1
    land(spark, path, [review("1")], name="defined_reviews")
    land(spark, path, [review("2"), review("3", at=90_000)], source="test", name="defined_reviews")
    assert spark.table("defined_reviews").count() == 4
    found = spark.sql("SELECT id FROM defined_reviews WHERE source = 'test' ORDER BY id").collect()
    assert [r.id for r in found] == ["2", "3"]
    plan = plan_of(read_landed(spark, path).where("source = 'test' AND batch_id = 0").select("id"))
    assert "PartitionFilters: [isnotnull(source" in plan and "PushedFilters: []" in plan
    compact(spark, path, "defined_reviews")
    spark.catalog.refreshTable("defined_reviews")
    assert spark.table("defined_reviews").count() == 4


def test_row_numbers_follow_the_order_over_many_partitions(spark):
    rng = random.Random(2)
    # Half of the rows share the leading key.
    rows = [(0 if rng.random() < 0.5 else rng.randrange(100), i) for i in range(5000)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "k INT, v INT").repartition(16)
    got = {(r.k, r.v): r.row_index for r in number_rows(frame, "k", "v").collect()}
    assert got == {row: i for i, row in enumerate(sorted(rows))}


def test_slices_end_short_and_wrap(spark):
    rows = spark.range(2500).withColumnRenamed("id", "row_index")
    sliced = slice_rows(rows)
    sizes = {r.slice: r["count"] for r in sliced.groupBy("slice").count().collect()}
    assert sizes == {0: 1024, 1: 1024, 2: 452}
    ticks = {r.tick: r["count"] for r in replay(sliced, 3).groupBy("tick").count().collect()}
    assert ticks == {t: sizes[t % 3] for t in range(9)}


def test_feed_records_get_ids_and_a_time(spark, tmp_path):
    feed_records(spark.range(100).select(F.lit("x").alias("comment"))).write.parquet(str(tmp_path / "f"))
    rows = spark.read.parquet(str(tmp_path / "f")).collect()
    assert len({r.id for r in rows}) == 100
    assert all(len(r.id) == 36 and dt.datetime.fromisoformat(r.date_time) for r in rows)
