"""Metrics against a direct computation."""

import random

import pytest
from pyspark.sql import functions as F

from review_lens.operators import quality as Q
from review_lens.operators import views as V
from review_lens.schema import ASPECTS

COLUMNS = [f"{a}_{side}" for side in ("true", "pred") for a in ASPECTS]
SCHEMA = "batch_id BIGINT, " + ", ".join(f"`{c}` INT" for c in COLUMNS)


def direct(rows):
    """Metrics of one batch, straight from their definitions."""
    pairs = [(t, p) for true, guess in rows for t, p in zip(true, guess, strict=True)]
    scores, all_tp, all_off = [], 0, 0
    for k in {x for pair in pairs for x in pair}:
        tp = sum(t == p == k for t, p in pairs)
        off = sum((t == k) != (p == k) for t, p in pairs)
        scores.append(2 * tp / (2 * tp + off))
        all_tp, all_off = all_tp + tp, all_off + off
    return {
        "accuracy_per_label": sum(t == p for t, p in pairs) / len(pairs),
        "exact_match_accuracy": sum(t == p for t, p in rows) / len(rows),
        "f1_micro": 2 * all_tp / (2 * all_tp + all_off),
        "f1_macro": sum(scores) / len(scores),
        "total_records": len(rows),
    }


def random_batch(rng, n, wrong):
    rows = []
    for _ in range(n):
        true = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in ASPECTS[:-1]] + [rng.randrange(2)]
        rows.append((true, [rng.randrange(4) if rng.random() < wrong else t for t in true]))
    return rows


def measured(spark, batches):
    rows = [(b, *t, *p) for b, rows in batches.items() for t, p in rows]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    return {r.batch_id: r.asDict() for r in Q.batch_metrics(frame).collect()}


def test_metrics_per_batch(spark):
    rng = random.Random(3)
    batches = {b: random_batch(rng, n, w) for b, (n, w) in enumerate([(1, 0.5), (40, 0.1), (400, 0.02)])}
    zeros, ones = [0] * 11, [1] * 11
    batches[10] = [(zeros, zeros)]
    batches[11] = [(zeros, ones)]
    batches[12] = [(ones[:5] + zeros[:6], ones[:5] + zeros[:6])] * 3
    batches[13] = [([3] + zeros[:10], [2] + zeros[:10]), (zeros, zeros)]
    got = measured(spark, batches)
    assert set(got) == set(batches)
    for b, rows in batches.items():
        for name, value in direct(rows).items():
            assert got[b][name] == pytest.approx(value, abs=1e-12), (b, name)
        assert got[b]["f1_micro"] == pytest.approx(got[b]["accuracy_per_label"])


def test_an_empty_batch_has_no_metrics(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert Q.batch_metrics(nothing).count() == 0
    assert Q.one_batch_metrics(nothing, 7).count() == 0


def test_one_batch_alone_has_the_same_metrics(spark):
    rows = random_batch(random.Random(9), 50, 0.2)
    frame = spark.createDataFrame([(7, *t, *p) for t, p in rows], SCHEMA)
    assert Q.one_batch_metrics(frame, 7).collect() == Q.batch_metrics(frame).collect()


def test_confusion_agrees_with_the_pairs(spark):
    rows = random_batch(random.Random(4), 60, 0.3)
    frame = spark.createDataFrame([(0, t, p) for t, p in rows], "batch_id INT, true_array ARRAY<INT>, prediction_array ARRAY<INT>")
    pairs = Q.flattened_pairs(frame, "batch_id")
    assert pairs.count() == 60 * 11
    flat = [(t, p) for a, b in rows for t, p in zip(a, b, strict=True)]
    got = {r["class"]: (r.tp, r.fp, r.fn) for r in Q.confusion_tallies(pairs).collect()}
    for k in range(4):
        tp = sum(t == p == k for t, p in flat)
        assert got[k] == (tp, sum(p == k for _, p in flat) - tp, sum(t == k for t, _ in flat) - tp)


def test_hot_batches_are_combined_before_the_shuffle(spark, plan_of):
    frame = spark.range(10).select((F.col("id") % 3).alias("batch_id"), *[F.lit(0).alias(c) for c in COLUMNS])
    plan = plan_of(Q.batch_metrics(frame))
    assert "partial_count" in plan[plan.rindex("Exchange") :]
    assert "Python" not in plan


def test_training_overlap(spark):
    batches = spark.createDataFrame([(0, "a"), (0, "a"), (0, "z"), (1, "z"), (1, None)], "batch_id INT, comment STRING")
    trained = spark.createDataFrame([("a",), ("b",), ("a",)], "comment STRING")
    got = {r.batch_id: (r.total_records, r.trained_records) for r in Q.training_overlap(batches, trained).collect()}
    assert got == {0: (3, 2), 1: (2, 0)}


def metrics_frame(spark, stamps):
    rows = [(b, t, 0.5, 0.5, 0.5, 0.5, 10) for b, t in stamps]
    return spark.createDataFrame(
        rows,
        "batch_id BIGINT, timestamp STRING, accuracy_per_label DOUBLE, exact_match_accuracy DOUBLE, "
        "f1_micro DOUBLE, f1_macro DOUBLE, total_records BIGINT",
    )


def test_metrics_history_drops_repeats_and_keeps_ten(spark):
    stamps = [(b, f"2024-01-01T00:{b:02d}") for b in range(25)]
    history = V.metrics_history(metrics_frame(spark, stamps + stamps[-5:]))
    assert history.columns == list(V.METRICS_VIEW)
    assert [r.batch_id for r in history.collect()] == list(range(24, 14, -1))


def test_recent_predictions_are_the_newest_fifty(spark, plan_of):
    frame = spark.range(200).selectExpr(
        "cast(id AS STRING) AS id", "'c' AS comment", "cast(id AS INT) AS n_star", "'' AS label",
        "'' AS predicted_label", "timestamp_seconds(id div 2) AS processing_timestamp",
    )
    recent = V.recent_predictions(frame)
    assert recent.columns == list(V.PREDICTION_VIEW)
    assert sorted(r.n_star for r in recent.collect()) == list(range(150, 200))
    assert "TakeOrderedAndProject" in plan_of(recent)


def test_a_batch_measured_again_counts_once(spark):
    rows = metrics_frame(spark, [(0, "2024-01-01T00:00"), (0, "2024-01-01T00:05"), (1, "2024-01-01T00:01")])
    named = rows.withColumn("key", F.lit("one")).union(rows.where("batch_id = 1").withColumn("key", F.lit("two")))
    found = V.without_repeats(named).collect()
    assert sorted((r.batch_id, r.timestamp) for r in found) == [
        (0, "2024-01-01T00:05"), (1, "2024-01-01T00:01"), (1, "2024-01-01T00:01")
    ]


def test_a_prediction_delivered_twice_is_shown_once(spark):
    frame = spark.range(60).selectExpr(
        "cast(id AS STRING) AS id", "'c' AS comment", "cast(id AS INT) AS n_star", "'' AS label",
        "'' AS predicted_label", "timestamp_seconds(id) AS processing_timestamp",
    )
    again = frame.withColumns({"processing_timestamp": F.expr("processing_timestamp - INTERVAL 1 SECOND"), "label": F.lit("old")})
    recent = V.recent_predictions(frame.union(frame).union(again)).collect()
    assert sorted(r.n_star for r in recent) == list(range(10, 60)) and {r.label for r in recent} == {""}
