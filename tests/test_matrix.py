"""The training matrix against a brute-force merge."""

import datetime as dt
import hashlib
import random

from review_lens.operators.matrix import (
    aspect_matrix,
    aspect_matrix_joined,
    code_counts,
    fill_absent,
)
from review_lens.schema import ASPECTS, OTHERS, SENTIMENT_CODES
from tests.test_labels import read_parts, read_vector

SCHEMA = "id STRING, comment STRING, label STRING, ingestion_timestamp TIMESTAMP"
START = dt.datetime(2024, 1, 1)


def merged(rows):
    """Per comment and aspect: the newest mention; on a tie the id's MD5 decides."""
    best = {}
    for id_, comment, label, at in rows:
        tie = int(hashlib.md5(id_.encode()).hexdigest()[:3], 16) % 512
        parts = read_parts(label)
        if comment is None or not parts:
            continue
        codes = dict(zip(ASPECTS, read_vector(label), strict=True))
        mine = best.setdefault(comment, {})
        for aspect in {a for a, _ in parts} & set(ASPECTS):
            at_ = codes[aspect] if aspect == OTHERS else at or dt.datetime.min
            key = (at_, 0 if aspect == OTHERS else tie, codes[aspect])
            mine[aspect] = max(mine.get(aspect, key), key)
    return {c: [m.get(a, (0, 0, 0))[-1] for a in ASPECTS] for c, m in best.items()}


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of all rows share one comment.
        comment = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", "Ünïcode", "", None])
        pieces = []
        for _ in range(rng.randrange(4)):
            a = rng.choice([*ASPECTS[:4], OTHERS, "FOO"])
            pieces.append("{OTHERS};" if a == OTHERS else "{%s#%s};" % (a, rng.choice([*SENTIMENT_CODES, "Odd"])))
        label = rng.choice([None, "", "plain"]) if rng.random() < 0.1 else "".join(pieces)
        at = None if rng.random() < 0.05 else START + dt.timedelta(seconds=rng.randrange(5))
        rows.append((str(i), comment, label, at))
    return rows


def as_dict(frame):
    rows = frame.collect()
    got = {r["comment"]: [r[a] for a in ASPECTS] for r in rows}
    assert len(got) == len(rows)
    return got


def test_matrix_against_brute_force(spark):
    for seed in range(3):
        rows = random_rows(400, seed)
        frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
        expected = merged(rows)
        assert as_dict(aspect_matrix(frame)) == expected
        assert as_dict(aspect_matrix_joined(frame)) == expected


def test_aspects_nobody_mentions_are_zero(spark):
    frame = spark.createDataFrame([("1", "x", "{OTHERS};", START)], SCHEMA)
    for build in (aspect_matrix, aspect_matrix_joined):
        assert as_dict(build(frame)) == {"x": [0] * 10 + [1]}


def test_unknown_aspects_keep_their_comment(spark):
    frame = spark.createDataFrame([("1", "x", "{FOO#Positive};", START)], SCHEMA)
    for build in (aspect_matrix, aspect_matrix_joined):
        assert as_dict(build(frame)) == {"x": [0] * 11}


def test_times_before_1970(spark):
    old, older = dt.datetime(1960, 1, 2), dt.datetime(1960, 1, 1)
    rows = [("1", "x", "{CAMERA#Negative};", old), ("2", "x", "{CAMERA#Positive};", older)]
    assert as_dict(aspect_matrix(spark.createDataFrame(rows, SCHEMA))) == merged(rows)


def test_matrix_combines_before_its_one_shuffle(spark, tmp_path, plan_of):
    spark.createDataFrame(random_rows(50, 1), SCHEMA).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(aspect_matrix(frame))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("HashAggregate") == 2
    assert "SortAggregate" not in plan and "Python" not in plan
    # Only the columns that matter are read, and the scan drops useless rows.
    assert "ReadSchema: struct<id:string,comment:string,label:string,ingestion_timestamp:timestamp>" in plan
    assert "StringContains(label,{)" in plan


def test_code_counts_cover_every_aspect(spark):
    frame = spark.createDataFrame(random_rows(300, 5), SCHEMA)
    matrix = aspect_matrix(frame)
    counts = {(r.aspect, r.code): r.comments for r in code_counts(matrix).collect()}
    total = matrix.count()
    for a in ASPECTS:
        assert sum(n for (aspect, _), n in counts.items() if aspect == a) == total


def test_fill_absent(spark):
    row = ", ".join(f"cast({'NULL' if i % 2 else i} AS INT) AS `{a}`" for i, a in enumerate(ASPECTS))
    filled = fill_absent(spark.sql(f"SELECT 'c' AS comment, {row}"), "comment").first()
    assert [filled[a] for a in ASPECTS] == [0 if i % 2 else i for i in range(11)]


def test_no_sentiment_has_an_advantage_in_a_tie(spark, plan_of):
    """Three conflicting labels for each comment in one batch: each wins about as often."""
    rows = spark.range(900).selectExpr(
        "concat('review-', id) AS id", "concat('c', id div 3) AS comment",
        "concat('{BATTERY#', element_at(array('Negative', 'Neutral', 'Positive'), cast(id % 3 AS INT) + 1), '};') AS label",
        "timestamp'2024-01-01 00:00:00' AS ingestion_timestamp",
    )
    matrix = aspect_matrix(rows)
    won = {r.BATTERY: r["count"] for r in matrix.groupBy("BATTERY").count().collect()}
    assert sum(won.values()) == 300 and all(70 <= won[c] <= 130 for c in (1, 2, 3))
    plan = plan_of(matrix)
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
