"""Queries over records on the wire, files, the landed table and slices."""

from pyspark.sql import functions as F

from review_lens.functions.records import accepted, as_messages, parse_records, rejected
from review_lens.operators import slices as S
from review_lens.operators.keyed import latest_per_key
from review_lens.operators.slices import feed_namespace
from review_lens.plans import fixtures as P
from review_lens.schema import CSV_SCHEMA, REVIEW_COLUMNS, SLICE_ROWS, WIRE_SCHEMA
from review_lens.session import scratch_dir
from review_lens.sinks.tables import compact, create_review_table, land_reviews
from review_lens.sinks.topics import file_outlet
from review_lens.sources.delimited import read_split_csv
from review_lens.sources.reviews import CSV_FORMAT, read_landed, read_review_csv, read_reviews
from review_lens.sources.topics import read_messages
from review_lens.streaming.jobs import publish_feed


_FEED = "reviews/resumed"


def _plain_time(name):
    return F.col(name).cast("timestamp_ntz").alias(name)


def review_json_out(spark, sf_dir):
    """Reviews as keyed JSON messages."""
    rows = P.reviews(spark, sf_dir).select("id", "comment", "n_star", "label")
    return as_messages(rows, key="id")


def review_json_in(spark, sf_dir):
    """JSON messages back to typed reviews."""
    parsed = accepted(parse_records(P.wire_records(spark, sf_dir)))
    return parsed.select("id", "comment", "n_star", _plain_time("date_time"), "label")


def event_json_in(spark, sf_dir):
    """The JSON properties of events, parsed with a fixed schema."""
    parsed = F.from_json("props", "k BIGINT").alias("data")
    return P.table(spark, sf_dir, "events").select("event_id", parsed).select("event_id", "data.k")


def _damage(kind, value):
    return (
        F.when(kind == 1, F.substring(value, 1, 7))
        .when(kind == 2, F.regexp_replace(value, '^\\{"id":"[0-9]+",', "{"))
        .when(kind == 3, F.regexp_replace(value, '"n_star":([0-9])', '"n_star":$1.5'))
        .when(kind == 4, F.regexp_replace(value, '"date_time":"', '"date_time":"x'))
        .when(kind == 5, F.regexp_replace(value, '"comment":', '"comments":'))
        .when(kind == 6, F.regexp_replace(value, '^\\{', '{"extra":[1],'))
        .otherwise(value)
    )


def damaged_messages(spark, sf_dir):
    """Messages of which some are cut short, lack a field or hold a wrong type."""
    kind = F.col("doc_id") % 9
    # Through a lambda, so that `value` is not copied into every branch.
    damaged = F.get(F.transform(F.array("value"), lambda value: _damage(kind, value)), F.lit(0))
    return P.wire_records(spark, sf_dir).select("doc_id", damaged.alias("value"))


def damaged_json_in(spark, sf_dir):
    """What survives of damaged messages: wrong fields become null, the rest stays."""
    parsed = accepted(parse_records(damaged_messages(spark, sf_dir)))
    return parsed.select(
        "id",
        "comment",
        F.coalesce("n_star", F.lit(-1)).alias("n_star"),
        F.date_format("date_time", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
        "label",
    ).fillna("", ["date_time"])


def malformed_quarantine(spark, sf_dir):
    """Damaged messages that cannot be stored, counted by reason."""
    parsed = parse_records(damaged_messages(spark, sf_dir))
    return rejected(parsed).groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


def review_csv_in(spark, sf_dir):
    """Reviews through delimited files with quoted line breaks."""
    path = scratch_dir(spark, "csv")
    stamp = F.date_format("date_time", "yyyy-MM-dd'T'HH:mm:ss").alias("date_time")
    rows = P.reviews(spark, sf_dir).select("comment", "n_star", stamp, "label")
    rows.write.options(**CSV_FORMAT).csv(path)
    # An empty field reads as null.
    return read_review_csv(spark, path).fillna("", ["label"])


def review_csv_split(spark, sf_dir):
    """The same files with each of them split among tasks, records with line breaks and all."""
    path = scratch_dir(spark, "csv")
    stamp = F.date_format("date_time", "yyyy-MM-dd'T'HH:mm:ss").alias("date_time")
    rows = P.reviews(spark, sf_dir).select("comment", "n_star", stamp, "label")
    rows.write.options(**CSV_FORMAT).csv(path)
    return read_split_csv(spark, path, CSV_SCHEMA, CSV_FORMAT).drop("file", "place").fillna("", ["label"])


def resumed_feed(spark, sf_dir):
    """A publication that stopped after its first slice and went on: each record once, under an
    id that its place and content give."""
    path = scratch_dir(spark, "resumed")
    rows = P.reviews(spark, sf_dir).select("doc_id", "comment", "n_star", "label")
    size = -(-rows.count() // 3)
    for most in (1, None, None):
        publish_feed(rows, file_outlet(path), _FEED, "doc_id", size=size, most=most)
    sent = read_messages(spark, path).select(
        F.col("batch_id").alias("slice"), F.from_json("value", WIRE_SCHEMA).alias("data")
    )
    return sent.select("slice", "data.id", "data.n_star", "data.label")


def batch_slices(spark, sf_dir):
    """Slices of a table whose key already counts its rows."""
    rows = P.reviews(spark, sf_dir).select("id", F.col("doc_id").alias("row_index"))
    return S.slice_rows(rows)


def batch_slices_wrapped(spark, sf_dir):
    """Two rounds of the same slices: after the last one the feed starts again."""
    return S.replay(batch_slices(spark, sf_dir), 2)


def numbered_slices(spark, sf_dir):
    """Slices of a table without row numbers, in the order of its key."""
    turns = P.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return S.slice_rows(S.number_rows(turns, "conv_id", "turn"))


def feed_records(spark, sf_dir):
    """Records as a feed sends them: a fresh id and the time of sending."""
    path = scratch_dir(spark, "feed")
    rows = P.reviews(spark, sf_dir).select(
        F.col("doc_id").alias("row_index"), "comment", "n_star", "label"
    )
    sent = S.feed_records(S.slice_rows(rows))
    value = F.to_json(F.struct("id", "comment", "n_star", "date_time", "label"))
    sent.select("slice", "row_index", value.alias("value")).write.parquet(path)
    read = spark.read.parquet(path)
    fields = F.from_json("value", WIRE_SCHEMA).alias("data")
    received = read.select("slice", "row_index", fields)
    return received.select(
        "slice",
        "row_index",
        "data.comment",
        "data.n_star",
        F.rlike("data.id", F.lit("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("has_id"),
        F.col("data.date_time").try_cast("timestamp").isNotNull().alias("has_time"),
    )


def latest_event_per_user(spark, sf_dir):
    """The newest event of every user."""
    events = P.table(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", "ts", "event_id")


def _land_twice(spark, sf_dir, path, name=None):
    """Land all reviews, run that batch again, then land corrections of some."""
    rows = P.reviews(spark, sf_dir).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("date_time", "ingestion_timestamp")}
    )
    land_reviews(rows, path, "train", "first", 0, name)
    land_reviews(rows, path, "train", "first", 0, name)
    later = rows.where("n_star = 1").withColumns(
        {
            "n_star": F.lit(5),
            "ingestion_timestamp": F.col("ingestion_timestamp") + F.expr("INTERVAL 1 DAY"),
        }
    )
    land_reviews(later, path, "test", "second", 0, name)


def _as_stored(reviews):
    columns = [_plain_time(c) if c.endswith(("_time", "_timestamp")) else c for c in REVIEW_COLUMNS]
    return reviews.select(*columns)


def latest_review_per_id(spark, sf_dir):
    """Upserts: replayed and corrected reviews read back as one row per id."""
    path = scratch_dir(spark, "reviews")
    _land_twice(spark, sf_dir, path)
    return _as_stored(read_reviews(spark, path))


def compacted_reviews(spark, sf_dir):
    """All that is stored after the versions were merged in place."""
    path = scratch_dir(spark, "reviews")
    _land_twice(spark, sf_dir, path)
    compact(spark, path)
    return _as_stored(read_landed(spark, path))


def keyed_table_ddl(spark, sf_dir):
    """The landed table as a catalog table: defined, filled, read by partition."""
    path = scratch_dir(spark, "catalog")
    name = "reviews_" + path.rsplit("-", 1)[1]
    create_review_table(spark, name, path)
    create_review_table(spark, name, path)
    _land_twice(spark, sf_dir, path, name)
    counts = spark.table(name).groupBy("source", "batch_id")
    return counts.agg(F.count(F.lit(1)).alias("reviews"))


_STAMPED = "id, comment, n_star, date_time, label"

_DAMAGED_SQL = (
    P.REVIEWS_SQL
    + """, damaged AS (
  SELECT doc_id % 9 AS kind, CASE WHEN doc_id % 9 = 3 THEN -1 ELSE n_star END AS n_star,
         CASE WHEN doc_id % 9 = 4 THEN ''
              ELSE strftime(date_time, '%Y-%m-%d %H:%M:%S') END AS date_time,
         id, comment, label FROM reviews)"""
)

_LATEST_SQL = (
    P.REVIEWS_SQL
    + """, latest AS (
  SELECT id, comment, CAST(CASE WHEN n_star = 1 THEN 5 ELSE n_star END AS INTEGER) AS n_star,
         date_time, label,
         CASE WHEN n_star = 1 THEN ingestion_timestamp + INTERVAL 1 DAY
              ELSE ingestion_timestamp END AS ingestion_timestamp
  FROM reviews)"""
)

_SLICES_SQL = (
    P.REVIEWS_SQL
    + f", slices AS (SELECT id, doc_id AS row_index, doc_id // {SLICE_ROWS} AS slice FROM reviews)"
)

QUERIES = {
    "review_json_out": (
        review_json_out,
        f"WITH {P.REVIEWS_SQL} SELECT id AS key, CAST(to_json({{'id': id, 'comment': comment, "
        "'n_star': n_star, 'label': label}) AS VARCHAR) AS value FROM reviews",
    ),
    "review_json_in": (
        review_json_in,
        f"WITH {P.REVIEWS_SQL} SELECT {_STAMPED} FROM reviews",
    ),
    "event_json_in": (
        event_json_in,
        "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    ),
    "damaged_json_in": (
        damaged_json_in,
        f"WITH {_DAMAGED_SQL} SELECT {_STAMPED} FROM damaged WHERE kind NOT IN (1, 2, 5)",
    ),
    "malformed_quarantine": (
        malformed_quarantine,
        f"WITH {_DAMAGED_SQL} SELECT CASE kind WHEN 1 THEN 'unparsable' WHEN 2 THEN 'missing id' "
        "ELSE 'missing comment' END AS reason, count(*) AS messages FROM damaged "
        "WHERE kind IN (1, 2, 5) GROUP BY 1",
    ),
    "review_csv_in": (
        review_csv_in,
        f"WITH {P.REVIEWS_SQL} SELECT comment, n_star, "
        "strftime(date_time, '%Y-%m-%dT%H:%M:%S') AS date_time, label FROM reviews",
    ),
    "review_csv_split": (
        review_csv_split,
        f"WITH {P.REVIEWS_SQL} SELECT comment, n_star, "
        "strftime(date_time, '%Y-%m-%dT%H:%M:%S') AS date_time, label FROM reviews",
    ),
    "resumed_feed": (
        resumed_feed,
        f"WITH {P.REVIEWS_SQL}, sizes AS (SELECT (count(*) + 2) // 3 AS size FROM reviews), "
        f"hashed AS (SELECT doc_id, n_star, label, sha1(unhex('{feed_namespace(_FEED).hex}') || "
        "encode(concat(doc_id, ':', comment, chr(31), n_star, chr(31), label))) AS h FROM reviews) "
        "SELECT doc_id // (SELECT size FROM sizes) AS slice, concat(substr(h, 1, 8), '-', substr(h, 9, 4), "
        "'-5', substr(h, 14, 3), '-', substr('89ab', CAST(('0x' || substr(h, 17, 1)) AS BIGINT) % 4 + 1, 1), "
        "substr(h, 18, 3), '-', substr(h, 21, 12)) AS id, n_star, label FROM hashed",
    ),
    "batch_slices": (
        batch_slices,
        f"WITH {_SLICES_SQL} SELECT id, row_index, slice FROM slices",
    ),
    "batch_slices_wrapped": (
        batch_slices_wrapped,
        f"WITH {_SLICES_SQL}, n AS (SELECT max(slice) + 1 AS n FROM slices) "
        "SELECT id, row_index, slice, slice AS tick FROM slices UNION ALL "
        "SELECT id, row_index, slice, slice + (SELECT n FROM n) AS tick FROM slices",
    ),
    "numbered_slices": (
        numbered_slices,
        "WITH numbered AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_index, "
        "conv_id, turn, text FROM conversations) "
        f"SELECT row_index, conv_id, turn, text, row_index // {SLICE_ROWS} AS slice FROM numbered",
    ),
    "feed_records": (
        feed_records,
        f"WITH {P.REVIEWS_SQL} SELECT doc_id // {SLICE_ROWS} AS slice, doc_id AS row_index, "
        "comment, n_star, true AS has_id, true AS has_time FROM reviews",
    ),
    "latest_event_per_user": (
        latest_event_per_user,
        "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER ("
        "PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) AS u WHERE r = 1",
    ),
    "latest_review_per_id": (
        latest_review_per_id,
        f"WITH {_LATEST_SQL} SELECT * FROM latest",
    ),
    "compacted_reviews": (
        compacted_reviews,
        f"WITH {_LATEST_SQL} SELECT * FROM latest",
    ),
    "keyed_table_ddl": (
        keyed_table_ddl,
        f"WITH {P.REVIEWS_SQL} SELECT 'train' AS source, CAST(0 AS BIGINT) AS batch_id, "
        "count(*) AS reviews FROM reviews UNION ALL "
        "SELECT 'test', CAST(0 AS BIGINT), count(*) FROM reviews WHERE n_star = 1",
    ),
}
