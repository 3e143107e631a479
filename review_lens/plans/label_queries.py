"""Queries over the label grammar and the aspect matrix."""

from pyspark.sql import functions as F

from review_lens.functions import labels as L
from review_lens.operators import matrix as X
from review_lens.plans import fixtures as P
from review_lens.schema import ASPECTS, OTHERS


def review_records(spark, sf_dir):
    """The review table itself."""
    return P.reviews(spark, sf_dir)


def label_entries(spark, sf_dir):
    """Labels in long form: one row per part, with its place and code."""
    return X.label_entries(P.reviews(spark, sf_dir), "id")


def aspect_matrix(spark, sf_dir):
    """Distinct comments by aspect, newest code first: the training matrix."""
    return X.aspect_matrix(P.reviews(spark, sf_dir))


def aspect_matrix_joined(spark, sf_dir):
    """The training matrix composed of a pivot, a flag and two left joins."""
    return X.aspect_matrix_joined(P.reviews(spark, sf_dir))


def aspect_sentiment_counts(spark, sf_dir):
    """Class distribution of every aspect model."""
    return X.code_counts(X.aspect_matrix(P.reviews(spark, sf_dir)))


def label_decode_array(spark, sf_dir):
    """Label to vector, shown as text."""
    vectors = L.decoded(P.reviews(spark, sf_dir).select("id", "label"))
    return vectors.select("id", F.array_join(L.aspect_array(), ",").alias("codes"))


def label_encode_roundtrip(spark, sf_dir):
    """Label to codes and back again."""
    decoded = L.decoded(P.reviews(spark, sf_dir).select("id", "label"))
    encoded = decoded.select("id", "label", L.encode().alias("encoded"))
    return encoded.withColumn("same", F.col("label") == F.col("encoded"))


def _damage(kind, label):
    return (
        F.when(kind == 1, F.regexp_replace(label, ";$", ""))
        .when(kind == 2, F.regexp_replace(label, "}", ""))
        .when(kind == 3, F.regexp_replace(label, "[{}]", ""))
        .when(kind == 4, F.regexp_replace(label, r"\};\{", "}{"))
        .when(kind == 5, F.regexp_replace(label, r"\{", " {"))
        .when(kind == 6, F.lower(label))
        .when(kind == 7, F.concat(label, F.lit("{CAMERA#Negative};{PRICE#Odd};")))
        .when(kind == 8, F.concat(F.lit("{OTHERS#Positive};"), label))
        .when(kind == 9, F.concat(F.lit("{FOO#Positive};{SCREEN#Neutral#Positive};"), label))
        .when(kind == 10, F.lit(None))
        .when(kind == 11, F.concat(F.lit(" \t"), label, F.lit("\n")))
        .when(kind == 12, F.regexp_replace(label, r"\{([^;]*)\};", "{{$1}}x;;"))
        .otherwise(label)
    )


def _damaged(spark, sf_dir):
    """Reviews whose labels are damaged in twelve ways, by turns."""
    kind = F.col("doc_id") % 13
    # Through a lambda, so that a filter on the result does not copy `label` into every branch.
    damaged = F.get(F.transform(F.array("label"), lambda label: _damage(kind, label)), F.lit(0))
    return P.reviews(spark, sf_dir).withColumn("label", damaged)


def damaged_label_decode(spark, sf_dir):
    """The vector of labels that break the grammar."""
    vectors = L.decoded(_damaged(spark, sf_dir).select("id", "label"))
    return vectors.select("id", "label", F.array_join(L.aspect_array(), ",").alias("codes"))


def damaged_label_matrix(spark, sf_dir):
    """The training matrix of labels that break the grammar."""
    return X.aspect_matrix(_damaged(spark, sf_dir))


def distinct_comments(spark, sf_dir):
    """Comments that carry at least one label part."""
    labelled = P.reviews(spark, sf_dir).where(L.label_bits() != 0)
    return labelled.where(F.col("comment").isNotNull()).select("comment").distinct()


def others_flag(spark, sf_dir):
    """Whether any review of a comment carries the OTHERS mark."""
    bits = P.reviews(spark, sf_dir).select("comment", L.label_bits().alias("bits")).where("bits <> 0")
    return bits.groupBy("comment").agg(F.expr(f"max({L.code('bits', OTHERS)})").alias("OTHERS"))


_DAMAGED_SQL = (
    P.REVIEWS_SQL
    + r""", damaged AS (SELECT doc_id, id, comment, ingestion_timestamp, CASE doc_id % 13
    WHEN 1 THEN regexp_replace(label, ';$', '')
    WHEN 2 THEN replace(label, '}', '')
    WHEN 3 THEN replace(replace(label, '{', ''), '}', '')
    WHEN 4 THEN replace(label, '};{', '}{')
    WHEN 5 THEN replace(label, '{', ' {')
    WHEN 6 THEN lower(label)
    WHEN 7 THEN label || '{CAMERA#Negative};{PRICE#Odd};'
    WHEN 8 THEN '{OTHERS#Positive};' || label
    WHEN 9 THEN '{FOO#Positive};{SCREEN#Neutral#Positive};' || label
    WHEN 10 THEN NULL
    WHEN 11 THEN ' ' || chr(9) || label || chr(10)
    WHEN 12 THEN replace(replace(label, '{', '{{'), '};', '}}x;;')
    ELSE label END AS label FROM reviews),
pieces AS (
  SELECT doc_id, comment, ingestion_timestamp,
         string_split(trim(label, ' ' || chr(9) || chr(10)), ';') AS parts FROM damaged),
placed AS (
  SELECT doc_id, comment, ingestion_timestamp, unnest(range(len(parts))) AS position,
         unnest(parts) AS part FROM pieces),
valid AS (
  SELECT *, string_split(trim(part, '{}'), '#') AS pair FROM placed
  WHERE part = '{OTHERS}' OR (starts_with(part, '{') AND len(string_split(part, '#')) = 2)),
named AS (
  SELECT doc_id, comment, ingestion_timestamp, position, pair[1] AS aspect,
         CASE WHEN pair[1] = 'OTHERS' THEN 1 WHEN pair[2] = 'Negative' THEN 1
              WHEN pair[2] = 'Neutral' THEN 2 WHEN pair[2] = 'Positive' THEN 3
              ELSE 0 END AS code FROM valid),
own AS (
  SELECT doc_id, comment, ingestion_timestamp, aspect, arg_max(code, position) AS code
  FROM named GROUP BY doc_id, comment, ingestion_timestamp, aspect)"""
)


def _own_code(aspect):
    return f"coalesce(max(code) FILTER (WHERE aspect = '{aspect}'), 0)"


_VECTOR_SQL = " || ',' || ".join(
    f"CAST(coalesce(max(o.code) FILTER (WHERE o.aspect = '{a}'), 0) AS VARCHAR)" for a in ASPECTS
)

_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS aspect, \"{a}\" AS code FROM matrix" for a in ASPECTS
)

_COLUMNS_SQL = ", ".join(f'"{a}"' for a in ASPECTS)

QUERIES = {
    "review_records": (review_records, f"WITH {P.REVIEWS_SQL} SELECT * FROM reviews"),
    "label_entries": (
        label_entries,
        f"WITH {P.ENTRIES_SQL} SELECT id, position, aspect, sentiment, code FROM entries",
    ),
    "aspect_matrix": (
        aspect_matrix,
        f"WITH {P.MATRIX_SQL} SELECT comment, {_COLUMNS_SQL} FROM matrix",
    ),
    "aspect_matrix_joined": (
        aspect_matrix_joined,
        f"WITH {P.MATRIX_SQL} SELECT comment, {_COLUMNS_SQL} FROM matrix",
    ),
    "aspect_sentiment_counts": (
        aspect_sentiment_counts,
        f"WITH {P.MATRIX_SQL} SELECT aspect, code, count(*) AS comments "
        f"FROM ({_COUNTS_SQL}) AS u GROUP BY aspect, code",
    ),
    "label_decode_array": (
        label_decode_array,
        f"WITH {P.ENTRIES_SQL} SELECT r.id, {_VECTOR_SQL} AS codes "
        "FROM reviews r LEFT JOIN entries o ON o.doc_id = r.doc_id GROUP BY r.id",
    ),
    "label_encode_roundtrip": (
        label_encode_roundtrip,
        f"WITH {P.REVIEWS_SQL} SELECT id, label, label AS encoded, true AS same FROM reviews",
    ),
    "damaged_label_decode": (
        damaged_label_decode,
        f"WITH {_DAMAGED_SQL} SELECT r.id, r.label, {_VECTOR_SQL} AS codes "
        "FROM damaged r LEFT JOIN own o ON o.doc_id = r.doc_id GROUP BY r.id, r.label",
    ),
    "damaged_label_matrix": (
        damaged_label_matrix,
        f"WITH {_DAMAGED_SQL}, ranked AS (SELECT comment, aspect, code, row_number() OVER ("
        "PARTITION BY comment, aspect ORDER BY ingestion_timestamp DESC, "
        "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 3) AS BIGINT) % 512 DESC, code DESC) AS rank "
        "FROM own) SELECT comment, "
        + ", ".join(f"CAST({_own_code(a)} AS INTEGER) AS \"{a}\"" for a in ASPECTS)
        + " FROM ranked WHERE rank = 1 AND comment IS NOT NULL GROUP BY comment",
    ),
    "distinct_comments": (
        distinct_comments,
        f"WITH {P.ENTRIES_SQL} SELECT DISTINCT comment FROM entries",
    ),
    "others_flag": (
        others_flag,
        f"WITH {P.ENTRIES_SQL} SELECT comment, "
        "CAST(max(CASE WHEN aspect = 'OTHERS' THEN 1 ELSE 0 END) AS INTEGER) AS \"OTHERS\" "
        "FROM entries GROUP BY comment",
    ),
}
