"""Reviews derived from the given tables, in Spark and in SQL.

`documents` supplies comments, `labels` the real annotations behind GENERAL and
OTHERS; the other aspects follow arithmetic on `doc_id`.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_lens.functions.labels import encode
from review_lens.schema import ASPECTS, OTHERS, SENTIMENT_NAMES

GENERAL = "GENERAL"
ARRIVAL_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(j: int, aspect: str) -> str:
    if aspect == GENERAL:
        return "CASE quality WHEN 1 THEN 3 WHEN 0 THEN 1 ELSE 0 END"
    if aspect == OTHERS:
        return "CASE toxic WHEN 1 THEN 1 ELSE 0 END"
    e = f"cast((doc_id * {j + 1} + {3 * j}) % 11 AS INT)"
    return f"if({e} <= 3, {e}, 0)"


def arrival():
    """When a review came in: every 256 reviews share one instant."""
    minutes = f"make_dt_interval(0, 0, cast(doc_id div {ARRIVAL_ROWS} AS INT))"
    return F.expr(f"TIMESTAMP_NTZ'2024-02-01 00:00:00' + {minutes}")


def coded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text and one code column per aspect."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    codes = [f"{_code(j, a)} AS `{a}`" for j, a in enumerate(ASPECTS)]
    return joined.selectExpr("doc_id", "text", *codes)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, id, comment, n_star, date_time, label, ingestion_timestamp."""
    doc_id = F.col("doc_id")
    posted = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return coded_documents(spark, sf_dir).select(
        "doc_id",
        doc_id.cast("string").alias("id"),
        F.col("text").alias("comment"),
        (1 + doc_id % 5).cast("int").alias("n_star"),
        (posted + F.make_dt_interval(secs=doc_id.cast("decimal(18,6)"))).alias("date_time"),
        encode().alias("label"),
        arrival().alias("ingestion_timestamp"),
    )


def wire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reviews as JSON messages: doc_id, value."""
    stamp = F.date_format("date_time", "yyyy-MM-dd'T'HH:mm:ss")
    row = F.struct("id", "comment", "n_star", stamp.alias("date_time"), "label")
    return reviews(spark, sf_dir).select("doc_id", F.to_json(row).alias("value"))


def predicted(spark: SparkSession, sf_dir: str, rows_per_batch=ARRIVAL_ROWS) -> DataFrame:
    """Codes with made-up predictions that are wrong here and there, in batches."""
    batch = f"cast(doc_id div {rows_per_batch} AS BIGINT) AS batch_id"
    truth = [f"`{a}` AS `{a}_true`" for a in ASPECTS]
    guesses = [
        f"(`{a}` + if((doc_id + {j}) % 37 = 0, 1, 0)) % {2 if a == OTHERS else 4} AS `{a}_pred`"
        for j, a in enumerate(ASPECTS)
    ]
    return coded_documents(spark, sf_dir).selectExpr("doc_id", "text", batch, *truth, *guesses)


# --- the same, as SQL -------------------------------------------------------


def _q(name: str) -> str:
    return '"' + name + '"'


def _code_sql(j: int, aspect: str) -> str:
    if aspect == GENERAL:
        return "CASE WHEN l.quality = 1 THEN 3 WHEN l.quality = 0 THEN 1 ELSE 0 END"
    if aspect == OTHERS:
        return "CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END"
    e = f"(d.doc_id * {j + 1} + {3 * j}) % 11"
    return f"CAST(CASE WHEN {e} <= 3 THEN {e} ELSE 0 END AS INTEGER)"


def _piece_sql(aspect: str) -> str:
    if aspect == OTHERS:
        return "CASE WHEN " + _q(aspect) + " = 1 THEN '{OTHERS};' ELSE '' END"
    whens = " ".join(f"WHEN {c} THEN '{{{aspect}#{s}}};'" for c, s in SENTIMENT_NAMES.items())
    return f"CASE {_q(aspect)} {whens} ELSE '' END"


CODED_SQL = (
    "coded AS (SELECT d.doc_id, d.text, "
    + ", ".join(f"{_code_sql(j, a)} AS {_q(a)}" for j, a in enumerate(ASPECTS))
    + " FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)

REVIEWS_SQL = (
    CODED_SQL
    + ", reviews AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, text AS comment, "
    + "CAST(1 + doc_id % 5 AS INTEGER) AS n_star, "
    + "TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS date_time, "
    + " || ".join(_piece_sql(a) for a in ASPECTS)
    + " AS label, "
    + f"TIMESTAMP '2024-02-01 00:00:00' + to_minutes(doc_id // {ARRIVAL_ROWS}) "
    + "AS ingestion_timestamp FROM coded)"
)

# Long form, by plain string splitting: one row per part of a label.
ENTRIES_SQL = (
    REVIEWS_SQL
    + """, cut AS (
  SELECT doc_id, id, comment, ingestion_timestamp,
         list_filter(string_split(label, ';'), lambda p: p <> '') AS parts FROM reviews),
placed AS (
  SELECT doc_id, id, comment, ingestion_timestamp,
         unnest(range(len(parts))) AS position, unnest(parts) AS part FROM cut),
named AS (
  SELECT *, string_split(trim(part, '{}'), '#') AS pair FROM placed),
entries AS (
  SELECT doc_id, id, comment, ingestion_timestamp, CAST(position AS INTEGER) AS position,
         pair[1] AS aspect, pair[2] AS sentiment,
         CASE WHEN pair[1] = 'OTHERS' THEN 1 WHEN pair[2] = 'Negative' THEN 1
              WHEN pair[2] = 'Neutral' THEN 2 WHEN pair[2] = 'Positive' THEN 3
              ELSE 0 END AS code
  FROM named)"""
)


def _pick(aspect: str) -> str:
    code = f"max(code) FILTER (WHERE aspect = '{aspect}')"
    return f"CAST(coalesce({code}, 0) AS INTEGER) AS {_q(aspect)}"


# Newest arrival per comment and aspect; bits of the id's hash settle a tie.
MATRIX_SQL = (
    ENTRIES_SQL
    + """, ranked AS (
  SELECT comment, aspect, code, row_number() OVER (
    PARTITION BY comment, aspect ORDER BY ingestion_timestamp DESC,
    CAST('0x' || substr(md5(id), 1, 3) AS BIGINT) % 512 DESC, code DESC) AS rank
  FROM entries WHERE comment IS NOT NULL),
matrix AS (SELECT comment, """
    + ", ".join(_pick(a) for a in ASPECTS)
    + " FROM ranked WHERE rank = 1 GROUP BY comment)"
)

PREDICTED_SQL = (
    CODED_SQL
    + f", predicted AS (SELECT doc_id, text, doc_id // {ARRIVAL_ROWS} AS batch_id, "
    + ", ".join(
        f"{_q(a)} AS {_q(a + '_true')}, "
        f"({_q(a)} + CASE WHEN (doc_id + {j}) % 37 = 0 THEN 1 ELSE 0 END) % "
        f"{2 if a == OTHERS else 4} AS {_q(a + '_pred')}"
        for j, a in enumerate(ASPECTS)
    )
    + " FROM coded), pairs AS ("
    + " UNION ALL ".join(
        f"SELECT doc_id, batch_id, {j} AS place, CAST({_q(a + '_true')} AS INTEGER) AS true_code, "
        f"CAST({_q(a + '_pred')} AS INTEGER) AS predicted_code FROM predicted"
        for j, a in enumerate(ASPECTS)
    )
    + ")"
)

METRICS_SQL = (
    PREDICTED_SQL
    + """, classes AS (
  SELECT batch_id, true_code AS class FROM pairs UNION SELECT batch_id, predicted_code FROM pairs),
tallies AS (
  SELECT c.batch_id, c.class,
         count(*) FILTER (WHERE p.true_code = c.class AND p.predicted_code = c.class) AS tp,
         count(*) FILTER (WHERE p.true_code <> c.class AND p.predicted_code = c.class) AS fp,
         count(*) FILTER (WHERE p.true_code = c.class AND p.predicted_code <> c.class) AS fn
  FROM classes c JOIN pairs p ON p.batch_id = c.batch_id GROUP BY c.batch_id, c.class),
macro AS (
  SELECT batch_id, avg(2.0 * tp / (2 * tp + fp + fn)) AS f1_macro,
         2.0 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) AS f1_micro
  FROM tallies GROUP BY batch_id),
whole AS (
  SELECT batch_id, doc_id, count(*) FILTER (WHERE true_code = predicted_code) AS same
  FROM pairs GROUP BY batch_id, doc_id),
exact AS (
  SELECT batch_id, avg(same / 11.0) AS accuracy_per_label,
         avg(CASE WHEN same = 11 THEN 1.0 ELSE 0.0 END) AS exact_match_accuracy,
         count(*) AS total_records
  FROM whole GROUP BY batch_id),
metrics AS (SELECT e.batch_id, accuracy_per_label, exact_match_accuracy, f1_micro, f1_macro,
                   total_records FROM exact e JOIN macro m ON m.batch_id = e.batch_id)"""
)

# Tokens as the tokeniser cuts them: one separator each, no empty ones at the end.
TOKENS_SQL = r"""pieces AS (
  SELECT doc_id, lower(text) AS low, regexp_replace(lower(text), '[ \t\n\x0B\f\r]+$', '') AS body
  FROM documents),
tokens AS (
  SELECT doc_id, unnest(CASE WHEN body = '' AND low <> '' THEN []
         ELSE string_split_regex(body, '[ \t\n\x0B\f\r]') END) AS term
  FROM pieces)"""
