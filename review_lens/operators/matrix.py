"""Labels in long form, and the comment x aspect matrix that models train on."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_lens.functions import labels as L
from review_lens.functions.labels import quoted
from review_lens.operators.keyed import comment_tie, latest_per_key
from review_lens.schema import ASPECTS, OTHERS, RATED_ASPECTS

# Bits of a code, and of the hash of an id that settles which of several reviews of one
# instant counts. What is left holds microseconds until the year 2112.
_CODE_BITS, _ID_BITS = 2, 9
_NEVER = -(1 << 52)


def label_entries(reviews: DataFrame, *keep: str) -> DataFrame:
    """One row per well-formed label part: `keep`, position, aspect, sentiment, code."""
    pair = F.split(L.part_body(F.col("part")), "#")
    rows = reviews.select(*keep, F.posexplode(L.parts("label")).alias("position", "part"))
    rows = rows.select(
        *keep,
        "position",
        F.get(pair, F.lit(0)).alias("aspect"),
        F.get(pair, F.lit(1)).alias("sentiment"),
    )
    return rows.withColumn("code", L.sentiment_code())


def _labelled(reviews: DataFrame, arrived: str) -> DataFrame:
    """Comment, time of arrival and label bits of the reviews that may train models."""
    usable = F.col("comment").isNotNull() & L.maybe_labelled("label")
    return reviews.where(usable).select("comment", arrival_rank(reviews, arrived), L.label_bits().alias("bits"))


def arrival_rank(reviews: DataFrame, arrived: str) -> Column:
    """Time of arrival in microseconds, bits of the id's MD5, and room for a code, in one long.

    All reviews of a micro-batch arrive at one instant. The id decides between them,
    so that no sentiment has an advantage. Reviews without an id share one rank.
    """
    micros = F.unix_micros(F.col(arrived).cast("timestamp"))
    held = F.when(micros.isNull(), _NEVER).otherwise(
        F.greatest(F.least(micros, F.lit(-_NEVER - 1)), F.lit(_NEVER))
    )
    digest = "0"
    if "id" in reviews.columns:
        digest = f"cast(conv(substr(md5(coalesce(id, '')), 1, 3), 16, 10) AS BIGINT) % {1 << _ID_BITS}"
    shifted = F.shiftleft(held, _CODE_BITS + _ID_BITS)
    return shifted.bitwiseOR(F.expr(f"shiftleft(cast({digest} AS BIGINT), {_CODE_BITS})")).alias("at")


def _newest(code: str) -> str:
    """Aggregate that finds the newest code: rank and code in one long.

    A single long per aspect keeps the aggregate in fixed-width buffers, hence
    hashed and combined before the shuffle, however often a comment repeats.
    """
    return f"max(at | cast({code} AS BIGINT))"


def unpacked(aspect: str) -> str:
    return f"cast(coalesce({quoted(aspect)} & 3L, 0L) AS INT) AS {quoted(aspect)}"


def aspect_matrix(reviews: DataFrame, arrived="ingestion_timestamp") -> DataFrame:
    """One row per distinct labelled comment with the newest code of each aspect.

    One shuffle, on `comment`, of one pre-combined row per task and comment.
    Reviews without a comment or without any well-formed label part stay out.
    """
    return _coded(_labelled(reviews, arrived), "comment")


def packed_codes(labelled: DataFrame, key: str) -> DataFrame:
    """For every `key` the newest code of each aspect with its rank, in one long; OTHERS; and
    `any`, which is 0 where no label part is well-formed. All are maxima, hence can be merged."""
    newest = [
        F.expr(f"{_newest(L.code('bits', a))} FILTER (WHERE {L.mentioned('bits', a)})").alias(a)
        for a in RATED_ASPECTS
    ]
    others = F.expr(f"max(cast({L.code('bits', OTHERS)} AS BIGINT))").alias(OTHERS)
    return labelled.groupBy(key).agg(*newest, others, F.max("bits").alias("any"))


def _coded(labelled: DataFrame, key: str) -> DataFrame:
    """The newest code of each aspect for every `key` with a well-formed label part."""
    coded = packed_codes(labelled, key).where("any <> 0")
    return coded.selectExpr(key, *[unpacked(a) for a in RATED_ASPECTS], f"cast({OTHERS} AS INT) AS {OTHERS}")


def landed_matrix(landed: DataFrame, arrived="ingestion_timestamp") -> DataFrame:
    """The matrix of the newest version of each review, straight from all landed versions.

    Versions and labels are worked out on digests of the comments; each distinct text
    is then shuffled once, to where its digest's codes already are.
    """
    digested = landed.withColumn("digest", comment_digest())
    slim = digested.select(
        "id", "digest", F.col("comment").isNotNull().alias("told"), arrived, "date_time", "label",
        comment_tie().alias("tie"), "n_star",
    )
    order = [F.col(c).desc_nulls_last() for c in ("date_time", "label", "tie", "n_star")]
    newest = latest_per_key(slim, "id", arrived, *order)
    usable = newest.where(F.col("told") & L.maybe_labelled("label"))
    coded = _coded(usable.select("digest", arrival_rank(usable, arrived), L.label_bits().alias("bits")), "digest")
    texts = digested.where("comment IS NOT NULL").select("digest", "comment").dropDuplicates(["digest"])
    return texts.join(coded, "digest").drop("digest")


def comment_digest() -> Column:
    """SHA-256 of a comment: 32 bytes that stand for a text of any length.

    Empty, not null, for a null comment: on a key that cannot be null the
    planner adds no filter, which would work out the digest a second time.
    """
    return F.expr("coalesce(unhex(sha2(comment, 256)), X'')")


def aspect_matrix_joined(reviews: DataFrame, arrived="ingestion_timestamp") -> DataFrame:
    """The same matrix as distinct comments, left-joined to a pivot and to a flag.

    The pivot list is explicit, so no extra job looks for values and an aspect
    nobody mentions is a column of zeros. Every side is unique per comment, so
    the joins do not multiply rows. Pivot and flag carry the digest of their
    comment instead of its text, which leaves the text out of most shuffles.
    """
    labelled = _labelled(reviews, arrived)
    pairs = ", ".join(
        f"struct('{a}' AS aspect, if({L.mentioned('bits', a)}, {L.code('bits', a)}, NULL) AS code)"
        for a in ASPECTS
    )
    digested = labelled.select(comment_digest().alias("digest"), "at", "bits")
    mentions = digested.selectExpr("digest", "at", f"inline(array({pairs}))")
    mentions = mentions.where("code IS NOT NULL")
    pivoted = (
        mentions.where(F.col("aspect") != OTHERS)
        .groupBy("digest")
        .pivot("aspect", list(RATED_ASPECTS))
        .agg(F.expr(_newest("code")))
    )
    flags = mentions.groupBy("digest").agg(
        F.max(F.when(F.col("aspect") == OTHERS, 1).otherwise(0)).alias(OTHERS)
    )
    comments = labelled.where("bits <> 0").select("comment").distinct()
    comments = comments.withColumn("digest", comment_digest())
    joined = comments.join(pivoted, "digest", "left").join(flags, "digest", "left")
    rated = [unpacked(a) for a in RATED_ASPECTS]
    return fill_absent(joined.selectExpr("comment", *rated, OTHERS), "comment")


def fill_absent(matrix: DataFrame, *keep: str) -> DataFrame:
    """Replace the missing codes of a wide matrix by 0."""
    filled = [f"cast(coalesce({quoted(a)}, 0) AS INT) AS {quoted(a)}" for a in ASPECTS]
    return matrix.selectExpr(*keep, *filled)


def code_counts(matrix: DataFrame) -> DataFrame:
    """Rows per aspect and code, i.e. the class distribution of every model."""
    pairs = ", ".join(f"struct('{a}' AS aspect, {quoted(a)} AS code)" for a in ASPECTS)
    return (
        matrix.selectExpr(f"inline(array({pairs}))")
        .groupBy("aspect", "code")
        .agg(F.count(F.lit(1)).alias("comments"))
    )
