"""Quality of predicted label vectors, computed where the rows are."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.functions.labels import quoted
from review_lens.operators.matrix import comment_digest
from review_lens.schema import ASPECTS, CODES


def flattened_pairs(rows: DataFrame, *keep: str, true="true_array", predicted="prediction_array"):
    """One row per review and aspect: the true and the predicted code."""
    zipped = F.arrays_zip(F.col(true).alias("true_code"), F.col(predicted).alias("predicted_code"))
    return rows.select(*keep, F.inline(zipped).alias("true_code", "predicted_code"))


def confusion_tallies(pairs: DataFrame, batch="batch_id") -> DataFrame:
    """True positives, false positives and false negatives per batch and class.

    The pairs are counted first; what is left to rearrange is at most one row
    per batch and pair of codes.
    """
    counted = pairs.groupBy(batch, "true_code", "predicted_code").agg(
        F.count(F.lit(1)).alias("n")
    )
    right = F.col("true_code") == F.col("predicted_code")
    zero = F.lit(0).cast("bigint")
    n = F.col("n")
    as_true = F.struct(
        F.col("true_code").alias("class"),
        F.when(right, n).otherwise(zero).alias("tp"),
        zero.alias("fp"),
        F.when(~right, n).otherwise(zero).alias("fn"),
    )
    as_predicted = F.struct(
        F.col("predicted_code").alias("class"),
        zero.alias("tp"),
        F.when(~right, n).otherwise(zero).alias("fp"),
        zero.alias("fn"),
    )
    return (
        counted.select(batch, F.inline(F.array(as_true, as_predicted)))
        .groupBy(batch, "class")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    )


def _outcomes(true: str, predicted: str) -> str:
    """A row's outcomes as small ints: 4 * true + predicted per aspect, then 16 or 17.

    The last one says whether the whole vector is right (16) or not (17).
    """
    pairs = [(quoted(a + true), quoted(a + predicted)) for a in ASPECTS]
    codes = ", ".join(f"4 * {t} + {p}" for t, p in pairs)
    whole = " AND ".join(f"{t} = {p}" for t, p in pairs)
    return f"explode(array({codes}, if({whole}, 16, 17))) AS outcome"


def _tallies() -> list:
    """Per class: hits, and occurrences on either side; then whole vectors."""

    def total(condition, name):
        return F.expr(f"sum(if({condition}, n, 0L))").alias(name)

    hits = [total(f"outcome = {5 * k}", f"tp_{k}") for k in CODES]
    true = [total(f"outcome < 16 AND outcome div 4 = {k}", f"true_{k}") for k in CODES]
    guess = [total(f"outcome < 16 AND outcome % 4 = {k}", f"pred_{k}") for k in CODES]
    whole = [total("outcome = 16", "exact"), total("outcome >= 16", "total_records")]
    return [*hits, *true, *guess, *whole]


def _measures(rows: DataFrame, keys: list, true: str, predicted: str) -> DataFrame:
    counted = (
        rows.selectExpr(*keys, _outcomes(true, predicted))
        .groupBy(*keys, "outcome")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    right = " + ".join(f"tp_{k}" for k in CODES)
    seen = {k: f"(true_{k} + pred_{k})" for k in CODES}
    f1 = " + ".join(f"if({seen[k]} > 0, 2 * tp_{k} / {seen[k]}, 0D)" for k in CODES)
    classes = " + ".join(f"if({seen[k]} > 0, 1, 0)" for k in CODES)
    return (
        counted.groupBy(*keys)
        .agg(*_tallies())
        .where("total_records > 0")
        .selectExpr(
            *keys,
            f"({right}) / (total_records * {len(ASPECTS)}) AS accuracy_per_label",
            "exact / total_records AS exact_match_accuracy",
            f"2 * ({right}) / ({' + '.join(seen.values())}) AS f1_micro",
            f"({f1}) / ({classes}) AS f1_macro",
            "total_records",
        )
    )


def batch_metrics(rows: DataFrame, batch="batch_id", true="_true", predicted="_pred") -> DataFrame:
    """Metrics per batch from one code column per aspect on either side.

    There are 18 possible outcomes, so each task combines its rows into at most
    18 counters per batch before anything is shuffled. Classes that occur on
    neither side do not count for the macro average.
    """
    numbered = rows.withColumn("batch_id", F.col(batch).cast("bigint"))
    return _measures(numbered, ["batch_id"], true, predicted)


def one_batch_metrics(rows: DataFrame, batch_id: int, true="_true", predicted="_pred") -> DataFrame:
    """Metrics of rows that are all of one batch; no row when there are none.

    The number of the batch joins last, so that the code compiled for one
    micro-batch serves the next one too.
    """
    number = F.lit(batch_id).cast("bigint").alias("batch_id")
    return _measures(rows, [], true, predicted).select(number, "*")


def metrics_messages(metrics: DataFrame) -> DataFrame:
    """Metrics rows in the field order of their message, stamped with local time."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return metrics.select(
        "accuracy_per_label",
        "batch_id",
        "exact_match_accuracy",
        "f1_macro",
        "f1_micro",
        now.alias("timestamp"),
        "total_records",
    )


def training_overlap(batches: DataFrame, trained: DataFrame, batch="batch_id") -> DataFrame:
    """Per batch, how many reviews have a comment that models were trained on.

    Scored reviews come back as training rows, so a repeated feed measures
    examples that the models already know; this count tells how many.
    """
    # Both sides meet on digests, so that no text is shuffled, and equal comments
    # of a batch are combined first, so that a hot one joins as a single row.
    digest = comment_digest().alias("digest")
    known = trained.where("comment IS NOT NULL").select(digest).distinct()
    known = known.withColumn("known", F.lit(1))
    asked = batches.select(batch, digest).groupBy(batch, "digest")
    asked = asked.agg(F.count(F.lit(1)).alias("n"))
    return (
        asked.join(known, "digest", "left")
        .groupBy(batch)
        .agg(
            F.sum("n").alias("total_records"),
            F.expr("sum(if(known IS NOT NULL, n, 0L))").alias("trained_records"),
        )
    )
