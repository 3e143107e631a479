"""The corpus pipeline: language ID, near-dedup, decontamination, PII, SentencePiece.

Every stage takes what its predecessor kept, as written to Parquet, and judges its own input. A document goes if
no learned language fits it, if a near duplicate with a smaller id stays, or if it
holds a passage of a benchmark item; personal data is masked in those that stay, and
the last stage adds their ids in a public vocabulary.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_lens.llm import language, personal, simhash, suffixes, transducer
from review_lens.llm.common import settled, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the labelled ones among them. Null and empty texts
    and those without letters go; repeated rows are judged alike; an empty table stays empty."""
    return language.accepted(docs, language.fit(docs), limits=language.floors(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id: the
    SimHash operator with 4-word shingles and 4 bits. Texts without words are one group; of
    rows without an id, or with equal ids, one of a group stays as well."""
    return simhash.representatives(docs, ngram=4, budget=4, stored=True)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item. Null and empty texts hold none and
    stay, as does everything where the benchmark is empty."""
    return suffixes.decontaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars is that of the new text,
    null for a null text."""
    masked = personal.redacted(docs, personal.fit(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ids, n_ids and whether the ids decode to the text. A null text has
    null ids and n_ids 0."""
    found = transducer.encoded(docs)
    return found.withColumn("n_ids", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint"))


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", mask_personal_data),
    ("sentencepiece", encode_pieces),
]

#: Fitted models decide; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over `documents`; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
