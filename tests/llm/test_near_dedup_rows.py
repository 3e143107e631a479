"""One row of each near-duplicate group stays, whatever the ids are."""

import pytest

from review_lens.llm import simhash
from review_lens.llm.common import settled

ROWS = [
    (4, "a b c d e f"),
    (4, "other words for this same id"),
    (4, "a b c d e f"),
    (None, "A b c d e f"),
    (None, "p q r s t u"),
    (None, "p q r s t u"),
    (9, None),
    (3, " "),
    (None, ""),
]


@pytest.mark.parametrize("stored", [False, True])
def test_repeated_and_missing_ids(spark, stored):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").selectExpr("*", "7 AS file_", "8 AS place_")
    docs = settled(docs.repartition(4), "test") if stored else docs
    found = simhash.representatives(docs, stored=stored)
    assert found.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in found.collect()) == [
        ("3", " "),
        ("4", "a b c d e f"),
        ("4", "other words for this same id"),
        ("None", "p q r s t u"),
    ]
