import pytest
from pyspark.sql import types as T

#: Texts that break careless code: nothing, only spaces, very long ones, odd characters.
TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "The quick brown fox jumps over the lazy dog near the old river bank today.",
    "the QUICK brown fox jumps over the lazy dog near the old river bank today.",
    "word " * 60_000,
    "x" * 300_000,
    "é漢字😀 \x00 ▁ ﬁ\r\n" * 3,
    "12345 67890 !!! ??? ...",
    "mail a.b@c.example.org or +1 (578) 555-6437, 10.0.0.1, 4918187128635271",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, null and repeated ids, repeated rows, columns named like results and helpers."""
    rows = [(k, text) for k, text in enumerate(TEXTS)] + [(4, TEXTS[4]), (4, "another text for id 4"), (None, TEXTS[4])]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    docs = spark.createDataFrame(rows, schema)
    names = ["lang", "ids", "leaks", "n_words", "lang_pred", "toxicity", "kept", "all_spans", "fingerprint", "id", "source", "text_of_row_"]
    return docs.selectExpr("*", *(f"cast(null AS STRING) AS {name}" for name in names), "length(text) AS n_chars")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
