"""Texts that no learned language fits are rejected, whatever their share of the likelihood."""

import random

import corpus_pipeline

FOREIGN = {
    "polish": "Miasto leży w północnej części kraju i co roku przyjeżdża tutaj wielu turystów, żeby zobaczyć stare kościoły oraz muzea.",
    "finnish": "Kaupunki sijaitsee maan pohjoisosassa ja joka vuosi sinne saapuu paljon matkailijoita katsomaan vanhoja kirkkoja.",
    "russian": "Город расположен в северной части страны, и каждый год сюда приезжает много туристов, чтобы увидеть старые церкви.",
    "greek": "Η πόλη βρίσκεται στο βόρειο τμήμα της χώρας και κάθε χρόνο έρχονται εδώ πολλοί τουρίστες για να δουν τις εκκλησίες.",
    "chinese": "这座城市位于该国北部，每年都有许多游客来到这里参观古老的教堂和博物馆。居民说的语言外国人不容易理解。",
}


def test_unlearned_languages_and_random_letters_go(spark):
    draw = random.Random(5)
    gibberish = [" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 10))) for _ in range(60)) for _ in range(3)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    names = docs.columns
    odd = [(-1 - k, text, None, "odd", len(text)) for k, text in enumerate([*FOREIGN.values(), *gibberish])]
    both = docs.union(spark.createDataFrame(odd, docs.select("doc_id", "text", "lang", "source", "n_chars").schema).select(*names))
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, both, "").select("doc_id").collect()}
    assert not [k for k in kept if k < 0]
    lettered = {r.doc_id for r in docs.where(r"text rlike '\\p{L}'").select("doc_id").collect()}
    assert kept == lettered


def test_every_labelled_text_teaches(spark):
    """Words that one text of some thousands holds each have their pieces counted."""
    from review_lens.llm import language

    import pyarrow as pa

    rows = [(k, "the house stands by the river", "en") for k in range(3000)]
    common = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    letters = pa.array(list("αβγδεζηθ"))
    rare = spark.createDataFrame([(5000 + k, f"{x} " * 50, "en") for k, x in enumerate(letters.to_pylist())], common.schema)
    with_them, without = (language.fit(rows).score(letters)[2] for rows in (common.union(rare), common))
    assert (with_them > without + 0.5).all()
