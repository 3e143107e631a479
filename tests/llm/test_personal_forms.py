"""Each stated way to write personal data is found where it stands in a sentence."""

from review_lens.llm import personal


def test_stated_variations_in_sentences(spark):
    field = personal.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    for kind, form in [
        ("email", "john @ example.com"),
        ("email", "ann.lee @ mail.example.org"),
        ("phone", "(578) 555-6437"),
        ("phone", "578-555-6437"),
        ("phone", "578.555.6437"),
        ("phone", "578 - 555 - 6437"),
        ("card", "4918.1871.2863.5271"),
        ("card", "4918 1871 2863 5271"),
        ("card", "4918-1871-2863-5271"),
        ("card", "4918 - 1871 - 2863 - 5271"),
    ]:
        for before, after in (("please write to ", " before noon"), ("Data: ", "")):
            text = before + form + after
            assert field.spans(text) == [(kind, len(before), len(before) + len(form))], text
    for text in ("meet @ noon on the 3rd", "we paid 3 @ 5 dollars", "thanks @name12 and all", "on 2024 - 05 - 17 we met"):
        assert field.spans(text) == [], text
