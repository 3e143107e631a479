"""Every operator on odd rows and on empty tables: nothing crashes, no row is lost."""

import pyarrow as pa
import pytest

import corpus_pipeline
from review_lens.llm import (
    language,
    personal,
    quality,
    sharding,
    simhash,
    suffixes,
    toxicity,
    transducer,
    urls,
    weighting,
)

ROWS = 14


@pytest.fixture(scope="module")
def items(spark):
    rows = [("a", "jumps over the lazy dog near the old river bank"), ("a", None), (None, ""), ("b", "one")]
    return spark.createDataFrame(rows, "item_id string, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, k % 2, k % 2, "x") for k in range(12)] + [(None, 1, 1, "x"), (3, None, 0, "x"), (99, 1, 0, "x")]
    return spark.createDataFrame(rows, "doc_id bigint, toxic int, quality int, text string")


def by_id(frame, name="doc_id"):
    out = {}
    for row in frame.collect():
        out.setdefault(row[name], []).append(row)
    return out


def test_simhash(odd_docs, no_docs):
    found = by_id(simhash.near_duplicates(odd_docs), "id")
    assert sum(map(len, found.values())) == ROWS
    # Null, empty and blank texts have fingerprint zero and are one class; case doesn't count.
    assert [found[k][0].component for k in (0, 1, 2)] == [0, 0, 0] and found[0][0].fingerprint == 0
    assert found[5][0].component == found[4][0].component == found[None][0].component == 4
    kept = by_id(simhash.representatives(odd_docs))
    assert {0, 4} <= set(kept) and not {1, 2, 5} & set(kept)
    # Of the repeated rows one stays; the other text that has the same id is a class of its own.
    assert sorted(r.text for r in kept[4]) == ["The quick brown fox jumps over the lazy dog near the old river bank today.", "another text for id 4"]
    assert simhash.representatives(odd_docs).columns == odd_docs.columns
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.representatives(no_docs).count() == 0


def test_suffixes(odd_docs, no_docs, items):
    found = by_id(suffixes.leaks(odd_docs, items))
    assert sum(map(len, found.values())) == ROWS
    assert found[0][0].leaks == [] and found[0][0].n_words == 0
    match = found[4][0].leaks[0]
    assert (match["item"], match["item_start"], match["start"], match["words"]) == ("a", 0, 4, 10)
    assert [m["item"] for m in found[3][0].leaks] == ["b"]
    kept = suffixes.decontaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert not {3, 4, 5} & {r.doc_id for r in kept.collect() if r.text != "another text for id 4"}
    assert suffixes.leaks(no_docs, items).count() == 0
    assert suffixes.decontaminated(odd_docs, items.limit(0)).count() == ROWS


def test_language(odd_docs, no_docs, spark):
    assert language.fit(odd_docs) is None and language.fit(no_docs) is None
    found = by_id(language.identified(odd_docs, None))
    assert {r.lang_pred for rows in found.values() for r in rows} == {"und"}
    taught = spark.createDataFrame(
        [(1, "the dog and the house", "en"), (2, "der hund und das haus", "de"), (3, None, "en"), (4, "x", None)],
        "doc_id bigint, text string, lang string",
    )
    scorer = language.fit(taught)
    found = by_id(language.identified(odd_docs, scorer, keep=["doc_id", "text"]))
    assert all(found[k][0].lang_pred == "und" and found[k][0].lang_score == 0 for k in (0, 1, 2, 9))
    assert found[4][0].lang_pred == "en" and all(0 <= r.lang_score <= 1 for rows in found.values() for r in rows)
    kept = language.accepted(odd_docs, scorer)
    assert kept.columns == odd_docs.columns and not {0, 1, 2, 9} & {r.doc_id for r in kept.collect()}
    assert language.accepted(no_docs, scorer).count() == 0


def test_toxicity(odd_docs, no_docs, labels):
    assert toxicity.fit(no_docs, labels) is None and toxicity.fit(odd_docs, labels.limit(0)) is None
    assert {r.toxicity for r in toxicity.scored(odd_docs, None).collect()} == {0.0}
    found = toxicity.scored(odd_docs, toxicity.fit(odd_docs, labels)).collect()
    assert len(found) == ROWS and all(0 <= r.toxicity <= 1 for r in found)
    assert len({r.toxicity for r in found if r.doc_id in (0, 1, 2)}) == 1


def test_quality(odd_docs, no_docs, labels):
    assert quality.fit(no_docs, labels) is None
    for chain in (None, quality.fit(odd_docs, labels)):
        found = by_id(quality.judged(odd_docs, chain))
        assert sum(map(len, found.values())) == ROWS
        assert found[0][0].n_words == 0 and found[0][0].base_failed and not found[0][0].kept
        assert found[6][0].n_repeat_words == 60_000 and found[6][0].base_failed
    assert quality.judged(no_docs, None).count() == 0


def test_weighting(odd_docs, no_docs):
    found = by_id(weighting.scored(odd_docs, odd_docs), "id")
    assert sum(map(len, found.values())) == ROWS
    assert found[0][0].n_tokens == found[1][0].n_tokens == 1 and found[0][0].score == found[1][0].score < 0
    assert len(found[4]) == 3 and found[4][0].train_tokens == found[0][0].train_tokens
    untaught = by_id(weighting.scored(odd_docs, no_docs), "id")
    assert untaught[4][0].n_known == 0 and untaught[0][0].train_tokens == 0
    assert weighting.scored(no_docs, odd_docs).count() == 0


def test_sharding(odd_docs, no_docs):
    found = sharding.sharded(odd_docs, 4).collect()
    assert len(found) == ROWS
    for shard in {r.shard for r in found}:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    assert next(r for r in found if r.id == 0)["size"] == 8
    assert sharding.sharded(no_docs, 4).count() == 0


def test_personal(odd_docs, no_docs):
    assert personal.fit(no_docs).spans("nothing here") == []
    field = personal.fit(odd_docs)
    found = by_id(personal.with_spans(odd_docs, field))
    assert sum(map(len, found.values())) == ROWS and found[0][0].all_spans == []
    assert [s["kind"] for s in found[10][0].base_spans] == ["email", "ip", "card", "phone"]
    masked = personal.redacted(odd_docs, field)
    assert masked.columns == odd_docs.columns
    masked = by_id(masked)
    assert masked[0][0].text is None and masked[10][0].text == "mail <email> or <phone>, <ip>, <card>"
    assert masked[4][0].text == odd_docs.where("doc_id = 4").first().text
    assert personal.redacted(no_docs, field).count() == 0


def test_transducer(odd_docs, no_docs):
    found = by_id(transducer.encoded(odd_docs))
    assert sum(map(len, found.values())) == ROWS and all(r.round_trip for rows in found.values() for r in rows)
    assert found[0][0].ids is None and found[1][0].ids == []
    assert transducer.encoded(no_docs).count() == 0


def test_urls(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/")]
    urls_ = [None, "", "no scheme", "http://A.EXAMPLE.org/es/1?x=1#y", "http://example.org", "://", "a" * 100_000, "http://b.org/"]
    pages = spark.createDataFrame([(k, u, "rule") for k, u in enumerate(urls_)] + [(3, urls_[3], "r")], "page_id int, url string, rule string")
    found = by_id(urls.judged(pages, rules), "id")
    assert sum(map(len, found.values())) == 9 and len(found[3]) == 2
    assert [found[k][0].host for k in (0, 1, 2)] == [""] * 3
    row = found[3][0]
    assert (row.host, row.path, row.rule, row.verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert found[4][0].rule is None and found[4][0].path == "" and found[7][0].verdict == "allow"
    assert urls.judged(pages.limit(0), rules).count() == 0
    one = urls.judged(pages, [("allow", "org", "/")]).collect()
    assert {r.verdict for r in one} == {"allow"}


def test_pipeline_stages(spark, odd_docs, no_docs, tmp_path):
    from pyspark.sql import functions as F

    docs = odd_docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.col("n_chars").cast("bigint").alias("n_chars"))
    spark.createDataFrame([("i", "quick brown fox")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (docs, docs.limit(0)):
        rows, counts = start, []
        for _, stage in corpus_pipeline.STAGES:
            rows = corpus_pipeline.settled(stage(spark, rows, str(tmp_path)), "test")
            counts.append(rows.count())
            assert rows.columns[:5] == docs.columns
        assert counts == sorted(counts, reverse=True)
        assert {"ids", "n_ids", "round_trip"} <= set(rows.columns)


def test_batches_without_rows():
    empty = pa.array([], pa.string())
    assert len(quality.measured(empty, None)[0]) == 0 and len(simhash.fingerprint_batch(empty, 4, 42)) == 0
