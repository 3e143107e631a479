"""Features, aspect models, and their publication."""

import math
from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from review_lens.operators import features as X
from review_lens.operators import models as M
from review_lens.schema import ASPECTS

TEXTS = [
    "good battery and good price",
    "bad battery",
    "camera is good",
    "camera is bad bad",
    "screen fine price fine",
    "",
]


def matrix_of(spark, texts=TEXTS):
    """BATTERY follows good/bad, CAMERA skips code 2, OTHERS marks one text, the rest is 0."""
    rows = []
    for i, text in enumerate(texts):
        codes = dict.fromkeys(ASPECTS, 0)
        if "battery" in text:
            codes["BATTERY"] = 3 if "good" in text else 1
        if "camera" in text:
            codes["CAMERA"] = 3 if "good" in text else 1
        codes["OTHERS"] = int(i == 4)
        rows.append((text, *codes.values()))
    return spark.createDataFrame(rows, "comment STRING, " + ", ".join(f"`{a}` INT" for a in ASPECTS))


@pytest.fixture(scope="module")
def trained(spark):
    models = M.train(matrix_of(spark), max_iter=50)
    models.version = 0
    return models


def test_tokens_split_on_single_blanks(spark):
    rows = spark.createDataFrame([("A  b\tC ",), ("",), (" ",)], "comment STRING")
    words = [r.words for r in X.tokenizer().transform(rows).collect()]
    assert words == [["a", "", "b", "c"], [""], []]


def test_document_frequency(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS] * 3, "comment STRING")
    got = {r.term: r.documents for r in X.document_frequency(rows).collect()}
    expected = Counter(w for t in TEXTS for w in set(t.split(" ")))
    assert got == {w: 3 * n for w, n in expected.items()}


def test_sparse_entries_hold_all_weights(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i INT, comment STRING")
    counted = X.term_counts(rows)
    weighted = X.idf().fit(counted).transform(counted)
    entries = X.sparse_entries(weighted, "i", vector=X.FEATURES, value="weight").collect()
    dense = {r.i: r.v for r in weighted.select("i", vector_to_array(X.FEATURES).alias("v")).collect()}
    for r in entries:
        assert dense[r.i][r.bucket] == r.weight
    assert len(entries) == sum(len(set(t.split(" "))) for t in TEXTS)
    # "good" occurs in two of six rows, once more in the first.
    first = max(r.weight for r in entries if r.i == 0)
    assert first == pytest.approx(max(2 * math.log(7 / 3), math.log(7 / 2)))


def test_one_shared_featuriser_equals_one_per_aspect(spark, trained):
    matrix = matrix_of(spark)
    for aspect in ("BATTERY", "CAMERA", "OTHERS", "SCREEN"):
        classifier = M._classifier(aspect, 50).setPredictionCol("prediction")
        own = Pipeline(stages=[X.tokenizer(), X.hasher(), X.idf(), classifier]).fit(matrix)
        expected = {r.comment: r.prediction for r in own.transform(matrix).collect()}
        mine = trained.pipeline(aspect).transform(matrix).select("comment", "prediction")
        assert {r.comment: r.prediction for r in mine.collect()} == expected


def test_models_learn_their_training_rows(spark, trained):
    matrix = matrix_of(spark)
    scored = M.score(trained, matrix)
    for row in scored.collect():
        assert [row[a] for a in ASPECTS] == [row[f"{a}_pred"] for a in ASPECTS], row.comment
    classes = {a: m.numClasses for a, m in trained.classifiers.items()}
    assert (classes["BATTERY"], classes["OTHERS"], classes["SCREEN"]) == (4, 2, 1)


def test_predictions_follow_the_weights(spark, trained):
    texts = [*TEXTS, "price of a bad screen", "good good camera", "unheard words only"]
    rows = spark.createDataFrame([(t,) for t in texts], "comment STRING")
    scored = {r.comment: r for r in M.score(trained, rows).collect()}
    weighted = trained.featuriser.transform(rows).select("comment", vector_to_array(X.FEATURES).alias("v"))
    for row in weighted.collect():
        for aspect, model in trained.classifiers.items():
            margins = model.coefficientMatrix.toArray() @ row.v + model.interceptVector.toArray()
            assert scored[row.comment][f"{aspect}_pred"] == margins.argmax(), (row.comment, aspect)


def test_scoring_keeps_rows_order_free_and_whole(spark, trained):
    rows = [("1", TEXTS[0], 5), ("1", TEXTS[0], 5), (None, TEXTS[1], 1), ("3", None, 2), ("4", "unheard words", 3)]
    frame = spark.createDataFrame(rows, "id STRING, comment STRING, n_star INT")
    scored = M.with_predicted_label(M.score(trained, frame))
    got = scored.collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted([(r.id, r.comment, r.n_star) for r in got], key=key) == sorted(rows, key=key)
    by_comment = {r.comment: r for r in got}
    assert by_comment[TEXTS[0]].predicted_label == "{BATTERY#Positive};"
    assert by_comment[TEXTS[1]].prediction_array == [1] + [0] * 10
    assert by_comment[None].prediction_array == [0] * 11 and by_comment[None].predicted_label == ""


def test_scoring_needs_no_shuffle(spark, trained, tmp_path, plan_of):
    matrix_of(spark).write.parquet(str(tmp_path / "m"))
    plan = plan_of(M.score(trained, spark.read.parquet(str(tmp_path / "m"))))
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


def test_no_training_rows(spark):
    assert M.train(matrix_of(spark).limit(0)) is None


def test_publication(spark, trained, tmp_path):
    root = str(tmp_path / "models")
    assert M.load(spark, root) is None
    M.publish(spark, trained, root)
    first = M.load(spark, root)
    assert first.version == 0 and set(first.classifiers) == set(ASPECTS)
    frame = matrix_of(spark)
    assert sorted(M.score(first, frame).collect()) == sorted(M.score(trained, frame).collect())
    # Nothing newer: the generation at hand stays as it is.
    assert M.load(spark, root, first) is first
    M.publish(spark, M.AspectModels(trained.featuriser, trained.classifiers, 1, 6), root)
    second = M.load(spark, root, first)
    assert second is not first and second.version == 1


def test_an_unnamed_generation_is_not_loaded(spark, trained, tmp_path):
    root = str(tmp_path / "models")
    # As after a crash between the models and the record of their publication.
    trained.featuriser.write().overwrite().save(f"{root}/version=0/featuriser")
    assert M.load(spark, root) is None


def test_whole_label_variant_answers_with_labels(spark):
    rows = spark.createDataFrame(
        [(t, "{OTHERS};" if "bad" in t else "{PRICE#Positive};") for t in TEXTS * 2],
        "comment STRING, processed_label STRING",
    )
    model = M.train_whole_label(rows, ["{OTHERS;}", "{OTHERS};", "{PRICE#Positive};"], max_iter=20)
    unseen = spark.createDataFrame([("x", "{SCREEN#Neutral};")], rows.schema)
    assert model.transform(rows.union(unseen)).count() == rows.count()
    answers = M.for_unlabelled(model).transform(rows.select("comment"))
    got = {r.comment: r.predicted_label for r in answers.select("comment", F.col("predicted_label")).collect()}
    assert got["bad battery"] == "{OTHERS};" and got["camera is good"] == "{PRICE#Positive};"
