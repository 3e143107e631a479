"""Long texts are used whole, in fair time; names of the input clash with nothing."""

import itertools
import time

import numpy as np
import pyarrow as pa

from review_lens.llm import quality, suffixes

PROSE = "The harbour was quiet and the boats came back, one by one, before the evening."


def test_the_fit_learns_from_lines_far_down(spark):
    """A mark that occurs in the 100th line alone, of bad texts alone."""
    rows, marks = [], []
    for k in range(40):
        lines = [f"{PROSE} {j}" for j in range(99)] + (["|||| #### ||||"] if k % 2 else [PROSE])
        rows.append((k, "\n".join(lines)))
        marks.append((k, 1 - k % 2))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    chain = quality.fit(docs, spark.createDataFrame(marks, "doc_id bigint, quality int"))
    footer = quality.Lines(pa.array(["|||| #### ||||"])).features()
    prose = quality.Lines(pa.array([PROSE])).features()
    content = lambda line: np.diff(chain.emissions(line)[0])[0]
    assert content(footer) < 0 < content(prose)


def test_stretches_hold_every_line_once():
    rows = np.array([0, 3, 3, 13, 14])
    assert quality.stretches(rows, 4).tolist() == [0, 3, 7, 11, 13, 14]
    places, there = quality.padded(quality.stretches(rows, 4))
    assert sorted(places[there].tolist()) == list(range(14))


def test_labels_are_the_best_whatever_the_number_of_texts(monkeypatch):
    draw = np.random.default_rng(7)
    chain = quality.Chain()
    chain.weights[:], chain.follows[:] = draw.normal(size=chain.weights.shape), draw.normal(size=(2, 2))
    rows = np.cumsum([0, *draw.integers(0, 9, 60)])
    features = draw.integers(0, quality.WIDTH, (int(rows[-1]), len(quality.GROUPS)))
    found = []
    for alone in (0, 5, 100):
        monkeypatch.setattr(quality, "ALONE", alone)
        found.append(chain.decode(features, rows).tolist())
    assert found[0] == found[1] == found[2]
    scores = chain.emissions(features)
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        value = lambda y: sum(scores[a + k, v] for k, v in enumerate(y)) + sum(  # noqa: B023, E731
            chain.follows[p, q] for p, q in zip(y[:-1], y[1:], strict=True)
        )
        assert tuple(found[0][a:b]) == max(itertools.product((0, 1), repeat=b - a), key=value)


def test_a_megabyte_of_one_word_lines():
    chain = quality.Chain()
    chain.follows[:] = [[1.0, 0.0], [0.0, 1.0]]
    started = time.process_time()
    found = quality.measured(pa.array(["word\n" * 200_000]), chain)
    assert found[0][0].as_py() == 200_000 and time.process_time() - started < 20


def test_names_like_our_own_in_the_input(spark):
    text = "jumps over the lazy dog near the old river bank"
    docs = spark.createDataFrame([(1, f"he {text} again", "x")], "doc_id bigint, text string, text_of_leaks_ string")
    docs = docs.selectExpr("*", "'y' AS leaks_before_")
    items = spark.createDataFrame([("i", text)], "item_id string, text string")
    found = suffixes.leaks(docs, items).collect()
    assert found[0].text_of_leaks_ == "x" and found[0].leaks_before_ == "y"
    assert [(m["item"], m["words"]) for m in found[0].leaks] == [("i", 10)]
    assert suffixes.decontaminated(docs, items).count() == 0
