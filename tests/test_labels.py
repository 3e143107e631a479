"""The label grammar against a plain reading of its rules."""

from hypothesis import given, settings
from hypothesis import strategies as st

from review_lens.functions import labels as L
from review_lens.operators.matrix import label_entries
from review_lens.schema import ASPECTS, OTHERS, SENTIMENT_CODES

BLANKS = " \t\n\r\f\x0b"


def read_parts(label):
    """(aspect, sentiment) of every well-formed part, in order."""
    found = []
    for piece in (label or "").strip(BLANKS).split(";"):
        if piece == "{OTHERS}":
            found.append((OTHERS, None))
        elif piece[:1] == "{" and piece.count("#") == 1:
            found.append(tuple(piece.strip("{}").split("#")))
    return found


def read_vector(label):
    codes = dict.fromkeys(ASPECTS, 0)
    for aspect, sentiment in read_parts(label):
        if aspect == OTHERS:
            codes[OTHERS] = 1
        elif aspect in codes:
            codes[aspect] = SENTIMENT_CODES.get(sentiment, 0)
    return list(codes.values())


def vector(**codes):
    return [codes.get(a.replace("&", "_"), 0) for a in ASPECTS]


# Label, and the vector it stands for.
EDGES = [
    (None, vector()),
    ("", vector()),
    ("  ;; ", vector()),
    ("{BATTERY#Positive};{PRICE#Negative};", vector(BATTERY=3, PRICE=1)),
    ("{BATTERY#Positive};{PRICE#Negative}", vector(BATTERY=3, PRICE=1)),
    ("{BATTERY#Positive;{PRICE#Negative};", vector(BATTERY=3, PRICE=1)),
    ("{SER&ACC#Positive};", vector(SER_ACC=3)),
    ("{OTHERS};", vector(OTHERS=1)),
    ("{OTHERS#Positive};", vector(OTHERS=1)),
    ("OTHERS;", vector()),
    ("{OTHERS;", vector()),
    ("CAMERA#Neutral;", vector()),
    ("{CAMERA#Odd};", vector()),
    ("{CAMERA#Positive};{CAMERA#Odd};", vector()),
    ("{CAMERA#Negative};{CAMERA#Positive};", vector(CAMERA=3)),
    ("{CAMERA#Positive}{BATTERY#Negative};", vector()),
    ("{CAMERA#Positive}; {BATTERY#Negative};", vector(CAMERA=3)),
    (" \t{CAMERA#Positive};\n", vector(CAMERA=3)),
    ("{{CAMERA#Positive}};", vector(CAMERA=3)),
    ("{CAMERA#Positive}x;", vector()),
    ("{FOO#Positive};{STORAGE#Neutral};", vector(STORAGE=2)),
    ("{camera#Positive};", vector()),
    ("{CAMERA#Positive#Negative};", vector()),
    ("{#Positive};{CAMERA#};", vector()),
    ("{CAMERA#Posi\ntive};{DESIGN#Neutral};", vector(DESIGN=2)),
]


def decode_all(spark, labels):
    rows = spark.createDataFrame(list(enumerate(labels)), "i INT, label STRING")
    decoded = L.decoded(rows).select("i", L.aspect_array().alias("v"))
    return [r.v for r in sorted(decoded.collect(), key=lambda r: r.i)]


def test_edge_labels(spark):
    labels = [label for label, _ in EDGES]
    got = decode_all(spark, labels)
    for (label, expected), codes in zip(EDGES, got, strict=True):
        assert codes == expected, label
        assert read_vector(label) == expected, label


def test_edge_labels_in_long_form(spark):
    rows = spark.createDataFrame([(i, e[0]) for i, e in enumerate(EDGES)], "i INT, label STRING")
    got = {}
    for r in label_entries(rows, "i").collect():
        got.setdefault(r.i, []).append((r.position, r.aspect, r.sentiment))
    for i, (label, _) in enumerate(EDGES):
        entries = [(a, s) for _, a, s in sorted(got.get(i, []), key=lambda e: e[0])]
        assert entries == read_parts(label), label


PIECES = st.sampled_from(
    ["{", "}", ";", "#", " ", "OTHERS", "CAMERA", "SER&ACC", "Positive", "Negative", "\n", "x"]
    + ["{BATTERY#Positive};", "{CAMERA#Negative};", "{OTHERS};", "{PRICE#Odd};"]
)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=200, max_size=300))
def test_any_label(spark, labels):
    assert decode_all(spark, labels) == [read_vector(label) for label in labels]


def test_encode_undoes_decode(spark):
    labels = ["", "{BATTERY#Negative};{SER&ACC#Neutral};{OTHERS};"]
    labels += ["{" + a + "#" + s + "};" for a in ASPECTS if a != OTHERS for s in SENTIMENT_CODES]
    rows = spark.createDataFrame([(x,) for x in labels], "label STRING")
    back = L.decoded(rows).select("label", L.encode().alias("again")).collect()
    assert all(r.label == r.again for r in back)


def test_encode_spells_nothing_for_an_unknown_code(spark):
    columns = ", ".join(f"cast({9 if a == 'CAMERA' else 0} AS DOUBLE) AS `{a}`" for a in ASPECTS)
    assert spark.sql(f"SELECT {columns}").select(L.encode().alias("x")).first().x == ""


def test_decode_is_worked_out_once_per_row(spark, plan_of):
    rows = spark.createDataFrame([("{OTHERS};",)], "label STRING")
    plan = plan_of(L.decoded(rows).select(L.encode().alias("again")))
    assert plan.count("aggregate(transform(") == 1
    assert "Python" not in plan
