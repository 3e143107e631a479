"""Importance resampling against the plainest version of it."""

import collections
import hashlib
import math
import random
import re
import zlib

import pandas as pd
import pyarrow as pa
import pytest

from review_lens.llm import importance
from review_lens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def buckets_of(text):
    words = words_of(text)
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return [zlib.crc32(r.encode()) % 10_000 for r in runs]


def expected(docs, target):
    source = collections.Counter(b for _, text in docs for b in buckets_of(text))
    aim = collections.Counter(b for text in target for b in buckets_of(text))
    S, T = sum(source.values()), sum(aim.values())
    gain = [
        math.floor(1000 * math.log((aim[b] + 1.0) * (S + 10000.0) / ((source[b] + 1.0) * (T + 10000.0))))
        for b in range(10_000)
    ]
    rows = []
    for doc_id, text in docs:
        found = [gain[b] for b in buckets_of(text)]
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(found) // len(found) if found else 0
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, len(words_of(text)) >= 20])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = {id(r): k + 1 for k, r in enumerate(able[: 25 * len(able) // 100])}
    return [(*r[:4], drawn.get(id(r))) for r in rows]


def key(row):
    return tuple(-(10**18) if v is None else v for v in row)


def test_query(spark):
    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet")[["doc_id", "text"]].itertuples(index=False, name=None)
    target = pd.read_parquet(f"{SF_DIR}/benchmark.parquet").text
    found = QUERIES["op13_target_importance_resampling"](spark, SF_DIR)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in found.dtypes} == {"bigint"}
    assert sorted(map(key, map(tuple, found.collect()))) == sorted(map(key, expected(list(docs), target)))


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    # Long words, many of one length and some of their own; ids that tie by their score cannot be told apart.
    rows += [(100 + k, " ".join(["w" * (90 + k), "é" * 60, "Ab1", "AB1", "K"] * 6)) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS weight", "'y' AS rank", "'z' AS n_words")
    target = spark.createDataFrame([("the lazy dog ab1",), (None,), ("",)], "text string")
    found = [tuple(r) for r in importance.resampled(docs, target).collect()]
    assert sorted(map(key, found)) == sorted(map(key, expected(rows, ["the lazy dog ab1", None, ""])))
    assert importance.resampled(no_docs, target).count() == 0
    assert importance.resampled(docs, target.limit(0)).count() == len(rows)


@pytest.mark.parametrize("seed", range(3))
def test_checksums_by_columns(seed, monkeypatch):
    draw = random.Random(seed)
    texts = ["".join(draw.choices("ab é漢1 .\n", k=draw.randint(0, 400))) for _ in range(30)] + [None, ""]
    found, owners, counts = importance.feature_buckets(pa.array(texts))
    for k, text in enumerate(texts):
        assert sorted(found[owners == k]) == sorted(buckets_of(text)) and counts[k] == len(words_of(text))
    # The same where hashes of different words are equal.
    monkeypatch.setattr(importance.blocks, "word_hashes", lambda words: words.starts * 0)
    again, _, _ = importance.feature_buckets(pa.array(texts))
    assert (again == found).all()
