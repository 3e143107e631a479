"""Token counts against the library, text by text."""

import random

import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest

from review_lens.llm import counts
from review_lens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ALPHABETS = ["ab \u00a0\u3000\u2003\u0085 \n", "éα漢я \t", "ab 1", "aZ09 .,!'\n\t", "ab   \x1c\r\n", "漢字、。 ひカ1a", "<|endoftext|> a1", "é😀́ ß1"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: len(model.encode(text or "", add_special_tokens=False))


def test_query(spark, library):
    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op12_token_counts"](spark, SF_DIR).collect()}
    assert len(found) == len(docs)
    for doc_id, text in docs[["doc_id", "text"]].itertuples(index=False):
        row, n = found[doc_id], library(text)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((text or "").encode()), n, n > 512)


def test_odd_rows(spark, library, odd_docs, no_docs):
    rows = counts.token_counts(odd_docs.selectExpr("*", "'x' AS n_tokens")).collect()
    assert len(rows) == 14 and all(r.n_tokens == library(r.text) for r in rows)
    assert counts.token_counts(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_cut_texts_count_as_whole_ones(library, monkeypatch, seed):
    monkeypatch.setattr(counts.parts_of, "__defaults__", (3,))
    draw = random.Random(seed)
    machine = counts.Counter(public_tokenizers.path("byte_bpe_50k.json"))
    assert machine.cut
    texts = []
    for _ in range(300):
        letters = draw.choice(ALPHABETS)
        pieces = [draw.choice([*letters, "<|endoftext|>", "'s", "'ll 1", "  "]) for _ in range(draw.randint(0, 60))]
        texts.append("".join(pieces))
    assert any(len(counts.parts_of(t)) > 3 for t in texts)
    monkeypatch.setattr(counts, "REMEMBERED", 50)
    assert machine.counts(pa.array(texts)).tolist() == [library(t) for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_take_texts_whole(spark, odd_docs, name):
    path = public_tokenizers.path(name)
    assert not counts.Counter(path).cut
    found = counts.token_counts(odd_docs.where("doc_id in (1, 3, 4, 5)"), path=path).collect()
    assert {r.doc_id: r.n_tokens > 0 for r in found} == {1: False, 3: True, 4: True, 5: True}


def test_batches_are_even():
    sizes = [5, 1, 1, 1, 90, 3, 3, 40, 40, 1]
    parts = counts.balanced(sizes, 50)
    assert [a for a, _ in parts[1:]] == [b for _, b in parts[:-1]] and parts[0][0] == 0 and parts[-1][1] == 10
    assert counts.balanced([], 50) == [] or counts.balanced([], 50) == [(0, 0)]
