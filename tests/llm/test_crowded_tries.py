"""Copies of a fingerprint don't grow with the number of fingerprints, also in crowded tries."""

import random

import pytest

from review_lens.llm import simhash


@pytest.mark.parametrize("count", [2_000, 20_000])
def test_copies_are_bounded(spark, monkeypatch, count):
    monkeypatch.setattr(simhash, "PART", 60)
    draw = random.Random(count)
    # All agree on the first block; as pairs of parts each would have count / 60 copies there.
    prints = {(0x5A5 << 52) | draw.getrandbits(52) for _ in range(count)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "fingerprint bigint")
    tries = simhash.dealt_tries(frame, 4)
    assert tries.count() == 9 * len(prints)
    assert tries.groupBy("trie").count().agg({"count": "max"}).first()[0] <= 60
