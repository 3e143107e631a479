"""Statistics of URL suffixes against plain counting, frequent and rare ones."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from review_lens.llm import urls
from review_lens.llm.common import settled

RULES = [("allow", "org", "/"), ("block", "com", "/x/")]


@pytest.mark.parametrize("frequent", [1e-4, 0.02, 2.0])
def test_every_suffix_has_its_own_counts(spark, monkeypatch, frequent):
    monkeypatch.setattr(urls, "FREQUENT", frequent)
    draw = random.Random(2)
    texts = [None, "", "http://a.org"] + [
        f"http://h{draw.randrange(300)}.{draw.choice(['com', 'org', 'net'])}/{draw.choice(['x', 'y', str(draw.random())])}/{draw.choice(['a.html', 'b', ''])}"
        for _ in range(500)
    ]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id int, url string")
    rows = urls.described(pages, RULES, "page_id", "url").withColumn("row", F.monotonically_increasing_id())
    rows = settled(rows, "test")
    found = urls.with_counts(rows, urls.suffix_counts(rows), len(texts)).collect()
    assert sorted(r.id for r in found) == list(range(len(texts)))
    seen = [collections.Counter() for _ in range(3)]
    for r in found:
        for k, suffix in enumerate(r.parts):
            for held, on in zip(seen, (True, r.ruled is not None, r.ruled == "block"), strict=True):
                held[k, suffix] += on
    for r in found:
        for k, suffix in enumerate(r.parts):
            assert tuple(r[f"c{k}"]) == tuple(held[k, suffix] for held in seen)


def test_thousands_of_hosts_are_told_apart(spark):
    """Bad and good hosts in equal numbers, alike but for their names."""
    rows = [(2 * k + j, f"http://host{k}.net/{'bad' if j else 'p'}{k % 2}") for k in range(3_000) for j in (0, 1)]
    rules = [("block" if k % 2 else "allow", f"host{k}.net", "/p") for k in range(0, 200)]
    pages = spark.createDataFrame(rows, "page_id int, url string")
    counts = urls.suffix_counts(urls.described(pages, rules[:2], "page_id", "url"))
    hosts = counts.where("family = 2")
    assert hosts.count() == 3_000 and hosts.where("urls = 2").count() == 3_000
