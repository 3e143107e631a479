"""Every numbered query, whole, against the plainest version of what it returns."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from review_lens.llm import language, personal, quality, simhash, suffixes, transducer, weighting
from review_lens.llm.queries import ORACLES, QUERIES, URL_RULES

SF_DIR = "/root/testdata/sf0.001"
SPACES = r"[^\x20\x09-\x0D]+"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def read(name):
    return pd.read_parquet(f"{SF_DIR}/{name}.parquet")


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


@pytest.fixture(scope="module")
def result(spark):
    held = {}

    def get(name):
        if name not in held:
            found = QUERIES[name](spark, SF_DIR).toPandas()
            held[name] = found.sort_values(found.columns[0]).set_index(found.columns[0])
        return held[name]

    return get


def test_all_queries_are_there():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_url_filters(result):
    found = result("op1_url_filters")
    for page_id, url in read("pages")[["page_id", "url"]].itertuples(index=False):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = low(host)
        fits = [
            (len(h + p), h + p, kind)
            for kind, h, p in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        row = found.loc[page_id]
        assert (row.host, row.path, row.rule) == (host, path, max(fits)[1] if fits else None)
        assert row.verdict == max(fits)[2] if fits else row.verdict in ("allow", "block")


def windows(texts):
    out = {}
    for item, text in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
        size = min(10, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            out.setdefault(tuple(words[k : k + size]), set()).add(str(item))
    return out


def leaked(text, known):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
    hit, items = set(), set()
    for size in {len(w) for w in known}:
        for k in range(len(words) - size + 1):
            if tuple(words[k : k + size]) in known:
                items |= known[tuple(words[k : k + size])]
                hit.update(range(k, k + size))
    return len(words), len(hit), items


def test_decontamination(result):
    known = windows(read("benchmark")[["item_id", "text"]].itertuples(index=False))
    found = result("op2_benchmark_decontamination")
    assert found.contaminated.any()
    for doc_id, text in read("documents")[["doc_id", "text"]].itertuples(index=False):
        n, hit, items = leaked(text, known)
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert tuple(found.loc[doc_id]) == (n, hit, len(items), digest, hit > 0)


@pytest.mark.parametrize("seed", range(4))
def test_longest_matches(spark, seed):
    """Small vocabularies, so that windows overlap and repeat; short items; several blocks of items."""
    draw = random.Random(seed)
    text = lambda n: " ".join(draw.choice("aabbc") for _ in range(n))
    items = [(f"i{k}", text(draw.choice([0, 1, 3, 5, 9]))) for k in range(6)]
    docs = [(k, text(draw.randint(0, 40))) for k in range(40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    tests = spark.createDataFrame(items, "item_id string, text string")
    held, suffixes.BLOCK_BYTES = suffixes.BLOCK_BYTES, 10
    try:
        rows = suffixes.leaks(frame, tests, window=4)
        rows = rows.select("doc_id", suffixes.leaked_words("leaks").alias("hit"), suffixes.leaked_items("leaks").alias("items"), "leaks")
        found = {r.doc_id: r for r in rows.collect()}
    finally:
        suffixes.BLOCK_BYTES = held
    for k, doc in docs:
        words, hit, seen = doc.split(), set(), set()
        for item, text_ in items:
            own = text_.split()
            size = min(4, len(own))
            for i, j in itertools.product(range(len(words) - size + 1), range(len(own) - size + 1)):
                if size and words[i : i + size] == own[j : j + size]:
                    hit.update(range(i, i + size))
                    seen.add(item)
        assert (found[k].hit, found[k]["items"]) == (len(hit), sorted(seen))
        for m in found[k].leaks:
            own = dict(items)[m["item"]].split()
            i, j, n = m["start"], m["item_start"], m["words"]
            assert words[i : i + n] == own[j : j + n]
            # The longest: it can't be extended to either side.
            assert i == 0 or j == 0 or words[i - 1] != own[j - 1]
            assert i + n == len(words) or j + n == len(own) or words[i + n] != own[j + n]


def test_language_query(result):
    found = result("op3_language_id")
    docs = read("documents").set_index("doc_id")
    assert [fold(k, 4) == 2 for k in found.index] == found.held_out.tolist()
    right = found.lang_pred == docs.lang.loc[found.index]
    assert right[found.held_out].mean() > 0.97 and found.score.between(0, 1).all()


def test_forward_sum_over_all_segmentations():
    pieces = sorted({b" ", b"a", b"b", b"c", b" a", b"ab", b"bc", b"abc", b" ab", b"cab"})
    logs = np.log(np.random.default_rng(1).dirichlet(np.ones(len(pieces)), 3).T)
    place = {p: k for k, p in enumerate(pieces)}
    words = ["a", "abc", "abcabc", "cabab", "bbbb"]
    net = language.lattice([w.encode() for w in words], language.Pieces(pieces))
    found, back = net.forward(logs)[net.last], net.backward(logs)[net.first]
    for k, word in enumerate(words):
        text, total = b" " + word.encode(), np.zeros(3)
        for cuts in itertools.product([0, 1], repeat=len(word)):
            ends = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
            parts = [text[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            if all(p in place for p in parts):
                total += np.exp(sum(logs[place[p]] for p in parts))
        assert np.allclose(np.exp(found[k]), total) and np.allclose(found[k], back[k])


def test_toxicity_query(result):
    found = result("op4_toxicity")
    assert len(found) == len(read("documents")) and found.score.between(0, 1).all()
    assert ((found.score >= 0.3).astype(int) == found.predicted).all()


def test_toxicity_on_larger_data(spark):
    found = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet").dropna(subset=["toxic"])
    held = found[found.held_out].merge(labels, on="doc_id")
    hits = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert hits / held.predicted.sum() > 0.8 and hits / (held.toxic == 1).sum() > 0.6


def base_quality(text):
    text = text or ""
    words, seen, repeated = re.findall(SPACES, text), set(), 0
    for line in text.split("\n"):
        if re.search(SPACES, line):
            repeated += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return [len(words), sum(map(len, words)), symbols, repeated, len(covered), failed]


def test_quality_query(result):
    found = result("op5_quality_rules")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for doc_id, text in read("documents")[["doc_id", "text"]].itertuples(index=False):
        assert found.loc[doc_id, names].tolist() == base_quality(text)
    assert not (found.kept & found.base_failed).any()
    both = read("labels").dropna(subset=["quality"]).merge(found.reset_index(), on="doc_id")
    both = both[~both.base_failed]
    assert ((both.quality == 1) == both.kept).mean() > 0.95


def test_quality_counts_of_random_texts():
    draw = random.Random(3)
    parts = ["a", "b", "ab", " ", "  ", "\n", "\n\n", "é", "|", "#", "\t", "漢", "a b a b a "]
    texts = [None, "", "\n"] + ["".join(draw.choices(parts, k=draw.randint(0, 60))) for _ in range(500)]
    found = zip(*(a.to_pylist() for a in quality.measured(pa.array(texts, pa.string()), None)[:6]), strict=True)
    assert [list(f) for f in found] == [base_quality(t) for t in texts]


def test_viterbi_finds_the_best_labels():
    chain, draw = quality.Chain(), np.random.default_rng(5)
    chain.weights[:], chain.follows[:] = draw.normal(size=chain.weights.shape), draw.normal(size=(2, 2))
    features = draw.integers(0, quality.WIDTH, (14, len(quality.GROUPS)))
    rows = np.array([0, 5, 5, 6, 14])
    scores, labels = chain.emissions(features), chain.decode(features, rows)
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        value = lambda y: sum(scores[a + k, v] for k, v in enumerate(y)) + sum(
            chain.follows[p, q] for p, q in zip(y[:-1], y[1:], strict=True)
        )
        best = max(itertools.product((0, 1), repeat=b - a), key=value)
        assert tuple(labels[a:b]) == best


def test_scores_query(result):
    docs = read("documents")
    found = result("op6_lm_scoring")
    tokens = {k: re.findall(SPACES, low(t)) + [None] for k, t in zip(docs.doc_id, docs.text, strict=True)}
    counts = collections.Counter(w for k, ws in tokens.items() if fold(k, 5) != 1 for w in ws)
    total = sum(counts.values())
    floor = math.log10(total + 0.5 * (len(counts) + 1))
    for k, words in tokens.items():
        row = found.loc[k]
        assert row.held_out == (fold(k, 5) == 1)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(w in counts for w in words), total)
        assert row.base_score == pytest.approx(sum(math.log10(counts[w] + 0.5) - floor for w in words), rel=1e-9)
    # Far better than spelling each byte out.
    assert found.bits_per_byte[found.held_out].mean() < 4


def test_context_trees_by_definition():
    """Against the recursive definition, over the observed sequence itself."""
    seq = np.random.default_rng(0).integers(97, 100, 200).astype(np.uint8)
    places, _ = weighting.cells(seq, np.array([0, 200]))
    counts = np.bincount(places, minlength=weighting.CONTEXTS * 256).astype(float)
    logs = weighting.byte_logs(counts.reshape(-1, 256))
    assert np.allclose((10**logs).sum(axis=1), 1)
    stream = [weighting.EDGE] * 3 + seq.tolist() + [weighting.EDGE]
    seen = [(tuple(weighting.CLASS_OF[stream[i - k]] for k in (1, 2, 3)), stream[i]) for i in range(3, len(stream))]

    def node(start, level, context):
        n = [0, 0]
        for held, byte in seen:
            if held[: len(context)] == context and byte >> (8 - level) == start:
                n[byte >> (7 - level) & 1] += 1
        own = math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)
        if len(context) == weighting.DEPTH:
            return own, (n[1] + 0.5) / (sum(n) + 1), 1.0
        if not sum(n):
            return 0.0, 0.5, 1.0
        below = sum(node(start, level, (*context, k))[0] for k in {c[len(context)] for c, _ in seen})
        whole = np.logaddexp(own, below) + math.log(0.5)
        return whole, (n[1] + 0.5) / (sum(n) + 1), math.exp(own + math.log(0.5) - whole)

    for at, byte in itertools.product((0, 7, 199), (97, 98, 255, 120)):
        context, expected = seen[at][0], 0.0
        for level in range(8):
            share = None
            for depth in (3, 2, 1, 0):
                _, one, weight = node(byte >> (8 - level), level, context[:depth])
                share = one if share is None else weight * one + (1 - weight) * share
            expected += math.log10(share if byte >> (7 - level) & 1 else 1 - share)
        assert logs[context[2] * 1024 + context[1] * 32 + context[0], byte] == pytest.approx(expected)


def test_sharding_query(result):
    docs = read("documents").set_index("doc_id")
    found = result("op7_sharding")
    assert sorted(found.index) == sorted(docs.index) and set(found.law) == {"bytes"}
    data = [t.encode() for t in docs.text.loc[found.index]]
    assert found["size"].tolist() == [len(d) + 8 for d in data]
    assert found.text_crc32.tolist() == [zlib.crc32(d) for d in data]
    for _, shard in found.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    sizes = found.groupby("shard")["size"].sum().reindex(range(24), fill_value=0)
    assert (sizes - found["size"].sum() / 24).abs().max() <= found["size"].max()


def base_spans(text):
    def luhn(number):
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(number))]
        return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_personal_query(result):
    found = result("op9_pii")
    for doc_id, text in read("documents")[["doc_id", "text"]].itertuples(index=False):
        spans, row = base_spans(text), found.loc[doc_id]
        listed = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert [row[f"n_{k}"] for k in personal.KINDS] == [sum(s[0] == k for s in spans) for k in personal.KINDS]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row.spans.split(",")) | {""}


def test_personal_patterns_on_random_texts():
    draw = random.Random(1)
    for _ in range(20_000):
        text = "".join(draw.choices("0123456789.+-() @ab\n4%", k=draw.randint(0, 40)))
        assert personal.base_spans(text) == base_spans(text)


def test_field_finds_new_forms_and_leaves_numbers_alone(spark):
    field = personal.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    for text, spans in {
        "call (578) 555-6437 now": [("phone", 5, 19)],
        "4465758382889437 4465758382889437": [("card", 0, 16), ("card", 17, 33)],
        "x@y.com": [("email", 0, 7)],
        "in 2024-05-17 12:30:11, pages 12 of 340, 3.14159 2.71828, $1,234,567.89": [],
        "1 " * 200: [],
    }.items():
        assert field.spans(text) == spans


def test_semi_markov_best_and_gradient():
    """The best labelling, and the likelihood's slope, by going through all labellings."""
    draw = np.random.default_rng(2)
    region = personal.Region("a@b.c 12")
    weights, follows = draw.normal(size=(4, personal.WIDTH)), draw.normal(size=(5, 5))
    spans = {(int(s), int(e)): k for k, (s, e) in enumerate(zip(region.starts, region.ends, strict=True))}
    n = len(region.tokens)

    def ways(at, before):
        if at == n:
            yield [], 0.0
            return
        for rest, score in ways(at + 1, 0):
            yield rest, score + follows[before, 0]
        for (s, e), k in spans.items():
            if s == at:
                for kind in range(4):
                    own = weights[kind] @ region.features[k] + follows[before, kind + 1]
                    for rest, score in ways(e, kind + 1):
                        yield [(s, e, kind), *rest], score + own

    every = list(ways(0, 0))
    best = max(every, key=lambda w: w[1])[0]
    tokens = region.tokens
    assert region.best(weights, follows) == [(personal.KINDS[k], tokens[s][0], tokens[e - 1][1]) for s, e, k in best]
    gold = {(s, e): k for s, e, k in best}
    total = np.logaddexp.reduce([w[1] for w in every])
    expected = np.zeros_like(weights)
    for way, score in every:
        for s, e, k in way:
            expected[k] += np.exp(score - total) * region.features[spans[s, e]]
    held = sum((np.outer(np.eye(4)[k], region.features[spans[s, e]]) for s, e, k in best), np.zeros_like(weights))
    assert np.allclose(region.gradient(weights, follows, gold)[0], held - expected)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=language.vocabulary_path())


def test_pieces_query(result, library):
    found = result("op8_sentencepiece")
    for doc_id, text in read("documents")[["doc_id", "text"]].itertuples(index=False):
        assert list(found.ids[doc_id]) == library.encode(text)
    assert found.round_trip.all() and (found.n_ids == found.ids.map(len)).all()


def test_shortest_paths_of_random_texts(library):
    machine, draw = transducer.compiled(), random.Random(0)
    parts = ["a", "the", " ", "  ", "\n", "é", "漢", "😀", "ing", "T", "_", ".", "…", "\t", "0", "''", "!!", "--", "\x00", "▁", "²."]
    parts += draw.sample(sorted(machine.texts.values()), 200)
    for _ in range(6_000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 20)))
        ids = np.frombuffer(machine.encode(text), np.int32).tolist()
        assert ids == library.encode(text)
        assert machine.decode(ids) == text.replace("▁", " ")


def prints_of(texts):
    out = []
    for text in texts:
        words = re.findall(SPACES, low(text))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        out.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return out


def classes(ids, prints):
    root = {k: k for k in ids}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, x), (b, y) in itertools.combinations(zip(ids, prints, strict=True), 2):
        if (x ^ y).bit_count() <= 4:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {k: find(k) for k in ids}


def test_simhash_query(result):
    docs, found = read("documents"), result("op10_simhash_near_dedup")
    prints = prints_of(docs.text)
    known = classes(docs.doc_id.tolist(), prints)
    assert found.fingerprint.to_dict() == {k: f"{p:016x}" for k, p in zip(docs.doc_id, prints, strict=True)}
    assert found.component_id.to_dict() == known


@pytest.mark.parametrize("part", [3, 2_000])
def test_trie_join(spark, part):
    """Crowded fingerprints, also with tries dealt out in parts."""
    draw = random.Random(part)
    prints = {draw.getrandbits(64) for _ in range(150)}
    for p in list(prints):
        for _ in range(3):
            q = p
            for _ in range(draw.randint(1, 6)):
                q ^= 1 << draw.randrange(64)
            prints.add(q)
    prints |= {k for k in range(40)}
    ids = sorted(prints)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    held, simhash.PART = simhash.PART, part
    try:
        frame = spark.createDataFrame([(signed(p),) for p in ids], "fingerprint bigint")
        links = [(r.u, r.v) for r in simhash.trie_links(frame).collect()]
        stars = {r.node: r.root for r in simhash.components(simhash.trie_links(frame), "test").collect()}
    finally:
        simhash.PART = held
    assert all(((u ^ v) & (2**64 - 1)).bit_count() <= 64 for u, v in links)
    expected = classes([signed(p) for p in ids], ids)
    assert {k: stars.get(k, k) for k in expected} == expected


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).toPandas().set_index("doc_id")
    docs = read("documents")
    docs = docs[[bool(re.search(r"[^\W\d_]", t or "")) for t in docs.text]]
    root = classes(docs.doc_id.tolist(), prints_of(docs.text))
    known = windows(read("benchmark")[["item_id", "text"]].itertuples(index=False))
    docs = docs[[root[k] == k for k in docs.doc_id]]
    docs = docs[[not leaked(t, known)[1] for t in docs.text]]
    assert sorted(rows.index) == sorted(docs.doc_id)
    machine = transducer.compiled()
    for doc_id, text in docs[["doc_id", "text"]].itertuples(index=False):
        row = rows.loc[doc_id]
        assert row.n_chars == len(row.text) and machine.decode(row.ids) == row.text
        assert not base_spans(row.text)
        assert base_spans(text) or row.text == text


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(result, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = db.execute(ORACLES[name]).df()
    names = list(expected.columns)
    found = result(name).reset_index()[names].sort_values(names, ignore_index=True)
    pd.testing.assert_frame_equal(expected.sort_values(names, ignore_index=True), found, check_dtype=False)
