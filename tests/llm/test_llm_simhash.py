"""Fingerprints, anchor codes, links and components against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkq.llm import simhash
from sparkq.llm.simhash import (
    TWO_GOLAY,
    TWO_GOLAY_HAMMING,
    Code,
    connected,
    golay,
    hamming,
    keep_one,
    links,
    near_duplicates,
    slices,
    text_fingerprint,
)


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n\t", "one", "Two words", "a b c d e f a b c a b c", "É é\x0bx y\x0cz"])
def test_fingerprint(text):
    assert text_fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text_in_slices(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=5000))
    want = plain_fingerprint(text)
    monkeypatch.setattr("sparkq.llm.simhash.SLICE", 1000)
    assert text_fingerprint(text) == want


def test_same_hash_as_spark(spark):
    h = spark.sql("SELECT xxhash64('a b c') AS h").first().h
    assert h % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("block", [golay(), hamming(4), hamming(3)])
def test_codes_are_perfect(block):
    leaders = block.leaders()
    assert len(set(leaders.tolist())) == 1 << block.parity
    assert max(int(e).bit_count() for e in leaders.tolist()) == block.radius


def test_anchors_within_reach():
    code = Code((hamming(3), hamming(3)))
    anchors = [a for a in range(1 << 14) if all(code.blocks[0].syndromes(np.array([a & 127, a >> 7], np.uint64)) == 0)]
    words = np.array(random.Random(2).sample(range(1 << 14), 40), np.uint64)
    at, found = code.within(words, 4)
    for i, w in enumerate(words.tolist()):
        want = sorted(a for a in anchors if (a ^ w).bit_count() <= 4)
        assert sorted(found[at == i].tolist()) == want
    homes = code.home(words)
    assert all((int(h) ^ w).bit_count() <= code.radius for h, w in zip(homes.tolist(), words.tolist()))


def test_replicas_at_a_time_are_bounded():
    # Anchors themselves have 1,519 others within reach, most fingerprints 77.
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    words[1000:4000] = TWO_GOLAY.home(words[1000:4000])
    reach = TWO_GOLAY.radius + 2
    parts = list(slices(words, TWO_GOLAY, reach))
    assert np.concatenate(parts).tolist() == words.tolist()
    found = [TWO_GOLAY.within(part, reach)[0] for part in parts]
    assert max(len(at) for at in found) <= simhash.REPLICAS < sum(len(at) for at in found)
    counts = np.concatenate([np.bincount(at, minlength=len(p)) for at, p in zip(found, parts)])
    assert counts.tolist() == TWO_GOLAY.near(words, reach).tolist() and counts.max() == 1519


def test_a_word_with_more_replicas_than_the_bound_goes_alone(monkeypatch):
    monkeypatch.setattr(simhash, "REPLICAS", 100)
    words = TWO_GOLAY.home(np.array([7, 8, 9 << 40], np.uint64))
    assert [len(p) for p in slices(words, TWO_GOLAY, TWO_GOLAY.radius + 2)] == [1, 1, 1]
    assert list(slices(words[:0], TWO_GOLAY, 8)) == []


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.fixture(scope="module")
def prints():
    rng = random.Random(3)
    out = [rng.getrandbits(64) for _ in range(150)]
    for base in out[:60]:
        for flips in (1, 2, 3):
            x = base
            for b in rng.sample(range(64), flips):
                x ^= 1 << b
            out.append(x)
    # A chain, each two bits from the next.
    x = out[0]
    for i in range(0, 40, 2):
        x ^= 3 << i
        out.append(x)
    return out


@pytest.mark.parametrize("code", [TWO_GOLAY, TWO_GOLAY_HAMMING, Code((golay(),))])
def test_links_are_all_pairs(spark, prints, code):
    if code is TWO_GOLAY_HAMMING:
        prints = prints[:200]
    df = spark.createDataFrame([(signed(x),) for x in [*prints, *prints[:5]]] + [(None,)], "fp long")
    got = {(r.a, r.b) for r in links(df, code=code).collect()}
    values = sorted({signed(x) for x in prints})
    want = {
        (a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) % 2**64).bit_count() <= 2
    }
    assert got == want and len(want) > 20


def roots_of(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_connected(spark):
    rng = random.Random(4)
    pairs = [tuple(sorted(rng.sample(range(80), 2))) for _ in range(45)] + [(i, i + 1) for i in range(200, 260)]
    df = spark.createDataFrame(pairs, "a long, b long")
    assert {r.node: r.root for r in connected(df).collect()} == roots_of(pairs)
    assert connected(df.limit(0)).count() == 0


@pytest.mark.parametrize("room, most", [(16_384, 1), (40, 8)])
def test_few_rows_are_staged_in_few_files(spark, monkeypatch, room, most):
    files = []

    def counted(df, label, stage=simhash.stage):
        out = stage(df, label)
        files.append((label, len(out.inputFiles())))
        return out

    monkeypatch.setattr(simhash, "stage", counted)
    monkeypatch.setattr(simhash, "FILE", room)
    # Twelve chains of ten texts' fingerprints; ids count down along a chain.
    prints = []
    for i in range(12):
        x = random.Random(i).getrandbits(64)
        for b in range(0, 20, 2):
            prints.append((1000 * i + 100 - b, signed(x)))
            x ^= 3 << b
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        got = simhash.components(spark.createDataFrame(prints, "doc_id long, fp long"))
        assert got.rdd.getNumPartitions() <= most
        got = {r.doc_id: r.component_id for r in got.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i // 1000 * 1000 + 82 for i, _ in prints}
    assert {label for label, _ in files} == {"signatures", "fingerprints", "links", "roots", "fingerprint-ids", "components"}
    assert all(n <= most for label, n in files if label != "signatures"), files


DOCS = [
    (5, "the same words come again and again here", "x"),
    (3, "the same words come again and again here", "y"),
    (3, "the same words come again and again here", "y"),
    (None, "THE same  words come again\nand again here", "z"),
    (9, "entirely different content with many other words in it", None),
    (7, None, "n"),
    (8, "", "e"),
    (2, "  \n", "e"),
]


def test_documents_and_odd_rows(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, fp string").withColumn("component_id", F.lit("mine"))
    got = Counter((r.doc_id, r.component_id) for r in near_duplicates(docs).collect())
    assert got == Counter({(5, 3): 1, (3, 3): 2, (None, 3): 1, (9, 9): 1, (7, 2): 1, (8, 2): 1, (2, 2): 1})
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.fp) for r in kept.collect()) == [(2, "e"), (3, "y"), (9, None)]
    none = docs.limit(0)
    assert near_duplicates(none).count() == 0 and keep_one(none).count() == 0


def test_components_on_the_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(i, text_fingerprint(t)) for i, t in docs.select("doc_id", "text").collect()]
    values = sorted({f for _, f in rows})
    pairs = [(a, b) for i, a in enumerate(values) for b in values[i:] if (a ^ b).bit_count() <= 2]
    root = roots_of(pairs)
    least = {}
    for i, f in rows:
        least[root[f]] = min(i, least.get(root[f], i))
    want = {i: least[root[f]] for i, f in rows}
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == want
