"""The manifest against a tree built by plain loops."""

from hashlib import sha256
from itertools import groupby
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from sparkq.llm.manifest import fold, manifest
from sparkq.llm.q_manifest import FIELDS, op13_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, place int"


def h(text):
    return sha256(text.encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """Levels up to the one node that remains."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def steps(levels, at):
    """(left?, sibling or None) of each level above a node."""
    for nodes in levels[:-1]:
        other = at ^ 1
        yield other < at, nodes[other] if other < len(nodes) else None
        at >>= 1


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row."""
    leaf = lambda r: h("".join(map(told, r)))
    key = lambda r: (r[2] is not None, (r[2] or "").encode())
    order = lambda r: (key(r), r[0] is not None, r[0] or 0, leaf(r))
    groups = [list(g) for _, g in groupby(sorted(rows, key=order), key)]
    trees = [climb([leaf(r) for r in g]) for g in groups]
    upper = climb([t[-1][0] for t in trees]) if groups else []
    out = []
    for place, (group, levels) in enumerate(zip(groups, trees)):
        for i, row in enumerate(group):
            way = [*steps(levels, i), *steps(upper, place)]
            changed = row[0] is not None and crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            node = leaf((*row[:3], row[3] + 1, row[4])) if changed else leaf(row)
            for left, sibling in way:
                node = h(node if sibling is None else sibling + node if left else node + sibling)
            proof = h("".join(s for _, s in way if s is not None))
            root = upper[-1][0]
            out.append((row[0], leaf(row), levels[-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def digests(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, df.withColumn("proof_sha256", F.sha2("siblings", 256)).select(columns).collect()), key=repr)


def claim():
    from sparkq.llm.manifest import leaf_digest

    more = [(F.col(c) + 1 if c == "n_chars" else F.col(c)) for c in FIELDS]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return F.when(changed & F.col("n_chars").isNotNull(), leaf_digest(more))


def rows_of(n):
    langs = [None, "", "en", "en", "en", "ä", "￮", "\U0001f99c"]
    rows = [(i * 37 % n, f"s{i % 3}", langs[i % len(langs)], None if i % 11 == 0 else i, "tëxt " * (i % 5)) for i in range(n)]
    return [*rows, (None, None, None, None, None), (3, "x", "en", 1, None), (3, "x", "en", 1, None), (3, "a", "en", 1, "")]


@pytest.mark.parametrize("bits", [1, 3, 10])
@pytest.mark.parametrize("n", [1, 8, 67])
def test_equals_plain_loops(spark, bits, n):
    rows = rows_of(n)
    docs = spark.createDataFrame([(*r, "clash", 0) for r in rows], SCHEMA).repartition(4)
    assert digests(manifest(docs, FIELDS, "doc_id", "lang", claim(), bits)) == brute(rows)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS).collect()]
    got = sorted(map(tuple, op13_manifest(spark, sf_dir).collect()), key=repr)
    assert got == brute(rows)
    assert {g[-1] for g in got} == {True, False}


def test_proofs_stand_alone(spark):
    docs = spark.createDataFrame([(*r, "", 0) for r in rows_of(40)], SCHEMA)
    for r in manifest(docs, FIELDS, "doc_id", "lang", bits=2).collect():
        assert r.verified and fold(r.leaf, r.sides, r.siblings) == r.root
        assert len(r.siblings) == 64 * sum(s != "-" for s in r.sides)
        if r.siblings:
            assert fold(r.leaf, r.sides, "0" * 64 + r.siblings[64:]) != r.root


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert manifest(empty, FIELDS, "doc_id", "lang").count() == 0
    one = spark.createDataFrame([(1, None, None, None, "x" * 300_000, "", 0)], SCHEMA)
    (row,) = manifest(one, FIELDS, "doc_id", "lang", claim()).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.sides == row.siblings == ""
