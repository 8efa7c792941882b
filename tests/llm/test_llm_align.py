"""Alignment of two tokenizers against plain loops over the two libraries."""

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sparkq.llm import align
from sparkq.llm.q_align import op11_alignment

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def brute(texts):
    """Rows (numbers of COLUMNS, groups) by the libraries, loops and dictionaries."""
    import sentencepiece
    from tokenizers import Tokenizer

    from sparkq.llm.tokens import byte_letters

    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: b for b, c in byte_letters().items()}

    def piece(p):
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    rows, holds = [], Counter()
    for text in texts:
        want = (" " + (text or "")).encode()
        a = one.encode(" " + text, add_special_tokens=False) if text else None
        a = [(i, bytes(back[c] for c in t)) for i, t in zip(a.ids, a.tokens)] if text else []
        b = [(i, piece(two.id_to_piece(i))) for i in two.encode(text)] if text else []
        if b"".join(s for _, s in a) != want or b"".join(s for _, s in b) != want:
            rows.append(([], 0, 0))
            continue
        groups, left, right, x, y, i, j = [], [], [], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if x <= y:
                left.append(a[i][0])
                x += len(a[i][1])
                i += 1
            else:
                right.append(b[j][0])
                y += len(b[j][1])
                j += 1
            if x == y:
                groups.append((left, right))
                left, right = [], []
        rows.append((groups, len(a), len(b)))
        holds.update({(p, q) for g in groups for p in g[0] for q in g[1]})
    top = defaultdict(int)
    for (p, _), n in holds.items():
        top[p] = max(top[p], n)
    out = []
    for groups, n_a, n_b in rows:
        links = [(p, q) for g in groups for p in g[0] for q in g[1]]
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(holds[k] == top[k[0]] for k in links)
        out.append((n_a, n_b, len(groups), len(links), best, sum(holds[k] for k in links), told))
    return out


TEXTS = [
    None,
    "",
    " ",
    "hello wonderful world",
    "hello wonderful world",
    "Grüße <|endoftext|> und </s> <0x41>",
    "▁own mark",
    "日本語のテキスト 😀😀 x\r\n\ty",
    "é \0 zero",
    "\n " * 700,
    "a" * 5000,
    "ab" * 900 + "🦜" * 300,
    "hello " * 400,
]


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("fan_in, chars", [(2, 40), (64, align.SLICE)])
def test_equals_plain_loops(spark, fan_in, chars):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "radix int, text string").repartition(3)
    got = align.align_corpus(spark, docs, "text", A, B, ["radix", "text"], fan_in=fan_in, slice_chars=chars)
    assert got.columns == ["radix", "text", *COLUMNS, "groups"]
    want = [(i, t, *row) for i, (t, row) in enumerate(zip(TEXTS, brute(TEXTS)))]
    assert result(got) == sorted(want, key=repr)


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [
        (i, *row[:-1], sha256(row[-1].encode()).hexdigest() if row[-1] else "")
        for (i, _), row in zip(docs, brute([t for _, t in docs]))
    ]
    assert result(op11_alignment(spark, sf_dir)) == sorted(want, key=repr)


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    texts = [t for t in TEXTS if t] * 2
    aligner = align.Aligner(A, B)
    whole = aligner.align(texts)
    monkeypatch.setattr(align, "LARGE", 3)
    parts = align.Aligner(A, B).align(texts)
    for name in ("pair", "doc", "links", "n_links"):
        assert np.array_equal(getattr(whole, name), getattr(parts, name)), name


def test_runs_merge_by_heap():
    rng = np.random.default_rng(5)
    runs = []
    for _ in range(9):
        pairs = np.unique(rng.integers(0, 500, rng.integers(1, 200)))
        runs.append((pairs, rng.integers(1, 9, len(pairs))))
    want = Counter()
    for pairs, counts in runs:
        want.update(dict(zip(pairs.tolist(), counts.tolist())))
    pairs, counts = align.merged(runs)
    assert dict(zip(pairs.tolist(), counts.tolist())) == want and (np.diff(pairs) > 0).all()
    for one in ([], [0], [255, 256, 1 << 40]):
        assert [x.tolist() for x in align.unpack(align.pack(np.array(one, np.int64)))] == [one]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align.align_corpus(spark, empty, "text", A, B, ["doc_id"]).count() == 0
    odd = spark.createDataFrame([(None, None, "x"), (1, "", None), (1, "same", "y"), (1, "same", "y")], "doc_id long, text string, slice string")
    got = align.align_corpus(spark, odd, "text", A, B, ["doc_id", "slice"], outputs={"n": F.length("groups")})
    rows = result(got.select("doc_id", "slice", "n_a", "n_links", "count_sum", "n"))
    assert [r[:2] for r in rows] == [(1, "y"), (1, "y"), (1, None), (None, "x")]
    assert rows[2][2:] == rows[3][2:] == (0, 0, 0, 0)
    assert rows[0] == rows[1] and rows[0][4] == 2 * rows[0][3]
    with pytest.raises(ValueError, match="n_a"):
        align.align_corpus(spark, odd.withColumn("n_a", F.lit(1)), "text", A, B, ["n_a"])
