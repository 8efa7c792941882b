"""Sampled segmentations: exact way back, reproducible, with the lattice's shares."""

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkq.llm.pieces import MARK, SLICE, Encoder, Pieces, decode, encode

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b\n c ▁d\t́e", "日本語🙂👍🏽\n\n", "x" * 3000, "   lead", "a\x00b", "▁▁ ▁", "trail  "]


@pytest.fixture(scope="module")
def pieces():
    return Pieces.load(PATH)


def keys(n):
    return np.arange(n, dtype=np.uint64)


def spelled(pieces, ids):
    text = b"".join(pieces.spelling[i] for i in ids).decode()
    return text[1:] if text.startswith(" ") else text


def test_every_text_comes_back(pieces):
    ids = Encoder(pieces, 1, 1.0).batch(ODD, keys(len(ODD))).to_pylist()
    assert [spelled(pieces, i) for i in ids] == ODD and ids[0] == []


def test_rows_do_not_depend_on_their_neighbours(pieces, monkeypatch):
    texts = ["the quick brown fox %d jumps over it" % i for i in range(50)] + ODD
    whole = Encoder(pieces, 7, 1.0).batch(texts, keys(len(texts))).to_pylist()
    single = [Encoder(pieces, 7, 1.0).batch([t], keys(len(texts))[i : i + 1]).to_pylist()[0] for i, t in enumerate(texts)]
    assert whole == single
    monkeypatch.setattr("sparkq.llm.pieces.MEMO", 50)
    monkeypatch.setattr("sparkq.llm.pieces.SLICE", 40)
    assert Encoder(pieces, 7, 1.0).batch(texts, keys(len(texts))).to_pylist() == whole
    assert Encoder(pieces, 8, 1.0).batch(texts, keys(len(texts))).to_pylist() != whole


def segmentations(pieces, word):
    """All ways through the lattice of a word with their weights, by brute force."""
    names = {}
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            names[model.id_to_piece(i)] = i

    def ways(at):
        if at == len(word):
            yield (), 0.0
        for end in range(at + 1, len(word) + 1):
            i = names.get(word[at:end])
            if i is not None:
                for rest, weight in ways(end):
                    yield (i, *rest), weight + pieces.weights[i]

    return dict(ways(0))


def test_shares_of_segmentations(pieces):
    n = 20_000
    ids = Encoder(pieces, 3, 0.5).batch(["lower"] * n, keys(n)).to_pylist()
    got = Counter(map(tuple, ids))
    ways = segmentations(pieces, MARK + "lower")
    total = sum(math.exp(0.5 * w) for w in ways.values())
    assert set(got) <= set(ways)
    for way, weight in ways.items():
        share = math.exp(0.5 * weight) / total
        assert abs(got[way] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-3


def test_columns(spark):
    rows = [(1, t) for t in ODD] + [(None, None), (2, "the same"), (2, "the same")]
    df = spark.createDataFrame(rows, "k long, text string").withColumn("ids", F.lit("clash"))
    out = df.select("text", encode(spark, F.col("text"), F.col("k"), PATH).alias("got"))
    out = out.withColumn("back", decode(spark, F.col("got"), PATH))
    assert out.where("NOT (text <=> back)").count() == 0
    same = [r.got for r in out.where("text = 'the same'").collect()]
    assert same[0] == same[1]
    assert out.limit(0).count() == 0


def test_documents_come_back(spark, sf_dir):
    from sparkq.llm.q_pieces import op5_sentencepiece

    rows = op5_sentencepiece(spark, sf_dir)
    assert rows.where("NOT lossless").count() == 0
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_memory_is_bounded_by_slices_and_memo(pieces):
    """Many new words: arcs and slices stay within their bounds, whatever the batch."""
    import random
    import tracemalloc

    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [" ".join("".join(rng.choices(letters, k=rng.randrange(3, 12))) for _ in range(400)) for _ in range(900)]
    encoder = Encoder(pieces, 1, 1.0)
    tracemalloc.start()
    for part, ids in encoder.slices(pa.array(texts), keys(len(texts))):
        assert sum(map(len, part)) <= SLICE and len(ids) == len(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, texts)) > 2_500_000 and peak < 250_000_000
