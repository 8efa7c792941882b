"""Token counts against the tokenizer library."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkq.llm.tokens import Counter, Vocabulary, merge_counts, token_count

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = Vocabulary.load(PATH)
ODD = [
    "", "aaaaaaa", "<|endoftext|>hi<|startoftext|> <|endoftext", "it's I'LL don't we'd", "ΣΑΣ ΟΔΟΣ İstanbul ß ﬁ ½ ² 12345",
    "a\x1cb\x1db\x85c\xa0d e", "日本語テキスト 한국어 عربي", "é é ñ", "🙂👍🏽!!??", "\x00\x01", "____ a_b 'S 'sx", "x" * 5000, "  \n\t ",
    "word.word, word; (word) w'ord...",
    "a\u1680b\u2003c\u200ad\u200be\u2028f\u2029g\u202fh\u205fi\u3000j\ufeffk\u180el",
    "ǅ ⅷ ₂ ٣ ①x²y ª º ʰ ﬀ Å Ω",
]


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts():
    assert Counter(VOCABULARY).count(ODD) == library(ODD)
    assert Counter(VOCABULARY).count([]) == [] and Counter(VOCABULARY).count([None]) == [0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x3FF), max_size=60), max_size=5))
def test_any_text(texts):
    assert Counter(VOCABULARY).count(texts) == library(texts)


def test_memo_and_slices_change_nothing(monkeypatch):
    monkeypatch.setattr("sparkq.llm.tokens.MEMO", 3)
    monkeypatch.setattr("sparkq.llm.tokens.SLICE", 10)
    assert Counter(VOCABULARY).count(ODD * 2) == library(ODD * 2)


@pytest.mark.parametrize("word", [b"", b"a", b"aaaa", b"aaaaa", b"ababab"])
def test_single_words(word):
    assert merge_counts(VOCABULARY, [word, b"the", word]).tolist()[0] == library([word.decode()])[0]


def test_column(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("n_tokens", F.lit("clash"))
    rows = docs.select("text", token_count(spark, F.col("text"), PATH).alias("n")).collect()
    assert [r.n for r in rows] == library([r.text for r in rows])
    odd = spark.createDataFrame([(None,), ("",), ("a b",), ("a b",)], "text string")
    assert sorted(r[0] for r in odd.select(token_count(spark, F.col("text"), PATH)).collect()) == [0, 0, 2, 2]
    assert odd.limit(0).select(token_count(spark, F.col("text"), PATH)).count() == 0


def test_other_preparation_is_refused():
    with pytest.raises(ValueError, match="not supported"):
        Vocabulary.load(public_tokenizers.path("byte_bpe_50k.json"))
