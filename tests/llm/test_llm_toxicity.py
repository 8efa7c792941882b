"""Grammar, lexicon learning and scores of the toxicity operator."""

import pytest
from pyspark.sql import functions as F

from sparkq.llm.q_toxicity import held_out, model_of, op1_toxicity
from sparkq.llm.toxicity import NAMES, Lexicon, Model, Reader, Transducer, compose, fit, grammar, toxicity_score

READER = Reader(Lexicon.seed())


@pytest.mark.parametrize(
    "clause, name",
    [
        ("you are an idiot", "insult_aimed"),
        ("what an idiot", "insult"),
        ("you are not an idiot", "denied_insult"),
        ("she said you are an idiot", "quoted_insult"),
        ("i will kill you", "threat_aimed"),
        ("i will kill the process", ""),
        ("i will never hurt you", "denied_threat"),
        ("he wrote that they will kill you", "quoted_threat"),
        ("not this time my friends, you idiot", "insult_aimed"),
        ("the idiotic", ""),
        ("a calm clause about you", ""),
    ],
)
def test_clauses(clause, name):
    assert READER.clause(clause) == name


def test_counts_are_by_clause():
    counts = READER.counts("You idiot. Nothing here! She said you are a moron; kill it")
    assert dict(zip(["insult_aimed", "insult"], counts[:2])) == {"insult_aimed": 1, "insult": 0}
    assert counts[5] == 1  # the quoted one
    assert READER.counts("") == READER.counts(None) == (0,) * len(counts)
    assert READER.counts("idiot idiot idiot")[1] == 1


def test_compose_feeds_one_into_the_other():
    first = Transducer(0, {(0, "a"): (1, "b", 1.0)})
    second = Transducer("x", {("x", "b"): ("y", "c", 0.5)})
    both = compose(first, second, ["a"])
    assert both.step(both.start, "a") == ((1, "y"), "c", 1.5)


def four_machines(words, tags, weights):
    """The four machines one after the other, each as a plain loop over the whole clause."""
    hits = ("insult", "weak", "threat")
    tagged = [tags(w) for w in words]
    denied, since = [], 99
    for tag in tagged:
        denied.append(f"denied_{tag}" if tag in hits and since < 3 else tag)
        since = 0 if tag == "negation" else since + 1
    quoted, quoting = [], False
    for tag in denied:
        quoting = quoting or tag == "report"
        plain = tag.removeprefix("denied_")
        quoted.append(f"quoted_{plain}" if quoting and plain in hits else tag)
    aimed = "target" in quoted
    order = [f"{how}{hit}" for hit in ("weak", "threat", "insult") for how in ("quoted_", "denied_")]
    order += ["weak", "threat", "insult"]
    found = [t for t in quoted if t in order]
    best = max(found, key=order.index, default="")
    if not best or (best.endswith("threat") and not aimed) or (best.endswith("weak") and best != "weak"):
        return "", 0.0
    name = f"{best}_aimed" if aimed and best in ("insult", "threat") else best
    return name, weights.get(name, 0.0)


def plain_score(model, text):
    """A document's score by splitting it into clauses and reading every one of them."""
    import math
    import re

    weights, times, z = dict(zip(NAMES, model.weights)), {}, model.intercept
    for clause in re.split(r"[.!?;\n]+", (text or "").lower()):
        name, weight = four_machines(re.findall(r"[^\W\d_]+", clause), model.lexicon.tag, weights)
        if name:
            times[name] = times.get(name, 0) + 1
    z += sum(weights[n] * math.log2(1 + min(c, 3)) for n, c in times.items())
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def test_machine_equals_four_plain_loops():
    import random

    rng = random.Random(4)
    vocabulary = "you idiot moron kill burn not never said wrote the house glorb flimsy, and".split()
    lexicon = Lexicon.seed().learned(["glor"], ["=flimsy"])
    weights = {name: 1.5 * i - 2 for i, name in enumerate(NAMES)}
    reader = Reader(lexicon, grammar(weights))
    for _ in range(4000):
        words = rng.choices(vocabulary, k=rng.randrange(9))
        clause = " ".join(words)
        assert reader.read(clause) == four_machines([w.strip(",") for w in words], lexicon.tag, weights), clause


def test_scores_equal_plain_ones_on_the_tables(spark, sf_dir):
    model = model_of(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    odd = docs.union(spark.createDataFrame([(None,), ("",), ("You idiot! " * 9,), ("she said you idiot\nnot an idiot",)], "text string"))
    for text, score in odd.select("text", toxicity_score(model, F.col("text"))).collect():
        assert score == pytest.approx(plain_score(model, text)), text


def test_learned_entries_and_scores(spark):
    rows = [(i, f"word{i % 7} gruntlau{'xyz'[i % 3]} some text", 1) for i in range(40)]
    rows += [(100 + i, f"word{i % 7} some other text {i}", 0) for i in range(200)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label int")
    model = fit(docs, labels)
    assert any(b.startswith("grun") for b in model.lexicon.beginnings + tuple(model.lexicon.words))
    scored = docs.select("doc_id", toxicity_score(model, F.col("text")).alias("score"))
    by_id = {r[0]: r[1] for r in scored.collect()}
    assert min(by_id[i] for i in range(40)) > 0.7 > max(by_id[i] for i in range(100, 300))


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, label int")
    model = fit(docs, labels)
    assert model == Model()
    odd = spark.createDataFrame([(None,), ("",), ("idiot " * 50_000,)], "text string")
    scores = [r[0] for r in odd.select(toxicity_score(model, F.col("text"))).collect()]
    assert scores[0] == scores[1] < scores[2] <= 1


def test_query_on_the_tables(spark, sf_dir):
    rows = op1_toxicity(spark, sf_dir)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == documents.count()
    assert rows.where("score IS NULL OR score < 0 OR score > 1 OR predicted <> int(score >= 0.7)").isEmpty()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = rows.join(labels, "doc_id").where("predicted = 1")
    assert judged.where("toxic = 1").count() >= 0.8 * judged.count()


def test_held_out_by_checksum(spark):
    import zlib

    got = spark.range(200).select("id", held_out(F.col("id"))).collect()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in got)
