"""Measures against plain Python, and host verdicts."""

import re
from collections import Counter

from pyspark.sql import functions as F

from sparkq.llm.quality import judge

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


TEXTS = [
    None,
    "",
    " \n\t\x0b",
    "one two",
    "a b c a b c a b c",
    "a a a a a",
    "é ü\x0cß 🙂 #*$ %&|<>",
    "line\nline\n line\n\n\nline",
    "x y z " * 40,
    " ".join(f"w{i}" for i in range(60)),
    " ".join(f"w{i % 9000}" for i in range(30_000)),
    "no-break space stays inside",
]
NAMES = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()


def test_measures(spark):
    rows = [(i, t, None if i % 3 == 0 else "host") for i, t in enumerate(TEXTS)] + [(3, "one two", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.withColumn("host", F.lit(1)).withColumn("kept", F.lit("clash")).withColumn("words", F.lit(2))
    got = judge(docs, "doc_id", "text", "source").collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain(TEXTS[r.doc_id])
        assert tuple(r[n] for n in NAMES) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert judge(docs.limit(0), "doc_id", "text", "source").count() == 0


def test_hosts_are_shrunk(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "too short"
    rows = [(f"h{h}", good if d % 10 else bad) for h in range(40) for d in range(50)]
    rows += [("bad", bad)] * 45 + [("bad", good)] * 5 + [("tiny", bad), ("tiny", good)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, text string")
    judged = judge(docs, "doc_id", "text", "source").join(docs, "doc_id")
    kept = {r.source: r.n for r in judged.where("kept").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert kept.get("bad") is None and kept["tiny"] == 1 and kept["h0"] == 45
    plan = judge(docs, "doc_id", "text", "source")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
