"""Registered queries against their oracle SQL, and the pipeline by hand."""

import subprocess
import sys

import pytest
from compare import oracle, table
from conftest import ROOT
from pyspark.sql import functions as F

import corpus_pipeline
from sparkq.llm.queries import ORACLES, QUERIES
from sparkq.plans.staging import stage

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle(sf_dir, TABLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    assert table(df.columns, df.collect()) == table([d[0] for d in cursor.description], cursor.fetchall())


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark, sf_dir):
    docs = stage(spark.read.parquet(f"{sf_dir}/documents.parquet"), "in")
    seen = []
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, sf_dir), "out")
        if name != "packing":
            assert out.columns == docs.columns
            assert out.join(docs, "doc_id", "left_anti").isEmpty()
            assert out.where("NOT (n_chars <=> length(text))").isEmpty()
        seen.append(out.count())
        docs, before = out, docs
    assert seen[0] >= seen[1] == seen[2] == seen[3] <= seen[4]
    assert docs.select("doc_id").distinct().count() == before.count()
    run = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", "piece", "n_tokens", "bucket", "batch", "slot"]
    assert run.select(*key).exceptAll(docs.select(*key)).isEmpty() and run.count() == docs.count()


def test_stages_take_odd_rows(spark, sf_dir, tmp_path):
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(None, None, None, None, None), (1, None, "en", None, 0), (2, "", None, "s", 0), (2, "", None, "s", 0)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, whole.schema).withColumn("score", F.lit(1))
        for _, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, sf_dir), "odd")
        assert docs.count() == (1 if rows else 0)


def test_entry_without_the_subpackage(tmp_path):
    import shutil

    for name in ("__spark_entry__.py", "sparkq"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0 and done.stdout.split()[-1] == "False"
