"""The registered queries on the smallest tables, and the pipeline against its parts."""

import glob
import os
import random

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from limnocast.llm.queries import ORACLES, QUERIES
from tests.test_contract import multiset

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="tables are not here")


def test_every_operator_is_registered():
    queries = __spark_entry__.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries)
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, name):
    duck = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        duck.sql(f"CREATE VIEW {os.path.basename(file).removesuffix('.parquet')} AS SELECT * FROM '{file}'")
    df, twin = QUERIES[name](spark, SF), duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(twin.columns)
    assert multiset(df.columns, df.collect()) == multiset(twin.columns, twin.fetchall())


GOOD = ["water", "river", "stone", "green", "winter", "calm", "letter", "window"]


def tables(spark, folder, rows, labels):
    documents = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, documents).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_pipeline_against_plain_rules(spark, tmp_path):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(240):
        bad = i % 5 == 0
        text = " ".join(rng.choice(["$$$", "&&&", "@@@"] if bad else GOOD) for _ in range(80))
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(not bad), 0))
    # Copies of clean documents, and a text of no letters among clean ones.
    rows += [(1000 + i, rows[i][1], "en", "s", 1) for i in (1, 2, 3)] + [(1, rows[1][1], "en", "s", 1)]
    tables(spark, tmp_path, rows, labels)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    kept = {r.doc_id for r in packed.collect()}
    clean = {i for i, *_ in rows if i < 240 and i % 5}
    assert kept <= clean and len(kept) > 0.97 * len(clean)
    # Each stage by itself keeps the columns and does what it says.
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        after.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted(r.doc_id for r in docs.collect()) == sorted(kept)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "packing"]


def test_pipeline_of_empty_and_odd_tables(spark, tmp_path):
    tables(spark, tmp_path / "a", [], [])
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).collect() == []
    odd = [(None, None, None, None, None), (1, "", None, "s", 0), (2, "word " * 30000, None, "s", 9), (2, "word " * 30000, None, "s", 9)]
    tables(spark, tmp_path / "b", odd, [(None, None, None)])
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).columns[:3] == ["doc_id", "piece", "start"]
