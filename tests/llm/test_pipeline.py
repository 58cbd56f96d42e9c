"""The corpus pipeline and the registered queries."""

from __future__ import annotations

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from plumbline.llm.queries import ORACLE_SQL, QUERIES

from .conftest import prose
from .test_documents import brute_similar

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    registered = driver.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in registered) == 1
    assert registered["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF_DIR).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_near_duplicate_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op5_chosen_path_join"](spark, SF_DIR).select("doc_id", "class_id", "n_linked_docs").collect()
    assert sorted(map(tuple, got)) == brute_similar(rows)


def test_stages_decide(spark, workspace, make_docs, tmp_path):
    """Planted cases: each goes where it should, and clean documents stay to the end."""
    rng = random.Random(21)
    passage = "one passage of the benchmark that is long enough to be a window of its own"
    texts = [prose(rng, rng.randrange(60, 200), 3000) for _ in range(200)]
    texts[10] = texts[9]
    texts[11] = texts[9] + " more"
    texts[12] = "too short"
    texts[13] = "again and again it goes on " * 20
    texts[14] = f"{texts[14]} {passage} {texts[15][:200]}"
    folder = str(tmp_path)
    docs = make_docs(texts, lambda i: "big" if i % 4 else "small").withColumn("_row", F.lit(1))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = workspace.stage(stage(spark, docs, folder), name.replace(" ", "-"))
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "benchmark decontamination":
            assert docs.filter(F.col("text").contains("passage of the")).isEmpty()
    everything = set(range(200))
    assert seen[0] == everything - {12, 13}
    assert seen[1] == seen[2] == seen[3] == seen[4] == everything - {12, 13, 10, 11}
    assert corpus_pipeline.run(spark, folder).count() == docs.count()


def test_stages_take_edge_rows(spark, workspace, edge_docs, no_docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for given in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, given, folder)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == given.columns
            rows = out.count()
            assert rows <= 2 * given.count() and (rows > 0) == (given is edge_docs)
    assert math.isfinite(rows)
