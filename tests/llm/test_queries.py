"""The registered queries on small tables, and the pipeline's stages."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from lodewright.llm import queries, toxicity
from lodewright.llm.tables import written

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for view in ("documents", "benchmark", "pages"):
        database.execute(f"CREATE VIEW {view} AS FROM '{FOLDER}/{view}.parquet'")
    found = queries.QUERIES[name](spark, FOLDER).toArrow()
    wanted = database.sql(queries.ORACLE[name]).to_arrow_table()
    rows = [Counter(zip(*(t.column(c).to_pylist() for c in sorted(found.column_names)))) for t in (found, wanted)]
    assert rows[0] == rows[1]


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_every_stage_takes_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        assert 0.5 * rows < docs.count() <= rows
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages_take_empty_tables_and_nulls(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (None, "a b c d e f", "en", None, 3), (2, "", "en", "s", 0), (2, "", "en", "s", 0)],
        schema,
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd.where("false"), FOLDER).count() == 0
        assert stage(spark, odd, FOLDER).count() == 4
    assert toxicity.THRESHOLD == 0.3


def test_stage_removes_a_passage_of_51_words(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    passage = " ".join(f"word{i:02}" for i in range(51))
    assert len(passage) < 400
    rows = [(i, f"begin{i} {passage} end{i}", "en", "s", 0) for i in (1, 2)]
    found = corpus_pipeline.without_repeats(spark, spark.createDataFrame(rows, schema), FOLDER).collect()
    assert sorted(r.text for r in found) == ["begin1  end1", "begin2  end2"]
