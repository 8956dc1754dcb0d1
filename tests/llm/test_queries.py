"""The registered queries on the given tables, and the pipeline stage by stage."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from launchtide.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df):
    return sorted((tuple(row[c] for c in sorted(df.columns)) for row in df.collect()), key=str)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def test_all_and_the_pipeline_are_registered():
    names = [key for key in __spark_entry__.queries() if key.startswith("op")]
    assert sorted(int(key[2:].split("_")[0]) for key in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_equals_oracle(spark, duck, key):
    found = QUERIES[key](spark, SF_DIR)
    wanted = duck.execute(ORACLE_SQL[key])
    names = [column[0] for column in wanted.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    assert sorted(found.columns) == sorted(names)
    assert rows(found) == sorted((tuple(r[i] for i in order) for r in wanted.fetchall()), key=str)


def test_pipeline_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "mixing", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, before, SF_DIR), name)
        assert after.schema.names == docs.schema.names
        if name != "mixing":
            assert after.exceptAll(before).count() == 0 and 0 < after.count() < before.count()
        else:
            assert after.distinct().exceptAll(before.distinct()).count() == 0
        before = after
    whole = corpus_pipeline.run(spark, SF_DIR)
    ends = whole.groupBy("doc_id").sum("length").count()
    assert ends == before.select("doc_id").distinct().count()
    empty = [stage(spark, docs.limit(0), SF_DIR).count() for _, stage in corpus_pipeline.STAGES]
    assert empty == [0] * 5


def test_stages_take_nulls_repeats_and_clashing_columns(spark, edge_rows):
    """Each stage on its own, over texts of all kinds beside the given documents."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(*row, None if row[1] is None else len(row[1])) for row in edge_rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    clashing = {"score": "x", "kept": "y", "KEPT_ID": "z", "mix_size": "w", "copy": "v"}
    mixed = docs.unionByName(odd).unionByName(odd.filter("doc_id = 7"))
    wide = mixed
    for name, value in clashing.items():
        wide = wide.withColumn(name, F.lit(value))
    whole = set(map(str, wide.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, wide, SF_DIR)
        if name == "mixing":
            # Its own columns replace those of the same names.
            assert set(docs.columns) <= set(kept.columns) and kept.count() > 0
        else:
            rows_kept = kept.select(wide.columns).collect()
            assert kept.columns == wide.columns and set(map(str, rows_kept)) <= whole and 0 < len(rows_kept) < wide.count()
    pieces = corpus_pipeline.packing(spark, wide, SF_DIR)
    assert pieces.groupBy("doc_id").count().count() == mixed.select("doc_id").distinct().count()
