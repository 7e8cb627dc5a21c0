"""Registered queries and the pipeline."""

import random
import subprocess
import sys

import pytest

import corpus_pipeline
from careflow.llm import decontamination, near_dedup, quality_rules, suffix_dedup
from careflow.llm.oracle import ORACLE
from careflow.llm.queries import QUERIES
from tests.compare import connect, spark_rows, sql_rows
from tests.llm.tables import documents, odd_texts


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, small, name):
    folder = small.replace("sf0.001", "sf0.01")
    got = spark_rows(QUERIES[name](spark, folder))
    assert got == sql_rows(connect(folder), ORACLE[name])
    assert got[1]


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def by_stages(spark, docs, folder):
    """Ids that the operators keep when they are applied one after the other, each to all that its predecessor kept."""
    keep = lambda df, ids: df.where(df["doc_id"].isin(sorted(ids)))
    docs = keep(docs, {r.doc_id for r in quality_rules.rate(docs).where("kept").collect()})
    docs = keep(docs, {r.doc_id for r in near_dedup.classes(docs).where("doc_id = class_id").collect()})
    docs = suffix_dedup.without_repeats(docs)
    found = {r.doc_id for r in decontamination.leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    return {r.doc_id for r in docs.collect()} - found


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    packed = corpus_pipeline.run(spark, small)
    ids = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert ids < {r.doc_id for r in docs.collect()} and len(ids) > 50
    assert ids == by_stages(spark, docs, small)
    assert [r.sequence_id for r in packed.select("sequence_id").distinct().orderBy("sequence_id").collect()] == list(range(packed.selectExpr("max(sequence_id) + 1").first()[0]))


def test_packing_stage_stands_odd_rows(spark, small):
    docs = documents(spark, odd_texts(random.Random(17)), lang=None, source=None)
    name, function = corpus_pipeline.STAGES[4]
    out = function(spark, docs, small).collect()
    assert name == "packing" and sum(r.is_start for r in out) == docs.count() == sum(r.is_end for r in out)
    places = sorted((r.sequence_id, r.offset, r.length) for r in out)
    assert all((s, o) == ((t, p + n) if p + n < 1024 else (t + 1, 0)) for (t, p, n), (s, o, _) in zip(places, places[1:], strict=False))
    assert function(spark, docs.limit(0), small).count() == 0


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_and_stand_odd_rows(spark, small, stage):
    docs = documents(spark, odd_texts(random.Random(16)), lang=None, source=None).selectExpr("doc_id", "text", "lang", "source", "CAST(length(text) AS LONG) AS n_chars", "node AS extra", "`a.b`")
    function = corpus_pipeline.STAGES[stage][1]
    out = function(spark, docs, small)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert out.count() <= docs.count()
    assert function(spark, docs.limit(0), small).count() == 0


def test_rest_works_without_the_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "careflow.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
assert entry.queries() and not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rpartition("/")[0])
