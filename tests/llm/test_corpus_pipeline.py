"""The registered queries and the pipeline."""

import os
import subprocess
import sys

import corpus_pipeline
import duckdb
import pytest
from conftest import ROOT, TESTDATA

from cinetally.llm import near_dedup, queries
from test_copies import brute_classes, same
from test_scans import brute_contained

SF = f"{TESTDATA}/{os.environ.get('ORACLE_SF', 'sf0.01')}"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for file in ("documents", "labels", "benchmark"):
        duck.sql(f"create view {file} as select * from '{SF}/{file}.parquet'")
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    relation = duck.sql(queries.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    expected = relation.select(*(f'"{c}"' for c in columns)).fetchall()
    assert len(rows) > 0 and sorted(rows, key=repr) == sorted(expected, key=repr)


def test_all_operators_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def test_stages(spark, tmp_path):
    """Each stage by brute force over what the stage before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole, outputs = docs, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        outputs.append([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
        if name != "pieces":
            assert docs.columns == whole.columns
    clean, exact, near, fresh, final = outputs
    assert 0.85 * whole.count() < len(clean) < whole.count()
    first = {}
    for doc, text in sorted(clean):
        first.setdefault(same(text), doc)
    assert sorted(d for d, _ in exact) == sorted(first.values())
    assert sorted(d for d, _ in near) == sorted(c[0] for c in brute_classes(exact))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, *_ in brute_contained(near, items)}
    assert leaked and {d for d, _ in fresh} == {d for d, _ in near} - leaked
    assert sorted(final) == sorted(fresh)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "text").collect())) == sorted(final)


def test_an_empty_table_goes_through(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()


def test_the_library_works_without_these_operators():
    code = (
        "import sys\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        "class Hide:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('cinetally.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Hide())\n"
        "import __spark_entry__ as e\n"
        "assert not [q for q in e.queries() if q.startswith('op') or q == 'pipeline'] and len(e.queries()) > 80\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)


def test_constants_of_near_duplicates():
    miss = (1 - near_dedup.THRESHOLD**near_dedup.BAND_REGISTERS) ** near_dedup.BANDS
    assert miss < 1e-4
