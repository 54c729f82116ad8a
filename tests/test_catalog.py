"""Every query with an SQL twin, side by side in both engines on the smoke tables."""

import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import catalog.registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_query_of_the_catalog_has_a_twin():
    assert set(catalog.registry.QUERIES) == set(catalog.registry.SQL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, sf_dir, duck, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    wanted = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=key)
    assert found == wanted
    assert found and not any(isinstance(v, float) and math.isnan(v) for r in found for v in r)


@pytest.mark.parametrize("name", ["stage_audit", "dashboard", "classifier_report", "silhouette", "campaigns_enriched", "string_index_lookup"])
def test_no_python_in_the_plan(spark, sf_dir, name):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


ROOT = os.path.dirname(os.path.abspath(entry.__file__))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), len(e.oracle_sql()))"


def shown(code, folder):
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    return done.stdout.split() or done.stderr


@pytest.mark.parametrize("absent", ["pledgekit.llm", "public_tokenizers", "pyarrow"])
def test_entry_without_the_corpus_operators(absent):
    """The other queries are there without the subpackage, and without a module that only it needs."""
    found = shown(f"import sys; sys.modules['{absent}'] = None; {COUNT}", ROOT)
    assert found == [str(len(catalog.registry.QUERIES)), "False", str(len(catalog.registry.SQL))]


def test_an_absent_module_of_the_library_is_an_error():
    assert "ModuleNotFoundError" in shown(f"import sys; sys.modules['pledgekit.operators.lookups'] = None; {COUNT}", ROOT)


def test_a_copy_without_the_corpus_folders(tmp_path):
    """With both folders and the pipeline deleted, the entry file works, and all other tests can be collected."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "*.json"))
    found = shown(COUNT, copy)
    assert found == [str(len(catalog.registry.QUERIES)), "False", str(len(catalog.registry.SQL))]
    code = "import sys, pytest; sys.exit(pytest.main(['tests', '--collect-only', '-q', '-p', 'no:cacheprovider']))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "test_same_rows" in done.stdout, done.stdout[-500:]
