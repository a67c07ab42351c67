"""Every registered query of the engine against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from corpusloom.plans import catalog

SLOW = {"hybrid_pairs", "greedy_resolve", "tfidf_logreg", "tfidf_svm", "embedding_logreg", "kappa_bootstrap"}


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:26]
    return round(float(v), 9) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(set(catalog.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = catalog.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    found = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in found.description]
    wanted = sorted((tuple(plain(dict(zip(names, row, strict=True))[c]) for c in columns) for row in found.fetchall()), key=repr)
    assert sorted(names) == columns and got == wanted


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_the_rest_stands_without_the_training_data_operators(tmp_path):
    import pathlib
    import shutil
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parents[1]
    shutil.copytree(root / "corpusloom", tmp_path / "corpusloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and 'pipeline' not in q and not any(n.startswith('op1') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
