"""Every query beside its SQL on the smallest data, and what must hold without the corpus operators."""

import datetime
import math
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry_points
from ladderworks import plans

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    """A value as both engines give it: floats rounded, dates as text, nested values as tuples."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, dict):
        return tuple(sorted((str(k), plain(v)) for k, v in value.items()))
    if isinstance(value, list | tuple):
        return tuple(map(plain, value))
    return int(value) if type(value).__name__ == "Decimal" and value == int(value) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_agrees_with_its_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, SMALL)
    got = table(df.columns, df.collect())
    if name not in plans.ORACLES:
        assert got[0]
        return
    found = duck.execute(plans.ORACLES[name])
    columns = [d[0] for d in found.description]
    want = table(columns, found.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_points_name_the_same_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
def test_entry_has_rows(spark):
    assert entry_points.entry(spark).limit(1).count() == 1


def test_imports_without_the_corpus_operators(tmp_path):
    """With the corpus folder and the pipeline gone, the entry points import and keep the other queries."""
    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    for name in ("__spark_entry__.py", "ladderworks"):
        os.symlink(f"{root}/{name}", tmp_path / name) if name.endswith(".py") else os.mkdir(tmp_path / name)
    for name in os.listdir(f"{root}/ladderworks"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{root}/ladderworks/{name}", tmp_path / "ladderworks" / name)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(open(f"{root}/__spark_entry__.py").read())
    code = "import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(plans.QUERIES)), "False"]
