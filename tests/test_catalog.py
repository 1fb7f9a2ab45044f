"""Every query of the catalog against its SQL twin."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from frameloom import catalog

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("embeddings", "events", "orders"):
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    want = [tuple(row[names.index(c)] for c in columns) for row in found.fetchall()]
    assert sorted(names) == columns
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(want) and want


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 500
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_stands_alone(tmp_path, pipeline):
    """Without the text subpackage, whether its pipeline is still there or not,
    all of the catalog's queries remain."""
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "frameloom", tmp_path / "frameloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py") + ("corpus_pipeline.py",) * (pipeline and (root / "corpus_pipeline.py").exists()):
        shutil.copy(root / name, tmp_path)
    code = "import bench, __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert done.stdout.split("\n")[:2] == [" ".join(sorted(QUERIES)), " ".join(sorted(ORACLES))]
