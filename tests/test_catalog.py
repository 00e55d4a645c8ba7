"""Every registered query against its SQL, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

from catalog.oracles import ORACLES
from catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in ("pages", "documents"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    expected = duck.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    rows = expected.fetchall()
    assert rows
    assert ordered(frame.columns, frame.collect()) == ordered(expected.columns, rows)


HIDDEN = """
import sys

class Hide:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "sitetext.llm"):
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
from catalog.queries import QUERIES
assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
"""


def test_entry_without_the_llm_package():
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", HIDDEN], cwd=root, check=True)
