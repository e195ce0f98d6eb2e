"""Every registered query against its SQL, on the smallest sample tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from acceptance.oracle import ORACLE
from acceptance.queries import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="sample tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, database, name):
    df = contract.queries()[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    got = [tuple(row) for row in df.select(*columns).collect()]
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = database.execute(
        f"SELECT {listed} FROM ({contract.oracle_sql()[name]})"
    ).fetchall()
    assert got, "an empty result proves nothing"
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_entry_without_optional_folders(tmp_path):
    """A copy without the optional folders, corpus_pipeline.py left or not, still registers the other queries."""
    skipped = shutil.ignore_patterns(".git", "llm", "__pycache__")
    copy = shutil.copytree(Path(contract.__file__).parent, tmp_path / "copy", ignore=skipped)
    assert not list(copy.rglob("llm"))
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    for _ in range(2):
        ran = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
        assert ran.stdout.split() == sorted(QUERIES), ran.stderr
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
