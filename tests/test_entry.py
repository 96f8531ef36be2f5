"""The register, and every query of the core beside its SQL."""

import glob
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"


def run(code, folder=REPO):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(folder)})


def test_names_are_unique():
    names = [n for m in entry.MODULES for n in m.QUERIES]
    assert len(names) == len(set(names)) and set(entry.oracle_sql()) <= set(names) and {"p2_found", "p3_found"} <= set(names)


def test_without_the_text_subpackage(tmp_path):
    shutil.copytree(REPO / "folioframe", tmp_path / "folioframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    got = run("import __spark_entry__ as e; print(*e.queries())", tmp_path)
    assert "p3_found" in got.stdout and "p1_found" not in got.stdout, got.stderr


def test_a_broken_subpackage_fails_loudly(tmp_path):
    shutil.copytree(REPO / "folioframe", tmp_path / "folioframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    (tmp_path / "folioframe" / "llm").mkdir()
    (tmp_path / "folioframe" / "llm" / "__init__.py").write_text("")
    got = run("import __spark_entry__ as e; print(*e.queries())", tmp_path)
    assert got.returncode and "ModuleNotFoundError" in got.stderr


def rows(columns, found):
    def plain(v):
        return float(f"{v:.9g}") if isinstance(v, float) else list(map(plain, v)) if isinstance(v, (list, tuple)) else v

    return sorted(repr([plain(v) for _, v in sorted(zip(columns, r))]) for r in found)


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        db.execute(f"create view {Path(f).stem} as select * from read_parquet('{f}')")
    return db


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")
@pytest.mark.parametrize("name", sorted(n for m in entry.MODULES if ".llm" not in m.__name__ for n in m.QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    df = entry.queries()[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    if sql := entry.oracle_sql().get(name):
        want = tables.sql(sql)
        assert sorted(df.columns) == sorted(want.columns)
        assert rows(df.columns, got) == rows(want.columns, want.fetchall())
