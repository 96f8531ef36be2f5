"""The text subpackage registers all of its queries, or fails loudly."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent.parent


def run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(REPO)})


@pytest.mark.parametrize("missing", ["duckdb", "public_tokenizers", "regex", "folioframe.llm.registry"])
def test_a_missing_module_fails_loudly(missing):
    got = run(f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries())")
    assert got.returncode and ("ImportError" in got.stderr or "ModuleNotFoundError" in got.stderr)


def test_the_registry_is_complete():
    got = run("import __spark_entry__ as e; print(*sorted(e.queries()))")
    assert {"p1_found", "p4_found", "p5_found", "p6_ids", "p7_found", "p8_found"} <= set(got.stdout.split()), got.stderr
