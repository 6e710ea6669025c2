"""The library works without the optional subpackage, and without what that needs."""

import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT, SF

CODE = """
import sys
{before}
import __spark_entry__ as E
from ledgerlens.plans.catalog import QUERIES
assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) <= set(QUERIES)
{after}
"""
RUN = f"""
from ledgerlens.session import build_session
spark = build_session(2, 2)
assert E.entry(spark).count() > 0
assert E.queries()["overview"](spark, {SF["0.001"]!r}).count() == 1
"""


def run(cwd, before="", after=""):
    subprocess.run([sys.executable, "-c", CODE.format(before=before, after=after)], cwd=cwd,
                   check=True, timeout=300, env=os.environ | {"PYTHONPATH": str(cwd)})


def test_without_the_subpackage(tmp_path):
    for name in ("ledgerlens", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name,
                            ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    run(tmp_path, after=RUN)
    # a pipeline without its operators is left out too
    (tmp_path / "corpus_pipeline.py").write_text("from ledgerlens.llm import near_dup\n")
    run(tmp_path)


@pytest.mark.parametrize("missing", ["public_tokenizers", "xxhash"])
def test_without_its_packages(missing):
    run(ROOT, before=f"sys.modules[{missing!r}] = None")
