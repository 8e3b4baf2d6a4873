"""The entry point without the optional part, and tables that follow their inputs."""

import os
import shutil
import subprocess
import sys
import tempfile

import pyarrow.parquet as pq

from tessera.plans.registry import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def _names(root, code=""):
    out = subprocess.run([sys.executable, "-c", code + "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), len(e.oracle_sql()))"],
                         cwd=root, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def test_entry_without_the_text_operators():
    own = str(len(QUERIES))
    copy = tempfile.mkdtemp(prefix="tessera-entry-")
    shutil.copytree(f"{ROOT}/tessera", f"{copy}/tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", copy)
    os.makedirs(f"{copy}/tessera/llm/__pycache__")  # a leftover folder is no package
    assert _names(copy)[:2] == [own, "False"]
    # the operators are there, but something that they import is not
    assert _names(ROOT, "import sys; sys.modules['xxhash'] = None; ")[:2] == [own, "False"]


def test_employee_table_follows_its_input(spark):
    copy = tempfile.mkdtemp(prefix="tessera-input-")
    for t in ("customer", "nation", "region"):
        shutil.copy(f"{SF}/{t}.parquet", copy)
    before = QUERIES["group_share"](spark, copy).agg({"n": "sum"}).first()[0]
    whole = pq.read_table(f"{copy}/customer.parquet")
    pq.write_table(whole.slice(0, 20), f"{copy}/customer.parquet")
    after = QUERIES["group_share"](spark, copy).agg({"n": "sum"}).first()[0]
    assert before > 100 and 15 <= after <= 20
