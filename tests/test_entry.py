"""The entry module with and without the optional parts."""

import os
import subprocess
import sys
import warnings
from pathlib import Path
from types import SimpleNamespace

import pytest

from barmill.plans import catalog, oracle
from barmill.sources import tables

ROOT = Path(__file__).resolve().parent.parent


def test_entry_works_without_the_optional_parts(tmp_path):
    (tmp_path / "barmill").mkdir()
    for part in (ROOT / "barmill").iterdir():
        if part.name != "llm":
            (tmp_path / "barmill" / part.name).symlink_to(part)
    (tmp_path / "__spark_entry__.py").write_bytes((ROOT / "__spark_entry__.py").read_bytes())
    code = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True).stdout
    queries, sql = (part.split() for part in said.strip().splitlines()[-1].split("|"))
    assert queries == sorted(catalog.QUERIES) and sql == sorted(oracle.ORACLES)


@pytest.mark.parametrize("master, folder, warned", [("local[2]", "/x", 0), ("spark://h:1", "/x", 1), ("spark://h:1", "hdfs://n/x", 0), ("yarn", "file:/x", 1)])
def test_a_local_folder_on_a_cluster_is_warned_of(master, folder, warned):
    conf = {"spark.checkpoint.dir": folder}
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=SimpleNamespace(master=master))
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        assert tables.shared_folder(spark) == folder
    assert len(said) == warned
