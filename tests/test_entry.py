import importlib
import sys

import pytest

import __spark_entry__ as entry
from compare import connect, rows_of_spark, rows_of_sql
from frameloom.plans import catalogue, oracles


@pytest.fixture(scope="module")
def sql(data):
    return connect(data)


def test_keys():
    assert set(oracles.oracle_sql()) <= set(catalogue.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(oracles.oracle_sql()))
def test_matches_sql(spark, data, sql, name):
    assert rows_of_spark(catalogue.queries()[name](spark, data)) == rows_of_sql(sql, oracles.oracle_sql()[name])


@pytest.mark.parametrize("name", [n for n in catalogue.queries() if n not in oracles.oracle_sql()])
def test_runs(spark, data, name):
    assert catalogue.queries()[name](spark, data).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["lang", "part", "n"]


def test_runs_without_the_training_data_part(monkeypatch):
    real = importlib.import_module

    def absent(name, *a):
        if ".llm" in name:
            raise ModuleNotFoundError(name, name="frameloom.llm")
        return real(name, *a)

    monkeypatch.setattr(importlib, "import_module", absent)
    assert set(entry.queries()) == set(catalogue.queries()) and set(entry.oracle_sql()) == set(oracles.oracle_sql())


def test_other_missing_modules_are_errors(monkeypatch):
    def absent(name, *a):
        raise ModuleNotFoundError(name, name="zstandard")

    monkeypatch.setattr(importlib, "import_module", absent)
    with pytest.raises(ModuleNotFoundError):
        entry.queries()


def test_nothing_else_imports_that_part():
    import pathlib
    import re

    root = pathlib.Path(entry.__file__).parent / "frameloom"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
    assert "frameloom" in sys.modules


def test_workers_need_no_path(data, tmp_path):
    """Queries run from any folder, without PYTHONPATH: the package is sent to the Python workers."""
    import os
    import pathlib
    import subprocess

    repo = str(pathlib.Path(entry.__file__).parent)
    code = f"import sys; sys.path.insert(0, {repo!r}); import __spark_entry__ as e; from frameloom.session import local_session; print('rows', e.queries()['predicted_stub'](local_session('x', '2', 2), {data!r}).count())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in said.stdout, said.stderr[-2000:]


@pytest.mark.parametrize("name", ["seeded_topk", "quota_by_source", "unique_first_topk", "round_robin_kept", "global_order", "media_manifest", "check_report_of_broken_rows", "window_variants"])
def test_partitions_do_not_matter(spark, data, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = []
        for n in ("1", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(rows_of_spark(catalogue.queries()[name](spark, data)))
        assert got[0] == got[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
