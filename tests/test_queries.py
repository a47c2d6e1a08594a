"""Every registered query against its SQL, on whole tables of the smallest scale."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from moodmill.plans.queries import QUERIES
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, small, name):
    verdict, _, _ = compare(con, spark, small, name)
    assert verdict.startswith(("ok", "rows only")), verdict


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_is_a_confusion_matrix(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "predicted_0", "predicted_1", "predicted_2"]
    assert df.count() == 3


@pytest.mark.parametrize("hidden", ["xxhash", "tokenizers", "moodmill.llm"])
def test_core_queries_without_what_only_training_data_needs(hidden):
    code = f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = Path(entry.__file__).parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(QUERIES))], done.stderr[-500:]
