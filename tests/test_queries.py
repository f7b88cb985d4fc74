import importlib.util
from pathlib import Path

import pytest

from workloads.checks import CHECKS
from workloads.compare import check_connection, compare
from workloads.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def connection():
    return check_connection(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_check(spark, connection, name):
    assert compare(spark, SF_DIR, name, connection) == ""


def test_entry(spark):
    path = Path(__file__).resolve().parents[1] / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() > 0
    assert set(module.oracle_sql()) <= set(module.queries())
