import os

import pytest

from __spark_entry__ import entry
from tapeworks.catalog import ORACLES, QUERIES
from tests.compare import database, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_check_belongs_to_a_query():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).columns == ["exchange", "instrument_type", "trade_flag_canonical",
                                    "trades", "notional"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, name):
    assert differences(spark, database(SF_DIR), name, SF_DIR) == []


def test_hash_dedupe_moves_only_what_is_used(spark):
    plan = QUERIES["q_dedupe_hash"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" in plan and "source_file" not in plan
