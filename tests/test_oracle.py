"""Every registered key with an oracle matches DuckDB exactly (sf0.001)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import check

ORACLE = entry.oracle_sql()


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_key_matches_oracle(spark, duck, key):
    res = check(spark, duck, key, entry.queries()[key], ORACLE[key], SF_SMALL)
    assert res["status"] == "ok", res


def test_every_key_has_builder():
    assert set(ORACLE) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "season_rank" in df.columns
