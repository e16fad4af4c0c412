import pytest

from ledgerflow.plans.registry import ORACLE_SQL, QUERIES
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == {"qm_02"} and set(ORACLE_SQL) <= set(QUERIES)  # files and sizes are no matter of SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF)


def test_entry(spark):
    import __spark_entry__ as e

    rows = e.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"orderStatus", "order_count", "total_amount", "avg_amount"}
    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_size_report(spark):
    r = QUERIES["qm_02"](spark, SF).first()
    assert r["number_of_files"] > 0 and r["size_mb"] > 0 and r["avg_file_size_mb"] == r["number_of_files"] / max(1, r["size_mb"] / 128)
