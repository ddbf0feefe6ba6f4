"""Every registered query against its SQL on the smallest tables."""

import hashlib

import pytest

import __spark_entry__
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES = __spark_entry__.queries()
ORACLE = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_query_equals_sql(spark, database, name):
    assert differences(QUERIES[name](spark, SF_DIR), database, ORACLE[name]) == []


def test_blake2s_keys(spark):
    rows = QUERIES["derive_row_key_blake2s"](spark, SF_DIR).collect()
    ids = {
        r["event_id"]: r["user_id"] for r in spark.read.parquet(f"{SF_DIR}/events.parquet").collect()
    }
    assert len(rows) == len(ids)
    for row in rows:
        label = f"bin.node.cli.PRIMARY_KEY_INSERT_INTO<{ids[row['ordinal']]}_{row['ordinal']}>"
        assert row["row_key"] == hashlib.blake2s(label.encode()).hexdigest()


def test_entry(spark):
    frame = __spark_entry__.entry(spark)
    assert frame.columns == ["id", "number", "hash", "parent_hash", "timestamp"]
    assert frame.count() == 1500


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
