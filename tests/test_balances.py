import pytest
from pyspark.sql import functions as F

from chainloom.operators import balances

SHAPE = "block_num long, end_ordinal long, pos int, address binary, new_value binary"
ROWS = [
    (1, 10, 0, b"\xaa", b"\x05"),
    (1, 11, 0, b"\xaa", b"\x01\x00"),
    (2, 20, 0, b"\xbb", None),
    (2, 20, 1, b"\xbb", b"\xff" * 32),
    (3, 30, 0, b"\xaa", None),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([tuple(map(lambda v: bytearray(v) if isinstance(v, bytes) else v, r)) for r in ROWS], SHAPE)


def test_latest(rows):
    got = {r["key"]: r["balance"] for r in balances.balance_latest(rows).collect()}
    assert got == {"Address:aa": "0", "Address:bb": str(2**256 - 1)}


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_changes(rows, limit):
    got = {
        (r["ordinal"], r["pos"]): (r["type"], r["value"])
        for r in balances.balance_changes(rows, limit=limit).collect()
    }
    assert got == {
        (10, 0): ("Insert", '{"account":"aa","balance":"5"}'),
        (11, 0): ("Insert", '{"account":"aa","balance":"256"}'),
        (20, 0): ("Insert", '{"account":"bb","balance":"0"}'),
        (20, 1): ("Insert", '{"account":"bb","balance":"%d"}' % (2**256 - 1)),
        (30, 0): ("Update", '{"account":"aa","balance":"0"}'),
    }


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_changes_without_an_address_or_block_stay(rows, limit):
    odd = rows.withColumn("address", F.when(F.col("pos") == 0, F.col("address"))).unionByName(
        rows.withColumns({"address": F.lit(None).cast("binary"), "block_num": F.lit(None).cast("long")})
    )
    got = balances.balance_changes(odd, limit=limit)
    assert got.count() == odd.count() == 10
    assert sorted(r["type"] for r in got.filter("key is null").collect()) == ["Insert"] + ["Update"] * 5
    known = balances.first_blocks(odd)
    again = balances.balance_changes(odd, known, limit=limit)
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_batches_give_what_the_whole_gives(rows):
    early, late = rows.filter("block_num < 3"), rows.filter("block_num >= 3")
    known = balances.first_blocks(early)
    parts = balances.balance_changes(early).unionByName(balances.balance_changes(late, known))
    whole = balances.balance_changes(rows)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    assert whole.filter(F.col("type") == "Update").count() == 1
