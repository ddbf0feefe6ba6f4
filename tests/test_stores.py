"""Stores read as of any place against a replay of their deltas, and runs that keep them over batches."""

import random

import pytest
from pyspark.sql import functions as F

from chainloom.contracts import contract
from chainloom.functions.typed import field, value
from chainloom.operators.blocks import change
from chainloom.operators.stores import StoreReader, read_store, store_values
from chainloom.plans.ingest import IngestJob, MapModule, StoreModule, run_batch
from chainloom.streaming.store import BatchStore

SHAPE = "block_num long, ordinal long, pos int, key string, value long"


def deltas(seed):
    rng = random.Random(seed)
    rows = {}
    for _ in range(160):
        place = (rng.randint(1, 8), rng.randint(0, 9), rng.randint(0, 2))
        key = rng.choice(["hot", "hot", "hot", "a", "b", None])
        rows[(*place, key)] = rng.choice([None, *range(-5, 6)])
    return [(*k, v) for k, v in rows.items()]


def step(policy, before, new):
    if policy == "set":
        return new
    if new is None or before is None:
        return before if new is None else new
    return {"set_if_not_exists": before, "add": before + new, "min": min(before, new), "max": max(before, new)}[policy]


def replay(rows, policy, key, stop):
    """The value of a key after the deltas for whose place `stop` is false."""
    out = None
    for row in sorted(rows, key=lambda r: r[:3]):
        if row[3] == key and not stop(row[:3]):
            out = step(policy, out, row[4])
    return out


STOPS = {
    "first": lambda own: lambda place: place[0] >= own[0],
    "before": lambda own: lambda place: place >= own,
    "at": lambda own: lambda place: place[:2] > own[:2],
    "last": lambda own: lambda place: place[0] > own[0],
}


@pytest.mark.parametrize("limit", [1_000_000, 5])
@pytest.mark.parametrize("policy", ["set", "set_if_not_exists", "add", "min", "max"])
def test_reads_are_a_replay(spark, policy, limit):
    rows = deltas(3)
    frame = spark.createDataFrame(rows, SHAPE)
    readers = frame.drop("value").withColumn("note", F.lit("kept"))
    for at, stop in STOPS.items():
        got = read_store(readers, frame, "key", at=at, policy=policy, limit=limit).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["value"] == replay(rows, policy, r["key"], stop((r["block_num"], r["ordinal"], r["pos"]))) and r["note"] == "kept"
    last = {r["key"]: r["value"] for r in store_values(frame, policy).collect()}
    want = {k: replay(rows, policy, k, lambda place: False) for k in {r[3] for r in rows}}
    assert last == {k: v for k, v in want.items() if v is not None}


def test_unknown_policy_and_empty_store(spark):
    with pytest.raises(ValueError, match="unknown policy"):
        StoreModule("s", lambda blocks: blocks, "append")
    frame = spark.createDataFrame(deltas(1), SHAPE)
    rows = StoreReader(frame.limit(0)).get_last(frame.drop("value"), "key")
    assert rows.count() == frame.count() and rows.filter("value is not null").count() == 0


TOTALS = contract("totals", "id text, total bigint, seen bigint", "id")


def totals(blocks, stores):
    """Per block and key: the sum before the block and after it."""
    rows = blocks.filter("key is not null").groupBy("block_num", "key").agg(F.lit(0).alias("pos"))
    read = stores["sum"].get_last(stores["sum"].get_first(rows, "key", "seen"), "key", "total")
    name = F.concat_ws(":", "key", "block_num")
    fields = [field(c, value(int64=F.coalesce(c, F.lit(0)))) for c in ("total", "seen")]
    return read.select("block_num", "pos", change("totals", name, F.lit(0), fields).alias("c")).select("block_num", "pos", "c.*")


def test_store_is_kept_over_batches(spark, tmp_path):
    rows = [r for r in deltas(7) if r[4] is not None]
    frame = spark.createDataFrame(rows, SHAPE).withColumns({"block_id": F.lit("i"), "cursor": F.lit("c")})
    module = MapModule(totals, (StoreModule("sum", lambda blocks: blocks.select("block_num", "ordinal", "pos", "key", "value"), "add"),))
    tables = []
    for cuts in ((0, 99), (0, 3, 6, 99)):
        store = BatchStore(spark, str(tmp_path / f"store{len(cuts)}"))
        job = IngestJob("totals", module, [TOTALS], mode="changes", algo="sha256")
        for low, high in zip(cuts, cuts[1:]):
            run_batch(job, store, frame.filter(F.col("block_num").between(low, high - 1)))
        tables.append(sorted(map(tuple, store.folded(TOTALS).collect())))
    assert tables[0] == tables[1]
    for name, total, seen in tables[0]:
        key, block = name.split(":")
        assert total == replay(rows, "add", key, lambda place: place[0] > int(block))
        assert seen == (replay(rows, "add", key, lambda place: place[0] >= int(block)) or 0)
