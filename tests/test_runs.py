"""Stores, ingest runs and streams: what is committed, and what a second try does."""

import datetime as dt
import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from chainloom.contracts import (
    CHANGE,
    CREATE,
    DELETE,
    ETH_BLOCKHEADERS,
    ETH_EVENTS,
    LENS_POSTS_OFFCHAIN,
    UPDATE,
    ContractError,
    contract,
)
from chainloom.functions.posts_json import RECORDS
from chainloom.functions.typed import field, offchain_request, value
from chainloom.operators import balances, links, progress
from chainloom.operators.blocks import change
from chainloom.operators.changes import RejectedRecords
from chainloom.operators.keyed import DuplicateKey
from chainloom.plans import catalog
from chainloom.plans.ingest import (
    BALANCE_CHANGES,
    REJECTS,
    Enrichment,
    IngestJob,
    current_balances,
    current_tasks,
    next_due,
    open_tasks,
    process_batch,
    resolve_all,
    resolve_batch,
    run_batch,
)
from chainloom.sources.blocks import block_range_scan, check_range, final_blocks, read_blocks, spread, stream_blocks, write_blocks
from chainloom.streaming.blooms import bloom_rows, key_hash, may_hold
from chainloom.streaming.runs import run_stream, stream_balances
from chainloom.streaming.store import BatchStore

POINTS = contract("points", "id text, n integer", "id")
BLOCKS = "block_num long, block_id string, cursor string, n long, op int"


def blocks_frame(spark, numbers, op=CREATE):
    return spark.createDataFrame([(b, f"h{b}", f"c{b}", b % 3, op) for b in numbers], BLOCKS)


def to_points(blocks):
    """One record per block; blocks whose number ends in 5 have none."""
    record = change(
        "points", F.col("n").cast("string"), F.col("block_num"), [field("n", value(int64=F.col("n")))], F.col("op")
    )
    full = blocks.filter(F.col("block_num") % 10 != 5)
    return full.select("block_num", F.lit(0).alias("pos"), record.alias("c")).select("block_num", "pos", "c.*")


JOB = IngestJob("points", to_points, [POINTS], algo="sha256")


def write_files(spark, folder, *ranges):
    for i, numbers in enumerate(ranges):
        blocks_frame(spark, numbers).coalesce(1).write.mode("append").parquet(f"{folder}/part={i}")


def stream(spark, folder, **options):
    return stream_blocks(spark, f"{folder}/*", blocks_frame(spark, []).schema, files_per_batch=1, **options)


def points(store):
    return sorted(r["id"] for r in store.rows(POINTS).collect())


def cursor(store):
    row = store.progress().first()
    return None if row is None else tuple(row)


def test_ranges(spark):
    frame = blocks_frame(spark, range(10))
    numbers = lambda f: sorted(r["block_num"] for r in f.collect())
    assert numbers(block_range_scan(frame, 3, 5)) == [3, 4]
    assert numbers(block_range_scan(frame, 8, None)) == numbers(block_range_scan(frame, 8, 0)) == [8, 9]
    assert numbers(final_blocks(frame, 4)) == list(range(6))
    assert numbers(final_blocks(frame, 4, head=5)) == [0, 1]
    assert numbers(final_blocks(frame.withColumn("f", F.col("n") == 1), 0, flag="f")) == [1, 4, 7]
    for bad in ((-1, 5), (0, 0), (5, 5)):
        with pytest.raises(ValueError):
            check_range(*bad)


def test_range_reaches_the_scan(spark, tmp_path):
    blocks_frame(spark, range(100)).write.parquet(str(tmp_path / "b"))
    ranged = read_blocks(spark, str(tmp_path / "b"), 10, 20, columns=["block_num", "cursor"])
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(block_num,10), LessThan(block_num,20)" in plan
    assert "ReadSchema: struct<block_num:bigint,cursor:string>" in plan
    assert ranged.count() == 10


def test_range_opens_only_its_buckets(spark, tmp_path):
    frame = blocks_frame(spark, range(0, 100)).unionByName(blocks_frame(spark, [0]).withColumn("block_num", F.lit(None).cast("long")))
    write_blocks(frame, str(tmp_path / "b"), 16)
    assert len(list((tmp_path / "b").glob("bucket=*"))) == 8
    for start, stop in ((0, 0), (16, 32), (15, 33), (40, 0), (99, 100), (500, 0)):
        if start == stop == 0:
            got = read_blocks(spark, str(tmp_path / "b"), 0, None, width=16)
        else:
            got = read_blocks(spark, str(tmp_path / "b"), start, stop, width=16)
        last = stop or 100
        assert sorted(r["block_num"] for r in got.collect()) == list(range(start, last))
        assert got.columns == frame.columns
    some = read_blocks(spark, str(tmp_path / "b"), 16, 32, width=16)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "(bucket" in plan
    assert {r[0].split("bucket=")[1].split("/")[0] for r in some.select(F.input_file_name()).distinct().collect()} == {"1"}
    with pytest.raises(ValueError):
        write_blocks(frame, str(tmp_path / "c"), 0)


def test_key_check_opens_only_batches_that_may_have_the_keys(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    frame = lambda keys: spark.createDataFrame([(str(k), k) for k in keys], "id string, n int")
    for batch in range(6):
        store.commit({"points": frame(range(batch * 50, batch * 50 + 50))}, None, "s", batch, {"points": POINTS.keys} if batch else None)
    # The first batch was written without filters, and so is always read.
    for keys, batches in (([60, 61], {0, 1}), ([7], {0}), ([110, 299], {0, 2, 5}), ([1000, -1], {0}), ([], {0})):
        near = store.rows_near(POINTS, frame(keys))
        assert {r["n"] // 50 for r in near.collect()} == batches
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(batch" in plan and re.search(r"batch#\d+L < 1\)", plan)
        asked = {str(k) for k in keys}
        own = {r["id"] for r in near.collect()}
        assert own & asked == {r["id"] for r in store.rows(POINTS).collect()} & asked
    nulls = frame([1]).withColumn("id", F.lit(None).cast("string"))
    assert store.rows_near(POINTS, nulls).count() == 50


def test_filters_have_no_false_negatives(spark):
    keys = spark.range(30_000).select(F.col("id").cast("string"))
    blooms = bloom_rows(keys.repartition(3), ["id"]).withColumn("batch", F.spark_partition_id().cast("long"))
    hashes = [r[0] for r in keys.select(key_hash(["id"])).collect()]
    assert all(may_hold(blooms, hashes[at : at + 1]) for at in range(0, 30_000, 1500))
    others = [r[0] for r in spark.range(10**6, 10**6 + 2000).select(key_hash(["id"])).collect()]
    assert len(may_hold(blooms, others)) <= 1


def test_cursor_steps(spark):
    shape = "id string, cursor string, block_num long, block_id string"
    def upsert(stored, *row):
        return progress.cursor_upsert(stored, spark.createDataFrame([row], shape))

    one = upsert(None, "0x1", "cursor1", 0, "id1")
    assert progress.get_cursor(one, "0x1", 9) == ("cursor1", 0, "id1")
    two = upsert(one, "0x1", "cursor12", 1, "id2")
    assert [tuple(r) for r in two.collect()] == [("0x1", "cursor12", 1, "id2")]
    assert progress.get_cursor(two, "0x2", 9) == ("", 9, "9")
    with pytest.raises(ValueError):
        progress.get_cursor(two, "0x2", -1)


def test_stream_gives_what_batch_gives(spark, tmp_path):
    write_files(spark, tmp_path / "in", range(0, 20), range(20, 30), range(30, 57))
    streamed = BatchStore(spark, str(tmp_path / "stream"))
    run_stream(JOB, streamed, stream(spark, tmp_path / "in"), str(tmp_path / "check"))
    batch = BatchStore(spark, str(tmp_path / "batch"))
    run_batch(JOB, batch, blocks_frame(spark, range(57)))
    assert streamed.last_batch() == 2 and batch.last_batch() == 0
    assert points(streamed) == points(batch) and len(points(batch)) == 51
    assert cursor(streamed) == cursor(batch) == ("points", "c56", 56, "h56")


def test_files_out_of_order(spark, tmp_path):
    write_files(spark, tmp_path / "in", range(20, 30), range(0, 10), range(10, 20))
    store = BatchStore(spark, str(tmp_path / "s"))
    run_stream(JOB, store, stream(spark, tmp_path / "in"), str(tmp_path / "check"))
    assert len(points(store)) == 27 and cursor(store)[2] == 29


def test_range_of_a_job(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    run_batch(IngestJob("points", to_points, [POINTS], start=10, stop=20), store, blocks_frame(spark, range(57)))
    assert len(points(store)) == 9 and cursor(store)[2] == 19


def test_empty_batch_moves_the_cursor(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    run_batch(JOB, store, blocks_frame(spark, [5]))
    assert points(store) == [] and cursor(store) == ("points", "c5", 5, "h5")


class Killed(Exception):
    pass


class DyingStore(BatchStore):
    """Stops once between writing the rows and marking the batch."""

    deaths = 1

    def mark(self, batch, source, epoch, cursors):
        if batch == 1 and DyingStore.deaths:
            DyingStore.deaths -= 1
            raise Killed("between rows and marker")
        super().mark(batch, source, epoch, cursors)


def test_killed_between_rows_and_marker(spark, tmp_path):
    write_files(spark, tmp_path / "in", range(0, 10), range(10, 20), range(20, 30))
    root, check = str(tmp_path / "s"), str(tmp_path / "check")
    DyingStore.deaths = 1
    with pytest.raises(Exception, match="between rows and marker"):
        run_stream(JOB, DyingStore(spark, root), stream(spark, tmp_path / "in"), check)
    after = BatchStore(spark, root)
    assert len(points(after)) == 9 and cursor(after)[2] == 9
    run_stream(JOB, BatchStore(spark, root), stream(spark, tmp_path / "in"), check)
    again = BatchStore(spark, root)
    assert len(points(again)) == len(set(points(again))) == 27 and cursor(again)[2] == 29


def test_lost_checkpoint(spark, tmp_path):
    write_files(spark, tmp_path / "in", range(0, 10), range(10, 20))
    root = str(tmp_path / "s")
    run_stream(JOB, BatchStore(spark, root), stream(spark, tmp_path / "in"), str(tmp_path / "c1"))
    write_files(spark, tmp_path / "more", range(20, 30))
    run_stream(JOB, BatchStore(spark, root), stream(spark, tmp_path / "in"), str(tmp_path / "c2"))
    run_stream(JOB, BatchStore(spark, root), stream(spark, tmp_path / "more"), str(tmp_path / "c3"))
    store = BatchStore(spark, root)
    assert len(points(store)) == len(set(points(store))) == 27


def test_committed_batch_is_not_done_again(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    process_batch(JOB, store, blocks_frame(spark, range(3)), "src", 0)
    process_batch(JOB, store, blocks_frame(spark, range(3, 6)), "src", 0)
    assert store.last_batch() == 0 and len(points(store)) == 3


def same_key(blocks):
    return to_points(blocks).withColumn("ordinal", F.lit(0).cast("long"))


def test_duplicate_keys_in_a_run(spark, tmp_path):
    strict = BatchStore(spark, str(tmp_path / "strict"))
    job = IngestJob("points", same_key, [POINTS])
    with pytest.raises(DuplicateKey):
        run_batch(job, strict, blocks_frame(spark, range(10)))
    assert strict.last_batch() == -1 and cursor(strict) is None
    lenient = BatchStore(spark, str(tmp_path / "lenient"))
    job = IngestJob("points", same_key, [POINTS], strict=False, on_duplicate="reject", on_conflict="reject")
    run_batch(job, lenient, blocks_frame(spark, range(10)))
    run_batch(job, lenient, blocks_frame(spark, range(10, 20)))
    assert len(points(lenient)) == 3
    rejects = lenient.read("rejects", spark.read.parquet(f"{lenient.root}/rejects").drop("batch").schema)
    counts = {r["reject_reason"]: r["count"] for r in rejects.groupBy("reject_reason").count().collect()}
    assert counts == {"duplicate_key": 12, "key_exists": 3}


def test_strict_run_refuses_updates(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    with pytest.raises(RejectedRecords, match="unsupported_operation"):
        run_batch(JOB, store, blocks_frame(spark, range(3), UPDATE))
    assert store.last_batch() == -1


def test_changes_mode(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    job = IngestJob("points", to_points, [POINTS], mode="changes")
    run_batch(job, store, blocks_frame(spark, [0, 1]))
    run_batch(job, store, blocks_frame(spark, [2, 3]).withColumn("op", F.when(F.col("n") == 0, DELETE).otherwise(CREATE)))
    assert sorted(r["id"] for r in store.folded(POINTS).collect()) == ["1", "2"]


def test_creates_on_a_live_key(spark, tmp_path):
    """Keys of blocks are n = block % 3: in one batch, after a version, and after a delete."""
    strict = BatchStore(spark, str(tmp_path / "strict"))
    job = IngestJob("points", to_points, [POINTS], mode="changes")
    with pytest.raises(DuplicateKey):
        run_batch(job, strict, blocks_frame(spark, [0, 3]))
    run_batch(job, strict, blocks_frame(spark, [0, 1]))
    with pytest.raises(DuplicateKey):
        run_batch(job, strict, blocks_frame(spark, [3]))
    assert strict.last_batch() == 0

    store = BatchStore(spark, str(tmp_path / "s"))
    job = IngestJob("points", to_points, [POINTS], mode="changes", strict=False, on_conflict="reject")
    run_batch(job, store, blocks_frame(spark, [0, 1, 3]))
    store.compact(POINTS)
    run_batch(job, store, blocks_frame(spark, [4]).unionByName(blocks_frame(spark, [6], DELETE)).unionByName(blocks_frame(spark, [9])))
    rejected = [(r["block_num"], r["reject_reason"]) for r in store.read("rejects", REJECTS).collect()]
    assert sorted(rejected) == [(3, "key_exists"), (4, "key_exists")]
    again = BatchStore(spark, str(tmp_path / "s"))
    assert sorted(tuple(r) for r in again.folded(POINTS).collect()) == [("0", 0), ("1", 1)]
    run_batch(job, again, blocks_frame(spark, [12, 13], DELETE))
    again.compact(POINTS)
    assert BatchStore(spark, str(tmp_path / "s")).folded(POINTS).count() == 0


def test_null_key_of_a_change(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    no_id = lambda blocks: to_points(blocks).withColumn("id", F.lit(None).cast("string"))
    job = IngestJob("points", no_id, [POINTS], mode="changes", strict=False)
    run_batch(job, store, blocks_frame(spark, [0, 1]))
    assert store.folded(POINTS).count() == 0 and store.read("rejects", REJECTS).count() == 2


def test_stored_table_is_checked(spark, tmp_path):
    run_batch(JOB, BatchStore(spark, str(tmp_path / "s")), blocks_frame(spark, range(3)))
    renamed = contract("points", "id text, m integer", "id")
    with pytest.raises(ContractError):
        BatchStore(spark, str(tmp_path / "s")).rows(renamed)
    assert BatchStore(spark, str(tmp_path / "s")).rows(POINTS).count() == 3


def test_retries_go_on_by_themselves(spark, tmp_path):
    """Content that never comes: one retry after a minute, and no more."""
    noon, waits = dt.datetime(2024, 1, 1, 12), []
    store = BatchStore(spark, str(tmp_path / "s"))
    job = IngestJob("linked", with_links, [LINKED], enrichment=enrichment(spark, 0))
    run_batch(job, store, blocks_frame(spark, range(3)), noon)
    resolve_all(
        job.enrichment, store, "retries", clock=lambda: noon + dt.timedelta(seconds=sum(waits)), wait=waits.append
    )
    assert waits == [60.0]
    assert states(store) == {"ar://p0": (6, 0), "ar://p1": (3, 1), "ar://p2": (3, 1)}


def test_job_is_checked():
    with pytest.raises(ContractError):
        IngestJob("points", to_points, [])
    with pytest.raises(ValueError):
        IngestJob("points", to_points, [POINTS], start=0, stop=0)


LINKED = contract("linked", "id text, link text", "id")


def with_links(blocks):
    uri = F.concat(F.lit("ar://p"), F.col("n").cast("string"))
    record = change(
        "linked", F.col("block_num").cast("string"), F.lit(0), [field("link", value(offchaindata=offchain_request(uri, "go", 1, 60)))]
    )
    return blocks.select("block_num", F.lit(0).alias("pos"), record.alias("c")).select("block_num", "pos", "c.*")


def to_post(content, uri):
    text = lambda c: value(string=c)
    fields = F.array(
        field("uri", text(uri)), field("app_id", text(F.lit("a"))), field("name", text(content)), field("content", text(content))
    )
    return F.array(F.struct(F.lit("lens_posts_offchain").alias("record"), fields.alias("fields"))).cast(RECORDS)


def enrichment(spark, *content):
    frame = spark.createDataFrame([(f"ar://p{n}", f"text {n}") for n in content], "uri string, content string")
    return Enrichment("demo", {"go": to_post}, [LENS_POSTS_OFFCHAIN], content=lambda: frame)


def states(store):
    return {r["uri"]: (r["state"], r["num_retries"]) for r in current_tasks(store).collect()}


def test_links_of_a_run(spark, tmp_path):
    """Known links are not queued again, a missing content is retried when due, then given up."""
    noon = dt.datetime(2024, 1, 1, 12)
    store = BatchStore(spark, str(tmp_path / "s"))
    job = IngestJob("linked", with_links, [LINKED], enrichment=enrichment(spark, 0, 1))
    run_batch(job, store, blocks_frame(spark, range(9)), noon)
    assert store.rows(LINKED).count() == 9
    assert states(store) == {"ar://p0": (6, 0), "ar://p1": (6, 0), "ar://p2": (0, 1)}
    run_batch_links = lambda epoch, now, *content: resolve_batch(enrichment(spark, *content), store, "again", epoch, now)
    run_batch_links(0, noon + dt.timedelta(seconds=59), 2)
    assert states(store)["ar://p2"] == (0, 1)
    run_batch_links(1, noon + dt.timedelta(seconds=60))
    assert states(store)["ar://p2"] == (3, 1)
    assert sorted(r["name"] for r in store.rows(LENS_POSTS_OFFCHAIN).collect()) == ["text 0", "text 1"]


def test_stream_with_links(spark, tmp_path):
    write_files(spark, tmp_path / "in", range(0, 2), range(2, 9))
    store = BatchStore(spark, str(tmp_path / "s"))
    job = IngestJob("linked", with_links, [LINKED], enrichment=enrichment(spark, 0, 1, 2))
    run_stream(job, store, stream(spark, tmp_path / "in"), str(tmp_path / "check"))
    assert states(store) == {f"ar://p{n}": (links.FINISHED, 0) for n in range(3)}
    assert store.rows(LENS_POSTS_OFFCHAIN).count() == 3


def test_retries_of_a_quiet_stream_wake_by_themselves(spark, tmp_path):
    """Blocks have ended long before the retry is due; nobody calls anything."""
    write_files(spark, tmp_path / "in", range(0, 4))
    passed = [dt.datetime(2024, 1, 1, 12)]

    def clock():
        passed[0] += dt.timedelta(seconds=25)
        return passed[0]

    store = BatchStore(spark, str(tmp_path / "s"))
    job = IngestJob("linked", with_links, [LINKED], enrichment=enrichment(spark, 0, 1))
    arriving = stream(spark, tmp_path / "in")
    run_stream(job, store, arriving, str(tmp_path / "check"), retries="500 milliseconds", clock=clock, now=passed[0])
    assert states(store) == {"ar://p0": (6, 0), "ar://p1": (6, 0), "ar://p2": (3, 1)}
    assert open_tasks(store).count() == 0
    assert not spark.streams.active


def test_open_tasks_are_those_that_the_log_leaves_queued(spark, tmp_path):
    noon = dt.datetime(2024, 1, 1, 12)
    store = BatchStore(spark, str(tmp_path / "s"))
    job = IngestJob("linked", with_links, [LINKED], enrichment=enrichment(spark, 0))
    for step in range(3):
        run_batch(job, store, blocks_frame(spark, range(step, step + 1)), noon + dt.timedelta(seconds=step))
        folded = links.queued_tasks(current_tasks(store)).select("uri", "num_retries", "due_at").collect()
        assert sorted(map(tuple, folded)) == sorted(map(tuple, open_tasks(store).select("uri", "num_retries", "due_at").collect()))
    assert next_due(BatchStore(spark, str(tmp_path / "s"))) == next_due(store) is not None


BALANCES = "block_num long, end_ordinal long, pos int, address binary, new_value binary"


def test_balances_in_batches(spark, tmp_path):
    data = [(b, b * 10, 0, bytearray([b % 4]), bytearray([b])) for b in range(20)]
    frame = spark.createDataFrame(data, BALANCES)
    for i, part in enumerate(("block_num < 3", "block_num >= 3 and block_num < 9", "block_num >= 9")):
        frame.filter(part).coalesce(1).write.parquet(f"{tmp_path}/in/part={i}")
    store = BatchStore(spark, str(tmp_path / "s"))
    source = stream_blocks(spark, f"{tmp_path}/in/*", frame.schema, files_per_batch=1)
    stream_balances(store, source, str(tmp_path / "check")).awaitTermination()
    assert store.last_batch() == 2
    got = store.read("balance_changes", BALANCE_CHANGES).drop("batch")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, balances.balance_changes(frame).collect()))
    latest = sorted(map(tuple, current_balances(store).collect()))
    assert latest == sorted(map(tuple, balances.balance_latest(frame).collect()))


def test_state_of_addresses_over_batches(spark, tmp_path):
    """Rows of a batch in any order, a block that two batches share, and no address at all."""
    rows = [(b, 100 - b, p, None if b % 5 == 0 else bytearray([b % 3]), bytearray([b])) for b in range(1, 30) for p in (0, 1)]
    frame = spark.createDataFrame(rows, BALANCES)
    for i, part in enumerate(("block_num <= 7 and pos = 0 or block_num < 7", "block_num = 7 and pos = 1 or block_num between 8 and 20", "block_num > 20")):
        frame.filter(part).orderBy(F.rand(3)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/part={i}")
    store = BatchStore(spark, str(tmp_path / "s"))
    source = stream_blocks(spark, f"{tmp_path}/in/*", frame.schema, files_per_batch=1)
    stream_balances(store, source, str(tmp_path / "check")).awaitTermination()
    got = store.read("balance_changes", BALANCE_CHANGES).drop("batch")
    assert sorted(map(str, got.collect())) == sorted(map(str, balances.balance_changes(frame).collect()))


def test_json_blocks_with_nested_changes(spark, tmp_path):
    one = {"record": "points", "id": "a", "ordinal": 1, "operation": 1}
    fields = [{"name": "n", "new_value": {"int64": 4}}, {"name": "n", "new_value": {"uint32": 5}}]
    lines = [
        {"block_num": 1, "block_id": "h1", "cursor": "c1", "record_changes": [{**one, "fields": fields}]},
        {"block_num": 2, "block_id": "h2", "cursor": "c2", "record_changes": []},
        {"block_num": 3, "block_id": "h3", "cursor": "c3"},
    ]
    (tmp_path / "blocks.json").write_text("\n".join(map(json.dumps, lines)))
    shape = "block_num long, block_id string, cursor string, record_changes array<%s>" % CHANGE.simpleString()
    schema = spark.createDataFrame([], shape).schema
    blocks = read_blocks(spark, str(tmp_path / "blocks.json"), 1, fmt="json", schema=schema)
    store = BatchStore(spark, str(tmp_path / "s"))
    run_batch(IngestJob("json", lambda b: b, [POINTS]), store, blocks)
    row = store.rows(POINTS).first()
    label = "bin.node.cli.PRIMARY_KEY_INSERT_INTO<a_1>"
    assert tuple(row) == (hashlib.blake2s(label.encode()).hexdigest(), 5)
    assert cursor(store) == ("json", "c3", 3, "h3")


@pytest.mark.parametrize("module, table, count", [("extract_events", ETH_EVENTS, 5), ("block_meta", ETH_BLOCKHEADERS, 2)])
def test_modules_by_name(spark, tmp_path, module, table, count):
    shape = (
        "block_num long, block_id string, cursor string, hash binary, parent_hash binary, timestamp timestamp_ntz,"
        "block_hash binary, tx_index int, tx_hash binary, log_index int, ordinal long, address binary,"
        "topics array<binary>, data binary"
    )
    when = dt.datetime(2024, 1, 2, 3, 4, 5)
    data = [
        (b, f"h{b}", f"c{b}", bytearray([b]), bytearray([b - 1]), when, bytearray([b]), 0, bytearray([9]), i, i, bytearray(20), [bytearray(32)], bytearray(32))
        for b, n in ((1, 2), (2, 3))
        for i in range(n)
    ]
    frame = spark.createDataFrame(data, shape)
    if module == "block_meta":
        frame = frame.filter("log_index = 0")
    store = BatchStore(spark, str(tmp_path / "s"))
    run_batch(IngestJob(module, module, [table]), store, frame)
    rows = store.rows(table).collect()
    assert len(rows) == count and len({r["id"] for r in rows}) == count
    if module == "extract_events":
        assert {(r["blocknumber"], r["num_logs"]) for r in rows} == {(1, 2), (2, 3)}
        assert len({r["commitment"] for r in rows}) == 2 and {r["topic1"] for r in rows} == {None}
    else:
        assert {r["timestamp"] for r in rows} == {"2024-01-02T03:04:05Z"}
        assert {(r["number"], r["hash"], r["parent_hash"]) for r in rows} == {(1, "01", "00"), (2, "02", "01")}


def test_dead_write_stays_unseen_after_other_commits(spark, tmp_path):
    from chainloom.contracts import contract

    one, two = contract("one", "id text", "id"), contract("two", "id text", "id")
    rows = spark.createDataFrame([("a",), ("b",)], "id string")
    dead = BatchStore(spark, str(tmp_path / "s"))
    dead.commit({"one": rows}, None, "first", 0)
    dead.write({"one": rows, "two": rows})
    other = BatchStore(spark, str(tmp_path / "s"))
    other.commit({"two": rows.limit(1)}, None, "second", 0)
    after = BatchStore(spark, str(tmp_path / "s"))
    assert (after.rows(one).count(), after.rows(two).count()) == (2, 1)


def test_blocks_are_spread_whatever_their_splits(spark, tmp_path):
    spark.range(20_000).withColumnRenamed("id", "block_num").coalesce(1).write.parquet(str(tmp_path / "one"))
    bytes_each = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        # Many splits, of which the one with the row group has all rows.
        read = spark.read.parquet(str(tmp_path / "one"))
        assert read.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        counts = [r["count"] for r in spread(read).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(counts) == 20_000 and max(counts) <= 20_000 // spark.sparkContext.defaultParallelism + 10
        assert spread(read, each=500).groupBy(F.spark_partition_id()).count().count() == 40
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_each)


@pytest.mark.parametrize("places, files", [(list(range(300)), 5), ([*range(198), 1000, 2000, 2001], 8)])
def test_batches_of_a_stream_have_several_files(spark, tmp_path, places, files):
    table = spark.createDataFrame([(p,) for p in [*places, None]], "place long")
    folder = str(tmp_path / "arriving")
    arriving = catalog._arriving(table, F.col("place"), folder, rows=25)
    batches = []
    query = arriving.writeStream.foreachBatch(lambda frame, _: batches.append({r[0] for r in frame.collect()}))
    query.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    size = max(places) // 3 + 1
    # Rows without a place come last.
    assert batches == [{p for p in places if p // size == k} | ({None} if k == 2 else set()) for k in range(3)]
    assert len(list((tmp_path / "arriving").glob("*.parquet"))) == 3 * files
