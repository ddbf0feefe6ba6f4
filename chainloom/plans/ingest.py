"""An ingest run: blocks through a module to change records, checked, keyed and committed.

The same `process_batch` serves a batch run, which is one batch, and each micro-batch of a stream.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from chainloom.contracts import CREATE, DELETE, RESOLVER_TASKS, UPDATE, Contract, ContractError
from chainloom.functions.skew import fits_broadcast, join_same
from chainloom.operators import balances, blocks, changes, keyed, links, logs, progress
from chainloom.operators.stores import StoreReader, check_policy
from chainloom.sources.blocks import block_range_scan, check_range, spread, spread_parts
from chainloom.sources.forks import ABOVE, BELOW, SEVERAL, Links, follow_chain, side_by_side
from chainloom.streaming.store import BatchStore

Module = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class StoreModule:
    """Keeps values by key over all blocks of a run. `deltas` gives block_num, ordinal, pos, key and value (text,
    or a number for the policies that count) from blocks; a NULL value of `set` deletes its key."""

    name: str
    deltas: Module
    policy: str = "set"

    def __post_init__(self) -> None:
        check_policy(self.policy)


@dataclass(frozen=True)
class MapModule:
    """Change records from blocks and from the stores it names, read as of any place in the blocks."""

    records: Callable[[DataFrame, Mapping[str, StoreReader]], DataFrame]
    stores: tuple[StoreModule, ...]


# Modules by name: blocks (or their logs) in, change records out.
MODULES: dict[str, Module | MapModule] = {
    "block_meta": blocks.block_headers,
    "map_posts": logs.posts,
    "extract_events": lambda frame: logs.event_changes(
        logs.event_rows(frame, commitments=logs.block_commitment(frame))
    ),
    "balance_table": MapModule(
        balances.balance_records, (StoreModule("store_balance", balances.balance_deltas),)
    ),
}

REJECTS = T.StructType(
    [
        T.StructField("block_num", T.LongType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("record", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
    ]
)


BALANCE_LATEST = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("balance", T.StringType())]
)
BALANCE_CHANGES = T.StructType(
    [
        T.StructField("block_num", T.LongType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Enrichment:
    """Where the links of a run go: content by uri, handlers by name, and the tables of their records."""

    manifest: str
    handlers: Mapping[str, links.Handler]
    contracts: Sequence[Contract]
    content: Callable[[], DataFrame] | None = None
    fetcher: Callable | None = None
    ipfs_gateways: Sequence[str] = ()
    size_limit: int = links.MAX_CONTENT_SIZE
    max_concurrent: int = links.MAX_CONCURRENT


@dataclass(frozen=True)
class IngestJob:
    """What a run does. `module` is a name in MODULES or a function from blocks to change records.

    `mode="append"` takes creates only and appends rows. `mode="changes"` takes creates, updates and
    deletes, keyed by the record's id, and appends them as changes that `BatchStore.folded` applies; a create
    on a live key is an error, or a reject by `on_conflict`.

    With `final_depth` only blocks at least so far behind the head, and on its chain by `links`, are taken;
    the others wait in the store for later batches.
    """

    run_id: str
    module: str | Module | MapModule
    contracts: Sequence[Contract]
    start: int = 0
    stop: int | None = None
    algo: str = "blake2s"
    overflow: str = "reject"
    strict: bool = True
    on_duplicate: str = "fail"
    on_conflict: str = "fail"
    mode: str = "append"
    enrichment: Enrichment | None = field(default=None)
    final_depth: int | None = None
    links: Links = Links()

    def __post_init__(self) -> None:
        check_range(self.start, self.stop)
        if not self.run_id or not self.contracts:
            raise ContractError("a run needs an id and at least one table")
        if self.mode not in ("append", "changes"):
            raise ContractError("mode is 'append' or 'changes'")

    @property
    def transform(self) -> Module | MapModule:
        return MODULES[self.module] if isinstance(self.module, str) else self.module


def earlier_values(store: BatchStore, module: StoreModule, deltas: DataFrame) -> DataFrame | None:
    """The values that earlier batches left for the keys of `deltas`: the large side is scanned, not shuffled,
    while a batch has few keys."""
    rows = store.read(f"store_{module.name}", store_schema(deltas))
    if not store.has_rows(f"store_{module.name}"):
        return None
    keys = deltas.select("key").distinct()
    if fits_broadcast(keys):
        keys = F.broadcast(keys)
    own = join_same(rows, keys, ["key"], "left_semi")
    last = own.groupBy("key").agg(F.max_by(F.struct("value"), "batch").alias("last"))
    return last.select("key", F.col("last")["value"].alias("value")).filter("value is not null")


def store_schema(deltas: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(c, deltas.schema[c].dataType) for c in ("key", "value")])


def run_stores(job: IngestJob, store: BatchStore, todo: DataFrame) -> tuple[dict[str, StoreReader], dict[str, DataFrame]]:
    """(the readers of a module's stores, the values that this batch leaves in them)."""
    readers, tables = {}, {}
    for module in job.transform.stores if isinstance(job.transform, MapModule) else ():
        deltas = module.deltas(todo)
        reader = StoreReader(deltas, module.policy, earlier_values(store, module, deltas))
        readers[module.name] = reader
        tables[f"store_{module.name}"] = reader.values()
    return readers, tables


def change_records(job: IngestJob, todo: DataFrame, stores: Mapping[str, StoreReader] | None = None) -> DataFrame:
    """The change records of the blocks, one row each."""
    module = job.transform
    records = module.records(todo, stores or {}) if isinstance(module, MapModule) else module(todo)
    if "record_changes" in records.columns:
        records = changes.explode_changes(records).filter(F.col("record").isNotNull())
    return records


def checked_rows(job: IngestJob, records: DataFrame, contract: Contract) -> DataFrame:
    """All records of one table as typed and keyed rows, `_reject_reason` set where a rule is broken."""
    operations = (CREATE,) if job.mode == "append" else (CREATE, UPDATE, DELETE)
    tagged = changes.reject_invalid(changes.rows_for(records, contract), operations)
    return changes.fields_to_columns(
        changes.conform_to_contract(tagged, contract, job.overflow),
        contract,
        key="derived" if job.mode == "append" else "id",
        algo=job.algo,
        overflow=job.overflow,
        keep=(*changes.ORDER, "operation", "reject_reason"),
        present=job.mode == "changes",
        requests=job.enrichment is not None,
    )


def _rejects(frame: DataFrame, record: Column, reason: str, prefix: str = "_") -> DataFrame:
    return frame.select(
        F.col(f"{prefix}block_num").alias("block_num"),
        F.col(f"{prefix}ordinal").alias("ordinal"),
        F.col(f"{prefix}pos").alias("pos"),
        record.alias("record"),
        F.col(reason).alias("reject_reason"),
    )


def hold_back(job: IngestJob, store: BatchStore, blocks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blocks that are final now, dealt over tasks like those of `spread`, blocks that wait, with the block that was
    final last, the kept frame of both).

    Blocks that came before and wait are read from the store, where each batch writes all of them: as many
    as the depth and the forks in it. New ones at or below the last final block are too late and left out.
    The chain has to reach from the head down to the last final block; where blocks of it have not come yet,
    nothing is final and all wait. So blocks may come in any order once the first batch has begun at the
    lowest one. A head that moves to another fork changes what waits, never what was final.
    """
    number = F.col(job.links.number)
    flagged = T.StructType([*blocks.schema.fields, T.StructField("_settled", T.BooleanType())])
    seen = store.newest(f"waiting_{job.run_id}", flagged)
    anchor = seen.filter("_settled").agg(F.max(job.links.number)).first()[0]
    new = blocks if anchor is None else blocks.filter(number > anchor)
    both = seen.unionByName(new.withColumn("_settled", F.lit(False)))
    laid = side_by_side(both, job.links, spread_parts(both)).persist(StorageLevel.MEMORY_AND_DISK)
    both = laid.drop(SEVERAL, BELOW, ABOVE)
    chain = follow_chain(laid, job.links)
    if chain.head is None or chain.broken_at is not None:
        return blocks.limit(0), both, laid
    done = chain.keep(laid).filter(number <= max(chain.head - job.final_depth, -1 if anchor is None else anchor))
    last = done.agg(F.max(job.links.number)).first()[0]
    if last is None:
        return blocks.limit(0), both, laid
    done = done.select(*both.columns)
    waiting = both.filter(number > last).unionByName(done.filter(number == last).withColumn("_settled", F.lit(True)))
    return done.filter(~F.col("_settled")).select(*blocks.columns), waiting, laid


def process_batch(
    job: IngestJob,
    store: BatchStore,
    source_blocks: DataFrame,
    source: str,
    epoch: int,
    now: dt.datetime | str | None = None,
) -> None:
    """Take one batch of blocks to committed rows, tasks and progress.

    A batch of a source that was committed before is not done again. Blocks outside the range are
    passed over, and so are those up to the cursor that the run had reached before this source began:
    a new source, such as a stream that lost its checkpoint, starts where the last one ended. Inside
    a source blocks may come in any order.

    The rows of each table are worked out once and kept for the checks and the write.
    """
    if store.has(source, epoch):
        return
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    todo = block_range_scan(source_blocks, job.start, job.stop)
    if store.last_batch() >= 0:
        cursor, done, _ = progress.get_cursor(
            store.progress(before=source), job.run_id, job.start
        )
        if cursor:
            todo = todo.filter(F.col("block_num") > done)

    held: list[DataFrame] = []
    waiting = None
    if job.final_depth is not None:
        todo, waiting, kept = hold_back(job, store, todo)
        held.append(kept)
    else:
        todo = spread(todo)
    readers, left = run_stores(job, store, todo)
    records = change_records(job, todo, readers)
    unknown = changes.route_by_table(records, job.contracts).filter("reject_reason is not null")
    rejects = [_rejects(unknown, F.col("record"), "reject_reason", prefix="")]
    tables: dict[str, DataFrame] = {}
    tasks: list[DataFrame] = []
    try:
        for contract in job.contracts:
            rows = checked_rows(job, records, contract).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(rows)
            name = F.lit(contract.table)
            rejects.append(
                _rejects(rows.filter("_reject_reason is not null"), name, "_reject_reason")
            )
            valid = rows.filter("_reject_reason is null").drop("_reject_reason")
            if job.enrichment is not None:
                tasks.append(
                    changes.request_tasks(
                        valid, job.enrichment.manifest, [f"_{c}" for c in changes.ORDER]
                    )
                )
                valid = valid.drop("_requests")
            if job.mode == "changes":
                outcomes = keyed.change_outcomes(store.live_keys(contract, valid), valid, contract.keys)
                refused = outcomes.filter(F.col("reject_reason").isNotNull())
                if job.on_conflict == "fail":
                    clash = refused.filter(F.col("reject_reason") == "key_exists").head(1)
                    if clash:
                        key = {k: clash[0][k] for k in contract.keys}
                        raise keyed.DuplicateKey(f"{contract.table}: create on a live key: {key}")
                rejects.append(_rejects(refused, name, "reject_reason"))
                taken = outcomes.filter(F.col("reject_reason").isNull())
                tables[f"{contract.table}_changes"] = taken.drop("reject_reason")
                continue
            fresh, repeated = keyed.insert_append(
                store.rows_near(contract, valid) if store.has_rows(contract.table) else None,
                valid,
                contract.keys,
                on_duplicate=job.on_duplicate,
                on_conflict=job.on_conflict,
            )
            tables[contract.table] = fresh.select(*contract.names)
            rejects.append(_rejects(repeated, name, "reject_reason"))
        all_rejects = reduce(DataFrame.unionByName, rejects)
        if job.strict:
            first = all_rejects.head(1)
            if first:
                raise changes.RejectedRecords(f"{job.run_id}: {first[0].asDict()}")
        else:
            tables["rejects"] = all_rejects
        if tasks:
            known = store.read(RESOLVER_TASKS.table, RESOLVER_TASKS.schema)
            new = links.enqueue_tasks(known, reduce(DataFrame.unionByName, tasks), now)
            new = new.select(*RESOLVER_TASKS.names).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(new)
            tables[RESOLVER_TASKS.table] = new
            tables[OPEN_TASKS] = open_tasks(store).unionByName(new)
        tables.update(left)
        if waiting is not None:
            tables[f"waiting_{job.run_id}"] = waiting
        keys = {c.table: c.keys for c in job.contracts if c.table in tables}
        store.commit(tables, progress.batch_progress(todo, job.run_id), source, epoch, keys)
    finally:
        for frame in held:
            frame.unpersist()


# The tasks that are still queued, written whole by each batch that changes them.
OPEN_TASKS = "open_tasks"


def open_tasks(store: BatchStore) -> DataFrame:
    """The tasks that are still queued: as many rows as are open, however many were finished before."""
    if store.has_rows(OPEN_TASKS):
        return store.newest(OPEN_TASKS, RESOLVER_TASKS.schema)
    return links.queued_tasks(current_tasks(store)).select(*RESOLVER_TASKS.names)


def next_due(store: BatchStore) -> dt.datetime | None:
    """When the next task is due, None without any."""
    return open_tasks(store).agg(F.min("due_at").alias("due")).first()["due"]


def current_tasks(store: BatchStore) -> DataFrame:
    """Every task as its last batch left it."""
    log = store.read(RESOLVER_TASKS.table, RESOLVER_TASKS.schema)
    others = [c for c in RESOLVER_TASKS.names if c not in links.TASK_KEY]
    return (
        log.groupBy(*links.TASK_KEY)
        .agg(F.max_by(F.struct(*others), "batch").alias("last"))
        .select(*links.TASK_KEY, "last.*")
    )


def resolve_batch(
    enrichment: Enrichment,
    store: BatchStore,
    source: str,
    epoch: int,
    now: dt.datetime | str | None = None,
    *,
    at_once: bool = False,
) -> None:
    """One attempt for every task that is due (`at_once`: every queued one, as after a restart).

    The new task rows and the parsed rows are one batch. A parsed row whose key is taken is left out
    and its task is still finished.
    """
    if store.has(source, epoch):
        return
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    queued = open_tasks(store)
    due = links.queued_tasks(queued, None if at_once else now)
    content = enrichment.content() if enrichment.content else None
    resolved = links.attempt_tasks(
        due,
        content,
        {enrichment.manifest: enrichment.handlers},
        now,
        fetcher=enrichment.fetcher,
        ipfs_gateways=enrichment.ipfs_gateways,
        max_concurrent=enrichment.max_concurrent,
        limit=enrichment.size_limit,
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if resolved.isEmpty():
            return
        tried = resolved.select(*RESOLVER_TASKS.names)
        later = queued.limit(0) if at_once else queued.join(due.select(*links.TASK_KEY), list(links.TASK_KEY), "left_anti")
        tables = {
            RESOLVER_TASKS.table: tried,
            OPEN_TASKS: later.select(*RESOLVER_TASKS.names).unionByName(links.queued_tasks(tried)),
        }
        for contract in enrichment.contracts:
            rows = links.parsed_rows(resolved, contract)
            fresh, _ = keyed.insert_append(
                store.rows_near(contract, rows) if store.has_rows(contract.table) else None,
                rows,
                contract.keys,
                on_duplicate="reject",
                on_conflict="reject",
            )
            tables[contract.table] = fresh.select(*contract.names)
        store.commit(tables, None, source, epoch, {c.table: c.keys for c in enrichment.contracts})
    finally:
        resolved.unpersist()


def resolve_all(
    enrichment: Enrichment,
    store: BatchStore,
    source: str,
    *,
    clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
    wait: Callable[[float], None] = time.sleep,
) -> None:
    """Go on until no task is queued: wait for the next due time, then attempt what is due.

    Every attempt ends a task or uses up a retry, so this comes to an end. `source` names the attempts
    in the store and is not to be that of another writer. One row per round reaches the driver.
    """
    epoch = store.source(source).last_epoch
    while True:
        due = next_due(store)
        if due is None:
            return
        now = clock()
        if due > now:
            wait((due - now).total_seconds())
            continue
        epoch += 1
        resolve_batch(enrichment, store, source, epoch, now)


def run_batch(
    job: IngestJob, store: BatchStore, source_blocks: DataFrame, now: dt.datetime | str | None = None
) -> None:
    """All blocks as one batch, then one attempt for the links."""
    epoch = store.last_batch() + 1
    process_batch(job, store, source_blocks, f"batch:{job.run_id}:{epoch}", epoch, now)
    if job.enrichment is not None:
        resolve_batch(job.enrichment, store, f"links:{job.run_id}", epoch, now, at_once=True)


def balance_batch(store: BatchStore, seen: DataFrame, source: str, epoch: int) -> None:
    """One batch of balances with the first block of their address. Tables: `balance_changes`, and per batch
    the last balance of each of its addresses (`balance_latest`)."""
    if store.has(source, epoch):
        return
    changed = seen.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tables = {
            "balance_changes": balances.typed_balances(changed),
            "balance_latest": balances.balance_latest(changed),
        }
        store.commit(tables, None, source, epoch)
    finally:
        changed.unpersist()


def current_balances(store: BatchStore) -> DataFrame:
    """The last balance per address over all batches, which come in block order."""
    return (
        store.read("balance_latest", BALANCE_LATEST)
        .groupBy("key")
        .agg(F.max_by("balance", "batch").alias("balance"))
    )
