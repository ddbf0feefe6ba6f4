"""Ingest runs as streams: each micro-batch is one batch of the store."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from chainloom.operators.balances import with_first_blocks
from chainloom.plans.ingest import Enrichment, IngestJob, balance_batch, next_due, process_batch, resolve_batch
from chainloom.streaming.store import BatchStore


def stream_ingest(
    job: IngestJob,
    store: BatchStore,
    blocks: DataFrame,
    checkpoint: str,
    *,
    available_now: bool = True,
    interval: str = "10 seconds",
    now: dt.datetime | str | None = None,
) -> StreamingQuery:
    """Start the run. With `available_now` it stops when the blocks at hand are done.

    The checkpoint remembers which files were read, the store which batches were committed and up to
    which block. Losing the checkpoint re-reads the files and writes nothing twice; for that case
    blocks must have arrived in order, since a cursor stands for all blocks before it.
    """

    def each_batch(frame: DataFrame, epoch: int) -> None:
        with store.lock:
            process_batch(job, store, frame, checkpoint, epoch, now)
            if job.enrichment is not None:
                # After a restart every queued task is tried at once, later only those that are due.
                first, started["done"] = not started["done"], True
                resolve_batch(job.enrichment, store, f"links:{checkpoint}", epoch, now, at_once=first)

    started = {"done": False}
    return _start(blocks, each_batch, checkpoint, available_now, interval)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def stream_retries(
    enrichment: Enrichment,
    store: BatchStore,
    checkpoint: str,
    *,
    interval: str = "1 second",
    clock: Callable[[], dt.datetime] = utc_now,
    after_tick: Callable[[bool], None] = lambda idle: None,
) -> StreamingQuery:
    """Attempts of the links that are due, woken by a clock and not by blocks.

    A stream of ticks beside the stream of blocks; both write to one store, a batch at a time. A tick at which
    nothing is due reads nothing: the next due time is looked up only after a batch was committed. `after_tick` is
    told whether no task is queued any more.
    """
    source = f"retries:{checkpoint}"
    seen: dict = {"batch": None, "due": None}

    def tick(_: DataFrame, epoch: int) -> None:
        with store.lock:
            if seen["batch"] != store.last_batch():
                seen.update(batch=store.last_batch(), due=next_due(store))
            if seen["due"] is not None and seen["due"] <= clock():
                resolve_batch(enrichment, store, source, store.source(source).last_epoch + 1, clock())
                seen.update(batch=store.last_batch(), due=next_due(store))
            idle = seen["due"] is None
        after_tick(idle)

    ticks = store.spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    return _start(ticks, tick, checkpoint, False, interval)


def stream_balances(
    store: BatchStore,
    changes: DataFrame,
    checkpoint: str,
    *,
    available_now: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Balance changes as a stream, in block order. The first block of each address is state that Spark keeps
    with the checkpoint, so a batch costs what its own addresses cost, however many came before."""

    def each_batch(frame: DataFrame, epoch: int) -> None:
        balance_batch(store, frame, checkpoint, epoch)

    return _start(with_first_blocks(changes), each_batch, checkpoint, available_now, interval)


def _start(
    frame: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool,
    interval: str,
) -> StreamingQuery:
    writer = frame.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    )
    return writer.start()


def run_stream(
    job: IngestJob,
    store: BatchStore,
    blocks: DataFrame,
    checkpoint: str,
    *,
    retries: str | None = None,
    clock: Callable[[], dt.datetime] = utc_now,
    **options,
) -> None:
    """Run a bounded stream to its end; errors of a batch are raised here.

    With `retries` (an interval such as "1 second") links are attempted again when they are due, while blocks come
    and after the last one, until no task is queued.
    """
    query = stream_ingest(job, store, blocks, checkpoint, **options)
    if retries is None or job.enrichment is None:
        query.awaitTermination()
        return
    idle = threading.Event()
    ticks = stream_retries(
        job.enrichment, store, f"{checkpoint}-retries", interval=retries, clock=clock,
        after_tick=lambda done: idle.set() if done else idle.clear(),
    )
    try:
        query.awaitTermination()
        idle.clear()
        while ticks.isActive and not idle.wait(0.2):
            pass
        if ticks.exception() is not None:
            raise ticks.exception()
    finally:
        ticks.stop()
