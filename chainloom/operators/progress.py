"""Progress of named runs: the last cursor of each, and the blocks after it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.contracts import CURSORS
from chainloom.functions.skew import BROADCAST_ROWS, GROUP_LIMIT, join_lookup


def batch_progress(blocks: DataFrame, run_id: str) -> DataFrame:
    """The cursor row of a batch: its last block, whether or not the block had changes. Always one
    row; without any block it is empty."""
    last = blocks.agg(F.max_by(F.struct("cursor", "block_num", "block_id"), "block_num").alias("last"))
    return last.select(
        F.when(F.col("last").isNotNull(), F.lit(run_id)).alias("id"),
        "last.cursor",
        "last.block_num",
        "last.block_id",
    )


def cursor_upsert(progress: DataFrame | None, written: DataFrame) -> DataFrame:
    """One row per run: the furthest of the stored and the written cursors."""
    names = CURSORS.names
    rows = written.select(*names)
    if progress is not None:
        rows = progress.select(*names).unionByName(rows)
    return (
        rows.groupBy("id")
        .agg(F.max_by(F.struct("cursor", "block_num", "block_id"), "block_num").alias("last"))
        .select("id", "last.cursor", "last.block_num", "last.block_id")
    )


def get_cursor(progress: DataFrame | None, run_id: str, start: int) -> tuple[str, int, str]:
    """(cursor, block number, block id) of a run; without a row, the configured start and no cursor."""
    if start < 0:
        raise ValueError(f"start block {start} is negative")
    row = None if progress is None else progress.filter(F.col("id") == run_id).first()
    if row is None:
        return "", start, str(start)
    return row["cursor"], row["block_num"], row["block_id"]


def resume_filter(
    blocks: DataFrame,
    progress: DataFrame,
    start: int,
    *,
    run: str = "run_id",
    bound: int = BROADCAST_ROWS,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The blocks each run has still to do: after its cursor, or from `start` if it has none.

    `progress` has one row per run; up to `bound` rows it is broadcast.
    """
    if start < 0:
        raise ValueError(f"start block {start} is negative")
    done = progress.select(F.col("id").alias(run), F.col("block_num").alias("__done"))
    reached = join_lookup(blocks, done, [run], how="left", bound=bound, limit=limit)
    return reached.filter(
        F.col("block_num") > F.coalesce(F.col("__done"), F.lit(start - 1))
    ).select(*blocks.columns)
