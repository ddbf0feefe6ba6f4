"""Reading blocks: ranges, final blocks, batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainloom.sources.forks import Links, final_chain


def check_range(start: int, stop: int | None) -> None:
    """A run starts at a block that exists and, if it has a stop, before it; both zero is no range."""
    if start < 0:
        raise ValueError(f"start block {start} is negative")
    if start == 0 and stop == 0:
        raise ValueError("start and stop block are both zero")
    if stop and stop <= start:
        raise ValueError(f"stop block {stop} is not after start block {start}")


def block_range_scan(
    blocks: DataFrame, start: int, stop: int | None, *, number: str = "block_num"
) -> DataFrame:
    """Blocks from `start` up to, not including, `stop`; no stop, or 0, leaves the range open.

    Two plain comparisons, so that they reach the Parquet scan and prune block buckets.
    """
    check_range(start, stop)
    ranged = blocks.filter(F.col(number) >= start)
    return ranged.filter(F.col(number) < stop) if stop else ranged


def final_blocks(
    blocks: DataFrame,
    depth: int,
    *,
    head: int | None = None,
    number: str = "block_num",
    flag: str | None = None,
    links: Links | None = None,
) -> DataFrame:
    """Blocks that can no longer be replaced: by a flag column, or at least `depth` behind the head.

    With `links` (the columns of number, hash and parent hash) only blocks of the head's chain are final;
    without them the blocks are taken to be free of forks. Without a given head it is the largest number, one
    scalar that Spark computes first.
    """
    if links is not None:
        return final_chain(blocks, depth, links)
    if flag is not None:
        return blocks.filter(F.col(flag))
    if head is not None:
        return blocks.filter(F.col(number) <= head - depth)
    last = blocks.select((F.max(number) - depth).alias("last")).scalar()
    return blocks.filter(F.col(number) <= last)


BUCKET = "bucket"


def write_blocks(blocks: DataFrame, path: str, width: int, *, number: str = "block_num", mode: str = "error") -> None:
    """Write blocks into a folder per range of `width` numbers, sorted by number inside the files.

    Rows are range-partitioned by number, so a folder gets a few files whatever its size; blocks without a number
    have a folder of their own, which no range reads. `read_blocks` with the same width opens only the folders
    of its range.
    """
    if width <= 0:
        raise ValueError("a bucket holds at least one number")
    bucket = F.floor(F.col(number) / width).cast("bigint")
    placed = blocks.withColumn(BUCKET, bucket).repartitionByRange(BUCKET, number).sortWithinPartitions(BUCKET, number)
    placed.write.mode(mode).partitionBy(BUCKET).parquet(path)


def read_blocks(
    spark: SparkSession,
    path: str,
    start: int,
    stop: int | None = None,
    *,
    columns: Sequence[str] | None = None,
    number: str = "block_num",
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    width: int | None = None,
) -> DataFrame:
    """A block range of a Parquet, JSON or other file table.

    With `width`, that of `write_blocks`, the range becomes a filter of folders as well, so that files of other
    ranges are neither listed for the scan nor opened.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    found = reader.load(path)
    if width is not None:
        found = found.filter(F.col(BUCKET) >= start // width)
        found = found.filter(F.col(BUCKET) <= (stop - 1) // width) if stop else found
    ranged = block_range_scan(found, start, stop, number=number)
    ranged = ranged.drop(BUCKET) if width is not None else ranged
    return ranged.select(*columns) if columns else ranged


def stream_blocks(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Blocks as a stream of files."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    for name, setting in (options or {}).items():
        reader = reader.option(name, setting)
    return reader.load(path)


# Blocks of one task.
TASK_BLOCKS = 200_000


def spread(blocks: DataFrame, each: int = TASK_BLOCKS) -> DataFrame:
    """Blocks dealt evenly over all cores, and over more tasks where one would have more than `each`.

    A micro-batch is often a few files, and the work per block is far more than moving it. The number of its
    partitions tells little: those of a file with one row group are empty but for one.
    """
    return blocks.repartition(spread_parts(blocks, each))


def spread_parts(blocks: DataFrame, each: int = TASK_BLOCKS) -> int:
    """The number of tasks over which `spread` deals the blocks."""
    return max(blocks.sparkSession.sparkContext.defaultParallelism, -(-blocks.count() // each))
