"""Work per key that stays spread out when one key holds a large share of all rows.

Sums, counts, `min_by` and `max_by` are combined before the shuffle, so a hot key costs nothing
there. Three things are not: putting a per-key figure back on every row, numbering the rows of a
key, and looking back to an earlier row of the key. The functions below first measure the largest
key with one aggregate. Up to `limit` rows per key they use the plain join or window; beyond it they
split the hot keys, with the same result.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one key that one task may hold.
GROUP_LIMIT = 2_000_000
# Rows and bytes of a side that may be broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
# So many hot keys are broadcast. With more, none of them holds more than 1 / HOT_KEYS of the rows.
HOT_KEYS = 200_000


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only where none is set (tests, local runs)."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None and not configured and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if current is None:
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="chainloom-"))
        current = context.getCheckpointDir()
    return configured or current


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: worked out once, whatever reads it and whoever is lost."""
    path = f"{ensure_checkpoint_dir(frame.sparkSession)}/{purpose}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def group_profile(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows of the largest key, all rows); one row reaches the driver."""
    row = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.max("n").alias("largest"), F.sum("n").alias("total"))
        .first()
    )
    return int(row["largest"] or 0), int(row["total"] or 0)


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether `df` has no more than `rows` rows; stops counting one row later."""
    return df.limit(rows + 1).count() <= rows


def _width(name: str, kind: T.DataType) -> Column:
    """About the bytes of a value: its own length for texts, its JSON text for nested ones, else a word."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        length = F.octet_length(name)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        length = F.octet_length(F.to_json(F.struct(name)))
    else:
        return F.lit(16)
    return F.coalesce(length, F.lit(0)) + 16


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether `df` has no more than so many rows and bytes; stops one row later."""
    width = sum((_width(f.name, f.dataType) for f in df.schema), F.lit(0)).cast("bigint")
    found = df.select(width.alias("w")).limit(rows + 1).agg(F.count("w").alias("n"), F.sum("w").alias("size")).first()
    return found["n"] <= rows and (found["size"] or 0) <= size


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join in which NULL keys match each other, as they do in an aggregate or a window."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"__right_{key}"))
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])


def join_group_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    *,
    how: str = "inner",
    limit: int = GROUP_LIMIT,
    nulls: bool = True,
) -> DataFrame:
    """Put the one row per key of `stats` on every row of that key.

    A NULL key is a key like others, as it is in the aggregate that gave `stats`; with `nulls=False` it
    matches nothing.
    Keys with more than `limit` rows are hot (with more than `HOT_KEYS` of them, twice the limit counts): their part of `stats` is broadcast
    and their rows stay where they are; the other keys take the ordinary join.
    """
    keys = list(keys)

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return join_same(left, right, keys, how) if nulls else left.join(right, keys, how)

    largest, total = group_profile(rows, keys)
    if largest <= limit:
        return joined(rows, stats, how)
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit)
    hot = (counted if nulls else counted.filter(_no_nulls(keys))).drop("__n")
    if total // limit > HOT_KEYS and not has_at_most(hot, HOT_KEYS):
        # Too many to broadcast: split the hotter ones, until they fit.
        return join_group_stats(rows, stats, keys, how=how, limit=2 * limit, nulls=nulls)
    hot_rows = joined(rows, F.broadcast(hot), "left_semi")
    cold_rows = joined(rows, F.broadcast(hot), "left_anti")
    hot_stats = joined(stats, F.broadcast(hot), "left_semi")
    return joined(hot_rows, F.broadcast(hot_stats), how).unionByName(joined(cold_rows, stats, how))


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    *,
    how: str = "inner",
    bound: int = BROADCAST_ROWS,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Join rows with a table of one row per key: broadcast up to `bound` rows and 128 MB, beyond it a shuffle
    join that keeps the rows of hot keys where they are."""
    if fits_broadcast(lookup, bound):
        return rows.join(F.broadcast(lookup), list(keys), how)
    return join_group_stats(rows, lookup, keys, how=how, limit=limit, nulls=False)


def _no_nulls(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for key in keys:
        out = out & F.col(key).isNotNull()
    return out


def _segments(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows range-partitioned by (keys, order), each with the number of its partition.

    Range boundaries come from a sample, so they are fixed once by a checkpoint before two branches
    of one plan read them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    return (
        df.repartitionByRange(parts, *keys, *order)
        .withColumn("__seg", F.spark_partition_id())
        .checkpoint(eager=True)
    )


def row_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    out: str = "position",
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The 0-based position of each row among the rows of its key."""
    largest, _ = group_profile(df, keys)
    if largest <= limit:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, (F.row_number().over(window) - 1).cast("bigint"))
    seg = _segments(df, keys, order)
    # At most one row per key and partition from here on.
    per_seg = seg.groupBy(*keys, "__seg").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_seg.select(
        *keys, "__seg", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy(*keys, "__seg").orderBy(*order)
    return (
        join_same(seg, offsets, [*keys, "__seg"])
        .withColumn(out, (F.row_number().over(inside) - 1 + F.col("__offset")).cast("bigint"))
        .drop("__seg", "__offset")
    )


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    *,
    out: str,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The last non-null `value` on an earlier row of the same key, NULL if there is none."""
    return running_value(df, keys, order, value, "last", out=out, limit=limit)


def _both(carried: Column, inside: Column, how: str) -> Column:
    """The value of the rows of earlier segments and that of the rows of the own segment as one."""
    if how == "last":
        return F.coalesce(inside, carried)
    if how == "first":
        return F.coalesce(carried, inside)
    if how == "sum":
        return F.coalesce(carried + inside, carried, inside)
    return F.least(carried, inside) if how == "min" else F.greatest(carried, inside)


def running_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    how: str,
    *,
    out: str,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The last, first, sum, min or max (`how`) of the non-null values on earlier rows of the same key."""
    over = {
        "last": lambda v: F.last(v, ignorenulls=True),
        "first": lambda v: F.first(v, ignorenulls=True),
        "sum": F.sum,
        "min": F.min,
        "max": F.max,
    }[how]
    largest, _ = group_profile(df, keys)
    if largest <= limit:
        earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, over(value).over(earlier))
    seg = _segments(df.withColumn("__value", value), keys, order)
    at = F.when(F.col("__value").isNotNull(), F.struct(*order))
    whole = {"last": lambda v: F.max_by(v, at), "first": lambda v: F.min_by(v, at)}.get(how, over)
    per_seg = seg.groupBy(*keys, "__seg").agg(whole(F.col("__value")).alias("__part"))
    before = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_seg.select(*keys, "__seg", over(F.col("__part")).over(before).alias("__carried"))
    inside = (
        Window.partitionBy(*keys, "__seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        join_same(seg, carried, [*keys, "__seg"])
        .withColumn(out, _both(F.col("__carried"), over(F.col("__value")).over(inside), how))
        .drop("__seg", "__carried", "__value")
    )
