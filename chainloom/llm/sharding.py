"""Sharding by extendible hashing: a directory of hash prefixes in which only oversized buckets split."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainloom.llm.shared import fitting, kept

BITS = 60  # of a row's hash


@dataclass(frozen=True)
class Shards:
    """limit_bytes: most bytes of text in a shard. A round of splitting looks at so many more bits."""

    limit_bytes: int = 1 << 20
    bits_per_round: int = 6
    broadcast_rows: int = 500_000


def row_hash(id_col: str, text_col: str) -> Column:
    """The first 60 bits of the md5 of id and text: rows fall together only if they are copies."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _prefix(value: Column, have: int, want: int | Column) -> Column:
    """The first `want` of a value's `have` bits."""
    return F.call_function("shiftright", value, F.lit(have) - want)


def directory(rows: DataFrame, shards: Shards) -> list[tuple[int, DataFrame]]:
    """[(bits, frame (bucket, depth, shard_bytes))] of rows (hash, n_bytes): for each bucket of so many bits the
    shortest prefix whose rows fit the limit. Buckets that fit at no depth are in the next frame of more bits."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    bits = min(BITS, max(0, math.ceil(math.log2(max(1, total / shards.limit_bytes)))) + 2)
    out, left, floor = [], rows, 0
    while True:
        counted = left.groupBy(_prefix(F.col("hash"), BITS, bits).alias("bucket")).agg(F.sum("n_bytes").alias("n_bytes"))
        levels = counted.select("bucket", "n_bytes", F.explode(F.sequence(F.lit(floor), F.lit(bits))).alias("depth"))
        levels = levels.withColumn("prefix", _prefix(F.col("bucket"), bits, F.col("depth")))
        sums = levels.groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("shard_bytes")).where(F.col("shard_bytes") <= shards.limit_bytes)
        fits = levels.join(sums, ["depth", "prefix"], "left").groupBy("bucket").agg(
            F.min(F.when(F.col("shard_bytes").isNotNull(), F.struct("depth", "shard_bytes"))).alias("leaf")
        )
        fits = kept(fits.select("bucket", "leaf.depth", "leaf.shard_bytes"), "directory")
        out.append((bits, fits))
        over = fits.where("depth is null").select("bucket")
        if bits == BITS or not over.head(1):
            return out
        keyed = left.withColumn("bucket", _prefix(F.col("hash"), BITS, bits))
        left = kept(keyed.join(fitting(over, shards.broadcast_rows), "bucket").drop("bucket"), "oversized")
        floor, bits = bits + 1, min(BITS, bits + shards.bits_per_round)


def _pages(rows: DataFrame, shards: Shards) -> DataFrame:
    """Copies of one row that are over the limit together: as many shards as it takes, filled in turn.

    Copies are alike, so any numbering will do: it counts inside written partitions and adds each one's start.
    """
    placed = kept(rows.withColumn("part", F.spark_partition_id()), "copies")
    counts = placed.groupBy("hash", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("hash").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("hash", "part", before.alias("before"), F.sum("n").over(Window.partitionBy("hash")).alias("n"))
    number = F.row_number().over(Window.partitionBy("hash", "part").orderBy("n_bytes"))
    each = F.greatest(F.lit(1), F.floor(F.lit(shards.limit_bytes) / F.col("n_bytes"))).cast("long")
    at = placed.withColumn("number", number).join(starts, ["hash", "part"])
    at = at.withColumn("at", F.col("before") + F.col("number") - 1).withColumn("page", F.floor(F.col("at") / each).cast("long"))
    size = F.least(each, F.col("n") - F.col("page") * each) * F.col("n_bytes")
    return at.withColumn("shard_bytes", size.cast("long"))


def _assigned(docs: DataFrame, shards: Shards, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        row_hash(id_col, text_col).alias("hash"),
        F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"),
    )
    left = kept(rows, "rows")
    out = []
    bits_of = F.lpad(F.bin("hash"), BITS, "0")
    name = F.substring(bits_of, F.lit(1), F.col("depth"))
    for bits, leaves in directory(left, shards):
        keyed = left.withColumn("bucket", _prefix(F.col("hash"), BITS, bits))
        keyed = keyed.join(fitting(leaves, shards.broadcast_rows), "bucket")
        out.append(keyed.where("depth is not null").select("doc_id", "hash", "n_bytes", name.alias("shard"), "depth", "shard_bytes"))
        left = keyed.where("depth is null").select("doc_id", "hash", "n_bytes")
    if left.head(1):
        full = F.concat(bits_of, F.lit("."), F.col("page").cast("string"))
        out.append(_pages(left, shards).select("doc_id", "hash", "n_bytes", full.alias("shard"), F.lit(BITS).alias("depth"), "shard_bytes"))
    return reduce(DataFrame.union, out)


def shard(docs: DataFrame, shards: Shards = Shards(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, shard, depth, shard_bytes) for every row: its UTF-8 bytes and its shard's name, prefix
    length and bytes.

    A name is the prefix's bits; copies of one row (same id, same text) that no bit can part get `.0`, `.1` and
    so on behind all 60. A row that is over the limit by itself is alone in its shard. Null texts have no bytes
    and null ids are like empty ones; an empty table gives no rows; other columns are not read.
    """
    return _assigned(docs, shards, id_col, text_col).drop("hash")


def write_shards(docs: DataFrame, path: str, shards: Shards = Shards(), id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write whole documents (as `row`), a folder for each shard. Copies over the limit share the folder of their prefix."""
    name = _assigned(docs, shards, id_col, text_col).select("hash", F.substring_index("shard", ".", 1).alias("shard")).distinct()
    rows = docs.select(F.struct("*").alias("row"), row_hash(id_col, text_col).alias("hash")).join(name, "hash")
    rows.select("row", "shard").repartition("shard").write.partitionBy("shard").parquet(path)
