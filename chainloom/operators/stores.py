"""Stores: values by key that change with the blocks, and reading them as they were at a place in a block.

A store module gives deltas: block_num, ordinal, pos, key and value. Its policy says what a delta does to the
value of its key. A map module reads the store beside the blocks. Nothing is replayed row by row: rows that read
and deltas that write are put in one order per key, and each reader carries the value before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.functions.skew import GROUP_LIMIT, join_same, running_value

DELTA = ("block_num", "ordinal", "pos")
# What a delta does, as the value of all deltas before a place.
POLICIES = {"set": "last", "set_if_not_exists": "first", "add": "sum", "min": "min", "max": "max"}
# Where a reader stands among the deltas of its block: the order of block, phase, ordinal, step, pos and kind.
PLACES = {"first": (-1, 0), "before": (0, 0), "at": (0, 1), "last": (1, 0)}


def check_policy(policy: str) -> str:
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy}: one of {', '.join(POLICIES)}")
    return policy


def _kept(value, policy: str):
    """A delta of `set` with a NULL value deletes its key, so the value travels in a struct; others skip NULLs."""
    return F.struct(value.alias("value")) if POLICIES[policy] == "last" else value


def read_store(
    rows: DataFrame,
    deltas: DataFrame,
    key: str,
    *,
    at: str = "first",
    policy: str = "set",
    out: str = "value",
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The rows with the value of their key as of a place in the run of blocks, NULL where there is none.

    `first`: before the block of the row. `last`: after it. `at`: after all deltas of the block up to the
    row's ordinal. `before`: before the delta at the row's own ordinal and pos. Rows have block_num, for `at`
    an ordinal and for `before` a pos too; a row without a key reads the key NULL. One key may hold most deltas.
    """
    phase, step = PLACES[at]
    zero = F.lit(0).cast("bigint")
    writes = deltas.select(
        F.col("key").alias("__key"),
        F.col("block_num").cast("bigint").alias("__block"),
        F.lit(0).alias("__phase"),
        F.col("ordinal").cast("bigint").alias("__ordinal"),
        F.lit(0).alias("__step"),
        F.col("pos").cast("bigint").alias("__pos"),
        F.lit(1).alias("__kind"),
        _kept(F.col("value"), policy).alias("__write"),
    )
    reads = rows.select(
        F.col(key).alias("__key"),
        F.col("block_num").cast("bigint").alias("__block"),
        F.lit(phase).alias("__phase"),
        (F.col("ordinal").cast("bigint") if phase == 0 else zero).alias("__ordinal"),
        F.lit(step).alias("__step"),
        (F.col("pos").cast("bigint") if at == "before" else zero).alias("__pos"),
        F.lit(0).alias("__kind"),
        F.struct(*[F.col(c) for c in rows.columns]).alias("__row"),
    )
    order = ["__block", "__phase", "__ordinal", "__step", "__pos", "__kind"]
    both = writes.unionByName(reads, allowMissingColumns=True)
    seen = running_value(both, ["__key"], order, F.col("__write"), POLICIES[check_policy(policy)], out="__seen", limit=limit)
    value = F.col("__seen")["value"] if POLICIES[policy] == "last" else F.col("__seen")
    found = seen.filter(F.col("__kind") == 0)
    kept = [F.col("__row")[c].alias(c) for c in rows.columns if c != out]
    return found.select(*kept, value.alias(out))


def store_values(deltas: DataFrame, policy: str = "set") -> DataFrame:
    """key and value after all deltas; keys that were deleted are left out. One aggregate, combined before the
    shuffle."""
    how, value, place = POLICIES[check_policy(policy)], F.col("value"), F.struct(*DELTA)
    found = F.when(value.isNotNull(), place)
    last = {
        "last": F.max_by(value, place),
        "first": F.min_by(value, found),
        "sum": F.sum(value),
        "min": F.min(value),
        "max": F.max(value),
    }[how]
    return deltas.groupBy("key").agg(last.alias("value")).filter(F.col("value").isNotNull())


@dataclass(frozen=True)
class StoreReader:
    """A store as a map module sees it: the values before the blocks at hand, and the deltas of these blocks."""

    deltas: DataFrame
    policy: str = "set"
    earlier: DataFrame | None = None

    def _all(self) -> DataFrame:
        deltas = self.deltas.select(*DELTA, "key", "value")
        if self.earlier is None:
            return deltas
        # Values from before stand ahead of every block.
        places = [F.lit(None).cast(deltas.schema[c].dataType).alias(c) for c in DELTA]
        return deltas.unionByName(self.earlier.select(*places, "key", "value"))

    def values(self) -> DataFrame:
        """key and value of the keys at hand after all blocks; a deleted key has a NULL value."""
        last = store_values(self._all(), self.policy)
        return join_same(self.deltas.select("key").distinct(), last, ["key"], "left")

    def _read(self, rows: DataFrame, key: str, at: str, out: str) -> DataFrame:
        return read_store(rows, self._all(), key, at=at, policy=self.policy, out=out)

    def get_first(self, rows: DataFrame, key: str, out: str = "value") -> DataFrame:
        return self._read(rows, key, "first", out)

    def get_last(self, rows: DataFrame, key: str, out: str = "value") -> DataFrame:
        return self._read(rows, key, "last", out)

    def get_at(self, rows: DataFrame, key: str, out: str = "value") -> DataFrame:
        return self._read(rows, key, "at", out)

    def get_before(self, rows: DataFrame, key: str, out: str = "value") -> DataFrame:
        return self._read(rows, key, "before", out)
