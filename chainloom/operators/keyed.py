"""Keyed tables as DataFrames: key check, insert, update, delete, and a mixed set of changes.

Change rows carry the columns of `fields_to_columns`: `_block_num`, `_ordinal`, `_pos`, `_operation`,
`_present` and the table's own columns. No function writes; a result is the new rows or the new table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.contracts import CREATE, DELETE, UPDATE
from chainloom.functions.skew import (
    BROADCAST_ROWS,
    GROUP_LIMIT,
    fits_broadcast,
    join_group_stats,
    join_lookup,
    previous_value,
    row_position,
)

ORDER = ("_block_num", "_ordinal", "_pos")


class DuplicateKey(ValueError):
    """A key given twice in one batch, or already in the table."""


def _null_key(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for key in keys:
        out = out | F.col(key).isNull()
    return out


def check_primary_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that break the rule: given more than once, or NULL; with their number of rows."""
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter((F.col("rows") > 1) | _null_key(keys))
    )


def first_of_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER
) -> DataFrame:
    """The first row of each key. An aggregate, so a hot key is reduced before the shuffle."""
    others = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("__first")
    return rows.groupBy(*keys).agg(first).select(*keys, "__first.*").select(*rows.columns)


def existing_keys(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of `rows` that the table already has.

    The table is the large side. While the batch is small its keys are broadcast, so the table's key
    columns are scanned once and not shuffled; a larger batch takes the shuffle join.
    """
    batch = rows.select(*keys).distinct()
    if fits_broadcast(batch):
        batch = F.broadcast(batch)
    return target.select(*keys).join(batch, list(keys), "left_semi")


def key_counts(
    rows: DataFrame, target: DataFrame | None, keys: Sequence[str], *, bound: int = BROADCAST_ROWS
) -> DataFrame:
    """The keys of `rows` with their number of `rows` and whether the table has them (`taken`).

    While the batch is small its keys are broadcast; a larger one is counted together with the keys of the table, in
    one aggregate."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    if target is None:
        return counts.withColumn("taken", F.lit(False))
    if fits_broadcast(rows.select(*keys), bound):
        return _with_flag(counts, existing_keys(rows, target, keys), keys, "taken")
    own, stored = rows.select(*keys, F.lit(False).alias("__stored")), target.select(*keys, F.lit(True).alias("__stored"))
    counts = own.unionByName(stored).groupBy(*keys).agg(F.count_if(~F.col("__stored")).alias("rows"), F.max("__stored").alias("taken"))
    # A NULL key is none that the table has.
    return counts.filter(F.col("rows") > 0).withColumn("taken", F.col("taken") & ~_null_key(keys))


def _with_flag(rows: DataFrame, found: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Rows with `flag` set where their key is in `found`."""
    marks = found.select(*keys).distinct().withColumn("__found", F.lit(True))
    joined = join_lookup(rows, marks, keys, how="left")
    return joined.withColumn(flag, F.coalesce("__found", F.lit(False))).drop("__found")


def insert_outcomes(
    target: DataFrame | None,
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ORDER,
    *,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """All rows with `reject_reason`: NULL for those to append, else `null_key`, `duplicate_key` (not the
    first row of its key) or `key_exists` (the first one, but the table has the key)."""
    placed = row_position(rows, keys, order, out="__position", limit=limit)
    reason = F.when(_null_key(keys), "null_key").when(F.col("__position") > 0, "duplicate_key")
    if target is not None:
        placed = _with_flag(placed, existing_keys(rows, target, keys), keys, "__taken")
        reason = reason.when(F.col("__taken"), "key_exists")
    return placed.withColumn("reject_reason", reason).select(*rows.columns, "reject_reason")


def insert_append(
    target: DataFrame | None,
    rows: DataFrame,
    keys: Sequence[str],
    *,
    on_duplicate: str = "fail",
    on_conflict: str = "fail",
    order: Sequence[str] = ORDER,
    limit: int = GROUP_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """(rows to append, rejects).

    A key twice in the batch is an error, or with `on_duplicate="reject"` all rows after the first
    are rejects. The same for a key that the table has, by `on_conflict`. Where both are errors one
    aggregate over the keys checks the batch, and its rows are left as they are.
    """
    for policy in (on_duplicate, on_conflict):
        if policy not in ("fail", "reject"):
            raise ValueError("a policy is 'fail' or 'reject'")
    if "fail" in (on_duplicate, on_conflict):
        broken = (F.col("rows") > 1) | _null_key(keys) if on_duplicate == "fail" else F.lit(False)
        clash = F.col("taken") if on_conflict == "fail" else F.lit(False)
        stored = target if on_conflict == "fail" else None
        found = key_counts(rows, stored, keys).filter(broken | clash).head(1)
        if found:
            key = {k: found[0][k] for k in keys}
            twice = on_duplicate == "fail" and (found[0]["rows"] > 1 or None in key.values())
            what = "key given more than once or NULL in a batch" if twice else "key already in the table"
            raise DuplicateKey(f"{what}: {key}")
    unchecked = target if on_conflict == "reject" else None
    if on_duplicate == "fail" and unchecked is None:
        return rows, rows.filter(F.lit(False)).withColumn("reject_reason", F.lit("duplicate_key"))
    outcomes = insert_outcomes(unchecked, rows, keys, order, limit=limit)
    fresh = outcomes.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return fresh, outcomes.filter(F.col("reject_reason").isNotNull())


def _touched(target: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """(rows of the table with one of the keys, the others). While the keys can be broadcast the table is
    scanned and only its touched rows are shuffled; else (the whole table, None)."""
    some = keyed.select(*keys).distinct()
    if not fits_broadcast(some):
        return target, None
    some = F.broadcast(some)
    return target.join(some, list(keys), "left_semi"), target.join(some, list(keys), "left_anti")


def update_by_key(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER
) -> DataFrame:
    """The table with the given columns of each matching key replaced; other keys change nothing.

    `updates` has `_present`, the names of the columns a row sets, so that a column can be set to NULL.
    Updates of a key run one after the other: of every column the last one that sets it counts. That is
    an aggregate, so a key with many updates is reduced before the shuffle.
    """
    values = [c for c in target.columns if c not in keys]
    at = F.struct(*[F.coalesce(F.col(c), F.lit(0)) for c in order if c in updates.columns] or [F.lit(0)])
    last = [
        F.max_by(F.struct(F.col(c).alias("v")), F.when(F.array_contains("_present", F.lit(c)), at)).alias(f"__{c}")
        for c in values
    ]
    touched, others = _touched(target, updates, keys)
    joined = touched.join(updates.groupBy(*keys).agg(*last), list(keys), "left")
    updated = joined.select(
        *[
            F.col(c)
            if c in keys
            else F.when(F.col(f"__{c}").isNotNull(), F.col(f"__{c}.v")).otherwise(F.col(c)).alias(c)
            for c in target.columns
        ]
    )
    return updated if others is None else updated.unionByName(others)


def delete_by_key(target: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table without the given keys."""
    gone = deletes.select(*keys).distinct()
    if fits_broadcast(gone):
        gone = F.broadcast(gone)
    return target.join(gone, list(keys), "left_anti")


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    *,
    order: Sequence[str] = ORDER,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The table after a mixed set of creates, updates and deletes, as if done one by one in order.

    A create on a live key is refused and changes nothing, an update on a dead key changes nothing, and a
    change whose key is NULL, or has a NULL part, changes nothing: `change_outcomes` reports it as `null_key`.
    What counts per key is the last delete, the first create after it, and per column the last update
    after that. So it takes one small aggregate for the deletes and one for the rest, both combined
    before their shuffle, and no sequence of a key is ever gathered.
    """
    keys = list(keys)
    values = [c for c in target.columns if c not in keys]
    known = F.col("_operation").isin(CREATE, UPDATE, DELETE) & ~_null_key(keys)
    rows = changes.filter(known).select(
        *keys,
        "_operation",
        F.struct(*order).alias("__at"),
        "_present",
        *[F.col(c).alias(f"__{c}") for c in values],
    )
    deletes = rows.filter(F.col("_operation") == DELETE).groupBy(*keys).agg(F.max("__at").alias("__deleted"))
    live = join_group_stats(rows, deletes, keys, how="left", limit=limit).filter(
        F.col("__deleted").isNull() | (F.col("__at") >= F.col("__deleted"))
    )
    create = F.when(F.col("_operation") == CREATE, F.col("__at"))

    def updated(column: str) -> Column:
        sets = (F.col("_operation") == UPDATE) & F.array_contains("_present", F.lit(column))
        return F.max_by(
            F.struct("__at", F.col(f"__{column}").alias("value")), F.when(sets, F.col("__at"))
        ).alias(f"__last_{column}")

    folded = live.groupBy(*keys).agg(
        F.max("__deleted").alias("__deleted"),
        F.min(create).alias("__created"),
        F.min_by(F.struct("__at", *[f"__{c}" for c in values]), create).alias("__row"),
        *[updated(c) for c in values],
    )
    touched, others = _touched(target, rows, keys)
    base = touched.select(*keys, *values, F.lit(True).alias("__stored"))
    both = base.join(folded, keys, "full_outer")
    kept = F.coalesce(F.col("__stored"), F.lit(False)) & F.col("__deleted").isNull()

    def result(column: str) -> Column:
        last = F.col(f"__last_{column}")
        after = last["__at"] > F.col("__created")
        return (
            F.when(kept, F.when(last.isNotNull(), last["value"]).otherwise(F.col(column)))
            .when(F.coalesce(after, F.lit(False)), last["value"])
            .otherwise(F.col("__row")[f"__{column}"])
        ).alias(column)

    alive = both.filter(kept | F.col("__created").isNotNull())
    changed = alive.select(*[F.col(c) if c in keys else result(c) for c in target.columns])
    return changed if others is None else changed.unionByName(others)


def change_outcomes(
    live: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    *,
    order: Sequence[str] = ORDER,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """All changes with `reject_reason`: `null_key`, `key_exists` for a create on a live key, else NULL.

    A key is live when the last create or delete before is a create (taken or refused, it leaves the
    key live), or when there is none and `live` has the key.
    """
    keys = list(keys)
    mark = F.when(F.col("_operation").isin(CREATE, DELETE), F.col("_operation"))
    rows = previous_value(changes, keys, list(order), mark, out="__previous", limit=limit)
    before = F.col("__previous") == CREATE
    if live is not None:
        rows = _with_flag(rows, live, keys, "__live")
        before = F.coalesce(before, F.col("__live"))
    refused = (F.col("_operation") == CREATE) & F.coalesce(before, F.lit(False))
    reason = F.when(_null_key(keys), "null_key").when(refused, "key_exists")
    return rows.withColumn("reject_reason", reason).select(*changes.columns, "reject_reason")


def live_keys(
    target: DataFrame | None,
    changes: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """The keys of `rows` that are live once `changes` have been applied to the table: their last create or
    delete is a create, or they have none and the table has them. Only the keys, operations and order of
    `changes` are read; no row is folded."""
    marks = changes.filter(F.col("_operation").isin(CREATE, DELETE)).select(*keys, "_operation", *order)
    own = rows.select(*keys).distinct()
    if fits_broadcast(own):
        own = F.broadcast(own)
    last = marks.join(own, list(keys), "left_semi").groupBy(*keys).agg(
        F.max_by("_operation", F.struct(*order)).alias("__last")
    )
    if target is None:
        return last.filter(F.col("__last") == CREATE).select(*keys)
    stored = existing_keys(rows, target, keys).distinct().withColumn("__last", F.lit(None).cast("int"))
    both = last.unionByName(stored).groupBy(*keys).agg(F.max("__last").alias("__last"))
    return both.filter(F.coalesce("__last", F.lit(CREATE)) == CREATE).select(*keys)


def change_conflicts(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    *,
    order: Sequence[str] = ORDER,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The creates on a live key: those `apply_changes` refuses."""
    creates = changes.filter(F.col("_operation") == CREATE)
    outcomes = change_outcomes(existing_keys(creates, target, keys), changes, keys, order=order, limit=limit)
    return outcomes.filter(F.col("reject_reason") == "key_exists").drop("reject_reason")


def batch_counts(changes: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Number of operations per batch, table and kind."""
    return changes.groupBy(batch, "record", "operation").agg(F.count(F.lit(1)).alias("operations"))
