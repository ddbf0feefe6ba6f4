"""From change records to typed rows: routing, keys, checks and columns.

Change frames have the columns block_num, block_id, cursor, pos and those of a change record
(record, id, ordinal, operation, fields). Checks never drop a row: they fill `reject_reason`, and
`split_rejects` separates the frames.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainloom.contracts import CREATE, DELETE, UNSET, UPDATE, Contract
from chainloom.contracts import Column as ContractColumn
from chainloom.functions.binding import bind
from chainloom.functions.typed import canonical, coerce_canonical, has_alternative

# Text that is hashed into a row key (fixed value).
ROW_KEY_LABEL = "bin.node.cli.PRIMARY_KEY_INSERT_INTO"

ORDER = ("block_num", "ordinal", "pos")


class RejectedRecords(ValueError):
    """Records that break a rule while rules are strict."""


def explode_changes(blocks: DataFrame) -> DataFrame:
    """One row per change record of each block, in list order; a block without changes keeps one
    row with an empty record, so that its cursor is not lost."""
    clock = [c for c in blocks.columns if c != "record_changes"]
    flat = blocks.select(*clock, F.posexplode_outer("record_changes").alias("pos", "change"))
    return flat.select(*clock, "pos", "change.*")


def with_reason(changes: DataFrame, reason: Column) -> DataFrame:
    """Set `reject_reason` where it is still empty and `reason` is not NULL."""
    if "reject_reason" in changes.columns:
        return changes.withColumn("reject_reason", F.coalesce(F.col("reject_reason"), reason))
    return changes.withColumn("reject_reason", reason.cast("string"))


def split_rejects(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects)."""
    valid = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, tagged.filter(F.col("reject_reason").isNotNull())


def raise_rejects(tagged: DataFrame) -> DataFrame:
    """The strict form: the job fails on the first row with a reason."""
    checked = F.when(
        F.col("reject_reason").isNotNull(),
        F.raise_error(F.concat(F.lit("rejected record: "), F.col("reject_reason"))),
    )
    return tagged.withColumn("reject_reason", checked.cast("string")).filter(
        F.col("reject_reason").isNull()
    ).drop("reject_reason")


def route_by_table(changes: DataFrame, contracts: Sequence[Contract]) -> DataFrame:
    """Tag records of a table that has no contract.

    The contracts are part of the program, so the lookup is a literal list, not a join.
    """
    known = F.col("record").isin([c.table for c in contracts])
    return with_reason(changes, F.when(~F.coalesce(known, F.lit(False)), F.lit("unknown_table")))


def rows_for(changes: DataFrame, contract: Contract) -> DataFrame:
    """The records of one table."""
    return changes.filter(F.col("record") == contract.table)


def _blake2s_hex(labels: Column) -> Column:
    # Defined here so that it travels to the executors by value.
    def digest(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda text: hashlib.blake2s(text.encode()).hexdigest(), na_action="ignore"
        )

    return F.pandas_udf(digest, T.StringType())(labels)


def derive_row_key(id_column: Column, ordinal: Column, algo: str = "blake2s") -> Column:
    """The key of a record: hash of its id and ordinal, in lower-case hex.

    `blake2s` gives the customary keys and runs in Arrow batches; `sha256` stays in the JVM.
    """
    label = F.concat(
        F.lit(ROW_KEY_LABEL + "<"), id_column, F.lit("_"), ordinal.cast("string"), F.lit(">")
    )
    if algo == "blake2s":
        return _blake2s_hex(label)
    if algo == "sha256":
        return F.sha2(label, 256)
    raise ValueError("algo is 'blake2s' or 'sha256'")


def reject_invalid(changes: DataFrame, operations: Sequence[int] = (CREATE,)) -> DataFrame:
    """Tag records that cannot be written.

    In this order: an operation outside the enum, an operation that is not accepted, a field with an
    old value, a field without a new value, a field with an array. A value with no alternative set
    stands for NULL, which an update may give and a create may not.
    """
    operation = F.col("operation")
    known = F.coalesce(operation.isin(UNSET, CREATE, UPDATE, DELETE), F.lit(False))
    accepted = operation.isin(list(operations))

    def flaw(f: Column) -> Column:
        new = f["new_value"]
        return (
            F.when(f["old_value"].isNotNull(), "old")
            .when(new.isNull() | ((operation == CREATE) & ~has_alternative(new)), "missing")
            .when(new["array"].isNotNull(), "array")
        )

    def some(name: str) -> Column:
        return F.coalesce(F.array_contains("__flaws", F.lit(name)), F.lit(False))

    flaws = F.coalesce(F.transform("fields", flaw), F.array().cast("array<string>"))
    reason = (
        F.when(~known, F.lit("invalid_operation"))
        .when(~accepted, F.lit("unsupported_operation"))
        .when(some("old"), F.lit("old_value_given"))
        .when(some("missing"), F.lit("new_value_missing"))
        .when(some("array"), F.lit("array_value"))
        .when(F.col("ordinal") < 0, F.lit("ordinal_out_of_range"))
    )
    return with_reason(bind(changes, __flaws=flaws), reason).drop("__flaws")


def last_field(name: str) -> Column:
    """The last field of this name; NULL if there is none."""
    return F.try_element_at(F.filter("fields", lambda f: f["name"] == name), F.lit(-1))


def given_fields(changes: DataFrame, contract: Contract, overflow: str = "reject") -> DataFrame:
    """Add `_given`: per contract column the last field of its name, in canonical form."""
    # Reversed, so that the first field found is the last one given.
    listed = changes.withColumns(
        {
            "__names": F.reverse(F.transform("fields", lambda f: f["name"])),
            "__values": F.reverse(F.transform("fields", lambda f: canonical(f["new_value"], overflow))),
        }
    )
    given = F.struct(
        *[
            F.get("__values", (F.array_position("__names", c.name) - 1).cast("int")).alias(c.name)
            for c in contract.columns
        ]
    )
    return listed.withColumn("_given", given).drop("__names", "__values")


def _typed_column(column: ContractColumn) -> Column:
    return coerce_canonical(F.col("_given")[column.name], column)


def type_fields(changes: DataFrame, contract: Contract, overflow: str = "reject") -> DataFrame:
    """Add `_given` and `_typed`: the fields as they came and as the columns' types. The typed values
    are bound, since a check and the row itself both use them."""
    typed = F.struct(*[_typed_column(c).alias(c.name) for c in contract.columns])
    return bind(given_fields(changes, contract, overflow), _typed=typed)


def conform_to_contract(changes: DataFrame, contract: Contract, overflow: str = "reject") -> DataFrame:
    """Tag records with a field that the table does not have, or a value its column cannot hold."""
    names = F.transform(F.col("fields"), lambda f: f["name"])
    unknown = F.array_sort(F.array_except(names, F.array(*[F.lit(n) for n in contract.names])))
    reason = F.when(
        F.size(unknown) > 0, F.concat(F.lit("unknown_column:"), F.array_join(unknown, ","))
    )
    for column in contract.columns:
        given, typed = F.col("_given")[column.name], F.col("_typed")[column.name]
        reason = reason.when(
            given["kind"].isNotNull() & typed.isNull(), F.lit(f"bad_value:{column.name}")
        )
    return with_reason(type_fields(changes, contract, overflow), reason)


def fields_to_columns(
    changes: DataFrame,
    contract: Contract,
    *,
    key: str = "derived",
    algo: str = "blake2s",
    overflow: str = "reject",
    keep: Sequence[str] = (*ORDER, "operation"),
    present: bool = False,
    requests: bool = False,
) -> DataFrame:
    """One row of the table per record, without a shuffle.

    The last field of a name wins, also over the key. The first key column holds the derived key, or
    with `key="id"` the id of the record. `present` adds the list of columns the record gives, so
    that an update to NULL differs from no update; `requests` the list of links to be fetched.
    """
    if key == "derived":
        own_key = derive_row_key(F.col("id"), F.col("ordinal"), algo)
    elif key == "id":
        own_key = F.col("id")
    else:
        raise ValueError("key is 'derived' or 'id'")
    checked = "_typed" in changes.columns
    if checked and changes.schema["_typed"].dataType.fieldNames() != contract.names:
        raise ValueError(f"records were typed for another table than {contract.table}")
    source = changes if checked else given_fields(changes, contract, overflow)
    source = source.withColumn("__key", own_key)
    columns = []
    for column in contract.columns:
        # Without a check before, each column is typed on its own and can be pruned.
        typed = F.col("_typed")[column.name] if checked else _typed_column(column)
        if column.name == contract.keys[0]:
            typed = F.coalesce(typed, F.col("__key").try_cast(column.spark_type))
        columns.append(typed.alias(column.name))
    extra = [F.col(k).alias(f"_{k}") for k in keep]
    if present:
        extra.append(F.transform("fields", lambda f: f["name"]).alias("_present"))
    if requests:
        extra.append(link_requests().alias("_requests"))
    return source.select(*extra, *columns)


def link_requests() -> Column:
    """The links among the fields of a record."""
    return F.filter(
        F.transform("fields", lambda f: f["new_value"]["offchaindata"]), lambda r: r.isNotNull()
    )


def extract_offchain_requests(changes: DataFrame, manifest: str) -> DataFrame:
    """One task per link-valued field, with no retries yet."""
    return request_tasks(changes.withColumn("_requests", link_requests()), manifest, ORDER)


def request_tasks(rows: DataFrame, manifest: str, order: Sequence[str]) -> DataFrame:
    """The tasks in `_requests`, with the place of their record."""
    placed = rows.select(
        *[F.col(c).alias(name) for c, name in zip(order, ORDER)],
        F.explode("_requests").alias("request"),
    )
    return placed.select(
        *ORDER,
        F.col("request.uri").alias("uri"),
        F.lit(manifest).alias("manifest"),
        F.col("request.handler").alias("handler"),
        F.col("request.max_retries").alias("max_retries"),
        F.col("request.wait_before_retry").alias("wait_before_retry"),
        F.lit(0).alias("num_retries"),
    )
