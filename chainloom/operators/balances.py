"""Account balances: the last one per address, and every change as an insert or an update.

Balance frames have block_num, end_ordinal, pos, address and new_value (big-endian bytes, NULL = 0).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chainloom.functions.hexes import bytes_to_word, hex_text, word_to_text
from chainloom.contracts import CREATE, UPDATE
from chainloom.functions.skew import GROUP_LIMIT, fits_broadcast, join_group_stats, join_same
from chainloom.functions.typed import field, value
from chainloom.operators.blocks import change
from chainloom.operators.stores import StoreReader

ADDRESS_LABEL = "Address:"


def explode_balance_changes(blocks: DataFrame) -> DataFrame:
    """One row per balance change of nested blocks, in the shape of a balance frame. No shuffle.

    `blocks` has block_num and transactions: an array of end_ordinal and calls (balance_changes: address,
    new_value). Failed transactions count as well, since they pay too. `pos` numbers the changes of a
    transaction over its calls; what is empty or NULL gives no row.
    """
    traces = blocks.select("block_num", F.explode("transactions").alias("__tx"))
    changed = F.flatten(
        F.filter(F.transform("__tx.calls", lambda call: call["balance_changes"]), lambda found: found.isNotNull())
    )
    rows = traces.select("block_num", "__tx.end_ordinal", F.posexplode(changed).alias("pos", "__change"))
    return rows.select("block_num", "end_ordinal", "pos", "__change.address", "__change.new_value")


def balance_latest(balances: DataFrame) -> DataFrame:
    """key and balance: the last balance of each address. One aggregate, combined before the shuffle."""
    last = balances.groupBy("address").agg(
        F.max_by(
            bytes_to_word(F.col("new_value")), F.struct("block_num", "end_ordinal", "pos")
        ).alias("word")
    )
    return last.select(
        F.concat(F.lit(ADDRESS_LABEL), hex_text(F.col("address"))).alias("key"),
        word_to_text(F.col("word")).alias("balance"),
    )


def balance_deltas(balances: DataFrame) -> DataFrame:
    """Balances as the deltas of a store: the new balance is set under the account's label."""
    return balances.select(
        "block_num",
        F.col("end_ordinal").cast("bigint").alias("ordinal"),
        "pos",
        F.concat(F.lit(ADDRESS_LABEL), hex_text(F.col("address"))).alias("key"),
        word_to_text(bytes_to_word(F.col("new_value"))).alias("value"),
    )


def balance_records(balances: DataFrame, stores: Mapping[str, StoreReader], table: str = "balances") -> DataFrame:
    """Every change as a change record: CREATE where the store has no balance of the account yet, else UPDATE."""
    rows = balance_deltas(balances)
    account = F.substring("key", len(ADDRESS_LABEL) + 1, 64)
    known = stores["store_balance"].get_before(rows, "key", out="known")
    operation = F.when(F.col("known").isNull(), CREATE).otherwise(UPDATE)
    fields = [field("account", value(string=account)), field("balance", value(string=F.col("value")))]
    record = change(table, account, F.col("ordinal"), fields, operation)
    return known.select("block_num", "pos", record.alias("change")).select("block_num", "pos", "change.*")


def first_blocks(balances: DataFrame) -> DataFrame:
    """The first block of each address: the state a later batch passes as `known`."""
    return balances.groupBy("address").agg(F.min("block_num").alias("first_block"))


def balance_changes(
    balances: DataFrame, known: DataFrame | None = None, *, limit: int = GROUP_LIMIT
) -> DataFrame:
    """Every change as Insert while its address was unknown before its block, else Update.

    `known` (address, first_block) holds the addresses of earlier batches. Changes without an address
    are those of one account, whose key is NULL.
    """
    first = first_blocks(balances)
    if known is not None:
        # The known addresses are the large side: they are scanned, not shuffled, while a batch is small.
        addresses = first.select("address")
        if fits_broadcast(addresses):
            addresses = F.broadcast(addresses)
        earlier = join_same(known.select("address", "first_block"), addresses, ["address"], "left_semi")
        first = first.unionByName(earlier).groupBy("address").agg(
            F.min("first_block").alias("first_block")
        )
    joined = join_group_stats(balances, first, ["address"], limit=limit)
    return _typed(joined)


def _typed(joined: DataFrame) -> DataFrame:
    """Balances with the first block of their address as inserts and updates."""
    account = F.col("__account")
    balance = word_to_text(F.col("__word"))
    words = joined.withColumns(
        {"__account": hex_text(F.col("address")), "__word": bytes_to_word(F.col("new_value"))}
    )
    return words.select(
        "block_num",
        F.col("end_ordinal").alias("ordinal"),
        "pos",
        account.alias("key"),
        F.when(F.col("first_block").eqNullSafe(F.col("block_num")), "Insert").otherwise("Update").alias("type"),
        F.to_json(F.struct(account.alias("account"), balance.alias("balance"))).alias("value"),
    )


# Numbers that are missing, while rows pass through pandas, which has no whole numbers that may be missing.
NO_BLOCK, NO_PLACE = 2**63 - 1, -1
SEEN = "address binary, block_num long, end_ordinal long, pos int, new_value binary, first_block long"


def with_first_blocks(balances: DataFrame) -> DataFrame:
    """A stream of balances, each with the first block of its address so far: kept per address in Spark's state
    store, 8 bytes each, and not read again with every batch."""
    def first_block_state(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """The rows of an address in a batch, a part at a time. Only rows of the least block so far wait for the end of
        the batch, since a row of an earlier block may follow; all others are updates whatever comes."""
        first = state.get[0] if state.exists else None
        waiting: list[pd.DataFrame] = []

        def out(part: pd.DataFrame, least: int) -> pd.DataFrame:
            return part.assign(first_block=least)

        for part in parts:
            low = int(part["block_num"].min())
            if first is None or low < first:
                for held in waiting:
                    yield out(held, low)
                first, waiting = low, []
            here = part["block_num"] == first
            if (~here).any():
                yield out(part[~here], first)
            if here.any():
                waiting.append(part[here])
        for held in waiting:
            yield out(held, first)
        if first is not None:
            state.update((first,))

    placed = balances.select(
        "address",
        F.coalesce("block_num", F.lit(NO_BLOCK)).alias("block_num"),
        F.coalesce("end_ordinal", F.lit(NO_PLACE)).cast("long").alias("end_ordinal"),
        F.coalesce("pos", F.lit(NO_PLACE)).cast("int").alias("pos"),
        "new_value",
    )
    seen = placed.groupBy("address").applyInPandasWithState(
        first_block_state, SEEN, "first_block long", "append", GroupStateTimeout.NoTimeout
    )
    return seen.withColumns(
        {
            "block_num": F.nullif("block_num", F.lit(NO_BLOCK)),
            "end_ordinal": F.nullif("end_ordinal", F.lit(NO_PLACE).cast("long")),
            "pos": F.nullif("pos", F.lit(NO_PLACE)),
            "first_block": F.nullif("first_block", F.lit(NO_BLOCK)),
        }
    )


def typed_balances(seen: DataFrame) -> DataFrame:
    """The rows of `balance_changes` from balances with the first block of their address."""
    return _typed(seen)
