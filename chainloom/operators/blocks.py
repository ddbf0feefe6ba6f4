"""Change records from block headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.contracts import CREATE
from chainloom.functions.hexes import hex_text
from chainloom.functions.typed import field, value

TIMESTAMP_FORM = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def change(record: str, id_column, ordinal, fields, operation=None):
    """A change record struct."""
    return F.struct(
        F.lit(record).alias("record"),
        id_column.alias("id"),
        ordinal.cast("bigint").alias("ordinal"),
        (F.lit(CREATE) if operation is None else operation).cast("int").alias("operation"),
        F.array(*fields).alias("fields"),
    )


def block_headers(blocks: DataFrame, table: str = "eth_blockheaders") -> DataFrame:
    """One CREATE per block: number, hash, parent hash and time, named by the block hash.

    `blocks` has block_num, hash, parent_hash (binary) and timestamp; block_id and cursor are kept.
    """
    kept = [c for c in ("block_num", "block_id", "cursor") if c in blocks.columns]
    block_hash = hex_text(F.col("hash"))
    header = change(
        table,
        block_hash,
        F.lit(0),
        [
            field("number", value(uint64=F.col("block_num"))),
            field("hash", value(string=block_hash)),
            field("parent_hash", value(string=hex_text(F.col("parent_hash")))),
            field("timestamp", value(string=F.date_format("timestamp", TIMESTAMP_FORM))),
        ],
    )
    return blocks.select(*kept, F.lit(0).alias("pos"), header.alias("change")).select(
        *kept, "pos", "change.*"
    )
