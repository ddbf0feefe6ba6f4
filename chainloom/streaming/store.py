"""Batches of rows that appear together with their progress, or not at all.

A table is a folder with one subfolder per written batch, `batch=<n>/write=<id>`, read by Spark as a
partitioned Parquet table. A batch is written in two steps: the rows of every table, and last one
progress row with the cursor and the id of the write. Readers keep what a progress row names, so a write
that was never marked is never seen, whatever is committed after it. One writer per store.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainloom.contracts import CURSORS, Contract, check_schema
from chainloom.operators.keyed import apply_changes, live_keys
from chainloom.operators.progress import cursor_upsert
from chainloom.streaming.blooms import BLOOM, MOST_KEYS, bloom_rows, key_hash, may_hold

# One row per batch: who wrote it, in which write, and the cursor it reached, if it read blocks.
PROGRESS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("write", T.StringType()),
        *CURSORS.schema.fields,
    ]
)
CHANGE_COLUMNS = T.StructType(
    [
        T.StructField("_block_num", T.LongType()),
        T.StructField("_ordinal", T.LongType()),
        T.StructField("_pos", T.IntegerType()),
        T.StructField("_operation", T.IntegerType()),
        T.StructField("_present", T.ArrayType(T.StringType())),
    ]
)
BATCH_ORDER = ("batch", "_block_num", "_ordinal", "_pos")


@dataclass
class Source:
    """What a store knows about one writer of batches."""

    first_batch: int | None
    last_epoch: int


class BatchStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._last: int | None = None
        self._writes: dict[int, str] = {}
        self._sources: dict[str, Source] = {}
        self._opened: set[str] = set()
        self._newest: dict[str, int] = {}
        # One batch at a time, also where a run and the retries of its links are two streams.
        self.lock = threading.RLock()

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _all(self, table: str, schema: T.StructType) -> DataFrame | None:
        """All batches of a table, with or without progress, with their number; None without any."""
        place = [T.StructField("batch", T.LongType())]
        if table != CURSORS.table:
            place.append(T.StructField("write", T.StringType()))
        with_batch = T.StructType([*schema.fields, *place])
        try:
            return self.spark.read.schema(with_batch).parquet(self._path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def last_batch(self) -> int:
        """Number of the last committed batch, -1 without any; read once, then known to the writer."""
        if self._last is None:
            batches = self._all(CURSORS.table, PROGRESS)
            row = None if batches is None else batches.agg(F.max("batch").alias("last")).first()
            self._last = -1 if row is None or row["last"] is None else int(row["last"])
        return self._last

    def source(self, name: str) -> Source:
        """The first batch and the last epoch of a source; read once per source."""
        if name not in self._sources:
            known = Source(None, -1)
            if self.last_batch() >= 0:
                own = self.read(CURSORS.table, PROGRESS).filter(F.col("source") == name)
                row = own.agg(F.min("batch").alias("first"), F.max("epoch").alias("epoch")).first()
                if row["first"] is not None:
                    known = Source(int(row["first"]), int(row["epoch"]))
            self._sources[name] = known
        return self._sources[name]

    def has(self, source: str, epoch: int) -> bool:
        """Whether this batch of a source has been committed before; epochs of a source only grow."""
        return epoch <= self.source(source).last_epoch

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """The committed rows, with the number of their batch."""
        batches = self._all(table, schema) if self.last_batch() >= 0 else None
        if batches is None:
            return self.spark.createDataFrame(
                [], T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
            )
        committed = batches.filter(F.col("batch") <= self.last_batch())
        if table == CURSORS.table:
            return committed
        marks = self.read(CURSORS.table, PROGRESS).select("batch", "write")
        return committed.join(marks, ["batch", "write"], "left_semi").drop("write")

    def newest(self, table: str, schema: T.StructType) -> DataFrame:
        """The rows of the last batch that wrote a table: for tables that each batch writes whole."""
        rows = self.read(table, schema)
        if table not in self._newest:
            last = rows.agg(F.max("batch")).first()[0]
            self._newest[table] = -1 if last is None else last
        return rows.filter(F.col("batch") == self._newest[table]).drop("batch")

    def has_rows(self, table: str) -> bool:
        """Whether any batch of this table may be committed."""
        return self.last_batch() >= 0 and self._all(table, T.StructType([])) is not None

    def _check(self, table: str, contract: Contract, others: Sequence[str] = ()) -> None:
        """When a stored table is first opened: it has the columns of its contract, or an error is raised."""
        if table in self._opened or not self.has_rows(table):
            return
        stored = self.spark.read.parquet(self._path(table)).schema
        own = T.StructType([f for f in stored if f.name not in ("batch", "write", *others)])
        check_schema(own, contract)
        self._opened.add(table)

    def rows(self, contract: Contract) -> DataFrame:
        """The committed rows of a keyed table."""
        self._check(contract.table, contract)
        return self.read(contract.table, contract.schema).select(*contract.names)

    def rows_near(self, contract: Contract, keyed: DataFrame) -> DataFrame:
        """The committed rows of the batches that may have one of the keys of `keyed`: all rows with such a key,
        and few others. The filters of the batches are read, and then only the folders that they name; with more
        than a hundred thousand keys, all rows."""
        hashes = keyed.select(key_hash(contract.keys)).distinct().limit(MOST_KEYS + 1).collect()
        if len(hashes) > MOST_KEYS or not self.has_rows(f"{contract.table}_blooms"):
            return self.rows(contract)
        self._check(contract.table, contract)
        blooms = self.read(f"{contract.table}_blooms", BLOOM)
        near = may_hold(blooms, [r[0] for r in hashes])
        first = blooms.agg(F.min("batch")).first()[0]
        place = F.col("batch").isin(near) if near else F.lit(False)
        # Batches from before there were filters have none.
        place = place if first is None else place | (F.col("batch") < first)
        return self.read(contract.table, contract.schema).filter(place).select(*contract.names)

    def progress(self, before: str | None = None) -> DataFrame:
        """The furthest cursor per run; with `before`, as it was ahead of the first batch of a source."""
        cursors = self.read(CURSORS.table, PROGRESS).filter(F.col("id").isNotNull())
        if before is not None and self.source(before).first_batch is not None:
            cursors = cursors.filter(F.col("batch") < self.source(before).first_batch)
        return cursor_upsert(None, cursors)

    def _changes(self, contract: Contract) -> tuple[DataFrame | None, DataFrame]:
        """(the rows of the last version of a table, the changes after it); None without any rows.

        Batch numbers are folders, so changes that a version has taken in are not read."""
        self._check(f"{contract.table}_changes", contract, CHANGE_COLUMNS.names)
        schema = T.StructType([*CHANGE_COLUMNS.fields, *contract.schema.fields])
        changes = self.read(f"{contract.table}_changes", schema)
        version = self.source(f"version:{contract.table}").last_epoch
        if version >= 0:
            rows = self.read(f"{contract.table}_version", contract.schema)
            base = rows.filter(F.col("batch") == version).select(*contract.names)
            return base, changes.filter(F.col("batch") > version)
        return (self.rows(contract) if self.has_rows(contract.table) else None), changes

    def folded(self, contract: Contract) -> DataFrame:
        """A keyed table kept as a list of changes, with all of them applied."""
        base, changes = self._changes(contract)
        table = self.rows(contract) if base is None else base
        return apply_changes(table, changes, contract.keys, order=BATCH_ORDER)

    def live_keys(self, contract: Contract, rows: DataFrame) -> DataFrame:
        """The keys of `rows` that a table kept as changes has."""
        base, changes = self._changes(contract)
        return live_keys(base, changes, rows, contract.keys, BATCH_ORDER)

    def compact(self, contract: Contract) -> int:
        """Write the folded table as a version of its own, in a batch; later reads start from it."""
        batch = self.last_batch() + 1
        rows = self.folded(contract)
        return self.commit({f"{contract.table}_version": rows}, None, f"version:{contract.table}", batch)

    def write(self, tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None) -> int:
        """Write the rows of the next batch, not yet visible, with filters of the keys of the tables in `keys`."""
        batch = self.last_batch() + 1
        self._writes[batch] = uuid.uuid4().hex
        filters = {f"{table}_blooms": bloom_rows(tables[table], own) for table, own in (keys or {}).items()}
        for table, rows in (*tables.items(), *filters.items()):
            rows.write.parquet(f"{self._path(table)}/batch={batch}/write={self._writes[batch]}")
        return batch

    def mark(self, batch: int, source: str, epoch: int, cursors: DataFrame | None) -> None:
        """Make a written batch visible: one file with one progress row."""
        if cursors is None:
            row = self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in CURSORS.schema])
        else:
            row = cursors.select(*CURSORS.names)
        stamped = row.select(
            F.lit(source).alias("source"),
            F.lit(epoch).cast("bigint").alias("epoch"),
            F.lit(self._writes.pop(batch)).alias("write"),
            *CURSORS.names,
        )
        stamped.coalesce(1).write.mode("overwrite").parquet(
            f"{self._path(CURSORS.table)}/batch={batch}"
        )
        known = self.source(source)
        first = batch if known.first_batch is None else known.first_batch
        self._sources[source] = Source(first, epoch)
        self._last = batch

    def commit(
        self,
        tables: Mapping[str, DataFrame],
        cursors: DataFrame | None,
        source: str,
        epoch: int,
        keys: Mapping[str, Sequence[str]] | None = None,
    ) -> int:
        """Write a batch and make it visible. `cursors` has one row, empty when no block was read."""
        self.source(source)
        batch = self.write(tables, keys)
        self.mark(batch, source, epoch, cursors)
        self._newest.update({table: batch for table in tables if table in self._newest})
        return batch
