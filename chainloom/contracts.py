"""Table contracts: column types and key columns of the keyed tables, and the shape of a change record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Operation codes of a change record (fixed values).
UNSET, CREATE, UPDATE, DELETE = 0, 1, 2, 3

OFFCHAIN_REQUEST = T.StructType(
    [
        T.StructField("uri", T.StringType()),
        T.StructField("handler", T.StringType()),
        T.StructField("max_retries", T.IntegerType()),
        T.StructField("wait_before_retry", T.IntegerType()),
    ]
)

# One nullable member per alternative; exactly one is set.
VALUE = T.StructType(
    [
        T.StructField("int32", T.IntegerType()),
        T.StructField("uint32", T.LongType()),
        T.StructField("int64", T.LongType()),
        T.StructField("uint64", T.DecimalType(20, 0)),
        T.StructField("bigdecimal", T.StringType()),
        T.StructField("bigint", T.StringType()),
        T.StructField("string", T.StringType()),
        T.StructField("bytes", T.BinaryType()),
        T.StructField("bool", T.BooleanType()),
        T.StructField("array", T.ArrayType(T.StringType())),
        T.StructField("offchaindata", OFFCHAIN_REQUEST),
    ]
)

FIELD = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("new_value", VALUE),
        T.StructField("old_value", VALUE),
    ]
)

CHANGE = T.StructType(
    [
        T.StructField("record", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("operation", T.IntegerType()),
        T.StructField("fields", T.ArrayType(FIELD)),
    ]
)

# Column type names (fixed values) and the Spark type that stands for each. `time` has no
# Spark type that is on by default, so it stays text that was checked.
TYPE_NAMES: dict[str, T.DataType] = {
    "bool": T.BooleanType(),
    "smallint": T.ShortType(),
    "int2": T.ShortType(),
    "integer": T.IntegerType(),
    "int4": T.IntegerType(),
    "bigint": T.LongType(),
    "int8": T.LongType(),
    "float": T.FloatType(),
    "float4": T.FloatType(),
    "double": T.DoubleType(),
    "float8": T.DoubleType(),
    "numeric": T.DecimalType(38, 18),
    "decimal": T.DecimalType(38, 18),
    "text": T.StringType(),
    "varchar": T.StringType(),
    "char": T.StringType(),
    "tinytext": T.StringType(),
    "mediumtext": T.StringType(),
    "longtext": T.StringType(),
    "binary": T.BinaryType(),
    "tinyblob": T.BinaryType(),
    "blob": T.BinaryType(),
    "mediumblob": T.BinaryType(),
    "longblob": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "bit": T.BinaryType(),
    "date": T.DateType(),
    "interval": T.StringType(),
    "time": T.StringType(),
    "timestamp": T.TimestampNTZType(),
}

# Spellings a database catalog uses for some of them.
CATALOG_SPELLINGS = {
    "boolean": "bool",
    "real": "float4",
    "double precision": "float8",
    "character varying": "varchar",
    "character": "char",
    "bytea": "binary",
    "timestamp without time zone": "timestamp",
    "time without time zone": "time",
}


class ContractError(ValueError):
    """A table, column or type that does not fit its contract."""


def type_name(name: str) -> str:
    """The lower-case known type name for `name`, in either spelling."""
    lowered = name.strip().lower()
    lowered = CATALOG_SPELLINGS.get(lowered, lowered)
    if lowered not in TYPE_NAMES:
        raise ContractError(f"unknown column type: {name}")
    return lowered


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    scale: int | None = None

    @property
    def spark_type(self) -> T.DataType:
        kind = type_name(self.type)
        if kind in ("numeric", "decimal") and self.scale is not None:
            return T.DecimalType(38, self.scale)
        return TYPE_NAMES[kind]


@dataclass(frozen=True)
class Contract:
    """A keyed table: its name, its columns in order, and the columns of its key."""

    table: str
    columns: tuple[Column, ...]
    keys: tuple[str, ...]

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ContractError(f"{self.table}: column named twice")
        missing = [k for k in self.keys if k not in names]
        if missing or not self.keys:
            raise ContractError(f"{self.table}: key columns {missing or 'missing'}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type) for c in self.columns])


def contract(table: str, columns: str, keys: str) -> Contract:
    """`contract("t", "id text, amount numeric(2)", "id")`; a number in brackets is the scale of a decimal."""
    parsed = []
    for part in columns.split(","):
        name, kind = part.strip().split(" ", 1)
        scale = None
        if kind.endswith(")"):
            kind, digits = kind[:-1].split("(")
            scale = int(digits)
        parsed.append(Column(name, type_name(kind), scale))
    return Contract(table, tuple(parsed), tuple(k.strip() for k in keys.split(",")))


# Target tables (fixed values).
ETH_BLOCKHEADERS = contract(
    "eth_blockheaders",
    "id text, number integer, hash text, parent_hash text, timestamp text",
    "id",
)
LENS_POSTS = contract("lens_posts", "id text, profile_id text, content_uri text, timestamp bigint", "id")
LENS_POSTS_OFFCHAIN = contract(
    "lens_posts_offchain", "uri text, app_id text, name text, content text", "uri, app_id"
)
ETH_EVENTS = contract(
    "eth_events",
    "id text, blocknumber integer, blockhash text, txhash text, txindex integer, logindex integer,"
    "address text, topic0 text, topic1 text, topic2 text, topic3 text, topic4 text, data text,"
    "addressF text, commitment text, num_logs integer",
    "id",
)
BLOCK_META = contract(
    "block_meta", "id text, at text, number integer, hash text, parent_hash text, timestamp text", "id"
)
CURSORS = contract("cursors", "id text, cursor text, block_num bigint, block_id text", "id")
RESOLVER_TASKS = contract(
    "resolver_tasks",
    "uri text, manifest text, handler text, max_retries integer, wait_before_retry integer,"
    "num_retries integer, state integer, due_at timestamp",
    "uri, manifest",
)


def check_schema(schema: T.StructType, expected: Contract) -> None:
    """Raise unless `schema` has exactly the columns of the contract, each with its type."""
    given = {f.name: f.dataType for f in schema.fields}
    missing = [n for n in expected.names if n not in given]
    extra = [n for n in given if n not in expected.names]
    wrong = [
        f"{c.name} is {given[c.name].simpleString()}, not {c.spark_type.simpleString()}"
        for c in expected.columns
        if c.name in given and given[c.name] != c.spark_type
    ]
    if missing or extra or wrong:
        raise ContractError(f"{expected.table}: missing {missing}, extra {extra}, wrong {wrong}")


def check_cursor_contract(columns: dict[str, str], keys: list[str]) -> None:
    """The progress table must have its four columns with these types, and the key `id`."""
    wanted = {c.name: CURSORS.schema[c.name].dataType for c in CURSORS.columns}
    given = {name: TYPE_NAMES[type_name(kind)] for name, kind in columns.items()}
    if given != wanted:
        raise ContractError(f"progress table has columns {columns}")
    if list(keys) != list(CURSORS.keys):
        raise ContractError(f"progress table has key {keys}")
