"""Typed values: building them, turning one into a column, and strict parsing of text."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainloom.contracts import OFFCHAIN_REQUEST, VALUE, ContractError, type_name
from chainloom.contracts import Column as ContractColumn

# \z is the end of the text; $ would also match before a last line break.
INTEGER_TEXT = r"^[+-]?[0-9]+\z"
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
SPECIAL_FLOAT_TEXT = r"^[+-]?(?i)(inf|infinity|nan)\z"
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TIMESTAMP_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"
TIME_TEXT = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{1,9})?\z"

INT32_END = 2**31
UINT32_SPAN = 2**32
INT64_END = 2**63
UINT64_SPAN = 2**64


MEMBER_TYPES = {f.name: f.dataType.simpleString() for f in VALUE.fields}


def value(**member: Column) -> Column:
    """A value struct with the given alternative set, e.g. `value(string=F.col("name"))`."""
    unknown = set(member) - set(VALUE.fieldNames())
    if unknown:
        raise ContractError(f"no such value alternative: {sorted(unknown)}")
    return F.struct(
        *[member.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in MEMBER_TYPES.items()]
    )


def no_value() -> Column:
    return F.lit(None).cast(VALUE.simpleString())


def has_alternative(typed: Column) -> Column:
    """Whether some alternative of the value is set; false for a missing value."""
    return F.coalesce(*[F.when(typed[f.name].isNotNull(), True) for f in VALUE.fields], F.lit(False))


def offchain_request(uri: Column, handler: str, max_retries: int, wait_before_retry: int) -> Column:
    return F.struct(
        uri.alias("uri"),
        F.lit(handler).alias("handler"),
        F.lit(max_retries).alias("max_retries"),
        F.lit(wait_before_retry).alias("wait_before_retry"),
    ).cast(OFFCHAIN_REQUEST.simpleString())


def field(name: str, new_value: Column, old_value: Column | None = None) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        new_value.alias("new_value"),
        (no_value() if old_value is None else old_value).alias("old_value"),
    )


def _guarded(text: Column, pattern: str, kind: str) -> Column:
    return F.when(text.rlike(pattern), text.try_cast(kind))


def _decimal_text(text: Column, scale: int) -> Column:
    """DECIMAL(38, scale), NULL when the number needs more digits on either side."""
    fraction = F.rtrim(F.regexp_extract(text, r"\.([0-9]*)", 1), F.lit("0"))
    # A cast that fails is slow, so texts without an exponent do not try one.
    exponent = F.when(
        text.rlike("[eE]"), F.regexp_extract(text, r"[eE]([+-]?[0-9]+)$", 1).try_cast("int")
    ).otherwise(0)
    fits = F.length(fraction) - exponent <= scale
    return F.when(text.rlike(NUMBER_TEXT) & fits, text.try_cast(f"decimal(38,{scale})"))


def parse_text_value(text: Column, kind: str, scale: int = 18) -> Column:
    """`text` as a value of the named column type; NULL when it is not exactly one.

    Spark's own casts trim blanks, take `yes` and `1` as booleans and `1f` as a number, so the form
    is checked before the cast. No text is an interval.
    """
    kind = type_name(kind)
    if kind == "bool":
        return F.when(text == "true", True).when(text == "false", False)
    if kind in ("smallint", "int2"):
        return _guarded(text, INTEGER_TEXT, "smallint")
    if kind in ("integer", "int4"):
        return _guarded(text, INTEGER_TEXT, "int")
    if kind in ("bigint", "int8"):
        return _guarded(text, INTEGER_TEXT, "bigint")
    if kind in ("float", "float4", "double", "float8"):
        target = "float" if kind in ("float", "float4") else "double"
        # A sign before "nan" means nothing, and Spark does not read it.
        unsigned = F.when(text.rlike(r"^[+-](?i)nan\z"), F.lit("NaN")).otherwise(text)
        return F.when(
            text.rlike(NUMBER_TEXT) | text.rlike(SPECIAL_FLOAT_TEXT), unsigned.try_cast(target)
        )
    if kind in ("numeric", "decimal"):
        return _decimal_text(text, scale)
    if kind in ("text", "varchar", "char", "tinytext", "mediumtext", "longtext"):
        return text
    if kind in ("binary", "tinyblob", "blob", "mediumblob", "longblob", "varbinary", "bit"):
        return F.encode(text, "UTF-8")
    if kind == "date":
        return _guarded(text, DATE_TEXT, "date")
    if kind == "timestamp":
        return _guarded(text, TIMESTAMP_TEXT, "timestamp_ntz")
    if kind == "time":
        return F.when(text.rlike(TIME_TEXT), text)
    return F.lit(None).cast(T.StringType())


def _check_overflow(overflow: str) -> None:
    if overflow not in ("reject", "wrap"):
        raise ValueError("overflow is 'reject' or 'wrap'")


def narrow_uint32(number: Column, overflow: str = "reject") -> Column:
    """An unsigned 32-bit number that must fit 31 bits: NULL above, or wrapped to a negative number."""
    _check_overflow(overflow)
    fits = F.when((number >= 0) & (number < INT32_END), number)
    if overflow == "reject":
        return fits
    return fits.when((number >= INT32_END) & (number < UINT32_SPAN), number - UINT32_SPAN)


def narrow_uint64(number: Column, overflow: str = "reject") -> Column:
    """An unsigned 64-bit number that must fit 63 bits: NULL above, or wrapped to a negative number."""
    _check_overflow(overflow)
    end, span = F.lit(Decimal(INT64_END)), F.lit(Decimal(UINT64_SPAN))
    fits = F.when((number >= 0) & (number < end), number.try_cast("bigint"))
    if overflow == "reject":
        return fits
    return fits.when((number >= end) & (number < span), (number - span).try_cast("bigint"))


def canonical(typed: Column, overflow: str = "reject") -> Column:
    """A value as (kind, text, bytes), whatever its alternative.

    kind is number, text, bool, bytes, array, or NULL for no value. Numbers and booleans stand as
    their text, a link as its uri; text is NULL for a number out of range or no number at all.
    """
    numbers = [
        typed["int32"].cast("string"),
        narrow_uint32(typed["uint32"], overflow).cast("string"),
        typed["int64"].cast("string"),
        narrow_uint64(typed["uint64"], overflow).cast("string"),
        F.when(typed["bigdecimal"].rlike(NUMBER_TEXT), typed["bigdecimal"]),
        _guarded(typed["bigint"], INTEGER_TEXT, "bigint").cast("string"),
    ]
    is_text = typed["string"].isNotNull() | typed["offchaindata"].isNotNull()
    is_number = F.lit(False)
    for name in ("int32", "uint32", "int64", "uint64", "bigdecimal", "bigint"):
        is_number = is_number | typed[name].isNotNull()
    kind = (
        F.when(typed.isNull(), None)
        .when(is_text, "text")
        .when(is_number, "number")
        .when(typed["bool"].isNotNull(), "bool")
        .when(typed["bytes"].isNotNull(), "bytes")
        .when(typed["array"].isNotNull(), "array")
    )
    text = F.coalesce(
        typed["string"], typed["offchaindata"]["uri"], *numbers, typed["bool"].cast("string")
    )
    return F.struct(kind.alias("kind"), text.alias("text"), typed["bytes"].alias("bytes"))


def coerce_canonical(plain: Column, target: ContractColumn) -> Column:
    """A value in canonical form as a column of the contract's type; NULL when it cannot be one."""
    kind, text = plain["kind"], plain["text"]
    name = type_name(target.type)
    spark_type = target.spark_type
    if name in ("interval", "time"):
        return parse_text_value(text, name)
    if isinstance(spark_type, T.StringType):
        return text
    if isinstance(spark_type, T.BinaryType):
        return F.coalesce(plain["bytes"], F.when(kind == "text", parse_text_value(text, name)))
    if isinstance(spark_type, T.DecimalType):
        return parse_text_value(text, name, spark_type.scale)
    if isinstance(spark_type, (T.ShortType, T.IntegerType, T.LongType)):
        target_name = spark_type.simpleString()
        return F.when(text.rlike(INTEGER_TEXT), text.try_cast(target_name)).when(
            kind == "number", _decimal_text(text, 0).try_cast(target_name)
        )
    return parse_text_value(text, name)


def coerce_typed_value(typed: Column, target: ContractColumn, overflow: str = "reject") -> Column:
    """One typed value as a column of the contract's type; NULL when it cannot be one.

    Unsigned numbers follow `overflow`, texts of another type than the column's are parsed strictly,
    a link stands as its uri, an array never fits.
    """
    return coerce_canonical(canonical(typed, overflow), target)
