import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chainloom.contracts import Column
from chainloom.functions.typed import coerce_typed_value, parse_text_value, value

GOOD = [
    (["smallint", "int2", "integer", "int4", "bigint", "int8"], "10", 10),
    (["smallint"], "-32768", -32768),
    (["integer"], "+7", 7),
    (["double", "float8"], "17.0625001", 17.0625001),
    (["double"], ".5", 0.5),
    (["double"], "5.", 5.0),
    (["double"], "-inf", float("-inf")),
    (["numeric", "decimal"], "17.0625001", Decimal("17.062500100000000000")),
    (["numeric"], "12e2", Decimal("1200")),
    (["text", "varchar", "char", "mediumtext", "tinytext", "longtext"], "plain words", "plain words"),
    (["binary", "tinyblob", "blob", "mediumblob", "longblob", "varbinary", "bit"], "é", b"\xc3\xa9"),
    (["date"], "2023-01-01", dt.date(2023, 1, 1)),
    (["time"], "23:59:59", "23:59:59"),
    (["timestamp"], "2023-01-01 23:59:59", dt.datetime(2023, 1, 1, 23, 59, 59)),
    (["bool"], "true", True),
    (["bool"], "false", False),
]
BAD = [
    ("integer", " 10"),
    ("integer", "10 "),
    ("integer", "1.5"),
    ("integer", ""),
    ("integer", "10\n"),
    ("integer", "2147483648"),
    ("smallint", "40000"),
    ("bigint", "9223372036854775808"),
    ("bool", "yes"),
    ("bool", "1"),
    ("bool", "TRUE"),
    ("float", "1f"),
    ("double", "1d"),
    ("double", " 1"),
    ("double", "."),
    ("numeric", "1.2.3"),
    ("numeric", "1" * 39),
    ("numeric", "0." + "1" * 19),
    ("date", "2023-1-1"),
    ("date", "2023-02-30"),
    ("date", "2023-01-01 00:00:00"),
    ("timestamp", "2023-01-01T23:59:59"),
    ("timestamp", "2023-01-01 23:59:59.5"),
    ("timestamp", "2023-01-01"),
    ("timestamp", "2023-01-01 25:00:00"),
    ("time", "24:00:00"),
    ("time", "1:00:00"),
    ("interval", "1 day"),
]


def parse(spark, pairs):
    row = spark.range(1).select(
        *[parse_text_value(F.lit(t), k).alias(f"c{i}") for i, (k, t) in enumerate(pairs)]
    )
    return list(row.first())


def test_good_texts(spark):
    pairs = [(k, text) for kinds, text, _ in GOOD for k in kinds]
    wanted = [want for kinds, _, want in GOOD for _ in kinds]
    assert parse(spark, pairs) == wanted


def test_float_is_32_bit(spark):
    (got,) = parse(spark, [("float4", "17.0625001")])
    assert abs(got - 17.0625001) < 1e-6 and got != 17.0625001


def test_bad_texts(spark):
    assert parse(spark, BAD) == [None] * len(BAD)


def coerce(spark, member, kind, scale=None, overflow="reject"):
    frame = spark.range(1).select(value(**member).alias("v"))
    return frame.select(coerce_typed_value(F.col("v"), Column("c", kind, scale), overflow)).first()[0]


@pytest.mark.parametrize(
    "member, kind, overflow, want",
    [
        ({"uint32": 2**31}, "integer", "reject", None),
        ({"uint32": 2**31}, "integer", "wrap", -(2**31)),
        ({"uint32": 2**32 - 1}, "integer", "wrap", -1),
        ({"uint64": Decimal(2**63)}, "bigint", "reject", None),
        ({"uint64": Decimal(2**63)}, "bigint", "wrap", -(2**63)),
        ({"uint64": Decimal(2**63 - 1)}, "bigint", "reject", 2**63 - 1),
        ({"uint64": Decimal(2**31)}, "integer", "reject", None),
        ({"bigint": "9223372036854775808"}, "bigint", "reject", None),
        ({"bigint": "-5"}, "bigint", "reject", -5),
        ({"bigdecimal": "5.00"}, "integer", "reject", 5),
        ({"bigdecimal": "5.01"}, "integer", "reject", None),
        ({"string": "5.00"}, "integer", "reject", None),
        ({"string": "x"}, "text", "reject", "x"),
        ({"bool": True}, "bool", "reject", True),
        ({"bool": True}, "integer", "reject", None),
        ({"int32": 1}, "bool", "reject", None),
        ({"int32": 1}, "text", "reject", "1"),
        ({"int32": 1}, "binary", "reject", None),
    ],
)
def test_coerce(spark, member, kind, overflow, want):
    given = {k: F.lit(v) for k, v in member.items()}
    assert coerce(spark, given, kind, overflow=overflow) == want


def test_coerce_array_never_fits(spark):
    assert coerce(spark, {"array": F.array(F.lit("a"))}, "text") is None


def test_coerce_link_is_its_uri(spark):
    link = F.struct(F.lit("ar://x"), F.lit("h"), F.lit(1), F.lit(1))
    assert coerce(spark, {"offchaindata": link}, "text") == "ar://x"
