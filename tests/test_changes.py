import pytest
from pyspark.sql import functions as F

from chainloom.contracts import CHANGE, LENS_POSTS, contract
from chainloom.functions.typed import field, no_value, value
from chainloom.operators import changes

TABLE = contract("t", "id text, name text, amount integer", "id")
SHAPE = "block_num long, block_id string, cursor string, pos int," + ",".join(
    f"{f.name} {f.dataType.simpleString()}" for f in CHANGE.fields
)


def text(name, content):
    return field(name, value(string=F.lit(content)))


def record(spark, *fields, operation=1, table="t"):
    listed = F.array(*fields) if fields else F.array().cast(CHANGE["fields"].dataType)
    return spark.range(1).select(
        F.lit(7).cast("long").alias("block_num"),
        F.lit(0).alias("pos"),
        F.lit(table).alias("record"),
        F.lit("x").alias("id"),
        F.lit(3).cast("long").alias("ordinal"),
        F.lit(operation).alias("operation"),
        listed.alias("fields"),
    )


def row(frame, **options):
    return changes.fields_to_columns(frame, TABLE, algo="sha256", keep=(), **options).first()


def test_last_field_wins(spark):
    assert row(record(spark, text("name", "a"), text("name", "b")))["name"] == "b"


def test_field_named_like_the_key_replaces_it(spark):
    assert row(record(spark, text("id", "own")))["id"] == "own"
    assert len(row(record(spark, text("name", "a")))["id"]) == 64


def test_key_from_id(spark):
    assert row(record(spark), key="id")["id"] == "x"


def test_absent_columns_are_null(spark):
    got = row(record(spark))
    assert got["name"] is None and got["amount"] is None


def reason(frame):
    return changes.reject_invalid(frame).first()["reject_reason"]


@pytest.mark.parametrize(
    "operation, want",
    [
        (1, None),
        (0, "unsupported_operation"),
        (2, "unsupported_operation"),
        (3, "unsupported_operation"),
        (4, "invalid_operation"),
        (None, "invalid_operation"),
    ],
)
def test_operations(spark, operation, want):
    assert reason(record(spark, text("name", "a"), operation=operation)) == want


def test_bad_fields(spark):
    old = field("name", value(string=F.lit("a")), value(string=F.lit("b")))
    assert reason(record(spark, old)) == "old_value_given"
    assert reason(record(spark, field("name", no_value()))) == "new_value_missing"
    assert reason(record(spark, field("name", value()))) == "new_value_missing"
    assert reason(record(spark, field("name", value(array=F.array(F.lit("a")))))) == "array_value"
    assert reason(record(spark)) is None


def test_strict_raises(spark):
    tagged = changes.reject_invalid(record(spark, operation=9))
    with pytest.raises(Exception, match="invalid_operation"):
        changes.raise_rejects(tagged).collect()


def test_conform(spark):
    def conform(*fields):
        return changes.conform_to_contract(record(spark, *fields), TABLE).first()["reject_reason"]

    assert conform(text("name", "a")) is None
    assert conform(text("nope", "a"), text("also", "b")) == "unknown_column:also,nope"
    assert conform(text("amount", "a")) == "bad_value:amount"
    assert conform(field("amount", value(int32=F.lit(4)))) is None
    assert conform(field("amount", value(bytes=F.lit(b"4")))) == "bad_value:amount"


def test_typing_for_two_tables_is_refused(spark):
    typed = changes.conform_to_contract(record(spark), TABLE)
    with pytest.raises(ValueError):
        changes.fields_to_columns(typed, LENS_POSTS)


def test_route(spark):
    def route(table):
        return changes.route_by_table(record(spark, table=table), [TABLE]).first()["reject_reason"]

    assert route("t") is None
    assert route("u") == route(None) == "unknown_table"


def test_empty_block_keeps_its_cursor(spark):
    blocks = spark.range(2).select(
        F.col("id").alias("block_num"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("cursor"),
        F.array().cast(f"array<{CHANGE.simpleString()}>").alias("record_changes"),
    )
    flat = changes.explode_changes(blocks)
    assert [(r["cursor"], r["record"]) for r in flat.orderBy("block_num").collect()] == [
        ("c0", None),
        ("c1", None),
    ]


def test_unused_columns_are_not_typed(spark, tmp_path):
    record(spark, text("name", "a")).write.parquet(str(tmp_path / "r"))
    rows = changes.fields_to_columns(spark.read.parquet(str(tmp_path / "r")), TABLE, algo="sha256")
    plan = rows.select("_ordinal")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ordinal:bigint>" in plan
