import pytest
from pyspark.sql import types as T

from chainloom import contracts as c

TYPE_NAMES = """bool smallint int2 integer int4 bigint int8 float float4 double float8 numeric decimal text
varchar char tinytext mediumtext longtext binary tinyblob blob mediumblob longblob varbinary bit date
interval time timestamp""".split()


def test_thirty_type_names_in_any_case():
    assert sorted(c.TYPE_NAMES) == sorted(TYPE_NAMES) and len(TYPE_NAMES) == 30
    for name in TYPE_NAMES:
        assert c.type_name(name.upper()) == name


def test_catalog_spellings():
    assert c.type_name("timestamp without time zone") == "timestamp"
    assert c.type_name("character varying") == "varchar"
    assert c.type_name("boolean") == "bool"


@pytest.mark.parametrize("name", ["jsonb", "", "integer[]", "timestamptz"])
def test_unknown_type(name):
    with pytest.raises(c.ContractError):
        c.type_name(name)


def test_contract_needs_its_key():
    with pytest.raises(c.ContractError):
        c.contract("t", "a text", "b")
    with pytest.raises(c.ContractError):
        c.contract("t", "a text, a text", "a")
    assert c.contract("t", "a numeric(4)", "a").schema["a"].dataType == T.DecimalType(38, 4)


def test_cursor_contract():
    good = {"id": "text", "cursor": "text", "block_num": "bigint", "block_id": "text"}
    c.check_cursor_contract(good, ["id"])
    for bad in (
        {k: v for k, v in good.items() if k != "cursor"},
        {**good, "more": "text"},
        {**good, "block_num": "text"},
        {**good, "id": "bigint"},
    ):
        with pytest.raises(c.ContractError):
            c.check_cursor_contract(bad, ["id"])
    with pytest.raises(c.ContractError):
        c.check_cursor_contract(good, ["cursor"])


def test_check_schema():
    c.check_schema(c.BLOCK_META.schema, c.BLOCK_META)
    with pytest.raises(c.ContractError, match="missing"):
        c.check_schema(T.StructType(c.BLOCK_META.schema.fields[:-1]), c.BLOCK_META)
