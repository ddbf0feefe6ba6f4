"""The registered queries over the given tables, each with equivalent SQL where SQL can express it."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.contracts import CREATE, DELETE, ETH_BLOCKHEADERS, LENS_POSTS, UPDATE, contract
from chainloom.contracts import Column as ContractColumn
from chainloom.functions.binding import bind
from chainloom.functions.hexes import FIELD_DIGITS, FIELD_PRIME, LIMB
from chainloom.functions.posts_json import RECORDS
from chainloom.functions.skew import ensure_checkpoint_dir
from chainloom.functions.typed import (
    canonical,
    coerce_canonical,
    field,
    offchain_request,
    parse_text_value,
    value,
)
from chainloom.operators import balances, blocks, changes, keyed, links, logs, progress
from chainloom.plans.ingest import (
    BALANCE_CHANGES,
    REJECTS,
    Enrichment,
    IngestJob,
    current_tasks,
    resolve_all,
    run_batch,
)
from chainloom.sources import shapes
from chainloom.sources.blocks import block_range_scan, final_blocks, read_blocks, stream_blocks, write_blocks
from chainloom.sources.forks import Links
from chainloom.streaming.runs import run_stream, stream_balances
from chainloom.operators.stores import StoreReader, store_values
from chainloom.streaming.store import BatchStore

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

NOW = "2024-02-01 00:00:00"
RANGE_SPLIT = 1000
BUCKET_WIDTH = 1500
FINAL_DEPTH = 12
PAGE_SIZE_LIMIT = 20_000
GATEWAY = "http://localhost:5001"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


# Parts of SQL that several queries share.
OPERATION_SQL = """case when event_type in ('signup', 'view') then 1
     when event_type in ('click', 'purchase') then 2 else 3 end"""
MONEY_SQL = "value::decimal(18,2)::varchar"
SHA_BLOCK = "sha256((event_id // 100)::varchar)"


# Sources


@query(
    "block_range_scan",
    f"""select o_orderkey as block_num, sha256(o_orderkey::varchar) as block_id,
       case when o_orderkey < {RANGE_SPLIT} then 'lower' else 'upper' end as part
from orders""",
)
def q_block_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_blocks = shapes.blocks(spark, sf_dir).select("block_num", "block_id")
    lower = block_range_scan(all_blocks, 0, RANGE_SPLIT).withColumn("part", F.lit("lower"))
    upper = block_range_scan(all_blocks, RANGE_SPLIT, 0).withColumn("part", F.lit("upper"))
    return lower.unionByName(upper)


@query(
    "block_bucket_scan",
    f"""select o_orderkey as block_num, sha256(o_orderkey::varchar) as block_id
from orders where o_orderkey >= {RANGE_SPLIT} and o_orderkey < {4 * RANGE_SPLIT}""",
)
def q_block_bucket_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All blocks written in folders by block range, and a range of them read from the folders it touches."""
    folder = f"{ensure_checkpoint_dir(spark)}/buckets/{uuid.uuid4().hex}"
    write_blocks(shapes.blocks(spark, sf_dir), folder, BUCKET_WIDTH)
    return read_blocks(
        spark, folder, RANGE_SPLIT, 4 * RANGE_SPLIT, columns=["block_num", "block_id"], width=BUCKET_WIDTH
    )


@query(
    "final_blocks",
    f"""select o_orderkey as block_num, sha256(o_orderkey::varchar) as block_id
from orders where o_orderkey <= (select max(o_orderkey) - {FINAL_DEPTH} from orders)""",
)
def q_final_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return final_blocks(shapes.blocks(spark, sf_dir), FINAL_DEPTH).select("block_num", "block_id")


# The chain of the head, followed block by block.
FORKS_SQL = f"""with recursive named as (
  select event_id as n, event_id::varchar as name, (event_id - 1)::varchar as parent from events
  union all select event_id, 'a' || event_id, case when event_id % 50 = 7 then '' else 'a' end || (event_id - 1)
  from events where event_id % 50 between 7 and 10
  union all select event_id, 'b' || event_id, case when event_id % 1000 = 100 then '' else 'b' end || (event_id - 1)
  from events where event_id % 1000 between 100 and 139
  union all select event_id, 'h' || event_id, case when event_id = last - 2 then '' else 'h' end || (event_id - 1)
  from events, (select max(event_id) as last from events) where event_id > last - 3
), block as (select n, sha256(name) as hash, sha256(parent) as parent from named
), chain as (
  (select n, hash, parent from block order by n desc, hash limit 1)
  union all select b.n, b.hash, b.parent from block b join chain c on b.n = c.n - 1 and b.hash = c.parent
), final as (select n, hash from chain where n <= (select max(n) - {FINAL_DEPTH} from chain))"""


@query("final_blocks_of_forks", FORKS_SQL + " select n as block_num, hash as block_id from final")
def q_final_blocks_of_forks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final blocks among forks, from the head along the parents."""
    forked = shapes.forked_blocks(spark, sf_dir)
    return final_blocks(forked, FINAL_DEPTH, links=Links()).select("block_num", "block_id")


@query(
    "explode_changes",
    f"""select event_id as block_num, 'c' || event_id as cursor, p.pos::varchar as pos,
       case p.pos when 0 then 'accounts' when 1 then 'audit' end as record,
       case p.pos when 0 then user_id::varchar when 1 then event_type end as id,
       (event_id + p.pos)::varchar as ordinal,
       case p.pos when 0 then ({OPERATION_SQL})::varchar when 1 then '1' end as operation,
       case p.pos when 0 then 'value,props' when 1 then 'props' end as field_names
from events left join (select 0 as pos union all select 1) p on p.pos < event_id % 3""",
)
def q_explode_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = changes.explode_changes(shapes.nested_blocks(spark, sf_dir))
    names = F.array_join(F.transform("fields", lambda f: f["name"]), ",")
    return flat.select(
        "block_num",
        "cursor",
        F.col("pos").cast("string").alias("pos"),
        "record",
        "id",
        F.col("ordinal").cast("string").alias("ordinal"),
        F.col("operation").cast("string").alias("operation"),
        names.alias("field_names"),
    )


# Change records


@query(
    "route_by_table",
    """select event_id as ordinal, event_type as record,
       case when event_type in ('signup', 'view', 'click', 'purchase') then 'ok'
            else 'unknown_table' end as route
from events""",
)
def q_route_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = shapes.changes(spark, sf_dir, record=F.col("event_type"))
    tagged = changes.route_by_table(records, shapes.ROUTED_TABLES)
    return tagged.select(
        "ordinal", "record", F.coalesce("reject_reason", F.lit("ok")).alias("route")
    )


@query(
    "derive_row_key",
    f"""select event_id as ordinal,
       sha256('{changes.ROW_KEY_LABEL}<' || user_id || '_' || event_id || '>') as row_key
from events""",
)
def q_derive_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = changes.derive_row_key(F.col("id"), F.col("ordinal"), "sha256")
    return shapes.changes(spark, sf_dir).select("ordinal", key.alias("row_key"))


@query("derive_row_key_blake2s")
def q_derive_row_key_blake2s(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = changes.derive_row_key(F.col("id"), F.col("ordinal"), "blake2s")
    return shapes.changes(spark, sf_dir).select("ordinal", key.alias("row_key"))


@query(
    "row_keys_blake2s",
    """select event_id as ordinal, user_id::varchar as id, 64 as digits, true as is_hex, 1::bigint as rows
from events""",
)
def q_row_keys_blake2s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys a run makes by default: one form, and each key on one record only."""
    records = shapes.changes(spark, sf_dir).select("id", "ordinal")
    keyed_records = records.withColumn("key", changes.derive_row_key(F.col("id"), F.col("ordinal"), "blake2s"))
    one = keyed_records.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ordinal").alias("ordinal"), F.min("id").alias("id")
    )
    form = F.col("key").rlike("^[0-9a-f]*$")
    return one.select("ordinal", "id", F.length("key").alias("digits"), form.alias("is_hex"), "rows")


def _typed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per event, its alternative by turns, some out of the range of the narrower types."""
    number, odd = F.col("event_id"), F.col("event_id") % 2 == 1
    turn = number % 11
    page = F.concat(F.lit("ar://"), number.cast("string"))
    big = F.lit(Decimal(2**64 - 1)) - number
    return shapes.table(spark, sf_dir, "events").select(
        "event_id",
        value(
            int32=F.when(turn == 0, -F.col("user_id")),
            uint32=F.when(
                turn == 1, F.when(odd, F.lit(2**32 - 1) - F.col("user_id")).otherwise(F.col("user_id"))
            ),
            int64=F.when(turn == 2, number * 1000003),
            uint64=F.when(turn == 3, F.when(odd, big).otherwise(number.cast("decimal(20,0)"))),
            bigdecimal=F.when(turn == 4, shapes.money(F.col("value"))),
            bigint=F.when(
                turn == 5, F.when(odd, F.lit("99999999999999999999")).otherwise(number.cast("string"))
            ),
            string=F.when(turn == 6, F.when(odd, F.col("props")).otherwise(number.cast("string"))),
            bytes=F.when(turn == 7, F.encode("props", "UTF-8")),
            bool=F.when(turn == 8, odd),
            array=F.when(turn == 9, F.array("props")),
            offchaindata=F.when(
                turn == 10,
                F.struct(page, F.lit("h"), F.lit(1), F.lit(1)),
            ),
        ).alias("value"),
    )


@query(
    "coerce_typed_value",
    """with v as (
  select event_id, event_id % 11 as turn, event_id % 2 = 1 as odd,
         case when event_id % 2 = 1 then 4294967295 - user_id else user_id end as u32,
         case when event_id % 2 = 1 then 18446744073709551615 - event_id else event_id end as u64,
         user_id, value, props
  from events),
n as (
  select event_id, turn, odd, props, value,
         case turn when 0 then -user_id when 1 then u32 when 2 then event_id * 1000003
                   when 3 then u64 when 5 then case when odd then null else event_id end
                   when 6 then case when odd then null else event_id end end::hugeint as whole
  from v)
select event_id,
  case when turn = 4 then value::decimal(18,2)::varchar when turn = 6 and odd then props
       when turn = 8 then odd::varchar when turn = 10 then 'ar://' || event_id
       when turn = 1 and whole >= 2147483648 then null when turn = 3 and whole >= 9223372036854775808 then null
       else whole::varchar end as as_text,
  case when turn = 4 and value::decimal(18,2) = trunc(value::decimal(18,2)) then value::int::varchar
       when whole between -2147483648 and 2147483647 then whole::varchar end as as_integer,
  case when turn = 4 and value::decimal(18,2) = trunc(value::decimal(18,2)) then value::int::varchar
       when turn = 1 and whole >= 2147483648 then null
       when whole between -9223372036854775808 and 9223372036854775807 then whole::varchar end as as_bigint,
  case when turn = 4 and value::decimal(18,2) = trunc(value::decimal(18,2)) then value::int::varchar
       when turn = 1 and whole >= 2147483648 then (whole - 4294967296)::varchar
       when turn = 3 and whole >= 9223372036854775808 then (whole - 18446744073709551616)::varchar
       else whole::varchar end as as_wrapped,
  case when turn = 4 then value::decimal(18,2)::varchar
       when turn = 1 and whole >= 2147483648 then null when turn = 3 and whole >= 9223372036854775808 then null
       else whole::varchar || '.00' end as as_decimal,
  case when turn = 8 then odd::varchar end as as_bool,
  case when turn = 7 or (turn = 6 and odd) then lower(hex(encode(props)))
       when turn = 6 then lower(hex(encode(event_id::varchar)))
       when turn = 10 then lower(hex(encode('ar://' || event_id))) end as as_binary
from n""",
)
def q_coerce_typed_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    def as_type(kind: str, scale: int | None = None, overflow: str = "reject") -> Column:
        return coerce_canonical(F.col(overflow), ContractColumn("c", kind, scale))

    plain = {name: canonical(F.col("value"), name) for name in ("reject", "wrap")}
    return bind(_typed_values(spark, sf_dir), **plain).select(
        "event_id",
        as_type("text").alias("as_text"),
        as_type("integer").cast("string").alias("as_integer"),
        as_type("bigint").cast("string").alias("as_bigint"),
        as_type("bigint", overflow="wrap").cast("string").alias("as_wrapped"),
        as_type("numeric", 2).cast("string").alias("as_decimal"),
        as_type("bool").cast("string").alias("as_bool"),
        F.lower(F.hex(as_type("binary"))).alias("as_binary"),
    )


TEXT_KINDS = ("bool", "smallint", "integer", "bigint", "float", "double", "numeric", "text", "date",
              "timestamp", "time", "interval")

TEXT_SQL = """case event_id % 10
    when 0 then user_id::varchar when 1 then ' ' || user_id when 2 then '+' || user_id
    when 3 then user_id || '.50' when 4 then case when event_id % 3 = 0 then 'yes' when event_id % 3 = 1 then 'true' else 'false' end
    when 5 then strftime(ts, '%Y-%m-%d') when 6 then strftime(ts, '%Y-%m-%d %H:%M:%S')
    when 7 then strftime(ts, '%H:%M:%S') when 8 then (40000 + user_id)::varchar else user_id || 'e2' end"""

_WHOLE = "regexp_full_match(t, '[+-]?[0-9]+')"
_NUMBER = "regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')"


@query(
    "parse_text_value",
    f"""with t as (select event_id, {TEXT_SQL} as t from events
  union all select -1 - doc_id, text from documents)
select event_id,
  case when t in ('true', 'false') then t end as as_bool,
  case when {_WHOLE} then try_cast(t as smallint)::varchar end as as_smallint,
  case when {_WHOLE} then try_cast(t as integer)::varchar end as as_integer,
  case when {_WHOLE} then try_cast(t as bigint)::varchar end as as_bigint,
  case when {_NUMBER} then try_cast(t as float)::varchar end as as_float,
  case when {_NUMBER} then try_cast(t as double)::varchar end as as_double,
  case when {_NUMBER} then try_cast(try_cast(t as double) as decimal(38,2))::varchar end as as_numeric,
  sha256(t) as as_text,
  case when regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then try_cast(t as date)::varchar end as as_date,
  case when regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}')
       then try_cast(t as timestamp)::varchar end as as_timestamp,
  case when regexp_full_match(t, '[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') then try_cast(t as time)::varchar end as as_time,
  null::varchar as as_interval,
  sha256(encode(t)) as as_binary
from t""",
)
def q_parse_text_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    turn = F.col("event_id") % 10
    third = F.col("event_id") % 3
    words = F.when(third == 0, "yes").when(third == 1, "true").otherwise("false")
    text = (
        F.when(turn == 0, user)
        .when(turn == 1, F.concat(F.lit(" "), user))
        .when(turn == 2, F.concat(F.lit("+"), user))
        .when(turn == 3, F.concat(user, F.lit(".50")))
        .when(turn == 4, words)
        .when(turn == 5, F.date_format("ts", "yyyy-MM-dd"))
        .when(turn == 6, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(turn == 7, F.date_format("ts", "HH:mm:ss"))
        .when(turn == 8, (F.col("user_id") + 40000).cast("string"))
        .otherwise(F.concat(user, F.lit("e2")))
    )
    texts = shapes.table(spark, sf_dir, "events").select("event_id", text.alias("t"))
    documents = shapes.table(spark, sf_dir, "documents")
    texts = texts.unionByName(
        documents.select((-1 - F.col("doc_id")).alias("event_id"), F.col("text").alias("t"))
    )
    parsed = {k: parse_text_value(F.col("t"), k, 2).cast("string") for k in TEXT_KINDS}
    parsed["text"] = F.sha2(parsed["text"], 256)
    parsed["binary"] = F.sha2(parse_text_value(F.col("t"), "binary"), 256)
    return texts.select("event_id", *[c.alias(f"as_{k}") for k, c in parsed.items()])


ACCOUNT_ROWS_SQL = f"""select sha256('{changes.ROW_KEY_LABEL}<' || user_id || '_' || event_id || '>') as id,
  {MONEY_SQL} as value, props, user_id, 'https://example.org/' || event_id as page from events"""


@query("fields_to_columns", ACCOUNT_ROWS_SQL)
def q_fields_to_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.fields_to_columns(
        shapes.changes(spark, sf_dir), shapes.ACCOUNTS, algo="sha256", keep=()
    )
    return rows.withColumn("value", F.col("value").cast("string"))


@query(
    "reject_invalid",
    f"""select event_id as ordinal,
  case when event_id % 37 = 0 then 'invalid_operation'
       when ({OPERATION_SQL}) <> 1 then 'unsupported_operation'
       when event_id % 17 = 0 then 'old_value_given'
       when event_id % 19 = 0 then 'new_value_missing'
       when event_id % 23 = 0 then 'array_value' else 'ok' end as reason
from events""",
)
def q_reject_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = changes.reject_invalid(shapes.dirty_changes(spark, sf_dir))
    return tagged.select("ordinal", F.coalesce("reject_reason", F.lit("ok")).alias("reason"))


@query(
    "conform_to_contract",
    """select event_id as ordinal,
  case when event_id % 31 = 0 then 'unknown_column:extra'
       when event_id % 29 = 0 then 'bad_value:value'
       when event_id % 23 = 0 then 'bad_value:page' else 'ok' end as reason
from events""",
)
def q_conform_to_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = changes.conform_to_contract(shapes.dirty_changes(spark, sf_dir), shapes.ACCOUNTS)
    return tagged.select("ordinal", F.coalesce("reject_reason", F.lit("ok")).alias("reason"))


@query(
    "extract_offchain_requests",
    """select event_id as ordinal, 'https://example.org/' || event_id as uri, 'demo' as manifest,
  'parse_offchain_data' as handler, 3::int as max_retries, 5::int as wait_before_retry, 0::int as num_retries
from events""",
)
def q_extract_offchain_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = changes.extract_offchain_requests(shapes.changes(spark, sf_dir), "demo")
    return requests.drop("block_num", "pos")


# Block and log jobs


@query(
    "block_headers",
    f"""select sha256('{changes.ROW_KEY_LABEL}<' || sha256(o_orderkey::varchar) || '_0>') as id,
  o_orderkey::int as number, sha256(o_orderkey::varchar) as hash,
  sha256((o_orderkey - 1)::varchar) as parent_hash,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as timestamp
from orders""",
)
def q_block_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks to header records, checked, keyed and typed: the rows that are appended."""
    records = blocks.block_headers(shapes.blocks(spark, sf_dir))
    tagged = changes.route_by_table(records, [ETH_BLOCKHEADERS])
    tagged = changes.conform_to_contract(changes.reject_invalid(tagged), ETH_BLOCKHEADERS)
    valid, _ = changes.split_rejects(tagged)
    rows = changes.fields_to_columns(valid, ETH_BLOCKHEADERS, algo="sha256")
    fresh, _ = keyed.insert_append(None, rows, ETH_BLOCKHEADERS.keys)
    return fresh.select(*ETH_BLOCKHEADERS.names)


ADDRESS_SQL = "lpad(lower(to_hex(user_id)), 40, '0')"


@query(
    "filter_event_logs",
    f"""select event_id as ordinal, event_type as event, {ADDRESS_SQL} as address
from events
where event_type in ('signup', 'purchase') and user_id < (select max(user_id) / 2 from events)""",
)
def q_filter_event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = logs.filter_event_logs(shapes.logs(spark, sf_dir), shapes.signatures(spark, sf_dir))
    return hits.select("ordinal", "event", F.lower(F.hex("address")).alias("address"))


@query(
    "filter_named_events",
    f"""select event_id as ordinal, case event_type when 'click' then 'CommentCreated' when 'purchase' then 'PostCreated'
    else 'MirrorCreated' end as event, event_id // 100 as block_num
from events where event_type in ('click', 'purchase', 'error') and event_id % 10 <> 0""",
)
def q_filter_named_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts, comments and mirrors of one contract, by the hashes of their signatures."""
    wanted = logs.event_signatures(spark, [logs.POSTS_CONTRACT], ["PostCreated", "CommentCreated", "MirrorCreated"])
    return logs.filter_event_logs(shapes.post_logs(spark, sf_dir), wanted).select("ordinal", "event", "block_num")


@query(
    "decode_event_fields",
    """select event_id as ordinal, lpad(lower(to_hex(user_id)), 64, '0') as profile_id,
  lpad(lower(to_hex(event_id)), 64, '0') as pub_id, 'https://example.org/' || props as content_uri,
  lpad(lower(to_hex(user_id)), 40, '0') as collect_module, '' as collect_data,
  repeat('0', 40) as reference_module, '' as reference_data,
  lpad(lower(to_hex(event_id)), 64, '0') as timestamp
from events where event_type = 'purchase' and event_id % 10 <> 0""",
)
def q_decode_event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = logs.event_signatures(spark, [logs.POSTS_CONTRACT], ["PostCreated"])
    own = logs.filter_event_logs(shapes.post_logs(spark, sf_dir), wanted)
    decoded = logs.decode_event_fields(own, "PostCreated")
    names = {
        "profileId": "profile_id",
        "pubId": "pub_id",
        "contentURI": "content_uri",
        "collectModule": "collect_module",
        "collectModuleReturnData": "collect_data",
        "referenceModule": "reference_module",
        "referenceModuleReturnData": "reference_data",
        "timestamp": "timestamp",
    }
    return decoded.select("ordinal", *[F.col(k).alias(v) for k, v in names.items()])


LITTLE_ENDIAN_SQL = """(select list_aggregate(list_reverse(regexp_extract_all(h, '(..)', 1)), 'string_agg', '')
    || case when left(h, 1) >= '8' then '00' else '' end
  from (select case when length(x) % 2 = 1 then '0' || x else x end as h
        from (select lower(to_hex({n})) as x)))"""


@query(
    "posts",
    f"""select event_id as ordinal, {LITTLE_ENDIAN_SQL.format(n='user_id')} as profile_id,
  {LITTLE_ENDIAN_SQL.format(n='user_id')} || '-' || {LITTLE_ENDIAN_SQL.format(n='event_id')} as id,
  'https://example.org/' || props as content_uri, event_id as timestamp
from events where event_type = 'purchase' and event_id % 10 <> 0""",
)
def q_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = logs.posts(shapes.post_logs(spark, sf_dir))

    def given(name: str) -> Column:
        return changes.last_field(name)["new_value"]

    return records.select(
        "ordinal",
        given("profile_id")["string"].alias("profile_id"),
        "id",
        given("content_uri")["offchaindata"]["uri"].alias("content_uri"),
        given("timestamp")["uint64"].cast("bigint").alias("timestamp"),
    )


def _word_sql(number: str) -> str:
    return f"lpad(lower(to_hex({number})), 64, '0')"


LOGS_SQL = f"""link as (
  select *, lower(hex(encode('https://example.org/' || props))) as link_hex from events),
log as (
  select event_id, ts, event_id // 100 as block_num, ((event_id % 100) // 10)::int as tx_index,
    (event_id % 100)::int as log_index, {SHA_BLOCK} as block_hash,
    sha256((event_id // 10)::varchar) as tx_hash,
    rpad({ADDRESS_SQL}, 64, '0') as address, sha256(event_type) as topic0,
    case when event_type <> 'view' then {_word_sql('user_id')} end as topic1,
    case when event_type <> 'view' then {_word_sql('event_id')} end as topic2,
    {_word_sql('192')} || {_word_sql('user_id')}
      || {_word_sql("192 + 32 * (1 + (length(link_hex) + 63) // 64)")} || repeat('0', 64)
      || {_word_sql("192 + 32 * (1 + (length(link_hex) + 63) // 64)")} || {_word_sql('event_id')}
      || {_word_sql('length(link_hex) // 2')}
      || rpad(link_hex, ((length(link_hex) + 63) // 64 * 64)::int, '0') || repeat('0', 64) as data
  from link)"""

def _swapped_sql(digits: str) -> str:
    return f"list_aggregate(list_reverse(regexp_extract_all({digits}, '..')), 'string_agg', '')"


def _field_sql() -> str:
    """Every address with its digits in base p: long division of eight limbs, five times."""
    steps = [f"('0x' || substr(h, {8 * k + 1}, 8))::hugeint as q0_{k}" for k in range(8)]
    for d in range(1, FIELD_DIGITS + 1):
        for k in range(8):
            before = f"r{d}_{k - 1}" if k else "0::hugeint"
            steps.append(f"{before} * {LIMB} + q{d - 1}_{k} as t{d}_{k}")
            steps.append(f"t{d}_{k} // {FIELD_PRIME}::hugeint as q{d}_{k}, t{d}_{k} % {FIELD_PRIME}::hugeint as r{d}_{k}")
    shown = " || ".join(_swapped_sql(f"lpad(lower(to_hex(r{d}_7::ubigint)), 16, '0')") for d in range(1, FIELD_DIGITS + 1))
    return f"""field as (select word, {shown} as digits from (select *, {', '.join(steps)}
  from (select distinct address as word, {_swapped_sql('address')} as h from log)))"""


EVENT_ROWS_SQL = f"""with {LOGS_SQL}, {_field_sql()}
select '{logs.EVENT_ID_LABEL}<' || block_hash || '_' || tx_hash || '_' || tx_index || '_' || log_index || '>' as id,
  block_num as blocknumber, block_hash as blockhash, tx_hash as txhash, tx_index as txindex,
  log_index as logindex, address, topic0, topic1, topic2, null::varchar as topic3,
  null::varchar as topic4, {{data}} as data, digits as "addressF",
  (count(*) over (partition by block_num))::int as num_logs
from log join field on word = address"""


def _event_rows(spark: SparkSession, sf_dir: str, legacy: bool) -> DataFrame:
    rows = logs.event_rows(shapes.logs(spark, sf_dir), legacy_windows=legacy)
    return rows.drop("commitment")


@query("event_rows", EVENT_ROWS_SQL.format(data="data"))
def q_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_rows(spark, sf_dir, legacy=False)


@query(
    "event_rows_legacy",
    EVENT_ROWS_SQL.format(
        data="""list_aggregate(list_transform(range(1, length(data) // 64),
    lambda i: substr(data, 2 * i + 1, 64)), 'string_agg', '')"""
    ),
)
def q_event_rows_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_rows(spark, sf_dir, legacy=True)


def _commitment_sql(block: str, order: str) -> str:
    return f"""with recursive {LOGS_SQL},
placed as (
  select {block} as block_num, count(*) over (partition by {block}) as n,
    row_number() over (partition by {block} order by {order}) - 1 as position,
    sha256(tx_index || '|' || log_index || '|' || address || '|'
      || concat_ws(',', topic0, topic1, topic2) || '|' || data) as hash
  from log),
sized as (select distinct block_num, n, length(ltrim(bin(n), '0')) as k from placed),
leaves as (
  select block_num, n, k, i as place,
    coalesce(p.hash, case when i = (1::bigint << k) - n - 1 then sha256(n::varchar) else sha256('0') end) as hash
  from (select block_num, n, k, unnest(range(0, 1::bigint << k)) as i from sized) s
  left join placed p using (block_num, n)
  where false
  union all
  select s.block_num, s.n, s.k, s.i,
    coalesce(p.hash, case when s.i = (1::bigint << s.k) - s.n - 1 then sha256(s.n::varchar) else sha256('0') end)
  from (select block_num, n, k, unnest(range(0, 1::bigint << k)) as i from sized) s
  left join placed p on p.block_num = s.block_num and p.position = s.i - ((1::bigint << s.k) - s.n)),
tree as (
  select block_num, n, k, 0 as level, place, hash from leaves
  union all
  select block_num, n, k, level + 1, place // 2, sha256(string_agg(hash, '' order by place))
  from tree where level < k group by block_num, n, k, level, place // 2)
select block_num, n as num_logs, hash as commitment from tree where level = k"""


@query("block_commitment", _commitment_sql("block_num", "tx_index, log_index"))
def q_block_commitment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.block_commitment(shapes.logs(spark, sf_dir))


@query("block_commitment_daily", _commitment_sql("strftime(ts, '%Y-%m-%d')", "event_id"))
def q_block_commitment_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = shapes.logs(spark, sf_dir).withColumn("block_num", F.date_format("ts", "yyyy-MM-dd"))
    return logs.block_commitment(daily, order=("ordinal",))


CENTS_SQL = "case when event_type <> 'error' then (value::decimal(18,2) * 100)::bigint else 0 end"


TRANSACTIONS_SQL = "(select *, unnest(range(0, event_id % 2 + 1)) as tx from events)"


@query(
    "explode_logs",
    f"""select event_id as block_num, sha256(event_id::varchar) as block_hash, tx::int as tx_index,
  sha256((event_id * 10 + tx)::varchar) as tx_hash, nth::int as log_index, event_id * 100 + tx * 10 + nth as ordinal,
  {ADDRESS_SQL} as address, sha256(event_type) as topic0, props as data
from (select *, unnest(range(1, event_id % 3 + 1)) as nth from {TRANSACTIONS_SQL} where tx = 0 or event_type <> 'error')""",
)
def q_explode_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = logs.explode_logs(shapes.traced_blocks(spark, sf_dir))
    return found.select(
        "block_num",
        *[F.lower(F.hex(c)).alias(c) for c in ("block_hash", "tx_hash", "address")],
        "tx_index",
        "log_index",
        "ordinal",
        F.lower(F.hex(F.get("topics", F.lit(0)))).alias("topic0"),
        F.decode("data", "UTF-8").alias("data"),
    )


@query(
    "explode_balance_changes",
    f"""select event_id as block_num, event_id * 100 + tx * 10 + 9 as end_ordinal, nth::int as pos,
  lpad(lower(to_hex(user_id + tx)), 40, '0') as address,
  case when nth = 0 then lpad(lower(to_hex(event_id * 10)), 64, '0') end as new_value
from (select *, unnest(range(0, 2)) as nth from {TRANSACTIONS_SQL})""",
)
def q_explode_balance_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = balances.explode_balance_changes(shapes.traced_blocks(spark, sf_dir))
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("address", "new_value")})


@query(
    "balance_latest",
    f"""select 'Address:' || {ADDRESS_SQL} as key, arg_max({CENTS_SQL}, event_id)::varchar as balance
from events group by user_id""",
)
def q_balance_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balances.balance_latest(shapes.balances(spark, sf_dir))


@query(
    "balance_changes",
    f"""select event_id // 100 as block_num, event_id as ordinal, 0::int as pos, {ADDRESS_SQL} as key,
  case when event_id // 100 = min(event_id // 100) over (partition by user_id) then 'Insert'
       else 'Update' end as type,
  json_object('account', {ADDRESS_SQL}, 'balance', ({CENTS_SQL})::varchar)::varchar as value
from events""",
)
def q_balance_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balances.balance_changes(shapes.balances(spark, sf_dir))


@query(
    "store_reads",
    f"""with d as (select event_id, user_id, event_id // 100 as block, 'Address:' || {ADDRESS_SQL} as key, ({CENTS_SQL})::varchar as balance from events)
select event_id as ordinal, key,
  (select arg_max(balance, event_id) from d e where e.user_id = d.user_id and e.block < d.block) as first,
  lag(balance) over (partition by user_id order by event_id) as before, balance as at,
  last_value(balance) over (partition by user_id, block order by event_id rows between unbounded preceding and unbounded following) as last
from d""",
)
def q_store_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances as a store, read by every change as of four places: before its block, before and after itself,
    and after its block."""
    deltas = balances.balance_deltas(shapes.balances(spark, sf_dir))
    store = StoreReader(deltas)
    rows = deltas.select("block_num", "ordinal", "pos", "key")
    read = store.get_last(store.get_at(store.get_before(store.get_first(rows, "key", "first"), "key", "before"), "key", "at"), "key", "last")
    return read.select("ordinal", "key", "first", "before", "at", "last")


@query(
    "store_policies",
    f"""with d as (select user_id, event_id, ({CENTS_SQL}) as cents from events)
select 'Address:' || {ADDRESS_SQL} as key, arg_min(cents, event_id) as first_cents, sum(cents)::bigint as all_cents,
  min(cents) as least_cents, max(cents) as most_cents
from d group by user_id""",
)
def q_store_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store per policy that counts or keeps the first, by account."""
    deltas = balances.balance_deltas(shapes.balances(spark, sf_dir)).withColumn("value", F.col("value").cast("bigint"))
    names = {"set_if_not_exists": "first_cents", "add": "all_cents", "min": "least_cents", "max": "most_cents"}
    tables = [store_values(deltas, policy).withColumnRenamed("value", name) for policy, name in names.items()]
    return reduce(lambda a, b: a.join(b, "key"), tables)


# Keyed tables

STORED = contract("accounts", "id text, value numeric(2), props text", "id")


def _sparse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = shapes.sparse_changes_of(shapes.table(spark, sf_dir, "events"))
    return changes.fields_to_columns(records, STORED, key="id", present=True)


def _plain(table: DataFrame) -> DataFrame:
    return table.withColumn("value", F.col("value").cast("string"))


STORED_SQL = """stored as (
  select s_suppkey::varchar as id, s_acctbal::decimal(38,2) as value, s_name as props from supplier),
change as (
  select user_id::varchar as id, event_id as o,
    case when event_type in ('signup', 'view') then 1 when event_type in ('click', 'purchase') then 2 else 3 end as op,
    event_type in ('signup', 'view', 'click') as gives_value,
    event_type in ('signup', 'view', 'purchase') as gives_props,
    value::decimal(38,2) as value, case when event_id % 5 <> 0 then props end as props
  from events)"""


@query(
    "check_primary_key",
    """select user_id::varchar as id, count(*) as rows from events group by user_id having count(*) > 1""",
)
def q_check_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.check_primary_key(_sparse_rows(spark, sf_dir), STORED.keys)


@query(
    "insert_append",
    f"""with {STORED_SQL},
placed as (select *, row_number() over (partition by id order by o) as place from change where op = 1)
select p.id, o as ordinal,
  case when place > 1 then 'duplicate_key' when s.id is not null then 'key_exists' else 'inserted' end as outcome
from placed p left join stored s on s.id = p.id""",
)
def q_insert_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    creates = _sparse_rows(spark, sf_dir).filter(F.col("_operation") == CREATE)
    outcomes = keyed.insert_outcomes(shapes.accounts(spark, sf_dir), creates, STORED.keys)
    outcome = F.coalesce("reject_reason", F.lit("inserted")).alias("outcome")
    return outcomes.select("id", F.col("_ordinal").alias("ordinal"), outcome)


@query(
    "update_by_key",
    f"""with {STORED_SQL},
last as (
  select id, arg_max(struct_pack(v := value), o) filter (gives_value) as v,
    arg_max(struct_pack(p := props), o) filter (gives_props) as p
  from change where op = 2 group by id)
select s.id, (case when l.v is not null then l.v.v else s.value end)::varchar as value,
  case when l.p is not null then l.p.p else s.props end as props
from stored s left join last l on l.id = s.id""",
)
def q_update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _sparse_rows(spark, sf_dir).filter(F.col("_operation") == UPDATE)
    return _plain(keyed.update_by_key(shapes.accounts(spark, sf_dir), updates, STORED.keys))


@query(
    "delete_by_key",
    f"""with {STORED_SQL}
select c_custkey::varchar as id, c_acctbal::decimal(38,2)::varchar as value, c_name as props from customer
where c_custkey::varchar not in (select id from change where op = 3)""",
)
def q_delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    deletes = _sparse_rows(spark, sf_dir).filter(F.col("_operation") == DELETE)
    customers = shapes.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_acctbal").cast("decimal(38,2)").alias("value"),
        F.col("c_name").alias("props"),
    )
    return _plain(keyed.delete_by_key(customers, deletes, STORED.keys))


FOLD_SQL = f"""{STORED_SQL},
marked as (
  select c.*, s.id is not null as was_stored,
    last_value(case when op in (1, 3) then op end ignore nulls)
      over (partition by c.id order by o rows between unbounded preceding and 1 preceding) as previous
  from change c left join stored s on s.id = c.id),
live as (
  select *, case when previous is null then was_stored else previous = 1 end as is_live from marked)"""


@query(
    "apply_changes",
    f"""with {FOLD_SQL},
epochs as (
  select id, max(case when op = 3 or (op = 1 and not is_live) then o end) as epoch,
    arg_max(op, o) filter (op in (1, 3)) as final_op
  from live group by id),
kept as (
  select l.*, e.epoch from live l join epochs e on e.id = l.id
  where l.o >= coalesce(e.epoch, -1) and (l.op = 2 or (l.op = 1 and not l.is_live))),
folded as (
  select id, arg_max(struct_pack(v := value), o) filter (gives_value) as new_value,
    arg_max(struct_pack(p := props), o) filter (gives_props) as new_props
  from kept group by id)
select coalesce(s.id, e.id) as id,
  (case when f.new_value is not null then f.new_value.v when e.epoch is null then s.value end)::varchar as value,
  case when f.new_props is not null then f.new_props.p when e.epoch is null then s.props end as props
from stored s full join epochs e on e.id = s.id left join folded f on f.id = e.id
where case when e.final_op is null then s.id is not null else e.final_op = 1 end""",
)
def q_apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = shapes.accounts(spark, sf_dir)
    return _plain(keyed.apply_changes(table, _sparse_rows(spark, sf_dir), STORED.keys))


@query("change_conflicts", f"with {FOLD_SQL} select id, o as ordinal from live where op = 1 and is_live")
def q_change_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = shapes.accounts(spark, sf_dir)
    refused = keyed.change_conflicts(table, _sparse_rows(spark, sf_dir), STORED.keys)
    return refused.select("id", F.col("_ordinal").alias("ordinal"))


@query(
    "batch_counts",
    f"""select event_id // 100 as batch_id, event_type as record, ({OPERATION_SQL})::int as operation,
  count(*) as operations from events group by all""",
)
def q_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = shapes.changes(spark, sf_dir, record=F.col("event_type"))
    return keyed.batch_counts(records.withColumnRenamed("block_num", "batch_id"))


# Progress: one run per order priority, its cursor after the blocks of finished orders.

PROGRESS_SQL = """done as (
  select o_orderpriority as id, max(o_orderkey) as block_num from orders
  where o_orderstatus = 'F' and o_orderpriority <> '5-LOW' group by o_orderpriority)"""


def _cursors(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderpriority").alias("id"),
        F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("cursor"),
        F.col("o_orderkey").alias("block_num"),
        shapes.number_hash(F.col("o_orderkey")).alias("block_id"),
    )


def _finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors of four of the five runs: the fifth has none, and starts where it is told to."""
    finished = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW")
    return _cursors(shapes.table(spark, sf_dir, "orders").filter(finished))


@query(
    "cursor_upsert",
    """select id, 'c' || block_num as cursor, block_num, sha256(block_num::varchar) as block_id
from (select o_orderpriority as id, max(o_orderkey) as block_num from orders group by o_orderpriority)""",
)
def q_cursor_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = _cursors(shapes.table(spark, sf_dir, "orders"))
    even = written.filter(F.col("block_num") % 2 == 0)
    odd = written.filter(F.col("block_num") % 2 == 1)
    return progress.cursor_upsert(progress.cursor_upsert(None, even), odd)


@query(
    "resume_filter",
    f"""with {PROGRESS_SQL}
select o_orderpriority as run_id, o_orderkey as block_num
from orders left join done on done.id = o_orderpriority
where o_orderkey > coalesce(done.block_num, 99)""",
)
def q_resume_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = progress.cursor_upsert(None, _finished(spark, sf_dir))
    orders = shapes.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("run_id"), F.col("o_orderkey").alias("block_num")
    )
    return progress.resume_filter(orders, done, 100).select("run_id", "block_num")


# Links


def _link_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.table(spark, sf_dir, "events").select(
        (F.expr("event_id div 100")).alias("block_num"),
        F.col("event_id").alias("ordinal"),
        F.lit(0).alias("pos"),
        F.concat(F.lit("https://example.org/"), F.col("props")).alias("uri"),
        F.col("event_type").alias("manifest"),
        F.lit("parse_offchain_data").alias("handler"),
        (F.col("event_id") % 4).cast("int").alias("max_retries"),
        F.lit(5).alias("wait_before_retry"),
        F.lit(0).alias("num_retries"),
    )


@query(
    "enqueue_tasks",
    """with first as (
  select 'https://example.org/' || props as uri, event_type as manifest,
    (arg_min(event_id, event_id) % 4)::int as max_retries
  from events group by props, event_type)
select uri, manifest, 'parse_offchain_data' as handler, max_retries, 5::int as wait_before_retry,
  0::int as num_retries, 0::int as state
from first
where (uri, manifest) not in (
  select 'https://example.org/{"k": ' || n_nationkey || '}', 'click' from nation)""",
)
def q_enqueue_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = shapes.table(spark, sf_dir, "nation").select(
        F.concat(
            F.lit('https://example.org/{"k": '), F.col("n_nationkey").cast("string"), F.lit("}")
        ).alias("uri"),
        F.lit("click").alias("manifest"),
    )
    return links.enqueue_tasks(known, _link_requests(spark, sf_dir), NOW).drop("due_at")


@query(
    "queued_tasks",
    """select url as uri from pages where page_id % 7 = 0
  and timestamp '2024-01-31 00:00:00' + to_minutes((page_id * 10)::int) <= timestamp '2024-02-01 00:00:00'""",
)
def q_queued_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        mins=(F.col("page_id") * 10).cast("int")
    )
    tasks = shapes.table(spark, sf_dir, "pages").select(
        F.col("url").alias("uri"), (F.col("page_id") % 7).alias("state"), later.alias("due_at")
    )
    return links.queued_tasks(tasks, NOW).select("uri")


MANIFEST_SQL = "case when page_id % 11 = 0 then 'other' else 'demo' end"


@query(
    "classify_tasks",
    f"""select url as uri, {MANIFEST_SQL} as manifest,
  (case when not starts_with(url, 'https://') then 1 when page_id % 11 = 0 then 2 else 0 end)::int as state
from pages""",
)
def q_classify_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = links.classify_tasks(shapes.page_tasks(spark, sf_dir), ["demo"])
    return tasks.select("uri", "manifest", "state")


@query(
    "rewrite_links",
    f"""select page_id, url as uri, case when starts_with(url, 'https://') then url end as address from pages
union all
select page_id, 'ar://id_' || page_id || '/x?y#z', 'https://arweave.net/id_' || page_id from pages
union all
select page_id, 'ipfs://Qm' || page_id, '{GATEWAY}/api/v0/cat?arg=Qm' || page_id from pages""",
)
def q_rewrite_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("page_id").cast("string")
    forms = F.array(
        F.col("url"),
        F.concat(F.lit("ar://id_"), key, F.lit("/x?y#z")),
        F.concat(F.lit("ipfs://Qm"), key),
    )
    uris = shapes.table(spark, sf_dir, "pages").select("page_id", F.explode(forms).alias("uri"))
    return links.rewrite_links(uris, [GATEWAY])


@query(
    "attach_content",
    f"""select url as uri, {MANIFEST_SQL} as manifest,
  case when page_id % 7 <> 0 then sha256(html) end as content_hash
from pages""",
)
def q_attach_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    attached = links.attach_content(shapes.page_tasks(spark, sf_dir), shapes.page_content(spark, sf_dir))
    return attached.select("uri", "manifest", F.sha2("content", 256).alias("content_hash"))


@query(
    "retry_schedule",
    """select url as uri, (case when page_id % 5 < 3 then 0 else 3 end)::int as state,
  (case when page_id % 5 < 3 then page_id % 5 + 1 else page_id % 5 end)::int as num_retries,
  case when page_id % 5 < 3 then '2024-02-01 00:00:05' else '2024-01-01 00:00:00' end as due_at
from pages""",
)
def q_retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = links.retry_schedule(shapes.page_tasks(spark, sf_dir), NOW)
    due = F.date_format("due_at", "yyyy-MM-dd HH:mm:ss").alias("due_at")
    return tasks.select("uri", "state", "num_retries", due)


@query(
    "size_guard",
    f"""select url as uri, strlen(url) + strlen('demo') + strlen(html) > {PAGE_SIZE_LIMIT} as too_big
from pages""",
)
def q_size_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = shapes.table(spark, sf_dir, "pages")
    contents = pages.select(F.col("url").alias("uri"), F.col("html").alias("content"), F.lit("demo").alias("manifest"))
    return links.size_guard(contents, PAGE_SIZE_LIMIT).select("uri", "too_big")


@query(
    "parse_posts",
    """select 'https://example.org/' || conv_id || '/' || turn as uri,
  case role when 'user' then 'Lenster' else 'phaver' end as app_id, 'turn ' || turn as name, text as content
from conversations where role in ('user', 'assistant') and turn not in (2, 3)""",
)
def q_parse_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.parse_posts(shapes.post_documents(spark, sf_dir))


PAGE_TITLES = contract("page_titles", "uri text, title text", "uri")


def parse_page(content: Column, uri: Column) -> Column:
    """A page with a title gives one record; other pages give none."""
    title = F.regexp_extract(content, "<title>([^<]*)</title>", 1)
    record = F.struct(
        F.lit(PAGE_TITLES.table).alias("record"),
        F.array(field("uri", value(string=uri)), field("title", value(string=title))).alias("fields"),
    )
    plain = F.coalesce(title != "", F.lit(False))
    return F.when(plain, F.array(record).cast(RECORDS)).otherwise(F.array().cast(RECORDS))


PAGE_HANDLERS = {"demo": {"parse_page": parse_page}}

OUTCOMES_SQL = f"""outcome as (
  select *, {MANIFEST_SQL} as manifest, regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
    case when not starts_with(url, 'https://') then 1
         when page_id % 11 = 0 then 2
         when page_id % 7 = 0 then case when page_id % 5 < 3 then 0 else 3 end
         when strlen(url) + strlen('demo') + strlen(html) > {links.MAX_CONTENT_SIZE} then 5
         when page_id % 13 = 0 or title = '' then 4
         else 6 end as state
  from pages)"""


@query(
    "task_outcomes",
    f"""with {OUTCOMES_SQL}
select url as uri, manifest, state::int as state,
  (page_id % 5 + case when state = 0 then 1 else 0 end)::int as num_retries,
  case when state = 0 then '2024-02-01 00:00:05' else '2024-01-01 00:00:00' end as due_at
from outcome""",
)
def q_task_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = links.task_outcomes(
        shapes.page_tasks(spark, sf_dir),
        shapes.page_content(spark, sf_dir),
        PAGE_HANDLERS,
        NOW,
    )
    due = F.date_format("due_at", "yyyy-MM-dd HH:mm:ss").alias("due_at")
    return outcomes.select("uri", "manifest", "state", "num_retries", due)


@query(
    "parsed_rows",
    f"with {OUTCOMES_SQL} select url as uri, title from outcome where state = 6",
)
def q_parsed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = links.attempt_tasks(
        shapes.page_tasks(spark, sf_dir),
        shapes.page_content(spark, sf_dir),
        PAGE_HANDLERS,
        NOW,
    )
    return links.parsed_rows(resolved, PAGE_TITLES).select(*PAGE_TITLES.names)


# Streams and runs. They write to a new folder under the checkpoint folder of the session.


def _run_dir(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/runs/{uuid.uuid4().hex}"


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # A stream wants a folder; a pattern also takes a table that is one file.
    schema = shapes.table(spark, sf_dir, name).schema
    return stream_blocks(spark, f"{sf_dir}/{name}.parquet*", schema)


# Rows of one file of an arriving table.
FILE_ROWS = 200_000


def _arriving(frame: DataFrame, place: Column, folder: str, batches: int = 3, rows: int = FILE_ROWS) -> DataFrame:
    """A table as a stream of a few batches in the order of `place`. Each has the same number of files, so many that
    the largest batch has about `rows` rows in one; a batch with fewer rows than files gets empty ones."""
    size = frame.agg(F.max(place)).first()[0] // batches + 1
    part = F.least(F.floor(place / size), F.lit(batches - 1))
    largest = frame.groupBy(part.alias("part")).count().filter(F.col("part") >= 0).agg(F.max("count")).first()[0] or 0
    files = max(1, -(-largest // rows))
    for k in range(batches):
        frame.filter(part == k).repartition(files).write.mode("append").parquet(folder)
        found = len(frame.sparkSession.read.schema(frame.schema).parquet(folder).inputFiles())
        for _ in range(files * (k + 1) - found):
            frame.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return stream_blocks(frame.sparkSession, folder, frame.schema, files_per_batch=files)


@query("stream_ingest", ORACLE["block_headers"])
def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block headers as a stream in three batches: the same rows as in batch."""
    folder = _run_dir(spark)
    store = BatchStore(spark, f"{folder}/store")
    job = IngestJob("headers", "block_meta", [ETH_BLOCKHEADERS], algo="sha256")
    arriving = _arriving(shapes.table(spark, sf_dir, "orders"), F.col("o_orderkey"), f"{folder}/orders")
    run_stream(job, store, shapes.blocks_of(arriving), f"{folder}/checkpoint")
    return store.rows(ETH_BLOCKHEADERS)


@query(
    "final_blocks_stream",
    FORKS_SQL + """ select sha256('bin.node.cli.PRIMARY_KEY_INSERT_INTO<' || hash || '_0>') as id, hash from final""",
)
def q_final_blocks_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of final blocks from a stream of files with forks, orphans a little late: each batch holds back
    what a later one may replace."""
    folder = _run_dir(spark)
    forked = shapes.forked_blocks(spark, sf_dir)
    place = F.col("block_num") + F.when(F.col("orphan"), 5).otherwise(0)
    arriving = _arriving(forked, place, f"{folder}/blocks")
    store = BatchStore(spark, f"{folder}/store")
    job = IngestJob("final", "block_meta", [ETH_BLOCKHEADERS], algo="sha256", final_depth=FINAL_DEPTH)
    run_stream(job, store, arriving, f"{folder}/checkpoint")
    return store.rows(ETH_BLOCKHEADERS).select("id", "hash")


@query("balance_changes_stream", ORACLE["balance_changes"])
def q_balance_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance changes as a stream in three batches, with keyed state: the same rows as in batch."""
    folder = _run_dir(spark)
    store = BatchStore(spark, f"{folder}/store")
    events = shapes.table(spark, sf_dir, "events")
    arriving = _arriving(events, shapes.event_block(), f"{folder}/events")
    stream_balances(store, shapes.balances_of(arriving), f"{folder}/checkpoint").awaitTermination()
    return store.read("balance_changes", BALANCE_CHANGES).drop("batch")


@query(
    "flush_batch",
    """select (case when event_type = 'error' then 1 else 0 end)::bigint as batch, event_id as ordinal, c.cursor
from events cross join (select 'c' || max(event_id // 100) as cursor from events) c""",
)
def q_flush_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two committed batches and a third that was written but not marked: it stays invisible."""
    store = BatchStore(spark, f"{_run_dir(spark)}/store")
    records = shapes.changes(spark, sf_dir)
    rows = records.select("block_num", "ordinal", "operation")
    reached = progress.batch_progress(records, "flush")
    store.commit({"rows": rows.filter(F.col("operation") != DELETE)}, reached, "flush", 0)
    store.commit({"rows": rows.filter(F.col("operation") == DELETE)}, reached, "flush", 1)
    store.write({"rows": rows})
    cursor = store.progress().select("cursor").scalar()
    return store.read("rows", rows.schema).select("batch", "ordinal", cursor.alias("cursor"))


def _page_changes(pages: DataFrame) -> DataFrame:
    """One record per page: its link is to be fetched."""
    request = offchain_request(F.col("url"), "parse_page", 3, 5)
    record = blocks.change(
        PAGES.table,
        F.col("page_id").cast("string"),
        F.lit(0),
        [field("link", value(offchaindata=request))],
    )
    return pages.select("block_num", F.lit(0).alias("pos"), record.alias("change")).select(
        "block_num", "pos", "change.*"
    )


PAGES = contract("linked_pages", "id text, link text", "id")


def _linked_pages(pages: DataFrame) -> DataFrame:
    """A block per page."""
    return pages.select(
        F.col("page_id").alias("block_num"),
        shapes.number_hash(F.col("page_id")).alias("block_id"),
        F.concat(F.lit("c"), F.col("page_id").cast("string")).alias("cursor"),
        "page_id",
        "url",
    )


def _enrich_job(spark: SparkSession, sf_dir: str) -> IngestJob:
    enrichment = Enrichment(
        manifest="demo",
        handlers=PAGE_HANDLERS["demo"],
        contracts=[PAGE_TITLES],
        content=lambda: shapes.page_content(spark, sf_dir),
    )
    return IngestJob("pages", _page_changes, [PAGES], algo="sha256", enrichment=enrichment)


@query(
    "enrich_stream",
    f"""with done as (
  select url, page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
    case when not starts_with(url, 'https://') then 1 when page_id % 7 = 0 then 0
         when strlen(url) + strlen('demo') + strlen(html) > {links.MAX_CONTENT_SIZE} then 5
         when regexp_extract(html, '<title>([^<]*)</title>', 1) = '' then 4
         else 6 end as state
  from pages)
select url as uri, state::int as state,
  (case when state = 0 then 1 else 0 end)::int as num_retries,
  case when state = 6 then title end as title
from done""",
)
def q_enrich_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a stream: their links queued, attempted once, parsed and stored."""
    folder = _run_dir(spark)
    store = BatchStore(spark, f"{folder}/store")
    pages = _arriving(_linked_pages(shapes.table(spark, sf_dir, "pages")), F.col("block_num"), f"{folder}/pages", 2)
    run_stream(_enrich_job(spark, sf_dir), store, pages, f"{folder}/checkpoint", now=NOW)
    titles = store.rows(PAGE_TITLES)
    return current_tasks(store).join(titles, "uri", "left").select(
        "uri", "state", "num_retries", "title"
    )


@query("enrich_timers")
def q_enrich_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a stream that ends at once: the links without content are tried again by a clock until they
    are given up, with no further blocks. The clock of the query runs ahead, so a wait takes no real time."""
    folder = _run_dir(spark)
    store = BatchStore(spark, f"{folder}/store")
    passed = [dt.datetime.fromisoformat(NOW)]

    def clock() -> dt.datetime:
        passed[0] += dt.timedelta(seconds=5)
        return passed[0]

    arriving = _arriving(_linked_pages(shapes.table(spark, sf_dir, "pages")), F.col("block_num"), f"{folder}/pages", 2)
    run_stream(_enrich_job(spark, sf_dir), store, arriving, f"{folder}/checkpoint", retries="1 second", clock=clock, now=NOW)
    return current_tasks(store).select("uri", "state", "num_retries")


@query(
    "enrich_retries",
    f"""select url as uri,
  (case when not starts_with(url, 'https://') then 1 when page_id % 7 = 0 then 3
        when strlen(url) + strlen('demo') + strlen(html) > {links.MAX_CONTENT_SIZE} then 5
        when regexp_extract(html, '<title>([^<]*)</title>', 1) = '' then 4 else 6 end)::int as state,
  (case when starts_with(url, 'https://') and page_id % 7 = 0 then 3 else 0 end)::int as num_retries
from pages""",
)
def q_enrich_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links whose content never comes: three retries after the first attempt, then given up."""
    store = BatchStore(spark, f"{_run_dir(spark)}/store")
    job = _enrich_job(spark, sf_dir)
    start = dt.datetime.fromisoformat(NOW)
    run_batch(job, store, _linked_pages(shapes.table(spark, sf_dir, "pages")), start)
    passed = [start]
    resolve_all(
        job.enrichment,
        store,
        "retries",
        clock=lambda: passed[-1],
        wait=lambda seconds: passed.append(passed[-1] + dt.timedelta(seconds=seconds)),
    )
    return current_tasks(store).select("uri", "state", "num_retries")


ORACLE["enrich_timers"] = ORACLE["enrich_retries"]


@query(
    "changes_run",
    f"""with {STORED_SQL},
valid as (select * from change where op <> 1 or props is not null),
seen as (select *, last_value(case when op in (1, 3) then op end ignore nulls) over (
    partition by id order by o rows between unbounded preceding and 1 preceding) as before from valid),
refused as (select * from seen where op = 1 and before = 1),
taken as (select * from seen where not (op = 1 and coalesce(before, 0) = 1)),
alive as (select id, max(o) filter (op = 1) as born from taken group by id
  having arg_max(op, o) filter (op in (1, 3)) = 1)
select 'refused' as part, id, o as ordinal, null as value, null as props from refused
union all
select 'alive', a.id, null, arg_max(struct_pack(v := t.value), t.o) filter (gives_value).v::varchar,
  arg_max(struct_pack(p := t.props), t.o) filter (gives_props).p
from alive a join taken t on t.id = a.id and t.o >= a.born group by a.id""",
)
def q_changes_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that keeps its table as changes, in two batches with a table version in between: the creates that
    it refused, and the rows that its table has in the end."""
    store = BatchStore(spark, f"{_run_dir(spark)}/store")
    job = IngestJob("changes", shapes.sparse_changes_of, [STORED], mode="changes", strict=False, on_conflict="reject")
    events = shapes.table(spark, sf_dir, "events").withColumn("block_num", shapes.event_block())
    blocks_seen = events.withColumns({"block_id": F.col("block_num").cast("string"), "cursor": F.col("block_num").cast("string")})
    middle = events.agg(F.max("block_num")).first()[0] // 2
    run_batch(job, store, blocks_seen.filter(F.col("block_num") < middle))
    store.compact(STORED)
    run_batch(job, store, blocks_seen.filter(F.col("block_num") >= middle))
    refused = store.read("rejects", REJECTS).filter(F.col("reject_reason") == "key_exists")
    own = events.select(F.col("event_id").alias("ordinal"), F.col("user_id").cast("string").alias("id"))
    named = refused.join(own, "ordinal").select(F.lit("refused").alias("part"), "id", "ordinal")
    alive = _plain(store.folded(STORED)).withColumn("part", F.lit("alive"))
    return named.unionByName(alive, allowMissingColumns=True)


BALANCES = contract("balances", "id text, account text, balance text", "id")


@query(
    "store_module_run",
    f"""select {ADDRESS_SQL} as id, {ADDRESS_SQL} as account, arg_max({CENTS_SQL}, event_id)::varchar as balance
from events group by user_id""",
)
def q_store_module_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of a store module and the map module that reads it, by name, in two batches of blocks."""
    store = BatchStore(spark, f"{_run_dir(spark)}/store")
    job = IngestJob("balances", "balance_table", [BALANCES], mode="changes")
    changed = shapes.balances(spark, sf_dir).withColumns(
        {"block_id": F.col("block_num").cast("string"), "cursor": F.col("block_num").cast("string")}
    )
    half = changed.agg(F.max("block_num")).first()[0] // 2 + 1
    for k in range(2):
        run_batch(job, store, changed.filter(F.expr(f"block_num div {half}") == k))
    return store.folded(BALANCES)


@query(
    "ingest_run",
    f"""with p as ({ORACLE['posts']})
select sha256('{changes.ROW_KEY_LABEL}<' || id || '_' || ordinal || '>') as id, profile_id,
  content_uri, timestamp from p""",
)
def q_ingest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run by module name: posts from event logs, in batch."""
    store = BatchStore(spark, f"{_run_dir(spark)}/store")
    run_batch(
        IngestJob("posts", "map_posts", [LENS_POSTS], algo="sha256"),
        store,
        shapes.post_logs(spark, sf_dir),
    )
    return store.rows(LENS_POSTS)
