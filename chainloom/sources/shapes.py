"""The given tables in the shapes the operators take: blocks, change records, logs, balances, tasks.

Each shape is a projection of a whole table, so work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.contracts import CHANGE, CREATE, DELETE, UPDATE, contract
from chainloom.functions.events import topic0
from chainloom.functions.hexes import WORD, word_from_number
from chainloom.functions.typed import field, no_value, offchain_request, value
from chainloom.operators.logs import POST_HANDLER, POST_RETRIES, POST_WAIT, POSTS_CONTRACT

EVENTS_PER_BLOCK = 100

ACCOUNTS = contract(
    "accounts", "id text, value numeric(2), props text, user_id bigint, page text", "id"
)
ROUTED_TABLES = [
    contract(name, "id text, value numeric(2), props text, user_id bigint, page text", "id")
    for name in ("signup", "view", "click", "purchase")
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def number_hash(number: Column) -> Column:
    """Hash of a number as hex text: stands for the hash of a block or a transaction."""
    return F.sha2(number.cast("string"), 256)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks_of(table(spark, sf_dir, "orders"))


def blocks_of(orders: DataFrame) -> DataFrame:
    """One block per order; works on a stream as well."""
    number = F.col("o_orderkey")
    return orders.select(
        number.alias("block_num"),
        number_hash(number).alias("block_id"),
        F.concat(F.lit("c"), number.cast("string")).alias("cursor"),
        F.unhex(number_hash(number)).alias("hash"),
        F.unhex(number_hash(number - 1)).alias("parent_hash"),
        F.col("o_orderdate").alias("timestamp"),
    )


def forked_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block per event, and orphans: four blocks in fifty, forty in a thousand, and three at the head."""
    key = F.col("event_id")
    events = table(spark, sf_dir, "events")
    last = events.select(F.max("event_id")).scalar()

    def block(name: Column, parent: Column, orphan: bool) -> Column:
        return F.struct(name.alias("name"), parent.alias("parent"), F.lit(orphan).alias("orphan"))

    def fork(kind: str, here: Column, first: Column) -> Column:
        side, main = F.concat(F.lit(kind), (key - 1).cast("string")), (key - 1).cast("string")
        return F.when(here, block(F.concat(F.lit(kind), key.cast("string")), F.when(first, main).otherwise(side), True))

    made = F.array_compact(
        F.array(
            block(key.cast("string"), (key - 1).cast("string"), False),
            fork("a", (key % 50).between(7, 10), key % 50 == 7),
            fork("b", (key % 1000).between(100, 139), key % 1000 == 100),
            fork("h", key > last - 3, key == last - 2),
        )
    )
    return events.select("event_id", "ts", F.explode(made).alias("b")).select(
        key.alias("block_num"),
        F.sha2("b.name", 256).alias("block_id"),
        F.concat(F.lit("c"), F.col("b.name")).alias("cursor"),
        F.unhex(F.sha2("b.name", 256)).alias("hash"),
        F.unhex(F.sha2("b.parent", 256)).alias("parent_hash"),
        F.col("ts").cast("date").cast("string").alias("timestamp"),
        F.col("b.orphan").alias("orphan"),
    )


def event_block() -> Column:
    return F.expr(f"event_id div {EVENTS_PER_BLOCK}")


def operation_of(event_type: Column) -> Column:
    return (
        F.when(event_type.isin("signup", "view"), CREATE)
        .when(event_type.isin("click", "purchase"), UPDATE)
        .otherwise(DELETE)
        .cast("int")
    )


def money(column: Column) -> Column:
    return column.cast("decimal(18,2)").cast("string")


def event_fields() -> list[Column]:
    page = F.concat(F.lit("https://example.org/"), F.col("event_id").cast("string"))
    return [
        field("value", value(bigdecimal=money(F.col("value")))),
        field("props", value(string=F.col("props"))),
        field("user_id", value(uint64=F.col("user_id"))),
        field(
            "page",
            value(offchaindata=offchain_request(page, POST_HANDLER, POST_RETRIES, POST_WAIT)),
        ),
    ]


def changes_of(events: DataFrame, *, record: Column | None = None, fields: Column | None = None) -> DataFrame:
    """One change record per event, ordered by event_id; works on a stream as well."""
    number = event_block()
    return events.select(
        number.alias("block_num"),
        number_hash(number).alias("block_id"),
        F.concat(F.lit("c"), number.cast("string")).alias("cursor"),
        F.lit(0).alias("pos"),
        (F.lit("accounts") if record is None else record).alias("record"),
        F.col("user_id").cast("string").alias("id"),
        F.col("event_id").alias("ordinal"),
        operation_of(F.col("event_type")).alias("operation"),
        (F.array(*event_fields()) if fields is None else fields).alias("fields"),
    )


def changes(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return changes_of(table(spark, sf_dir, "events"), **options)


def dirty_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of which some break a rule: an old value, no new value, an array, a strange
    operation, an unknown column, a value that does not fit."""
    key = F.col("event_id")
    kept, missing = value(string=F.col("props")), no_value()
    fields = F.array(
        field("value", value(bigdecimal=F.when(key % 29 == 0, F.lit("1.234")).otherwise(money(F.col("value"))))),
        field("props", kept, F.when(key % 17 == 0, value(string=F.lit("old")))),
        field("user_id", F.when(key % 19 == 0, missing).otherwise(value(uint64=F.col("user_id")))),
        F.struct(
            F.when(key % 31 == 0, F.lit("extra")).otherwise(F.lit("page")).alias("name"),
            F.when(key % 23 == 0, value(array=F.array(F.lit("a"), F.lit("b"))))
            .otherwise(value(string=F.lit("p")))
            .alias("new_value"),
            no_value().alias("old_value"),
        ),
    )
    base = changes(spark, sf_dir, fields=fields)
    return base.withColumn(
        "operation", F.when(F.col("ordinal") % 37 == 0, 7).otherwise(F.col("operation"))
    )


def sparse_changes_of(events: DataFrame) -> DataFrame:
    """Change records that give only some columns, some of them set to NULL: for folding into a table."""
    key = F.col("event_type")
    props = F.when(F.col("event_id") % 5 != 0, value(string=F.col("props"))).otherwise(value())
    amount = field("value", value(bigdecimal=money(F.col("value"))))
    note = field("props", props)
    fields = (
        F.when(key == "click", F.array(amount))
        .when(key == "purchase", F.array(note))
        .when(key == "error", F.array().cast(CHANGE["fields"].dataType))
        .otherwise(F.array(amount, note))
    )
    return changes_of(events, fields=fields)


def nested_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with a list of none, one or two change records: one block per event."""
    key = F.col("event_id")
    first = F.struct(
        F.lit("accounts").alias("record"),
        F.col("user_id").cast("string").alias("id"),
        key.alias("ordinal"),
        operation_of(F.col("event_type")).alias("operation"),
        F.array(*event_fields()[:2]).alias("fields"),
    )
    second = F.struct(
        F.lit("audit").alias("record"),
        F.col("event_type").alias("id"),
        (key + 1).alias("ordinal"),
        F.lit(CREATE).alias("operation"),
        F.array(event_fields()[1]).alias("fields"),
    )
    some = F.slice(F.array(first, second), F.lit(1), (key % 3).cast("int"))
    return table(spark, sf_dir, "events").select(
        key.alias("block_num"),
        number_hash(key).alias("block_id"),
        F.concat(F.lit("c"), key.cast("string")).alias("cursor"),
        some.alias("record_changes"),
    )


def address_of(number: Column) -> Column:
    return F.unhex(F.lpad(F.hex(number), 40, "0"))


def topic_of(event_type: Column) -> Column:
    return F.unhex(F.sha2(event_type, 256))


def _bytes_argument(hex_content: Column) -> Column:
    """Length word and content, padded to whole words."""
    digits = F.length(hex_content)
    padded = (F.ceil(digits / WORD) * WORD).cast("int")
    return F.concat(word_from_number(F.floor(digits / 2)), F.rpad(hex_content, padded, "0"))


def _words(*numbers: int | Column) -> Column:
    return F.concat(*[word_from_number(F.lit(n) if isinstance(n, int) else n) for n in numbers])


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log per event: the event as an encoded post by its user.

    Views have one topic only. The data holds six head words (link offset, a module address, the
    offset of its bytes, another module, its bytes, the time) and then the link and empty bytes.
    """
    key, number = F.col("event_id"), event_block()
    link = F.col("__link")
    link_words = F.ceil(F.length(link) / WORD) + 1
    after_link = F.lit(6 * 32) + link_words * 32
    data = F.concat(
        _words(6 * 32, F.col("user_id"), after_link, 0, after_link, key),
        _bytes_argument(link),
        _words(0),
    )
    topics = F.array(
        topic_of(F.col("event_type")),
        F.unhex(word_from_number(F.col("user_id"))),
        F.unhex(word_from_number(key)),
    )
    first_only = F.col("event_type") == "view"
    link_text = F.concat(F.lit("https://example.org/"), F.col("props"))
    events = table(spark, sf_dir, "events")
    return events.withColumn("__link", F.lower(F.hex(F.encode(link_text, "UTF-8")))).select(
        number.alias("block_num"),
        number_hash(number).alias("block_id"),
        F.concat(F.lit("c"), number.cast("string")).alias("cursor"),
        F.unhex(number_hash(number)).alias("block_hash"),
        F.expr(f"(event_id % {EVENTS_PER_BLOCK}) div 10").cast("int").alias("tx_index"),
        F.unhex(number_hash(F.expr("event_id div 10"))).alias("tx_hash"),
        (key % EVENTS_PER_BLOCK).cast("int").alias("log_index"),
        key.alias("ordinal"),
        address_of(F.col("user_id")).alias("address"),
        F.when(first_only, F.slice(topics, 1, 1)).otherwise(topics).alias("topics"),
        F.unhex(data).alias("data"),
        "ts",
        "event_type",
    )


def traced_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One block per event, with up to two transactions of up to two logs and three calls each.

    The second transaction of a block has failed where the event is an error.
    """
    key, index = F.col("event_id"), F.col("event_id") % 3

    def log(tx: Column, at: Column) -> Column:
        return F.struct(
            at.cast("int").alias("index"),
            (key * 100 + tx * 10 + at).alias("ordinal"),
            address_of(F.col("user_id")).alias("address"),
            F.array(topic_of(F.col("event_type"))).alias("topics"),
            F.encode("props", "UTF-8").alias("data"),
        )

    def balance_change(tx: Column, call: Column) -> Column:
        amount = F.unhex(word_from_number(key * 10 + call))
        return F.struct(
            address_of(F.col("user_id") + tx).alias("address"), F.when(call != 1, amount).alias("new_value")
        )

    def call(tx: Column, at: Column) -> Column:
        none = F.array_repeat(balance_change(tx, at), 0)
        return F.struct(F.when(at == 2, none).otherwise(F.array(balance_change(tx, at))).alias("balance_changes"))

    def transaction(tx: Column) -> Column:
        logs_of = F.when(index > 0, F.transform(F.sequence(F.lit(1), index.cast("int")), lambda at: log(tx, at)))
        return F.struct(
            tx.cast("int").alias("index"),
            F.unhex(number_hash(key * 10 + tx)).alias("hash"),
            ((F.col("event_type") != "error") | (tx == 0)).alias("succeeded"),
            (key * 100 + tx * 10 + 9).alias("end_ordinal"),
            logs_of.alias("logs"),
            F.transform(F.sequence(F.lit(0), F.lit(2)), lambda at: call(tx, at)).alias("calls"),
        )

    return table(spark, sf_dir, "events").select(
        key.alias("block_num"),
        F.unhex(number_hash(key)).alias("block_hash"),
        F.transform(F.sequence(F.lit(0), (key % 2).cast("int")), transaction).alias("transactions"),
    )


def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contracts of all users below the middle id, with two event types each."""
    users = table(spark, sf_dir, "events").select("user_id")
    middle = users.select((F.max("user_id") / 2).alias("middle")).scalar()
    listed = users.distinct().filter(F.col("user_id") < middle)
    return listed.select(
        address_of(F.col("user_id")).alias("address"),
        F.explode(F.array(F.lit("signup"), F.lit("purchase"))).alias("event"),
    ).withColumn("topic0", topic_of(F.col("event")))


# The event type of a log of the posts contract, by the kind of the event that it is made of.
CONTRACT_EVENTS = {
    "signup": "ProfileCreated",
    "click": "CommentCreated",
    "purchase": "PostCreated",
    "error": "MirrorCreated",
}


def post_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All logs: of four event types of the posts contract, but views and every tenth log are of others."""
    kind, topics = F.col("event_type"), F.col("topics")
    named = F.coalesce(*[F.when(kind == k, F.unhex(F.lit(topic0(e)))) for k, e in CONTRACT_EVENTS.items()], topics[0])
    own = (kind != "view") & (F.col("ordinal") % 10 != 0)
    return logs(spark, sf_dir).withColumns(
        {
            "address": F.when(own, F.unhex(F.lit(POSTS_CONTRACT))).otherwise(F.col("address")),
            "topics": F.concat(F.array(named), F.slice(topics, 2, 5)),
        }
    )


def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balances_of(table(spark, sf_dir, "events"))


def balances_of(events: DataFrame) -> DataFrame:
    """One balance change per event, in cents as big-endian bytes; errors have none."""
    cents = (F.col("value").cast("decimal(18,2)") * 100).cast("bigint")
    return events.select(
        event_block().alias("block_num"),
        F.col("event_id").alias("end_ordinal"),
        F.lit(0).alias("pos"),
        address_of(F.col("user_id")).alias("address"),
        F.when(F.col("event_type") != "error", F.unhex(word_from_number(cents))).alias("new_value"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table to change: one account per supplier."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_acctbal").cast("decimal(38,2)").alias("value"),
        F.col("s_name").alias("props"),
    )


def page_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task per page, some with a manifest or handler nobody knows, some close to giving up."""
    key = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("uri"),
        F.when(key % 11 == 0, "other").otherwise("demo").alias("manifest"),
        F.when(key % 13 == 0, "no_such_handler").otherwise("parse_page").alias("handler"),
        F.lit(POST_RETRIES).alias("max_retries"),
        F.lit(POST_WAIT).alias("wait_before_retry"),
        (key % 5).cast("int").alias("num_retries"),
        F.lit(0).alias("state"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("due_at"),
    )


def page_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The content of the pages that were fetched: all but every seventh."""
    return table(spark, sf_dir, "pages").filter(F.col("page_id") % 7 != 0).select(
        F.col("url").alias("uri"), F.col("html").alias("content")
    )


def post_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per conversation turn: of a known app or not, complete or not."""
    role, turn = F.col("role"), F.col("turn")
    app = F.when(role == "user", "Lenster").when(role == "assistant", "phaver").otherwise("other")
    text = [
        F.lit(name).alias(alias)
        for alias, name in (
            ("version", "1.0.0"),
            ("metadata_id", "m"),
            ("external_url", "u"),
            ("mainContentFocus", "TEXT"),
            ("locale", "en"),
        )
    ]
    medium = F.struct(
        F.when(turn != 2, F.lit("i")).alias("item"), F.lit("t").alias("type")
    )
    document = F.struct(
        app.alias("appId"),
        *text,
        F.when(turn != 3, F.concat(F.lit("turn "), turn.cast("string"))).alias("name"),
        F.col("text").alias("content"),
        F.array(
            F.struct(
                F.lit("a").alias("traitType"), F.lit("b").alias("displayType"), F.lit("c").alias("value")
            )
        ).alias("attributes"),
        F.array(medium).alias("media"),
        F.array(F.lit("x")).alias("tags"),
    )
    return table(spark, sf_dir, "conversations").select(
        F.concat(
            F.lit("https://example.org/"), F.col("conv_id").cast("string"), F.lit("/"), turn.cast("string")
        ).alias("uri"),
        F.lit("demo").alias("manifest"),
        F.to_json(document).alias("content"),
    )
