"""Jobs on event logs: filter, decode, posts, one row per log, and one digest per block.

Log frames have block_num, block_hash, tx_index, tx_hash, log_index, ordinal, address, topics
(array of binary) and data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.functions.binding import bind
from chainloom.functions.events import EVENT_TYPES, WORD_BYTES, parameters, read_parameters, topic0
from chainloom.functions.hexes import (
    field_digits,
    hex_text,
    little_endian_hex,
    right_padded_word,
    word_to_decimal,
)
from chainloom.functions.skew import (
    BROADCAST_ROWS,
    GROUP_LIMIT,
    join_group_stats,
    join_lookup,
    join_same,
    row_position,
)
from chainloom.functions.typed import field, offchain_request, value
from chainloom.operators.blocks import change

# Contract whose posts are read, and the text that starts an event row's id (fixed values).
POSTS_CONTRACT = "db46d1dc155634fbc732f92e853b10b288ad5a1d"
EVENT_ID_LABEL = "tests.commitments.BLOCK_COMMITMENT"
# How posts ask for their content (fixed values).
POST_HANDLER, POST_RETRIES, POST_WAIT = "parse_offchain_data", 3, 5
TOPIC_COLUMNS = 5

LOG_ORDER = ("tx_index", "log_index")


def explode_logs(blocks: DataFrame) -> DataFrame:
    """One row per log of nested blocks, in the shape of a log frame. No shuffle.

    `blocks` has block_num, block_hash and transactions: an array of index, hash, succeeded and logs (index,
    ordinal, address, topics, data). Logs of transactions that failed are left out; a block or transaction
    without logs, or with NULL for them, gives no row. Other columns of the block are kept, but for those
    that have the name of a log column.
    """
    own = ("tx_index", "tx_hash", "log_index", "ordinal", "address", "topics", "data")
    others = [c for c in blocks.columns if c not in ("transactions", *own)]
    traces = blocks.select(*others, F.explode("transactions").alias("__tx"))
    found = traces.filter(F.col("__tx.succeeded")).select(*others, "__tx", F.explode("__tx.logs").alias("__log"))
    return found.select(
        *others,
        F.col("__tx.index").alias("tx_index"),
        F.col("__tx.hash").alias("tx_hash"),
        F.col("__log.index").alias("log_index"),
        *[F.col(f"__log.{c}").alias(c) for c in own[3:]],
    )


def event_signatures(
    spark: SparkSession, contracts: Sequence[str], events: Sequence[str] | None = None
) -> DataFrame:
    """address, topic0 and event of the named event types (all known ones without names) of each contract
    (hex): the table that `filter_event_logs` takes. An unknown event type is an error."""
    named = list(EVENT_TYPES if events is None else events)
    rows = [(bytes.fromhex(a), bytes.fromhex(topic0(e)), e) for a in dict.fromkeys(contracts) for e in dict.fromkeys(named)]
    return spark.createDataFrame(rows, "address binary, topic0 binary, event string")


def filter_event_logs(
    logs: DataFrame, signatures: DataFrame, *, bound: int = BROADCAST_ROWS, limit: int = GROUP_LIMIT
) -> DataFrame:
    """Logs of a listed contract and event type, with the name of the event.

    `signatures` has address, topic0 (binary) and event, one row per pair. Up to `bound` rows it is
    broadcast.
    """
    wanted = signatures.select("address", F.col("topic0").alias("__topic0"), "event")
    first = logs.withColumn("__topic0", F.get("topics", F.lit(0)))
    found = join_lookup(first, wanted, ["address", "__topic0"], bound=bound, limit=limit)
    return found.select(*logs.columns, "event")


def decode_event_fields(
    logs: DataFrame, event: str, numbers: str = "hex", only: Sequence[str] | None = None
) -> DataFrame:
    """Add the parameters of one event type as columns, or `only` those named.

    Numbers of 256 bits are hex words, or BIGINT or DECIMAL(38,0) by `numbers` (NULL if larger).
    Data that ends before a parameter gives NULL.
    """
    known = parameters(event)
    wanted = known if only is None else [p for p in known if p.name in only]
    return read_parameters(logs, wanted, known, numbers)


def posts(
    logs: DataFrame,
    table: str = "lens_posts",
    *,
    address: str = POSTS_CONTRACT,
    event: str = "PostCreated",
) -> DataFrame:
    """PostCreated logs of the contract as change records; the content link becomes a request.

    Other event types of the same contract, such as comments and mirrors, are no posts: a log is read only
    if its first topic is the hash of the event's signature. Address and topic are literals of the plan,
    so the scan can leave out what has other values. `event` may name another type that has the
    parameters of a post.
    """
    own = logs.filter(F.col("address") == F.unhex(F.lit(address)))
    own = own.filter(F.get("topics", F.lit(0)) == F.unhex(F.lit(topic0(event))))
    decoded = decode_event_fields(
        own, event, only=("profileId", "pubId", "contentURI", "timestamp")
    )
    decoded = bind(
        decoded,
        __profile=little_endian_hex(F.col("profileId")),
        __post=little_endian_hex(F.col("pubId")),
    )
    profile = F.col("__profile")
    record = change(
        table,
        F.concat(profile, F.lit("-"), F.col("__post")),
        F.col("ordinal"),
        [
            field("profile_id", value(string=profile)),
            field(
                "content_uri",
                value(
                    offchaindata=offchain_request(
                        F.col("contentURI"), POST_HANDLER, POST_RETRIES, POST_WAIT
                    )
                ),
            ),
            field("timestamp", value(uint64=word_to_decimal(F.col("timestamp")))),
        ],
    )
    kept = [c for c in ("block_num", "block_id", "cursor") if c in logs.columns]
    position = F.col("log_index").cast("int").alias("pos")
    return decoded.select(*kept, position, record.alias("change")).select(*kept, "pos", "change.*")


def data_words(data: Column, legacy_windows: bool = False) -> Column:
    """The data as hex text, all of its bytes.

    `legacy_windows` gives the overlapping windows of an older form instead: bytes i to i+32 for i
    from 1 to one less than the number of words.
    """
    if not legacy_windows:
        return hex_text(data)
    words = F.floor(F.octet_length(data) / WORD_BYTES).cast("int")
    windows = F.transform(
        F.sequence(F.lit(1), F.greatest(words - 1, F.lit(1))),
        lambda i: hex_text(F.substring(data, i + 1, F.lit(WORD_BYTES))),
    )
    return F.when(data.isNull(), None).when(words < 2, "").otherwise(F.array_join(windows, ""))


def event_rows(
    logs: DataFrame,
    *,
    legacy_windows: bool = False,
    commitments: DataFrame | None = None,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """One row per log, with the number of logs of its block and, if given, the block's digest.

    Logs without a block number belong to one block, whose number is NULL.
    """
    counts = logs.groupBy("block_num").agg(F.count(F.lit(1)).cast("int").alias("num_logs"))
    if commitments is not None:
        counts = join_same(counts, commitments.select("block_num", "commitment"), ["block_num"], "left")
    else:
        counts = counts.withColumn("commitment", F.lit(None).cast("string"))
    joined = join_group_stats(logs, counts, ["block_num"], limit=limit)
    # A step of its own: inside its lambdas the new column `address` would take the place of the log's.
    joined = joined.withColumn("addressF", field_digits(right_padded_word(F.col("address"))))
    block_hash, tx_hash = hex_text(F.col("block_hash")), hex_text(F.col("tx_hash"))
    topics = [
        right_padded_word(F.get("topics", F.lit(i))).alias(f"topic{i}") for i in range(TOPIC_COLUMNS)
    ]
    row_id = F.format_string(
        EVENT_ID_LABEL + "<%s_%s_%d_%d>", block_hash, tx_hash, F.col("tx_index"), F.col("log_index")
    )
    return joined.select(
        row_id.alias("id"),
        F.col("block_num").alias("blocknumber"),
        block_hash.alias("blockhash"),
        tx_hash.alias("txhash"),
        F.col("tx_index").alias("txindex"),
        F.col("log_index").alias("logindex"),
        right_padded_word(F.col("address")).alias("address"),
        *topics,
        data_words(F.col("data"), legacy_windows).alias("data"),
        "addressF",
        "commitment",
        "num_logs",
    )


def event_changes(rows: DataFrame, table: str = "eth_events") -> DataFrame:
    """The rows of `event_rows` as change records; absent topics give no field."""
    plain = ["blockhash", "txhash", "address", "data", "addressF"]
    unsigned = {"blocknumber": "uint64", "num_logs": "uint64", "txindex": "uint32", "logindex": "uint32"}
    fields = [field(n, value(**{kind: F.col(n)})) for n, kind in unsigned.items()]
    fields += [field(n, value(string=F.col(n))) for n in plain]
    fields.append(field("commitment", value(string=F.coalesce("commitment", F.lit("")))))
    optional = [
        F.when(F.col(f"topic{i}").isNotNull(), field(f"topic{i}", value(string=F.col(f"topic{i}"))))
        for i in range(TOPIC_COLUMNS)
    ]
    record = change(table, F.col("id"), F.lit(0), fields)
    with_topics = F.concat(F.col("change.fields"), F.array_compact(F.array(*optional)))
    return rows.select(
        F.col("blocknumber").alias("block_num"),
        F.col("logindex").cast("int").alias("pos"),
        record.alias("change"),
        *[f"topic{i}" for i in range(TOPIC_COLUMNS)],
    ).select("block_num", "pos", "change.record", "change.id", "change.ordinal", "change.operation",
             with_topics.alias("fields"))


def log_leaf() -> Column:
    """The text of a log that its leaf hashes."""
    return F.concat_ws(
        "|",
        F.col("tx_index").cast("string"),
        F.col("log_index").cast("string"),
        right_padded_word(F.col("address")),
        F.array_join(F.transform("topics", right_padded_word), ","),
        data_words(F.col("data")),
    )


def block_commitment(
    leaves: DataFrame,
    *,
    leaf: Column | None = None,
    order: tuple[str, ...] = LOG_ORDER,
    fan_levels: int = 10,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The root of a hash tree over the logs of each block, in order: block_num, num_logs, commitment.

    The tree of n logs has k = floor(log2 n) + 1 levels and 2^k leaves: padding, the count n, then
    the logs. Padding sits at the front, so a subtree of padding alone has a known hash and no rows.
    One round takes `fan_levels` levels: it groups the nodes by subtree, at most 2^fan_levels of them
    whatever the size of the block, and hashes each group in one expression. A block of a billion
    logs takes three rounds, and each round leaves a thousandth of the rows.
    """
    text = log_leaf() if leaf is None else leaf
    hashed = leaves.select("block_num", *order, F.sha2(text, 256).alias("hash"))
    counts = hashed.groupBy("block_num").agg(F.count(F.lit(1)).alias("n"))
    placed = row_position(hashed, ["block_num"], list(order), limit=limit)
    sized = counts.withColumn("k", F.length(F.bin("n")))
    largest = sized.agg(F.max("k")).first()[0]
    # Place of a node among the 2^k of its level; the leaf before the first log holds the count.
    logs = join_group_stats(placed, sized, ["block_num"], limit=limit).select(
        "block_num",
        "n",
        "k",
        (F.expr("shiftleft(1L, k)") - F.col("n") + F.col("position")).alias("place"),
        "hash",
    )
    count_leaf = sized.select(
        "block_num", "n", "k",
        (F.expr("shiftleft(1L, k)") - F.col("n") - 1).alias("place"),
        F.sha2(F.col("n").cast("string"), 256).alias("hash"),
    )
    nodes = logs.unionByName(count_leaf)
    padding = hashlib.sha256(b"0").hexdigest()
    level = 0
    while largest is not None and level < largest:
        nodes = _hash_round(nodes, level, fan_levels, padding)
        for _ in range(fan_levels):
            padding = hashlib.sha256((padding + padding).encode()).hexdigest()
        level += fan_levels
    return nodes.select("block_num", F.col("n").alias("num_logs"), F.col("hash").alias("commitment"))


def _hash_round(nodes: DataFrame, level: int, fan_levels: int, padding: str) -> DataFrame:
    """Replace the nodes of `level` by those `fan_levels` higher, or by the root if that is nearer."""
    steps = F.greatest(F.lit(0), F.least(F.lit(fan_levels), F.col("k") - level))
    grouped = (
        nodes.withColumn("steps", steps)
        .groupBy("block_num", "n", "k", "steps", F.expr("shiftright(place, steps)").alias("place"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("place").alias("at"), "hash"))).alias("nodes"))
    )
    width = F.expr("shiftleft(1, steps)")
    known = F.transform("nodes", lambda node: node["hash"])
    row = F.concat(F.array_repeat(F.lit(padding), width - F.size("nodes")), known)

    def pair_up(hashes: Column, _step: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), (F.size(hashes) / 2).cast("int") - 1),
            lambda i: F.sha2(F.concat(F.get(hashes, i * 2), F.get(hashes, i * 2 + 1)), 256),
        )

    each_step = F.slice(F.sequence(F.lit(1), F.lit(fan_levels)), F.lit(1), F.col("steps"))
    root = F.aggregate(each_step, row, pair_up)
    return grouped.select("block_num", "n", "k", "place", F.get(root, F.lit(0)).alias("hash"))
