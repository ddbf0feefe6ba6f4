"""Links found in the data: task queue, addresses, content, retries, parsing and outcomes.

Task frames have uri, manifest, handler, max_retries, wait_before_retry, num_retries, state, due_at;
a task is named by (uri, manifest). Content frames have uri (once each) and content, landed by any
fetch job; a task without content had a failed attempt.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.contracts import Contract
from chainloom.functions.posts_json import RECORDS, parse_post
from chainloom.functions.skew import fits_broadcast
from chainloom.functions.typed import narrow_uint32, narrow_uint64
from chainloom.operators.changes import conform_to_contract, fields_to_columns
from chainloom.operators.keyed import existing_keys

# Task states (fixed values).
QUEUED = 0
UNKNOWN_URI = 1
UNKNOWN_PARSER = 2
DOWNLOAD_FAILED = 3
PARSING_FAILED = 4
CONTENT_TOO_BIG = 5
FINISHED = 6

# Largest content that is parsed, in bytes, and the address of the archive gateway (fixed values).
MAX_CONTENT_SIZE = 1024 * 1024
ARCHIVE_GATEWAY = "https://arweave.net/"

# Downloads at once, where the caller names no other number.
MAX_CONCURRENT = 10

TASK_KEY = ("uri", "manifest")
TASK_COLUMNS = (
    "uri",
    "manifest",
    "handler",
    "max_retries",
    "wait_before_retry",
    "num_retries",
    "state",
    "due_at",
)

# A handler turns (content, uri) into an array of records; a registry names them per manifest.
Handler = Callable[[Column, Column], Column]
Registry = Mapping[str, Mapping[str, Handler]]

POST_HANDLERS: Mapping[str, Handler] = {"parse_offchain_data": parse_post}


def _instant(now: dt.datetime | str) -> Column:
    return F.lit(str(now)).cast("timestamp_ntz")


def enqueue_tasks(
    tasks: DataFrame | None,
    requests: DataFrame,
    now: dt.datetime | str,
    *,
    order: Sequence[str] = ("block_num", "ordinal", "pos"),
) -> DataFrame:
    """The new tasks among `requests`, queued and due at once.

    The first request of a (uri, manifest) wins, also over later batches. The first one is taken by
    an aggregate, so that a link that everybody posts is reduced before the shuffle.
    """
    others = ["handler", "max_retries", "wait_before_retry", "num_retries"]
    new = (
        requests.groupBy(*TASK_KEY)
        .agg(F.min_by(F.struct(*others), F.struct(*order)).alias("first"))
        .select(*TASK_KEY, "first.*")
    )
    if tasks is not None:
        known = existing_keys(new, tasks, TASK_KEY)
        new = new.join(known, list(TASK_KEY), "left_anti")
    return new.select(
        *TASK_KEY, *others, F.lit(QUEUED).alias("state"), _instant(now).alias("due_at")
    )


def queued_tasks(tasks: DataFrame, now: dt.datetime | str | None = None) -> DataFrame:
    """Tasks still to do; with `now`, those that are due. A restart takes all of them at once."""
    queued = tasks.filter(F.col("state") == QUEUED)
    return queued if now is None else queued.filter(F.col("due_at") <= _instant(now))


def link_scheme(uri: Column) -> Column:
    """The scheme of a link, NULL when it has none or is no link at all."""
    scheme = F.try_parse_url(uri, F.lit("PROTOCOL"))
    return F.when(F.lower(scheme) == "https", F.lit("https")).otherwise(scheme)


def link_host(uri: Column) -> Column:
    """The part after the scheme, NULL when empty. Ids with an underscore are no host names to a URL
    parser, so it is cut out by pattern."""
    host = F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)
    return F.when(host != "", host)


def known_schemes(ipfs_gateways: Sequence[str] = ()) -> list[str]:
    return ["https", "ar", "ipfs"] if ipfs_gateways else ["https", "ar"]


def classify(uri: Column, manifest: Column, schemes: Sequence[str], manifests: Sequence[str]) -> Column:
    """UNKNOWN_URI, UNKNOWN_PARSER or NULL; the link is looked at first.

    Both registries are settings of the run, so they are literal lists.
    """
    known_scheme = F.coalesce(link_scheme(uri).isin(list(schemes)), F.lit(False))
    known_manifest = F.coalesce(manifest.isin(list(manifests)), F.lit(False))
    return F.when(~known_scheme, F.lit(UNKNOWN_URI)).when(~known_manifest, F.lit(UNKNOWN_PARSER))


def classify_tasks(
    tasks: DataFrame, manifests: Sequence[str], ipfs_gateways: Sequence[str] = ()
) -> DataFrame:
    """Tasks with the state that ends those nobody can resolve; the others keep theirs."""
    ended = classify(F.col("uri"), F.col("manifest"), known_schemes(ipfs_gateways), manifests)
    return tasks.withColumn("state", F.coalesce(ended, F.col("state")))


def fetch_address(uri: Column, ipfs_gateways: Sequence[str] = ()) -> Column:
    """Where the content of a link is fetched; NULL when the link cannot be resolved."""
    scheme, host = link_scheme(uri), link_host(uri)
    address = F.when(scheme == "https", uri).when(
        scheme == "ar", F.concat(F.lit(ARCHIVE_GATEWAY), host)
    )
    if ipfs_gateways:
        address = address.when(
            scheme == "ipfs", F.concat(F.lit(f"{ipfs_gateways[0]}/api/v0/cat?arg="), host)
        )
    return address


def rewrite_links(
    tasks: DataFrame, ipfs_gateways: Sequence[str] = (), *, out: str = "address"
) -> DataFrame:
    return tasks.withColumn(out, fetch_address(F.col("uri"), ipfs_gateways))


def attach_content(
    tasks: DataFrame,
    content: DataFrame | None = None,
    *,
    fetcher: Callable | None = None,
    ipfs_gateways: Sequence[str] = (),
    max_concurrent: int = MAX_CONCURRENT,
) -> DataFrame:
    """Tasks with their content, NULL after a failed attempt.

    Either from a content table, by uri, or from a user's fetch function: it takes and gives batches
    of pandas frames (uri, address) → (uri, content) as `mapInPandas` does, and runs on executors, at
    most one batch per partition at a time, in `max_concurrent` partitions. Content that is given twice for a uri counts once, the
    smaller one; content that no task asks for is left out before it is shuffled any further.
    """
    if fetcher is not None:
        addresses = rewrite_links(tasks, ipfs_gateways).select("uri", "address").distinct()
        spread = addresses.filter(F.col("address").isNotNull()).repartition(max_concurrent)
        content = spread.mapInPandas(fetcher, "uri string, content binary")
    uris = tasks.select("uri").distinct()
    if fits_broadcast(uris):
        uris = F.broadcast(uris)
    asked = content.select("uri", "content").join(uris, "uri", "left_semi")
    once = asked.groupBy("uri").agg(F.min("content").alias("content"))
    return tasks.join(once, "uri", "left")


def retry_columns(now: dt.datetime | str) -> dict[str, Column]:
    """State, counter and due time of a task after a failed attempt."""
    again = F.col("num_retries") < F.col("max_retries")
    wait = F.make_dt_interval(secs=F.col("wait_before_retry"))
    return {
        "state": F.when(again, F.lit(QUEUED)).otherwise(F.lit(DOWNLOAD_FAILED)),
        "due_at": F.when(again, _instant(now) + wait).otherwise(F.col("due_at")),
        "num_retries": F.when(again, F.col("num_retries") + 1).otherwise(F.col("num_retries")),
    }


def retry_schedule(failed: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Failed tasks with another attempt scheduled, or given up after max_retries of them."""
    return failed.withColumns(retry_columns(now))


def message_size(uri: Column, manifest: Column, content: Column) -> Column:
    return F.octet_length(uri) + F.octet_length(manifest) + F.octet_length(content)


def size_guard(contents: DataFrame, limit: int = MAX_CONTENT_SIZE) -> DataFrame:
    """Add `too_big`: content that is not to be parsed."""
    size = message_size(F.col("uri"), F.col("manifest"), F.col("content"))
    return contents.withColumn("too_big", size > limit)


def parse_posts(contents: DataFrame) -> DataFrame:
    """uri, app_id, name, content of each document that is a post; the others give no row."""
    records = contents.select(
        F.explode(parse_post(F.col("content").cast("string"), F.col("uri"))).alias("record")
    )
    values = F.transform("record.fields", lambda f: f["new_value"]["string"])
    names = ("uri", "app_id", "name", "content")
    return records.select(*[F.get(values, F.lit(i)).alias(n) for i, n in enumerate(names)])


def resolve_tasks(
    tasks: DataFrame,
    registry: Registry,
    now: dt.datetime | str,
    *,
    ipfs_gateways: Sequence[str] = (),
    limit: int = MAX_CONTENT_SIZE,
) -> DataFrame:
    """One attempt for each task with its content attached: new state, counter and due time, and the
    parsed `records`. Everything is a column of the task's own row; nothing is shuffled."""
    content = F.col("content").cast("string")
    ended = classify(F.col("uri"), F.col("manifest"), known_schemes(ipfs_gateways), list(registry))
    readable = F.is_valid_utf8(content)
    size = message_size(F.col("uri"), F.col("manifest"), F.col("content"))

    parsed = F.lit(None).cast(RECORDS)
    for manifest, handlers in registry.items():
        for name, handler in handlers.items():
            here = (F.col("manifest") == manifest) & (F.col("handler") == name)
            parsed = F.when(here, handler(content, F.col("uri"))).otherwise(parsed)
    attempted = tasks.withColumn("__ended", ended).withColumn(
        "records",
        F.when(F.col("__ended").isNull() & readable & (size <= limit), parsed),
    )
    none = F.size(F.coalesce("records", F.array().cast(RECORDS))) == 0
    broken = F.exists("records", lambda r: ~_buildable(r["fields"]))
    retry = retry_columns(now)
    failed = F.col("__ended").isNull() & F.col("content").isNull()
    state = (
        F.when(F.col("__ended").isNotNull(), F.col("__ended"))
        .when(failed, retry["state"])
        .when(~readable, F.lit(PARSING_FAILED))
        .when(size > limit, F.lit(CONTENT_TOO_BIG))
        .when(none | broken, F.lit(PARSING_FAILED))
        .otherwise(F.lit(FINISHED))
    )
    return attempted.withColumns(
        {
            "state": state,
            "num_retries": F.when(failed, retry["num_retries"]).otherwise(F.col("num_retries")),
            "due_at": F.when(failed, retry["due_at"]).otherwise(F.col("due_at")),
        }
    ).select(*TASK_COLUMNS, "records")


def _buildable(fields: Column) -> Column:
    """Whether every field of a parsed record is a value that a column can take."""

    def fits(f: Column) -> Column:
        v = f["new_value"]
        narrow = (v["uint32"].isNull() | narrow_uint32(v["uint32"]).isNotNull()) & (
            v["uint64"].isNull() | narrow_uint64(v["uint64"]).isNotNull()
        )
        return v.isNotNull() & v["array"].isNull() & v["offchaindata"].isNull() & narrow

    return F.forall(fields, lambda f: F.coalesce(fits(f), F.lit(False)))


def attempt_tasks(
    tasks: DataFrame,
    content: DataFrame | None,
    registry: Registry,
    now: dt.datetime | str,
    *,
    fetcher: Callable | None = None,
    ipfs_gateways: Sequence[str] = (),
    max_concurrent: int = MAX_CONCURRENT,
    limit: int = MAX_CONTENT_SIZE,
) -> DataFrame:
    """`resolve_tasks` with the content attached. Only tasks that can be resolved are looked up or
    fetched, so a link has no more rows in the join than there are manifests."""
    ended = classify(
        F.col("uri"), F.col("manifest"), known_schemes(ipfs_gateways), list(registry)
    )
    marked = tasks.withColumn("__doomed", ended.isNotNull())
    live = attach_content(
        marked.filter(~F.col("__doomed")),
        content,
        fetcher=fetcher,
        ipfs_gateways=ipfs_gateways,
        max_concurrent=max_concurrent,
    )
    doomed = marked.filter("__doomed").withColumn("content", F.lit(None).cast(live.schema["content"].dataType))
    return resolve_tasks(
        live.unionByName(doomed).drop("__doomed"),
        registry,
        now,
        ipfs_gateways=ipfs_gateways,
        limit=limit,
    )


def task_outcomes(
    tasks: DataFrame,
    content: DataFrame,
    registry: Registry,
    now: dt.datetime | str,
    **options,
) -> DataFrame:
    """The new state of every task after one attempt."""
    return attempt_tasks(tasks, content, registry, now, **options).select(*TASK_COLUMNS)


def parsed_rows(resolved: DataFrame, contract: Contract) -> DataFrame:
    """Rows of one table from the records of resolved tasks; a record that does not fit the table is
    left out, its siblings are kept."""
    records = (
        resolved.select(F.posexplode("records").alias("pos", "r"))
        .filter(_buildable(F.col("r.fields")) & (F.col("r.record") == contract.table))
        .select(
            F.lit(0).cast("bigint").alias("block_num"),
            F.lit(0).cast("bigint").alias("ordinal"),
            "pos",
            F.lit(None).cast("string").alias("id"),
            F.lit(1).alias("operation"),
            "r.record",
            "r.fields",
        )
    )
    fitting = conform_to_contract(records, contract).filter(F.col("reject_reason").isNull())
    return fields_to_columns(fitting, contract, key="id")
