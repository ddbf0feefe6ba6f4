import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chainloom.contracts import LENS_POSTS_OFFCHAIN
from chainloom.functions.posts_json import RECORDS
from chainloom.functions.typed import field, value
from chainloom.operators import links

LENSTER = {
    "appId": "Lenster",
    "version": "1",
    "metadata_id": "m",
    "name": "n",
    "content": "c",
    "external_url": "u",
    "mainContentFocus": "TEXT",
    "locale": "en",
    "attributes": [{"traitType": "a", "displayType": "b", "value": "c", "more": 1}],
    "media": [{"item": "i", "type": "t"}],
    "tags": ["x", "y"],
    "image": None,
    "unknown": {"a": [1]},
}
PHAVER = {
    k: v
    for k, v in {**LENSTER, "appId": "phaver"}.items()
    if k in ("appId", "version", "metadata_id", "name", "content", "attributes", "media")
}


def without(document, name):
    return {k: v for k, v in document.items() if k != name}


POSTS = [
    (LENSTER, True),
    (PHAVER, True),
    ({**LENSTER, "media": [], "tags": [], "attributes": []}, True),
    ({**LENSTER, "image": "i", "contentWarning": "w"}, True),
    ({**LENSTER, "media": [["i", "t"]]}, True),
    ({**LENSTER, "media": [["i"]]}, False),
    ({**LENSTER, "image": 1}, False),
    (without(LENSTER, "appId"), False),
    ({**LENSTER, "appId": 1}, False),
    ({**LENSTER, "appId": "lenster"}, False),
    ({**LENSTER, "appId": "other"}, False),
    (without(LENSTER, "tags"), False),
    (without(PHAVER, "tags"), True),
    (without(LENSTER, "locale"), False),
    ({**LENSTER, "name": 1}, False),
    ({**LENSTER, "name": None}, False),
    ({**LENSTER, "tags": ["x", 1]}, False),
    ({**LENSTER, "tags": "x"}, False),
    ({**LENSTER, "media": [{"item": "i", "type": "t"}, {"type": "t"}]}, False),
    ({**PHAVER, "attributes": [{"traitType": "a", "displayType": "b", "value": 3}]}, False),
    ([LENSTER], False),
    ("text", False),
]


def test_posts(spark):
    texts = [(f"u{i}", json.dumps(d), ok) for i, (d, ok) in enumerate(POSTS)]
    texts += [("bad", '{"appId": "Lenster"', False), ("empty", "", False), ("null", None, False)]
    frame = spark.createDataFrame([(u, t) for u, t, _ in texts], "uri string, content string")
    got = {r["uri"]: (r["app_id"], r["name"], r["content"]) for r in links.parse_posts(frame).collect()}
    assert sorted(got) == sorted(u for u, _, ok in texts if ok)
    assert got["u0"] == ("Lenster", "n", "c") and got["u1"] == ("phaver", "n", "c")


NOW = dt.datetime(2024, 5, 1, 12, 0, 0)
TASK = "uri string, manifest string, handler string, max_retries int, wait_before_retry int, num_retries int, state int, due_at timestamp_ntz"


def tasks(spark, *rows):
    return spark.createDataFrame(
        [(u, m, h, 3, 5, n, 0, dt.datetime(2024, 1, 1)) for u, m, h, n in rows], TASK
    )


def test_schemes(spark):
    cases = {
        "https://a.b/c": None,
        "HTTPS://a.b/c": None,
        "http://a.b/c": links.UNKNOWN_URI,
        "ar://id_1": None,
        "ipfs://Qm": links.UNKNOWN_URI,
        "no scheme": links.UNKNOWN_URI,
        "ftp://x": links.UNKNOWN_URI,
        "": links.UNKNOWN_URI,
    }
    frame = tasks(spark, *[(u, "demo", "h", 0) for u in cases])
    got = {r["uri"]: r["state"] for r in links.classify_tasks(frame, ["demo"]).collect()}
    assert got == {u: s or links.QUEUED for u, s in cases.items()}
    with_gateway = links.classify_tasks(frame, ["demo"], ["http://g"]).filter("uri = 'ipfs://Qm'")
    assert with_gateway.first()["state"] == links.QUEUED


def test_unknown_link_outranks_unknown_manifest(spark):
    frame = tasks(spark, ("x", "other", "h", 0), ("ar://x", "other", "h", 0))
    got = {r["uri"]: r["state"] for r in links.classify_tasks(frame, ["demo"]).collect()}
    assert got == {"x": links.UNKNOWN_URI, "ar://x": links.UNKNOWN_PARSER}


def test_addresses(spark):
    frame = tasks(spark, *[(u, "m", "h", 0) for u in ("https://a/b?c", "ar://ab_c/d", "ipfs://Qm#x", "ftp://x")])
    got = {r["uri"]: r["address"] for r in links.rewrite_links(frame, ["http://g:1", "http://h"]).collect()}
    assert got == {
        "https://a/b?c": "https://a/b?c",
        "ar://ab_c/d": "https://arweave.net/ab_c",
        "ipfs://Qm#x": "http://g:1/api/v0/cat?arg=Qm",
        "ftp://x": None,
    }


def test_retries(spark):
    frame = tasks(spark, *[(f"u{n}", "m", "h", n) for n in range(5)])
    got = {r["uri"]: (r["state"], r["num_retries"], r["due_at"]) for r in links.retry_schedule(frame, NOW).collect()}
    later, old = NOW + dt.timedelta(seconds=5), dt.datetime(2024, 1, 1)
    assert got == {
        "u0": (0, 1, later),
        "u1": (0, 2, later),
        "u2": (0, 3, later),
        "u3": (links.DOWNLOAD_FAILED, 3, old),
        "u4": (links.DOWNLOAD_FAILED, 4, old),
    }


def test_enqueue(spark):
    shape = "block_num long, ordinal long, pos int, uri string, manifest string, handler string, max_retries int, wait_before_retry int, num_retries int"
    rows = [(2, 0, 0, "a", "m", "late", 1, 1, 0), (1, 0, 0, "a", "m", "first", 1, 1, 0), (1, 1, 0, "a", "n", "x", 1, 1, 0), (1, 2, 0, "b", "m", "x", 1, 1, 0)]
    known = tasks(spark, ("b", "m", "old", 2))
    new = links.enqueue_tasks(known, spark.createDataFrame(rows, shape), NOW).collect()
    assert sorted((r["uri"], r["manifest"], r["handler"], r["state"]) for r in new) == [("a", "m", "first", 0), ("a", "n", "x", 0)]
    assert {r["due_at"] for r in new} == {NOW}


def two_records(content, uri):
    def record(number):
        fields = F.array(
            field("uri", value(string=uri)),
            field("app_id", value(string=F.lit(str(number)))),
            field("name", number),
            field("content", value(string=content)),
        )
        return F.struct(F.lit("lens_posts_offchain").alias("record"), fields.alias("fields"))

    good, broken = value(string=F.lit("n")), value(uint32=F.lit(2**31))
    return F.when(content == "two", F.array(record(good), record(broken)).cast(RECORDS)).when(
        content == "one", F.array(record(good)).cast(RECORDS)
    )


REGISTRY = {"demo": {"go": two_records}}


def test_outcomes(spark):
    frame = tasks(
        spark,
        ("ar://one", "demo", "go", 0),
        ("ar://two", "demo", "go", 0),
        ("ar://none", "demo", "go", 0),
        ("ar://big", "demo", "go", 0),
        ("ar://bytes", "demo", "go", 0),
        ("ar://missing", "demo", "go", 0),
        ("ar://spent", "demo", "go", 3),
        ("ar://handler", "demo", "stop", 0),
        ("ar://manifest", "other", "go", 0),
        ("ftp://x", "demo", "go", 0),
    )
    content = spark.createDataFrame(
        [
            ("ar://one", b"one"),
            ("ar://two", b"two"),
            ("ar://none", b"neither"),
            ("ar://big", b"x" * 200),
            ("ar://bytes", b"\xff\xff"),
            ("ar://handler", b"one"),
            ("ar://manifest", b"one"),
            ("ftp://x", b"one"),
        ],
        "uri string, content binary",
    )
    got = {
        r["uri"]: (r["state"], r["num_retries"])
        for r in links.task_outcomes(frame, content, REGISTRY, NOW, limit=100).collect()
    }
    assert got == {
        "ar://one": (links.FINISHED, 0),
        "ar://two": (links.PARSING_FAILED, 0),
        "ar://none": (links.PARSING_FAILED, 0),
        "ar://big": (links.CONTENT_TOO_BIG, 0),
        "ar://bytes": (links.PARSING_FAILED, 0),
        "ar://missing": (links.QUEUED, 1),
        "ar://spent": (links.DOWNLOAD_FAILED, 3),
        "ar://handler": (links.PARSING_FAILED, 0),
        "ar://manifest": (links.UNKNOWN_PARSER, 0),
        "ftp://x": (links.UNKNOWN_URI, 0),
    }
    resolved = links.resolve_tasks(links.attach_content(frame, content), REGISTRY, NOW, limit=100)
    rows = links.parsed_rows(resolved, LENS_POSTS_OFFCHAIN).collect()
    # The sibling of the record that cannot be built is kept.
    assert sorted(r["uri"] for r in rows) == ["ar://one", "ar://two"]


def test_size_limit_is_exclusive(spark):
    frame = spark.createDataFrame([("u", "m", "x" * 8), ("u", "m", "x" * 9)], "uri string, manifest string, content string")
    assert [r["too_big"] for r in links.size_guard(frame, 10).collect()] == [False, True]


def test_fetch_function(spark):
    def fetch(batches):
        for batch in batches:
            batch = batch[batch["address"].str.contains("arweave")]
            yield pd.DataFrame({"uri": batch["uri"], "content": [b"got"] * len(batch)})

    frame = tasks(spark, ("ar://a", "m", "h", 0), ("ar://a", "n", "h", 0), ("https://b", "m", "h", 0))
    got = links.attach_content(frame, fetcher=fetch).collect()
    assert sorted((r["uri"], r["manifest"], r["content"]) for r in got if r["content"]) == [
        ("ar://a", "m", bytearray(b"got")),
        ("ar://a", "n", bytearray(b"got")),
    ]
    assert len(got) == 3


@pytest.mark.parametrize("now, want", [(None, 2), (dt.datetime(2023, 1, 1), 0), (NOW, 2)])
def test_due(spark, now, want):
    frame = tasks(spark, ("a", "m", "h", 0), ("b", "m", "h", 0)).unionByName(
        tasks(spark, ("c", "m", "h", 0)).withColumn("state", F.lit(links.FINISHED))
    )
    assert links.queued_tasks(frame, now).count() == want


def test_content_given_twice_counts_once(spark):
    tasks = spark.createDataFrame([("u",), ("v",)], "uri string")
    content = spark.createDataFrame([("u", "b"), ("u", "a"), ("other", "c")], "uri string, content string")
    got = sorted(tuple(r) for r in links.attach_content(tasks, content).collect())
    assert got == [("u", "a"), ("v", None)]
