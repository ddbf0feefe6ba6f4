import hashlib

import pytest
from pyspark.sql import functions as F

from chainloom.functions import hexes
from chainloom.functions.events import EVENT_TYPES, parameters, signature, topic0
from chainloom.functions.keccak import keccak256, sponge
from chainloom.operators import balances, logs


def word(number):
    return number.to_bytes(32, "big")


def signed_little_endian(number):
    length = max(1, number.bit_length() // 8 + 1) if number else 1
    return number.to_bytes(length, "little", signed=True).hex()


NUMBERS = [0, 1, 127, 128, 255, 256, 32767, 32768, 65535, 2**63, 2**64, 10**38 - 1, 10**38, 2**255, 2**256 - 1]


def test_numbers_in_words(spark):
    rows = spark.createDataFrame([(word(n),) for n in NUMBERS], "w binary")
    rows = rows.select(hexes.hex_text(F.col("w")).alias("w"))
    got = rows.select(
        hexes.little_endian_hex(F.col("w")).alias("little"),
        hexes.word_to_text(F.col("w")).alias("text"),
        hexes.word_to_bigint(F.col("w")).alias("big"),
        hexes.word_to_decimal(F.col("w")).alias("decimal"),
    ).collect()
    for number, row in zip(NUMBERS, got):
        assert row["little"] == signed_little_endian(number)
        assert row["text"] == str(number)
        assert row["big"] == (number if number < 2**63 else None)
        assert row["decimal"] is None or row["decimal"] == number
        assert (row["decimal"] is not None) == (number < (10**38 - 1) // 2**64 * 2**64)


def encode(*arguments):
    """Head words and tails of (kind, value) arguments."""
    heads, tails = [], b""
    size = 32 * len(arguments)

    def padded(data):
        return word(len(data)) + data + b"\0" * (-len(data) % 32)

    for kind, given in arguments:
        if kind in ("string", "bytes"):
            heads.append(word(size + len(tails)))
            tails += padded(given)
        elif kind == "words":
            heads.append(word(size + len(tails)))
            tails += word(len(given)) + b"".join(word(v) for v in given)
        elif kind == "list":
            heads.append(word(size + len(tails)))
            inner, places = b"", []
            for item in given:
                places.append(word(32 * len(given) + len(inner)))
                inner += padded(item)
            tails += word(len(given)) + b"".join(places) + inner
        else:
            heads.append(word(given))
    return b"".join(heads) + tails


def log_frame(spark, *rows):
    return spark.createDataFrame(
        [(i, list(topics), data) for i, (topics, data) in enumerate(rows)],
        "n int, topics array<binary>, data binary",
    )


def test_event_types():
    assert len(EVENT_TYPES) == 35
    assert [p.name for p in parameters("Followed") if p.indexed] == ["follower"]
    for event in EVENT_TYPES:
        assert sum(p.indexed for p in parameters(event)) <= 3


@pytest.mark.parametrize("event", EVENT_TYPES)
def test_every_event_type_has_its_columns(spark, event):
    frame = log_frame(spark, ([word(1)], b""))
    decoded = logs.decode_event_fields(frame, event)
    assert decoded.columns[3:] == [p.name for p in parameters(event)]


def test_decode_only_some(spark):
    frame = log_frame(spark, ([word(1), word(2), word(3)], encode(("uint256", 32), ("uint256", 7))))
    row = logs.decode_event_fields(frame, "PostCreated", "bigint", only=("pubId", "collectModule")).first()
    assert row.asDict().keys() == {"n", "topics", "data", "pubId", "collectModule"}
    assert row["pubId"] == 3 and row["collectModule"] == word(7)[12:].hex()


def test_decode_lists(spark):
    data = encode(("words", [5, 2**200]), ("list", [b"", b"abc" * 20]), ("uint256", 9))
    address = b"\0" * 12 + b"\x11" * 20
    frame = log_frame(spark, ([word(1), address], data), ([word(1), address], data[:70]))
    full, cut = logs.decode_event_fields(frame, "Followed").orderBy("n").collect()
    assert full["follower"] == "11" * 20
    assert full["profileIds"] == [word(5).hex(), word(2**200).hex()]
    assert full["followModuleDatas"] == ["", (b"abc" * 20).hex()]
    assert full["timestamp"] == word(9).hex()
    assert cut["profileIds"] is None and cut["timestamp"] is None


def test_decode_flags_and_empty_list(spark):
    data = encode(("words", []), ("words", [1, 0]), ("uint256", 9))
    frame = log_frame(spark, ([word(1), word(2)], data))
    row = logs.decode_event_fields(frame, "FollowsToggled", "bigint").first()
    assert row["profileIds"] == [] and row["enabled"] == [True, False] and row["timestamp"] == 9


def test_decode_text(spark):
    good = encode(("string", "né".encode()), ("string", b"S"), ("uint256", 2**70))
    bad = encode(("string", b"\xff\xfe"), ("string", b""), ("uint256", 1))
    wild = word(2**250) + word(64) + word(1)
    frame = log_frame(spark, ([word(1)], good), ([word(1)], bad), ([word(1)], wild), ([word(1)], b""))
    rows = logs.decode_event_fields(frame, "BaseInitialized", "decimal").orderBy("n").collect()
    assert [r["name"] for r in rows] == ["né", None, None, None]
    assert [r["symbol"] for r in rows][:2] == ["S", ""]
    assert [r["timestamp"] for r in rows] == [2**70, 1, 1, None]


def test_decode_small_numbers(spark):
    frame = log_frame(spark, ([word(1), word(7), word(2), word(3)], encode(("uint256", 1))))
    row = logs.decode_event_fields(frame, "StateSet").first()
    assert (row["prevState"], row["newState"]) == (2, 3)


def test_filter_needs_both_address_and_type(spark):
    a, b = b"\xaa" * 20, b"\xbb" * 20
    frame = spark.createDataFrame(
        [(1, a, [word(1)]), (2, a, [word(2)]), (3, b, [word(1)]), (4, a, [])],
        "n int, address binary, topics array<binary>",
    )
    wanted = spark.createDataFrame([(a, word(1), "E")], "address binary, topic0 binary, event string")
    assert [(r["n"], r["event"]) for r in logs.filter_event_logs(frame, wanted).collect()] == [(1, "E")]


@pytest.mark.parametrize("size", [0, 31, 32, 63, 64, 100, 160])
def test_data_words(spark, size):
    data = bytes(range(size))
    frame = spark.createDataFrame([(bytearray(data),)], "data binary")
    words = size // 32
    plain = frame.select(logs.data_words(F.col("data"))).first()[0]
    assert plain == data.hex()
    legacy = frame.select(logs.data_words(F.col("data"), True)).first()[0]
    assert legacy == b"".join(data[i : i + 32] for i in range(1, words)).hex()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def root(texts):
    """The tree of the leaves: padding, the count, then the texts."""
    n = len(texts)
    leaves = [sha("0")] * (2 ** n.bit_length() - n - 1) + [sha(str(n))] + [sha(t) for t in texts]
    while len(leaves) > 1:
        leaves = [sha(a + b) for a, b in zip(leaves[::2], leaves[1::2])]
    return leaves[0]


@pytest.mark.parametrize("fan_levels, limit", [(10, 1_000_000), (2, 1_000_000), (3, 10)])
def test_commitment(spark, fan_levels, limit):
    sizes = [1, 2, 3, 4, 7, 8, 15, 16, 33, 500]
    data = [(n, i, f"{n}:{i}") for n in sizes for i in range(n)]
    frame = spark.createDataFrame(data, "block_num long, at long, text string").repartition(7)
    got = logs.block_commitment(
        frame, leaf=F.col("text"), order=("at",), fan_levels=fan_levels, limit=limit
    ).collect()
    assert {r["block_num"]: r["commitment"] for r in got} == {
        n: root([f"{n}:{i}" for i in range(n)]) for n in sizes
    }
    assert all(r["num_logs"] == r["block_num"] for r in got) and len(got) == len(sizes)


def test_commitment_of_nothing(spark):
    frame = spark.createDataFrame([], "block_num long, at long, text string")
    assert logs.block_commitment(frame, leaf=F.col("text"), order=("at",)).count() == 0


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_event_rows(spark, limit):
    data = [
        (n, bytes([n]), 1, b"\x01", i, i, b"\xaa" * 20, [word(t) for t in range(i % 7)], b"\x07" * 70)
        for n in (1, 2)
        for i in range(12 if n == 1 else 3)
    ]
    frame = spark.createDataFrame(
        data,
        "block_num long, block_hash binary, tx_index int, tx_hash binary, log_index int, ordinal long,"
        "address binary, topics array<binary>, data binary",
    )
    commitments = logs.block_commitment(frame, limit=limit)
    rows = logs.event_rows(frame, commitments=commitments, limit=limit).collect()
    assert len(rows) == 15
    by_id = {r["id"]: r for r in rows}
    six = by_id["tests.commitments.BLOCK_COMMITMENT<01_01_1_6>"]
    assert six["topic4"] == word(4).hex() and six["num_logs"] == 12
    assert six["address"] == "aa" * 20 + "0" * 24 and six["data"] == "07" * 70
    none = by_id["tests.commitments.BLOCK_COMMITMENT<02_01_1_0>"]
    assert none["topic0"] is None and none["num_logs"] == 3
    assert len({r["commitment"] for r in rows}) == 2
    fields = logs.event_changes(logs.event_rows(frame)).filter("size(fields) = 15").count()
    assert fields == 2 + 0  # ten common fields and five topics: positions 5 and 6 of the first block


def test_commitment_depends_on_every_byte(spark):
    schema = "block_num long, tx_index int, log_index int, address binary, topics array<binary>, data binary"
    rows = [(1, 0, 0, b"a", [word(1)], word(7) + b"tail"), (2, 0, 0, b"a", [word(1)], word(7) + b"tale")]
    frame = spark.createDataFrame([tuple(map(lambda v: bytearray(v) if isinstance(v, bytes) else v, r)) for r in rows], schema)
    roots = {r["block_num"]: r["commitment"] for r in logs.block_commitment(frame).collect()}
    assert roots[1] != roots[2]


def test_digits_in_the_field(spark):
    """Digits in base p give the number back."""
    digest = int.from_bytes(hashlib.sha256(b"hello world").digest(), "little")
    prime = hexes.FIELD_PRIME
    numbers = [*NUMBERS, digest, prime - 1, prime, prime + 1, prime**2 - 1, prime**3, prime**4 - 1]
    rows = [(n.to_bytes(32, "little").hex(),) for n in numbers] + [(None,), ("00",)]
    got = spark.createDataFrame(rows, "w string").select("w", hexes.field_digits(F.col("w")).alias("d")).collect()
    digits = {r["w"]: r["d"] for r in got}
    assert digits[None] is None and digits["00"] is None
    for n in numbers:
        text = digits[n.to_bytes(32, "little").hex()]
        parts = [int.from_bytes(bytes.fromhex(text[i : i + 16]), "little") for i in range(0, 80, 16)]
        assert len(text) == 80 and max(parts) < prime
        assert sum(part * prime**i for i, part in enumerate(parts)) == n


def test_keccak():
    assert keccak256(b"").hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    transfer = "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
    assert keccak256(b"Transfer(address,address,uint256)").hex() == transfer
    for size in (0, 1, 134, 135, 136, 137, 271, 272, 1000):
        data = bytes(i * 7 % 256 for i in range(size))
        # The standardised digest differs only in how the padding starts.
        assert sponge(data, 0x06) == hashlib.sha3_256(data).digest()


def test_signatures_of_events(spark):
    assert signature("FollowNFTURISet") == "FollowNFTURISet(uint256,string,uint256)"
    assert signature("Followed") == "Followed(address,uint256[],bytes[],uint256)"
    assert len({topic0(event) for event in EVENT_TYPES}) == len(EVENT_TYPES) == 35
    table = logs.event_signatures(spark, ["aa" * 20, "bb" * 20, "aa" * 20])
    assert table.count() == 2 * 35 and table.distinct().count() == 2 * 35
    with pytest.raises(KeyError):
        logs.event_signatures(spark, ["aa" * 20], ["NoSuchEvent"])


def test_posts_are_of_the_contract_and_of_their_event(spark):
    from chainloom.sources import shapes

    mixed = shapes.post_logs(spark, "/root/testdata/sf0.001")
    own = F.col("address") == F.unhex(F.lit(logs.POSTS_CONTRACT))
    posted = own & (F.col("event_type") == "purchase")
    assert 0 < mixed.filter(posted).count() < mixed.filter(own).count() < mixed.count()
    found = {r["ordinal"] for r in logs.posts(mixed).collect()}
    assert found == {r["ordinal"] for r in mixed.filter(posted).collect()}
    assert logs.posts(mixed, address="ff" * 20).count() == 0
    # No topics at all, and a topic that no event has.
    odd = mixed.withColumn("topics", F.when(F.col("ordinal") % 2 == 0, F.array().cast("array<binary>")).otherwise(F.array(F.lit(b"x"))))
    assert logs.posts(odd).count() == 0


@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_logs_without_a_block_stay(spark, limit):
    from chainloom.sources import shapes

    frame = shapes.logs(spark, "/root/testdata/sf0.001").withColumn(
        "block_num", F.when(F.col("block_num") % 3 != 0, F.col("block_num"))
    )
    roots = logs.block_commitment(frame, limit=limit)
    rows = logs.event_rows(frame, commitments=roots, limit=limit)
    assert rows.count() == frame.count()
    lost = rows.filter("blocknumber is null")
    assert lost.count() == frame.filter("block_num is null").count() > 0
    assert lost.select("num_logs", "commitment").distinct().collect()[0]["num_logs"] == lost.count()
    assert rows.filter("commitment is null").count() == 0


def test_nested_blocks(spark):
    """Logs of successful transactions, balance changes of all; nothing where there is nothing."""
    log = "struct<index: int, ordinal: bigint, address: binary, topics: array<binary>, data: binary>"
    call = "struct<balance_changes: array<struct<address: binary, new_value: binary>>>"
    trace = f"struct<index: int, hash: binary, succeeded: boolean, end_ordinal: bigint, logs: array<{log}>, calls: array<{call}>>"
    b = lambda n: bytearray([n])
    changed = [([(b(1), b(5)), (b(2), None)],), (None,), ([],), ([(b(1), b(6))],)]
    blocks = spark.createDataFrame(
        [
            (1, b(1), [(0, b(9), True, 7, [(0, 3, b(4), [], b(0)), (1, 4, b(4), None, None)], changed)], "kept", "clash"),
            (2, b(2), [(0, b(8), False, 8, [(0, 3, b(4), [], b(0))], changed[:1]), (1, b(7), None, 9, None, None)], "kept", "clash"),
            (3, b(3), [], None, None),
            (4, b(4), None, None, None),
        ],
        f"block_num long, block_hash binary, transactions array<{trace}>, note string, data string",
    )
    got = logs.explode_logs(blocks)
    assert sorted((r["block_num"], r["tx_index"], r["log_index"], r["ordinal"], r["note"]) for r in got.collect()) == [
        (1, 0, 0, 3, "kept"),
        (1, 0, 1, 4, "kept"),
    ]
    assert dict(got.dtypes)["data"] == "binary"
    rows = sorted(tuple(r)[:4] for r in balances.explode_balance_changes(blocks).collect())
    assert rows == [(1, 7, 0, b(1)), (1, 7, 1, b(2)), (1, 7, 2, b(1)), (2, 8, 0, b(1)), (2, 8, 1, b(2))]
