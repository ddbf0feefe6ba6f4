import random

import pytest
from chainloom.contracts import BLOCK_META, CREATE, DELETE, UPDATE
from chainloom.operators import keyed

META = "id string, at string, number int, hash string, parent_hash string, timestamp string"
ORDERED = f"{META}, _block_num long, _ordinal long, _pos int"


def meta(spark, *rows):
    """Rows of the block table, keyed as given."""
    data = [
        (key, at, number, hash_, parent, "2023-01-01", 0, i, 0)
        for i, (key, parent, at, hash_, number) in enumerate(rows)
    ]
    return spark.createDataFrame(data, ORDERED)


PK1 = ("pk1", "0x0", "block1", "0x1", 0)
PK2 = ("pk2", "0x1", "block2", "0x2", 1)
PK2_AGAIN = ("pk2", "0x2", "block3", "0x3", 2)


def test_two_keys_are_inserted(spark):
    fresh, rejects = keyed.insert_append(None, meta(spark, PK1, PK2), BLOCK_META.keys)
    assert fresh.count() == 2 and rejects.count() == 0


def test_key_given_twice(spark):
    rows = meta(spark, PK1, PK2, PK2_AGAIN)
    broken = keyed.check_primary_key(rows, ["id"]).collect()
    assert [(r["id"], r["rows"]) for r in broken] == [("pk2", 2)]
    with pytest.raises(keyed.DuplicateKey):
        keyed.insert_append(None, rows, ["id"])
    for limit in (1_000_000, 1):
        fresh, rejects = keyed.insert_append(None, rows, ["id"], on_duplicate="reject", limit=limit)
        assert sorted(r["at"] for r in fresh.collect()) == ["block1", "block2"]
        assert [(r["at"], r["reject_reason"]) for r in rejects.collect()] == [
            ("block3", "duplicate_key")
        ]


def test_null_key(spark):
    rows = meta(spark, (None, "p", "a", "h", 0))
    with pytest.raises(keyed.DuplicateKey):
        keyed.insert_append(None, rows, ["id"])
    fresh, rejects = keyed.insert_append(None, rows, ["id"], on_duplicate="reject")
    assert fresh.count() == 0 and rejects.first()["reject_reason"] == "null_key"


def test_key_in_the_table(spark):
    target = meta(spark, PK1)
    with pytest.raises(keyed.DuplicateKey):
        keyed.insert_append(target, meta(spark, PK1, PK2), ["id"])
    fresh, rejects = keyed.insert_append(target, meta(spark, PK1, PK2), ["id"], on_conflict="reject")
    assert [r["id"] for r in fresh.collect()] == ["pk2"]
    assert [(r["id"], r["reject_reason"]) for r in rejects.collect()] == [("pk1", "key_exists")]


def test_composite_key(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y")], "uri string, app string")
    assert keyed.check_primary_key(rows, ["uri", "app"]).count() == 0
    assert keyed.check_primary_key(rows, ["uri"]).count() == 1


TABLE = "id string, a int, b string"


def test_update_and_delete(spark):
    target = spark.createDataFrame([("k", 1, "x"), ("l", 2, "y")], TABLE)
    updates = spark.createDataFrame(
        [("k", None, "z", ["a"]), ("gone", 9, "q", ["a", "b"])], f"{TABLE}, _present array<string>"
    )
    got = {r["id"]: (r["a"], r["b"]) for r in keyed.update_by_key(target, updates, ["id"]).collect()}
    assert got == {"k": (None, "x"), "l": (2, "y")}
    left = keyed.delete_by_key(target, updates, ["id"]).collect()
    assert [r["id"] for r in left] == ["l"]


CHANGES = f"{TABLE}, _operation int, _present array<string>, _block_num long, _ordinal long, _pos int"


def random_changes(seed, count, keys):
    rng = random.Random(seed)
    out = []
    for i in range(count):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(keys)}"
        operation = rng.choices([CREATE, UPDATE, DELETE], [4, 5, 2])[0]
        present = [c for c in ("a", "b") if rng.random() < 0.6] if operation != DELETE else []
        a = rng.choice([None, i]) if "a" in present else None
        b = rng.choice([None, f"v{i}"]) if "b" in present else None
        out.append((key, a, b, operation, present, i // 7, i % 7 // 2, i % 2))
    return out


def replay(target, changes):
    """The changes one by one."""
    table, conflicts = dict(target), []
    for key, a, b, operation, present, *order in sorted(changes, key=lambda c: c[5:]):
        if operation == CREATE:
            if key in table:
                conflicts.append((key, *order))
            else:
                table[key] = (a, b)
        elif operation == DELETE:
            table.pop(key, None)
        elif key in table:
            old = table[key]
            table[key] = (a if "a" in present else old[0], b if "b" in present else old[1])
    return table, sorted(conflicts)


@pytest.mark.parametrize("seed, limit", [(1, 1_000_000), (2, 1_000_000), (3, 10), (4, 10)])
def test_apply_changes_is_a_replay(spark, seed, limit):
    changes = [c for c in random_changes(seed, 420, 40) if c[5:] is not None]
    target = {f"k{i}": (i, f"s{i}") for i in range(0, 50, 2)}
    if seed % 2:
        target["hot"] = (0, "s")
    table, conflicts = replay(target, changes)
    stored = spark.createDataFrame([(k, *v) for k, v in target.items()], TABLE)
    rows = spark.createDataFrame(random.Random(0).sample(changes, len(changes)), CHANGES)
    applied = keyed.apply_changes(stored, rows, ["id"], limit=limit)
    assert {r["id"]: (r["a"], r["b"]) for r in applied.collect()} == table
    refused = keyed.change_conflicts(stored, rows, ["id"], limit=limit)
    got = sorted((r["id"], r["_block_num"], r["_ordinal"], r["_pos"]) for r in refused.collect())
    assert got == conflicts


def test_changes_without_a_key_change_nothing(spark):
    target = spark.createDataFrame([("a", "x")], "id string, v string")
    shape = "id string, v string, _operation int, _present array<string>, _block_num long, _ordinal long, _pos int"
    rows = [(None, "n", CREATE, ["v"], 1, 1, 0), (None, "m", UPDATE, ["v"], 1, 2, 0), (None, None, DELETE, [], 1, 3, 0), ("b", "y", CREATE, ["v"], 1, 4, 0)]
    changes = spark.createDataFrame(rows, shape)
    assert sorted(map(tuple, keyed.apply_changes(target, changes, ["id"]).collect())) == [("a", "x"), ("b", "y")]
    reasons = {r["_ordinal"]: r["reject_reason"] for r in keyed.change_outcomes(target, changes, ["id"]).collect()}
    assert reasons == {1: "null_key", 2: "null_key", 3: "null_key", 4: None}


def test_batch_counts(spark):
    rows = spark.createDataFrame([(0, "t", 1)] * 3 + [(1, "t", 2)], "batch_id int, record string, operation int")
    got = {tuple(r) for r in keyed.batch_counts(rows).collect()}
    assert got == {(0, "t", 1, 3), (1, "t", 2, 1)}


def test_updates_of_a_key_run_one_after_the_other(spark):
    target = spark.createDataFrame([("k", 1, "x"), ("l", 2, "y")], TABLE)
    updates = spark.createDataFrame(
        [("k", 5, "p", ["a", "b"], 1), ("k", None, None, ["a"], 3), ("k", 7, "q", ["a", "b"], 2)],
        f"{TABLE}, _present array<string>, _ordinal long",
    )
    got = sorted(tuple(r) for r in keyed.update_by_key(target, updates, ["id"]).collect())
    assert got == [("k", None, "q"), ("l", 2, "y")]


def test_keys_of_large_batches_are_counted_with_the_table(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "id string")
    target = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("z",)], "id string")
    wanted = {("a", 2, True), ("b", 1, True), (None, 1, False), ("c", 1, False)}
    for bound in (10, 0):
        found = keyed.key_counts(rows, target, ["id"], bound=bound)
        assert {tuple(r) for r in found.collect()} == wanted and found.count() == 4
        assert found.schema["rows"].dataType.simpleString() == "bigint"
    # One pass over both, no join.
    assert "Join" not in keyed.key_counts(rows, target, ["id"], bound=0)._jdf.queryExecution().executedPlan().toString()
