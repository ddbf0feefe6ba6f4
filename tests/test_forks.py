"""Chains among forks against a walk along the parents, in one go and held back over batches."""

import random

import pytest
from pyspark.sql import functions as F

from chainloom.contracts import ETH_BLOCKHEADERS
from chainloom.plans.ingest import IngestJob, hold_back, process_batch
from chainloom.sources import forks
from chainloom.sources.blocks import final_blocks
from chainloom.sources.forks import Links, canonical_blocks, follow_chain, side_by_side
from chainloom.streaming.store import BatchStore

SHAPE = "block_num long, hash binary, parent_hash binary, block_id string, cursor string, timestamp string, __hash string"


def forest(seed, length=70):
    """(number, name, parent) of a chain with forks of many lengths, some of them on forks, and one past its head."""
    rng = random.Random(seed)
    blocks = [(n, f"m{n}", f"m{n - 1}") for n in range(5, length)]
    for fork in range(12):
        number, name, _ = rng.choice(blocks)
        for step in range(1, rng.choice([1, 2, 3, 20])):
            if number + step <= length + (fork == 11):
                blocks.append((number + step, f"f{fork}-{step}", name))
                name = f"f{fork}-{step}"
    rng.shuffle(blocks)
    return blocks


def walk(blocks):
    """Numbers and names from the head to where the parent is missing, and whether that is the lowest number."""
    parents = {(n, name): parent for n, name, parent in blocks}
    top = max(n for n, _, _ in blocks)
    at, out = (top, min(name for n, name, _ in blocks if n == top)), set()
    while at in parents:
        out.add(at)
        at = (at[0] - 1, parents[at])
    return out, at[0] < min(n for n, _, _ in blocks)


def frame(spark, blocks):
    rows = [(n, bytearray(h.encode()), bytearray(p.encode()), h, f"c{h}", "2024-01-01", "clash") for n, h, p in blocks]
    return spark.createDataFrame(rows, SHAPE)


def names(found):
    return {(r["block_num"], r["block_id"]) for r in found.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_chain_among_forks(spark, seed):
    blocks = forest(seed)
    odd = [(None, "x", "y")] if seed == 1 else []
    kept, whole = walk(blocks)
    chain = follow_chain(frame(spark, blocks + odd + blocks[:9]))
    assert (chain.broken_at is None) == whole and chain.head == max(n for n, _, _ in blocks)
    found = chain.keep(frame(spark, blocks + odd + blocks[:9])).collect()
    assert {(r["block_num"], r["block_id"]) for r in found} == kept
    assert len(found) == len([b for b in blocks + blocks[:9] if b[:2] in kept])


def test_gaps_and_small_tables(spark):
    blocks = forest(3)
    cut = [b for b in blocks if b[0] != 30]
    kept, whole = walk(cut)
    assert not whole and names(canonical_blocks(frame(spark, cut))) == kept
    assert canonical_blocks(frame(spark, []).limit(0)).count() == 0
    straight = [(n, f"m{n}", f"m{n - 1}") for n in range(9)]
    chain = follow_chain(frame(spark, straight))
    assert chain.orphans is None and chain.broken_at is None
    assert names(final_blocks(frame(spark, straight), 3, links=Links())) == {(n, f"m{n}") for n in range(6)}


def test_batches_hold_back_what_may_change(spark, tmp_path):
    blocks = sorted(forest(4, length=40))
    rng = random.Random(4)
    # The first batch begins at the lowest block; later blocks come in any order, some a batch too early.
    placed = [(0 if n < 12 else min(3, max(1, n // 12 + rng.choice([-1, 0, 0, 0]))), (n, h, p)) for n, h, p in blocks]
    store = BatchStore(spark, str(tmp_path / "store"))
    job = IngestJob("final", "block_meta", [ETH_BLOCKHEADERS], algo="sha256", final_depth=6)
    seen = []
    for epoch in range(5):
        # The last batch is empty.
        batch = frame(spark, [b for k, b in placed if k == epoch] or blocks[:1]).filter(F.lit(epoch < 4))
        process_batch(job, store, batch, "stream", epoch)
        seen.append({r["hash"] for r in store.rows(ETH_BLOCKHEADERS).collect()})
    assert all(a <= b for a, b in zip(seen, seen[1:]))
    assert 0 < len(seen[0]) < len(seen[3])
    whole = final_blocks(frame(spark, blocks), 6, links=Links())
    assert seen[-1] == {r["h"] for r in whole.select(F.lower(F.hex("hash")).alias("h")).collect()}
    # A writer that starts anew finds what waits.
    again = BatchStore(spark, str(tmp_path / "store"))
    head, parent = max((n, h) for n, h in walk(blocks)[0])
    more = [(head + k, f"n{k}", parent if k == 1 else f"n{k - 1}") for k in range(1, 4)]
    process_batch(job, again, frame(spark, more), "stream", 5)
    late = final_blocks(frame(spark, blocks + more), 6, links=Links())
    assert {r["hash"] for r in again.rows(ETH_BLOCKHEADERS).collect()} == {
        r["h"] for r in late.select(F.lower(F.hex("hash")).alias("h")).collect()
    }


def test_chain_over_ranges_of_numbers(spark):
    # Ranges end at 255 and 511; forks, gaps and a wrong parent inside them and at their edges.
    blocks = sorted(forest(6, length=530))
    blocks += [(n, f"g{n}", f"m{n - 1}" if n == 254 else f"g{n - 1}") for n in range(254, 259)]
    blank = [(n, None, bytearray(b"m"), f"x{n}", "c", "2024-01-01", "clash") for n in (255, 300, 300)]
    wrong = [(n, h, "other" if n == 512 else p) for n, h, p in blocks]
    for k, left in enumerate([blocks, wrong, *([b for b in blocks if b[0] != n] for n in (511, 512, 100))]):
        kept, whole = walk(left)
        assert whole == (k == 0)
        rows = frame(spark, left + left[::7]).unionByName(spark.createDataFrame(blank, SHAPE))
        laid = side_by_side(rows, parts=3).persist()
        # Rows of a block, also of one without a hash, are one.
        assert laid.count() == len(left) + 2
        for given in (rows, laid)[k > 0 :]:
            chain = follow_chain(given)
            assert (chain.broken_at is None) == whole
            assert names(chain.keep(given)) == kept
        laid.unpersist()


def test_only_contested_blocks_are_written_apart(spark, tmp_path, monkeypatch):
    straight = [(n, f"m{n}", f"m{n - 1}") for n in range(2000)]
    fork = [(n, f"f{n}", "m999" if n == 1000 else f"f{n - 1}") for n in range(1000, 1004)]
    counts = []

    def counted(table, purpose, write=forks.written):
        out = write(table, purpose)
        counts.append(out.count())
        return out

    monkeypatch.setattr(forks, "written", counted)
    job = IngestJob("final", "block_meta", [ETH_BLOCKHEADERS], algo="sha256", final_depth=10)
    done, waiting, kept = hold_back(job, BatchStore(spark, str(tmp_path / "store")), frame(spark, straight + fork))
    assert names(done) == {(n, f"m{n}") for n in range(1990)} and waiting.count() == 11
    # Four numbers with two blocks each; the other blocks are not written again.
    assert max(counts) == 8
    kept.unpersist()
