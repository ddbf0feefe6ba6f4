"""Which blocks are on the chain that ends in the head, and which were orphaned by it.

A block's parent has the number before it. Blocks are laid side by side by number, so one pass sees which numbers
have several blocks and which blocks stand on the one before them. Only where a number has several does a choice
have to be made, and those blocks are few. They alone are followed from child to parent, by pointer doubling, so
a fork of n blocks takes log n joins of small tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainloom.functions.skew import join_lookup, written


@dataclass(frozen=True)
class Links:
    """The columns that hold a block's number, its hash and the hash of its parent."""

    number: str = "block_num"
    hash: str = "hash"
    parent: str = "parent_hash"


@dataclass(frozen=True)
class Chain:
    """The chain that ends in the head. head: its number, None without blocks. broken_at: the largest number
    at which the chain has no block, so that nothing at or below it is known to be on it; None if the chain goes
    down to the lowest block. orphans: the blocks (number, hash) of numbers with several that are not on it; None
    if every number has one block."""

    links: Links
    head: int | None
    broken_at: int | None
    orphans: DataFrame | None

    def keep(self, blocks: DataFrame) -> DataFrame:
        """The blocks that are on the chain; repeated rows of a block are all kept."""
        links = self.links
        if self.head is None:
            return blocks.limit(0)
        known = blocks.filter(F.col(links.hash).isNotNull() & (F.col(links.number) <= self.head))
        if self.broken_at is not None:
            known = known.filter(F.col(links.number) > self.broken_at)
        if self.orphans is None:
            return known
        if SEVERAL in blocks.columns:
            return known.filter(~F.col(SEVERAL)).unionByName(self._without_orphans(known.filter(SEVERAL)))
        return self._without_orphans(known)

    def _without_orphans(self, known: DataFrame) -> DataFrame:
        links = self.links
        marks = self.orphans.select(
            F.col("__number").alias(links.number), F.col("__hash").alias(links.hash), F.lit(True).alias("__orphan")
        )
        marked = join_lookup(known, marks, [links.number, links.hash], how="left")
        return marked.filter(F.col("__orphan").isNull()).select(*known.columns)


BLOCK = ["__number", "__hash"]
# Flags of blocks that lie side by side: the number has other blocks too; the block is the only one of its number, and
# so is the one before it, which is its parent; or the one after it, of which it is the parent.
SEVERAL, BELOW, ABOVE = "__several", "__below", "__above"
# So many bits of a number are its place in a range of numbers that lie together.
RANGE_BITS = 8


def side_by_side(blocks: DataFrame, links: Links = Links(), parts: int | None = None) -> DataFrame:
    """The blocks, one row each, those of a range of numbers together and in order, with the flags of `follow_chain`.

    One shuffle, and one sort inside the tasks. Blocks without a hash lie apart and have no flag set; of several
    rows of a block one with the least parent is kept.
    """
    number, block_hash, parent = F.col("__place"), F.col(links.hash), F.col(links.parent)
    placed = blocks.withColumns({"__place": F.col(links.number).cast("long"), "__blank": F.col(links.hash).isNull()})
    placed = placed.withColumn("__range", F.shiftright("__place", RANGE_BITS))
    where = ["__range", "__blank"]
    dealt = placed.repartition(*([parts] if parts else []), *where)
    order = Window.partitionBy(*where).orderBy("__place", links.hash, links.parent)
    same = F.lag("__place").over(order).eqNullSafe(number) & F.lag(links.hash).over(order).eqNullSafe(block_hash)
    first = dealt.withColumn("__again", same & (F.row_number().over(order) > 1)).filter(~F.col("__again")).drop("__again")
    before, after = F.lag("__place").over(order), F.lead("__place").over(order)
    known = ~F.col("__blank") & number.isNotNull()
    several = (before == number) | (after == number)
    below = (before == number - 1) & ~F.lag("__place", 2).over(order).eqNullSafe(before) & (F.lag(links.hash).over(order) == parent)
    above = (after == number + 1) & ~F.lead("__place", 2).over(order).eqNullSafe(after) & (F.lead(links.parent).over(order) == block_hash)
    flags = {name: F.coalesce(flag, F.lit(False)) for name, flag in ((SEVERAL, several), (BELOW, below), (ABOVE, above))}
    flagged = first.withColumns(flags)
    lone = known & ~F.col(SEVERAL)
    flagged = flagged.withColumns({SEVERAL: known & F.col(SEVERAL), BELOW: lone & F.col(BELOW), ABOVE: lone & F.col(ABOVE)})
    return flagged.drop("__place", "__blank", "__range")


def _reached(contested: DataFrame, entries: DataFrame) -> DataFrame:
    """The contested blocks that are ancestors of an entry, with their parents.

    Every block knows an ancestor, at first its parent, as long as that is contested too. In each pass the blocks
    that are reached pass that on to the ancestor they know, and every block takes over its ancestor's
    ancestor, which is twice as far. After pass k all ancestors at a distance below 2^k are reached.
    """
    parent = contested.select(F.col("__number").alias("__to"), F.col("__hash").alias("__to_hash")).distinct()
    first = entries.distinct().withColumn("__reached", F.lit(True))
    begun = (
        contested.withColumns({"__to": F.col("__number") - 1, "__to_hash": F.col("__parent")})
        .join(parent.withColumn("__there", F.lit(True)), ["__to", "__to_hash"], "left")
        .join(first, BLOCK, "left")
    )
    here = F.col("__there").isNotNull()
    state = written(
        begun.select(
            *BLOCK, "__parent", F.when(here, F.col("__to")).alias("__to"), F.when(here, F.col("__to_hash")).alias("__to_hash"),
            F.coalesce("__reached", F.lit(False)).alias("__reached"),
        ),
        "chain",
    )
    while not state.filter(F.col("__to").isNotNull()).isEmpty():
        told = state.filter("__reached and __to is not null").select(
            F.col("__to").alias("__number"), F.col("__to_hash").alias("__hash"), F.lit(True).alias("__told")
        )
        further = state.select(
            F.col("__number").alias("__to"), F.col("__hash").alias("__to_hash"), F.col("__to").alias("__far"), F.col("__to_hash").alias("__far_hash")
        )
        passed = state.join(told.distinct(), BLOCK, "left").join(further, ["__to", "__to_hash"], "left")
        state = written(
            passed.select(
                *BLOCK, "__parent", F.col("__far").alias("__to"), F.col("__far_hash").alias("__to_hash"),
                (F.col("__reached") | F.col("__told").isNotNull()).alias("__reached"),
            ),
            "chain",
        )
    return state.filter("__reached").select(*BLOCK, "__parent")


def follow_chain(blocks: DataFrame, links: Links = Links()) -> Chain:
    """Find the chain that ends in the head: the block with the largest number, of several the least hash.

    Numbers with one block leave no choice. Of the others, the parents of single blocks and the head are where the
    chain enters, and their contested ancestors are on it too. Last comes the largest number where the block on
    the chain is not the parent that the one above it names. Blocks without a number or hash are on no chain. What
    reaches the driver is a few numbers. `blocks` may be those of `side_by_side`, kept by the caller; others are laid
    out here.
    """
    laid = SEVERAL in blocks.columns
    if not laid:
        blocks = side_by_side(blocks.select(*{links.number, links.hash, links.parent}), links)
    narrow = blocks.select(
        F.col(links.number).cast("long").alias("__number"),
        F.col(links.hash).alias("__hash"),
        F.col(links.parent).alias("__parent"),
        SEVERAL,
        BELOW,
        ABOVE,
    ).filter(F.col("__number").isNotNull() & F.col("__hash").isNotNull())
    if not laid:
        narrow = written(narrow, "chain")
    head, fights, least = narrow.agg(
        F.max("__number"), F.count_if(SEVERAL), F.min(F.when(~F.col(SEVERAL), F.col("__number")))
    ).first()
    lone = narrow.filter(~F.col(SEVERAL)).select(*BLOCK, "__parent", BELOW, ABOVE)
    # What stands on the one before it, or carries the one after it, was compared already.
    targets, heirs = lone.filter(~F.col(ABOVE)).select(*BLOCK), lone.filter(~F.col(BELOW)).select(*BLOCK, "__parent")
    orphans = None
    if fights:
        contested = written(narrow.filter(SEVERAL).select(*BLOCK, "__parent"), "chain")
        above = heirs.select((F.col("__number") - 1).alias("__number"), F.col("__parent").alias("__hash"))
        top = contested.filter(F.col("__number") == head).groupBy("__number").agg(F.min("__hash").alias("__hash"))
        reached = _reached(contested, above.unionByName(top))
        orphans = written(contested.select(*BLOCK).join(reached.select(*BLOCK), BLOCK, "left_anti"), "chain")
        targets, heirs = targets.unionByName(reached.select(*BLOCK)), heirs.unionByName(reached)
    named = heirs.select((F.col("__number") - 1).alias("__number"), F.struct(F.col("__parent").alias("named")).alias("above"))
    met = (
        targets.unionByName(named, allowMissingColumns=True)
        .groupBy("__number")
        .agg(F.max("__hash").alias("__hash"), F.max("above").alias("above"))
    )
    gap = F.col("above").isNotNull() & ~F.col("__hash").eqNullSafe(F.col("above.named"))
    lowest, broken = met.agg(F.min(F.when(F.col("__hash").isNotNull(), F.col("__number"))), F.max(F.when(gap, F.col("__number")))).first()
    # The parent of the lowest block is not expected.
    lowest = min((n for n in (lowest, least) if n is not None), default=None)
    return Chain(links, head, broken if broken is not None and broken >= lowest else None, orphans)


def canonical_blocks(blocks: DataFrame, links: Links = Links()) -> DataFrame:
    """The blocks on the chain that ends in the head. Orphans, blocks below a gap of the chain, and blocks
    without a number or hash are left out."""
    return follow_chain(blocks, links).keep(blocks)


def final_chain(blocks: DataFrame, depth: int, links: Links = Links()) -> DataFrame:
    """The blocks of the chain that are at least `depth` behind its head: a later fork of less than `depth` blocks
    replaces none of them."""
    chain = follow_chain(blocks, links)
    return chain.keep(blocks).filter(F.col(links.number) <= (chain.head or 0) - depth)
