"""Mixing sources to target weights: blocks of equal token counts by Sainte-Laguë's highest quotients."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainloom.llm.shared import SPACES, bound, fitting, kept, n_words


@dataclass(frozen=True)
class Mix:
    """weights: of the sources in their order, again and again. share: words of the mix for a word there is.
    repeats: most times a source is read. shard_words: words that one task puts in order."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    repeats: int = 2
    block_words: int = 16
    shard_words: int = 2_000_000
    seed: int = 17
    broadcast_rows: int = 500_000


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, size) with sid, weight and target: the share of all words by weight, with no target over
    `repeats` times its source. What a capped source leaves goes to the others by weight.

    Sources whose cap is reached first come first, so with the first k capped the rest share what is left."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    sized = sizes.withColumn("sid", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (F.col("sid") % len(mix.weights) + 1).cast("int"))
    sized = sized.withColumn("weight", weight).withColumn("cap", mix.repeats * F.col("source_size").cast("double"))
    sized = sized.withColumn("reach", F.col("cap") / F.col("weight"))
    by_reach = Window.orderBy("reach", "sid")
    upto, every = by_reach.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = mix.share * F.sum("source_size").over(every)
    left = total - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0))
    # The level is the words for a unit of weight once all sources that come earlier are capped. It falls from
    # the first source on that stays below its cap.
    levels = sized.withColumn("level", left / rest)
    final = F.max(F.when(F.col("level") <= F.col("reach"), F.col("level"))).over(by_reach.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = F.coalesce(final, F.lit(float("inf")))
    return levels.withColumn("target", F.least(F.col("cap"), F.col("weight") * level)).drop("reach", "level", "cap")


def apportion(parties: DataFrame, group: str, party: str, weight: str, seats: str) -> DataFrame:
    """Integer seats (`quota`) of each group's parties by Sainte-Laguë: the highest quotients weight / (2k - 1).

    Rounding each party's share leaves at most as many seats open as there are parties; only the seats near
    that border are put in order. Ties go to the smaller party."""
    of = Window.partitionBy(group)
    share = F.when(F.col("_sum") > 0, F.col(seats) * F.col(weight) / F.col("_sum")).otherwise(0.0)
    frame = parties.withColumn("_sum", F.sum(weight).over(of)).withColumn("_n", F.count("*").over(of)).withColumn("_share", share)
    reach = F.ceil(F.col("_n") * F.col("_share") / F.greatest(F.col(seats), F.lit(1))) + 2
    frame = frame.withColumn("_sure", F.greatest(F.lit(0), F.floor(F.col("_share") + 0.5) - reach).cast("long"))
    frame = frame.withColumn("_open", F.col(seats) - F.sum("_sure").over(of)).where(F.col(weight) > 0)
    near = frame.select(group, party, "_open", weight, F.explode(F.sequence(F.col("_sure") + 1, F.col("_sure") + 2 * reach.cast("long") + 1)).alias("_k"))
    by_quotient = Window.partitionBy(group).orderBy((F.col(weight) / (2 * F.col("_k") - 1)).desc(), party, "_k")
    won = near.withColumn("_at", F.row_number().over(by_quotient)).where("_at <= _open").groupBy(group, party).agg(F.count("*").alias("_won"))
    sure = frame.select(group, party, "_sure")
    quota = (F.col("_sure") + F.coalesce("_won", F.lit(0))).cast("long")
    got = sure.join(won, [group, party], "left").select(group, party, quota.alias("quota"))
    return parties.join(got, [group, party], "left").withColumn("quota", F.coalesce("quota", F.lit(0)).cast("long"))


def plan(docs: DataFrame, mix: Mix, id_col: str, text_col: str, source_col: str, key: Column | None = None) -> DataFrame:
    """Every row of documents as (key, id, source, size, source_size, target, epochs, from, upto): the mix takes it
    `epochs` times whole, and besides its words from .. upto (and `from2` .. `upto2` where the choice wraps).
    key: tells rows apart that share an id; without one it is null."""
    spread = F.xxhash64(F.col(id_col).cast("string"), F.lit(mix.seed))
    key = F.lit(None).cast("long") if key is None else key
    rows = docs.select(key.alias("key"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), spread.alias("order"))
    rows = kept(rows, "sizes")
    sources = kept(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), mix), "sources")
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    seats = sources.withColumn("all", F.lit(0)).withColumn("seats", F.lit(round(total / mix.block_words)).cast("long"))
    seats = kept(apportion(seats, "all", "sid", "target", "seats").drop("all", "seats").withColumnRenamed("quota", "blocks"), "quotas")
    seats = seats.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / mix.shard_words)).cast("long"))
    dealt = rows.alias("r").join(fitting(seats, mix.broadcast_rows).alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
    dealt = dealt.select("r.key", "r.id", "r.source", "r.size", "r.order", "s.sid", "s.source_size", "s.target", "s.blocks", F.expr("pmod(r.order, s.shards)").alias("shard"))
    words = kept(dealt.groupBy("sid", "shard").agg(F.sum("size").alias("shard_size"), F.first("blocks").alias("blocks")), "words")
    quotas = kept(apportion(words, "sid", "shard", "shard_size", "blocks").select("sid", "shard", "shard_size", "quota"), "shards")
    turn = Window.partitionBy("sid", "shard").orderBy(F.xxhash64("order"), "id", "size", "key")
    ends = dealt.withColumn("end", F.sum("size").over(turn.rowsBetween(Window.unboundedPreceding, 0)))
    at = ends.join(quotas, ["sid", "shard"])
    n = F.greatest(F.col("shard_size"), F.lit(1))
    take = F.least(F.col("quota") * mix.block_words, mix.repeats * F.col("shard_size"))
    at = at.withColumn("epochs", F.floor(take / n).cast("long")).withColumn("rest", take - F.col("epochs") * n)
    first = mix.block_words * F.pmod(F.xxhash64("sid", "shard", F.lit(mix.seed)), F.ceil(n / mix.block_words))
    at = at.withColumn("first", first).withColumn("begin", F.col("end") - F.col("size"))

    def cut(low: Column, high: Column) -> list[Column]:
        a = F.least(F.greatest(low - F.col("begin"), F.lit(0)), F.col("size"))
        return [a, F.greatest(a, F.least(high - F.col("begin"), F.col("size")))]

    stop = F.col("first") + F.col("rest")
    a, b = cut(F.col("first"), F.least(stop, n))
    c, d = cut(F.lit(0), F.greatest(stop - n, F.lit(0)))
    return at.select("key", "id", "source", "size", "source_size", "target", "epochs", a.alias("from"), b.alias("upto"), c.alias("from2"), d.alias("upto2"))


def mixture(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of documents.

    Inside a shard of a source the documents stand in a seeded order and are cut into equal blocks; the shard's
    quota takes all blocks as often as it can and then a run of blocks from a seeded start, so that at most two
    documents of a shard are taken in part. Null texts have no words; a null source is a source, the last one;
    rows that repeat an id are each counted; an empty table gives no rows; other columns are not read.
    """
    rows = plan(docs, mix, id_col, text_col, source_col)
    taken = F.col("epochs") * F.col("size") + F.col("upto") - F.col("from") + F.col("upto2") - F.col("from2")
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix with their columns: a row for every time one is taken whole, and one with the
    words that are taken in part, one space between them. Every row has its own part of the plan, also where rows
    share an id or have none: the documents are written once with a key for each."""
    docs_row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    keyed = kept(docs.select(docs_row.alias("row"), F.monotonically_increasing_id().alias("key")), "keyed")
    fields = keyed.select("key", *(F.col("row").getField(c).alias(n) for c, n in ((id_col, "id"), (text_col, "text"), (source_col, "source"))))
    rows = plan(fields, mix, "id", "text", "source", F.col("key"))
    rows = kept(rows.where("epochs > 0 or upto > from or upto2 > from2").select("key", "epochs", "from", "upto", "from2", "upto2"), "plan")
    packed = keyed.select("row", "key", F.col("row").getField(text_col).alias("text"))
    joined = packed.join(fitting(rows, mix.broadcast_rows), "key")
    whole = F.array_repeat(F.lit(-1), F.col("epochs").cast("int"))
    part = F.when(F.col("upto") + F.col("upto2") > F.col("from") + F.col("from2"), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    copies = joined.withColumn("copy", F.explode(F.concat(whole, part)))
    text = F.col("text")

    def words_between(w: Column, low: str, high: str) -> Column:
        return F.slice(w, F.col(low).cast("int") + 1, (F.col(high) - F.col(low)).cast("int"))

    words = F.array_remove(F.split(text, SPACES), "")
    piece = bound(words, lambda w: F.concat_ws(" ", words_between(w, "from", "upto"), words_between(w, "from2", "upto2")))
    cut = F.when(F.col("copy") == 0, piece).otherwise(text)
    new = {text_col: cut}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length(cut).cast(docs.schema["n_chars"].dataType)
    return copies.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
