"""Benchmark decontamination: hashed word windows of the test items against every window of the documents.

Columns and SQL functions only. The items' windows are broadcast while they are few enough; the documents
are scanned twice, once to look up hashes and check the hits word by word, and once to put what was found on their
rows. Between the scans a text goes by its digest, and its hits by their places alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import bound, fits, fitting, kept

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Overlap:
    """width: words of a window. Windows or hits beyond these row counts or bytes are joined by a shuffle."""

    width: int = 10
    broadcast_windows: int = 500_000
    broadcast_documents: int = 200_000
    broadcast_bytes: int = 32 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NO_WORD), "")


def _windows(hashes: Column, width: int) -> Column:
    """(pos, width, h) of every window, pos from 1."""
    starts = F.when(F.size(hashes) >= width, F.sequence(F.lit(1), F.size(hashes) - width + 1))
    return F.transform(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda i: F.struct(i.alias("pos"), F.lit(width).alias("width"), F.xxhash64(F.slice(hashes, i, width)).alias("h")),
    )


def item_windows(items: DataFrame, overlap: Overlap, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(h, width, window, items): every window's hash, its words, and the ids of the items that have it."""
    n = F.size("w")
    rows = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(n > 0)
    width = F.least(n, F.lit(overlap.width))
    parts = rows.select("item", width.alias("width"), F.explode(F.transform(F.sequence(F.lit(1), n - width + 1), lambda i: F.slice("w", i, width))).alias("part"))
    hashed = F.xxhash64(F.transform("part", lambda x: F.xxhash64(x)))
    return parts.groupBy(hashed.alias("h"), "width", F.concat_ws(" ", "part").alias("window")).agg(F.collect_set("item").alias("items"))


def digest(text: Column) -> Column:
    """Names a text: hits depend on the text alone, so rows with the same one share them. None for a null."""
    return F.unhex(F.sha2(text, 256))


def sure_hits(docs: DataFrame, items: DataFrame, overlap: Overlap, text_col: str) -> DataFrame:
    """(_digest, pos, width, items) of each occurrence of an item's window in a text, checked word by word."""
    bench = kept(item_windows(items, overlap), "windows")
    widths = sorted(r["width"] for r in bench.select("width").distinct().collect())
    none = F.array().cast("array<struct<pos:int,width:int,h:bigint>>")
    at = bound(F.transform("_words", lambda x: F.xxhash64(x)), lambda w: F.concat(none, *(_windows(w, n) for n in widths)))
    texts = docs.where(F.col(text_col).isNotNull()).select(digest(F.col(text_col)).alias("_digest"), F.col(text_col).alias("_text"))
    worded = texts.select("_digest", words(F.col("_text")).alias("_words"))
    if fits(bench, overlap.broadcast_windows, overlap.broadcast_bytes):
        # Places and words meet the windows in one generated loop, so the words are not copied for every place. (A
        # plain explode would add a filter that hashes all windows once more.)
        places = worded.select("_digest", "_words", at.alias("_at")).select("_digest", "_words", F.explode_outer("_at").alias("_at"))
        met = places.select("_digest", "_words", "_at.*").join(F.broadcast(bench), ["h", "width"])
    else:
        # A shuffle would copy them: the places go alone, and those with a window meet their words afterwards.
        places = worded.select("_digest", F.explode(at).alias("_at")).select("_digest", "_at.*")
        asked = places.join(bench, ["h", "width"]).groupBy("_digest").agg(F.collect_set(F.struct("pos", "width", "window", "items")).alias("_asked"))
        asked = fitting(kept(asked, "asked"), overlap.broadcast_documents, overlap.broadcast_bytes)
        met = texts.join(asked, "_digest").select("_digest", words(F.col("_text")).alias("_words"), "_asked")
        met = met.select("_digest", "_words", F.explode("_asked").alias("_asked")).select("_digest", "_words", "_asked.*")
    # As `=` it would become a key of the join and be worked out for every place, not only for those with a hash.
    own = F.concat_ws(" ", F.slice("_words", F.col("pos"), F.col("width")))
    return met.where(own.startswith(F.col("window")) & F.col("window").startswith(own)).select("_digest", "pos", "width", "items")


def hits(docs: DataFrame, items: DataFrame, overlap: Overlap = Overlap(), text_col: str = "text") -> DataFrame:
    """Every row of documents with its columns and `_hits`, the places from 1 of words inside an item's window,
    and `_items`, the ids of the windows' items; both null where there are none."""
    places = F.sequence(F.col("pos"), F.col("pos") + F.col("width") - 1)
    once = (F.array_distinct(F.flatten(F.collect_set(c))).alias(n) for c, n in ((places, "_hits"), (F.col("items"), "_items")))
    found = kept(sure_hits(docs, items, overlap, text_col).groupBy("_digest").agg(*once), "hits")
    joined = docs.join(fitting(found, overlap.broadcast_documents, overlap.broadcast_bytes), digest(docs[text_col]) == found["_digest"], "left")
    return joined.drop(found["_digest"])


def contamination(docs: DataFrame, items: DataFrame, overlap: Overlap = Overlap(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of documents.

    Null and empty texts have no words; null items are no windows; repeated rows are each judged by their own
    words; with an empty benchmark nothing is hit; an empty table gives no rows; other columns are not read.
    """
    rows = hits(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), items, overlap)
    ids = F.array_sort(F.coalesce("_items", F.array().cast("array<string>")))
    n_hit = F.size(F.coalesce("_hits", F.array().cast("array<int>"))).cast("long")
    out = rows.select("id", F.size(words(F.col("text"))).cast("long").alias("n_words"), n_hit.alias("n_hit"), ids.alias("_ids"))
    return out.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, overlap: Overlap = Overlap(), remove: str = "documents", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with their columns as they were, without contaminated ones (`remove="documents"`), or with
    the hit words cut out of their texts (`remove="spans"`). Null and empty texts stay as they are."""
    if remove == "documents":
        found = kept(sure_hits(docs, items, overlap, text_col).select("_digest").distinct(), "hits")
        small = fitting(found, overlap.broadcast_documents, overlap.broadcast_bytes)
        return docs.join(small, digest(docs[text_col]) == found["_digest"], "left_anti")
    if remove != "spans":
        raise ValueError(remove)
    rows = hits(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")), items, overlap)
    text = F.col("text")

    def rebuilt(hit: Column) -> Column:
        own = F.array_remove(F.split(text, NO_WORD_ANY_CASE), "")
        between = F.split(text, ANY_CASE_WORD)
        parts = F.zip_with(between, own, lambda gap, word: F.struct(gap.alias("gap"), word.alias("word")))
        return F.concat_ws(
            "", F.transform(parts, lambda p, i: F.concat(p["gap"], F.when(F.array_contains(hit, i + 1), "").otherwise(F.coalesce(p["word"], F.lit("")))))
        )

    cut = F.when(F.size("_hits") > 0, rebuilt(F.col("_hits"))).otherwise(text)
    return rows.select(*(cut.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))
