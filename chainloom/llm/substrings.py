"""Substring dedup on a De Bruijn graph of words: repeated edges, compacted to paths and cut from later documents.

An edge is a window of 13 words, between the nodes of its first and its last 12. Edges travel in bundles: all
windows around the same rarest-looking 7 words of a neighbourhood (their minimiser, the smallest hash of 7
words in the window) share a bundle, so a first grouping of bundles, with a row for about every fourth word,
leaves out what no other document can have. The edges of the bundles that are left are grouped one by one; an
edge's source is the smallest document that has it, and its first place there. The words before and after an
edge tell whether the nodes at its ends branch: edges that follow each other in the source across a node
without branches are one path. Joined with the paths, the edges of later documents become spans, each with the
coordinates of its source, and a span counts only if its words have the digest of the source's words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainloom.llm.shared import discard, fitting, kept, release
from chainloom.llm.words import Words, slices


@dataclass(frozen=True)
class Graph:
    """width: words of an edge. seed: words of a minimiser. Up to broadcast_rows digests (36 bytes each) go to
    every executor. passes: the edges are grouped and joined in so many parts by their hash, one after the
    other, so that the shuffle files of one part at a time are on disk."""

    width: int = 13
    seed: int = 7
    passes: int = 4
    broadcast_rows: int = 200_000


def _edges(texts: pa.Array, graph: Graph) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, hash of each word, of the edge from it, of the edge's minimiser, whether an edge starts there)."""
    words = Words(texts)
    hashes = words.hashes()
    edges, fits = words.windows(hashes, graph.width)
    small, _ = words.windows(hashes, graph.seed)
    seeds, spread = np.zeros(len(small), np.uint64), graph.width - graph.seed + 1
    if len(small) >= spread:
        seeds[: len(small) - spread + 1] = small[: len(small) - spread + 1]
        for j in range(1, spread):
            np.minimum(seeds[: len(small) - spread + 1], small[j : len(small) - spread + 1 + j], out=seeds[: len(small) - spread + 1])
    return words, hashes, edges, seeds, fits


def _first(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether a value is the first of its kind for its owner."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    out = np.zeros(len(v), bool)
    out[order[new]] = True
    return out


def _bundles(graph: Graph):
    """(value, id): every minimiser of a text once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                words, _, _, seeds, fits = _edges(texts, graph)
                values, owner = seeds[fits], words.owner()[fits]
                once = _first(values, owner)
                ids = batch.column(0).slice(at, len(texts)).take(pa.array(owner[once]))
                yield pa.RecordBatch.from_arrays([pa.array(values[once].view(np.int64)), ids], names=["value", "id"])

    return task


def _occurrences(graph: Graph):
    """(value, id, pos, first, before, after) of texts (id, text, held): every edge whose minimiser is in the
    text's list, its place, whether it is the text's first of its kind, and 32 bits of the words around it
    (0: the text's edge)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                part = batch.slice(at, len(texts))
                words, hashes, edges, seeds, fits = _edges(texts, graph)
                chosen = np.flatnonzero(_held(part, words, seeds, fits))
                owner, label = words.owner()[chosen], (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)
                begin, end, follows = words.first[:-1][owner], words.first[1:][owner], chosen + graph.width
                before = np.where(chosen > begin, label[chosen - 1], 0)
                after = np.where(follows < end, label[np.minimum(follows, len(label) - 1)], 0)
                columns = [
                    pa.array(edges[chosen].view(np.int64)),
                    part.column(0).take(pa.array(owner)),
                    pa.array((chosen - begin).astype(np.int32)),
                    pa.array(_first(edges[chosen], owner)),
                    pa.array(before.astype(np.int32)),
                    pa.array(after.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["value", "id", "pos", "first", "before", "after"])

    return task


def _held(part: pa.RecordBatch, words: Words, values: np.ndarray, fits: np.ndarray) -> np.ndarray:
    """Edges that start in a text and whose value is in the text's list (the third column; null: none)."""
    out = np.zeros(len(values), bool)
    for i, held in enumerate(part.column(2)):
        a, b = words.first[i], words.first[i + 1]
        if held.is_valid and b > a:
            out[a:b] = np.isin(values[a:b], np.asarray(held.values).view(np.uint64))
    return out & fits


def occurrences(texts: DataFrame, graph: Graph) -> DataFrame:
    """Every place of the edges whose bundle two documents or more have."""
    spark = texts.sparkSession
    bundles = texts.mapInArrow(_bundles(graph), "value long, id long")
    both = bundles.groupBy("value").agg(F.min("id").alias("least"), F.max("id").alias("last"))
    common = kept(both.where("least < last").select("value"), "bundles")
    release(spark)
    lists = kept(bundles.join(common, "value").groupBy("id").agg(F.collect_list("value").alias("held")), "bundle-lists")
    release(spark)
    rows = texts.join(lists, "id").select("id", "text", "held").mapInArrow(
        _occurrences(graph), "value long, id long, pos int, first boolean, before int, after int"
    )
    edges = kept(rows, "edges")
    discard(common, lists)
    release(spark)
    return edges


def _parts(rows: DataFrame, graph: Graph) -> Iterator[DataFrame]:
    for k in range(graph.passes):
        yield rows.where(F.pmod(F.col("value"), F.lit(graph.passes)) == k)


def paths(edges: DataFrame, graph: Graph = Graph()) -> DataFrame:
    """(value, owner, at, path) of the edges that two documents or more have: the smallest one, the edge's first
    place there, and where its path starts there.

    Two edges that follow each other in their source are on one path unless the node between them branches:
    unless some place of the first has another word after it, or some place of the second another one before it.
    """
    at = F.min_by("pos", F.when(F.col("first"), F.col("id"))).alias("at")
    one_in, one_out = F.min("before") == F.max("before"), F.min("after") == F.max("after")
    found = []
    for part in _parts(edges, graph):
        every = part.groupBy("value").agg(F.min("id").alias("owner"), F.max("id").alias("last"), at, one_in.alias("one_in"), one_out.alias("one_out"))
        found.append(kept(every.where("owner < last").drop("last"), "shared"))
        release(edges.sparkSession)
    along = Window.partitionBy("owner").orderBy("at", "value")
    follows = (F.lag("at").over(along) == F.col("at") - 1) & F.lag("one_out").over(along) & F.col("one_in")
    begins = ~F.coalesce(follows, F.lit(False))
    path = F.max(F.when(F.col("begins"), F.col("at"))).over(along.rowsBetween(Window.unboundedPreceding, 0))
    rows = reduce(DataFrame.union, found).withColumn("begins", begins).select("value", "owner", "at", path.alias("path"))
    out = kept(rows, "paths")
    discard(*found)
    release(edges.sparkSession)
    return out


def spans(edges: DataFrame, routes: DataFrame, graph: Graph = Graph()) -> DataFrame:
    """(id, start, n, owner, owner_start): n edges on end that a later document shares with a path."""
    key = ["id", "owner", "path", "shift"]

    def places(edges: DataFrame, routes: DataFrame) -> DataFrame:
        both = edges.select("value", "id", "pos").join(routes, "value").where("id > owner")
        return both.select("id", "owner", "path", (F.col("pos") - F.col("at")).alias("shift"), "at")

    def runs(rows: DataFrame, n, low: str, high: str) -> DataFrame:
        return rows.groupBy(*key).agg(n.cast("int").alias("n"), F.min(low).alias("low"), F.max(high).alias("high"))

    met = []
    for part, route in zip(_parts(edges, graph), _parts(routes, graph)):
        met.append(kept(runs(places(part, route), F.count("*"), "at", "at"), "met"))
        release(edges.sparkSession)
    found = kept(runs(reduce(DataFrame.union, met), F.sum("n"), "low", "high"), "runs")
    discard(*met)
    gaps = found.where("high - low + 1 <> n")
    out = found.where("high - low + 1 = n").selectExpr("id", "shift + low as start", "n", "owner", "low as owner_start")
    if gaps.head(1):  # two words with equal labels hid a branch: these edges go one by one
        alone = places(edges, routes).join(gaps.select(*key), key, "left_semi")
        out = out.union(alone.selectExpr("id", "shift + at as start", "1 as n", "owner", "at as owner_start"))
    return kept(out, "spans")


def _digest(words: Words, data: bytes, first: int, n: int) -> bytes:
    """128 bits of the digest of n words."""
    at = zip(words.start[first : first + n].tolist(), words.end[first : first + n].tolist())
    return hashlib.sha256(b" ".join([data[a:b] for a, b in at])).digest()[:16]


def _source_digests(graph: Graph):
    """(owner, owner_start, n, digest) of texts (id, text, wanted): the words of every span that others share."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                part = batch.slice(at, len(texts))
                words, rows = Words(texts), []
                data = words.data.tobytes()
                for doc, wanted, first, last in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), words.first[:-1].tolist(), words.first[1:].tolist()):
                    for span in wanted:
                        begin, n = first + span["owner_start"], span["n"] + graph.width - 1
                        if begin + n <= last:  # else it is a place in another text with the same id
                            rows.append((doc, span["owner_start"], span["n"], _digest(words, data, begin, n)))
                columns = list(zip(*rows)) or [[], [], [], []]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["owner", "owner_start", "n", "digest"])

    return task


def verified_spans(texts: DataFrame, graph: Graph = Graph()) -> DataFrame:
    """(id, start, n, owner, owner_start, digest) of texts (id, text): spans of n edges with the coordinates of
    their source and the digest of the source's words. What does not have that digest is not the same text."""
    spark = texts.sparkSession
    named = texts.where("id is not null and text is not null")
    edges = occurrences(named, graph)
    routes = paths(edges, graph)
    found = spans(edges, routes, graph)
    discard(edges, routes)
    release(spark)
    key = ["owner", "owner_start", "n"]
    wanted = found.select(*key).distinct().groupBy("owner").agg(F.collect_list(F.struct("owner_start", "n")).alias("wanted"))
    sources = named.join(wanted, F.col("id") == F.col("owner")).select("id", "text", "wanted")
    digests = kept(sources.mapInArrow(_source_digests(graph), "owner long, owner_start int, n int, digest binary").distinct(), "digests")
    release(spark)
    return found.join(fitting(digests, graph.broadcast_rows), key).select("id", "start", "n", "owner", "owner_start", "digest")


def _checked(words: Words, data: bytes, first: int, last: int, held: list | None, graph: Graph) -> list[tuple[int, int]]:
    """[(from, upto)] of a text's words that spans with the right digest cover, in order and apart."""
    out: list[tuple[int, int]] = []
    for span in sorted(held or (), key=lambda x: x["start"]):
        a, n = span["start"], span["n"] + graph.width - 1
        if first + a + n > last or _digest(words, data, first + a, n) != span["digest"]:
            continue
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], a + n))
        else:
            out.append((a, a + n))
    return out


def _cut(graph: Graph, give: Callable):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                part = batch.slice(at, len(texts))
                words = Words(texts)
                data, bounds = words.data.tobytes(), zip(words.first[:-1].tolist(), words.first[1:].tolist())
                found = [_checked(words, data, a, b, held, graph) for (a, b), held in zip(bounds, part.column(2).to_pylist())]
                yield give(part, words, data, found)

    return task


def _with_repeats(docs: DataFrame, graph: Graph, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    held = verified_spans(texts, graph).groupBy("id").agg(F.collect_list(F.struct("start", "n", "digest")).alias("held"))
    return texts.join(kept(held, "repeats"), "id", "left").select("id", "text", "held")


def repeated_spans(docs: DataFrame, graph: Graph = Graph(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, stop, words): every span of words that would be removed."""

    def give(part, words, data, found):
        rows = [
            (doc, a, b, b" ".join(data[words.start[k] : words.end[k]] for k in range(first + a, first + b)).decode())
            for doc, first, spans in zip(part.column(0).to_pylist(), words.first.tolist(), found)
            for a, b in spans
        ]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*rows)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "start", "stop", "words"])

    return _with_repeats(docs, graph, id_col, text_col).mapInArrow(_cut(graph, give), "doc_id long, start long, stop long, words string")


def remove_repeats(docs: DataFrame, graph: Graph = Graph(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, text) for every row of documents: what is left of a text is its
    kept words with one space between them, and the text as it was where nothing is removed.

    Null and empty texts have no words; the kept words' digest is then that of the empty string. A row without an
    id owns nothing and loses nothing. Rows that repeat an id are not smaller than each other, so a window that
    only they share stays. An empty table gives no rows; other columns are not read.
    """

    def give(part, words, data, found):
        gone, digests, texts = [], [], []
        for i, (first, last) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            stay = np.ones(last - first, bool)
            for a, b in found[i]:
                stay[a:b] = False
            starts, ends = words.start[first:last][stay].tolist(), words.end[first:last][stay].tolist()
            left = b" ".join([data[s:e] for s, e in zip(starts, ends)])
            gone.append(last - first - len(starts))
            digests.append(hashlib.sha256(left).hexdigest())
            texts.append(left.decode() if found[i] else part.column(1)[i].as_py())
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(words.counts.astype(np.int64)), pa.array(gone, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "text"],
        )

    rows = _with_repeats(docs, graph, id_col, text_col)
    return rows.mapInArrow(_cut(graph, give), "doc_id long, n_words long, n_removed long, kept_sha256 string, text string")
