"""Periodic runs of words: where a text repeats a phrase again and again, and the text with one round of it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import SPACES
from chainloom.llm.suffixtree import maximal_runs
from chainloom.llm.words import Words, mix, slices

RUNS = "runs array<struct<start:long,length:long,period:long>>"
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


@dataclass(frozen=True)
class Runs:
    """least: the words of a run, which also has two periods at least. together: stretches of so many words share a
    pair of trees (a longer one has its own)."""

    least: int = 12
    together: int = 8192


def stretches(words: Words, hashes: np.ndarray, width: int) -> np.ndarray:
    """(first word, end) of the stretches that can hold a run: those that repeated windows cover.

    In a run of least = 2 * width words or more, at least `width` words in a row equal those one period on, so
    each of its words lies in a window of `width` words that the run holds twice. So a run lies in one stretch of
    such windows, whole, and the windows repeat inside the stretch; looking again at the stretches alone removes
    what repeats only elsewhere in the text. Equal hashes of different words can but leave a stretch in.
    """
    windows, _ = words.windows(hashes, width)
    bounds = np.stack([words.first[:-1], words.first[1:]], axis=1)
    while len(bounds):
        size = bounds[:, 1] - bounds[:, 0]
        bounds = bounds[size >= 2 * width]
        size = bounds[:, 1] - bounds[:, 0]
        part = np.repeat(np.arange(len(bounds)), size - width + 1)
        begin = np.cumsum(size - width + 1) - (size - width + 1)
        place = np.arange(len(part)) - np.repeat(begin, size - width + 1) + np.repeat(bounds[:, 0], size - width + 1)
        keys = mix(windows[place] ^ mix(part.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        marks = np.zeros(len(words.start) + 1, np.int64)
        np.add.at(marks, place[twice], 1)
        np.add.at(marks, place[twice] + width, -1)
        covered = np.cumsum(marks[:-1]) > 0
        edge = np.zeros(len(covered) + 1, bool)
        edge[bounds.ravel()] = True
        gap = np.concatenate([[True], ~covered, [True]])
        first = np.flatnonzero(covered & (gap[:-2] | edge[:-1]))
        end = np.flatnonzero(covered & (gap[2:] | edge[1:])) + 1
        found = np.stack([first, end], axis=1)
        if (end - first).sum() == size.sum():
            return found
        bounds = found
    return bounds


def text_runs(texts: pa.Array, rules: Runs) -> tuple[list[list[tuple[int, int, int]]], list[list[bytes]]]:
    """The runs of each text, and its words."""
    words = Words(texts)
    raw, bounds = words.data.tobytes(), words.bounds.tolist()
    split = [raw[a:b].split() for a, b in zip(bounds, bounds[1:])]
    out: list[list[tuple[int, int, int]]] = [[] for _ in split]
    spans = stretches(words, words.hashes(), (rules.least + 1) // 2)
    text = np.searchsorted(words.first, spans[:, 0], side="right") - 1
    inside = spans - words.first[text][:, None]
    group = np.cumsum(spans[:, 1] - spans[:, 0]) // rules.together
    for cut in np.split(np.arange(len(spans)), np.flatnonzero(np.diff(group)) + 1):
        _solve([(text[k], *inside[k].tolist()) for k in cut], split, rules, out)
    return out, split


def _solve(held: list[tuple[int, int, int]], split: list[list[bytes]], rules: Runs, out: list[list[tuple[int, int, int]]]) -> None:
    """Find the runs of the held stretches in one pair of trees.

    A symbol of its own ends each stretch. No run holds it, since each word of a run is in it twice.
    """
    number: dict[bytes, int] = {}
    symbols: list[int] = []
    begins = []
    for doc, first, end in held:
        begins.append(len(symbols))
        symbols += [number.setdefault(w, len(number) + 1) for w in split[doc][first:end]]
        symbols.append(0)
    for k, at in enumerate([*begins[1:], len(symbols)] if held else []):
        symbols[at - 1] = len(number) + 1 + k
    for start, length, period in maximal_runs(symbols, rules.least).tolist():
        k = int(np.searchsorted(begins, start, side="right")) - 1
        out[held[k][0]].append((start - begins[k] + held[k][1], length, period))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, rules: Runs = Runs()) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of (doc_id, text), without a shuffle.

    runs: start (word number), length and period of every maximal run, sorted by start and period. collapsed: the
    text with one period of each run, its words joined by one space. A null or empty text has no words, no runs
    and an empty collapsed text. Whole texts are read, of any length: memory is in proportion to the longest one,
    and the trees to its longest repetitive stretch. Every row is judged by itself, so repeated rows and ids, ties
    and null ids are rows like others; other columns are not read, and an empty table gives no rows.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            for at, some in slices(texts):
                runs, words = text_runs(some, rules)
                ends = np.cumsum([0, *map(len, runs)])
                flat = np.array([r for each in runs for r in each], np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN_TYPE))
                columns = [
                    ids.slice(at, len(some)),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                    pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, {RUNS}, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(task, schema)


def with_loops(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) of which about a tenth are made to end in a loop, by the CRC-32 h of the id.

    With h % 10 = 0 and n > 0 words, the words from a = h / 10 % n on repeat the first p of them, where p = 1 +
    (n - a) / (3 + h / 10 % 8). Texts of a null id stay as they are.
    """
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SPACES), lambda w: w != "")
    hit = docs.select("doc_id", "text", h.alias("__h")).withColumn("__w", F.when(F.col("__h") % 10 == 0, words))
    g = F.floor(F.col("__h") / 10)
    at = hit.withColumn("__n", F.size("__w")).withColumn("__a", F.when(F.col("__n") > 0, (g % F.col("__n")).cast("int")))
    placed = at.withColumn("__p", (1 + F.floor((F.col("__n") - F.col("__a")) / (3 + g % 8))).cast("int"))

    def looped(i: Column) -> Column:
        a, p = F.col("__a"), F.col("__p")
        return F.get("__w", F.when(i < a, i).otherwise(a + (i - a) % p))

    made = F.array_join(F.transform(F.sequence(F.lit(0), F.col("__n") - 1), looped), " ")
    return placed.select("doc_id", F.when(F.col("__a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of the runs and of the collapsed text, from `periodic_runs`."""
    ranked = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    ended = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = found.withColumn("__best", ranked)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("__best.start")).alias("start"),
        F.col("__best.length").alias("length"),
        (-F.col("__best.period")).alias("period"),
        F.floor(1000 * F.col("__best.length") / -F.col("__best.period")).alias("exponent_milli"),
        F.sha2(F.encode(ended, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode(F.col("collapsed"), "UTF-8"), 256).alias("collapsed_sha256"),
    )
