"""URL filters: rules by host suffix and path, then naive Bayes over the words of host names and paths.

Concatenated names are split into words by a unigram Viterbi search. The word counts come from the visible
text of all pages and from the paths of all URLs; the lattice of a name (its substrings that are words) is made
by a join with the counts, so neither the counts nor the names are collected anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import fitting, kept

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"[^a-z]+"

# The rules of the job, host and path, with their verdicts.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Words of names that make a URL an example of what is not wanted.
UNWANTED = ("adult", "ads", "bet", "bets", "betting", "casino", "gambling", "poker", "porn", "sex", "slots", "spam", "xxx")


@dataclass(frozen=True)
class Words:
    """least: times a word has to be met. A letter that is in no word costs as much as a word met `letter` times.
    smooth: tokens of the usual shares that are added to either class."""

    least: int = 2
    letter: float = 1e-3
    smooth: float = 10.0
    broadcast_rows: int = 500_000


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]], give) -> Column:
    """What give makes of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])
        out = F.when(fits, F.lit(give(rule))).otherwise(out)
    return out


def visible_words(html: Column) -> Column:
    """Lower-case runs of letters outside of tags."""
    return F.split(F.translate(F.regexp_replace(html, r"<[^>]*>", " "), UPPER, LOWER), LETTERS)


def word_counts(pages: DataFrame, words: Words, unwanted: tuple[str, ...]) -> DataFrame:
    """(word, n) of the words of all pages' texts and paths, with at least `least` occurrences, and of the unwanted
    words, which are words wherever they are met. Host names don't count, else they would be words themselves."""
    parts = F.concat(visible_words(F.coalesce("html", F.lit(""))), F.split(F.translate(path_of(F.col("url")), UPPER, LOWER), LETTERS))
    flat = pages.select(F.explode(parts).alias("word")).where(F.length("word") >= 2)
    counts = flat.groupBy("word").agg(F.count("*").alias("n"))
    known = pages.sparkSession.createDataFrame([(w, words.least) for w in unwanted], "word string, n long")
    return counts.union(known).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= words.least)


def viterbi(name: str, found: dict[tuple[int, int], int], total: int, letter: float) -> list[str]:
    """The likeliest split of a name into words; ties go to the longer last word."""
    best, back = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    single = math.log(letter) - math.log(total)
    ending: dict[int, list[tuple[int, float]]] = {}
    for (start, end), n in found.items():
        ending.setdefault(end, []).append((start, math.log(n) - math.log(total)))
    for end in range(1, len(name) + 1):
        words = sorted(ending.get(end, ()))
        if (end - 1, end) not in found:
            words.append((end - 1, single))
        for start, weight in words:
            if best[start] + weight > best[end]:
                best[end], back[end] = best[start] + weight, start
    out, end = [], len(name)
    while end:
        out.append(name[back[end] : end])
        end = back[end]
    return out[::-1]


def segments(names: DataFrame, counts: DataFrame, words: Words) -> DataFrame:
    """(name, words) of distinct names of letters, split by the counts.

    A name's substrings are looked up at every length that some word has which fits into the longest name; there
    are at most as many of those as that name has letters, and far fewer in practice."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    size = F.length("name")
    most = names.agg(F.max(size)).first()[0] or 0
    met = counts.where(F.length("word") <= most).agg(F.collect_set(F.length("word")).alias("lengths")).first()["lengths"]
    lengths = F.split(F.lit(",".join(map(str, sorted(met) or [1]))), ",").cast("array<int>")
    starts = names.select("name", size.alias("size"), F.explode(F.sequence(F.lit(1), size)).alias("start"))
    fits = F.filter(lengths, lambda n: n <= F.col("size") - F.col("start") + 1)
    spans = starts.select("name", "start", F.explode(fits).alias("length")).withColumn("word", F.expr("substring(name, start, length)"))
    lattice = spans.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("start", "length", "n")).alias("spans"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = []
            for name, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {(s["start"] - 1, s["start"] - 1 + s["length"]): s["n"] for s in spans or ()}
                split.append(viterbi(name, found, total, words.letter))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(split, pa.list_(pa.string()))], names=["name", "words"])

    return names.join(lattice, "name", "left").select("name", "spans").mapInArrow(task, "name string, words array<string>")


def tokens(urls: DataFrame, counts: DataFrame, words: Words, unwanted: tuple[str, ...] = ()) -> DataFrame:
    """(host, path, token, times): the words of every distinct URL's host (without its last label) and path, and how
    often the URL has each. An unwanted name is one word and not split."""
    labels = F.split(F.regexp_replace("host", r"\.?[^.]*$", ""), LETTERS)
    parts = F.split(F.translate("path", UPPER, LOWER), LETTERS)
    names = urls.select("host", "path", F.explode(F.concat(labels, parts)).alias("name")).where("name <> ''")
    flat = kept(names.groupBy("host", "path", "name").agg(F.count("*").alias("times")), "names")
    split = segments(flat.select("name").distinct(), counts, words)
    of = F.when(F.col("name").isin(*unwanted), F.array("name")).otherwise(F.col("words"))
    return flat.join(split, "name").select("host", "path", F.explode(of).alias("token"), "times").groupBy("host", "path", "token").agg(F.sum("times").alias("times"))


def scores(urls: DataFrame, counts: DataFrame, words: Words, unwanted: tuple[str, ...], examples: DataFrame | None = None) -> DataFrame:
    """(host, path, score) of distinct URLs (host, path, n): log odds of the unwanted class by multinomial naive Bayes.

    A token counts as often as a URL has it, in training and in scoring. With examples (host, path, bad) the model
    learns from those of the URLs that they name (one that is named both ways is bad). Without, the words themselves
    are the teacher: URLs with an unwanted word are one class, all others the other."""
    of = kept(tokens(urls, counts, words, unwanted), "tokens")
    if examples is None:
        said = of.groupBy("host", "path").agg(F.max(F.col("token").isin(*unwanted)).alias("bad"))
    else:
        said = examples.groupBy("host", "path").agg(F.max("bad").alias("bad"))
    marked = kept(said.join(urls, ["host", "path"]), "marked")

    def classes(n: Column) -> tuple[Column, Column]:
        return F.sum(F.when(F.col("bad"), n).otherwise(0)).alias("bad"), F.sum(F.when(~F.col("bad"), n).otherwise(0)).alias("good")

    n = F.col("n").cast("double")
    urls_of = marked.agg(*classes(n)).first()
    met = kept(of.join(marked, ["host", "path"]).groupBy("token").agg(*classes(n * F.col("times"))), "token-counts")
    tokens_of = met.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    n_bad, n_good = tokens_of["bad"] or 0.0, tokens_of["good"] or 0.0
    usual = words.smooth * (F.col("bad") + F.col("good")) / max(n_bad + n_good, 1.0)
    weight = F.log((F.col("bad") + usual) / (n_bad + words.smooth)) - F.log((F.col("good") + usual) / (n_good + words.smooth))
    prior = math.log(((urls_of["bad"] or 0.0) + 1) / ((urls_of["good"] or 0.0) + 1))
    model = met.select("token", weight.alias("weight"))
    return of.join(model, "token").groupBy("host", "path").agg((F.sum(F.col("weight") * F.col("times")) + prior).alias("score"))


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, words: Words = Words(), unwanted: tuple[str, ...] = UNWANTED, examples: DataFrame | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages (page_id, url, html).

    examples (url, bad): URLs whose class is known; the model learns from them instead of from the unwanted words.

    The longest rule that fits decides; without one the verdict is block where the log odds are over 0. A url
    that is null or has no `://` has an empty host and path and, without words, is allowed. Repeated rows get the
    same verdict; a null html has no words; log odds of 0 allow; an empty table gives no rows; other columns are not
    read. URLs and names of any length are read whole.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule = rule_of(F.col("host"), F.col("path"), rules, lambda r: r[0] + r[1])
    said = rule_of(F.col("host"), F.col("path"), rules, lambda r: r[2])
    rows = kept(rows.withColumn("rule", rule).withColumn("said", said), "urls")
    urls = kept(rows.groupBy("host", "path").agg(F.count("*").alias("n")), "distinct-urls")
    counts = kept(word_counts(pages, words, unwanted), "words")
    if examples is not None:
        known = F.coalesce(F.col("bad"), F.lit(False)).alias("bad")
        examples = examples.select(host.alias("host"), path.alias("path"), known)
    found = kept(scores(urls, counts, words, unwanted, examples), "scores")
    out = rows.join(fitting(found, words.broadcast_rows), ["host", "path"], "left")
    method = F.when(F.col("score") > 0, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"))
