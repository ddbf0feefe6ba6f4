"""The pipeline's stages against plain versions: every stage on the rows that the one before it left."""

import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from chainloom.llm.compression import Rules, measure
from tests.llm.test_operators import ITEM_WORD, WORD, plain_components, plain_targets, sets_of, A_TO_Z
import zstandard

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = " ".join(f"item{k}" for k in range(14))


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, at = random.Random(11), tmp_path_factory.mktemp("tables")
    base = prose(rng, 300)
    texts = [(k, prose(rng, rng.randint(60, 500))) for k in range(1, 30)]
    texts += [(40, base), (41, base), (42, base + " and an end"), (43, base.upper())]
    texts += [(50, prose(rng, 80) + " " + ITEM.upper() + ", " + prose(rng, 80)), (51, "few words"), (52, None), (53, ""), (54, "again and again " * 80)]
    rows = [(i, t, "en", [None, "a", "b"][i % 3], len(t or "")) for i, t in texts]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame([("x", ITEM), ("y", None)], "item_id string, text string").write.parquet(str(at / "benchmark.parquet"))
    spark.createDataFrame([], SCHEMA).write.parquet(str(at / "empty" / "documents.parquet"))
    spark.createDataFrame([("x", ITEM)], "item_id string, text string").write.parquet(str(at / "empty" / "benchmark.parquet"))
    return at


def plain_good(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count = Counter(windows)
    repeats = len({k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(3)})
    if len(words) < 50 or 100 * repeats > 50 * len(words):
        return False
    return measure(text.encode(), Rules(), zstandard.ZstdCompressor(level=3))[2]


def plain_leaks(text):
    words = ITEM_WORD.findall((text or "").translate(A_TO_Z))
    item = ITEM.split()
    windows = {tuple(item[k : k + 10]) for k in range(len(item) - 9)}
    return any(tuple(words[k : k + 10]) in windows for k in range(len(words) - 9))


def test_stages(spark, folder):
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    names, columns = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert names == ["quality rules", "near duplicates", "decontamination", "source mix", "sharding"]
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(folder))
        path = str(folder / re.sub(r"\W", "-", name))
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        at[name] = docs
        assert name == "sharding" or docs.columns == columns

    def texts(name):
        return {r["doc_id"]: r["text"] for r in at[name].select("doc_id", "text").collect()}

    every = {r["doc_id"]: r["text"] for r in spark.read.parquet(str(folder / "documents.parquet")).collect()}
    good = {i: t for i, t in every.items() if plain_good(t)}
    assert texts("quality rules") == good and {1, 40, 50} <= good.keys() and not {51, 52, 53, 54} & good.keys()
    of = plain_components(list(good.items()))
    one = {i: t for i, t in good.items() if of[i] == i}
    assert texts("near duplicates") == one and 40 in one and not {41, 42, 43} & one.keys()
    clean = {i: t for i, t in one.items() if not plain_leaks(t)}
    assert texts("decontamination") == clean and one.keys() - clean.keys() == {50}
    sizes, taken, rows = Counter(), Counter(), at["source mix"].collect()
    for i, t in clean.items():
        sizes[[None, "a", "b"][i % 3]] += len(WORD.findall(t))
    for r in rows:
        taken[r["source"]] += len(WORD.findall(r["text"]))
        assert " ".join(WORD.findall(r["text"])) in " ".join(WORD.findall(clean[r["doc_id"]]) * 2)
    assert all(abs(taken[s] - t) <= 16 * 4 for s, t in plain_targets(sizes).items())
    shards = at["sharding"].collect()
    assert Counter(r["doc_id"] for r in shards) == Counter(r["doc_id"] for r in rows)
    assert sum(r["n_bytes"] for r in shards) == sum(len(r["text"].encode()) for r in rows)
    assert all(r["shard_bytes"] <= 1 << 20 for r in shards)
    assert Counter(map(tuple, corpus_pipeline.run(spark, str(folder)).collect())) == Counter(map(tuple, shards))


def test_empty(spark, folder):
    assert corpus_pipeline.run(spark, str(folder / "empty")).count() == 0


def test_near_copies_from_0_80(spark):
    rng = random.Random(4)
    rows = [(k, prose(rng, 100)) for k in range(1, 9)]
    for k, extra in ((20, 22), (30, 23), (40, 16), (50, 25)):
        base = prose(rng, 100)
        rows += [(k, base), (k + 1, base + " " + prose(rng, extra))]

    def similarity(a, b):
        a, b = (sets_of(dict(rows)[k]) for k in (a, b))
        return len(a & b) / len(a | b)

    assert all(0.80 <= similarity(k, k + 1) < 0.85 for k in (20, 30)) and similarity(40, 41) > 0.85 and similarity(50, 51) < 0.80
    left = corpus_pipeline.near_duplicates(spark, spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], SCHEMA), "")
    of = plain_components(rows, 80)
    assert {r["doc_id"] for r in left.collect()} == {i for i in of if of[i] == i} == {*range(1, 9), 20, 30, 40, 50, 51}
