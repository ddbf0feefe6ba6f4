"""Operators on small tables with nulls, empty texts, repeated rows and clashing columns, against plain versions."""

import hashlib
import random
import re
import textwrap
from collections import Counter
from itertools import pairwise

import pyarrow as pa
import numpy as np
import pytest
from pyspark.sql import functions as F

from chainloom.llm import decontam, forest, mixture, sharding, substrings
from chainloom.llm.compression import Rules, keep_good, score_quality
from chainloom.llm.graph import components
from chainloom.llm.licenses import KNOWN, MIT, known_digests, scan_licenses
from chainloom.llm.shared import fits

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, _id int, hash string, row int, epochs int, held string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices("abcdeéßgh", k=rng.randint(1, 9))) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "\n", "\t "]) for w in words)


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    base, passage = prose(rng, 200), prose(rng, 60)
    out: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, "ONE two three")]
    out += [(10 + i, prose(rng, rng.randint(1, 400))) for i in range(20)]
    out += [(40, base), (41, base), (42, base.upper()), (43, base + "extra words at the end of it"), (44, "x " + base)]
    for i in range(12):
        words = base.split(" ")
        words[rng.randrange(len(words))] = f"changed{i}"
        out.append((50 + i, " ".join(words)))
    out += [(70 + i, prose(rng, 30) + passage + prose(rng, 30)) for i in range(5)]
    out += [(80, "same line of words here\n" * 40), (81, prose(rng, 20) + " " + "w" * 5000), (82, prose(rng, 6000))]
    out += [(90, base), (90, base), (91, passage), (91, prose(rng, 80)), (None, base), (None, None)]
    return out


ROWS = texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", [None, "a", "b", "c"][(i or 0) % 4], len(t or ""), "clash", 7, "h", 1, 3, "x") for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(frame, *names):
    return Counter(tuple(r[n] for n in names) for r in frame.collect())


def test_quality_counts(docs, nothing):
    want = Counter()
    for i, text in ROWS:
        words = WORD.findall(text or "")
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        count = Counter(windows)
        repeats = len({k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(3)})
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * repeats > 50 * len(words)
        want[(i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), repeats, failed)] += 1
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    scored = score_quality(docs)
    assert rows_of(scored, *names) == want
    assert scored.where("kept and base_failed").count() == 0
    kept = keep_good(docs)
    assert kept.schema == docs.schema
    assert rows_of(kept, "doc_id") == rows_of(scored.where("kept"), "doc_id")
    assert score_quality(nothing).count() == keep_good(nothing).count() == 0


def test_quality_bands(spark):
    rng = random.Random(1)
    noise = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=60)) for _ in range(200))
    varied = " ".join(f"the number {k} is in this list of things" for k in range(2000))
    good = prose(rng, 600)
    rows = spark.createDataFrame([(1, noise), (2, varied), (3, good)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in score_quality(rows, Rules(max_repeat_percent=100)).collect()}
    assert [found[k]["kept"] for k in (1, 2, 3)] == [True, False, True] or found[1]["ratio"] > found[3]["ratio"] > found[2]["ratio"]
    assert not found[2]["kept"] and found[3]["kept"]


def test_quality_bands_of_every_length(spark):
    rng = random.Random(2)
    common = ["".join(rng.choices("eeeeetttaaoinsrhldcump", k=rng.randint(2, 9))) for _ in range(3_000)]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    printable = "".join(map(chr, range(33, 127)))

    def text(kind, n):
        phrase = " ".join(rng.choices(common, k=12)) + " "
        words = {
            "prose": lambda: rng.choices(common, k=n // 3),
            "base64": lambda: ("".join(rng.choices(letters, k=8)) for _ in range(n // 8)),
            "printable": lambda: ("".join(rng.choices(printable, k=rng.randint(3, 9))) for _ in range(n // 4)),
            "loop": lambda: [phrase * (n // len(phrase) + 1)],
        }[kind]()
        return " ".join(words)[:n]

    # The two longest classes have too few texts for limits of their own; chunks have enough of them.
    sizes = {600: 60, 1_500: 60, 8_000: 60, 60_000: 3, 500_000: 1}
    rows = [(kind, n, text(kind, n)) for n, times in sizes.items() for kind in ["prose"] * times + ["base64", "printable", "loop"]]
    frame = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(rows)], "doc_id long, text string").repartition(4)
    rules = Rules(max_repeat_percent=100, min_words=40)
    kept = {r["doc_id"] for r in score_quality(frame, rules).where("kept").collect()}
    assert {rows[i][:2] for i in kept} == {("prose", n) for n in sizes} and len(kept) == sum(sizes.values())
    assert {r["doc_id"] for r in keep_good(frame, rules).collect()} == kept
    # Most of a class being copies does not draw its limits in.
    copies = frame.where("doc_id < 60").union(spark.createDataFrame([(1_000 + k, rows[0][2]) for k in range(500)], "doc_id long, text string"))
    assert score_quality(copies, rules).where("not kept").count() == 0
    # Base32 text is inside the outer bands; only the limits that come from the documents reject it.
    base32 = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz234567", k=8)) for _ in range(900))[:8_000]
    one = spark.createDataFrame([(5_000, base32)], "doc_id long, text string")
    assert score_quality(one, rules).first()["kept"] and not score_quality(frame.union(one), rules).where("doc_id = 5000").first()["kept"]


def sets_of(text):
    words = WORD.findall((text or "").translate(A_TO_Z))
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def plain_components(rows, percent=85):
    named = [(i, sets_of(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in named}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, s) in enumerate(named):
        for j, t in named[:k]:
            both = len(s & t)
            if i == j or (both and 100 * both >= percent * (len(s) + len(t) - both)):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in up}


@pytest.mark.parametrize("shape", [forest.Forest(), forest.Forest(region=4, group_shingles=3_000, broadcast_rows=0)])
def test_near_duplicates(docs, nothing, shape):
    of = plain_components(ROWS)
    want = Counter((i, len(sets_of(t)), of.get(i), i is None or of[i] == i) for i, t in ROWS)
    # Documents without words are linked with nothing, even where their id is repeated.
    assert rows_of(forest.near_duplicates(docs, shape), "doc_id", "n_shingles", "component_id", "kept") == want
    if shape.broadcast_rows:
        left = forest.one_of_each(docs, shape)
        assert left.columns == COLUMNS
        assert rows_of(left, "doc_id") == Counter([(i,) for i in of if of[i] == i] + [(None,)] * 2)
        assert forest.near_duplicates(nothing, shape).count() == 0


def test_large_groups_are_linked_exactly(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        rows.append((i + 1, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in forest.near_duplicates(frame, forest.Forest(region=16)).collect()}
    assert got == plain_components(rows)


def test_regions_by_common_prefix():
    rng = np.random.default_rng(2)
    for few, region in ((2, 5), (3, 3), (50, 50)):
        # A hash that few values have makes long common prefixes; length 4, own depth 2, trees 0 and 1.
        hashes = rng.integers(0, 3, (200, 4)).astype(">u4")
        tree = rng.integers(0, 2, 200).astype(">u2")
        raw = np.hstack([tree.view(np.uint8).reshape(-1, 2), np.ascontiguousarray(hashes).view(np.uint8).reshape(200, 16)])
        keys = np.array(sorted(map(bytes, raw)))
        keys = [k.ljust(18, b"\0") for k in keys]
        lcp = forest.common(np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 18))
        for at, (x, y) in enumerate(zip(keys, keys[1:])):
            same = next((d for d in range(4) if x[: 2 + 4 * (d + 1)] != y[: 2 + 4 * (d + 1)]), 4)
            assert lcp[at] == same
        found = forest.adaptive(lcp, 4, 2, few, region)
        for at, key in enumerate(keys):
            sizes = {d: sum(k.startswith(key[: 2 + 4 * d]) for k in keys) for d in range(1, 5)}
            d = next((d for d, n in sizes.items() if n <= (region if d >= 2 else min(few, region))), None)
            first = next(k for k, other in enumerate(keys) if other.startswith(key[: 2 + 4 * d])) if d else -1
            assert found[at] == first


def test_recall_of_candidates(spark):
    rng = random.Random(9)
    rows = []
    for group in range(60):
        base = [f"g{group}w{k}" for k in range(rng.randint(60, 200))]
        for _ in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"new{rng.random()}"
            rows.append((len(rows) + 1, " ".join(words)))
    # One passage at the head of all texts, so that regions of short prefixes are large.
    shared = " ".join(f"s{k}" for k in range(30))
    rows = [(i, f"{shared} {text}") for i, text in rows]
    sets = [sets_of(t) for _, t in rows]
    pairs = [(i, j) for j in range(len(rows)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for shape in (forest.Forest(), forest.Forest(region=8, few=2)):
        edges = forest.candidates(frame, frame.selectExpr("doc_id as node"), shape, "doc_id", "text").collect()
        groups = forest.Groups(len(rows) + 1)
        for a, b in edges:
            groups.join(a, b)
        met = sum(groups.root(i + 1) == groups.root(j + 1) for i, j in pairs)
        assert len(pairs) > 100 and met / len(pairs) >= 0.99


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 200), (200, 150), (7, 7), (300, 300), (None, 4)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 61)}, 100: 100, 150: 100, 200: 100, 300: 300}


ITEMS = [(1, None), (2, ""), (3, "Short Item!"), (4, " ".join(f"q{k}" for k in range(14))), (5, " ".join(f"Q{k}" for k in range(2, 12))), (6, "été noir")]


def contaminated_rows():
    long = "; ".join(f"q{k}" for k in range(14))
    return [
        (1, None), (2, "--- !"), (3, f"before {long} after"), (3, f"before {long} after"), (4, "q0 q1 q2 q3 q4 q5 q6 q7 q8 q9"), (5, "a short-item is here, short item"),
        (6, "q0 q1 q2 q3"), (None, "ÉTÉ noir, été NOIR"), (8, "clean words only"), (9, "short item"), (9, "other text of the same id"),
    ]


def plain_contamination(rows, items):
    windows = {}
    for item, text in items:
        words = ITEM_WORD.findall((text or "").translate(A_TO_Z))
        n = min(10, len(words))
        for k in range(len(words) - n + 1) if n else ():
            windows.setdefault(tuple(words[k : k + n]), set()).add(str(item))
    out = []
    for i, text in rows:
        words = ITEM_WORD.findall((text or "").translate(A_TO_Z))
        hit, ids = set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if found := windows.get(tuple(words[k : k + n])):
                    hit |= set(range(k, k + n))
                    ids |= found
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(ids), digest, bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("limits", [{}, {"broadcast_windows": 0, "broadcast_documents": 0}])
def test_contamination(spark, docs, nothing, limits):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = contaminated_rows()
    frame = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, _hits string, item string")
    overlap = decontam.Overlap(**limits)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(decontam.contamination(frame, items, overlap), *names) == plain_contamination(rows, ITEMS)
    left = decontam.decontaminate(frame, items, overlap)
    assert left.columns == frame.columns
    assert rows_of(left, "doc_id") == Counter([(1,), (2,), (6,), (8,), (9,)])
    cut = {r["doc_id"]: r["text"] for r in decontam.decontaminate(frame, items, overlap, remove="spans").where("doc_id in (1, 3, 5, 8)").collect()}
    assert cut == {1: None, 3: f"before {'; '.join([''] * 14)} after", 5: "a - is here,  ", 8: "clean words only"}
    empty = items.limit(0)
    assert decontam.contamination(docs, empty).where("contaminated").count() == 0
    assert decontam.contamination(nothing, items).count() == 0


@pytest.mark.parametrize("limits", [{"broadcast_bytes": 0}, {"broadcast_windows": 0}, {"broadcast_documents": 0}])
def test_contamination_beyond_a_limit(spark, limits):
    items, rows, overlap = spark.createDataFrame(ITEMS, "item_id long, text string"), contaminated_rows(), decontam.Overlap(**limits)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(decontam.contamination(frame, items, overlap), *names) == plain_contamination(rows, ITEMS)
    assert rows_of(decontam.decontaminate(frame, items, overlap), "doc_id") == Counter([(1,), (2,), (6,), (8,), (9,)])


def test_what_is_put_on_documents_is_narrow(spark, monkeypatch):
    sides, fitting = [], decontam.fitting
    monkeypatch.setattr(decontam, "fitting", lambda frame, *limits: sides.append(frame) or fitting(frame, *limits))
    leak = " ".join(f"leaked{k}" for k in range(300))
    items = spark.createDataFrame([(f"item {k}", leak) for k in range(20)], "item_id string, text string")
    frame = spark.createDataFrame([(k, f"own{k} {leak} end" if k % 2 else f"own{k}") for k in range(20)], "doc_id long, text string")
    assert {r["doc_id"] for r in decontam.decontaminate(frame, items).collect()} == {*range(0, 20, 2)}
    size = F.octet_length(F.to_json(F.struct("*")))
    assert [s.select(F.max(size)).first()[0] < 200 for s in sides if s.count() == 10] == [True]  # windows of words take 290 times that
    sides.clear()
    got = decontam.contamination(frame, items)
    assert {(r["n_hit"], r["n_items"]) for r in got.where("contaminated").collect()} == {(300, 20)}
    assert [s.select(F.max(size)).first()[0] < 3_000 for s in sides if s.count() == 10] == [True]


def test_broadcast_by_bytes(spark):
    rows = [(k, "x" * 1_000, [["y" * 500]] * 2) for k in range(10)] + [(None, None, None)]
    frame = spark.createDataFrame(rows, "id long, text string, parts array<array<string>>")
    assert fits(frame, 11) and not fits(frame, 10) and fits(frame, 11, 40_000) and not fits(frame, 11, 15_000) and not fits(frame, 10, 40_000)
    assert fits(frame.limit(0), 0, 0)


def test_substrings(docs, nothing):
    first = {}
    for i, text in ROWS:
        words = WORD.findall(text or "")
        for k in range(len(words) - 12):
            if i is not None:
                key = tuple(words[k : k + 13])
                first[key] = min(first.get(key, i), i)
    want = Counter()
    for i, text in ROWS:
        words = WORD.findall(text or "")
        gone = {k + j for k in range(len(words) - 12) if i is not None and first[tuple(words[k : k + 13])] < i for j in range(13)}
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        want[(i, len(words), len(gone), hashlib.sha256(left.encode()).hexdigest())] += 1
    assert rows_of(substrings.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    spans = substrings.repeated_spans(docs)
    assert spans.where("size(split(words, ' ')) <> stop - start").count() == 0
    assert spans.agg(F.sum(F.col("stop") - F.col("start"))).first()[0] == sum(n * k[2] for k, n in want.items())
    assert substrings.remove_repeats(nothing).count() == 0


def test_paths_and_sources(spark):
    rng = random.Random(3)
    passage, other = [f"p{k}" for k in range(40)], [f"q{k}" for k in range(30)]
    own = [[f"w{rng.random()}" for _ in range(20)] for _ in range(6)]
    rows = [(k + 1, " ".join(own[k] + passage + own[k][::-1])) for k in range(3)]
    # The passage goes on in two ways after its 20th word: the edges up to there are one path, those behind it others.
    rows += [(k + 1, " ".join(own[k] + passage[:20] + other)) for k in range(3, 6)]
    frame = spark.createDataFrame(rows, "id long, text string")
    graph = substrings.Graph()

    def spans():
        return {(r["id"], r["start"], r["n"], r["owner"], r["owner_start"]) for r in substrings.verified_spans(frame, graph).collect()}

    want = {(i, 20, 8, 1, 20) for i in (2, 3, 4, 5, 6)} | {(i, 28, 20, 1, 28) for i in (2, 3)} | {(i, 28, 30, 4, 28) for i in (5, 6)}
    assert spans() == want
    edges = substrings.occurrences(frame, graph)
    assert substrings.paths(edges).select("owner", "path").distinct().count() == 3
    # A span whose words are not those of its source is refused.
    words = substrings.Words(pa.array([rows[1][1]]))
    good = substrings._digest(words, rows[1][1].encode(), 20, 20)
    held = [{"start": 20, "n": 8, "digest": good}, {"start": 21, "n": 8, "digest": good}, {"start": 70, "n": 8, "digest": good}]
    assert substrings._checked(words, rows[1][1].encode(), 0, len(words.start), held, graph) == [(20, 40)]


def test_sharding(spark, docs, nothing, tmp_path):
    copies = spark.createDataFrame([(7, "copy " * 30)] * 9 + [(8, "big " * 300), (None, None), (None, "n")], "doc_id long, text string")
    frame = docs.select("doc_id", "text").union(copies)
    limit = sharding.Shards(limit_bytes=600)
    rows = sharding.shard(frame, limit).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in frame.collect())
    total, members = Counter(), Counter()
    for r in rows:
        total[r["shard"]] += r["n_bytes"]
        members[r["shard"]] += 1
    for r in rows:
        assert r["shard_bytes"] == total[r["shard"]]
        assert total[r["shard"]] <= 600 or members[r["shard"]] == 1
        assert len(r["shard"].split(".")[0]) == r["depth"]
    names = {s.split(".")[0] for s in total}
    assert not any(a != b and b.startswith(a) for a, b in pairwise(sorted(names)))
    # No bucket is split that would fit with its neighbour.
    by_prefix = Counter()
    for r in rows:
        for d in range(r["depth"]):
            by_prefix[r["shard"][:d]] += r["n_bytes"]
    assert all(v > 600 for v in by_prefix.values())
    assert sharding.shard(nothing).count() == 0
    sharding.write_shards(docs, str(tmp_path / "shards"), limit)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == docs.count()


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_sources, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if weight[s] * level > 2 * sizes[s]}
        for s in over or open_sources:
            target[s] = 2.0 * sizes[s] if over else weight[s] * level
            left -= target[s] if over else 0
        open_sources = open_sources - over if over else set()
    return target


def test_mixture(docs, nothing):
    rows = mixture.mixture(docs, mixture.Mix(shard_words=2_000)).collect()
    size = Counter()
    for i, text in ROWS:
        size[[None, "a", "b", "c"][(i or 0) % 4]] += len(WORD.findall(text or ""))
    target, by_size = plain_targets(size), {}
    assert len(set(size.values())) == len(size)
    for s, n in size.items():
        by_size[n] = s
    taken = Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        s = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(target[s])
        taken[s] += r["taken"]
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, len(WORD.findall(t or ""))) for i, t in ROWS)
    assert all(abs(taken[s] - target[s]) <= 16 * 4 for s in size)
    again = mixture.mixture(docs.repartition(5), mixture.Mix(shard_words=2_000)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert mixture.mixture(nothing).count() == 0


def test_mixed_texts(docs):
    unique = docs.where("doc_id is not null and doc_id < 90")
    taken = {r["doc_id"]: r["taken"] for r in mixture.mixture(unique).collect()}
    got, out = Counter(), mixture.mixed(unique)
    assert out.columns == COLUMNS
    for r in out.collect():
        got[r["doc_id"]] += len(WORD.findall(r["text"] or ""))
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in got.items() if v}


def test_mixed_rows_that_share_an_id(spark, docs):
    rng = random.Random(8)
    rows = [(None, n, prose(rng, n)) for n in (100, 200, 300, 300, 55)] + [(7, 90, prose(rng, 90)), (7, 180, prose(rng, 180)), (8, 40, prose(rng, 40))]
    frame = spark.createDataFrame([(i, t, "ab"[k % 2], n) for k, (i, n, t) in enumerate(rows)], "doc_id long, text string, source string, mark long").repartition(3)
    for given in (frame, docs):
        want = Counter()
        for r in mixture.mixture(given).collect():
            want[r["doc_id"], r["source_size"]] += r["taken"]
        sizes = {s: n for s, n in given.select("source", F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")).alias("n")).groupBy("source").agg(F.sum("n")).collect()}
        got = Counter()
        for r in mixture.mixed(given).collect():
            got[r["doc_id"], sizes[r["source"]]] += len(WORD.findall(r["text"] or ""))
        assert +got == +want
    texts = {n: " ".join(WORD.findall(t)) for _, n, t in rows if n != 300}
    whole = Counter()
    for r in mixture.mixed(frame).collect():
        if r["mark"] in texts:
            words = WORD.findall(r["text"])
            assert " ".join(words) in texts[r["mark"]] + " " + texts[r["mark"]]
            whole[r["mark"]] += len(words)
    assert all(whole[n] <= 2 * n for n in texts)


def test_apportionment(spark):
    weights, seats = [53_000, 24_000, 23_000, 10, 0], 100
    parties = spark.createDataFrame([(0, k, w, seats) for k, w in enumerate(weights)], "g int, p int, w long, seats long")
    got = {r["p"]: r["quota"] for r in mixture.apportion(parties, "g", "p", "w", "seats").collect()}
    want = Counter()
    for _ in range(seats):
        want[max((k for k in range(5) if weights[k]), key=lambda k: (weights[k] / (2 * want[k] + 1), -k))] += 1
    assert got == {k: want[k] for k in range(5)}


def test_licenses(spark, docs, nothing):
    known = known_digests(spark)
    changed = "Copyright (c) 2020 Somebody\n\n" + MIT.replace("Software", "SOFTWARE").replace('"', "“").replace("\n", "  \n").replace("sublicense", "sub-license")
    frame = spark.createDataFrame(
        [(1, changed), (2, "text\n# Released under the MIT licence\nlicensed under CC BY-NC 4.0!\nReleased under the MIT License."), (3, None), (4, "no such thing"), (4, "no such thing"), (5, MIT + " and more")],
        "doc_id long, text string",
    )
    got = Counter((r["doc_id"], r["license"], r["n_notices"], r["notices"]) for r in scan_licenses(frame, known).collect())
    assert got == Counter([(1, "MIT", 0, ""), (2, None, 3, "CC-BY-NC-4.0,MIT"), (3, None, 0, ""), (4, None, 0, ""), (4, None, 0, ""), (5, None, 0, "")])
    assert rows_of(scan_licenses(docs, known), "doc_id") == rows_of(docs, "doc_id")
    assert scan_licenses(nothing, known).count() == 0
    assert {n for n, _ in KNOWN} >= {r["license"] for r in known.collect()}


def test_licenses_in_every_wrapping(spark):
    rows, names = [], []
    heads = ["", "Copyright (c) 2020 Somebody\n", "Copyright 2019-2021 The Authors. All rights reserved.\n", "# Copyright [yyyy] [name of copyright owner]\n", "Copyright Somebody Else Inc.\nAll rights reserved.\n", "Copyright by the Very Long Name Inc. All rights reserved.\n", "(c) 2020 Somebody\n", "© Somebody\n"]
    for name, text in KNOWN:
        if len(text) > 200:
            one = " ".join(text.split())
            # The line breaks of the usual file, of every narrower one, and one before every "copyright".
            wraps = [one, text, re.sub("(?i) copyright", lambda m: "\n" + m[0].strip(), one)]
            wraps += ["\n".join(textwrap.wrap(one, width)) for width in (*range(20, 120), 10_000)]
            names += [name] * len(wraps)
            rows += [heads[k % len(heads)] + w for k, w in enumerate(wraps)]
    usual = MIT.replace("\n", " ").replace("AUTHORS OR COPYRIGHT", "\nAUTHORS OR COPYRIGHT")
    frame = spark.createDataFrame(list(enumerate([*rows, *(h + usual for h in heads)])), "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in scan_licenses(frame, known_digests(spark)).collect()}
    assert got == dict(enumerate([*names, *["MIT"] * len(heads)]))
    # What a line says besides the notice counts.
    other = MIT.replace("COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", "COPYRIGHT HOLDERS BE LIABLE FOR EVERY CLAIM")
    assert scan_licenses(spark.createDataFrame([(1, other)], "doc_id long, text string"), known_digests(spark)).first()["license"] is None
