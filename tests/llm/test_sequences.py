"""Periodic runs, token records and repaired conversations against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chainloom.llm import tokenfiles, turns
from chainloom.llm.periodic import Runs, periodic_runs, run_digests, text_runs, with_loops
from chainloom.llm.shared import run_folder
from chainloom.llm.suffixtree import SuffixTree, maximal_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGES = ["lorem ipsum dolor sit amet", "a b", "x", "no more than this and that and so on for ever and ever again today"]


def plain_runs(words, least=2):
    """Every maximal stretch with a smallest period q of at least two periods, by looking at every q."""
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            part = words[i : i + size]
            if size >= max(least, 2 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_runs_of_symbols(symbols):
    assert [tuple(r) for r in maximal_runs(symbols).tolist()] == plain_runs(symbols)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=30))
def test_common_prefixes(symbols):
    n = len(symbols)
    i, j = np.array([(a, b) for a in range(n + 1) for b in range(n + 1) if a != b]).T
    want = [next((k for k in range(n + 1) if symbols[a + k : a + k + 1] != symbols[b + k : b + k + 1] or a + k >= n), 0) for a, b in zip(i, j)]
    tree = SuffixTree(symbols)
    assert tree.common(i, j).tolist() == want
    assert sorted(range(n + 1), key=lambda k: symbols[k:]) == np.argsort(tree.ranks()).tolist()
    assert sorted(range(n + 1), key=lambda k: [-x for x in symbols[k:]]) == np.argsort(tree.ranks(inverted=True)).tolist()


def looping_texts():
    rng = random.Random(3)
    out = [None, "", " \n", "one", "a " * 11, "a " * 12, "same line of words\n" * 40, "x" * 900]
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(" ".join(f"w{rng.randint(0, 40)}" for _ in range(rng.randint(0, 50))))
            parts.append(" ".join([rng.choice(PASSAGES)] * rng.randint(1, 9)))
        out.append("\t".join(parts))
    return [*out, " ".join(f"v{i % 200}" for i in range(700)), " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(600))]


def test_runs_of_texts():
    texts = looping_texts()
    for together in (1, 100, 10**6):
        runs, words = text_runs(pa.array(texts), Runs(together=together))
        for text, found, own in zip(texts, runs, words):
            plain = WORD.findall(text or "")
            assert [w.decode() for w in own] == plain
            assert found == plain_runs(plain, 12)


def test_op11_against_plain(spark):
    texts = looping_texts()
    rows = [(None if i == 5 else i, t, "clash", i) for i, t in enumerate(texts * 3)] + [(7, "twice " * 30, "clash", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").repartition(3)
    want = defaultdict(int)
    for doc_id, text, _, _ in rows:
        words = WORD.findall(text or "")
        h = -1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h >= 0 and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs = plain_runs(words, 12)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        milli = best[1] and 1000 * best[1] // best[2]
        want[(doc_id, len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)))] += 1
    got = defaultdict(int)
    for row in run_digests(periodic_runs(with_loops(docs))).collect():
        got[tuple(row)] += 1
    assert got == want
    assert periodic_runs(docs.limit(0)).count() == 0


# --- token records


@pytest.fixture(scope="module")
def vocabulary():
    return str(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"))


def whole_ids(path, text):
    from tokenizers import Tokenizer

    if path not in LOADED:
        LOADED[path] = Tokenizer.from_file(path)
    return LOADED[path].encode(text or "", add_special_tokens=False).ids


LOADED: dict = {}
PARTS = list("aBé'sDtİß 9\n\t\x1c\x85 \u3000\u0301\u0345ΣσςЖ中한ﬁ<|>endoftx!.ÄŸÿ÷µ½²ª»") + ["<|endoftext|>", "<|ENDOFTEXT|>"]
ODD = st.lists(st.sampled_from(PARTS), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(text=ODD)
def test_ids_by_word_are_those_of_the_whole_text(vocabulary, text):
    global ENCODE
    if "ENCODE" not in globals():
        ENCODE = tokenfiles.Encoder(open(vocabulary, encoding="utf-8").read(), tokenfiles.Tokens(vocabulary, memo=50))
    assert ENCODE.pattern is not None
    assert np.frombuffer(ENCODE(text), "<u2").tolist() == [*whole_ids(vocabulary, text), 1]


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(ODD | st.text("aZ'sé 9\n\x0b.!ÄŸÿ÷×ß<|", max_size=80), max_size=8), size=st.sampled_from([3, 50, 1 << 20]))
def test_ids_of_many_texts_are_those_of_each(vocabulary, texts, size):
    encode = tokenfiles.encoder_of(open(vocabulary, encoding="utf-8").read(), tokenfiles.Tokens(vocabulary))
    assert encode.by_arrow
    was, cut = tokenfiles.STRETCH, tokenfiles.stretches.__defaults__
    tokenfiles.STRETCH, tokenfiles.stretches.__defaults__ = size, (size,)
    try:
        got = encode.many(texts)
    finally:
        tokenfiles.STRETCH, tokenfiles.stretches.__defaults__ = was, cut
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [[*whole_ids(vocabulary, t), 1] for t in texts]


def test_a_worker_keeps_its_encoder_and_looks_up_each_piece_once(vocabulary, monkeypatch):
    text = open(vocabulary, encoding="utf-8").read()
    encode = tokenfiles.encoder_of(text, tokenfiles.Tokens(vocabulary))
    assert tokenfiles.encoder_of(text, tokenfiles.Tokens(vocabulary)) is encode
    asked = []
    monkeypatch.setattr(encode, "pieces", tokenfiles._Memo(lambda p: asked.append(p) or encode._piece(p), 100))
    encode.many([f"w{n} w{n}, w{n}. (w{n})" for n in range(50)])
    assert len(asked) == len(set(asked)) and not encode.plain


def test_op12_against_plain(spark, vocabulary):
    rng = random.Random(2)
    texts = [None, "", " \n ", "It's 3 o'clock NOW", "<|endoftext|> is not <|ENDOFTEXT|>", "é" * 3000, "word " * 4000]
    texts += [" ".join(rng.choice(["Über", "naïve", "don't", "x1", "...", "Ünd", "東京"]) for _ in range(rng.randint(1, 300))) for _ in range(40)]
    rows = [(i * 7 - 20, t, "clash") for i, t in enumerate(texts)] + [(None, "no id", "clash"), (None, None, "clash"), (1, "the same row", "clash"), (1, "the same row", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    got = tokenfiles.round_trip(docs, tokenfiles.Tokens(vocabulary)).collect()
    assert [sorted((r[0] is not None, r[0] or 0) for r in got)] == [sorted((r[0] is not None, r[0] or 0) for r in rows)]
    got.sort(key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == sorted((r.doc_id is not None, r.doc_id or 0) for r in got)
    at = 0
    for row in got:
        assert row.start == at
        at += row.n_tokens
    plain = sorted((str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in ((r[0], [*whole_ids(vocabulary, r[1]), 1]) for r in rows))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == plain
    assert tokenfiles.round_trip(docs.limit(0), tokenfiles.Tokens(vocabulary)).count() == 0


def test_records_are_checked(spark, vocabulary):
    record = tokenfiles.frame(tokenfiles.pack(5, b"\1\0\2\0"))
    doc_id, ids = tokenfiles.unpack(tokenfiles.unframe(record), 2)
    assert (doc_id, ids.tolist()) == (5, [1, 2])
    for at in range(len(record)):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            tokenfiles.unframe(bytes(broken))
    with pytest.raises(ValueError, match="damaged"):
        tokenfiles.unframe(record[:-1])


def test_same_files_again_and_shuffled_reads(spark, vocabulary):
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 9)) for i in range(300)], "doc_id long, text string").repartition(4)
    listed, folders = [], []
    for _ in range(2):
        folders.append(run_folder(spark, "again"))
        listed.append(tokenfiles.write_tokens(docs, folders[-1], tokenfiles.Tokens(vocabulary)))
    assert sorted(map(tuple, listed[0].collect())) == sorted(map(tuple, listed[1].collect()))
    one = [tuple(r) for r in tokenfiles.read_shuffled(spark, listed[0], folders[0], seed=1).collect()]
    same = [tuple(r) for r in tokenfiles.read_shuffled(spark, listed[1], folders[1], seed=1).collect()]
    other = [tuple(r) for r in tokenfiles.read_shuffled(spark, listed[0], folders[0], seed=2).collect()]
    assert one == same != other and sorted(one) == sorted(other)
    assert {r[0]: r[1] for r in one} == {i: [*whole_ids(vocabulary, f"text number {i} " * (i % 9)), 1] for i in range(300)}


# --- conversations


def plain_damage(conv, turn, role, text):
    role, text = (" " if x is None else x for x in (role, text))
    name = ":".join(" " if x is None else str(x) for x in (conv, turn))
    case = zlib.crc32(name.encode()) % 20
    if case == 0:
        return []
    if case == 1:
        text = ""
    if case == 2:
        text = re.sub("[.!?]", "", text)
    return [(turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)


STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ROLES = {"u": "user", "a": "assistant"}


def plain_repair(rows):
    """gaps, counts, cost, audit and digest of one conversation's rows, by a forward search with whole audits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    known = [r[0] for r in rows if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    best = {0: (0, "", ())}
    seen: set = set()

    def offer(into, state, value):
        into[state] = min(into.get(state, value), value)

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for first, to in STEPS[state].items():
                    if first in ROLES:
                        offer(best, to, (cost + 2, audit + "I", (*lines, ROLES[first] + ":")))
        return best

    for _, role, text in rows:
        stripped = text.strip(" \t\n\v\f\r")
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        after: dict = {}
        for state, (cost, audit, lines) in inserted(best).items():
            offer(after, state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + (fault == "truncated")
            for first, to in STEPS[state].items():
                if role[:1] == first:
                    offer(after, to, (more, audit + "K", (*lines, f"{role}:{text}")))
                if first in ROLES:
                    offer(after, to, (more + 2, audit + "R", (*lines, f"{ROLES[first]}:{text}")))
        best = after
    cost, audit, lines = min(v for s, v in inserted(best).items() if s in (0, 3))
    illegal = sum((a[1][:1], b[1][:1]) not in (("s", "u"), ("u", "a"), ("a", "u")) for a, b in zip(rows, rows[1:]))
    return gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def conversations():
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "", "us", None]
    texts = ["Yes.", "No!", "half a", "", " \n", None, "Well?  ", "a:b\nc."]
    rows = [(0, None, "user", "Hi."), (0, None, "user", "Hi."), (0, 3, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]
    for conv in range(1, 120):
        n, clean = rng.choice([1, 2, 5, 9, 30]), rng.random() < 0.4
        for turn in range(n):
            if clean:
                rows.append((conv, turn * rng.choice([1, 1, 2]), roles[turn % 2], f"Text {turn}."))
            else:
                rows.append((conv, rng.choice([turn, turn, turn + 5, None]), rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice([*texts, f"Text {turn}."])))
    rows += [(500, t, "user", "") for t in range(40)] + [(500, 90, "user", "Hi."), (500, 91, "user", "Ho.")]
    rows += [(501, t, "user", "again.") for t in range(60)] + [(502, 1, "assistant", "copy.")] * 50
    return rows


@pytest.mark.parametrize("chunk", [1, 2, 5, 16_384])
def test_op13_against_plain(spark, chunk):
    rows = conversations()
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, kinds string, part int").repartition(3)
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv] += plain_damage(conv, turn, role, text)
    want = {conv: plain_repair(own) for conv, own in by_conv.items()}
    got = turns.repairs(turns.damaged(frame), turns.Turns(chunk)).collect()
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want


def test_repaired_turns(spark):
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = turns.damaged(frame)
    lines = defaultdict(list)
    for r in turns.repaired_turns(made, turns.Turns(7)).orderBy("place").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
        assert r.place == len(lines[r.conv_id]) - 1
    for r in turns.repairs(made).collect():
        assert hashlib.sha256("\n".join(lines[r.conv_id]).encode()).hexdigest() == r.repaired_sha256
    empty = frame.limit(0)
    assert turns.repairs(turns.damaged(empty)).count() == 0


def test_stretch_without_convergence_takes_few_passes(spark, monkeypatch):
    """Rows that must go keep every vector as it is: the guess for each chunk stays wrong until it is told."""
    rows = [(1, t, "user", "") for t in range(400)] + [(1, 1000, "assistant", "So.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("gone", pa_false())
    passes = []
    monkeypatch.setattr(turns, "_run", lambda frame, run=turns._run: (passes.append(1), run(frame))[1])
    got = turns.repairs(frame, replace(turns.Turns(), chunk=8)).collect()
    assert [tuple(r)[1:] for r in got] == [plain_repair([r[1:] for r in rows])]
    assert len(passes) <= 4


def pa_false():
    from pyspark.sql import functions as F

    return F.lit(False)
