"""Operators on pages: extraction, archives, URL filters."""

import base64
import hashlib
import html
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest

from chainloom.llm import urls, warc
from chainloom.llm.blocks import Training, extract, fit, label, label_long, leaf_blocks, made_pages, new_network, train, vectors
from chainloom.llm.urls import judge, viterbi

PAGES = [
    (1, "http://a.example.org/en/12", "<p>one</p>"), (2, "http://b.com/fr/x?y#z", "<p>one</p>"), (3, None, None), (4, "no scheme", ""), (5, "HTTPS://B.Com:80/de/?q", "<p>café</p>"),
    (6, "http://casinowin.net/play", "<p>casino win play play casino</p>"), (6, "http://casinowin.net/play", "<p>casino win play play casino</p>"), (None, "http://x.net", "<p>one</p>"), (8, "http://example.org/es/1\r\nInjected: 1", "x" * 70_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, text string, original long").repartition(3)


@pytest.fixture(scope="module")
def nothing(pages):
    return pages.where("page_id < 0")


@pytest.mark.parametrize("roll", [64 << 20, 200])
def test_archives(spark, pages, nothing, roll, tmp_path):
    first = {}
    for page, _, body in PAGES:
        if page is not None:
            first[body or ""] = min(first.get(body or "", page), page)
    want = Counter()
    for page, _, body in PAGES:
        data = (body or "").encode()
        revisit = page != first[body or ""]
        want[(page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first[body or ""] if revisit else None)] += 1
    folder = f"file://{tmp_path}/w{roll}"
    got = warc.round_trip(pages, warc.Archive(roll_bytes=roll), folder)
    assert Counter(tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()) == want
    names = sorted(p.name for p in (tmp_path / f"w{roll}").iterdir() if not p.name.endswith(".crc"))
    assert names and all(n.endswith(".warc.gz") and not n.startswith(".") for n in names)
    assert len(names) > 3 if roll == 200 else True
    assert warc.round_trip(nothing).count() == 0


def test_archive_records():
    record = warc.page_record(warc.Archive(), 7, "http://a/\r\nX: 1", b"body\r\n\r\nmore", None, False)
    fields, block = warc.parse_record(record)
    assert fields["WARC-Target-URI"] == "http://a/%0D%0AX: 1" and block.endswith(b"\r\n\r\nbody\r\n\r\nmore")
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"more", b"less"))


def test_least_bytes(pages):
    kinds = {(r["page_id"], r["record_type"]) for r in warc.round_trip(pages, warc.Archive(least_bytes=5)).collect()}
    assert (4, "response") in kinds and (2, "revisit") in kinds


def test_url_parts_and_rules(pages, nothing):
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in judge(pages).collect())
    assert got == Counter(
        [
            (1, "a.example.org", "/en/12", "example.org/en/1", "block"), (2, "b.com", "/fr/x", "com/fr/", "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow"),
            (5, "b.com:80", "/de/", None, "allow"), (6, "casinowin.net", "/play", None, "block"), (6, "casinowin.net", "/play", None, "block"), (None, "x.net", "", None, "allow"),
            (8, "example.org", "/es/1\r\nInjected: 1", "example.org/es/", "block"),
        ]
    )
    assert judge(nothing).count() == 0


def plain_viterbi(name, counts, total, letter):
    best = {0: (0.0, [])}
    for end in range(1, len(name) + 1):
        options = []
        for start in range(end):
            word = name[start:end]
            n = counts.get(word) or (letter if len(word) == 1 else None)
            if n:
                options.append((best[start][0] + np.log(n) - np.log(total), [*best[start][1], word]))
        best[end] = max(options, key=lambda o: o[0])
    return best[len(name)][1]


def test_viterbi(spark):
    counts = {"free": 50, "bets": 20, "be": 100, "ts": 3, "online": 9, "on": 80, "line": 10}
    total = sum(counts.values())
    names = ["freebets", "onlinebets", "zfreez", "q"]
    frame = urls.segments(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(list(counts.items()), "word string, n long"), urls.Words())
    got = {r["name"]: r["words"] for r in frame.collect()}
    assert got == {n: plain_viterbi(n, counts, total, 1e-3) for n in names}
    assert got["freebets"] == ["free", "bets"]
    assert viterbi("", {}, 1, 1e-3) == []


def test_words_of_blocked_hosts_spread(spark):
    rows = [(k, f"http://casino-lucky.net/p{k}", "<p>lucky casino news</p>") for k in range(40)]
    rows += [(100 + k, f"http://daily-news.net/p{k}", "<p>daily news news</p>") for k in range(400)]
    rows += [(999, "http://luckylucky.net/", "<p>x</p>")]
    got = {r["page_id"]: r["verdict"] for r in judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {got[k] for k in range(40)} == {"block"} and {got[100 + k] for k in range(400)} == {"allow"} and got[999] == "block"


def plain_scores(pages, counts, words, unwanted):
    """Log odds of every (host, path), by the multinomial formula over token counts."""
    total, urls_of, tokens_of = sum(counts.values()), Counter(), {}
    for _, url, _ in pages:
        host, path = re.match(r"[a-z]+://([^/]*)(.*)", url).groups()
        urls_of[host, path] += 1
        names = [n for n in re.split("[^a-z]+", host.rpartition(".")[0]) + re.split("[^a-z]+", path) if n]
        tokens_of[host, path] = Counter(w for n in names for w in ([n] if n in unwanted else plain_viterbi(n, counts, total, words.letter)))
    bad = {u for u, t in tokens_of.items() if set(t) & set(unwanted)}
    met = {True: Counter(), False: Counter()}
    for u, found in tokens_of.items():
        for token, times in found.items():
            met[u in bad][token] += times * urls_of[u]
    n = {side: sum(c.values()) for side, c in met.items()}
    prior = np.log((sum(urls_of[u] for u in bad) + 1) / (sum(k for u, k in urls_of.items() if u not in bad) + 1))
    out = {}
    for u, found in tokens_of.items():
        out[u] = prior
        for token, times in found.items():
            usual = words.smooth * (met[True][token] + met[False][token]) / sum(n.values())
            out[u] += times * np.log((met[True][token] + usual) / (n[True] + words.smooth) * (n[False] + words.smooth) / (met[False][token] + usual))
    return out


def test_scores_against_a_plain_version(spark):
    rows = [(k, f"http://casinolucky.net/win/win{k % 3}", "<p>lucky win win</p>") for k in range(9)]
    rows += [(20 + k, f"http://dailynews.net/win/daily/daily/{k % 4}", "<p>daily news</p>") for k in range(30)]
    rows += [(60 + k, f"http://internationalization.net/guide/{'x' * 70}", "<p>internationalization guide</p>") for k in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    words = urls.Words()
    counts = urls.word_counts(pages, words, urls.UNWANTED)
    got_counts = {r["word"]: r["n"] for r in counts.collect()}
    assert got_counts["internationalization"] == 5 and got_counts["x" * 70] == 5 and got_counts["win"] == 9 * 2 + 9 * 2 + 30
    distinct = pages.select(urls.host_of(pages.url).alias("host"), urls.path_of(pages.url).alias("path")).groupBy("host", "path").count().withColumnRenamed("count", "n")
    got = {(r["host"], r["path"]): r["score"] for r in urls.scores(distinct, counts, words, urls.UNWANTED).collect()}
    want = plain_scores(rows, got_counts, words, urls.UNWANTED)
    assert got.keys() == want.keys() and all(abs(got[u] - want[u]) < 1e-9 for u in want)
    names = spark.createDataFrame([("internationalizationguide",)], "name string")
    assert urls.segments(names, counts, words).first()["words"] == ["internationalization", "guide"]


def test_known_examples_teach(spark):
    rows = [(k, f"http://{'badplace' if k % 2 else 'goodplace'}{k}.net/", "<p>badplace goodplace</p>") for k in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    known = pages.where("page_id < 8").selectExpr("url", "page_id % 2 = 1 as bad").union(spark.createDataFrame([(None, None)], "url string, bad boolean"))
    got = {r["page_id"]: r["verdict"] for r in judge(pages, examples=known).collect()}
    assert got == {k: "block" if k % 2 else "allow" for k in range(20)}


def test_leaf_blocks():
    page = """<!DOCTYPE html><title>no</title><!-- <p>no --><style>p{}</style><script>var t="</p>no";</script><ul class="Menu big"><li>a&amp;b<li>c</ul>
    <p>one <b>two<br>three &nbsp; 4 < 5<p title="a>b">six<div id=main><a href=x>seven</a> eight</div><svg><text>no</text></svg>&#x41;<!-- open"""
    blocks = leaf_blocks(page)
    assert [b[1] for b in blocks] == ["a&b", "c", "one two three 4 < 5", "six", "seven eight", "A"]
    assert blocks[0][0] == ("ul", ".menu", ".big", "li") and blocks[4][0] == ("div", ".main") and blocks[4][2] == 5
    assert leaf_blocks("") == leaf_blocks("<p><br></p>") == [] and leaf_blocks("<" * 1000)


def test_held_out_accuracy():
    words = ["alpha", "beta", "gamma", "delta", "news", "market", "river", "stone"]
    made = [(vectors(b, {}), y) for b, y in made_pages(words, 800, 1) if b]
    net = train(made, Training())
    held = [(vectors(b, {}), y) for b, y in made_pages(words[::-1], 300, 2) if b]
    found = label(net, [v for v, _ in held])
    right = sum(int((a == (y > 0)).sum()) for a, (_, y) in zip(found, held))
    assert right / sum(len(y) for _, y in held) > 0.98


def lines(net, page):
    blocks = leaf_blocks(page)
    return [b[1] for b, good in zip(blocks, label(net, [vectors(blocks, {})])[0]) if good]


def test_deep_and_wide_pages():
    words = ["alpha", "beta", "gamma", "delta", "news", "market", "river", "stone"]
    net = train([(vectors(b, {}), y) for b, y in made_pages(words, 800, 1) if b], Training())
    said = "alpha beta gamma delta news market river stone alpha beta gamma delta news."
    article = f"<article><h1>Market news river</h1><p>{said}</p><p>Let <math><mi>x</mi>=5</math> be <script>1</script>alpha beta river.</p></article>"
    want = ["Market news river", said, "Let x=5 be alpha beta river."]
    for depth in (0, 3, 10, 11, 12, 14, 20, 40, 1000):
        down, up = "<div>" * depth, "</div>" * depth
        comments = f'<section class="comments">{down}<p>User wrote alpha beta market stone.</p><p>Reply says delta news.</p>{up}</section>'
        assert lines(net, f"<body><nav>{down}<a href=/>alpha beta</a>{up}</nav>{article}{comments}</body>") == want
    assert lines(net, f'<body>{article}<div class="a b c d e f g h comments"><p>User wrote alpha beta.</p></div></body>') == want


def test_long_pages():
    net = new_network(12, 5)
    for n in (1, 5, 6, 7, 50):
        blocks = leaf_blocks("".join(f"<p>word {k}</p><li>{k}.</li>" for k in range(n)))
        assert (label_long(net, blocks, {}, 6) == label(net, [vectors(blocks, {})])[0]).all()
    deep = leaf_blocks("".join(f'<div class="n{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}">x' for k in range(30_000)))
    assert len(deep) == 30_000 and max(len(b[0]) for b in deep) <= 384


def test_executors_without_the_package(tmp_path):
    job = tmp_path / "job.py"
    job.write_text(
        f"""import sys
sys.path.insert(0, {str(__file__).rsplit("/tests/", 1)[0]!r})
from pyspark.sql import SparkSession
from chainloom.llm.blocks import extract, new_network
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
pages = spark.createDataFrame([(1, "u", "<p>one</p>"), (2, "u", None)], "page_id long, url string, html string")
assert extract(pages, new_network(4, 1)).count() == 2 and len(extract(pages, new_network(4, 1)).collect()) == 2
"""
    )
    done = subprocess.run([sys.executable, str(job)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_extraction(spark, pages, nothing):
    real = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    net = fit(real)
    for row in extract(real, net).join(real.select("page_id", "html"), "page_id").collect():
        article = row["html"].partition("<article>")[2].partition("</article>")[0]
        want = [" ".join(html.unescape(x.replace("<b>", "").replace("<br>", " ")).split()) for x in article.replace("</h1>", "<p>").replace("<h1>", "<p>").replace("</p>", "<p>").split("<p>")]
        assert row["text"] == "\n".join(w for w in want if w) and row["n_chars"] == len(row["text"])
    rows = extract(pages, net).collect()
    assert Counter(r["page_id"] for r in rows) == Counter(p for p, _, _ in PAGES)
    assert all(r["text"] == "" for r in rows if r["page_id"] in (3, 4))
    assert extract(nothing, net).count() == 0
    assert [tuple(r) for r in extract(real, fit(real)).orderBy("page_id").limit(5).collect()] == [tuple(r) for r in extract(real, net).orderBy("page_id").limit(5).collect()]
