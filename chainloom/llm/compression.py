"""Quality rules: zstandard compression bands over whole texts and fixed chunks, after base rules.

The bands come from the documents themselves. Texts that pass the base rules are put into classes of length,
two for every doubling, and whole chunks into one of their own; a class's band reaches `fence` interquartile
ranges beyond its quartiles. Outer bands, which prose of any length keeps, hold besides, and alone for classes
with few texts.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from chainloom.llm.words import Words, mix, slices


@dataclass(frozen=True)
class Band:
    """Texts of up to `up_to` bytes keep a compressed size between low and high per byte."""

    up_to: float
    low: float
    high: float


@dataclass(frozen=True)
class Rules:
    """bands: the outer ones. Letters of prose carry up to 5 bits, those of encoded or random text 6 and more;
    short texts also pay for the code table, and texts far below the low limits repeat themselves.
    fitted: (class, low, high) of the documents, see `fitted_to`. fence: interquartile ranges from the quartiles
    to the limits, a range counting as least_spread at least. enough: texts that a class needs for its own limits.

    A text falls when it is outside the band of its length, or when more than `bad_chunks` of its chunks'
    bytes are outside theirs.
    """

    bands: tuple[Band, ...] = (
        Band(256, 0.35, 0.95),
        Band(512, 0.35, 0.80),
        Band(2_048, 0.30, 0.72),
        Band(8_192, 0.25, 0.66),
        Band(65_536, 0.20, 0.62),
        Band(float("inf"), 0.18, 0.60),
    )
    fitted: tuple[tuple[int, float, float], ...] = ()
    fence: float = 3.0
    least_spread: float = 0.02
    enough: int = 50
    chunk_bytes: int = 4_096
    bad_chunks: float = 0.5
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


COLUMNS = [
    ("n_words", "long"),
    ("word_chars", "long"),
    ("n_symbols", "long"),
    ("n_dup_lines", "long"),
    ("n_repeat_words", "long"),
    ("base_failed", "boolean"),
    ("ratio", "double"),
    ("bad_chunk_share", "double"),
    ("kept", "boolean"),
]
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
BLANKS = " \t\n\x0b\x0c\r"


WHOLE_CHUNK = -1


def length_class(n: int) -> int:
    """The whole part of 2 * log2(n)."""
    return (n * n).bit_length() - 1


def _band(rules: Rules, n: int, whole_chunk: bool = False) -> Band:
    outer, of = next(b for b in rules.bands if n <= b.up_to), WHOLE_CHUNK if whole_chunk else length_class(n)
    for which, low, high in rules.fitted:
        if which == of:
            return Band(n, max(low, outer.low), min(high, outer.high))
    return outer


def _chunks(text: bytes, rules: Rules) -> list[bytes]:
    """The chunks of a text of more than one."""
    n = rules.chunk_bytes
    return [text[at : at + n] for at in range(0, len(text), n)] if len(text) > n else []


def measure(text: bytes, rules: Rules, squeeze: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Compressed size per byte, share of bytes in chunks outside their band, and the verdict."""
    if not text:
        return 0.0, 0.0, False
    ratio = len(squeeze.compress(text)) / len(text)
    outside = 0
    for chunk in _chunks(text, rules):
        band = _band(rules, len(chunk), len(chunk) == rules.chunk_bytes)
        if not band.low <= len(squeeze.compress(chunk)) / len(chunk) <= band.high:
            outside += len(chunk)
    share, band = outside / len(text), _band(rules, len(text))
    return ratio, share, band.low <= ratio <= band.high and share <= rules.bad_chunks


def _repeated(words: Words) -> np.ndarray:
    """Flags of words that lie in a three-word window which its text has twice or more."""
    windows, fits = words.windows(words.hashes(), 3)
    at = np.flatnonzero(fits)
    keys = mix(windows[at] + mix(words.owner()[at].astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = at[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]] if len(at) else at
    out = np.zeros(len(windows) + 2, bool)
    for j in range(3):
        out[twice + j] = True
    return out[: len(windows)]


def _counts(texts: pa.Array, rules: Rules) -> list[np.ndarray]:
    """Words, their characters, symbols, words in repeats, and whether the base rules reject the text."""
    words = Words(texts)
    n = words.counts.astype(np.int64)
    chars = words.per_text(words.inside & ((words.data & 0xC0) != 0x80), words.bounds)
    symbols = words.per_text(SYMBOLS[words.data], words.bounds)
    repeats = words.per_text(_repeated(words), words.first)
    return [n, chars, symbols, repeats, (n < rules.min_words) | (100 * repeats > rules.max_repeat_percent * n)]


def _columns(texts: pa.Array, rules: Rules, squeeze: zstandard.ZstdCompressor) -> list[np.ndarray]:
    n, chars, symbols, repeats, failed = _counts(texts, rules)
    dup_lines, measured = np.zeros(len(n), np.int64), []
    for i, text in enumerate(texts.to_pylist()):
        lines = [x for x in (text or "").split("\n") if x.strip(BLANKS)]
        dup_lines[i] = len(lines) - len(set(lines))
        measured.append(measure((text or "").encode(), rules, squeeze))
    ratio, share, good = (np.array(x) for x in zip(*measured))
    return [n, chars, symbols, dup_lines, repeats, failed, ratio, share, good.astype(bool) & ~failed]


def fitted_to(docs: DataFrame, rules: Rules, text_col: str) -> Rules:
    """The rules with limits from all documents that pass the base rules, by one aggregation of ratios in
    thousandths. Equal texts and equal chunks count once. The driver takes a row for each class and thousandth."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                rows = []
                for text, failed in zip(texts.to_pylist(), _counts(texts, rules)[-1]):
                    if not text or failed:
                        continue
                    data = text.encode()
                    whole = [(WHOLE_CHUNK, c) for c in _chunks(data, rules) if len(c) == rules.chunk_bytes]
                    for of, part in [(length_class(len(data)), data), *whole]:
                        digest = int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "big", signed=True)
                        rows.append((of, round(1_000 * len(squeeze.compress(part)) / len(part)), digest))
                of, mille, digest = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of, pa.int32()), pa.array(mille, pa.int32()), pa.array(digest, pa.int64())], names=["of", "mille", "digest"]
                )

    parts = docs.select(text_col).mapInArrow(task, "of int, mille int, digest long").distinct()
    found = defaultdict(list)
    for row in parts.groupBy("of", "mille").count().collect():
        found[row["of"]].append((row["mille"], row["count"]))
    fitted = []
    for of, counts in sorted(found.items()):
        mille, n = np.array(sorted(counts)).T
        upto = np.cumsum(n)
        if upto[-1] >= rules.enough:
            low, high = (mille[np.searchsorted(upto, q * upto[-1])] / 1_000 for q in (0.25, 0.75))
            reach = rules.fence * max(high - low, rules.least_spread)
            fitted.append((of, float(low - reach), float(high + reach)))
    return replace(rules, fitted=tuple(fitted))


def score_quality(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, counts, compression figures and whether it is kept.

    The texts are read twice: for the limits, and to judge each by its own text and them. Null and empty texts
    have no words and fall; repeated rows are each judged; an empty table gives no rows; other columns are not read.
    """
    rules = fitted_to(docs, rules, text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                ids = batch.column(0).slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [ids, *map(pa.array, _columns(texts, rules, squeeze))], names=[id_col, *(c for c, _ in COLUMNS)]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} {t}" for c, t in COLUMNS)
    return docs.select(id_col, text_col).mapInArrow(task, schema)


def keep_good(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows of documents that are kept, with all their columns as they were. Null and empty texts fall."""
    rules = fitted_to(docs, rules, text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            where = batch.schema.get_field_index(text_col)
            for at, texts in slices(batch.column(where)):
                good = _columns(texts, rules, squeeze)[-1]
                yield batch.slice(at, len(texts)).filter(pa.array(good))

    return docs.mapInArrow(task, docs.schema)
