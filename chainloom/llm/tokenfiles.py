"""Token ids of texts as length-delimited binary records with masked checksums, and an offset index for shuffled reads.

A data file is HEADER and the width of an id in bytes, then the records. A record is the length of its body (8
bytes), the masked CRC-32 of those bytes (4), the body, and the masked CRC-32 of the body (4). A body is one byte
that tells whether there is a document id, the id (8 bytes), and the token ids, which take 2 bytes where the
vocabulary has at most 65,536 ids and 4 elsewhere. All numbers are little-endian. The index of a data file is the
offset of every record (8 bytes each) and their masked CRC-32.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainloom.llm.shared import kept, run_folder
from chainloom.llm.words import slices

HEADER = b"TOKENS1"
FILES = "part long, file string, n_records long, n_tokens long, n_bytes long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
LARGEST_VOCABULARY = 64 << 20
BUFFER = 1 << 20
# The constant of a masked checksum (fixed value).
MASK = 0xA282EAD8


@dataclass(frozen=True)
class Tokens:
    """path: a tokenizer file of the tokenizers library. end_id: what ends every document. memo: so many words are
    remembered by a task; it starts anew beyond that. free_words: a word's ids do not depend on its neighbours, so
    texts may be cut at ASCII white space (True for tokenizers that drop white space and split words at it)."""

    path: str
    end_id: int = 1
    memo: int = 400_000
    free_words: bool = True
    prefix: str = "tokens"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    length = struct.pack("<Q", len(body))
    return b"".join([length, struct.pack("<I", masked(length)), body, struct.pack("<I", masked(body))])


def unframe(data: bytes) -> bytes:
    """The body of one whole record; an error if a checksum or the length differs."""
    length = struct.unpack_from("<Q", data)[0]
    if struct.unpack_from("<I", data, 8)[0] != masked(data[:8]) or len(data) != length + 16:
        raise ValueError("the length of a record is damaged")
    body = data[12:-4]
    if struct.unpack("<I", data[-4:])[0] != masked(body):
        raise ValueError("the body of a record is damaged")
    return body


def pack(doc_id: int | None, ids: bytes) -> bytes:
    return struct.pack("<?q", doc_id is not None, doc_id or 0) + ids


def unpack(body: bytes, width: int) -> tuple[int | None, np.ndarray]:
    known, doc_id = struct.unpack_from("<?q", body)
    return doc_id if known else None, np.frombuffer(body, f"<u{width}", offset=9)


def piece_pattern(vocabulary: str):
    """The pattern by which a tokenizer cuts words into pieces, if it does nothing else with plain words than to
    lower their case and to show their bytes as letters; else None."""
    import regex

    made = json.loads(vocabulary)
    normal = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
    cuts = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
    model = made["model"]
    plain = normal == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
    plain = plain and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and not cuts[1]["use_regex"] and not cuts[1]["add_prefix_space"]
    plain = plain and model["type"] == "BPE" and not model.get("dropout") and not made["post_processor"]
    return regex.compile(cuts[0]["pattern"]["Regex"]) if plain else None


class _Memo(dict):
    """What `learn` gives for a key, remembered; it starts anew beyond `most` keys."""

    def __init__(self, learn: Callable, most: int):
        self.learn, self.most = learn, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        found = self[key] = self.learn(key)
        return found


class Encoder:
    """From texts to their packed ids; `width` is the bytes of an id.

    Each distinct word of a text is encoded once, by the library: a word of ASCII and Latin-1 letters and marks piece
    by piece by its model, any other by the whole tokenizer. A long text is cut at white space, so no text is
    encoded in one piece. `many` cuts the plain texts of a slice by Arrow and looks up each distinct piece of the slice
    once.
    """

    def __init__(self, vocabulary: str, tokens: Tokens):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses every core
        from tokenizers import Tokenizer, pre_tokenizers

        self.made = Tokenizer.from_str(vocabulary)
        self.model, self.tokens = self.made.model, tokens
        self.bytes_as_letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.width = 2 if max(self.made.get_vocab_size(), tokens.end_id + 1) <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.end = self._pack([tokens.end_id])
        self.pattern = piece_pattern(vocabulary) if tokens.free_words else None
        self.pieces, self.plain, self.words = (_Memo(f, tokens.memo) for f in (self._piece, self._plain, self._word))
        self.by_arrow = self.pattern is not None and _cuts_alike(self.pattern)

    def _pack(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else self.bytes_as_letters.pre_tokenize_str(piece)[0][0]
        return self._pack([t.id for t in self.model.tokenize(shown)])

    def _plain(self, word: str) -> bytes:
        """The ids of a plain word in small letters."""
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(word)))

    def _word(self, word: bytes) -> bytes:
        return self._pack(self.made.encode(word.decode(), add_special_tokens=False).ids)

    def __call__(self, text: str) -> bytes:
        if not self.tokens.free_words:
            return self._pack(self.made.encode(text, add_special_tokens=False).ids) + self.end
        # A special token is known by its exact letters and is not to be cut.
        if self.pattern is not None and PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.plain.__getitem__, text.lower().split())) + self.end
        return b"".join(map(self.words.__getitem__, text.encode().split())) + self.end


    def many(self, texts: list[str]) -> list[bytes]:
        """What a call gives for each text."""
        parts, owners, out = [], [], [None] * len(texts)
        for k, text in enumerate(texts):
            if self.by_arrow and PLAIN.fullmatch(text) and "<|" not in text:
                cut = stretches(text)
                parts += cut
                owners += [k] * len(cut)
                out[k] = []
            else:
                out[k] = self(text)
        at = 0
        while at < len(parts):
            to, size = at, 0
            while to < len(parts) and (to == at or size + len(parts[to]) <= STRETCH):
                size += len(parts[to])
                to += 1
            for k, ids in zip(owners[at:to], self._plain_ids(parts[at:to])):
                out[k].append(ids)
            at = to
        return [b"".join(ids) + self.end if isinstance(ids, list) else ids for ids in out]

    def _plain_ids(self, texts: list[str]) -> Iterator[bytes]:
        words = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
        known = words.flatten().dictionary_encode()
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(known.dictionary, self.pattern.pattern, r"\0 "))
        pieces = cut.flatten().dictionary_encode()
        ids = [self.pieces[p] if p else b"" for p in pieces.dictionary.to_pylist()]
        data = np.frombuffer(b"".join(ids), f"<u{self.width}")
        ends = np.cumsum([len(i) // self.width for i in ids], dtype=np.int64)
        data, ends = _gathered(data, ends, pieces.indices.to_numpy())
        ends = np.append(0, ends)[cut.offsets.to_numpy()[1:]]  # of words
        data, ends = _gathered(data, ends, known.indices.to_numpy())
        bounds = (np.append(0, ends)[words.offsets.to_numpy()] * self.width).tolist()
        packed = data.tobytes()
        return (packed[a:b] for a, b in zip(bounds, bounds[1:]))


def _gathered(data: np.ndarray, ends: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the picked ones of the stretches of data, their ends)."""
    starts = np.append(0, ends[:-1])[: len(ends)]
    sizes = (ends - starts)[picked]
    done = np.cumsum(sizes)
    return data[np.repeat(starts[picked] - (done - sizes), sizes) + np.arange(done[-1] if len(done) else 0)], done


def _cuts_alike(pattern) -> bool:
    """Whether Arrow can use the pattern and it leaves out no part of a plain word."""
    try:
        pc.replace_substring_regex(pa.array(["a"]), pattern.pattern, r"\0 ")
    except pa.ArrowInvalid:
        return False
    return all(pattern.fullmatch(chr(c)) for c in (*range(0x21, 0x7F), *range(0xC0, 0x100)))


# Characters of plain texts that are in arrays at a time.
STRETCH = 2 << 20
SPACE = re.compile("[\t-\r ]")


def stretches(text: str, size: int = STRETCH) -> list[str]:
    """The text, cut at white space behind every `size` characters."""
    out, at = [], 0
    while len(text) - at > size and (space := SPACE.search(text, at + size)):
        out.append(text[at : space.start()])
        at = space.end()
    return [*out, text[at:]]


_ENCODERS: dict[tuple[str, Tokens], Encoder] = {}


def encoder_of(vocabulary: str, tokens: Tokens) -> Encoder:
    """The encoder of a worker, which keeps it, with all it remembers, for its later tasks; one at a time."""
    if (vocabulary, tokens) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary, tokens] = Encoder(vocabulary, tokens)
    return _ENCODERS[vocabulary, tokens]


# Words of these are the same in NFC, and their small letters do not depend on their neighbours.
PLAIN = re.compile("[\t-\r -~\u00c0-\u00ff]*")


class _File:
    """A data file and its index under temporary names; both get their real names when the file is whole."""

    def __init__(self, folder: str, name: str, width: int):
        self.files, path = fs.FileSystem.from_uri(folder)
        self.names = [f"{path}/{name}.records", f"{path}/{name}.index"]
        self.temporary = [f"{path}/.{name}.{uuid.uuid4().hex}.{kind}" for kind in ("records", "index")]
        self.stream = self.files.open_output_stream(self.temporary[0], compression=None)
        self.stream.write(HEADER + bytes([width]))
        self.offsets, self.at, self.n_tokens, self.width = [], len(HEADER) + 1, 0, width

    def add(self, doc_id: int | None, ids: bytes) -> None:
        record = frame(pack(doc_id, ids))
        self.stream.write(record)
        self.offsets.append(self.at)
        self.at += len(record)
        self.n_tokens += len(ids) // self.width

    def close(self) -> None:
        self.stream.close()
        offsets = np.array(self.offsets, "<u8").tobytes()
        with self.files.open_output_stream(self.temporary[1], compression=None) as index:
            index.write(offsets + struct.pack("<I", masked(offsets)))
        for temporary, name in zip(self.temporary, self.names):
            self.files.move(temporary, name)


def write_tokens(docs: DataFrame, folder: str, tokens: Tokens) -> DataFrame:
    """Write the ids of every text (doc_id, text) in ascending doc_id order and return the list of files.

    Texts are range-sorted by id before they are encoded, so a text is shuffled once and its ids never; rows of one
    id are spread by their text and place. A task that is done again writes the same names, and readers open only
    what the committed list names. The vocabulary is read by the driver and goes to the tasks as a text of at most
    64 MB, so executors need no file of their own.
    """
    spark = docs.sparkSession
    if Path(tokens.path).stat().st_size > LARGEST_VOCABULARY:
        raise ValueError("the vocabulary file is too large to send to every task")
    vocabulary = spark.sparkContext.broadcast(Path(tokens.path).read_text(encoding="utf-8"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = rows.withColumn("__text", F.xxhash64("text")).withColumn("__place", F.monotonically_increasing_id())
    order = ["doc_id", "__text", "__place"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out = TaskContext.get().partitionId(), None
        encode = encoder_of(vocabulary.value, tokens)
        for batch in batches:
            ids, texts = batch.columns
            for at, some in slices(texts):
                if out is None:
                    out = _File(folder, f"{tokens.prefix}-{part:06d}", encode.width)
                for k, packed in enumerate(encode.many(some.to_pylist())):
                    out.add(ids[at + k].as_py(), packed)
        if out is not None:
            out.close()
            row = [part, f"{tokens.prefix}-{part:06d}", len(out.offsets), out.n_tokens, out.at]
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "file", "n_records", "n_tokens", "n_bytes"), row))])

    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    return kept(ordered.mapInArrow(task, FILES), "token-files")


def read_index(files: fs.FileSystem, name: str) -> np.ndarray:
    with files.open_input_stream(f"{name}.index", compression=None) as stream:
        data = stream.read()
    if struct.unpack("<I", data[-4:])[0] != masked(data[:-4]):
        raise ValueError(f"{name}: the index is damaged")
    return np.frombuffer(data[:-4], "<u8")


def read_width(head: bytes) -> int:
    if head[:-1] != HEADER:
        raise ValueError("not a file of token records")
    return head[-1]


def read_tokens(spark: SparkSession, listed: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, in tasks by file; every checksum is compared.

    start counts the ids of all records before it: those of earlier files, by a running sum over the list (a row
    for each file), and those before it in its own. One record is in memory at a time.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = listed.select("file", "n_records", "n_bytes", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name, start, found = f"{path}/{row['file']}", row["start"], []
                offsets = read_index(files, name)
                if len(offsets) != row["n_records"]:
                    raise ValueError(f"{name}: the index does not have all records")
                ends = np.append(offsets[1:], np.uint64(row["n_bytes"])).tolist()
                with files.open_input_stream(f"{name}.records", compression=None, buffer_size=BUFFER) as stream:
                    width = read_width(stream.read(len(HEADER) + 1))
                    for at, end in zip(offsets.tolist(), ends):
                        doc_id, ids = unpack(unframe(stream.read(end - at)), width)
                        found.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(found) == 10_000:
                            yield _rows(found)
                            found = []
                if found:
                    yield _rows(found)

    return placed.repartition(max(1, listed.count()), "file").mapInArrow(task, ROWS)


def _rows(found: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=names)


def read_shuffled(spark: SparkSession, listed: DataFrame, folder: str, seed: int = 0) -> DataFrame:
    """(doc_id, ids) of every record in an order drawn by the seed, for training.

    Only the offsets are shuffled: the index gives a row for each record, those are range-sorted by a hash, and
    each task seeks to its records.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                offsets = read_index(files, f"{path}/{row['file']}").astype(np.int64)
                ends = np.append(offsets[1:], row["n_bytes"])
                columns = [pa.array([row["file"]] * len(offsets)), pa.array(offsets), pa.array(ends, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "at", "end"])

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        opened: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] not in opened:
                    if len(opened) == 64:
                        opened.pop(next(iter(opened)))[0].close()
                    stream = files.open_input_file(f"{path}/{row['file']}.records")
                    opened[row["file"]] = stream, read_width(stream.read(len(HEADER) + 1))
                stream, width = opened[row["file"]]
                stream.seek(row["at"])
                doc_id, ids = unpack(unframe(stream.read(row["end"] - row["at"])), width)
                columns = [pa.array([doc_id], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids"])

    order = ["__drawn", "file", "at"]
    index = listed.select("file", "n_bytes").mapInArrow(places, "file string, at long, end long")
    drawn = index.withColumn("__drawn", F.xxhash64(F.lit(seed), "file", "at"))
    return drawn.repartitionByRange(*order).sortWithinPartitions(*order).select("file", "at", "end").mapInArrow(seek, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, tokens: Tokens, folder: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from files written here.

    A null or empty text has the end id alone. A null doc_id comes before all others; rows of one doc_id each have
    their record, by a hash of their text, and equal rows in the order of the table. A text of any length is
    encoded word by word. An empty table gives no file and no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "tokens")
    return read_tokens(spark, write_tokens(docs, folder, tokens), folder)
