"""Least edits that give every conversation a right order of turns: a parallel Viterbi by rank convergence.

The roles of a repaired conversation read `(s?(ua)+)?`. Its states are START (nothing yet), SYSTEM, USER and
ASSISTANT, after the last role; START and ASSISTANT may end it. A cost vector holds, for a place between two rows,
the least cost of the rest from each state. Vectors are kept without their least value, so two that differ only by
a constant are equal; then few are possible, and a step over a row is a lookup.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import kept

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# The state that a role initial leads to from each state; None where it does not fit.
ROLE_STEPS = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
# The one role that may be put in from each state, by insertion or by a changed role.
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (USER, USER, ASSISTANT, USER)
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAR = 1 << 20

# The class of a row: its role initial, and whether it is truncated, must go, or went before (dropped).
INITIALS = "sua"
OTHER, FORCED, CUT = 3, 4, 8
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

Vector = tuple[int, int, int, int]


@dataclass(frozen=True)
class Turns:
    """chunk: rows of a conversation that are solved in one piece; longer ones are solved in parallel chunks."""

    chunk: int = 16_384


def _closed(costs: list[int]) -> list[int]:
    """The costs when turns may be inserted first."""
    user = min(costs[USER], INSERT + costs[ASSISTANT])
    assistant = min(costs[ASSISTANT], INSERT + costs[USER])
    return [min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant]


FINAL: Vector = tuple(_closed([0, FAR, FAR, 0]))


def _options(kind: int, after: Vector, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of what may be done with a row, without insertions."""
    out = [("D", DELETE + after[state], state)]
    if not kind & FORCED:
        cut = TRUNCATED if kind & CUT else 0
        to = ROLE_STEPS[INITIALS[kind & 3]][state] if kind & 3 < OTHER else None
        if to is not None:
            out.append(("K", cut + after[to], to))
        out.append(("R", RENAME + cut + after[NEXT_STATE[state]], NEXT_STATE[state]))
    return out


class Steps:
    """Steps over a row by its class, looked up once they are known."""

    def __init__(self):
        self.backward: dict[tuple[int, Vector], tuple[Vector, int]] = {}
        self.traced: dict[tuple[int, Vector, int], tuple[str, int]] = {}

    def back(self, kind: int, after: Vector) -> tuple[Vector, int]:
        """The vector before a row, and what was taken off it."""
        key = (kind, after)
        if key not in self.backward:
            costs = _closed([min(cost for _, cost, _ in _options(kind, after, state)) for state in range(STATES)])
            least = min(costs)
            self.backward[key] = tuple(c - least for c in costs), least
        return self.backward[key]

    def edits(self, kind: int, after: Vector, state: int) -> tuple[str, int]:
        """The first edits in ASCII order (D, I, K, R) of least cost for a row and what is inserted before it."""
        key = (kind, after, state)
        if key not in self.traced:
            plain = [min(cost for _, cost, _ in _options(kind, after, s)) for s in range(STATES)]
            goal, out, spent = _closed(plain)[state], "", 0
            while True:
                found = {edit: to for edit, cost, to in _options(kind, after, state) if spent + cost == goal}
                if "D" not in found and spent + INSERT + _closed(plain)[NEXT_STATE[state]] == goal:
                    out, spent, state = out + "I", spent + INSERT, NEXT_STATE[state]
                    continue
                edit = min(found)
                self.traced[key] = out + edit, found[edit]
                break
        return self.traced[key]

    def run_back(self, kinds: bytes, after: Vector) -> tuple[Vector, int]:
        """The vector before a chunk from that after it, and the cost that was taken off."""
        total = 0
        for kind in reversed(kinds):
            after, least = self.back(kind, after)
            total += least
        return after, total

    def trace(self, kinds: bytes, after: Vector, state: int) -> tuple[list[str], int]:
        """The edits at each row of a chunk from a state, and the state that they end in."""
        vectors = []
        for kind in reversed(kinds):
            vectors.append(after)
            after, _ = self.back(kind, after)
        out = []
        for kind, vector in zip(kinds, reversed(vectors)):
            edits, state = self.edits(kind, vector, state)
            out.append(edits)
        return out, state


def closing(state: int) -> str:
    """The insertions that end a conversation from a state."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults made by the CRC-32 of `conv_id:turn`; `gone` marks a row that
    was dropped. Nulls count as one space, but for the order of turns."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    case = F.crc32(F.encode(name, "UTF-8")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(case == 4, "user").otherwise(role).alias("role"),
        F.when(case == 1, "").when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (case == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(case == 3, 2).otherwise(1))).alias("__copy"),
    ).drop("__copy")


def _placed(rows: DataFrame) -> DataFrame:
    """The rows with a number for their text, by which rows of the same turn and role are in order."""
    return rows.withColumn("digest", F.unhex(F.md5(F.encode(F.col("text"), "UTF-8"))))


ORDER = ["conv_id", "turn", "role", "digest"]
SPACE = " \t\n\x0b\x0c\r"
CHUNKS = "part long, chunk long, kinds binary, turn long, role string, digest binary, low long, high long, n_turns long, blank long, duplicate long, truncated long, illegal long, initial string, final string"


def chunks(rows: DataFrame, rules: Turns = Turns()) -> DataFrame:
    """Conversations cut into chunks: the classes of their rows, a byte each, with counts of their faults.

    Equal rows are one row with a count before anything is shuffled by order, and the first row of every role and
    text is found by an aggregate; it comes as a mark that sorts in front of that row. Rows are range-sorted by
    conversation and turn, so a long conversation lies in many tasks.
    """
    text = F.rtrim(F.col("text"), F.lit(SPACE))
    narrow = _placed(rows).select(
        *ORDER,
        "gone",
        (text == "").alias("blank"),
        (~F.right(text, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    counted = narrow.groupBy(*ORDER, "gone", "blank", "truncated").agg(F.count(F.lit(1)).alias("n"))
    first = (
        counted.where("not gone and not blank")
        .groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("first"))
        .select("conv_id", F.col("first.turn").alias("turn"), "role", "digest", F.lit(0).cast("long").alias("n"))
    )
    both = counted.unionByName(first, allowMissingColumns=True)
    ordered = both.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER, "n", "gone")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        made, now, mark = [], None, None
        for batch in batches:
            for conv, turn, role, digest, gone, blank, truncated, n in zip(*(c.to_pylist() for c in batch.columns)):
                if not n:
                    mark = (conv, turn, role, digest)
                    continue
                if now is None or now.conv != conv:
                    if now is not None:
                        made.append(now.row(part))
                    now = _Chunk(conv, 0)
                if gone:
                    continue
                while n:
                    if len(now.kinds) >= rules.chunk:
                        made.append(now.row(part))
                        now = _Chunk(conv, now.number + 1)
                    taken = min(n, rules.chunk - len(now.kinds))
                    now.add(turn, role, digest, blank, truncated, taken, mark == (conv, turn, role, digest))
                    mark, n = None, n - taken
            if len(made) >= 1000:
                yield pa.RecordBatch.from_pylist(made, schema)
                made = []
        if now is not None:
            made.append(now.row(part))
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)

    kind = rows.schema["conv_id"].dataType
    schema = _arrow(f"conv_id {kind.simpleString()}, {CHUNKS}")
    return ordered.select(*ORDER, "gone", "blank", "truncated", "n").mapInArrow(task, f"conv_id {kind.simpleString()}, {CHUNKS}")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in ddl.split(", "))])


class _Chunk:
    """A chunk in the making."""

    def __init__(self, conv, number: int):
        self.conv, self.number, self.kinds = conv, number, bytearray()
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.key = (None, None, None)
        self.low = self.high = None
        self.initial = self.final = None

    def add(self, turn, role: str, digest: bytes, blank: bool, truncated: bool, n: int, first: bool) -> None:
        if not self.kinds:
            self.key, self.initial = (turn, role, digest), role[:1]
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        again = (n - first) * (not blank)
        self.blank += n * blank
        self.duplicate += again
        self.truncated += first and truncated
        initial = role[:1]
        if self.final is not None:
            self.illegal += (self.final, initial) not in LEGAL
        self.illegal += (n - 1) * ((initial, initial) not in LEGAL)
        self.final = initial
        code = INITIALS.index(initial) if initial and initial in INITIALS else OTHER
        if first:
            self.kinds.append(code | CUT * truncated)
        self.kinds += bytes([code | FORCED]) * (n - first)

    def row(self, part: int) -> dict:
        turn, role, digest = self.key
        return {
            "conv_id": self.conv, "part": part, "chunk": self.number, "kinds": bytes(self.kinds), "turn": turn, "role": role, "digest": digest,
            "low": self.low, "high": self.high, "n_turns": self.turns,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
            "initial": self.initial, "final": self.final,
        }


def _text(vector: Vector) -> str:
    return ",".join(map(str, vector))


def _vector(text: str) -> Vector:
    return tuple(map(int, text.split(",")))


PLACE = ["conv_id", "part", "chunk"]


def _run(frame: DataFrame) -> DataFrame:
    """Run chunks (conv_id, part, chunk, kinds) backward from each vector of `todo`."""
    kind = frame.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, part long, chunk long, end string, start string, spent long"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, schema = Steps(), _arrow(ddl)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                for end in row["todo"]:
                    start, spent = steps.run_back(row["kinds"], _vector(end))
                    out.append({c: row[c] for c in PLACE} | {"end": end, "start": _text(start), "spent": spent})
            yield pa.RecordBatch.from_pylist(out, schema)

    return frame.select(*PLACE, "kinds", "todo").mapInArrow(task, ddl)


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by keys of which a null equals a null."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def _walk_back(pdf: pd.DataFrame) -> list[tuple[tuple[int, int], str | None]]:
    """The chunks of a conversation from its last, each with the vector after it: None where it is not known yet."""
    runs: dict[tuple[int, int], dict[str, str]] = {}
    for part, chunk, end, start in zip(pdf["part"], pdf["chunk"], pdf["end"], pdf["start"]):
        runs.setdefault((part, chunk), {})[end] = start
    after, out = _text(FINAL), []
    for place in sorted(runs, reverse=True):
        out.append((place, after))
        after = after and runs[place].get(after)
    return out


def stitched(several: DataFrame) -> DataFrame:
    """(conv_id, part, chunk, end): the vector after each chunk, for conversations of several chunks.

    All chunks start from the vector of a conversation's end, which is right for the last one and a guess for the
    others. A chunk's vector is right once the chunk was run from a vector equal, but for a constant, to that of the
    chunk behind it. In each pass the chunks of conversations that are not yet stitched run from all vectors that
    their conversation has shown and they have not met. There are few vectors, so the passes are few, also where
    a long stretch of rows lets no vector converge.
    """
    runs = kept(_run(several.withColumn("todo", F.array(F.lit(_text(FINAL))))), "turn-runs")
    kind = several.schema["conv_id"].dataType.simpleString()

    def missing(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        if any(end is None for _, end in _walk_back(pdf)):
            shown = set(pdf["start"])
            for (part, chunk), own in pdf.groupby(["part", "chunk"]):
                todo = sorted(shown.difference(own["end"]))
                if todo:
                    out.append({"conv_id": pdf["conv_id"].iloc[0], "part": part, "chunk": chunk, "todo": todo})
        return pd.DataFrame(out, columns=[*PLACE, "todo"])

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [{"conv_id": pdf["conv_id"].iloc[0], "part": p, "chunk": c, "end": end} for (p, c), end in _walk_back(pdf)]
        return pd.DataFrame(rows, columns=[*PLACE, "end"])

    while True:
        todo = kept(runs.groupBy("conv_id").applyInPandas(missing, f"conv_id {kind}, part long, chunk long, todo array<string>"), "turn-todo")
        if todo.isEmpty():
            return runs.groupBy("conv_id").applyInPandas(ends, f"conv_id {kind}, part long, chunk long, end string")
        runs = kept(runs.unionByName(_run(_same(several, todo, PLACE))), "turn-runs")


def _entries(several: DataFrame, ends: DataFrame) -> DataFrame:
    """(conv_id, part, chunk, end, entry, last): with the state that the cheapest edits enter each chunk in."""
    known = _same(several.select(*PLACE, "kinds"), ends, PLACE)
    kind = several.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, part long, chunk long, end string, exits string"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, schema = Steps(), _arrow(ddl)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                exits = [steps.trace(row["kinds"], _vector(row["end"]), state)[1] for state in range(STATES)]
                out.append({c: row[c] for c in (*PLACE, "end")} | {"exits": "".join(map(str, exits))})
            yield pa.RecordBatch.from_pylist(out, schema)

    def enter(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, state, entries = pdf.sort_values(["part", "chunk"]), START, []
        for exits in pdf["exits"]:
            entries.append(state)
            state = int(exits[state])
        pdf["entry"], pdf["last"] = entries, [False] * (len(pdf) - 1) + [True]
        return pdf[[*PLACE, "end", "entry", "last"]]

    return known.mapInArrow(task, ddl).groupBy("conv_id").applyInPandas(enter, f"conv_id {kind}, part long, chunk long, end string, entry long, last boolean")


SOLVED = "part long, chunk long, turn long, role string, digest binary, low long, high long, n_turns long, blank long, duplicate long, truncated long, illegal long, initial string, final string, cost long, edits string, tail string"


def solved(made: DataFrame) -> DataFrame:
    """The chunks with the cost of their edits, the edits of each row joined by a comma, and the insertions that
    end the conversation."""
    whole = {"end": F.lit(_text(FINAL)), "entry": F.lit(START).cast("long"), "last": F.lit(True)}
    long = made.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv_id")
    several = kept(_same(made, long, ["conv_id"], "left_semi").select(*PLACE, "kinds"), "turn-chunks")
    if several.isEmpty():
        entered = made.withColumns(whole)
    else:
        entries = kept(_entries(several, stitched(several)), "turn-entries")
        entered = _same(made, long, ["conv_id"], "left_anti").withColumns(whole).unionByName(_same(made, entries, PLACE))
    ddl = f"conv_id {made.schema['conv_id'].dataType.simpleString()}, {SOLVED}"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, schema = Steps(), _arrow(ddl)
        price = {"K": 0, "R": RENAME, "D": DELETE, "I": INSERT}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                edits, state = steps.trace(row["kinds"], _vector(row["end"]), row["entry"])
                tail = closing(state) if row["last"] else ""
                cost = sum(price[e] for e in "".join([*edits, tail]))
                cost += TRUNCATED * sum(kind & CUT > 0 and not e.endswith("D") for kind, e in zip(row["kinds"], edits))
                out.append({c: row.get(c) for c in schema.names} | {"cost": cost, "edits": ",".join(edits), "tail": tail})
            yield pa.RecordBatch.from_pylist(out, schema)

    return entered.mapInArrow(task, ddl)


FACTS = ["low", "high", "n_turns", "blank", "duplicate", "truncated", "illegal", "initial", "final", "cost", "edits", "tail"]


class _Replay:
    """One conversation whose chunks and rows come in order."""

    def __init__(self, conv):
        self.conv, self.low, self.high, self.final = conv, None, None, None
        self.sums = dict.fromkeys(("n_turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.audit: list[str] = []
        self.waiting: deque[str] = deque()
        self.tail, self.state = "", START

    def chunk(self, facts: dict) -> None:
        for name in self.sums:
            self.sums[name] += facts[name]
        if facts["low"] is not None:
            self.sums["n_turns"] -= facts["low"] == self.high
            self.low = facts["low"] if self.low is None else self.low
            self.high = facts["high"]
        if facts["initial"] is not None:
            self.sums["illegal"] += self.final is not None and (self.final, facts["initial"]) not in LEGAL
            self.final = facts["final"]
        if facts["edits"]:
            self.waiting.extend(facts["edits"].split(","))
            self.audit.append(facts["edits"].replace(",", ""))
        self.tail = facts["tail"]

    def lines(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The repaired turns (edit, role, text) that come from a row, what is inserted before it first."""
        for edit in self.waiting.popleft():
            yield from self.line(edit, role, text)

    def line(self, edit: str, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        if edit == "D":
            return
        state = self.state
        if edit == "K":
            self.state = ROLE_STEPS[role[:1]][state]
            yield edit, role, text
        else:
            self.state = NEXT_STATE[state]
            yield edit, NEXT_ROLE[state], "" if edit == "I" else text

    def end(self) -> Iterator[tuple[str, str, str]]:
        for edit in self.tail:
            yield from self.line(edit, "", "")


def _replayed(rows: DataFrame, chunks_solved: DataFrame) -> DataFrame:
    """Rows and the solved chunks they are in, by conversation and in order, a chunk before its first row."""
    marks = chunks_solved.withColumns({"mark": F.lit(0), "text": F.lit(None).cast("string")})
    own = _placed(rows.where("not gone")).drop("gone").withColumn("mark", F.lit(1))
    both = marks.unionByName(own, allowMissingColumns=True)
    order = ["conv_id", "turn", "role", "digest", "mark", "part", "chunk"]
    ordered = both.repartition("conv_id").sortWithinPartitions(*order)
    return ordered.select("conv_id", "role", "text", "mark", *FACTS)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Replay, tuple[str, str, str] | None]]:
    """(conversation, repaired turn), and (conversation, None) at its end."""
    now = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for conv, role, text, mark, *facts in zip(*columns):
            if now is None or conv != now.conv:
                if now is not None:
                    yield from ((now, line) for line in now.end())
                    yield now, None
                now = _Replay(conv)
            if mark:
                yield from ((now, line) for line in now.lines(role, text))
            else:
                now.chunk(dict(zip(FACTS, facts)))
    if now is not None:
        yield from ((now, line) for line in now.end())
        yield now, None


def repaired_turns(rows: DataFrame, rules: Turns = Turns()) -> DataFrame:
    """(conv_id, place, edit, role, text) of every turn of the repaired conversations.

    `rows` are (conv_id, turn, role, text, gone) without nulls in role and text, as `damaged` gives them.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, place long, edit string, role string, text string"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, size, place = _arrow(ddl), [], 0, 0
        for now, line in _conversations(batches):
            if line is None:
                place = 0
                continue
            out.append({"conv_id": now.conv, "place": place, "edit": line[0], "role": line[1], "text": line[2]})
            place, size = place + 1, size + len(line[2])
            if len(out) == 10_000 or size > 1 << 23:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return _replayed(rows, solved(kept(chunks(rows, rules), "turns"))).mapInArrow(task, ddl)


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repairs(rows: DataFrame, rules: Turns = Turns()) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    `rows` are (conv_id, turn, role, text, gone) without nulls in role and text, as `damaged` gives them. Rows are
    in order by turn, null turns first; rows of one turn by role and then the MD5 of their text. A row whose role
    and text came before is a duplicate, so equal rows are one row and its duplicates. A null conv_id is a
    conversation like others. A conversation without rows has zeros, an empty audit and the digest of an empty
    text; an empty table gives no rows, and other columns are not read. Long conversations are solved in chunks on
    many tasks; only the digest, which is a sequence by nature, reads one conversation in one task, row by row, so
    memory is bounded by the longest text and the audit.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, {RESULT}"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, digest, begun = _arrow(ddl), [], hashlib.sha256(), False
        for now, line in _conversations(batches):
            if line is not None:
                digest.update((("\n" if begun else "") + f"{line[1]}:{line[2]}").encode())
                begun = True
                continue
            gaps = 0 if now.low is None else now.high - now.low + 1 - now.sums["n_turns"]
            counts = {c: now.sums[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")}
            out.append({"conv_id": now.conv, "gaps": gaps, **counts, "audit": "".join([*now.audit, now.tail]), "repaired_sha256": digest.hexdigest()})
            digest, begun = hashlib.sha256(), False
            if len(out) == 10_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return _replayed(rows, solved(kept(chunks(rows, rules), "turns"))).mapInArrow(task, ddl)
