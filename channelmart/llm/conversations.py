"""Repair of conversations: the cheapest edits after which the roles read `(s?(ua)+)?`.

A conversation's rows are taken by turn (nulls first; rows of one turn by role, then text, bytewise). A row's first fault
counts: blank (nothing but white space), duplicate (role and text seen earlier in the conversation), truncated (its last
character that is no white space is none of `.!?`). Edits: Keep costs 0, Rerole to user or assistant 1, Delete 2 (the only one
for blank and duplicate rows), Insert a user or assistant message without text 5; a truncated row that stays adds 5. Of the
cheapest edits those with the ASCII-least initials are taken.

Method: secondary-sorted streaming with dynamic programming over the four states that the roles read so far can be in.

1. One exchange by ranges of (conversation, turn, role, text's beginning), sorted within. For each role and text of a conversation a
   narrow row with its first turn, found by a grouped minimum, travels with them and says which row is the first.
2. Each range is streamed. The rows of a conversation become one byte each (role, fault); the cost of what follows is carried
   backwards over these bytes as a vector of four numbers, and each byte leaves a backpointer of one byte, two bits for each state.
   A conversation that lies within a range and within PIECE_ROWS and PIECE_BYTES is finished there.
3. What is longer, or lies at a range's border, leaves the task as pieces, rows of a written table, instead of growing in memory: the
   bytes, the texts, and the 4 x 4 matrix of costs from each state before the piece to each behind it. Folding matrices from the
   end gives the vector behind each piece, from which each piece finds its backpointers; folding the states from the front gives the
   state before it, from which it finds its edits. Only matrices and states of a conversation meet in one task.

So a conversation with a third of all rows is many ranges and many pieces. Only the hash of its whole text, if asked for
(summary()), reads its repaired pieces one after the other, as SHA-256 must.

Cases: a null role or text is one space; a null turn counts for no gap; a null id is a conversation like others; a role is known by its
first letter, and a kept row keeps its role as written; repeated rows are duplicates; a conversation of which rows are only named
(`present` false) has no messages; other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import configure, stored

WHITE = " \t\n\x0b\x0c\r"
PREFIX = 16                     # characters of a text that ranges tell apart
PIECE_ROWS, PIECE_BYTES = 4096, 1 << 20

# States: nothing yet, a system message, a user message, an assistant message. Codes of a row: the class of its role, and its fault.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
MUST_GO, CUT = 4, 8
KEEP = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))    # by state and class
NEXT = (2, 2, 3, 2)             # where an inserted or changed message leads; its role follows
ROLE = (None, None, "user", "assistant")
LETTERS = "DIKR"
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
END = (0.0, 10.0, 5.0, 0.0)     # what is still to be inserted
NEVER = float("inf")
_steps: dict[tuple, tuple] = {}


def _normal(costs) -> tuple[tuple, float]:
    low = min(costs)
    return tuple(c - low for c in costs), low


def _step(after: tuple, code: int) -> tuple:
    """Costs before a row, less their least; that; the letters to take in each state."""
    stay = 5.0 if code & CUT else 0.0
    choices = []
    for state in range(4):
        kept = KEEP[state][code & 3]
        choices.append({"D": 2 + after[state]} if code & MUST_GO else
                       {"D": 2 + after[state], "K": stay + after[kept] if kept is not None else NEVER, "R": 1 + stay + after[NEXT[state]]})
    costs = [min(c.values()) for c in choices]
    for _ in range(2):
        costs = [min(*choices[s].values(), 5 + costs[NEXT[s]], NEVER) for s in range(4)]
    taken = 0
    for state in range(4):
        choices[state]["I"] = 5 + costs[NEXT[state]]
        taken |= LETTERS.index(min(k for k, v in choices[state].items() if v == costs[state])) << 2 * state
    return (*_normal(costs), taken)


def backward(codes: bytes, behind) -> tuple[bytearray, list[float]]:
    """The letters to take at each row, and the costs before the first one, given those behind the last one."""
    costs, total = _normal(behind)
    taken = bytearray(len(codes))
    for k in range(len(codes) - 1, -1, -1):
        key = costs, codes[k]
        if key not in _steps:
            _steps[key] = _step(*key)
        costs, more, taken[k] = _steps[key]
        total += more
    return taken, [c + total for c in costs]


def forward(codes: bytes, taken: bytes, state: int, roles=None, texts=None) -> tuple[str, list[tuple[str, str]], int]:
    """Edits, messages (where roles and texts are given) and the state at the end."""
    edits, messages = [], []
    for k, (code, letters) in enumerate(zip(codes, taken)):
        while (letter := letters >> 2 * state & 3) == 1:
            edits.append("I")
            state = NEXT[state]
            messages.append((ROLE[state], ""))
        edits.append(LETTERS[letter])
        if letter == 2:
            state = KEEP[state][code & 3]
            if roles:
                messages.append((roles[k], texts[k]))
        elif letter == 3:
            state = NEXT[state]
            if roles:
                messages.append((ROLE[state], texts[k]))
    return "".join(edits), messages, state


def ending(state: int) -> tuple[str, list[tuple[str, str]]]:
    messages = []
    while END[state]:
        state = NEXT[state]
        messages.append((ROLE[state], ""))
    return "I" * len(messages), messages


COUNTS = ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "cost")
MESSAGES = "array<struct<role:string,text:string>>"


def _schema(conv: str) -> str:
    return (f"conv_id {conv}, whole boolean, part int, seq long, first_turn long, last_turn long, first_role int, last_role int, "
            + ", ".join(f"{c} long" for c in COUNTS)
            + f", edits string, messages {MESSAGES}, codes binary, matrix array<double>, roles array<string>, texts array<string>")


class Piece:
    """Consecutive rows of a conversation."""

    def __init__(self, conv, after: Piece | None = None):
        self.conv, self.codes, self.roles, self.texts, self.size = conv, bytearray(), [], [], 0
        self.first_turn = self.last_turn = self.first_role = self.last_role = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, text: str, kind: int, blank: bool, seen: bool, cut: bool) -> None:
        code = kind
        if blank:
            self.blank += 1
            code |= MUST_GO
        elif seen:
            self.duplicate += 1
            code |= MUST_GO
        elif cut:
            self.truncated += 1
            code |= CUT
        if turn is not None:
            self.turns += turn != self.last_turn
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        if self.last_role is None:
            self.first_role = kind
        else:
            self.illegal += (self.last_role, kind) not in LEGAL
        self.last_role = kind
        self.codes.append(code)
        gone = code & MUST_GO
        self.roles.append("" if gone else role)
        self.texts.append("" if gone else text)
        self.size += 0 if gone else len(role) + len(text)

    def row(self, whole: bool, part: int, seq: int) -> tuple:
        counts = (self.first_turn, self.last_turn, self.turns, self.blank, self.duplicate, self.truncated, self.illegal)
        ends = (self.first_turn, self.last_turn, self.first_role, self.last_role)
        if whole:
            taken, costs = backward(self.codes, END)
            edits, messages, state = forward(self.codes, taken, 0, self.roles, self.texts)
            more, last = ending(state)
            return (self.conv, True, part, seq, *ends, *counts, int(costs[0]), edits + more, messages + last, None, None, None, None)
        columns = [backward(self.codes, [0.0 if s == end else NEVER for s in range(4)])[1] for end in range(4)]
        matrix = [columns[end][state] for state in range(4) for end in range(4)]
        return (self.conv, False, part, seq, *ends, *counts, None, None, None, bytes(self.codes), matrix, self.roles, self.texts)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    def value(column, kind):
        if pa.types.is_list(kind) and pa.types.is_struct(kind.value_type):
            column = [c if c is None else [{"role": r, "text": t} for r, t in c] for c in column]
        return pa.array(column, kind)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([value(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _pieces(conv_type: pa.DataType, piece_rows: int):
    text = pa.string()
    listed = pa.list_(pa.struct([("role", text), ("text", text)]))
    schema = pa.schema([("conv_id", conv_type), ("whole", pa.bool_()), ("part", pa.int32()), ("seq", pa.int64()), ("first_turn", pa.int64()),
                        ("last_turn", pa.int64()), ("first_role", pa.int32()), ("last_role", pa.int32()), *((c, pa.int64()) for c in COUNTS), ("edits", text),
                        ("messages", listed), ("codes", pa.binary()), ("matrix", pa.list_(pa.float64())), ("roles", pa.list_(text)), ("texts", pa.list_(text))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, piece, inside, firsts, here = TaskContext.get().partitionId(), 0, None, False, set(), None
        for batch in batches:
            out = []
            columns = [batch.column(n).to_pylist() for n in ("conv", "turn", "role", "prefix", "mark", "present", "text", "key", "kind", "blank", "cut")]
            for conv, turn, role, prefix, mark, present, text, key, kind, blank, cut in zip(*columns):
                if piece is None or conv != piece.conv:
                    if piece is not None:
                        out.append(piece.row(inside, part, seq))
                        seq += 1
                    inside = piece is not None          # the range's first conversation may have begun in another one
                    piece, firsts, here = Piece(conv), set(), None
                elif len(piece.codes) >= piece_rows or piece.size >= PIECE_BYTES:
                    out.append(piece.row(False, part, seq))
                    seq, inside, piece = seq + 1, False, Piece(conv)
                if here != (turn, role, prefix):
                    here, firsts = (turn, role, prefix), set()
                if mark:
                    firsts.add(key)
                elif present:
                    seen = key not in firsts
                    firsts.discard(key)
                    piece.add(turn, role, text, kind, blank, seen, cut)
            yield _batch(out, schema)
        if piece is not None:
            yield _batch([piece.row(False, part, seq)], schema)
    return each


def _behind(pieces: pa.Table) -> pa.Table:
    """The costs behind each piece of a conversation: matrices folded from the end."""
    rows = sorted(pieces.to_pylist(), key=lambda r: (r["part"], r["seq"]))
    costs = list(END)
    for row in reversed(rows):
        row["behind"] = costs
        m = row["matrix"]
        costs = [min(m[4 * s + e] + costs[e] for e in range(4)) for s in range(4)]
    return pa.table({"part": pa.array([r["part"] for r in rows], pa.int32()), "seq": pa.array([r["seq"] for r in rows], pa.int64()),
                     "behind": pa.array([r["behind"] for r in rows], pa.list_(pa.float64())),
                     "last": pa.array([k == len(rows) - 1 for k in range(len(rows))], pa.bool_())})


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece the state behind it, for each state before it."""
    for batch in batches:
        ends = []
        for codes, behind in zip(batch.column("codes").to_pylist(), batch.column("behind").to_pylist()):
            taken, _ = backward(codes, behind)
            ends.append([forward(codes, taken, s)[2] for s in range(4)])
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in ("conv", "part", "seq", "behind", "last")], pa.array(ends, pa.list_(pa.int32()))],
                                         names=["conv", "part", "seq", "behind", "last", "ends"])


def _before(pieces: pa.Table) -> pa.Table:
    """The state before each piece: states folded from the front."""
    rows = sorted(pieces.to_pylist(), key=lambda r: (r["part"], r["seq"]))
    states = [0]
    for row in rows:
        states.append(row["ends"][states[-1]])
    return pa.table({"part": pa.array([r["part"] for r in rows], pa.int32()), "seq": pa.array([r["seq"] for r in rows], pa.int64()),
                     "behind": pa.array([r["behind"] for r in rows], pa.list_(pa.float64())), "last": pa.array([r["last"] for r in rows], pa.bool_()),
                     "state": pa.array(states[:-1], pa.int32())})


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        edits, messages, costs = [], [], []
        for row in batch.select(["codes", "roles", "texts", "behind", "last", "state"]).to_pylist():
            taken, before = backward(row["codes"], row["behind"])
            some, found, state = forward(row["codes"], taken, row["state"], row["roles"], row["texts"])
            cost = before[row["state"]] - row["behind"][state]
            if row["last"]:
                more, tail = ending(state)
                some, found, cost = some + more, found + tail, cost + END[state]
            edits.append(some)
            messages.append([{"role": r, "text": t} for r, t in found])
            costs.append(int(cost))
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("seq"), pa.array(costs, pa.int64()), pa.array(edits, pa.string()), pa.array(messages, kind)],
                                         names=["part", "seq", "cost", "edits", "messages"])


def repair(rows: DataFrame, conv: str = "conv_id", present: Column | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Rows (conv, turn, role, text) -> the repaired pieces of each conversation, in the order (part, seq): edits (their initials),
    messages (role, text), cost and the faults counted. A row for which `present` is false only names its conversation."""
    spark = rows.sparkSession
    configure(spark)
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    given = rows.select(F.col(f"`{conv}`").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"))
    end = F.rtrim("text", F.lit(WHITE))
    initial = F.left("role", F.lit(1))
    known = given.select(
        "conv", "turn", "role", F.left("text", F.lit(PREFIX)).alias("prefix"), F.lit(False).alias("mark"), "present", "text",
        F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias("key"),
        F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER).alias("kind"),
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    marks = known.where("present and not blank").groupBy("conv", "key").agg(
        F.min(F.struct("turn"))["turn"].alias("turn"), F.first("role").alias("role"), F.first("prefix").alias("prefix"))
    none = [F.lit(None).cast(known.schema[c].dataType).alias(c) for c in ("text",)]
    marks = marks.select("conv", "turn", "role", "prefix", F.lit(True).alias("mark"), F.lit(True).alias("present"), *none, "key",
                         F.lit(OTHER).alias("kind"), F.lit(False).alias("blank"), F.lit(False).alias("cut"))
    order = ["conv", "turn", "role", "prefix"]
    ranged = known.unionByName(marks).repartitionByRange(*order).sortWithinPartitions(*order, F.col("mark").desc(), "text")
    conv_field = known.schema["conv"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    pieces = stored(ranged.mapInArrow(_pieces(to_arrow_type(conv_field), piece_rows), _schema(conv_field.simpleString())), "conversations")

    cut = pieces.where("not whole")
    behind = cut.select(F.col("conv_id").alias("conv"), "part", "seq", "matrix").groupBy("conv").applyInArrow(
        _behind, "part int, seq long, behind array<double>, last boolean")
    codes = cut.select(F.col("conv_id").alias("conv"), "part", "seq", "codes").join(behind, ["part", "seq"])
    ends = codes.select("conv", "part", "seq", "codes", "behind", "last").mapInArrow(
        _ends, f"conv {conv_field.simpleString()}, part int, seq long, behind array<double>, last boolean, ends array<int>")
    before = ends.groupBy("conv").applyInArrow(_before, "part int, seq long, behind array<double>, last boolean, state int")
    edited = (cut.select("part", "seq", "codes", "roles", "texts").join(before, ["part", "seq"])
              .mapInArrow(_repaired, f"part int, seq long, cost long, edits string, messages {MESSAGES}"))
    drop = ["codes", "matrix", "roles", "texts"]
    mended = cut.drop(*drop, "cost", "edits", "messages").join(edited, ["part", "seq"])
    return pieces.where("whole").drop(*drop).unionByName(mended)


def _gaps(low: Column, high: Column, turns: Column) -> Column:
    return F.coalesce(high - low + 1 - turns, F.lit(0).cast("long"))


SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _joined(conv_type: pa.DataType):
    schema = pa.schema([("conv_id", conv_type), *((c, pa.int64()) for c in SUMMARY), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result():
            low, high, turns = at["low"], at["high"], at["turns"]
            gaps = 0 if low is None else high - low + 1 - turns
            return tuple([conv, gaps, *(at[c] for c in SUMMARY[1:]), "".join(edits), digest.hexdigest()])
        started = False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not started or row["conv_id"] != conv:
                    if started:
                        out.append(result())
                    started, conv, edits, digest, lines = True, row["conv_id"], [], hashlib.sha256(), 0
                    at = {"low": None, "high": None, "turns": 0, "role": None} | {c: 0 for c in SUMMARY}
                for c in SUMMARY[1:]:
                    at[c] += row[c]
                if row["low"] is not None:
                    at["turns"] += row["turns"] - (row["low"] == at["high"])
                    at["low"] = row["low"] if at["low"] is None else at["low"]
                    at["high"] = row["high"]
                if row["first_role"] is not None:
                    at["illegal"] += at["role"] is not None and (at["role"], row["first_role"]) not in LEGAL
                    at["role"] = row["last_role"]
                edits.append(row["edits"])
                for m in row["messages"]:
                    digest.update(("\n" * (lines > 0) + m["role"] + ":" + m["text"]).encode())
                    lines += 1
            yield _batch(out, schema)
        if started:
            yield _batch([result()], schema)
    return each


def summary(pieces: DataFrame) -> DataFrame:
    """One row for each conversation: gaps, the faults counted, cost, audit (the edits' initials) and the SHA-256 of the repaired `role:text`
    lines. Pieces of a conversation meet in one task, in order."""
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    whole = pieces.where("whole").select("conv_id", _gaps(F.col("low"), F.col("high"), F.col("turns")).alias("gaps"), *SUMMARY[1:], F.col("edits").alias("audit"),
                                         F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
    from pyspark.sql.pandas.types import to_arrow_type
    kind = pieces.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in SUMMARY) + ", audit string, repaired_sha256 string"
    cut = (pieces.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_joined(to_arrow_type(kind)), schema))
    return whole.unionByName(cut)
