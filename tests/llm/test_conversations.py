import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from channelmart.llm import conversations
from channelmart.llm.queries import op13_conversation_repair

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
GRAMMAR = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        fault = "blank" if not text.strip(WHITE) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(WHITE)[-1] not in ".!?" else None
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, found):
    """(cost, audit, messages) by dynamic programming over whole strings: states are the grammar's, the value is (cost, audit)."""
    start = {"s": {"s": "s", "u": "u"}, "": {"s": "s", "u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    start["s"] = {"u": "u"}
    whole = {"u": "user", "a": "assistant"}

    def insertions(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for r in start[state]:
                    if r != "s":
                        other = cost + 5, audit + "I", (*lines, whole[r] + ":")
                        if r not in best or other[:2] < best[r][:2]:
                            best[r] = other
        return best

    # Forward search keeps for each state the cheapest; audits of different lengths are compared from their start.
    best = insertions({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, found):
        after = {}
        for state, (cost, audit, lines) in best.items():
            steps = [(state, 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] in start[state]:
                    steps.append((role[:1], more, "K", (f"{role}:{text}",)))
                steps += [(r, 1 + more, "R", (f"{whole[r]}:{text}",)) for r in start[state] if r != "s"]
            for state2, price, letter, line in steps:
                other = cost + price, audit + letter, lines + line
                if state2 not in after or other[:2] < after[state2][:2]:
                    after[state2] = other
        best = insertions(after)
    return min(best[s] for s in ("", "a") if s in best)


def every_edit(rows, found):
    """The same by trying all edits of a short conversation, with up to two insertions."""
    best = None
    n = len(rows)
    for letters in itertools.product("DKR", repeat=n):
        for places in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(n + 1), k) for k in range(3)):
            audit, choices, cost = "", [], 0
            for k in range(n + 1):
                for _ in range(places.count(k)):
                    audit += "I"
                    cost += 5
                    choices.append([("u", "user:"), ("a", "assistant:")])
                if k < n:
                    audit += letters[k]
                    _, role, text = rows[k]
                    if letters[k] == "D":
                        cost += 2
                        continue
                    if found[k] in ("blank", "duplicate"):
                        break
                    cost += 5 * (found[k] == "truncated") + (letters[k] == "R")
                    choices.append([(role[:1], f"{role}:{text}")] if letters[k] == "K" else [("u", f"user:{text}"), ("a", f"assistant:{text}")])
            else:
                for made in itertools.product(*choices):
                    if GRAMMAR.fullmatch("".join(r for r, _ in made)) and (best is None or (cost, audit) < best[:2]):
                        best = cost, audit, tuple(line for _, line in made)
    return best


def brute(rows, solve=cheapest):
    """Rows (conv, turn, role, text, present) -> the summary of each conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x, p in rows if c == conv and p]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        found = faults(mine)
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = solve(mine, found)
        out[conv] = (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(n, text)
        out += [(conv, turn, "user" if n == 4 else role, text, n != 0)] * (2 if n == 3 else 1)
    return out


def conversation(rng, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "System"]
    texts = ["Yes.", "No!", "why", "", "  \n", None, "Ünlü?", "a. b", "end. \t\r\n", "\x85", "Long text " * 30 + "."]
    return [(conv, rng.choice([k + 1, k + 1, None]) if rng.random() < 0.2 else k, rng.choice(roles), rng.choice(texts)) for k in range(n)]


def cases():
    rng = random.Random(6)
    rows = [r for conv in range(120) for r in conversation(rng, conv, rng.randint(1, 9))]
    rows += [(500, k, ("user", "assistant")[k % 2], f"Turn {k}." if k % 17 else "cut off") for k in range(900)]       # a long one
    rows += [(501, None, "user", "Same."), (501, None, "user", "Same."), (501, 3, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]
    return rows + [(600 + k, 0, "user", "x.") for k in range(200)]          # some of these lose their only row


def got(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def frame(spark, rows):
    schema = T.StructType([*ROWS, T.StructField("present", T.BooleanType())])
    return spark.createDataFrame(rows, schema).selectExpr("*", "'x' as conv", "1 as part", "2 as seq", "'y' as kind", "'z' as key").repartition(5)


@pytest.mark.parametrize("piece_rows", [4096, 7])
def test_against_brute_force(spark, piece_rows):
    """With whole conversations and with conversations in many pieces."""
    rows = damaged(cases())
    pieces = conversations.repair(frame(spark, rows), present=F.col("present"), piece_rows=piece_rows)
    want = brute(rows)
    assert got(conversations.summary(pieces)) == want
    assert any(w[6] == "" for w in want.values())
    per = Counter(r["conv_id"] for r in pieces.select("conv_id").collect())
    assert per[500] > (100 if piece_rows == 7 else 0)


def test_dynamic_programming_finds_the_cheapest_of_all_edits():
    rng = random.Random(9)
    for _ in range(250):
        rows = [(k, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["A.", "B!", "cut", "", f"T{k}."])) for k in range(rng.randint(0, 5))]
        found = faults(rows)
        want = every_edit(rows, found)
        assert cheapest(rows, found)[:2] == want[:2]
        piece = conversations.Piece(1)
        seen = set()
        for (turn, role, text), fault in zip(rows, found):
            kind = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
            piece.add(turn, role, text, kind, fault == "blank", (role, text) in seen, fault == "truncated")
            seen.add((role, text))
        row = piece.row(True, 0, 0)
        cost, edits, messages = row[15], row[16], row[17]
        assert (cost, edits) == want[:2] and tuple(f"{r}:{t}" for r, t in messages) == want[2]


def test_a_giant_conversation_is_many_ranges(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"Turn {k}.", True) for k in range(6000)]
    merge = "spark.sql.adaptive.coalescePartitions.enabled"       # these few rows would be merged into one range
    spark.conf.set(merge, "false")
    try:
        pieces = conversations.repair(frame(spark, rows))
    finally:
        spark.conf.set(merge, "true")
    assert pieces.select("part").distinct().count() > 3
    row, = conversations.summary(pieces).collect()
    assert row["audit"] == "K" * 6000 and row["cost"] == row["illegal"] == row["gaps"] == 0
    assert row["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t, _ in rows).encode()).hexdigest()


def test_the_query_reads_null_as_a_space(spark, tmp_path):
    rows = cases()
    spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' as present", "'y' as copy").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op13_conversation_repair(spark, str(tmp_path))) == brute(damaged(rows))


def test_an_empty_table_gives_no_rows(spark):
    assert conversations.summary(conversations.repair(frame(spark, []))).count() == 0


def test_on_the_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op13_conversation_repair(spark, sf_dir)) == brute(damaged(rows))
