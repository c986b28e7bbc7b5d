import hashlib
import random

import pytest
from pyspark.sql import functions as F

from channelmart.llm import suffix_dedup
from channelmart.llm.queries import op4_suffix_dedup
from .helpers import words


def brute(rows, length):
    """doc_id, kept and spans of each row by a dictionary of all strings."""
    low, out = {}, []
    ids = [-2**63 if k is None else k for k, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    for k, d in zip(ids, data):
        for i in range(len(d) - length + 1):
            s = d[i:i + length]
            low[s] = min(low.get(s, k), k)
    for (k, _), own, d in zip(rows, ids, data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if low[d[i:i + length]] < own:
                gone[i:i + length] = b"\1" * length
        spans = [(m, n) for m, n in zip([i for i in range(len(d)) if gone[i] and (not i or not gone[i - 1])],
                                        [i + 1 for i in range(len(d)) if gone[i] and (i + 1 == len(d) or not gone[i + 1])])]
        out.append((k, bytes(b for b, g in zip(d, gone) if not g), len(d), spans))
    return out


def ran(df, length):
    return [(r["doc_id"], bytes(r["kept"]), r["n_bytes"], [tuple(s) for s in r["spans"]]) for r in suffix_dedup.remove_repeats(df, length).collect()]


def key(row):
    return (row[0] is None, row[0] or 0, row[1], row[2], row[3])


@pytest.mark.parametrize("v", suffix_dedup.COVERS)
def test_covers_hold_every_shift(v):
    cover = suffix_dedup.COVERS[v]
    for shift in range(v):
        assert any((x + shift) % v in cover for x in cover)
    assert suffix_dedup.cover_for(50) == 31


@pytest.mark.parametrize("length,seed,chunk", [(50, 1, 2000), (50, 2, 2 << 20), (20, 3, 3000), (33, 4, 500)])
def test_equals_brute_force(docs, length, seed, chunk, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3 * chunk)
    rng = random.Random(seed)
    passages = [words(rng, rng.randrange(3, 40), 400) for _ in range(12)]
    rows = []
    for k in range(120):
        parts = [words(rng, rng.randrange(12), 400) for _ in range(4)]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts.insert(rng.randrange(len(parts)), p[a:a + rng.randrange(20, 200)])
        rows.append((k, rng.choice(["", " ", "é"]).join(parts)))
    rows += [(200 + k, t[:rng.randrange(1, len(t) + 1)]) for k, (_, t) in enumerate(rows[:40]) if t]           # cut copies
    rows += [(300 + k, t) for k, (_, t) in enumerate(rows[:20])]                                                # copies
    rows += [(400, "ab" * 200), (401, "ab" * 150 + "c"), (402, "a" * 300), (403, "a" * 49), (404, "a" * 120 + "b" * 60)]
    rows += [(400, "ab" * 30), (None, rows[3][1]), (None, "ab" * 60), (-5, rows[5][1]), (500, None), (501, ""), (300, rows[0][1])]
    assert sorted(ran(docs(rows), length), key=key) == sorted(brute(rows, length), key=key)


def test_a_frequent_line_and_other_columns(docs):
    rng = random.Random(9)
    line = "this line stands in a third of all of the documents of the table"
    rows = [(k, f"{words(rng, 9, 9000)}\n{line}\n{words(rng, 9, 9000)}" if k % 3 == 0 else words(rng, 30, 9000), "en") for k in range(300)]
    df = docs(rows)
    assert sorted(ran(df, 50), key=key) == sorted(brute([r[:2] for r in rows], 50), key=key)
    clean = suffix_dedup.without_repeats(df)
    assert clean.schema == df.schema
    assert {r["lang"] for r in clean.collect()} == {"en"} and {r["chunk"] for r in clean.collect()} == {"x"}
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in clean.collect()) == sorted((k, d.decode(), len(d)) for k, d, _, _ in brute([r[:2] for r in rows], 50))


def test_characters_cut_in_part_go(docs):
    line = "é" * 40
    rows = [(1, "a" + line), (2, "\ufffd x" + line[1:] + "b"), (3, None), (4, "ü" + line)]
    got = {r["doc_id"]: r["text"] for r in suffix_dedup.without_repeats(docs(rows)).collect()}
    want = {k: d.decode("utf-8", "ignore") for k, d, _, _ in brute(rows, 50)} | {3: None}
    assert got == want and got[2] == "\ufffd xb"


def test_empty_tables(docs):
    assert suffix_dedup.remove_repeats(docs([])).count() == 0
    assert ran(docs([(1, None)]), 50) == [(1, b"", 0, [])]


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op4_suffix_dedup(spark, sf_dir).collect()}
    want = {k: (n, n - len(d), len(s), hashlib.sha256(d).hexdigest()) for k, d, n, s in brute(rows, 50)}
    assert got == want and sum(w[1] for w in want.values()) > 0


def test_texts_are_exchanged_once(docs):
    plan = suffix_dedup.remove_repeats(docs([(1, "a"), (2, "b")]))._jdf.queryExecution().executedPlan()
    df = suffix_dedup.remove_repeats(docs([(k, "text " * k) for k in range(20)]))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert plan is not None and final.count("ReusedExchange") >= 4
    assert df.select(F.count("*")).first()[0] == 20
