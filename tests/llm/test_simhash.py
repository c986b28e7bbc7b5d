import random

import pytest
import xxhash

from channelmart.llm import simhash
from channelmart.llm.queries import op6_simhash
from .helpers import words


def fingerprint(text, n):
    ws = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [b" ".join(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))] if ws else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def brute(rows, n, bits):
    """(doc_id, fingerprint, component_id) by comparing all fingerprints."""
    prints = [fingerprint(t, n) for _, t in rows]
    known = sorted(set(prints))
    group = {p: p for p in known}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p
    for i, p in enumerate(known):
        for q in known[i + 1:]:
            if (p ^ q).bit_count() <= bits:
                group[root(p)] = root(q)
    low = {}
    for (k, _), p in zip(rows, prints):
        if k is not None:
            low[root(p)] = min(low.get(root(p), k), k)
    return [(k, f"{p:016x}", low.get(root(p))) for (k, _), p in zip(rows, prints)]


def got(df, n, bits):
    return [(r["doc_id"], f"{r['fingerprint'] & (1 << 64) - 1:016x}", r["component_id"]) for r in simhash.near_duplicates(df, n, bits).collect()]


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in row)


def near_copies(rng, text, n):
    for _ in range(n):
        ws = text.split()
        for _ in range(rng.randrange(3)):
            ws[rng.randrange(len(ws))] = "other"
        yield " ".join(ws)


@pytest.mark.parametrize("n,bits", [(4, 4), (2, 6), (5, 0)])
def test_equals_brute_force(docs, n, bits):
    rng = random.Random(n)
    texts = [words(rng, rng.randrange(1, 120), 300) for _ in range(150)]
    for t in texts[:6]:
        texts += near_copies(rng, " ".join([t] * 3), 40)                    # groups of near copies of few different words
    texts += ["A b  C\td"] * 30 + ["a B c d", "a b c d", None, "", " \n", "one", "ONE", "x " * 20_000]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, "only without id"), (3, texts[3]), (3, "other text")]
    rng.shuffle(rows)
    assert sorted(got(docs(rows), n, bits), key=key) == sorted(brute(rows, n, bits), key=key)


def test_every_linked_pair_shares_a_choice_of_blocks():
    rng = random.Random(1)
    masks = simhash.block_masks(4)
    assert len(masks) == 35
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), 4):
            b ^= 1 << k
        assert any(not (a ^ b) & m & (1 << 64) - 1 for m in masks)


def test_search_keeps_connections():
    import numpy as np
    rng = np.random.default_rng(3)
    base = rng.integers(-1 << 62, 1 << 62, 20)
    prints = np.unique(np.concatenate([base, base ^ 1, base ^ 7, base ^ 0x7F, base ^ 0x3FF00]))
    found = list(simhash.reach(prints, 4))
    assert len(found) <= len(prints) - 1 and all(((int(a) ^ int(b)) & (1 << 64) - 1).bit_count() <= 4 for a, b in found)
    assert len(prints) - len(found) == 40                                   # x, x^1, x^7, x^7f chain up; x^3ff00 is alone


def test_chains_and_stars_become_components(spark):
    rng = random.Random(8)
    edges = [(k, k + 1) for k in range(0, 200)] + [(1000, 2000 + k) for k in range(300)] + [(5000 + rng.randrange(90), 5000 + rng.randrange(90)) for _ in range(60)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert {found[k] for k in range(201)} == {0} and {found[1000], *(found[2000 + k] for k in range(300))} == {1000}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert found == {x: root(x) for x in list(parent) if any(x in e and e[0] != e[1] for e in edges)}


def test_one_of_each_keeps_one_row_a_group(docs):
    rows = [(5, "a b c d e f g"), (2, "A b c d e f g"), (9, "something else entirely here now"), (2, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (4, None), (3, "")]
    df = docs(rows)
    kept = simhash.one_of_each(df, 4, 4)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 9]
    assert simhash.one_of_each(docs([]), 4, 4).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in op6_simhash(spark, sf_dir).collect()]
    assert sorted(found) == sorted(brute(rows, 4, 4))
