import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from channelmart.llm import lm
from channelmart.llm.queries import op10_lm_scoring
from .helpers import words


def tokens(text):
    return [*"".join(c.lower() if c.isascii() else c for c in text or "").encode().split(), "end"]


def brute(train, texts):
    """The model by dictionaries."""
    pairs, uni = Counter(), Counter()
    for t in train:
        ts = tokens(t)
        uni.update(ts)
        pairs.update(zip(["start", *ts], ts))
    context, before = defaultdict(Counter), Counter()
    for (u, w), c in pairs.items():
        context[u][min(c, 3)] += 1
        context[u]["sum"] += c
        before[w] += 1
    d = lm.discounts([sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)])
    e = lm.discounts([sum(c == k for c in before.values()) for k in (1, 2, 3, 4)])
    n, v = sum(uni.values()), len(uni)
    classes = Counter(min(c, 3) for c in before.values())

    def word(w):
        spare = sum(e[k - 1] * classes[k] for k in (1, 2, 3)) / len(pairs)
        c = before[w]
        return max(c - (0, *e)[min(c, 3)], 0) / len(pairs) + spare / (v + 1)

    def pair(u, w):
        x = context.get(u)
        if not x:
            return word(w)
        c = pairs.get((u, w), 0)
        return max(c - (0, *d)[min(c, 3)], 0) / x["sum"] + sum(d[k - 1] * x[k] for k in (1, 2, 3)) / x["sum"] * word(w)

    out = []
    for t in texts:
        ts = tokens(t)
        out.append((len(ts), sum(uni[w] > 0 for w in ts), n, sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts),
                    sum(math.log10(pair(u, w)) for u, w in zip(["start", *ts], ts))))
    return out, pair, [*uni, "never seen"], [*context, "never seen"]


def test_equals_brute_force(docs):
    rng = random.Random(5)
    train = [words(rng, rng.randrange(40), 30 + 70 * (k % 3)) for k in range(60)] + [None, "", "A b\tC", "a B c"] + ["again and again"] * 300
    texts = train[:20] + ["", None, "unknown words here", "wak WAK\n wal", "x " * 5000]
    model = lm.fit(docs(list(enumerate(train))))
    got = {r["doc_id"]: r for r in lm.score(docs(list(enumerate(texts))), model, [F.col("doc_id")]).collect()}
    want, pair, vocabulary, contexts = brute(train, texts)
    for k, (n, known, total, base, score) in enumerate(want):
        r = got[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-9 * n) and r["score"] == pytest.approx(score, abs=1e-9 * n)
    for u in contexts[:8] + contexts[-1:]:
        assert sum(pair(u, w) for w in vocabulary) == pytest.approx(1)


def test_empty_training(docs):
    model = lm.fit(docs([]))
    got = lm.score(docs([(1, "a b"), (None, None)]), model, [F.col("doc_id")]).collect()
    assert [(r["base_score"], r["score"], r["train_tokens"], r["n_known"]) for r in got] == [(0, 0, 0, 0)] * 2
    assert lm.score(docs([]), model, [F.col("doc_id")]).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    import zlib
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows}
    want, *_ = brute([r["text"] for r in rows if not held[r["doc_id"]]], [r["text"] for r in rows])
    got = {r["doc_id"]: r for r in op10_lm_scoring(spark, sf_dir).collect()}
    for r, (n, known, total, base, score) in zip(rows, want):
        g = got[r["doc_id"]]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (held[r["doc_id"]], n, known, total)
        assert g["base_score"] == pytest.approx(base, rel=1e-9) and g["score"] == pytest.approx(score, rel=1e-9)
