import math
import random

import numpy as np
from pyspark.sql import functions as F

from channelmart.llm import ann
from channelmart.llm.queries import op7_ann

SCHEMA = "vec_id long, embedding array<float>, label int, cell long, part int"


def table(spark, rows):
    return spark.createDataFrame([(k, v, 0, None, None) for k, v in rows], SCHEMA).repartition(3)


def brute(rows, is_query, n):
    ok = [(k, np.array(v, np.float32).astype(float)) for k, v in rows
          if k is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v)]
    ids, x = np.array([k for k, _ in ok]), np.array([v for _, v in ok])
    size = np.sqrt((x * x).sum(1))
    out = {}
    for k, v in ok:
        if is_query(k):
            score = (x * v).sum(1) / (size * np.sqrt((v * v).sum()))
            rows_ = np.flatnonzero(ids != k)
            out[k] = [(int(ids[i]), float(score[i])) for i in rows_[np.lexsort((ids[rows_], -score[rows_]))][:n]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, want):
    return sum(len({k for k, _ in found.get(q, [])} & {k for k, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_all_cells_visited_is_exact(spark):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 1) for _ in range(7)]) for k in range(300)]
    rows += [(1000 + k, rows[0][1]) for k in range(40)] + [(2000 + k, [2 * x for x in rows[1][1]]) for k in range(9)]
    rows += [(5, None), (6, [0.0] * 7), (7, [1.0, None] + [0.0] * 5), (8, [float("nan")] * 7), (9, [float("inf")] + [1.0] * 6), (None, [1.0] * 7)]
    rows = [r for r in rows if not (r[0] in (5, 6, 7, 8, 9) and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]))]
    found = got(ann.nearest(table(spark, rows), F.col("vec_id") % 10 == 0, 5, candidates=10**9))
    want = brute(rows, lambda k: k % 10 == 0, 5)
    assert found.keys() == want.keys()
    for q, w in want.items():
        assert [k for k, _ in found[q]] == [k for k, _ in w]
        assert np.allclose([s for _, s in found[q]], [s for _, s in w], rtol=1e-12, atol=0)


def test_a_large_cell_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(200)] + [(200 + k, [1.0, float(k), 0.5]) for k in range(100)]
    found = got(ann.nearest(table(spark, rows), F.col("vec_id") % 50 == 0, 5, candidates=10**9))
    want = brute(rows, lambda k: k % 50 == 0, 5)
    assert {q: [k for k, _ in w] for q, w in found.items()} == {q: [k for k, _ in w] for q, w in want.items()}


def test_few_or_no_rows(spark):
    assert got(ann.nearest(table(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])]), F.col("vec_id") % 50 == 0, 5, 10)) == {0: [(1, 0.0)]}
    assert ann.nearest(table(spark, []), F.col("vec_id") % 50 == 0, 5, 10).count() == 0
    assert ann.nearest(table(spark, [(0, [1.0])]), F.col("vec_id") % 50 == 0, 5, 10).count() == 0
    assert got(ann.nearest(table(spark, [(0, [1.0]), (1, [-2.0]), (2, [1.0, 1.0]), (3, [3.0])]), F.col("vec_id") == 0, 5, 10)) == {0: [(3, 1.0), (1, -1.0)]}


def test_cells_are_visited_by_summed_distance():
    rng = np.random.default_rng(1)
    index = ann.MultiIndex(rng.normal(size=(9, 3)), rng.normal(size=(7, 4)))
    index.sizes = {c: 1 for c in range(63)}
    a, b = rng.random(9), rng.random(7)
    cells = index.visit(a, b, 10**9)
    sums = [a[c // 7] + b[c % 7] for c in cells]
    assert sorted(cells) == list(range(63)) and sums == sorted(sums)
    assert index.visit(a, b, 5) == cells[:5]


def test_recall_of_the_query(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert recall(got(op7_ann(spark, sf_dir)), brute(rows, lambda k: k % 50 == 0, 5)) >= 0.9


def test_calibration_holds_for_other_queries(spark, monkeypatch):
    """Vectors without structure: the number of candidates found on a few queries reaches the recall on all."""
    rng = np.random.default_rng(5)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(6000, 12)))]
    seen = []
    monkeypatch.setattr(ann, "CALIBRATION", 40)
    monkeypatch.setattr(ann, "calibrated", lambda *a, real=ann.calibrated: seen.append(real(*a)) or seen[-1])
    found = got(ann.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, 5))
    assert 0 < seen[0] < len(rows) / 2
    assert recall(found, brute(rows, lambda k: k % 20 == 0, 5)) >= 0.9


def test_extreme_components_have_their_cosine(spark):
    """Squares of 1e200 overflow and those of 1e-200 vanish; cosines do neither."""
    vectors = [[1e200, 2e200, 0.0], [1e-200, 2e-200, 1e-201], [3.0, 4.0, 1.0], [1e200, 1e-200, 1.0], [-1e300, 2.0, 1e300], [5e-324, 0.0, 0.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    found = got(ann.nearest(df, F.col("vec_id") < 6, neighbours=5))
    small = [[c / max(map(abs, v)) for c in v] for v in vectors]

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    for q in range(6):
        want = {k: cosine(small[q], small[k]) for k in range(6) if k != q}
        assert {k for k, _ in found[q]} == set(want)
        assert all(math.isclose(s, want[k], abs_tol=1e-12) for k, s in found[q])
