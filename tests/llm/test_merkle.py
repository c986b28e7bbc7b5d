import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from channelmart.llm import merkle
from channelmart.llm.queries import op11_merkle_manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[f] for f in FIELDS)))


def tree(digests, fan):
    """The root and for each node its runs up to it: (digests before, digests after)."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for k, place in enumerate(at):
            run = level[place - place % fan:place - place % fan + fan]
            paths[k].append((run[:place % fan], run[place % fan + 1:]))
        level = [h(*level[k:k + fan]) for k in range(0, len(level), fan)]
        at = [place // fan for place in at]
    return level[0], paths


def brute(rows, fan):
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fan) for g in names}
    root, tops = tree([trees[g][0] for g in names], fan)
    out = []
    for g, top in zip(names, tops):
        for (_, _, leaf, row), path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            path = path + top
            text = row["text"]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf_of(dict(row, text=text))
            for before, after in path:
                folded = h(*before, folded, *after)
            out.append((row["doc_id"], leaf, trees[g][0], root, h(*(d for before, after in path for d in before + after)), folded, folded == root))
    return sorted(out, key=str)


def digest(found):
    root = merkle.hex_text(F.col("root"))
    return [(r[0], *r[1:]) for r in found.select("doc_id", merkle.hex_text(F.col("leaf")), merkle.hex_text(F.col("subroot")), root,
                                                 F.sha2(merkle.siblings(F.col("path")), 256), merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))).collect()]


def run(spark, tmp_path, rows, schema):
    df = spark.createDataFrame(rows, schema).selectExpr("*", "'x' as grp", "1 as idx", "2 as n", "'y' as digest", "'z' as carry")
    df.repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in op11_merkle_manifest(spark, str(tmp_path)).collect()), key=str)


def cases():
    rng = random.Random(3)
    rows = [dict(doc_id=k, source=rng.choice(["src0"] * 4 + ["src1", "ä", "", None]), lang=rng.choice(["en", None]), n_chars=rng.choice([3, None]),
                 text=rng.choice(["A b É", "", None, "plain", "X" * 3000])) for k in range(700)]
    rows += [dict(rows[5]), dict(rows[5]), dict(rows[6], text="other of the same id")]
    rows += [dict(doc_id=None, source=s, lang="en", n_chars=1, text="Null id") for s in ("src0", None, "alone")]
    return rows + [dict(doc_id=9000 + k, source=f"s{k:03}", lang=None, n_chars=0, text="T") for k in range(40)]


def test_against_brute_force(spark, docs, tmp_path):
    from .conftest import DOCS
    rows = cases()
    got = run(spark, tmp_path, [tuple(r[f.name] for f in DOCS) for r in rows], DOCS)
    want = brute(rows, 16)
    assert got == want
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("fan_out", [2, 3])
def test_other_widths(spark, docs, fan_out):
    rows = [dict(doc_id=k, source="ab"[k % 7 == 0], lang="en", n_chars=k, text=f"T {k}") for k in range(40)]
    df = docs([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows])
    found = merkle.manifest(df, FIELDS, "source", "doc_id", fan_out, keep=[F.lit(None).cast("binary").alias("tampered")])
    want = {(r[0], r[1], r[2], r[3], r[4]) for r in brute(rows, fan_out)}
    got = digest(found)
    assert {r[:5] for r in got} == want and all(r[5] == r[3] for r in got)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small_tables(spark, tmp_path, n):
    from .conftest import DOCS
    rows = [dict(doc_id=k, source="s", lang=None, n_chars=None, text=None) for k in range(n)]
    got = run(spark, tmp_path, [tuple(r[f.name] for f in DOCS) for r in rows], DOCS)
    assert got == (brute(rows, 16) if n else [])


def test_a_hot_group_is_dealt_to_many_tasks(spark, docs):
    df = docs([(k, f"t{k}", "en", "hot", 1) for k in range(2000)])
    placed = merkle._placed(merkle.stored(df.select(F.lit("=hot").alias("grp"), F.col("doc_id").alias("ord"), F.unhex(F.sha2("text", 256)).alias("digest"),
                                                    F.struct(F.col("doc_id").alias("ord")).alias("carry")), "t"), ["ord", "digest"])
    assert [r[0] for r in placed.orderBy("idx").select("carry.ord").collect()] == list(range(2000))
    assert {r["n"] for r in placed.select("n").distinct().collect()} == {2000}
