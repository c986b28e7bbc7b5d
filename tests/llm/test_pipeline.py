import random

import pytest

import __spark_entry__
import corpus_pipeline
from channelmart.llm import pii, quality
from channelmart.llm.queries import QUERIES, tokenizer_path
from . import test_pii, test_simhash, test_suffix_dedup
from .helpers import words
from .test_bpe_packing import check_packing, tokenizer


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_every_stage_against_brute_force(spark, sf_dir):
    """Each stage on what its predecessor kept, with the columns of documents, by brute force where there is one."""
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, seen = given, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == given.columns
        seen[name] = rows_of(docs), rows_of(out)
        assert all(r["n_chars"] == len(r["text"]) for r in out.select("n_chars", "text").collect())
        docs = spark.createDataFrame(out.collect(), given.schema)

    before, after = seen["quality rules"]
    kept = {r["doc_id"] for r in QUERIES["op9_quality_rules"](spark, sf_dir).where("kept").collect()}
    assert sorted(after) == sorted(r for r in before if r[0] in kept) and 0 < len(after) < len(before)

    before, after = seen["near duplicates"]
    low = {k: c for k, _, c in test_simhash.brute(before, 4, 4)}
    assert sorted(after) == sorted(r for r in before if low[r[0]] == r[0]) and len(after) < len(before)

    before, after = seen["repeated strings"]
    assert sorted(after) == sorted((k, d.decode("utf-8", "ignore")) for k, d, _, _ in test_suffix_dedup.brute(before, 50))

    before, after = seen["personal data"]
    found, texts = {r["doc_id"]: [s.asDict() for s in r["spans"]] for r in pii.spans(spark.createDataFrame(before, "doc_id long, text string")).collect()}, dict(before)
    assert sorted(after) == sorted((k, pii.redact(t, found[k])) for k, t in before)
    assert all({(a, b) for a, _, b in test_pii.brute(t)} <= {(s["start"], s["end"]) for s in found[k]} for k, t in texts.items())

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    check_packing(rows_of(docs), packed, 4096, tokenizer(tokenizer_path("word_bpe_49k.json")), 2)
    whole = corpus_pipeline.run(spark, sf_dir)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(tuple(r[c] for c in columns) for r in whole.collect()) == sorted(tuple(r[c] for c in columns) for r in packed)


def test_nulls_and_other_columns_pass_every_stage(spark, docs, sf_dir):
    rng = random.Random(1)
    rows = [(k, words(rng, 40, 700)) for k in range(12)] + [(None, words(rng, 40, 700)), (3, None), (3, ""), (50, rows_text := words(rng, 60, 700)), (50, rows_text), (51, rows_text)]
    df = docs(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, sf_dir)
        assert out.columns == df.columns
        out.collect()
        assert stage(spark, docs([]), sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, df, sf_dir).count() == len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs([]), sf_dir).count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_strings", "personal_data", "packed"]
    assert quality.FEATURES and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("stage", range(5))
def test_functions_take_the_agreed_arguments(stage):
    function = corpus_pipeline.STAGES[stage][1]
    assert function.__code__.co_varnames[:3] == ("spark", "docs", "sf_dir")
