import random

from pyspark.sql import functions as F

from channelmart.llm import langid
from channelmart.llm.queries import op1_language_id

EN, FR = "the cat and the dog saw that of with this".split(), "le chat et la chienne que pour dans avec été".split()


def sentence(words, rng):
    return " ".join(rng.choice(words) for _ in range(12))


def test_held_out_accuracy_on_the_given_documents(spark, sf_dir):
    found = op1_language_id(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_cases(docs):
    rng = random.Random(3)
    train = docs([(k, sentence(EN if k % 2 else FR, rng), "en" if k % 2 else "fr") for k in range(60)] + [(99, "zzz", None)])
    model = langid.fit(train)
    assert model.languages == ["en", "fr"]
    texts = [None, "", "123 .. !", "the dog", "la chienne dans", "THE CAT", "thez dogs thats", "chiennes étés", "漢字", "the dog", "the " * 300_000]
    out = {r["doc_id"]: r for r in langid.predict(docs(list(enumerate(texts))), model, [F.col("doc_id")]).collect()}
    assert [out[k]["lang_pred"] for k in range(11)] == ["und"] * 3 + ["en", "fr", "en", "en", "fr", "en", "en", "en"]
    assert [out[k]["score"] for k in range(3)] == [0, 0, 0]
    assert out[8]["score"] == 0.5                                    # nothing of it is known: an even share
    assert langid.predict(docs([]), model, [F.col("doc_id")]).count() == 0


def test_no_learned_language_gives_und(docs):
    model = langid.fit(docs([(1, "some text", None)]))
    assert [r["lang_pred"] for r in langid.predict(docs([(1, "some text")]), model, [F.col("doc_id")]).collect()] == ["und"]


def test_backoff_uses_the_longest_known_ngrams():
    import pyarrow as pa
    w = langid.Words(pa.array(["ab abc"]))
    sizes = {n: len(keys) for n, keys, _ in w.grams(__import__("numpy").arange(2))}
    assert sizes == {5: 1, 4: 3, 3: 5, 2: 7, 1: 5}                   # of " ab " and " abc "; single letters without the marks
