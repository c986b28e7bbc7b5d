from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from channelmart.llm import token_counts
from channelmart.llm.queries import op12_token_counts
from .test_bpe_packing import BYTE, texts, tokenizer


def library(lib, text):
    return len((text or "").encode()), len(lib.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("shard_bytes", [64 << 20, 4000])
def test_counts_equal_the_library(docs, monkeypatch, shard_bytes):
    """With one shard and with many."""
    monkeypatch.setattr(token_counts, "SHARD_BYTES", shard_bytes)
    lib, rows = tokenizer(BYTE), list(enumerate(texts())) + [(None, "no id"), (None, "no id"), (1, "again")]
    got = token_counts.count_tokens(docs(rows), BYTE, [F.col("doc_id"), F.col("kind"), F.col("shard")]).collect()
    assert got[0].__fields__ == ["doc_id", "kind", "shard", "n_bytes", "n_tokens"]
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == Counter((k, *library(lib, t)) for k, t in rows)


def test_a_pre_token_is_counted_once(monkeypatch):
    """A shard counts each distinct text once, however many tasks send it."""
    calls = []
    cutter = token_counts.PreTokens(BYTE)
    monkeypatch.setitem(token_counts._loaded, "spy", cutter)
    count = cutter.pieces
    monkeypatch.setattr(cutter, "pieces", lambda w: calls.append(w) or count(w))
    rows, docs = [], pa.RecordBatch.from_pydict({"doc_id": [1, 2]})
    for task in range(3):
        sender = token_counts.Sender(1)
        rows += [*token_counts._block([" the of the", f" task{task} the"], cutter, docs, task, 1, sender), *sender.flush()]
    rows.sort(key=lambda r: r[0])
    found = [r for b in token_counts._sums("spy")([token_counts._rows(rows)]) for r in b.to_pylist()]
    sums = [token_counts.unpack(r["sums"], "u4", "i8") for r in found if r["documents"] is None]
    lib = tokenizer(BYTE)
    want = [[len(lib.encode(t).ids) for t in (" the of the", f" task{k} the")] for k in range(3)]
    assert [(d.tolist(), n.tolist()) for d, n in sums] == [([0, 1], w) for w in want]
    assert sorted(calls) == sorted({w.encode() for k in range(3) for w in cutter.words.findall(f" the of task{k}")})


def test_new_pre_tokens_leave_in_bounded_lots(monkeypatch):
    monkeypatch.setattr(token_counts, "SEND_BYTES", 100)
    monkeypatch.setattr(token_counts, "SENT_KEYS", 10)
    sender, sent = token_counts.Sender(2), []
    for k in range(50):
        words = [b"word%d" % k, b"common"]
        sent += list(sender.add(token_counts._keys(words).tolist(), words))
        assert sender.size <= 100 + 20 and len(sender.known) <= 12
    assert sent


def test_an_empty_table_gives_no_rows(docs):
    assert token_counts.count_tokens(docs([]), BYTE, [F.col("doc_id")]).count() == 0


def test_on_the_given_documents(spark, sf_dir):
    lib = tokenizer(BYTE)
    want = {r["doc_id"]: library(lib, r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op12_token_counts(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got) and len({r["over_limit"] for r in got}) == 2
