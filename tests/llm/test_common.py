import random

import numpy as np
import pyarrow as pa

from channelmart.llm import common


def test_runs_end_at_text_borders():
    texts = ["ab c", "", "  ", "d", None, "e f", "gé"]
    data, offsets = common.utf8(pa.array(texts))
    starts, ends, first = common.runs(~common.WHITE[data], offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends)] == ["ab", "c", "d", "e", "f", "gé"]
    assert np.diff(first).tolist() == [2, 0, 0, 1, 0, 2, 1]
    assert common.utf8(pa.array(texts).slice(3, 3))[0].tobytes() == b"de f"


def test_rolling_hash_depends_on_the_bytes_alone():
    rng = random.Random(1)
    data = np.frombuffer(bytes(rng.choices(b"ab", k=4000)), np.uint8)
    for seed in (0, 1):
        r = common.Rolling(data, seed)
        starts = np.arange(3900)
        found = {}
        for length in (7, 20, 64):
            for s, h in zip(starts, r(starts, starts + length).tolist()):
                found.setdefault(h, set()).add(bytes(data[s:s + length]))
        assert all(len(v) == 1 for v in found.values())
        assert len(found) == len(set().union(*found.values()))


def test_packed_arrays_come_back():
    rng = np.random.default_rng(2)
    for n in (0, 1, 1000):
        keys = np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        values = rng.integers(0, 9, n).astype("u4"), rng.normal(size=n), rng.random(n) < 0.5, rng.integers(-5, 5, n)
        back = common.unpack(common.pack(keys, *values), "u8", "u4", "f8", "?", "i8")
        assert all((a == b).all() for a, b in zip(back, (keys, *values)))


def test_shards_cut_the_key_space_in_order():
    keys = np.sort(np.random.default_rng(3).integers(0, 1 << 64, 5000, dtype=np.uint64))
    for shards in (1, 7, 64):
        parts = list(common.split(keys, shards))
        assert [a for _, a, _ in parts] == [0, *(b for _, _, b in parts[:-1])] and parts[-1][2] == len(keys)
        assert [s for s, _, _ in parts] == sorted({int(k) // -(-(1 << 64) // shards) for k in keys})


def test_counter_flushes_bounded_memory(monkeypatch):
    monkeypatch.setattr(common, "FLUSH_KEYS", 100)
    counter, total, largest = common.Counter(4), {}, 0
    rng = np.random.default_rng(4)
    sent = []
    for _ in range(50):
        keys = rng.integers(0, 1000, 60, dtype=np.uint64) << np.uint64(50)
        for k in keys.tolist():
            total[k] = total.get(k, 0) + 1
        sent += list(counter.add(keys, np.ones(60, "u4")))
        largest = max(largest, counter.size)
    sent += list(counter.flush())
    found = {}
    for batch in sent:
        for blob in batch.column("blob").to_pylist():
            for k, n in zip(*(x.tolist() for x in common.unpack(blob, "u8", "u4"))):
                found[k] = found.get(k, 0) + n
    assert found == total and largest <= 260


def test_slices_are_bounded_and_whole():
    texts = ["x" * n for n in (5, 0, 700, 3, 3, 3, 90, 2000)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = [p.column("text").to_pylist() for p in common.slices(batch, limit=100)]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 100 for p in parts)


def test_sorted_table_finds_keys_of_every_shard(spark, tmp_path):
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 64, 3000, dtype=np.uint64))
    table = common.SortedTable(f"file://{tmp_path}/t", 5, {"n": "u4"})

    def emit(batches):
        for _ in batches:
            pass
        yield common.to_shards(keys, (np.arange(len(keys), dtype="u4"),), 5)

    def store(batches):
        k, n = common.merged(batches, "u4")
        table.write(k, {"n": n})
        yield pa.RecordBatch.from_pydict({"rows": [len(k)]})

    one = spark.range(1).coalesce(1)
    rows = common.exchange(one, emit, 5).mapInArrow(store, "rows long").collect()
    assert len(rows) == 5 and sum(r["rows"] for r in rows) == len(keys)
    asked = np.unique(np.concatenate((keys[::3], keys[::7] + np.uint64(1))))
    n, known = table.find(asked)
    assert known.tolist() == np.isin(asked, keys).tolist()
    assert n[known].tolist() == np.flatnonzero(np.isin(keys, asked)).tolist() and not n[~known].any()
