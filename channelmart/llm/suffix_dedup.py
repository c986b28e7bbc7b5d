"""Removal of repeated byte strings by a difference cover.

A byte goes if it lies in a string of `length` bytes that also starts in a text with a smaller id. The positions of a
text that a difference cover modulo v selects are the sampled suffixes: whatever two suffixes begin alike, some shift
below v takes both to sampled ones. As only prefixes of `length` bytes are compared, the names of sampled suffixes are
needed to that depth alone, and names that one text alone has are discarded, as their suffixes are then ranked:

1. sort the sampled tuples (length - v + 1 bytes at each sampled position): tuples of several texts are repeated names;
2. recurse on repeated names: the triple of the v - 1 bytes before, the tuple, and the v - 1 bytes after it holds every
   string of `length` bytes around the tuple. Sort the triples: where the smallest id of a triple is smaller than the
   own one, all its strings are repeated. A name whose triples are all equal, so that the triple comes as often as the
   name, is settled by that;
3. merge the remaining suffixes, those around names with different triples: name their prefixes of `length` bytes,
   discard again the names that one text alone has, sort the other prefixes and compare neighbours, that is, take the
   smallest id of each prefix.

Sorting is by 64-bit hashes of the bytes with 24 bits more of a second hash, in ranges of the key space (shards), each
sorted by one task. A chunk (the texts of one remainder of the id's hash; chunks and shards are as many as the bytes of
all texts ask for) sends each distinct key once, so a frequent
string is one entry for each chunk, and gets one answer back for each key. The texts are exchanged by chunk once,
compressed; every step reads that exchange. Names have 32 bits more than it takes to number the shards, so that as few of
them meet by chance at any size of the input; they only propose.

Cases: a null text is empty, a null id is smaller than all others; rows with the same id never remove each other's
bytes; texts shorter than `length` are kept as they are; an empty table gives no rows; other columns pass through
under their own names if asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rolling, configure, mix, pack, runs, split, unpack, utf8

# Perfect difference covers, by modulus.
COVERS = {7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
# Bytes of text for which there is a chunk, and a shard.
CHUNK_BYTES, SHARD_BYTES = 2 << 20, 16 << 20
PACKED_BYTES = 32 << 20
# What a chunk sends for each key of a step, and what it gets back.
SENT_KINDS = {"name": ("u8", "u4", "?"), "triple": ("u8", "u4", "i8", "u4", "u8"), "prefix name": ("u8", "?"), "prefix": ("u8", "u4", "i8")}
ANSWERS = {"name": "u8", "triple": "u1", "prefix name": "u1", "prefix": "u1"}
SENT = "shard int, chunk int, kind string, blob binary"


def cover_for(length: int) -> int:
    """The modulus: the largest that leaves tuples of more than a third of the length."""
    return max((v for v in COVERS if length - v + 1 > length / 3), default=7)


def _table(kind: str, rows: list[tuple[int, int, bytes]], names: tuple[str, str]) -> pa.Table:
    return pa.table({names[0]: pa.array([r[0] for r in rows], pa.int32()), names[1]: pa.array([r[1] for r in rows], pa.int32()),
                     "kind": pa.array([kind] * len(rows), pa.string()), "blob": pa.array([r[2] for r in rows], pa.binary())})


class Groups:
    """Rows grouped by (key, check): sorted distinct pairs, each row's group, and the smallest id of each group."""

    def __init__(self, key: np.ndarray, check: np.ndarray, ids: np.ndarray):
        order = np.lexsort((check, key))
        k, c = key[order], check[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        first = np.flatnonzero(new)
        self.key, self.check = k[first], c[first]
        self.of = np.empty(len(k), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.low = np.minimum.reduceat(ids[order], first) if len(first) else ids[:0]

    def blobs(self, shards: int, *more: np.ndarray):
        return [(s, pack(self.key[a:b], self.check[a:b], self.low[a:b], *(m[a:b] for m in more))) for s, a, b in split(self.key, shards)]


class Chunk:
    """The texts of a chunk in one order, whatever order the rows came in."""

    def __init__(self, packed: pa.Table, length: int, shards: int):
        self.length, self.shards, self.v = length, shards, cover_for(length)
        docs = pa.concat_tables(_unpacked(b) for b in packed.column("blob").to_pylist()).combine_chunks()
        docs = docs.take(pc.sort_indices(docs, [("doc_id", "ascending"), ("text", "ascending")]))
        self.docs = docs
        self.id = int(packed.column("chunk")[0].as_py())
        self.data, self.offsets = utf8(docs.column("text").combine_chunks())
        self.ids = pc.fill_null(docs.column("doc_id").cast(pa.int64()), np.iinfo(np.int64).min).to_numpy()
        self.doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.offsets))
        self.rolling = Rolling(self.data)

    @cached_property
    def checking(self) -> Rolling:
        return Rolling(self.data, 1)

    def sampled(self) -> np.ndarray:
        """Positions r, r + v, r + 2 v ... of each text for the members r of the cover, in no order."""
        tuple_length, size, out = self.length - self.v + 1, np.diff(self.offsets), []
        for r in COVERS[self.v]:
            n = np.where(size >= self.length, (size - tuple_length - r) // self.v + 1, 0)
            before = np.cumsum(n) - n
            out.append(np.repeat(self.offsets[:-1] + r - self.v * before, n) + self.v * np.arange(int(n.sum())))
        return np.concatenate(out)

    def _name(self, at: np.ndarray, length: int) -> np.ndarray:
        spare = np.uint64(32 - (self.shards - 1).bit_length())
        return self.rolling(at, at + length) >> spare << spare

    def names(self, at: np.ndarray) -> np.ndarray:
        return self._name(at, self.length - self.v + 1)

    def prefix_names(self, at: np.ndarray) -> np.ndarray:
        return self._name(at, self.length)

    def triples(self, at: np.ndarray):
        """The triples' extents, first and last starts of their strings, keys and checks."""
        doc = self.doc[at]
        left = np.maximum(at - (self.v - 1), self.offsets[:-1][doc])
        right = np.minimum(at + self.length, self.offsets[1:][doc])
        key = mix(self.rolling(left, right) + (at - left).astype(np.uint64))
        return left, right, np.minimum(at, self.offsets[1:][doc] - self.length), key, self._check(left, right)

    def _check(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (self.checking(left, right) >> np.uint64(40)).astype(np.uint32)

    def prefixes(self, at: np.ndarray) -> Groups:
        return Groups(self.rolling(at, at + self.length), self._check(at, at + self.length), self.ids[self.doc[at]])

    def marked(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Which positions lie in one of the intervals (last exclusive)."""
        n = len(self.data) + 1
        return np.cumsum(np.bincount(first, minlength=n) - np.bincount(last, minlength=n))[:-1] > 0

    def send(self, kind: str, blobs: list[tuple[int, bytes]]) -> pa.Table:
        return _table(kind, [(s, self.id, b) for s, b in blobs], ("shard", "chunk"))

    def state(self, kind: str, inside: np.ndarray) -> pa.Table:
        """Positions that the chunk's next step needs, as runs, by way of the shard of the chunk's number."""
        starts, ends, _ = runs(inside, np.array([0, len(inside)]))
        return self.send(kind, [(self.id % self.shards, pack(starts.astype(np.uint64), (ends - starts).astype(np.uint32)))])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each chunk that a task has, as one compressed value for every PACKED_BYTES of the task's rows."""
    def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        table = table.take(pc.sort_indices(table, [("chunk", "ascending")]))
        ids = table.column("chunk").to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True])))
        blobs = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            sink = pa.BufferOutputStream()
            part = table.slice(a, b - a).drop_columns("chunk")
            with pa.ipc.new_stream(sink, part.schema) as stream:
                stream.write_table(part)
            blobs.append(zstandard.ZstdCompressor(level=3).compress(sink.getvalue()))
        return pa.RecordBatch.from_arrays([pa.array(ids[cuts[:-1]], pa.int32()), pa.array(blobs, pa.binary())], names=["chunk", "blob"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size > PACKED_BYTES:
            yield out(held)
            held, size = [], 0
    if held:
        yield out(held)


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all()


def _blobs(replies: pa.Table, kind: str) -> list[tuple[int, bytes]]:
    rows = replies.filter(pc.equal(replies.column("kind"), kind))
    return sorted(zip(rows.column("shard").to_pylist(), rows.column("blob").to_pylist()))


def _answer(replies: pa.Table, kind: str, keys: np.ndarray, shards: int) -> np.ndarray:
    """The answers for sorted keys, in the keys' order: times for names, else bit sets."""
    found, out = dict(_blobs(replies, kind)), np.zeros(len(keys), ANSWERS[kind])
    for shard, a, b in split(keys, shards):
        out[a:b] = unpack(found[shard], ANSWERS[kind])[0]
    return out


def _state(chunk: Chunk, replies: pa.Table, kind: str) -> np.ndarray:
    inside = np.zeros(len(chunk.data), bool)
    for _, blob in _blobs(replies, kind):
        starts, size = (a.astype(np.int64) for a in unpack(blob, "u8", "u4"))
        inside = chunk.marked(starts, starts + size)
    return inside


def _distinct(names: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names, how often each comes, and whether several ids have it."""
    if not len(names):
        return names, np.zeros(0, np.uint32), np.zeros(0, bool)
    order = np.argsort(names)
    names, ids = names[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
    several = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
    return names[first], np.diff(np.concatenate((first, [len(names)]))).astype(np.uint32), several


def _tuples(chunk: Chunk) -> pa.Table:
    """Step 1: each distinct name, how often the chunk has it, and whether several of its texts do."""
    at = chunk.sampled()
    names, times, several = _distinct(chunk.names(at), chunk.ids[chunk.doc[at]])
    return chunk.send("name", [(s, pack(names[a:b], times[a:b], several[a:b])) for s, a, b in split(names, chunk.shards)])


def _repeated(chunk: Chunk, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose name several texts have, and how often the name comes in all texts."""
    at = chunk.sampled()
    names, index = np.unique(chunk.names(at), return_inverse=True)
    times = _answer(replies, "name", names, chunk.shards)[index]
    return at[times > 0], times[times > 0]


def _triples(chunk: Chunk, replies: pa.Table) -> pa.Table:
    """Step 2: the distinct triples of repeated names, with the smallest id, how often the chunk has the triple, and
    how often the name comes."""
    at, times = _repeated(chunk, replies)
    key, check = chunk.triples(at)[3:]
    groups = Groups(key, check, chunk.ids[chunk.doc[at]])
    own = np.bincount(groups.of, minlength=len(groups.key)).astype(np.uint32)
    name_times = np.zeros(len(groups.key), np.uint64)
    name_times[groups.of] = times
    anchors = np.zeros(len(chunk.data), bool)
    anchors[at] = True
    return pa.concat_tables([chunk.send("triple", groups.blobs(chunk.shards, own, name_times)), chunk.state("anchors", anchors)])


def _prefix_names(chunk: Chunk, replies: pa.Table) -> pa.Table:
    """Step 3: the names of the prefixes around names with different triples that no equal triple has settled."""
    at = np.flatnonzero(_state(chunk, replies, "anchors"))
    left, right, last, key, check = chunk.triples(at)
    ids = chunk.ids[chunk.doc[at]]
    groups = Groups(key, check, ids)
    answer = _answer(replies, "triple", groups.key, chunk.shards)[groups.of]
    gone = (answer & 1 > 0) | (groups.low[groups.of] < ids)
    open_ = (answer & 2 > 0) & ~gone
    rest = chunk.marked(left[open_], last[open_] + 1) & ~chunk.marked(left[gone], last[gone] + 1)
    at = np.flatnonzero(rest)
    names, _, several = _distinct(chunk.prefix_names(at), chunk.ids[chunk.doc[at]])
    blobs = [(s, pack(names[a:b], several[a:b])) for s, a, b in split(names, chunk.shards)]
    return pa.concat_tables([chunk.send("prefix name", blobs), chunk.state("gone", chunk.marked(left[gone], right[gone])), chunk.state("rest", rest)])


def _prefixes(chunk: Chunk, replies: pa.Table) -> pa.Table:
    """The prefixes whose name several texts have."""
    at = np.flatnonzero(_state(chunk, replies, "rest"))
    names, index = np.unique(chunk.prefix_names(at), return_inverse=True)
    at = at[_answer(replies, "prefix name", names, chunk.shards)[index] > 0]
    rest = np.zeros(len(chunk.data), bool)
    rest[at] = True
    return pa.concat_tables([chunk.send("prefix", chunk.prefixes(at).blobs(chunk.shards)), chunk.state("gone", _state(chunk, replies, "gone")), chunk.state("rest", rest)])


def _removed(chunk: Chunk, replies: pa.Table) -> np.ndarray:
    at = np.flatnonzero(_state(chunk, replies, "rest"))
    groups = chunk.prefixes(at)
    at = at[(_answer(replies, "prefix", groups.key, chunk.shards)[groups.of] > 0) | (groups.low[groups.of] < chunk.ids[chunk.doc[at]])]
    return _state(chunk, replies, "gone") | chunk.marked(at, at + chunk.length)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard: the answers for the keys of each chunk; positions are passed on."""
    rows: dict[str, list] = {k: [] for k in SENT_KINDS}
    names = ("chunk", "shard")
    for batch in batches:
        for shard, chunk, kind, blob in zip(*(c.to_pylist() for c in batch.columns)):
            if kind in rows:
                rows[kind].append((chunk, shard, blob))
            else:
                yield from _table(kind, [(chunk, shard, blob)], names).to_batches()
    for kind, found in rows.items():
        if not found:
            continue
        parts = [unpack(blob, *SENT_KINDS[kind]) for _, _, blob in found]
        columns = [np.concatenate(c) for c in zip(*parts)]
        cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
        del parts
        if kind in ("name", "prefix name"):
            _, index = np.unique(columns[0], return_inverse=True)
            answer = (np.bincount(index) > 1) | (np.bincount(index, columns[-1]) > 0)
            if kind == "name":
                answer = np.where(answer, np.bincount(index, columns[1]), 0)
            answer = answer[index]
        else:
            groups = Groups(*columns[:3])
            answer = groups.low[groups.of] < columns[2]
            if kind == "triple":
                answer = answer + 2 * (np.bincount(groups.of, columns[3])[groups.of] < columns[4])
        blobs = [pack(a.astype(ANSWERS[kind])) for a in np.split(answer, cuts)]
        yield from _table(kind, [(chunk, shard, b) for (chunk, shard, _), b in zip(found, blobs)], names).to_batches()


def _rows(docs: DataFrame, length: int, rest: tuple[str, ...], as_text: bool) -> DataFrame:
    """doc_id, rest (a struct of these columns), kept (bytes, or with as_text the text without characters that are left
    in part only), n_bytes and spans."""
    spark = docs.sparkSession
    configure(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, shards = (max(1, -(-size // n)) for n in (CHUNK_BYTES, SHARD_BYTES))
    docs = docs.select("doc_id", F.struct(F.lit(None).cast("string").alias("_"), *(F.col(f"`{c}`") for c in rest)).alias("rest"), "text",
                       F.expr(f"cast(pmod(xxhash64(doc_id), {chunks}) as int)").alias("chunk"))
    by_chunk = docs.mapInArrow(_packed, "chunk int, blob binary").groupBy("chunk")

    def step(work, replies: DataFrame | None) -> DataFrame:
        if replies is None:
            sent = by_chunk.applyInArrow(lambda d: work(Chunk(d, length, shards)), SENT)
        else:
            sent = by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(lambda d, r: work(Chunk(d, length, shards), r), SENT)
        return sent.repartitionById(shards, "shard").mapInArrow(_answers, "chunk int, shard int, kind string, blob binary")

    def result(d: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = Chunk(d, length, shards)
        gone = _removed(chunk, replies)
        starts, ends, first = runs(gone, chunk.offsets)
        base = np.repeat(chunk.offsets[:-1], np.diff(first))
        left = np.concatenate(([0], np.cumsum(~gone)))[chunk.offsets]
        spans = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(starts - base, pa.int64()), pa.array(ends - base, pa.int64())], names=["start", "end"]))
        data = chunk.data[~gone].tobytes()
        if as_text:
            kept = pa.array([data[a:b].decode("utf-8", "ignore") for a, b in zip(left[:-1], left[1:])], pa.string())
        else:
            kept = pa.Array.from_buffers(pa.binary(), len(chunk.ids), [None, pa.py_buffer(left.astype(np.int32)), pa.py_buffer(data)])
        return pa.table([chunk.docs.column("doc_id"), chunk.docs.column("rest"), kept, pa.array(np.diff(chunk.offsets), pa.int64()), spans],
                        names=["doc_id", "rest", "kept", "n_bytes", "spans"])

    replies = step(_prefixes, step(_prefix_names, step(_triples, step(_tuples, None))))
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([docs.schema["doc_id"], docs.schema["rest"], T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
                           T.StructField("n_bytes", T.LongType()), T.StructField("spans", spans)])
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(result, schema)


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes (before) and spans (the maximal removed runs of bytes, end exclusive)
    of each row."""
    return _rows(docs, length, (), False).drop("rest")


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """docs with the repeated bytes taken out of the texts, and n_chars (if there) counted anew; other columns stay. What is
    left of a character that went in part goes too. A null text stays null."""
    flag = "text is null"
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = _rows(docs.withColumn(flag, F.col("text").isNull()), length, (*rest, flag), True)
    text = F.when(~F.col("rest")[flag], F.col("kept"))
    values = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text)}
    return found.select(*(values.get(c, F.col("rest")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))
