"""Helpers of the llm operators.

Texts are handled as the UTF-8 buffer of an Arrow column, a bounded slice at a time, so that words and windows are
found and hashed by array operations. Counts over the corpus leave a task as a few packed arrays, one for each range
of the key space (a shard), and meet in one task for each shard: keys are hashes, so shards are even whatever the
texts are, and a frequent key is one entry for each task. The number of shards is spark.sql.shuffle.partitions,
which the user sizes to the input.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from channelmart.session import ensure_checkpoint_dir

# Names of helper columns beside those of a given table.
ROW, OTHER_ID, OTHER_ROW = "llm row", "llm id", "llm other row"
SLICE_BYTES = 2 << 20
FLUSH_KEYS = 3 << 20
WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.default_rng(7041)
_TABLES = _random.integers(0, 1 << 64, size=(2, 256), dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers = {}


def configure(spark: SparkSession) -> None:
    """Batches that reach Python workers are bounded in rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def shards_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the checkpoint folder, which the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """df, written once as Parquet in the shared folder and read from there."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


# ---------------------------------------------------------------- texts as arrays

def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of whole rows with at most `limit` bytes of text (a longer text is a piece by itself)."""
    if not batch.num_rows:
        return
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
    first = 0
    while first < batch.num_rows:
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(first, last - first)
        first = last


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; null counts as empty."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True within each text, and the index of each text's first run."""
    n = len(inside)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    starts[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _series(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, SLICE_BYTES)
        known = np.full(size, base, np.uint64)
        known[:1] = 1
        np.cumprod(known, out=known)
        if size > 8 * SLICE_BYTES:
            return known
        _powers[base] = known
    return known[:n]


class Rolling:
    """Hashes of any substrings of `data`: polynomial sums over random values of the bytes, modulo 2**64."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[seed][data] * _series(_BASE, len(data)), out=self.sums[1:])
        self.inverse = _series(pow(_BASE, -1, 1 << 64), len(data) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        found ^= (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix(found)


# ---------------------------------------------------------------- packed arrays and shards

def combine(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, with the sum of each column of values."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return (keys[first], *(np.add.reduceat(v[order], first, dtype=v.dtype) for v in values))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as one compressed value: byte planes apart, as high bytes are alike; 64-bit keys (in the first
    array, sorted) as differences."""
    if arrays[0].dtype == np.uint64 and len(arrays[0]):
        arrays = (np.concatenate((arrays[0][:1], np.diff(arrays[0]))), *arrays[1:])
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    kinds = [np.dtype(k) for k in kinds]
    n, out, at = len(raw) // sum(k.itemsize for k in kinds), [], 0
    for k in kinds:
        out.append(np.ascontiguousarray(raw[at:at + n * k.itemsize].reshape(k.itemsize, n).T).view(k).reshape(n))
        at += n * k.itemsize
    if kinds[0] == np.uint64:
        out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def split(keys: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) for the shards that sorted keys fall into."""
    step = -(-(1 << 64) // shards)
    cuts = np.searchsorted(keys, np.array([k * step for k in range(1, shards)], np.uint64))
    cuts = [0, *cuts.tolist(), len(keys)]
    for shard, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            yield shard, a, b


def to_shards(keys: np.ndarray, values: tuple, shards: int) -> pa.RecordBatch:
    """Sorted keys and their values as one packed row for each shard."""
    rows = [(s, pack(keys[a:b], *(v[a:b] for v in values))) for s, a, b in split(keys, shards)]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                      names=["shard", "blob"])


def exchange(df: DataFrame, emit: Callable, shards: int) -> DataFrame:
    """Rows (shard, blob) that `emit` makes of Arrow batches, each shard in the partition of its number."""
    return df.mapInArrow(emit, "shard int, blob binary").repartitionById(shards, "shard")


def merged(batches: Iterator[pa.RecordBatch], *kinds) -> tuple[np.ndarray, ...]:
    """The packed rows of one shard as distinct sorted keys with summed values; whole numbers are summed in 64 bits."""
    kinds = ("u8", *kinds)
    parts = [unpack(b, *kinds) for batch in batches for b in batch.column("blob").to_pylist()]
    columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind) for k, kind in enumerate(kinds)]
    del parts
    return combine(columns[0], *(c if c.dtype.kind == "f" else c.astype(np.uint64) for c in columns[1:]))


# ---------------------------------------------------------------- sorted arrays in the shared folder

def write_file(path: str, data: bytes) -> None:
    """Whole or not at all; a repeated task writes the same bytes again."""
    part = f"{path}.{uuid.uuid4().hex}"
    if path.startswith("file:") or path.startswith("/"):
        path, part = path.removeprefix("file://").removeprefix("file:"), part.removeprefix("file://").removeprefix("file:")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
        return
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(path)
    with store.open_output_stream(part_name := name + part[len(path):]) as f:
        f.write(data)
    store.move(part_name, name)


def map_file(path: str) -> np.ndarray:
    """The bytes of a file of the shared folder, memory-mapped. A file of a remote store is mapped from an unnamed copy,
    which goes when the mapping does."""
    if path.startswith("file:") or path.startswith("/"):
        path = path.removeprefix("file://").removeprefix("file:")
        return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name) as f, tempfile.TemporaryFile() as copy:
        while block := f.read(1 << 22):
            copy.write(block)
        copy.flush()
        return np.memmap(copy, np.uint8, "r") if copy.tell() else np.zeros(0, np.uint8)


class SortedTable:
    """Sorted 64-bit keys with columns of values: files for each shard, written by one task each, mapped by readers."""

    def __init__(self, root: str, shards: int, columns: dict[str, str]):
        self.root, self.shards, self.columns, self._open = root, shards, columns, {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def write(self, keys: np.ndarray, values: dict[str, np.ndarray]) -> None:
        shard = TaskContext.get().partitionId()
        write_file(f"{self.root}/{shard:06d}.keys", keys.tobytes())
        for name, kind in self.columns.items():
            write_file(f"{self.root}/{shard:06d}.{name}", values[name].astype(kind).tobytes())

    def _shard(self, shard: int):
        if shard not in self._open:
            self._open[shard] = (map_file(f"{self.root}/{shard:06d}.keys").view("u8"),
                                 {c: map_file(f"{self.root}/{shard:06d}.{c}").view(k) for c, k in self.columns.items()})
        return self._open[shard]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """Columns for sorted keys, zero where a key is unknown, and whether each is known."""
        out = [np.zeros(len(keys), k) for k in self.columns.values()]
        known = np.zeros(len(keys), bool)
        for shard, a, b in split(keys, self.shards):
            have, columns = self._shard(shard)
            if not len(have):
                continue
            at = np.minimum(np.searchsorted(have, keys[a:b]), len(have) - 1)
            hit = have[at] == keys[a:b]
            known[a:b] = hit
            at = at[hit]
            for o, values in zip(out, columns.values()):
                o[a:b][hit] = values[at]
        return (*out, known)


class Counter:
    """Sums by key over the slices of a task, combined now and then so that memory stays bounded by FLUSH_KEYS distinct
    keys; flush() gives what to send."""

    def __init__(self, shards: int):
        self.shards, self.parts, self.size = shards, [], 0

    def add(self, keys: np.ndarray, *values: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, *values))
        self.size += len(keys)
        if self.size > 2 * FLUSH_KEYS:
            self._combine()
            if self.size > FLUSH_KEYS:
                yield from self.flush()

    def _combine(self) -> None:
        self.parts = [combine(*(np.concatenate(c) for c in zip(*self.parts)))] if self.parts else []
        self.size = sum(len(p[0]) for p in self.parts)

    def flush(self) -> Iterator[pa.RecordBatch]:
        self._combine()
        if self.size:
            keys, *values = self.parts[0]
            yield to_shards(keys, tuple(values), self.shards)
        self.parts, self.size = [], 0
