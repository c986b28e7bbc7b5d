"""Token counts of texts by a public byte-level BPE tokenizer, without their ids.

A tokenizer cuts a text into pre-tokens and each of these into pieces, whatever stands around it. So the number of a text's
tokens is the sum over its distinct pre-tokens of frequency times number of pieces, plus one for each added token in the text.

1. Where the texts are read, a block of texts (SLICE_BYTES, or one longer text) becomes its documents' pre-token frequencies: for
   each shard (a range of hashes) the block's distinct pre-tokens of that shard, sorted by hash, with the documents that have them
   and how often. Beside these go the texts of the pre-tokens that the task has not sent yet, and one row of the documents' columns.
2. One exchange by shard brings texts and frequencies together, the texts first. A shard counts the pieces of each distinct
   pre-token once, by the tokenizers library's model, and joins the blocks' frequencies in passing, as a merge join does; what
   leaves it is, for each block, the documents' sums over the shard.
3. The sums of a block's documents are added up over the shards.

How it scales: a frequent pre-token is one entry for each block, so no shard is hot; shards follow the bytes of the texts, and
hold the hashes and counts of their own distinct pre-tokens alone, while blocks stream by. Ids are never made, and each row is
exchanged once. Numbers of blocks follow the partitions of the input, so a task that is run again sends the same.

Cases: null and empty texts have 0 bytes and tokens; a text may be one pre-token; repeated rows and null ids are rows like
others; only the columns asked for and the text are read, whatever the others are named; an empty table gives no rows.
Pre-tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import WORD, byte_letters
from .common import configure, pack, slices, split, unpack, utf8

TEXT = "llm text"
SHARD_BYTES = 64 << 20          # of text, for each shard
SEND_BYTES = 4 << 20            # of new pre-tokens that a task gathers before it sends them
SENT_KEYS = 1 << 20             # hashes that a task remembers to have sent; beyond, it may send some again
TEXTS, FREQUENCIES, DOCUMENTS = 0, 1, 2
WORK = "kind int, shard int, block long, first binary, second binary"


class PreTokens:
    """Cuts texts into pre-tokens and counts the pieces of one."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f)["added_tokens"]]
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = regex.compile(WORD)
        self.added = added
        self.cut = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.letters = dict(enumerate(byte_letters()))

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """The pre-tokens of a text with their numbers, and how many added tokens it holds."""
        if not any(a in text for a in self.added):
            return Counter(self.words.findall(text)), 0
        parts = self.cut.split(text)
        found = Counter()
        for part in parts:
            found.update(self.words.findall(part))
        return found, len(parts) - 1

    def pieces(self, word: bytes) -> int:
        return len(self.model.tokenize(word.decode("latin-1").translate(self.letters)))


_loaded: dict[str, PreTokens] = {}


def pre_tokens(path: str) -> PreTokens:
    """The file's pre-tokens, one for each worker process."""
    if path not in _loaded:
        _loaded[path] = PreTokens(path)
    return _loaded[path]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "shard", "block", "first", "second"])


def _keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Sender:
    """The new pre-tokens of a task, sent to their shards in bounded lots."""

    def __init__(self, shards: int):
        self.shards, self.known, self.words, self.size = shards, set(), {}, 0

    def add(self, keys: list[int], words: list[bytes]) -> Iterator[tuple]:
        for key, word in zip(keys, words):
            if key not in self.known:
                self.known.add(key)
                self.words[key] = word
                self.size += len(word) + 8
        if self.size > SEND_BYTES:
            yield from self.flush()
        if len(self.known) > SENT_KEYS:
            self.known = set()

    def flush(self) -> Iterator[tuple]:
        keys = np.sort(np.array(list(self.words), np.uint64))
        for shard, a, b in split(keys, self.shards):
            words = [self.words[k] for k in keys[a:b].tolist()]
            lengths = np.array([len(w) for w in words], np.uint32)
            yield TEXTS, shard, None, pack(keys[a:b], lengths), zstandard.ZstdCompressor(level=1).compress(b"".join(words))
        self.words, self.size = {}, 0


def _block(texts: list[str], cutter: PreTokens, keep: pa.RecordBatch, number: int, shards: int, sender: Sender) -> Iterator[tuple]:
    """The rows of one block of texts."""
    place: dict[str, int] = {}
    at, times, sizes, extra = [], [], [], []
    for text in texts:
        found, added = cutter.frequencies(text)
        at += [place.setdefault(w, len(place)) for w in found]
        times += found.values()
        sizes.append(len(found))
        extra.append(added)
    words = [w.encode() for w in place]
    keys = _keys(words)
    yield from sender.add(keys.tolist(), words)
    order = np.argsort(keys)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    at = rank[np.array(at, np.int64)]
    by_key = np.argsort(at, kind="stable")                       # documents ascend within a pre-token
    at, times = at[by_key], np.array(times, np.uint32)[by_key]
    document = np.repeat(np.arange(len(texts), dtype=np.uint32), sizes)[by_key]
    holders = np.bincount(at, minlength=len(keys)).astype(np.uint32)
    ends = np.concatenate(([0], np.cumsum(holders, dtype=np.int64)))
    keys = keys[order]
    for shard, a, b in split(keys, shards):
        yield FREQUENCIES, shard, number, pack(keys[a:b], holders[a:b]), pack(document[ends[a]:ends[b]], times[ends[a]:ends[b]])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, keep.schema) as out:
        out.write_batch(keep)
    yield DOCUMENTS, number % shards, number, sink.getvalue().to_pybytes(), pack(np.array(extra, np.uint32))


def _sums(path: str):
    """Arrow batches of a shard, the texts first -> for each block, the sums of its documents that have pre-tokens of the shard; the
    rows of documents pass."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["kind"] == TEXTS:
                    keys, lengths = unpack(row["first"], "u8", "u4")
                    data, ends = zstandard.ZstdDecompressor().decompress(row["second"]), np.cumsum(lengths, dtype=np.int64)
                    at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
                    new = np.flatnonzero(known[at] != keys) if len(known) else np.arange(len(keys))
                    pieces = pre_tokens(path).pieces
                    found = [pieces(data[ends[k] - lengths[k]:ends[k]]) for k in new.tolist()]
                    known, counts = np.concatenate((known, keys[new])), np.concatenate((counts, np.array(found, np.uint32)))
                    order = np.argsort(known, kind="stable")
                    known, counts = known[order], counts[order]
                elif row["kind"] == FREQUENCIES:
                    keys, holders = unpack(row["first"], "u8", "u4")
                    document, times = unpack(row["second"], "u4", "u4")
                    pieces = np.repeat(counts[np.searchsorted(known, keys)], holders).astype(np.int64)
                    sums = np.bincount(document, pieces * times).astype(np.int64)       # exact: below 2 ** 53
                    have = np.flatnonzero(sums)
                    out.append((row["block"], None, pack(have.astype(np.uint32), sums[have])))
                else:
                    out.append((row["block"], row["first"], row["second"]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary()),
                                              pa.array([r[2] for r in out], pa.binary())], names=["block", "documents", "sums"])
    return each


def count_tokens(docs: DataFrame, path: str, keep: list[Column]) -> DataFrame:
    """The columns `keep`, n_bytes and n_tokens of each text. `path`: the vocabulary file, present on every machine."""
    configure(docs.sparkSession)
    shards = max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES))
    docs = docs.select(*keep, F.col("text").alias(TEXT))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, number = Sender(shards), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, TEXT):
                kept = pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(np.diff(utf8(part.column(TEXT))[1]), pa.int64())],
                                                  names=[*part.schema.names[:-1], "n_bytes"])
                texts = [t or "" for t in part.column(TEXT).to_pylist()]
                yield _rows(list(_block(texts, pre_tokens(path), kept, number, shards, sender)))
                number += 1
        yield _rows(list(sender.flush()))

    sums = (docs.mapInArrow(emit, WORK).repartitionById(shards, "shard").sortWithinPartitions("kind")
            .mapInArrow(_sums(path), "block long, documents binary, sums binary"))
    schema = T.StructType([*docs.schema.fields[:-1], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def total(block: pa.Table) -> pa.Table:
        rows = block.to_pylist()
        own = next(r for r in rows if r["documents"] is not None)
        n_tokens = unpack(own["sums"], "u4")[0].astype(np.int64)                        # added tokens
        for row in rows:
            if row["documents"] is None:
                have, some = unpack(row["sums"], "u4", "i8")
                n_tokens[have] += some
        return pa.ipc.open_stream(own["documents"]).read_all().append_column("n_tokens", pa.array(n_tokens, pa.int64()))

    return sums.groupBy("block").applyInArrow(total, schema)
