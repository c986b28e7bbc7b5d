"""Packing of tokenised texts into windows by best-fit decreasing.

Texts are tokenised by the public tokenizer, the end id follows, and an overlong text is first cut into full windows.
The pieces are written once and dealt by a hash of id and start over groups of about GROUP_WINDOWS windows, as many as their
ids ask for. In a group the longest piece comes first; a segment tree over remaining capacities finds the tightest open
window that takes it, else a window is opened. Only the lengths are exchanged, unless the ids are asked for. What a group
leaves unfilled, beside what no shorter piece fits, is its last windows: few beside GROUP_WINDOWS, whatever the session's
settings and the size of the table.

Cases: a null text is empty and gives one piece, the end id; an id may be null or repeated (each row has its own
pieces); other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import configure, slices, stored

# Fixed value: the pieces of the lower-casing tokenizer's words, for lower-case ASCII and Latin-1; a line end separates words.
PIECES = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\na-z0-9ß-öø-ÿ]+")
OTHER = re.compile(r"[^\n!-~\u00c0-\u00ff]|<\|")
BETWEEN = b"\xff" * 4        # within no ids: the high byte of an id is never ff
LETTERS = {b: c for b, c in enumerate(byte_letters()) if b != 10}
WORD_BYTES, PIECE_BYTES = 128 << 20, 48 << 20      # of words and of pieces that a worker keeps
ENTRY = 200                 # bytes of an entry besides its key's and value's: two objects and a place in the table
GROUP_WINDOWS = 2000
GROUP_IDS = 1 << 32
_loaded: dict[str, WordEncoder] = {}


class Cache:
    """Ids by word or piece within a number of bytes, in two halves: when the young one is full it becomes the old one, and
    what is found in the old one is put into the young one again; so frequent words stay."""

    def __init__(self, limit: int):
        self.limit, self.size, self.young, self.old = limit // 2, 0, {}, {}

    def put(self, found: dict) -> None:
        more = sum(map(len, found)) + sum(map(len, found.values())) + ENTRY * len(found)
        if self.size + more > self.limit:
            self.young, self.old, self.size = {}, self.young, 0
        if more <= self.limit:
            self.young.update(found)
            self.size += more

    def known(self, keys) -> dict:
        """Those of the distinct keys that are known, from now on young."""
        young = {k: self.young[k] for k in keys if k in self.young}
        old = {k: self.old[k] for k in keys if k in self.old and k not in young}
        if old:
            self.put(old)
        return young | old


class WordEncoder:
    """Ids of texts by the tokenizers library. The library's lower-casing tokenizer drops white space and never joins
    what stands on either side of it, so each distinct word between ASCII white space is encoded once.

    Words of ASCII and Latin-1 letters are lower-cased and cut into pieces here, as the library does it for these
    characters, and each distinct piece goes through the library's model; other words, and those with what could be a
    special token, go through the library whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.cache, self.pieces = Cache(WORD_BYTES), Cache(PIECE_BYTES)

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words."""
        joined = b"\n".join(words).decode()
        ids = {}
        if OTHER.search(joined):
            texts = joined.split("\n")
            whole = [k for k, t in enumerate(texts) if OTHER.search(t)]
            encoded = self.tokenizer.encode_batch_fast([texts[k] for k in whole], add_special_tokens=False)
            ids = {words[k]: array("I", e.ids).tobytes() for k, e in zip(whole, encoded)}
            words = [w for w in words if w not in ids]
            joined = b"\n".join(words).decode()
        if not words:
            return ids
        found = PIECES.findall(joined.lower())
        kinds = set(found).difference("\n")
        known = self.pieces.known(kinds)
        new = list(kinds.difference(known))
        spelt = "\n".join(new).encode().decode("latin-1").translate(LETTERS).split("\n") if new else []
        tokenize = self.model.tokenize
        made = {piece: array("I", [t.id for t in tokenize(s)]).tobytes() for piece, s in zip(new, spelt)}
        self.pieces.put(made)
        known |= made
        known["\n"] = BETWEEN
        ids.update(zip(words, b"".join(map(known.__getitem__, found)).split(BETWEEN)))
        return ids

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text (UTF-8) as little-endian unsigned 32-bit integers."""
        words = [(t or b"").split() for t in texts]
        young = self.cache.young
        found = [list(map(young.get, ws)) for ws in words]
        missing = [[k for k, ids in enumerate(f) if ids is None] for f in found]
        distinct = {ws[k] for ws, ks in zip(words, missing) for k in ks}
        known = self.cache.known(distinct)
        new = self.encode_words(list(distinct.difference(known)))
        self.cache.put(new)
        known |= new
        for ws, f, ks in zip(words, found, missing):
            for k in ks:
                f[k] = known[ws[k]]
        return [b"".join(f) for f in found]


def word_encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


class Windows:
    """Open windows by remaining capacity: a segment tree whose leaf c counts the windows with c ids left."""

    def __init__(self, size: int):
        self.size, self.leaves = size, 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.count = 0

    def _add(self, capacity: int, by: int) -> None:
        at = self.leaves + capacity
        while at:
            self.tree[at] += by
            at >>= 1

    def _tightest(self, length: int) -> int:
        """The least capacity of at least `length` that a window has, or -1."""
        at = self.leaves + length
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return -1
            at += 1
            while at < self.leaves:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.leaves

    def place(self, length: int) -> tuple[int, int]:
        """The window that takes a piece and the place in it."""
        capacity = self._tightest(length)
        if capacity < 0:
            capacity, window = self.size, self.count
            self.count += 1
        else:
            window = self.open[capacity].pop()
            self._add(capacity, -1)
        if capacity > length:
            self.open[capacity - length].append(window)
            self._add(capacity - length, 1)
        return window, self.size - capacity


def pieces(docs: DataFrame, path: str, end_id: int, window: int, with_ids: bool = False) -> DataFrame:
    """Each text's ids, cut at the multiples of `window`: doc_id, start, length, ids_crc32, doc_tokens and, if asked
    for, ids."""
    configure(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    schema = f"doc_id {docs.schema[0].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, step = int(end_id).to_bytes(4, "little"), 4 * window
        for batch in batches:
            for part in slices(batch):
                ids = [i + end for i in word_encoder(path).encode(part.column("text").cast(pa.binary()).to_pylist())]
                cuts = [(k, at) for k, i in enumerate(ids) for at in range(0, len(i), step)]
                chunks = [ids[k][at:at + step] for k, at in cuts]
                columns = [part.column("doc_id").take(pa.array([k for k, _ in cuts], pa.int64())), pa.array([at // 4 for _, at in cuts], pa.int64()),
                           pa.array([len(c) // 4 for c in chunks], pa.int64()), pa.array([zlib.crc32(c) for c in chunks], pa.int64()),
                           pa.array([len(ids[k]) // 4 for k, _ in cuts], pa.int64())]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(chunks, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)
    return docs.mapInArrow(each, schema)


def pack(cut: DataFrame, window: int) -> DataFrame:
    """The rows of pieces() with sequence_id and offset."""
    cut = stored(cut, "pieces")
    groups = max(1, (cut.agg(F.sum("length")).first()[0] or 0) // (GROUP_WINDOWS * window))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, open_ = TaskContext.get().partitionId() * GROUP_IDS, Windows(window)
        for batch in batches:
            placed = [open_.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + w for w, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=[*batch.schema.names, "sequence_id", "offset"])
    return (cut.repartition(groups, "doc_id", "start")
            .sortWithinPartitions(F.col("length").desc(), "doc_id", "start", "ids_crc32").mapInArrow(each, schema))
