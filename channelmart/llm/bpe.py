"""Byte-level BPE by speculate and verify.

The vocabulary file of a public tokenizer gives the tokens and the order of merges; nothing is trained. A text is cut
at the added tokens and then into words by the tokenizer's pattern. For the words that a task has not met before:

1. greedy longest match over the words (one automaton for all tokens) proposes tokens;
2. array operations test every adjacent pair of proposed tokens of all words at once. Tokens a and b may stand side by
   side unless, while both are being built, some merge crosses the border between them: that is, a piece x of a's
   right edge and a piece y of b's left edge exist at the same time and the merge of x and y comes before the merges
   that end x and y. A sequence whose pairs all pass is what merging gives, as the first merge over a border would
   have to be one of these;
3. only words with a failing pair are merged exactly.

Decoding joins the tokens' bytes and reads them as UTF-8, with U+FFFD for bytes that are none.

Cases: null and empty texts have no tokens; a word may be as long as its text (exact merging is n log n); repeated
rows are encoded each; only the columns asked for and the text are read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame

from .common import configure, slices

# Fixed value: the word pattern of byte-level tokenizers.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_WORDS = 400_000
NEVER = np.iinfo(np.int64).max
_loaded: dict[str, Encoder] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: printable bytes stand for themselves, the others
    for the letters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in shown else next(other)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        vocabulary = file["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.size = 1 + max(*vocabulary.values(), *self.added.values())
        self.text = [b""] * self.size
        for token, i in vocabulary.items():
            self.text[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.added.items():
            self.text[i] = token.encode()
        self.atom = [vocabulary[c] for c in letters]
        self.merge = {}
        for rank, pair in enumerate(file["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merge.setdefault((vocabulary[left], vocabulary[right]), (rank, vocabulary[left + right]))
        self._edges(vocabulary)
        codes = np.array([a * self.size + b for a, b in self.merge], np.int64)
        order = np.argsort(codes)
        self.codes = codes[order]
        self.ranks = np.array([r for r, _ in self.merge.values()], np.int64)[order]
        self.words = regex.compile(WORD)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.cache: dict[str, bytes] = {}
        lengths = np.array([len(t) for t in self.text])
        self.bytes, self.lengths = np.frombuffer(b"".join(self.text), np.uint8), lengths
        self.begins = np.cumsum(lengths) - lengths

    def _edges(self, vocabulary: dict[str, int]) -> None:
        """Tables of the pieces along both edges of each token and of the rank at which each piece ends, and the
        automaton of the tokens that merging their own bytes gives."""
        parts: dict[int, tuple[int, int, int] | None] = {i: None for i in self.atom}
        for (left, right), (rank, whole) in self.merge.items():
            if left in parts and right in parts and whole not in parts and self.exact(self.text[whole]) == [whole]:
                parts[whole] = self.last
        right_edge, left_edge = [], []
        for i in range(self.size):
            for side, edges in ((1, right_edge), (0, left_edge)):
                edge, until, at = [], NEVER, i
                while at in parts:
                    edge.append((at, until))
                    if parts[at] is None:
                        break
                    until, at = parts[at][2], parts[at][side]
                edges.append(edge)
        depth = max(map(len, right_edge + left_edge))
        table = lambda edges, k, none: np.array([[x[k] for x in e] + [none] * (depth - len(e)) for e in edges], np.int64)
        self.right, self.right_until = table(right_edge, 0, -1), table(right_edge, 1, -1)
        self.left, self.left_until = table(left_edge, 0, -1), table(left_edge, 1, -1)
        self.automaton = ahocorasick.Automaton()
        for i in parts:
            self.automaton.add_word(self.text[i].decode("latin-1"), i)
        self.automaton.make_automaton()

    def exact(self, word: bytes) -> list[int]:
        """Merging by rank, leftmost first; leaves the last merge's parts and rank in self.last."""
        ids = [self.atom[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merge, self.last = self.merge, None
        heap = [(found[0], k, ids[k], ids[k + 1]) for k in range(n - 1) if (found := merge.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, k, a, b = heapq.heappop(heap)
            m = after[k]
            if ids[k] != a or m >= n or ids[m] != b:
                continue
            self.last = a, b, rank
            ids[k], ids[m] = merge[a, b][1], -1
            after[k] = after[m]
            if after[k] < n:
                before[after[k]] = k
                if found := merge.get((ids[k], ids[after[k]])):
                    heapq.heappush(heap, (found[0], k, ids[k], ids[after[k]]))
            if before[k] >= 0 and (found := merge.get((ids[before[k]], ids[k]))):
                heapq.heappush(heap, (found[0], before[k], ids[before[k]], ids[k]))
        return [i for i in ids if i >= 0]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the border between a and b, for each pair."""
        ok = np.ones(len(a), bool)
        for i in range(self.right.shape[1]):
            rows = np.flatnonzero(ok & (self.right[a, i] >= 0))
            if not len(rows):
                break
            for j in range(self.left.shape[1]):
                rows = rows[ok[rows] & (self.left[b[rows], j] >= 0)]
                if not len(rows):
                    break
                codes = self.right[a[rows], i] * self.size + self.left[b[rows], j]
                at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
                rank = np.where(self.codes[at] == codes, self.ranks[at], NEVER)
                ok[rows[(rank < self.right_until[a[rows], i]) & (rank <= self.left_until[b[rows], j]) & (rank < NEVER)]] = False
        return ok

    def propose(self, word: bytes) -> list[int]:
        return [i for _, i in self.automaton.iter_long(word.decode("latin-1"))]

    def encode_words(self, words: list[bytes]) -> tuple[list[list[int]], np.ndarray]:
        """Tokens of each word and which words had to be merged exactly."""
        found = [self.propose(w) for w in words]
        size = np.array([len(f) for f in found], np.int64)
        flat = np.array([i for f in found for i in f], np.int64)
        owner = np.repeat(np.arange(len(words)), size)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        code, index = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        fine = self.compatible(code // self.size, code % self.size)
        failing = np.unique(owner[inside[~fine[index]]])
        for k in failing:
            found[k] = self.exact(words[k])
        return found, failing

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self.cut.split(t) if self.cut and t else [t or ""] for t in texts]
        words = [[self.words.findall(p) if k % 2 == 0 else p for k, p in enumerate(ps)] for ps in parts]
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        new = list(set().union(*(ws for ps in words for ws in ps[::2])).difference(self.cache))
        found, _ = self.encode_words([w.encode() for w in new])
        for word, ids in zip(new, found):
            self.cache[word] = np.array(ids, "<u4").tobytes()
        known = self.cache.__getitem__
        return [b"".join(b"".join(map(known, w)) if k % 2 == 0 else self.added[w].to_bytes(4, "little") for k, w in enumerate(ps)) for ps in words]

    def decode(self, ids: bytes) -> str:
        at = np.frombuffer(ids, "<u4").astype(np.int64)
        size = self.lengths[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        data = self.bytes[np.arange(total) + np.repeat(self.begins[at] - (ends - size), size)]
        return data.tobytes().decode("utf-8", "replace")


def encoder(path: str) -> Encoder:
    """The file's encoder, one for each worker process."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, keep: list[Column], decoded: bool = False) -> DataFrame:
    """The columns `keep` and each text's `ids` (little-endian unsigned 32-bit integers); with `decoded`, also the
    text that decoding these ids gives. `path`: the vocabulary file, present on every machine."""
    configure(docs.sparkSession)
    docs = docs.select(*keep, "text")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema[:-1]] + ["ids binary"] + ["decoded string"] * decoded)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = encoder(path).encode(part.column("text").to_pylist())
                more = [pa.array([encoder(path).decode(i) for i in ids], pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary()), *more],
                                                 names=[*part.schema.names[:-1], "ids", *["decoded"] * decoded])
    return docs.mapInArrow(each, schema)
