"""Language-model scoring: an interpolated modified Kneser-Ney model of word pairs (order 2).

Texts are lower-cased in A-Z; tokens are the words between white space, then one end token for each text; the first
token is conditioned on a start symbol that is never predicted. Tokens and pairs are 64-bit hashes.

Fitting reads the learning texts twice, each time with one exchange of packed counts by key range:

1. pairs are counted and stored as sorted hash arrays in the shared folder;
2. every occurrence of a pair with count c gives 1/c to the number of distinct pairs of its context and of its word
   (so each distinct pair counts once), which yields the context's numbers of successors seen once, twice and more
   often, and the word's number of distinct predecessors. Exchanging pairs by context or by word is thus not needed,
   and a frequent context is one entry for each task.

Scoring maps both tables into memory and looks up the sorted distinct pairs of each slice of texts. Discounts and
totals are a handful of numbers. The tables grow with the learning texts and are never sent through the driver.

Cases: a null text is the empty text, whose only token is the end. An unknown word gets the share of the uniform
distribution that the word level leaves over; after an unknown context the word level is used alone. Without any
learning text each token's probability is 1 (base and score 0). Repeated rows are scored and counted each; columns
other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (LOWER, WHITE, Counter, Rolling, SortedTable, configure, exchange, merged, mix, runs, shards_of,
                     shared_folder, slices, utf8)

END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
MANY = 255


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts, one after the other, and the index of each text's first token."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, first = runs(~WHITE[data], offsets)
    out = np.empty(len(starts) + len(texts), np.uint64)
    last = first[1:] + np.arange(len(texts))
    word = np.ones(len(out), bool)
    word[last] = False
    out[word] = Rolling(data)(starts, ends)
    out[last] = END
    return out, np.concatenate(([0], last[:-1] + 1))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0xBF58476D1CE4E5B9) + word)


class Pairs:
    """Distinct symbols and distinct pairs of the texts, with the index of each token's symbol and pair."""

    def __init__(self, texts: pa.Array):
        toks, self.first = tokens(texts)
        self.symbols, index = np.unique(np.concatenate((toks, [START])), return_inverse=True)
        self.start, self.word = index[-1], index[:-1]
        before = np.concatenate(([self.start], self.word[:-1]))
        before[self.first] = self.start
        both, pair = np.unique(before * len(self.symbols) + self.word, return_inverse=True)
        keys = pair_keys(self.symbols[both // len(self.symbols)], self.symbols[both % len(self.symbols)])
        order = np.argsort(keys)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.keys, self.pair, both = keys[order], rank[pair], both[order]
        self.pair_before, self.pair_word = both // len(self.symbols), both % len(self.symbols)
        self.pair_times = np.bincount(self.pair, minlength=len(self.keys))


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D1, D2 and D3+ of Chen and Goodman from the numbers of entries with counts 1 to 4; where the estimate is
    undefined or out of range (tiny corpora) 0.5, 1 and 1.5."""
    fallback = (0.5, 1.0, 1.5)
    if not all(n):
        return fallback
    y = n[0] / (n[0] + 2 * n[1])
    found = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
    return found if all(0 < d <= k for k, d in enumerate(found, 1)) else fallback


@dataclass
class Model:
    pairs: SortedTable
    often: SortedTable
    symbols: SortedTable
    train_tokens: int
    vocabulary: int
    pair_discounts: tuple
    word_discounts: tuple
    word_pairs: int
    word_classes: tuple

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted pair keys."""
        small, _ = self.pairs.find(keys)
        out = small.astype(np.int64)
        many = np.flatnonzero(small == MANY)
        if len(many):
            out[many] = self.often.find(keys[many])[0]
        return out

    def word_probability(self, predecessors: np.ndarray) -> np.ndarray:
        """Of words with these numbers of distinct predecessors."""
        if not self.word_pairs:
            return np.full(len(predecessors), 1 / (self.vocabulary + 1))
        cut = np.array((0.0, *self.word_discounts))[np.minimum(predecessors, 3)]
        spare = sum(d * n for d, n in zip(self.word_discounts, self.word_classes)) / self.word_pairs
        return np.maximum(predecessors - cut, 0) / self.word_pairs + spare / (self.vocabulary + 1)

    def log10(self, p: Pairs) -> tuple[np.ndarray, np.ndarray]:
        """log10 of each distinct pair's probability; the learning count of each symbol."""
        count, once, twice, more, predecessors, _ = self.symbols.find(p.symbols)
        count, predecessors = count.astype(np.int64), predecessors.astype(np.int64)
        low = self.word_probability(predecessors)
        total = np.maximum(count, 1).astype(float)
        d1, d2, d3 = self.pair_discounts
        spare = np.where(count > 0, (d1 * once + d2 * twice + d3 * more) / total, 1.0)
        c = self.counts(p.keys)
        top = np.maximum(c - np.array((0.0, d1, d2, d3))[np.minimum(c, 3)], 0) / total[p.pair_before]
        return np.log10(top + spare[p.pair_before] * low[p.pair_word]), np.where(p.symbols == START, 0, count)


def fit(texts: DataFrame) -> Model:
    """The model of the texts in column text."""
    spark = texts.sparkSession
    configure(spark)
    shards, root = shards_of(spark), shared_folder(spark, "lm")
    pairs = SortedTable(f"{root}/pairs", shards, {"count": "u1"})
    often = SortedTable(f"{root}/often", shards, {"count": "u8"})
    symbols = SortedTable(f"{root}/symbols", shards, {"count": "u8", "once": "u4", "twice": "u4", "more": "u4", "predecessors": "u4"})
    texts = texts.select("text")

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shards)
        for batch in batches:
            for part in slices(batch):
                toks, first = tokens(part.column("text"))
                before = np.concatenate(([START], toks[:-1]))
                before[first] = START
                yield from counter.add(pair_keys(before, toks), np.ones(len(toks), np.uint32))
        yield from counter.flush()

    def store_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, count = merged(batches, "u4")
        many = count >= MANY
        pairs.write(keys, {"count": np.minimum(count, MANY)})
        often.write(keys[many], {"count": count[many]})
        yield pa.RecordBatch.from_pydict({f"n{k}": [int((count == k).sum())] for k in (1, 2, 3, 4)})

    def total(df: DataFrame) -> list[int]:
        return [int(x or 0) for x in df.agg(*(F.sum(c) for c in df.columns)).first()]

    pair_classes = total(exchange(texts, count_pairs, shards).mapInArrow(store_pairs, "n1 long, n2 long, n3 long, n4 long"))
    model = Model(pairs, often, symbols, 0, 0, discounts(pair_classes), (), 0, ())

    def count_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shards)
        for batch in batches:
            for part in slices(batch):
                p = Pairs(part.column("text"))
                c, n = model.counts(p.keys), len(p.symbols)
                times, share = p.pair_times, p.pair_times / np.maximum(c, 1)
                by = lambda index, weights: np.bincount(index, weights, minlength=n)
                count = np.bincount(p.word, minlength=n)
                count[p.start] = len(p.first)
                yield from counter.add(
                    p.symbols, count.astype("u4"), by(p.pair_before, times * (c == 1)).astype("u4"), by(p.pair_before, times * (c == 2)).astype("u4"),
                    by(p.pair_before, share * (c > 2)), by(p.pair_word, share))
        yield from counter.flush()

    def store_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, count, once, twice, more, predecessors = merged(batches, "u4", "u4", "u4", "f8", "f8")
        predecessors = np.rint(predecessors).astype(np.int64)
        symbols.write(keys, {"count": count, "once": once, "twice": twice // 2, "more": np.rint(more), "predecessors": predecessors})
        word = keys != START
        out = {"tokens": int(count[word].sum(dtype=np.int64)), "vocabulary": int(word.sum()), "pairs": int(predecessors.sum())}
        out |= {f"n{k}": int((predecessors == k).sum()) for k in (1, 2, 3, 4)} | {"more": int((predecessors > 2).sum())}
        yield pa.RecordBatch.from_pydict({k: [v] for k, v in out.items()})

    names = ("tokens", "vocabulary", "pairs", "n1", "n2", "n3", "n4", "more")
    found = total(exchange(texts, count_symbols, shards).mapInArrow(store_symbols, ", ".join(f"{n} long" for n in names)))
    model.train_tokens, model.vocabulary, model.word_pairs = found[:3]
    model.word_discounts, model.word_classes = discounts(found[3:7]), (found[3], found[4], found[7])
    return model


def score(docs: DataFrame, model: Model, keep: list[Column]) -> DataFrame:
    """The columns `keep` of docs and, for each text: n_tokens, n_known, train_tokens, base_score (the smoothed word
    counts' log10 probability), score (the model's) and perplexity."""
    configure(docs.sparkSession)
    docs = docs.select(*keep, "text")
    kept = docs.schema[:-1]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
                       + ["n_tokens long", "n_known long", "train_tokens long", "base_score double", "score double", "perplexity double"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                p = Pairs(part.column("text"))
                log, count = model.log10(p)
                base = np.log10((count + 0.1) / (model.train_tokens + 0.1 * (model.vocabulary + 1)))
                n = np.diff(np.concatenate((p.first, [len(p.word)])))
                score = np.add.reduceat(log[p.pair], p.first)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:-1], pa.array(n, pa.int64()), pa.array(np.add.reduceat((count > 0)[p.word].astype(np.int64), p.first)),
                    pa.array(np.full(len(n), model.train_tokens, np.int64)), pa.array(np.add.reduceat(base[p.word], p.first)),
                    pa.array(score), pa.array(10 ** np.minimum(-score / n, 300))],
                    names=[*part.schema.names[:-1], "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])
    return docs.mapInArrow(each, schema)
