"""Language identification by word-first backoff.

A word is a maximal run of ASCII letters and non-ASCII characters of the lower-cased text. Learning counts words by
language, and the character n-grams (5 to 1 bytes, with a mark at either end) of all words by language. A text's
words are scored by their log frequency in each language; a word that no learning text has falls back to its 5-grams,
if none of those is known to its 4-grams, and so on. The language with the largest sum is predicted, ties to the
first in alphabetical order; the score is its share of the softmax of the sums.

Counts leave each task combined by key and are stored as sorted hash arrays in the shared folder, which the scoring
tasks map into memory; the number of languages is the only thing that each entry grows with.

Cases: null language: not learned from; null or letterless text, or no learned language: `und` with score 0; a text
whose words and n-grams are all unknown gets the first language with an even share. Empty tables give no rows; other
columns than id, text and language are not read; repeated rows count and are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Counter, Rolling, SortedTable, combine, configure, exchange, merged, mix, runs, shards_of, shared_folder, slices, utf8

ORDERS = (5, 4, 3, 2, 1)
SMOOTHING = 0.5
LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True
ANY_LETTER = regex.compile(r"\p{L}")
GRAM_WORDS = 1 << 16


class Words:
    """Distinct words of some texts: sorted hashes, where one copy of each stands, and each occurrence's word."""

    def __init__(self, texts: pa.Array):
        self.data, offsets = utf8(pc.utf8_lower(pc.fill_null(texts, "")))
        starts, ends, self.first = runs(LETTER[self.data], offsets)
        found = Rolling(self.data)(starts, ends)
        self.keys, at, self.word = np.unique(found, return_index=True, return_inverse=True)
        self.starts, self.ends = starts[at], ends[at]

    def grams(self, which: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each order the n-grams of the words `which`, marked at both ends, and whose they are (index in which)."""
        size = self.ends[which] - self.starts[which] + 2
        at = np.concatenate(([0], np.cumsum(size)))
        marked = np.full(at[-1], 0x20, np.uint8)
        owner = np.repeat(np.arange(len(which)), size)
        inner = np.arange(at[-1]) - at[owner]
        letters = (inner > 0) & (inner < size[owner] - 1)
        marked[letters] = self.data[(self.starts[which][owner] + inner - 1)[letters]]
        rolling = Rolling(marked)
        for n in ORDERS:
            starts = np.flatnonzero(inner <= size[owner] - n)
            if n == 1:
                starts = np.flatnonzero(letters)
            yield n, mix(rolling(starts, starts + n) + np.uint64(n)), owner[starts]


@dataclass
class Model:
    words: SortedTable
    grams: SortedTable
    languages: list[str]
    word_totals: np.ndarray
    vocabulary: int
    gram_totals: np.ndarray
    gram_kinds: int

    def scores(self, w: Words) -> np.ndarray:
        """Log frequency by language (columns) of each distinct word."""
        *counts, known = self.words.find(w.keys)
        out = np.log((np.stack(counts, 1) + SMOOTHING) / (self.word_totals + SMOOTHING * (self.vocabulary + 1)))
        missing = np.flatnonzero(~known)
        for at in range(0, len(missing), GRAM_WORDS):
            which = missing[at:at + GRAM_WORDS]
            out[which] = self._backoff(w, which)
        return out

    def _backoff(self, w: Words, which: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros((len(which), len(self.languages))), np.ones(len(which), bool)
        for n, keys, owner in w.grams(which):
            use = open_[owner]
            keys, owner = keys[use], owner[use]
            distinct, index = np.unique(keys, return_inverse=True)
            *counts, known = self.grams.find(distinct)
            hit = known[index]
            index, owner = index[hit], owner[hit]
            log = np.log((np.stack(counts, 1) + SMOOTHING) / (self.gram_totals + SMOOTHING * (self.gram_kinds + 1)))
            n_known = np.bincount(owner, minlength=len(which))
            for k in range(len(self.languages)):
                out[:, k] += np.bincount(owner, log[index, k], minlength=len(which)) / np.maximum(n_known, 1)
            open_ &= n_known == 0
            if not open_.any():
                break
        return out


def fit(docs: DataFrame) -> Model:
    """The model of the texts of docs (text, lang); rows with a null language are left out."""
    spark = docs.sparkSession
    configure(spark)
    docs = docs.select("text", "lang").where(F.col("lang").isNotNull())
    languages = sorted(r[0] for r in docs.select("lang").distinct().collect())     # as many as there are languages
    shards, root = shards_of(spark), shared_folder(spark, "langid")
    columns = {f"n{k}": "u8" for k in range(len(languages))}
    words, grams = SortedTable(f"{root}/words", shards, columns), SortedTable(f"{root}/grams", shards, columns)
    kinds = ["u4"] * len(languages)

    def emit(batches: Iterator[pa.RecordBatch], gram: bool) -> Iterator[pa.RecordBatch]:
        counter = Counter(shards)
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"))
                lang = np.searchsorted(languages, np.array(part.column("lang").to_pylist(), dtype=object)) if len(languages) else None
                lang = np.repeat(lang, np.diff(w.first))
                counts = np.bincount(w.word * len(languages) + lang, minlength=len(w.keys) * len(languages)).reshape(len(w.keys), -1)
                if not gram:
                    yield from counter.add(w.keys, *counts.T.astype(np.uint32))
                    continue
                for at in range(0, len(w.keys), GRAM_WORDS):
                    which = np.arange(at, min(at + GRAM_WORDS, len(w.keys)))
                    for _, keys, owner in w.grams(which):
                        distinct, index = np.unique(keys, return_inverse=True)
                        by = [np.bincount(index, counts[which, k][owner], minlength=len(distinct)).astype(np.uint32) for k in range(len(languages))]
                        yield from counter.add(distinct, *by)
        yield from counter.flush()

    def store(table: SortedTable):
        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, *counts = merged(batches, *kinds)
            table.write(keys, dict(zip(columns, counts)))
            yield pa.RecordBatch.from_pydict({"kinds": [len(keys)], "totals": [[int(c.sum(dtype=np.int64)) for c in counts]]})
        return write

    def totals(gram: bool, table: SortedTable) -> tuple[int, np.ndarray]:
        rows = exchange(docs, lambda b: emit(b, gram), shards).mapInArrow(store(table), "kinds long, totals array<long>")
        sums = rows.agg(F.sum("kinds"), *(F.sum(F.col("totals")[k]) for k in range(len(languages)))).first()
        return int(sums[0] or 0), np.array([float(x or 0) for x in sums[1:]])

    if not languages:
        return Model(words, grams, [], np.zeros(0), 0, np.zeros(0), 0)
    vocabulary, word_totals = totals(False, words)
    gram_kinds, gram_totals = totals(True, grams)
    return Model(words, grams, languages, word_totals, vocabulary, gram_totals, gram_kinds)


def predict(docs: DataFrame, model: Model, keep: list[Column]) -> DataFrame:
    """The columns `keep` of docs, lang_pred and score of each text."""
    configure(docs.sparkSession)
    docs = docs.select(*keep, "text")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema[:-1]] + ["lang_pred string", "score double"])

    def labels(texts: pa.Array) -> tuple[list[str], np.ndarray]:
        w = Words(texts)
        has_letter = [bool(t) and ANY_LETTER.search(t) is not None for t in texts.to_pylist()]
        names, sums = np.array(model.languages, dtype=object), np.zeros((len(texts), len(model.languages)))
        by_word, owner = model.scores(w), np.repeat(np.arange(len(texts)), np.diff(w.first))
        for k in range(len(names)):
            sums[:, k] = np.bincount(owner, by_word[w.word, k], minlength=len(texts))
        best = sums.argmax(1)
        share = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
        return [names[b] if ok else "und" for b, ok in zip(best, has_letter)], np.where(has_letter, share, 0.0)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found, share = labels(part.column("text")) if model.languages else (["und"] * part.num_rows, np.zeros(part.num_rows))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.string()), pa.array(share)],
                                                 names=[*part.schema.names[:-1], "lang_pred", "score"])
    return docs.mapInArrow(each, schema)
