"""Personal data: fixed patterns, and terms that disclose them by corpus co-occurrence.

E-mail and IP addresses, card and phone numbers are found by their patterns; each distinct value is a protected entity.
A term is a run of letters of three characters or more outside them. A term co-occurs with the entities of its document,
however far apart they stand. With document counts over the whole corpus, the term t discloses the entity e by the share

    PMI(t; e) / IC(e) = log2(n(t, e) N / (n(t) n(e))) / log2(N / n(e)),

1 if the term never occurs without the entity. However few documents a pair is seen in, it is scored: by its share times
the confidence 1 - p ** (1 / DOUBT), p bounding the chance (Chernoff) that a term of n(t) documents meets the entity so often if they
are independent, which takes the information of the term and of the entity into account. A pair whose score reaches
GENERALISE_AT has its term sanitised wherever it stands, also in documents without the entity: from REMOVE_AT on the term is
removed, below it is generalised. So a term and an entity of one document each, p = 1 / N, are evidence from N = 5 ** DOUBT
documents on.

The documents of every term and entity are counted by packed exchange into a table that workers map. With it, pairs that
cannot reach GENERALISE_AT are known before they are sent; the others are summed for each task and then by their hashes, so
a frequent entity is many groups. Disclosing terms are a table that workers map, too, and each text is marked where it
is read. Nothing is collected.

Cases: a null text is empty; spans are in code points, end exclusive; upper and lower case are one term; equal rows have
equal spans and count each; a null id is an id like others; an empty table gives no rows; very long digit or letter runs
are scanned once; other columns pass through sanitise() under their own names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Counter, Rolling, SortedTable, configure, exchange, merged, runs, shards_of, shared_folder, slices, utf8

KINDS = ("email", "ip", "card", "phone", "term")
DOUBT = 4
PAIRS = 1 << 20
GENERALISE_AT = 0.8
REMOVE_AT = 0.95
MIN_TERM = 3

LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = re.compile(r"[A-Za-z\u0080-\U0010ffff]+")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True
SPAN = "array<struct<kind: string, start: int, end: int>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the pattern; each @ is looked at once, with the run of local characters before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARACTERS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches that pass their checks, in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def entity(kind: int, value: str) -> str:
    """The protected value without writing differences."""
    return f"{kind}:{value.lower() if kind == 0 else re.sub('[^0-9.]' if kind == 1 else '[^0-9]', '', value)}"


def hashes(words: list[str]) -> np.ndarray:
    """Hashes of the bytes, lower-cased in A-Z."""
    data, offsets = utf8(pa.array(words, pa.string()))
    return Rolling(LOWER[data])(offsets[:-1], offsets[1:])


class Terms:
    """The terms of some texts outside the pattern spans: of each occurrence the hash, the text and the span."""

    def __init__(self, texts: pa.Array, base: list[list[tuple[int, int, int]]]):
        data, offsets = utf8(pc.utf8_lower(pc.fill_null(texts, "")))           # code point by code point
        starts, ends, first = runs(LETTER[data], offsets)
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))        # code points that start before each byte
        covered = np.zeros(len(data) + 1, np.int64)
        for at, found in zip(offsets.tolist(), base):
            for a, _, b in found:
                a, b = np.searchsorted(points, (points[at] + a, points[at] + b), side="right") - 1
                covered[a + 1:b + 1] = 1
        covered = np.cumsum(covered)
        use = (points[ends] - points[starts] >= MIN_TERM) & (covered[ends] == covered[starts])
        self.text = np.repeat(np.arange(len(base)), np.diff(first))[use]
        self.hash = Rolling(data)(starts[use], ends[use])
        self.start, self.end = (points[x[use]] - points[offsets[self.text]] for x in (starts, ends))


def entities(texts: list[str | None], base: list[list[tuple[int, int, int]]]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each pattern span's entity and the text it is in."""
    return (hashes([entity(k, text[a:b]) for text, found in zip(texts, base) for a, k, b in found]),
            np.repeat(np.arange(len(base)), [len(found) for found in base]))


def each_once(hash_: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and in how many of the texts each occurs."""
    distinct, index = np.unique(hash_, return_inverse=True)
    return distinct, np.bincount(np.unique(index * texts + text) // max(1, texts), minlength=len(distinct)).astype(np.uint32)


def documents(docs: DataFrame) -> SortedTable:
    """In how many rows each term and each entity of the corpus occurs."""
    shards = shards_of(docs.sparkSession)
    table = SortedTable(shared_folder(docs.sparkSession, "pii"), shards, {"documents": "u8"})

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shards)
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                base = [base_spans(t or "") for t in texts]
                terms = Terms(part.column("text"), base)
                yield from counter.add(*each_once(terms.hash, terms.text, len(texts)))
                yield from counter.add(*each_once(*entities(texts, base), len(texts)))
        yield from counter.flush()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = merged(batches, "u4")
        table.write(keys, {"documents": n})
        yield pa.RecordBatch.from_pydict({"kinds": [len(keys)]})
    exchange(docs.select("text"), emit, shards).mapInArrow(write, "kinds long").agg(F.sum("kinds")).first()
    return table


def candidates(docs: DataFrame, table: SortedTable, total: int) -> DataFrame:
    """(entity, term, holders, documents, together): the pairs that share a row, summed for each task. A pair that could
    not reach GENERALISE_AT even if the term or the entity never occurred without the other is not sent."""
    names = ["entity", "term", "holders", "documents", "together"]
    evidence = -DOUBT * math.log2(1 - GENERALISE_AT) * (1 - 1e-9)

    def summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        e, t, holders, documents, n = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((t, e))
        first = np.flatnonzero(np.concatenate(([True], (np.diff(e[order]) != 0) | (np.diff(t[order]) != 0))))
        at = order[first]
        return e[at], t[at], holders[at], documents[at], np.add.reduceat(n[order], first)

    def batches_of(columns: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(columns[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[at:at + (1 << 16)].astype(np.uint64).view(np.int64)) for c in columns], names=names)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                base = [base_spans(t or "") for t in texts]
                with_one = [k for k, found in enumerate(base) if found]
                if not with_one:
                    continue
                texts, base = [texts[k] for k in with_one], [base[k] for k in with_one]
                terms = Terms(pa.array(texts, pa.string()), base)
                keys, index = np.unique(terms.hash, return_inverse=True)
                counts = table.find(keys)[0]
                cuts = np.searchsorted(terms.text, np.arange(len(texts) + 1))
                found, text = entities(texts, base)
                entity_keys, entity_index = np.unique(found, return_inverse=True)
                holders, entity_cuts = table.find(entity_keys)[0], np.searchsorted(text, np.arange(len(texts) + 1))
                for k in range(len(texts)):
                    mine = np.unique(index[cuts[k]:cuts[k + 1]])
                    t, n = keys[mine], counts[mine]
                    for e in np.unique(entity_index[entity_cuts[k]:entity_cuts[k + 1]]):
                        h = int(holders[e])
                        if h >= total:
                            continue
                        may = (n <= total * (h / total) ** GENERALISE_AT * (1 + 1e-9)) & (n * math.log2(total / h) >= evidence)
                        if some := int(may.sum()):
                            parts.append((np.full(some, entity_keys[e]), t[may], np.full(some, h, np.uint64), n[may], np.ones(some, np.uint64)))
                            size += some
                            if size > PAIRS:
                                parts = [summed(parts)]
                                size = len(parts[0][0])
                                if size > PAIRS // 2:
                                    yield from batches_of(parts[0])
                                    parts, size = [], 0
        if parts:
            yield from batches_of(summed(parts))
    return docs.select("text").mapInArrow(emit, ", ".join(f"{n} long" for n in names))


def score(total: int) -> Column:
    """Share of the entity's information that the term discloses, times the confidence that it is no chance."""
    n, t, e, both = F.lit(float(total)), F.col("documents"), F.col("holders"), F.col("together")
    pmi = F.log2(both * n / (t * e))
    without = F.when(t > both, (t - both) * F.log2((1 - both / t) / (1 - e / n))).otherwise(0.0)
    return pmi / F.log2(n / e) * (1 - F.pow(F.lit(2.0), -(both * pmi + without) / DOUBT))


def disclosing(docs: DataFrame) -> SortedTable | None:
    """The terms that are to be sanitised: 1 for those that are generalised, 2 for those that are removed."""
    total = docs.count()
    if not total:
        return None
    pairs = (candidates(docs, documents(docs), total).groupBy("entity", "term")
             .agg(F.max("holders").alias("holders"), F.max("documents").alias("documents"), F.sum("together").alias("together")))
    flagged = (pairs.select("term", score(total).alias("score")).where(F.col("score") >= GENERALISE_AT)
               .groupBy("term").agg((1 + (F.max("score") >= REMOVE_AT).cast("int")).alias("level")))
    shards = shards_of(docs.sparkSession)
    table = SortedTable(shared_folder(docs.sparkSession, "disclosing"), shards, {"level": "u1"})

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shards)
        for batch in batches:
            yield from counter.add(batch.column("term").to_numpy().view(np.uint64), batch.column("level").to_numpy().astype(np.uint32))
        yield from counter.flush()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, level = merged(batches, "u4")
        table.write(keys, {"level": level})
        yield pa.RecordBatch.from_pydict({"terms": [len(keys)]})
    return table if exchange(flagged, emit, shards).mapInArrow(write, "terms long").agg(F.sum("terms")).first()[0] else None


def marked(texts: pa.Array, flagged: SortedTable | None) -> tuple[list[list[tuple]], list[list[tuple]]]:
    """The pattern spans of each text, and with them those of the flagged terms: (start, kind, end, removed) in order."""
    base = [base_spans(t or "") for t in texts.to_pylist()]
    spans = [[(a, k, b, False) for a, k, b in found] for found in base]
    if flagged is not None:
        terms = Terms(texts, base)
        keys, index = np.unique(terms.hash, return_inverse=True)
        level = flagged.find(keys)[0][index]
        for at in np.flatnonzero(level).tolist():
            spans[terms.text[at]].append((int(terms.start[at]), KINDS.index("term"), int(terms.end[at]), bool(level[at] == 2)))
    return base, [sorted(s) for s in spans]


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, base and spans (all, with those of disclosing terms; removed: whether a span's text goes) of
    each row, in the order of start and kind."""
    configure(docs.sparkSession)
    flagged = disclosing(docs)
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    schema = f"doc_id {docs.schema[0].dataType.simpleString()}, row_key long, base {SPAN}, spans {SPAN.replace('>>', ', removed: boolean>>')}"
    fields = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                base, found = marked(part.column("text"), flagged)
                base = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in s] for s in base]
                found = [[{"kind": KINDS[k], "start": a, "end": b, "removed": r} for a, k, b, r in s] for s in found]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row_key"), pa.array(base, pa.list_(pa.struct(fields))),
                                                  pa.array(found, pa.list_(pa.struct([*fields, ("removed", pa.bool_())])))], names=["doc_id", "row_key", "base", "spans"])
    return docs.mapInArrow(each, schema)


def redact(text: str, found: list[dict]) -> str:
    """The text with each span as its kind in brackets; generalised terms as [word], removed ones as nothing. Where
    spans overlap the first one stands for all."""
    out, at = [], 0
    for s in found:
        if s["start"] >= at:
            out += [text[at:s["start"]], "" if s["removed"] else "[word]" if s["kind"] == "term" else f"[{s['kind']}]"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame) -> DataFrame:
    """docs with the texts redacted; rows and other columns as they are."""
    configure(docs.sparkSession)
    flagged = disclosing(docs)
    at = docs.columns.index("text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column(at)
                found = [[{"kind": KINDS[k], "start": a, "end": b, "removed": r} for a, k, b, r in s] for s in marked(texts, flagged)[1]]
                columns = list(part.columns)
                columns[at] = pa.array([redact(t, s) if t and s else t for t, s in zip(texts.to_pylist(), found)], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)
    return docs.mapInArrow(each, docs.schema)
