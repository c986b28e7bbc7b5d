"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

A text is lower-cased in A-Z and cut into words at white space; its shingles are runs of `words` words joined by a space
(a shorter text is one shingle, one without words has fingerprint zero). A fingerprint bit is 1 if it is set in over
half of the shingles' 64-bit hashes.

Fingerprints are linked at `bits` or fewer differing bits. The 64 bits are split into bits + 3 blocks, so a linked pair
agrees in three blocks at least: distinct fingerprints are joined on every choice of three blocks. Those that share a
choice are not compared in all pairs: a search from one fingerprint to the unvisited ones within the distance leaves
each after it is reached, so a dense group costs little more than its size and gives one link for each member, which
keeps all connections. Groups are the connected components of these links, found by hooking each fingerprint to
its smallest neighbour, following the hooks to their ends and contracting, until no link is left.

Copies share one fingerprint and are handled once. Cases: a null text has no words; a null id joins its group but names
it only if all ids are null; repeated rows are returned each; an empty table gives no rows; other columns are not read,
but stay in what one_of_each() returns. Of rows with equal ids the one with the smallest row_key (a hash of id and text)
represents the group, and equal rows are one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, OTHER_ID, OTHER_ROW, ROW, WHITE, configure, runs, shards_of, slices, stored, utf8

CLEAN_BLOCKS = 3
SEED = 42


def fingerprints_of(texts: pa.Array, words: int) -> np.ndarray:
    """The fingerprint of each text, as signed 64-bit integers."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, first = runs(~WHITE[data], offsets)
    out = np.zeros(len(texts), np.uint64)
    if not len(starts):
        return out.view(np.int64)
    kept = ~WHITE[data]                                 # the words and one space after each
    kept[ends[ends < len(data)]] = True
    data = np.where(WHITE[data], 0x20, data).astype(np.uint8)
    place = np.cumsum(kept) - kept
    buffer = data[kept].tobytes()
    starts, ends = place[starts], place[ends - 1] + 1
    n = np.diff(first)
    shingles = np.where(n > 0, np.maximum(n - words + 1, 1), 0)
    has = np.flatnonzero(n)
    at = np.cumsum(shingles) - shingles
    head = np.arange(int(shingles.sum())) + np.repeat(first[:-1] - at, shingles)
    tail = np.minimum(head + words, np.repeat(first[1:], shingles)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(buffer[a:b], SEED) for a, b in zip(starts[head].tolist(), ends[tail].tolist())), np.uint64, len(head))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.add.reduceat(bits, at[has], axis=0, dtype=np.int32)
    out[has] = np.packbits(2 * counts > shingles[has, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out.view(np.int64)


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, row_key and fingerprint (signed 64-bit integer) of each row."""
    configure(docs.sparkSession)
    docs = docs.select("doc_id", row_key().alias("row_key"), "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(fingerprints_of(part.column("text"), words))],
                                                 names=["doc_id", "row_key", "fingerprint"])
    return docs.mapInArrow(each, f"doc_id {docs.schema[0].dataType.simpleString()}, row_key long, fingerprint long")


def block_masks(bits: int) -> list[int]:
    """Masks of every choice of CLEAN_BLOCKS of the blocks, as signed integers."""
    cuts = np.linspace(0, 64, bits + CLEAN_BLOCKS + 1).round().astype(int).tolist()
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [int(np.uint64(sum(c)).view(np.int64)) for c in combinations(blocks, CLEAN_BLOCKS)]


def reach(prints: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """Links that connect whatever of the fingerprints is connected: each from a reached one to a newly reached one."""
    rest = prints
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            here = todo.pop()
            near = np.bitwise_count((rest ^ here).view(np.uint64)) <= bits      # of signed numbers it counts the absolute value's
            for other in (found := rest[near]):
                yield here, other
            todo.extend(found)
            rest = rest[~near]


def links(prints: DataFrame, bits: int) -> DataFrame:
    """Links (a, b) of distinct fingerprints at `bits` or fewer differing bits that keep all connections."""
    shards = shards_of(prints.sparkSession)
    keys = F.explode(F.array(*(F.xxhash64(F.lit(k), F.col("fingerprint").bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(block_masks(bits)))))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, value = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def found(key, value):
            pairs = []
            cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
            for k in np.flatnonzero(np.diff(cuts) > 1):
                pairs.extend(reach(value[cuts[k]:cuts[k + 1]], bits))
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

        for batch in batches:
            key, value = np.concatenate((key, batch.column(0).to_numpy())), np.concatenate((value, batch.column(1).to_numpy()))
            done = int(np.searchsorted(key, key[-1])) if len(key) else 0      # the last key may go on in the next batch
            if done:
                yield found(key[:done], value[:done])
                key, value = key[done:], value[done:]
        if len(key):
            yield found(key, value)

    return (prints.select(keys.alias("key"), "fingerprint").repartition(shards, "key").sortWithinPartitions("key")
            .mapInArrow(each, "a long, b long"))


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node of the pairs (a, b): one root for each connected component."""
    def ordered(df: DataFrame) -> DataFrame:
        return stored(df.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")

    todo = ordered(pairs)
    found = stored(todo.select("a").union(todo.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("root")), "nodes")
    while todo.limit(1).count():
        hooks = stored(todo.groupBy("a").agg(F.min("b").alias("to")), "hooks")
        while True:
            following = hooks.select(F.col("a").alias("to"), F.col("to").alias("next"))
            hooks = stored(hooks.join(following, "to", "left").select("a", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "hooks")
            moved = hooks.where("moved").limit(1).count()
            hooks = hooks.select("a", "to")
            if not moved:
                break
        ends = lambda column: hooks.select(F.col("a").alias(column), F.col("to").alias(f"{column}_end"))
        found = stored(found.join(ends("root"), "root", "left").select("node", F.coalesce("root_end", "root").alias("root")), "nodes")
        todo = ordered(todo.join(ends("a"), "a").join(ends("b"), "b", "left").select(F.col("a_end").alias("a"), F.coalesce("b_end", "b").alias("b")))
    return found


def near_duplicates(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """doc_id, row_key, fingerprint (signed 64-bit integer), component_id, the smallest doc_id of its group, and
    represents, whether it is the row with that id (and the smallest row_key) of each row."""
    rows = stored(fingerprints(docs, words), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    prints = stored(rows.groupBy("fingerprint").agg(first.alias("low")), "prints")
    groups = components(links(prints, bits)).withColumnRenamed("node", "fingerprint")
    linked = prints.join(groups, "fingerprint").select("fingerprint", "root", "low")
    lowest = linked.groupBy("root").agg(F.min("low").alias("lowest"))
    named = linked.join(lowest, "root").select("fingerprint", "lowest")
    every = prints.join(named, "fingerprint", "left").select("fingerprint", F.coalesce("lowest", "low").alias("first"))
    represents = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row_key") == F.col("first.row_key"))
    return (rows.join(stored(every, "groups"), "fingerprint")
            .select("doc_id", "row_key", "fingerprint", F.col("first.doc_id").alias("component_id"), represents.alias("represents")))


def one_of_each(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """The rows of docs that represent their group, with all their columns."""
    chosen = near_duplicates(docs, words, bits).where("represents").select(F.col("doc_id").alias(OTHER_ID), F.col("row_key").alias(OTHER_ROW))
    keyed = docs.withColumn(ROW, row_key())
    kept = keyed.join(chosen, keyed["doc_id"].eqNullSafe(chosen[OTHER_ID]) & (keyed[ROW] == chosen[OTHER_ROW]), "left_semi")
    return kept.dropDuplicates([ROW, "doc_id"]).drop(ROW)
