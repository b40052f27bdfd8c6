"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are reduced to distinct ones, then dealt into buckets by the
pigeonhole principle: two fingerprints that differ in at most ``r`` bits agree
on one of ``r + 1`` parts of the bits.  A bucket (mask, value) that holds more
than ``MOST_IN_BUCKET`` distinct fingerprints is dealt again by ``r + 1`` parts
of its free bits, up to ``DEALS`` times; one that is still larger (a dense ball
of fingerprints) is compared in blocks, each pair of blocks in its own group.
No link is lost either way.

Inside a bucket fingerprints stand in order of their Gray rank.  Each run of
``FAN`` neighbours gets a node that keeps the bits they all share (mask and
value), runs of nodes get nodes in turn.  A search goes down from the top and
adds up, per query, the differing bits that each node's own mask shows; a node
whose sum passes the limit is cut with all below it.

Only links that join two parts of a bucket leave the task (a spanning forest),
so a large group of near copies yields no more links than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WORDS, MOST_BITS, SEED = 3, 3, 42
MOST_IN_BUCKET, FAN, DEALS = 1024, 8, 3
#: Shingles hashed and queries searched at a time.
SHINGLES, QUERIES = 1 << 16, 2048


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The 64-bit fingerprint of a text, as a signed number."""
    parts = text.lower().split()  # of bytes: lowers A-Z, splits at 0x20 and 0x09 to 0x0D
    if not parts:
        return 0
    joined = b" ".join(parts)
    length = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(length + 1) - 1
    starts = ends - length
    width = min(words, len(parts))
    n = len(parts) - width + 1
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, SHINGLES):
        to = min(n, at + SHINGLES)
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at:to].tolist(), ends[at + width - 1:to + width - 1].tolist())])
        set_bits += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big", signed=True)


def _text_hash(text) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _hashed(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; a NULL text counts as empty (fingerprint 0)."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            found = [fingerprint(t, words) for t in common.encoded(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], schema=schema)

    rows = common.narrow(docs, doc_id="long", text="string").select("doc_id", _text_hash(F.col("text")).alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp) of every row; a NULL text counts as empty (fingerprint 0)."""
    return _hashed(docs, words).select("doc_id", "fp")


def parts_of(mask: int, parts: int) -> list[int]:
    """``mask`` with one of ``parts`` runs of its free bits added, for each run."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = np.linspace(0, len(free), parts + 1).astype(int)
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:])]


def _deal(parts: int):
    """Rows (mask, fp) to rows (mask, value, fp), one for each part of the free bits."""
    schema = pa.schema([("mask", pa.int64()), ("value", pa.int64()), ("fp", pa.int64())])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for m in np.unique(mask):
                own = fp[mask == m]
                for child in parts_of(int(m) & (1 << 64) - 1, parts):
                    child = np.full(len(own), _signed(child), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(own & child), pa.array(own)], schema=schema)

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(column: str):
    """Position of a 64-bit word in the reflected Gray sequence."""
    x = F.col(column)
    for step in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, step))
    return x


class GrayIndex:
    """The hierarchy over codes in Gray order; ``bucket`` numbers runs of codes that may be compared."""

    def __init__(self, codes: np.ndarray, bucket: np.ndarray):
        self.codes, n = codes, len(codes)
        self.levels = []  # from the leaves up: value, mask, first child, children, last leaf
        value, known = codes, np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
        last = np.arange(n)
        self.levels.append((value, known, None, None, last))
        while len(value) > 1 and (bucket[1:] == bucket[:-1]).any():
            new = np.r_[True, bucket[1:] != bucket[:-1]]
            place = np.arange(len(value)) - np.maximum.accumulate(np.where(new, np.arange(len(value)), 0))
            starts = np.flatnonzero(place % FAN == 0)
            ones = np.bitwise_and.reduceat(value & known, starts)
            zeros = np.bitwise_and.reduceat(~value & known, starts)
            children = np.diff(np.r_[starts, len(value)])
            value, known = ones, ones | zeros
            bucket, last = bucket[starts], last[starts + children - 1]
            self.levels.append((value, known, starts, children, last))
        self.top_of_bucket = bucket
        # a node answers for the shared bits that its parent doesn't
        self.own = [None] * len(self.levels)
        self.own[-1] = self.levels[-1][1]
        for k in range(len(self.levels) - 1, 0, -1):
            _, known, _, children, _ = self.levels[k]
            self.own[k - 1] = self.levels[k - 1][1] & ~np.repeat(known, children)

    def search(self, queries: np.ndarray, roots: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later leaf) that differ in at most ``most`` bits; queries and leaves are positions."""
        q, node = queries, roots
        differing = np.zeros(len(q), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            value, _, first, children, last = self.levels[k]
            differing = differing + np.bitwise_count((self.codes[q] ^ value[node]) & self.own[k][node])
            stay = (differing <= most) & (last[node] > q)
            q, node, differing = q[stay], node[stay], differing[stay]
            if k:
                count = children[node]
                within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                node = np.repeat(first[node], count) + within
                q, differing = np.repeat(q, count), np.repeat(differing, count)
        return q, node


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _begins(key: list[np.ndarray]) -> np.ndarray:
    """True where a row's key is not that of the row before."""
    return np.r_[True, np.any([k[1:] != k[:-1] for k in key], axis=0)]


def bucket_links(key: list[np.ndarray], codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each run of equal keys."""
    bucket = np.cumsum(_begins(key)) - 1
    index = GrayIndex(codes, bucket)
    label = np.arange(len(codes))
    crowded = np.flatnonzero(np.bincount(bucket)[bucket] > 1)
    root = np.searchsorted(index.top_of_bucket, bucket)
    for at in range(0, len(crowded), QUERIES):
        q = crowded[at:at + QUERIES]
        _union(label, *index.search(q, root[q], most))
    far = np.flatnonzero(label != np.arange(len(codes)))
    return codes[far], codes[label[far]]


def _search_sorted(most: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(held: list[np.ndarray]):
        u, v = bucket_links(held[:-1], held[-1].view(np.uint64), most)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], schema=schema)

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4
        for batch in batches:
            held = [np.r_[h, c.to_numpy(zero_copy_only=False)] for h, c in zip(held, batch.columns)]
            if not len(held[0]):
                continue
            last = int(np.flatnonzero(_begins(held[:-1]))[-1])
            if last >= 4096:  # the last bucket may go on in the next batch
                yield links([h[:last] for h in held])
                held = [h[last:] for h in held]
        if len(held[0]):
            yield links(held)

    return run


def links(codes: DataFrame, most_bits: int = MOST_BITS, most_in_bucket: int = MOST_IN_BUCKET) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fp`` that keep every connected group connected."""
    def dealt(rows: DataFrame) -> DataFrame:
        return rows.select("mask", "fp").mapInArrow(_deal(most_bits + 1), "mask long, value long, fp long")

    key = ["mask", "value"]
    live, ready = dealt(codes.select(F.lit(0).cast("long").alias("mask"), "fp")), None
    for deal in range(DEALS):
        full = common.checkpoint(live.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most_in_bucket))
        last = full.isEmpty()
        keep = (live if last else live.join(full, key, "left_anti")).withColumn("block", F.lit(0).cast("long"))
        ready = keep if ready is None else ready.union(keep)
        if last:
            break
        live = live.join(full, key)
        if deal < DEALS - 1:
            live = common.checkpoint(dealt(live))
        else:  # every pair of blocks (i <= j) is a group of its own: i * blocks + j
            blocks = F.ceil(2 * F.col("n") / most_in_bucket).cast("long")
            mine = F.pmod(F.xxhash64("fp"), blocks)
            pair = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: F.least(mine, j) * blocks + F.greatest(mine, j)))
            ready = ready.union(live.select("mask", "value", "fp", pair.alias("block")))
    key.append("block")
    return (ready.select(*key, "fp", gray_rank("fp").alias("rank")).repartition(*key)
            .sortWithinPartitions(*key, "rank").select(*key, "fp")
            .mapInArrow(_search_sorted(most_bits), "u long, v long"))


def _least_of_groups(rows: DataFrame, value: Column, most_bits: int, most_in_bucket: int) -> DataFrame:
    """(fp, least): of each fingerprint the smallest ``value`` in its group."""
    codes = common.checkpoint(rows.groupBy("fp").agg(F.min(value).alias("least")))
    reached = common.components(links(codes.select("fp"), most_bits, most_in_bucket))
    labelled = common.checkpoint(codes.join(reached.withColumnRenamed("node", "fp"), "fp", "left")
                                 .select("fp", F.coalesce("component", "fp").alias("component"), "least"))
    least = labelled.groupBy("component").agg(F.min("least").alias("least"))
    return labelled.drop("least").join(least, "component").select("fp", "least")


def near_duplicates(docs: DataFrame, words: int = WORDS, most_bits: int = MOST_BITS, most_in_bucket: int = MOST_IN_BUCKET) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most
    ``most_bits`` differing bits, the row's own included (NULL doc_ids are
    passed over; NULL if the group has no other).  NULL and empty texts have
    fingerprint 0 and link like any other; repeated rows all come back; an
    empty table gives an empty result; other columns are ignored.
    """
    rows = common.checkpoint(fingerprints(docs, words))
    named = _least_of_groups(rows, F.col("doc_id"), most_bits, most_in_bucket).withColumnRenamed("least", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, most_bits: int = MOST_BITS, most_in_bucket: int = MOST_IN_BUCKET) -> DataFrame:
    """``docs`` with exactly one row of each group: the smallest by doc_id (NULL last), then by a hash of the text; of rows that repeat both, any one.

    NULL and empty texts are one group, as their fingerprints are equal; all
    columns stay, whatever their names; an empty table gives an empty result.
    """
    rows = common.checkpoint(_hashed(docs, words))
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    least = _least_of_groups(rows, own, most_bits, most_in_bucket)
    judged = rows.join(least, "fp").select("doc_id", "text_hash", own.eqNullSafe(F.col("least")).alias("stays"))
    # a key has one text, so one group: all its rows stay or none; of those that stay more than once one row is taken
    keys = judged.groupBy(F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash")).agg(F.first("stays").alias("stays"), F.count("*").alias("n"))
    keys = common.checkpoint(keys.where("NOT stays OR n > 1").select("key_id", "key_hash", "stays"))
    again = keys.where("stays")
    same = F.col("_doc").eqNullSafe(F.col("key_id")) & (F.col("_hash") == F.col("key_hash"))
    keyed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_doc"), _text_hash(F.col("text")).alias("_hash"))
    kept = keyed.join(keys, same, "left_anti").select("_row")
    if not again.isEmpty():
        kept = kept.union(keyed.join(again, same, "left_semi").groupBy("_doc", "_hash").agg(F.first("_row").alias("_row")).select("_row"))
    return kept.select("_row.*")
