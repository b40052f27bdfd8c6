"""Exact deduplication by content-defined chunk recipes.

A text is cut where a hash of the last 16 bytes hits a pattern, so equal texts
are cut equally.  Each chunk's bytes travel once, in one shuffle that groups
them by digest and bytes together: it proves that no digest names two different
chunks (else the digests are made wider and the proof repeated).  From then on
a text is its recipe, the ordered list of chunk identifiers, and texts are
compared by recipe; long texts do not move again.

Hot groups: recipes are counted with map-side aggregation and joined back to a
written table of the repeated recipes, a plain sort-merge join that adaptive
execution splits when one recipe holds a large share of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LEAST, MEAN_BITS, MOST = 1024, 12, 16384
#: Digest bytes, tried in turn until the identifiers are proven distinct.
WIDTHS = (16, 24, 32, 48, 64)


def _byte_values() -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 32, 256, dtype=np.uint32) | np.uint32(1)


_VALUES = _byte_values()


def cut_points(text: bytes) -> list[int]:
    """Ends of the chunks of a text; an empty text has one empty chunk."""
    n = len(text)
    if n <= LEAST:
        return [n]
    h = _VALUES[np.frombuffer(text, np.uint8)]
    factor = np.uint32(0x9E3779B1)
    for step in (1, 2, 4, 8):  # h[i] covers 2 * step bytes from i on
        h = h[:-step] * factor + h[step:]
        factor = np.uint32((int(factor) * int(factor)) & 0xFFFFFFFF)
    found = np.flatnonzero((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - MEAN_BITS) == 0) + 16
    ends, start, k = [], 0, 0
    while n - start > LEAST:
        k = int(np.searchsorted(found, start + LEAST))
        end = int(found[k]) if k < len(found) else n
        end = min(end, start + MOST, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def _chunks(text: bytes, width: int) -> Iterator[tuple[bytes, bytes]]:
    start = 0
    for end in cut_points(text):
        chunk = text[start:end]
        yield hashlib.blake2b(chunk, digest_size=width).digest(), chunk
        start = end


def _pieces(width: int):
    schema = pa.schema([("id", pa.binary()), ("chunk", pa.binary())])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            rows = [x for text in common.encoded(batch.column(0)) for x in _chunks(text, width)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.binary()), pa.array([x[1] for x in rows], pa.binary())], schema=schema)

    return run


def _recipes(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("recipe", pa.list_(pa.binary()))])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            texts = common.encoded(batch.column(1))
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                pa.array([[i for i, _ in _chunks(t, width)] for t in texts], pa.list_(pa.binary()))], schema=schema)

    return run


def recipes(docs: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(doc_id, text_sha256, recipe) per row; two recipes are equal exactly when the texts are."""
    rows = common.narrow(docs, doc_id="long", text="string")
    for width in widths:
        chunks = rows.select("text").mapInArrow(_pieces(width), "id binary, chunk binary").distinct()
        if chunks.groupBy("id").count().where("count > 1").isEmpty():
            return rows.mapInArrow(_recipes(width), "doc_id long, text_sha256 string, recipe array<binary>")
    raise RuntimeError("chunk digests clash at every width")


def exact_groups(docs: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (NULL counts as empty) the row with the largest doc_id
    stays.  A row given more than once counts as often, and one of the repeats
    stays.  A NULL doc_id is below all others; where a group has no other,
    keep_id is NULL and one row stays.  Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = recipes(docs, widths).groupBy("recipe", "text_sha256", "doc_id").agg(F.count("*").alias("copies"))
    rows = common.checkpoint(rows)
    groups = common.checkpoint(rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
                               .where("group_size > 1"))
    joined = rows.join(groups, "recipe", "left")
    size = F.coalesce("group_size", F.lit(1)).cast("long")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), size.alias("group_size"), "text_sha256",
        F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("repeat", "_n")
    ).select("doc_id", "keep_id", "group_size",
             (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 0)).alias("kept"), "text_sha256")
