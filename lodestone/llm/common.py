"""Helpers shared by the operators: table reads, byte slices, components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import checkpoint

__all__ = ["checkpoint", "components", "encoded", "narrow", "one_blas_thread", "read", "released", "slices"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, as ``name=type`` (clashing extra columns go; missing ones are NULL)."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def released(run: Callable) -> Callable:
    """For functions of mapInArrow: when a task ends, its worker, which lives on, gives back the memory that it has freed."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return task


@contextlib.contextmanager
def one_blas_thread() -> Iterator[None]:
    """OpenBLAS, where numpy brings it, works in the caller's thread alone: its pool may not wake in a driver process."""
    held = []
    with contextlib.suppress(OSError):
        with open("/proc/self/maps") as maps:
            for path in sorted(set(re.findall(r"/\S*openblas\S*", maps.read()))):
                lib = ctypes.CDLL(path)
                for prefix, suffix in (("scipy_", "64_"), ("", "64_"), ("scipy_", ""), ("", "")):
                    with contextlib.suppress(AttributeError):
                        get, put = (getattr(lib, f"{prefix}openblas_{what}_num_threads{suffix}") for what in ("get", "set"))
                        held.append((put, get()))
                        put(1)
                        break
    try:
        yield
    finally:
        for put, threads in held:
            put(threads)


def encoded(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; NULL gives b""."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose ``column`` holds about ``most_bytes`` (one row at least)."""
    at = None
    for batch in batches:
        at = batch.schema.get_field_index(column) if at is None else at
        lengths = pa.compute.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Connected components of an undirected graph: (u long, v long) -> (node, component = smallest node).

    Large-star / small-star rounds: every round is two shuffles of the edges,
    a min per node that combines map-side, and a reliable checkpoint; it ends
    when a round changes nothing.  Stars shrink every chain by a constant
    factor, so the number of rounds is logarithmic in the longest path.
    """
    links = checkpoint(edges.where("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: a's larger neighbours point to a's smallest one (or a)
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: a's smaller neighbours and a point to the smallest of them
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        pulled = large.join(small_low, "a")
        small = (pulled.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(small_low.select("a", F.col("m").alias("b"))).distinct())
        links = checkpoint(small)
        now = links.agg(F.count("*").alias("n"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s"),
                        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            stars = links.groupBy("a").agg(F.min("b").alias("component"))
            roots = links.select(F.col("b").alias("a")).distinct().join(stars.select("a"), "a", "left_anti")
            return (stars.union(roots.select("a", F.col("a").alias("component")))
                    .select(F.col("a").alias("node"), "component"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
