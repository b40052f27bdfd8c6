"""Packing documents into sequences by cutting-stock column generation.

Every document gives its full sequences and a remainder shorter than the
capacity.  A histogram of the remainders' lengths (at most capacity - 1 rows,
whatever the corpus) is all that the plan needs: a linear program over patterns
of lengths that fill one sequence, solved by the revised simplex method, whose
columns a knapsack dynamic program prices from the dual values.  The patterns
are rounded to whole numbers of copies.

Documents are numbered within their length on Spark (a number within the task
plus the counts of the tasks before, from one aggregation), and the number
alone says which copy of which pattern a remainder goes to.  Patterns of the
program that leave a gap, and patterns made of what the rounding leaves, are used
as far as there are remainders left to fill the gaps with; only these are cut.
They are laid end to end, first through the gaps, then through sequences of
their own, of which the last have lengths that are powers of two, so nothing is
padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import scratch_dir

from . import bpe, common

CAPACITY, END = 2048, 1
#: Columns are generated until the program is within this share of its lower bound (that of Farley), or needs as many whole
#: sequences, or has not come down by that much in so many rounds of pricing.  How far it is from the bound is known then.
GAP, PATIENCE = 5e-4, 40
_EPS, _LEAST_PIVOT = 1e-9, 1e-6


def price(value: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the best value of each size (filled or not) and the item that it ends with (-1: none)."""
    by_length = np.full(capacity + 1, -1.0)
    by_length[lengths] = value
    best, item = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        with_item = by_length[1:c + 1] + best[c - 1::-1] if c > 1 else by_length[1:2] + best[:1]
        k = int(with_item.argmax())
        if with_item[k] > best[c - 1]:
            best[c], item[c] = with_item[k], k + 1
        else:
            best[c] = best[c - 1]
    return best, item


def _pattern(size: int, item: np.ndarray, first: int) -> dict[int, int]:
    """The lengths that make up the best filling of ``size``, and ``first``."""
    found = {first: 1}
    while size > 0:
        if item[size] < 0:
            size -= 1
        else:
            found[int(item[size])] = found.get(int(item[size]), 0) + 1
            size -= int(item[size])
    return found


def first_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[list[dict[int, int]], np.ndarray, list[int]]:
    """A first basis, one pattern for each length that it uses up: the longest that is left, filled up with the longest that fit.

    Also gives the lengths in the order in which they are used up; a pattern holds no length used up before its own.
    """
    left = np.zeros(capacity + 1)
    left[lengths] = demand
    of: dict[int, tuple[dict[int, int], float]] = {}
    while (there := np.flatnonzero(left > _EPS)).size:
        p, gap = {}, capacity
        while (fits := int(np.searchsorted(there, gap, side="right"))):
            n = int(there[fits - 1])
            p[n] = p.get(n, 0) + 1
            gap -= n
        at, count = list(p), np.array(list(p.values()), float)
        copies = float((left[at] / count).min())
        left[at] -= copies * count
        used = [n for n in at if left[n] <= _EPS]
        left[used] = 0
        of[used[0]] = (p, copies)
        for n in used[1:]:
            of[n] = ({n: capacity // n}, 0.0)
    return [of[int(n)][0] for n in lengths], np.array([of[int(n)][1] for n in lengths]), list(of)


def _inverse(patterns: list[dict[int, int]], row: dict[int, int], order: list[int]) -> np.ndarray:
    """Of the first basis, by forward substitution: in ``order`` it is lower triangular, and nearly empty."""
    holds: dict[int, list[tuple[int, int]]] = {n: [] for n in order}
    for n in order:
        for other, count in patterns[row[n]].items():
            if other != n:
                holds[other].append((row[n], count))
    inverse = np.zeros((len(order), len(order)))
    for n in order:
        k = row[n]
        inverse[k, k] = 1
        for column, count in holds[n]:
            inverse[k] -= count * inverse[column]
        inverse[k] /= patterns[k][n]
    return inverse


def column_generation(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP) -> tuple[list[tuple[dict[int, int], float]], float]:
    """Patterns {length: count} and how often each is used in a linear program that meets the demand with few sequences; and a lower bound of that."""
    row = {int(n): i for i, n in enumerate(lengths)}
    # slightly different demands keep basic solutions from being degenerate
    demand = demand * (1 + 1e-5 * np.random.default_rng(len(lengths)).random(len(lengths)))
    patterns, x, order = first_patterns(lengths, demand, capacity)
    inverse = _inverse(patterns, row, order)
    dual = inverse.sum(axis=0)
    bound, least, patience = float(lengths @ demand) / capacity, np.inf, PATIENCE
    while True:
        best, item = price(dual, lengths, capacity)
        # the dual values over the value of the best pattern are feasible for the dual program
        bound = max(bound, float(dual @ demand) / max(1.0, float(best[capacity])))
        if least - x.sum() > gap * bound:
            least, patience = x.sum(), PATIENCE
        patience -= 1
        if x.sum() - bound <= gap * bound or np.ceil(x.sum() - 1e-3) <= np.ceil(bound - 1e-3) or not patience:
            break
        gain = dual + best[capacity - lengths] - 1  # of the best pattern with each length in it
        pool = [i for i in np.argsort(-gain) if gain[i] > 1e-7]
        done = 0
        for i in pool:
            p = _pattern(capacity - int(lengths[i]), item, int(lengths[i]))
            at, count = [row[n] for n in p], np.array(list(p.values()), float)
            if dual[at] @ count - 1 <= 1e-7:
                continue
            change = inverse[:, at] @ count
            up = np.flatnonzero(change > _LEAST_PIVOT)
            if not len(up):
                continue
            ratio = x[up] / change[up]
            ties = up[ratio <= ratio.min() + _EPS]
            out = int(ties[change[ties].argmax()])  # of rows that leave alike, the largest pivot
            step = x[out] / change[out]
            x -= step * change
            x[out] = step
            np.maximum(x, 0, out=x)
            pivot_row = inverse[out] / change[out]
            touched = np.flatnonzero(np.abs(change) > _EPS)
            touched = touched[touched != out]
            inverse[touched] -= np.outer(change[touched], pivot_row)
            inverse[out] = pivot_row
            dual = dual - (dual[at] @ count - 1) * pivot_row
            patterns[out] = p
            done += 1
        if not done:  # no column has a price: this is the optimum
            break
    return [(p, float(v)) for p, v in zip(patterns, x) if v > _EPS], bound


def _total(p: dict[int, int]) -> int:
    return sum(n * k for n, k in p.items())


@dataclass
class Layout:
    """Where the remainder number ``rank`` of a length goes; a few numbers for each length and pattern."""

    capacity: int
    start: np.ndarray  # of each length: documents of smaller lengths
    segments: dict[int, tuple[np.ndarray, ...]]  # of each length: first rank, per copy, first sequence, offset
    placed: np.ndarray  # of each length: ranks that patterns take
    gaps: tuple[np.ndarray, ...]  # of each pattern with a gap: tokens in gaps before, size of the gap, first sequence
    gap_tokens: int
    rest: np.ndarray  # of each length: tokens laid end to end before it
    rest_tokens: int  # of those, the tokens behind the gaps
    rest_first: int  # and their first sequence
    sequences: int

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """Pieces (start in the remainder, length, sequence, offset)."""
        if rank < self.placed[length]:
            first, per_copy, sequence, offset = self.segments[length]
            k = int(np.searchsorted(first, rank, side="right")) - 1
            copy, slot = divmod(rank - int(first[k]), int(per_copy[k]))
            return [(0, length, int(sequence[k]) + copy, int(offset[k]) + slot * length)]
        at = int(self.rest[length]) + (rank - int(self.placed[length])) * length
        out, done = [], 0
        whole = self.rest_tokens // self.capacity
        while done < length:
            p = at + done
            if p < self.gap_tokens:
                before, gap, first = self.gaps
                k = int(np.searchsorted(before, p, side="right")) - 1
                copy, offset = divmod(p - int(before[k]), int(gap[k]))
                take = min(length - done, int(gap[k]) - offset)
                out.append((done, take, int(first[k]) + copy, self.capacity - int(gap[k]) + offset))
                done += take
                continue
            p -= self.gap_tokens
            sequence, offset = divmod(p, self.capacity)
            size = self.capacity
            if sequence >= whole:  # the tail: one sequence for each bit of what is left
                offset, left = p - whole * self.capacity, self.rest_tokens - whole * self.capacity
                sequence = whole
                for bit in range(left.bit_length() - 1, -1, -1):
                    if left >> bit & 1:
                        size = 1 << bit
                        if offset < size:
                            break
                        offset, sequence = offset - size, sequence + 1
            take = min(length - done, size - offset)
            out.append((done, take, self.rest_first + sequence, offset))
            done += take
        return out


def _rounded(found: list[tuple[dict[int, int], float]], left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole copies of patterns for the remainders ``left``, which are taken off; as many stay as fill the gaps."""
    chosen: list[tuple[dict[int, int], int]] = []
    gaps = 0

    def use(p: dict[int, int], most: int) -> None:
        nonlocal gaps
        gap = capacity - _total(p)
        # a copy takes a sequence's worth of remainders, those that fill its gap included; those promised to gaps stay
        copies = min([most, (int(left @ np.arange(len(left))) - gaps) // capacity, *(int(left[n]) // c for n, c in p.items())])
        if copies > 0:
            for n, c in p.items():
                left[n] -= copies * c
            gaps += copies * gap
            chosen.append((p, copies))

    by_gap = sorted(found, key=lambda f: capacity - _total(f[0]))
    for p, v in by_gap:
        use(p, int(v + 1e-6))
    for p, v in sorted(found, key=lambda f: (capacity - _total(f[0]), int(f[1]) - f[1])):  # round up while remainders last
        use(p, 1 if capacity - _total(p) else 1 << 60)
    while True:  # what is left: the longest, filled up with the longest that fit
        p, gap, have = {}, capacity, left.copy()
        while gap and (fits := np.flatnonzero(have[1:gap + 1])).size:
            n = int(fits[-1]) + 1
            k = min(gap // n, int(have[n]))
            p[n], gap = k, gap - n * k
            have[n] = 0
        before = len(chosen)
        if p:
            use(p, 1 << 60)
        if len(chosen) == before:
            return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY, gap: float = GAP) -> Layout:
    """The layout of remainders from the number of documents of each length (0: no remainder)."""
    count = np.zeros(capacity, np.int64)
    for n, k in histogram.items():
        count[n] = k
    lengths = np.flatnonzero(count[1:]) + 1
    left = count.copy()
    left[0] = 0
    chosen = []
    if len(lengths):
        with common.one_blas_thread():
            found, _ = column_generation(lengths, count[lengths].astype(float), capacity, gap)
        chosen = _rounded(found, left, capacity)
    parts: dict[int, list[tuple[int, int, int, int]]] = {}
    placed, sequence, gaps, gap_tokens = np.zeros(capacity, np.int64), 0, [], 0
    for p, k in chosen:
        offset = 0
        for n, c in sorted(p.items(), reverse=True):
            parts.setdefault(n, []).append((int(placed[n]), c, sequence, offset))
            placed[n] += k * c
            offset += n * c
        if offset < capacity:
            gaps.append((gap_tokens, capacity - offset, sequence))
            gap_tokens += k * (capacity - offset)
        sequence += k
    tokens = left * np.arange(capacity)
    total = int(tokens.sum()) - gap_tokens
    tail = total % capacity
    return Layout(capacity, np.cumsum(count) - count, {n: tuple(np.array(c, np.int64) for c in zip(*v)) for n, v in parts.items()}, placed,
                  tuple(np.array(c, np.int64) for c in zip(*gaps)) or (np.empty(0, np.int64),) * 3, gap_tokens,
                  np.cumsum(tokens) - tokens, total, sequence, sequence + total // capacity + tail.bit_count())


def _kind(path: str) -> str:
    """Ids are kept in 16 bits where the vocabulary allows."""
    return "<u2" if len(bpe.tokenizer(bpe.vocabulary(path)).labels) <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(task, doc_id, tokens, length, number, ids): each document's ids with ``end``, numbered within its task and remainder length."""
    text = docs.sparkSession.sparkContext.broadcast(bpe.vocabulary(path))
    kind = _kind(path)
    last = np.array([end], kind).tobytes()

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task, seen = bpe.encoder(text.value), TaskContext.get().partitionId(), np.zeros(capacity, np.int64)
        for batch in common.slices(batches, "text"):
            ids = [i.astype(kind).tobytes() + last for i in known.encode([t or "" for t in batch.column(1).to_pylist()])]
            tokens = [len(b) // len(last) for b in ids]
            numbers = []
            for n in tokens:
                numbers.append(int(seen[n % capacity]))
                seen[n % capacity] += 1
            yield pa.RecordBatch.from_arrays([
                pa.array([task] * len(ids), pa.int32()), batch.column(0), pa.array(tokens, pa.int64()),
                pa.array([n % capacity for n in tokens], pa.int32()), pa.array(numbers, pa.int64()), pa.array(ids, pa.binary())],
                names=["task", "doc_id", "tokens", "length", "number", "ids"])

    rows = common.narrow(docs, doc_id="long", text="string").mapInArrow(run, "task int, doc_id long, tokens long, length int, number long, ids binary")
    folder = scratch_dir(docs.sparkSession, "ids")
    rows.write.option("compression", "zstd").parquet(folder)  # the numbering is fixed from here on
    return docs.sparkSession.read.parquet(folder)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences: one row per piece.

    Returns doc_id, start (its document's ids before it), length, ids_crc32 (of
    the ids as little-endian 32-bit numbers), doc_tokens, sequence_id, offset,
    and the ids if asked for.  Every id lies in exactly one piece; pieces of a
    sequence follow each other without a gap from offset 0; each sequence holds
    ``capacity`` ids or a power of two, so none is padded.  A NULL or empty text
    still has its end id; repeated rows and NULL doc_ids are documents of their
    own; an empty table gives an empty result; other columns are ignored.
    """
    rows = encoded(docs, path, capacity, end)
    counts = rows.groupBy("task", "length").agg(F.count("*").alias("n"), F.max(F.expr(f"tokens div {capacity}")).alias("full"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = common.checkpoint(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n"), F.max("full").alias("full")).collect()  # at most ``capacity`` rows
    layout = plan({r.length: r.n for r in lengths}, capacity)
    most_full = max([0, *(r.full for r in lengths)])
    shared = docs.sparkSession.sparkContext.broadcast(layout)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def pieces(layout: Layout, tokens: int, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        full = tokens // capacity
        document = int(layout.start[length]) + rank
        for i in range(full):
            yield i * capacity, capacity, layout.sequences + document * most_full + i, 0
        if length:
            for start, n, sequence, offset in layout.place(length, rank):
                yield full * capacity + start, n, sequence, offset

    kind = _kind(path)

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = shared.value
        bpe.encoder.cache_clear()  # this stage has no use for the tables
        bpe.tokenizer.cache_clear()
        for batch in common.slices(batches, "ids"):
            out = []
            for doc, tokens, length, rank, ids in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, kind).astype("<u4").tobytes()
                for start, n, sequence, offset in pieces(layout, tokens, length, rank):
                    own = ids[4 * start:4 * (start + n)]
                    out.append((doc, start, n, zlib.crc32(own), tokens, sequence, offset, own))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.binary() if i == 7 else pa.int64()) for i in range(len(names))], names=names)

    numbered = (rows.join(counts.select("task", "length", "base"), ["task", "length"])
                .select("doc_id", "tokens", "length", (F.col("base") + F.col("number")).alias("rank"), "ids"))
    return numbered.mapInArrow(run, ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names))
