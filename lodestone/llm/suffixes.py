"""Removal of repeated byte strings with suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that starts anywhere else in
the corpus goes, whole texts counted, matches never across documents.

*Sharding by content.*  A start (the place of one such string) belongs to the
least hash among the strings of ``ANCHORS[0]`` bytes inside its own, its anchor.
Equal strings have equal anchors at equal distance, so all starts that can
match share an anchor, and the starts of one anchor place are a run.  The text
that a run's strings cover is its piece.  Only anchors that occur twice or more
are looked at further.  Pieces that are equal are counted, not shipped: all
starts of a piece that occurs twice are repeated.  Different pieces with one
anchor go to a shard of about ``SHARD`` bytes with one representative each.

*Shards.*  Suffixes of all pieces are sorted by Larsson-Sadakane refinement
(only groups that are still tied are sorted again, by the ranks ``h`` further
on, ``h`` doubling), and Kasai's walk gives the common prefixes of neighbours,
in step over all pieces.  Neighbours that share ``LENGTH`` bytes are repeated.
Pieces of one anchor that a shard's end parts are merged by binary search of
the later shard's strings in the sorted strings of the earlier.

*Crowded anchors.*  More than ``MOST_KINDS`` different pieces with one anchor
(a frequent line in changing surroundings) would fill a task.  They are dealt
again by longer anchors (``ANCHORS``), which surroundings tell apart, equal
pieces counted as before; the longest anchor is a whole string, whose pieces
are all equal, so no group is left that is too large.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import scratch_dir

from . import common

LENGTH, ANCHORS = 200, (64, 168, 200)
MOST_KINDS, SHARD = 256, 2 << 20
_STEP, _PLACE = 1 << 21, np.uint64((1 << 24) - 1)
_ODD = np.random.default_rng(8).integers(1, 1 << 63, 300, dtype=np.uint64) | np.uint64(1)


# starts, anchors and pieces


def _runs(text: bytes, ends: np.ndarray, length: int, anchor: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of joined texts: (first start, starts, anchor) of each run of starts with one anchor place."""
    width = length - anchor + 1
    for base in range(0, max(0, len(text) - length + 1), _STEP):
        part = np.frombuffer(text, np.uint8, min(len(text), base + _STEP + length - 1) - base, base)
        h = _ODD[part]
        done = 1
        while done < anchor:
            step = min(done, anchor - done)  # strings of done + step bytes from two that may overlap
            h = h[:-step] * _ODD[256 + done.bit_length()] + h[step:]
            done += step
        h ^= h >> np.uint64(31)
        h *= _ODD[290]
        h ^= h >> np.uint64(29)
        least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        done = 1
        while done < width:
            step = min(done, width - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        place = (least & _PLACE).astype(np.int64)
        at = np.arange(len(place)) + base
        end = ends[np.searchsorted(ends, at, side="right")]
        fits = np.flatnonzero(at + length <= end)
        if not len(fits):
            continue
        place, at = place[fits], at[fits]
        new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)])
        yield at[new], np.diff(np.r_[new, len(at)]), h[place[new]].view(np.int64)


_KEY = "doc long, text_hash long"
_PIECE = "anchor long, piece long, starts int"
_NAMES = ["anchor", "piece", "starts"]
_RANGES = "ranges array<struct<from:int,to:int>>"


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, doc_id, text): rows that agree in the first two are repeats of each other."""
    text = F.coalesce("text", F.lit(""))
    return common.narrow(docs, doc_id="long", text="string").select(
        F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("doc"), F.xxhash64(text).alias("text_hash"), "doc_id", text.alias("text"))


def _joined(column: pa.Array) -> tuple[bytes, np.ndarray]:
    texts = common.encoded(column)
    return b"".join(texts), np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))


def anchors_of(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHORS[0]) -> DataFrame:
    """(anchor): one row for each run of starts."""

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            for _, _, found in _runs(*_joined(batch.column(0)), length, anchor):
                yield pa.RecordBatch.from_arrays([pa.array(found)], names=["anchor"])

    return _keyed(docs).select("text").mapInArrow(run, "anchor long")


def pieces(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHORS[0]) -> DataFrame:
    """One row for each run of starts: its anchor, the hash of its piece, number of starts, document and first start."""

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in common.slices(batches, "text"):
            text, ends = _joined(batch.column(2))
            doc, text_hash = (batch.column(i).to_numpy() for i in (0, 1))
            for first, starts, found in _runs(text, ends, length, anchor):
                piece = np.array([digest(text[a:b]) for a, b in zip(first.tolist(), (first + starts + length - 1).tolist())], np.uint64).view(np.int64)
                row = np.searchsorted(ends, first, side="right")
                begin = np.r_[0, ends][row]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (found, piece, starts.astype(np.int32), doc[row], text_hash[row], first - begin)],
                                                 names=["anchor", "piece", "starts", "doc", "text_hash", "at"])

    return _keyed(docs).select("doc", "text_hash", "text").mapInArrow(run, f"{_PIECE}, {_KEY}, at long")


# suffix arrays


def suffix_array(text: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes sorted by at least ``depth`` bytes, their ranks and the 8 bytes at each place.

    ``ends`` gives for each place the end of its piece, which sorts before every byte.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    word = np.zeros(n, np.uint64)
    left = ends - np.arange(n)
    for k in range(8):
        word = (word << np.uint64(8)) | np.where(left > k, padded[k:n + k], 0).astype(np.uint64)
    short = np.minimum(left, 8)
    order = np.lexsort((short, word)) if (text == 0).any() else np.argsort(word, kind="stable")
    new = np.concatenate([[True], (word[order[1:]] != word[order[:-1]]) | (short[order[1:]] != short[order[:-1]])])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    while h < depth:
        tied = np.flatnonzero(~new | np.concatenate([~new[1:], [False]]))  # places in the order, by groups
        if not len(tied):
            break
        some = order[tied]
        ahead = some + h
        inside = ahead < ends[some]
        second = np.where(inside, rank[np.where(inside, ahead, 0)] + 1, 0)
        sort = np.argsort(rank[some] * (n + 1) + second, kind="stable")
        some, second = some[sort], second[sort]
        group = rank[some]
        begins = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        order[tied] = some
        new[tied] = begins
        rank[some] = np.maximum.accumulate(np.where(begins, tied, 0))
        h *= 2
    return order, rank, word


def common_prefixes(order: np.ndarray, word: np.ndarray, ends: np.ndarray, first: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Kasai's walk over the starts of all pieces in step: at each start, the prefix (``most`` at most) shared with the suffix before it in order."""
    n = len(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    shared = np.zeros(n, np.int64)
    by_starts = np.argsort(-starts, kind="stable")
    first, starts = first[by_starts], starts[by_starts]
    kept = np.zeros(len(first), np.int64)
    for t in range(int(starts[0]) if len(starts) else 0):
        active = int(np.searchsorted(-starts, -t, side="left"))
        i = first[:active] + t
        where = place[i]
        j = order[np.maximum(where - 1, 0)]
        limit = np.where(where > 0, np.minimum(np.minimum(ends[i] - i, ends[j] - j), most), 0)
        equal = np.minimum(np.maximum(kept[:active] - 1, 0), limit)
        going = np.flatnonzero(equal < limit)
        while len(going):
            at = equal[going]
            differ = word[i[going] + at] ^ word[j[going] + at]
            more = np.zeros(len(going), np.int64)
            for k in range(1, 9):
                more += differ < np.uint64(1 << (64 - 8 * k)) if k < 8 else differ == 0
            equal[going] = np.minimum(at + more, limit[going])
            going = going[(more == 8) & (equal[going] < limit[going])]
        shared[i] = equal
        kept[:active] = equal
    return shared


class Shard:
    """A suffix array over the pieces of some anchors, and which of their starts are repeated in it."""

    def __init__(self, found: list[bytes], starts: np.ndarray, length: int):
        self.length, self.starts = length, starts
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.text = np.frombuffer(b"".join(found), np.uint8)
        self.first = np.cumsum(sizes) - sizes
        ends = np.repeat(self.first + sizes, sizes)
        order, _, word = suffix_array(self.text, ends, length)
        shared = common_prefixes(order, word, ends, self.first, starts, length)
        self.repeated = np.zeros(len(self.text), bool)
        hit = np.flatnonzero(shared[order] >= length)
        self.repeated[order[hit]] = True
        self.repeated[order[hit - 1]] = True
        self.order = order

    def strings(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The starts of some pieces in suffix order, and their strings."""
        mine = np.zeros(len(self.text), bool)
        for p in some:
            mine[self.first[p]:self.first[p] + self.starts[p]] = True
        at = self.order[mine[self.order]]
        window = np.lib.stride_tricks.sliding_window_view(self.text, self.length)[at]
        return at, np.ascontiguousarray(window).view(f"S{self.length}").ravel()

    def ranges(self, p: int) -> list[tuple[int, int]]:
        """Runs (from, to) of repeated starts of a piece."""
        flags = self.repeated[self.first[p]:self.first[p] + self.starts[p]]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
        return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def merge(earlier: Shard, some: np.ndarray, later: Shard, others: np.ndarray) -> None:
    """Mark what pieces of two shards share: binary search of the later shard's strings in the earlier's sorted ones."""
    at, strings = earlier.strings(some)
    places, wanted = later.strings(others)
    if not len(at) or not len(places):
        return
    low, high = (np.searchsorted(strings, wanted, side=s) for s in ("left", "right"))
    later.repeated[places[low < high]] = True
    covered = np.zeros(len(at) + 1, np.int64)
    np.add.at(covered, low, 1)
    np.add.at(covered, high, -1)
    earlier.repeated[at[np.cumsum(covered)[:-1] > 0]] = True


def _sorted_shards(length: int, shard_bytes: int):
    names = [*_NAMES, "ranges"]

    def results(keys, shard: Shard, some: range):
        """One row a piece that has repeated starts (all starts of one with copies are, and told elsewhere)."""
        out = [(*keys[p][:3], [{"from": a, "to": b} for a, b in own]) for p in some if keys[p][3] < 2 and (own := shard.ranges(p))]
        kinds = (pa.int64(), pa.int64(), pa.int32(), _RUNS)
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=names)

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, found, held, before = [], [], 0, None

        def work(before):
            """The shard, with the one before it: what is settled, and what the next may add to."""
            shard = Shard(found, np.array([k[2] for k in keys], np.int64), length)
            out = []
            if before is not None:
                old_keys, old, tail = before
                head = [p for p in range(len(keys)) if keys[p][0] == old_keys[-1][0]]
                merge(old, np.array(tail), shard, np.array(head, np.int64))
                out.append(results(old_keys, old, tail))
            last = [p for p in range(len(keys)) if keys[p][0] == keys[-1][0]]
            out.append(results(keys, shard, range(last[0])))
            return out, (keys, shard, last)

        for batch in batches:
            for anchor, piece, starts, copies, data in zip(*(c.to_pylist() for c in batch.columns)):
                if held > shard_bytes and (before is None or keys[0][0] != keys[-1][0] or before[0][-1][0] != keys[0][0]):
                    out, before = work(before)
                    yield from out
                    keys, found, held = [], [], 0
                keys.append((anchor, piece, starts, copies))
                found.append(data)
                held += len(data)
        if keys:
            out, before = work(before)
            yield from out
        if before is not None:
            yield results(before[0], before[1], before[2])

    return run


# the corpus


_RUNS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _moved(by: str) -> Column:
    return F.transform("ranges", lambda r: F.struct((F.col(by) + r["from"]).alias("from"), (F.col(by) + r["to"]).alias("to")))


def _maximal(rows: DataFrame) -> DataFrame:
    """(anchor, piece, starts, ranges) with a piece's ranges as maximal runs: one row a piece."""

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ranges in batch.column(3).to_pylist():
                own: list[dict] = []
                for a, b in sorted((r["from"], r["to"]) for part in ranges for r in part):
                    if own and a <= own[-1]["to"]:
                        own[-1]["to"] = max(own[-1]["to"], b)
                    else:
                        own.append({"from": a, "to": b})
                out.append(own)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, _RUNS)], names=[*_NAMES, "ranges"])

    grouped = rows.groupBy(*_NAMES).agg(F.collect_list("ranges").alias("ranges"))  # a piece has few starts
    return grouped.mapInArrow(run, f"{_PIECE}, {_RANGES}")


def _cut(docs: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """The text of pieces."""
    wanted = places.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("at", *_NAMES, "copies", "crowded")).alias("places"))
    one = _keyed(docs).select("doc", "text_hash", "text").join(wanted, ["doc", "text_hash"]).select("text", "places")
    schema = pa.schema([("anchor", pa.int64()), ("piece", pa.int64()), ("starts", pa.int32()), ("copies", pa.int64()), ("crowded", pa.bool_()), ("data", pa.binary())])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", 1 << 20):
            out, done = [], set()
            for text, own in zip(common.encoded(batch.column(0)), batch.column(1).to_pylist()):
                for p in own:
                    key = (p["anchor"], p["piece"], p["starts"])
                    if key not in done:  # a repeated row has the same pieces
                        done.add(key)
                        out.append((*key, p["copies"], p["crowded"], text[p["at"]:p["at"] + p["starts"] + length - 1]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return one.mapInArrow(run, f"{_PIECE}, copies long, crowded boolean, data binary")


def _dealt_again(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """The pieces of longer anchors inside pieces, with the piece that each lies in and where."""
    owners = ["owner_anchor", "owner_piece", "owner_starts"]
    names = [*_NAMES, "copies", "data", *owners, "owner_copies", "at"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "data"):
            text, ends = _joined(batch.column(4))
            keys, begins = list(zip(*(batch.column(i).to_pylist() for i in range(3)))), np.r_[0, ends]
            copies = batch.column(3).to_pylist()
            for first, starts, found in _runs(text, ends, length, anchor):
                out = []
                row = np.searchsorted(ends, first, side="right")
                for a, n, h, r in zip(first.tolist(), starts.tolist(), found.tolist(), row.tolist()):
                    data = text[a:a + n + length - 1]
                    piece = np.uint64(xxhash.xxh3_64_intdigest(data)).astype(np.int64)
                    out.append((h, int(piece), n, copies[r], data, *keys[r], copies[r], a - int(begins[r])))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=names)

    return rows.select(*_NAMES, "copies", "data").mapInArrow(
        run, f"{_PIECE}, copies long, data binary, owner_anchor long, owner_piece long, owner_starts int, owner_copies long, at int")


def repeated_starts(docs: DataFrame, length: int = LENGTH, anchors: tuple[int, ...] = ANCHORS, most_kinds: int = MOST_KINDS, shard_bytes: int = SHARD) -> DataFrame:
    """(doc, text_hash, ranges): runs of starts whose string starts anywhere else too, one row a piece of text.

    Ranges are kept as one array a piece, and both joins that bring them back to
    where the piece lies have one row a piece on their right, so neither makes
    more rows than it reads.
    """
    spark = docs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        folder = scratch_dir(spark, name)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    def compared(kinds: DataFrame, level: int) -> DataFrame:
        """Of anchors with several kinds of pieces: those kinds, and whether they are too many."""
        many = written(kinds.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select(
            "anchor", (F.col("n") > (most_kinds if level + 1 < len(anchors) else 1 << 62)).alias("crowded")), "many")
        return kinds.join(many, "anchor")

    def sharded(rows: DataFrame) -> DataFrame:
        return (rows.where("NOT crowded").select(*_NAMES, "copies", "data").repartition("anchor").sortWithinPartitions(*_NAMES)
                .mapInArrow(_sorted_shards(length, shard_bytes), f"{_PIECE}, {_RANGES}"))

    def settled(kinds: DataFrame, rows: DataFrame, level: int) -> DataFrame:
        """(anchor, piece, starts, ranges) of the kinds of a level, one row a kind; ``rows`` has the text of those to compare."""
        whole = F.array(F.struct(F.lit(0).alias("from"), F.col("starts").alias("to"))).alias("ranges")
        out = kinds.where("copies > 1").select(*_NAMES, whole).union(sharded(rows))
        crowded = rows.where("crowded")
        if level + 1 == len(anchors) or crowded.isEmpty():
            return out
        parts = written(_dealt_again(crowded, length, anchors[level + 1]), "dealt")
        inner = written(parts.groupBy(*_NAMES).agg(F.sum("copies").alias("copies"), F.first("data").alias("data")), "kinds")
        deeper = settled(inner, written(compared(inner, level + 1), "cut"), level + 1)
        # kinds with copies are told whole above; the others get what their inner pieces have
        back = parts.where("owner_copies < 2").drop("copies", "data", "owner_copies").join(deeper, _NAMES)
        return out.union(_maximal(back.select(*[F.col(f"owner_{c}").alias(c) for c in _NAMES], _moved("at").alias("ranges"))))

    often = written(anchors_of(docs, length, anchors[0]).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "often")
    found = written(pieces(docs, length, anchors[0]).join(often, "anchor"), "pieces")
    kinds = written(found.groupBy(*_NAMES).agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("doc", "text_hash", "at")]), "kinds")
    cut = written(_cut(docs, compared(kinds, 0), length), "cut")
    repeated = settled(kinds, cut, 0)
    return found.join(repeated, _NAMES).select("doc", "text_hash", _moved("at").alias("ranges"))


def _of_documents(docs: DataFrame, length: int, **options) -> DataFrame:
    """(doc, text_hash, ranges): all ranges of a document, those of its repeats among them."""
    return repeated_starts(docs, length, **options).groupBy("doc", "text_hash").agg(F.flatten(F.collect_set("ranges")).alias("ranges"))


def _spans(ranges: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for a, b in sorted((r["from"], r["to"] - 1 + length) for r in ranges or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _kept(text: bytes, spans) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def _with_ranges(docs: DataFrame, length: int, **options) -> DataFrame:
    ranges = _of_documents(docs, length, **options)
    return _keyed(docs).join(ranges, ["doc", "text_hash"], "left")


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False, **options) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes).

    A byte goes if a string of ``length`` bytes that covers it starts anywhere
    else, in this or another document; strings are judged on the input.  NULL
    and empty texts have nothing to remove, nor has a text shorter than
    ``length``; repeated rows are copies of each other and lose all their
    strings; an empty table gives an empty result; other columns are ignored.
    """
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            out = []
            for doc, text, ranges in zip(batch.column(0).to_pylist(), common.encoded(batch.column(1)), batch.column(2).to_pylist()):
                spans = _spans(ranges, length)
                kept = _kept(text, spans)
                out.append((doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(len(names))], names=names)

    return (_with_ranges(docs, length, **options).select("doc_id", "text", "ranges")
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text))


def without_repeats(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """``docs`` with the bytes that stay; what a cut leaves of a broken character goes with it, and so does a document of which only white space is left.

    Repeated rows are copies of each other; texts without a repeated string stay
    as they are, NULL and blank ones too; all columns stay, whatever their names;
    an empty table gives an empty result.
    """
    ranges = _of_documents(docs, length, **options)
    keyed = docs.select(F.struct("*").alias("row"), F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    joined = keyed.join(ranges, ["doc", "text_hash"], "left").select("row", "ranges", F.col("row.text").alias("text"))

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            texts = batch.column(2).to_pylist()
            spans = [_spans(r, length) for r in batch.column(1).to_pylist()]
            kept = [_kept(t.encode(), s).decode(errors="ignore") if s else t for t, s in zip(texts, spans)]
            stays = pa.array([not s or bool(t.strip()) for t, s in zip(kept, spans)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["row", "kept"]).filter(stays)

    cut = joined.mapInArrow(run, joined.select("row", F.col("text").alias("kept")).schema)
    return cut.select(*[F.col("kept").alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
