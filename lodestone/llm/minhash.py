"""MinHash near-duplicates through an inverted join on signature coordinates.

*Classes.*  Documents with equal words are one class, which is looked at once.

*Signatures.*  Coordinate i of a signature is the least value that the i-th
hash function takes on the document's shingles; two documents agree in a share
of coordinates that is their similarity, on average.  A pair has to agree in
``MATCHES`` of ``COORDINATES``; at the similarity of a link it fails to do so
with a chance of 2.4e-6.

*Inverted join.*  Documents are posted under their coordinate-value pairs.
Prefix: of a document's pairs, ordered by how many documents have them, only the
rarest ``COORDINATES - MATCHES + 1`` are posted, since two documents that agree
in ``MATCHES`` coordinates share one of those.  The lists that have one most
central document (that with the most frequent pairs) are merged into its group,
where collisions are counted; a candidate is skipped when the coordinates that
are left can't bring it to the threshold, or when it is linked already.  Pairs
above the threshold are confirmed on the full sets of shingles, made of words.

*Large groups.*  In a group over ``MOST_IN_GROUP`` documents or ``MOST_WORDS`` words
members are first compared with its centre B alone.  Let a and b be what a member
lacks of B and has beyond it; with links at 85 of 100, two members can only be
linked if the differences that they share number (100 a + 85 b, summed over both,
less 15 |B|) / 185 or more.  Members for which 100 a + 85 b <= 15 |B| are linked to
B, so a pair that matters has another member, and shares a difference at least.
So the members that collide with B often enough are posted again, under their
differences and with the same prefix rule, and the centre leaves its group.  Those
that don't (they are in the group for other pairs) meet all its members in pairs
of blocks, and so do groups that are large still after ``LEVELS`` rounds.  No pair is
lost, and none is made of two members that are linked to the centre.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import scratch_dir

from . import common

WORDS, LEAST = 3, 85
COORDINATES, MATCHES = 64, 40
MOST_IN_GROUP, MOST_WORDS, LEVELS = 4096, 1 << 21, 3
#: Shingles hashed at a time.
_STEP = 1024
_ODD = np.random.default_rng(11).integers(1, 1 << 63, COORDINATES + 8, dtype=np.uint64) | np.uint64(1)
_GROUP = "grp long, hub long"


# shingles and signatures


class _Words(dict):
    """Hashes of words, by word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 20:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    for k in (0, 1):
        x = (x ^ (x >> np.uint64(32))) * _ODD[COORDINATES + k]
    return x ^ (x >> np.uint64(32))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: lowers A-Z, splits at 0x20 and 0x09 to 0x0D


def shingles(words: list[bytes], hashes: _Words, width: int = WORDS) -> np.ndarray:
    """Hashes of the different shingles, in order."""
    h = np.fromiter((hashes[w] for w in words), np.uint64, len(words))
    width = min(width, len(h))
    if not width:
        return h
    n = len(h) - width + 1
    joined = np.full(n, width, np.uint64)
    for k in range(width):
        joined = joined * _ODD[COORDINATES + 2] + h[k:k + n]
    return np.unique(_mixed(joined))


def signature(found: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max)
    for at in range(0, len(found), _STEP):
        least = np.minimum(least, (found[at:at + _STEP, None] * _ODD[:COORDINATES]).min(axis=0))
    return least


def _hashed(docs: DataFrame, width: int) -> DataFrame:
    """One row a document: its key, the two hashes of its words that name its class, the number of its shingles and its signature."""
    schema = pa.schema([("doc_id", pa.int64()), ("doc", pa.int64()), ("text_hash", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
                        ("n_words", pa.int64()), ("n_shingles", pa.int64()), ("signature", pa.binary())])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Words()
        for batch in common.slices(batches, "text"):
            names, counts, signatures = [], [], []
            for text in common.encoded(batch.column(3)):
                words = words_of(text)
                found = shingles(words, hashes, width)
                names.append(xxhash.xxh3_128_digest(b" ".join(words)))
                counts.append((len(words), len(found)))
                signatures.append(signature(found).tobytes() if len(found) else None)
            a, b = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2).T
            n_words, n_shingles = np.array(counts, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(a), pa.array(b), pa.array(n_words), pa.array(n_shingles), pa.array(signatures, pa.binary())], schema=schema)

    return _keyed(docs).mapInArrow(run, "doc_id long, doc long, text_hash long, a long, b long, n_words long, n_shingles long, signature binary")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, text_hash, text): rows that agree in doc and text_hash are repeats of each other."""
    text = F.coalesce("text", F.lit(""))
    return common.narrow(docs, doc_id="long", text="string").select(
        "doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("doc"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


# the inverted join


def posts(postings: DataFrame, owner: list[str], carried: list[str]) -> DataFrame:
    """(owner, carried, key, weight): the postings of each owner's prefix under keys that others have too.

    ``postings`` has the owner, a key and ``least``, how many keys the owner
    shares at least with any partner that matters; weight is larger for owners
    with more frequent keys.
    """
    often = _written(postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "often")
    shared = postings.join(often, "key")
    lists = shared.groupBy(owner).agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"), F.sum(F.log("n")).alias("weight"), *[F.first(c).alias(c) for c in (*carried, "least") if c not in owner])
    prefix = lists.where(F.size("keys") >= F.col("least")).withColumn("keys", F.slice("keys", F.lit(1), F.size("keys") - F.col("least") + 1))
    return prefix.select(*owner, *[c for c in carried if c not in owner], "weight", F.explode("keys.key").alias("key"))


def _written(df: DataFrame, name: str) -> DataFrame:
    folder = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def groups(posted: DataFrame) -> DataFrame:
    """(grp, hub, cid, probe): the members of the groups; the lists with one central document are one group."""
    hubs = posted.groupBy("grp", "key").agg(F.max(F.struct("weight", "cid")).alias("centre"), F.count("*").alias("n"), F.max("probe").alias("any"))
    hubs = hubs.where("n > 1 AND any").select("grp", "key", F.col("centre.cid").alias("hub"))
    return posted.join(hubs, ["grp", "key"]).groupBy("grp", "hub", "cid").agg(F.max("probe").alias("probe"))


def _blocks(members: DataFrame) -> DataFrame:
    """Members in pairs of blocks (``p`` of probes, ``t`` of all): one pair of blocks a group unless it is large."""
    own = [F.pmod(F.xxhash64("cid", "grp", "hub"), F.col(c)) for c in ("probe_blocks", "blocks")]
    zero = F.lit(0).cast("long")

    def pairs(p: Column, t: Column, probe: Column, over: str) -> Column:
        return F.transform(F.sequence(zero, F.col(over) - 1), lambda i: F.struct((i if over == "probe_blocks" else p).alias("p"), (i if over == "blocks" else t).alias("t"), probe.alias("probe")))

    as_target, as_probe = pairs(own[0], own[1], F.lit(False), "probe_blocks"), pairs(own[0], own[1], F.lit(True), "blocks")
    one = F.array(F.struct(zero.alias("p"), zero.alias("t"), F.col("probe").alias("probe")))
    many = F.when(F.col("probe"), F.concat(as_target, as_probe)).otherwise(as_target)
    cut = members.select("grp", "hub", "cid", F.explode(F.when(F.col("blocks") == 1, one).otherwise(many)).alias("b"))
    return cut.select("grp", "hub", "b.p", "b.t", "cid", "b.probe")


# sets of shingles, made of words


class Sets:
    """The full sets of shingles of some texts as numbers: equal numbers are equal words."""

    def __init__(self, texts: list[bytes], width: int = WORDS):
        numbers: dict[bytes, int] = {}
        ids = [np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t)], np.int64) for t in texts]
        owners, codes = [], []
        for size in range(1, width + 1):  # texts of fewer words have one shingle of all; shingles of different sizes differ
            own = [i for i, x in enumerate(ids) if len(x) >= width or len(x) == size] if size == width else [i for i, x in enumerate(ids) if len(x) == size]
            if not own:
                continue
            counts = np.array([len(ids[i]) - size + 1 for i in own])
            code = np.concatenate([ids[i][:len(ids[i]) - size + 1] for i in own])
            for k in range(1, size):
                code = np.unique(code, return_inverse=True)[1] * np.int64(len(numbers)) + np.concatenate([ids[i][k:len(ids[i]) - size + 1 + k] for i in own])
            code = np.unique(code, return_inverse=True)[1]
            owners.append(np.repeat(np.array(own), counts))
            codes.append(code + (0 if not codes else max(int(c.max()) for c in codes) + 1))
        owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        code = np.concatenate(codes) if codes else np.empty(0, np.int64)
        self.numbers = int(code.max()) + 1 if len(code) else 0
        both = np.unique(owner * np.int64(self.numbers or 1) + code)
        owner, self.codes = both // (self.numbers or 1), both % (self.numbers or 1)
        self.ends = np.searchsorted(owner, np.arange(len(texts)), side="right")
        self.sizes = np.diff(np.r_[0, self.ends])

    def of(self, i: int) -> np.ndarray:
        return self.codes[self.ends[i] - self.sizes[i]:self.ends[i]]

    def shared(self, i: int, others: np.ndarray) -> np.ndarray:
        """How many shingles the i-th set shares with each of some others."""
        mark = np.zeros(self.numbers, bool)
        mark[self.of(i)] = True
        return np.array([int(mark[self.of(j)].sum()) for j in others.tolist()], np.int64)


def linked(shared, size, other, least: int = LEAST):
    return 100 * shared >= least * (size + other - shared)


def group_links(cids: np.ndarray, probe: np.ndarray, signatures: np.ndarray, texts: list[bytes], centre: int, width: int, least: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of one group, in which one of a pair at least is a probe."""
    n, out = len(cids), []
    sets = Sets(texts, width)
    label = np.arange(n)
    order = np.argsort(cids != cids[centre], kind="stable")  # the centre comes first
    half = COORDINATES // 2
    for at, i in enumerate(order.tolist()):
        rest = order[at + 1:]
        rest = rest[(probe[rest] | probe[i]) & (label[rest] != label[i])]
        small, large = np.minimum(sets.sizes[rest], sets.sizes[i]), np.maximum(sets.sizes[rest], sets.sizes[i])
        rest = rest[(100 * small >= least * large) & (small > 0)]
        found = (signatures[rest, :half] == signatures[i, :half]).sum(axis=1)
        going = found >= MATCHES - (COORDINATES - half)  # the others can't reach the threshold any more
        rest, found = rest[going], found[going]
        rest = rest[found + (signatures[rest, half:] == signatures[i, half:]).sum(axis=1) >= MATCHES]
        for j in rest[linked(sets.shared(i, rest), sets.sizes[i], sets.sizes[rest], least)].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((int(cids[i]), int(cids[j])))
    return out


def _compared(members: DataFrame, kept: DataFrame, width: int, least: int) -> DataFrame:
    """(u, v): links inside the pairs of blocks of groups."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}

        def links():
            cids = np.array(list(held), np.int64)
            probe, signatures, texts = zip(*held.values())
            centre = int(np.flatnonzero(cids == key[1])[0]) if key[1] in held else 0
            found = group_links(cids, np.array(probe), np.frombuffer(b"".join(signatures), np.uint64).reshape(len(cids), -1), texts, centre, width, least)
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], schema=schema)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for *at, cid, probe, signature, text in zip(*columns, common.encoded(batch.column(7))):
                if key != at:
                    if len(held) > 1:
                        yield links()
                    key, held = at, {}
                held[cid] = (probe or cid in held and held[cid][0], signature, text)
        if len(held) > 1:
            yield links()

    rows = _blocks(members).join(kept, "cid").select("grp", "hub", "p", "t", "cid", "probe", "signature", "text")
    group = ["grp", "hub", "p", "t"]
    return rows.repartition(*group).sortWithinPartitions(*group, "cid").mapInArrow(run, "u long, v long")


def _against_centres(members: DataFrame, kept: DataFrame, width: int, least: int) -> DataFrame:
    """Of the members of large groups but their centres: whether they are linked to it or far from it, and else their
    differences from it, how many of them any partner shares at least, and whether a partner may be linked to the centre."""
    kinds = [("grp", pa.int64()), ("hub", pa.int64()), ("cid", pa.int64()), ("linked", pa.bool_()), ("far", pa.bool_()), ("probe", pa.bool_()),
             ("least", pa.int64()), ("differences", pa.list_(pa.int64()))]
    schema = pa.schema(kinds)

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, centre, own = _Words(), None, None
        for batch in common.slices(batches, "text"):
            out = []
            keys = zip(*(batch.column(i).to_pylist() for i in range(5)))
            for (grp, hub, cid, at, mine), at_hub, text in zip(keys, common.encoded(batch.column(5)), common.encoded(batch.column(6))):
                if (np.frombuffer(at, np.uint64) == np.frombuffer(mine, np.uint64)).sum() < MATCHES:
                    out.append((grp, hub, cid, False, True, False, 0, []))
                    continue
                if at_hub != centre:
                    centre, own = at_hub, shingles(words_of(at_hub), hashes, width)
                found = shingles(words_of(text), hashes, width)
                lacks, beyond = np.setdiff1d(own, found, assume_unique=True), np.setdiff1d(found, own, assume_unique=True)
                shared = len(own) - len(lacks)
                one = linked(shared, len(own), len(found), least)
                if one:  # by hashes; the words decide
                    sets = Sets([at_hub, text], width)
                    one = bool(linked(sets.shared(0, np.array([1]))[0], *sets.sizes, least))
                # 100 s >= L (x + y - s) is (100 + L) s >= L (x + y); with x = |B| - a + b and s = |B| - a - a' + shared differences:
                # (100 + L) differences >= weight + weight' - (100 - L) |B|, weight = 100 a + L b
                weight, bound = 100 * len(lacks) + least * len(beyond), (100 - least) * len(own)
                need = max(-(-(weight - bound) // (100 + least)), 1) if weight > bound else weight // (100 + least) + 1
                out.append((grp, hub, cid, one, False, weight > bound, need, np.concatenate([lacks ^ np.uint64(1), beyond]).view(np.int64).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, (_, kind) in enumerate(kinds)], schema=schema)

    # the centre's row comes to its members: a join in which a large group's rows can be split
    centres = members.select("grp", "hub").distinct().join(kept.select(F.col("cid").alias("hub"), F.col("text").alias("at_hub"), F.col("signature").alias("at")), "hub")
    rows = members.where("cid <> hub").join(kept.select("cid", "text", "signature"), "cid").join(centres, ["grp", "hub"])
    return rows.select("grp", "hub", "cid", "at", "signature", "at_hub", "text").mapInArrow(
        run, f"{_GROUP}, cid long, linked boolean, far boolean, probe boolean, least long, differences array<long>")


def links(classes: DataFrame, docs: DataFrame, width: int = WORDS, least: int = LEAST, most_in_group: int = MOST_IN_GROUP, most_words: int = MOST_WORDS, levels: int = LEVELS) -> DataFrame:
    """(u, v): links between classes that keep every connected group connected."""
    if least < LEAST:
        raise ValueError(f"COORDINATES and MATCHES are made for links of {LEAST} in 100 or more")
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda i: F.xxhash64(i, F.substring("signature", 8 * i + 1, F.lit(8)))))
    postings = classes.select("cid", pairs.alias("key"), F.lit(MATCHES).alias("least"))
    posted = posts(postings, ["cid"], []).select(F.lit(0).cast("long").alias("grp"), "key", "cid", "weight", F.lit(True).alias("probe"))
    kept, found = None, []

    def sized(members: DataFrame) -> DataFrame:
        """Members with the numbers of blocks of their group (1: a task can hold it); groups without a pair go."""
        n, words = F.count("*"), F.sum("n_words")
        parts = F.greatest(F.ceil(n / most_in_group), F.least(F.ceil(words / most_words), F.ceil(n / 2))).cast("long")
        sizes = (members.join(kept.select("cid", "n_words"), "cid").groupBy("grp", "hub")
                 .agg(n.alias("n"), F.count_if("probe").alias("probes"), parts.alias("blocks")).where("n > 1 AND probes > 0"))
        sizes = sizes.select("grp", "hub", "blocks", F.ceil(F.col("probes") * F.col("blocks") / F.col("n")).cast("long").alias("probe_blocks"))
        return members.join(_written(sizes, "groups"), ["grp", "hub"])

    def compare(members: DataFrame) -> None:
        found.append(_written(_compared(members, kept, width, least), "links"))

    for level in range(levels + 1):
        members = _written(groups(_written(posted, "posts")), "members")
        if kept is None:
            kept = _written(_texts(classes.join(members.select("cid").distinct(), "cid"), docs), "texts")
        dealt = _written(sized(members), "dealt")
        if level == levels or dealt.where("blocks > 1").isEmpty():
            compare(dealt)
            break
        compare(dealt.where("blocks = 1"))
        against = _written(_against_centres(dealt.where("blocks > 1").select("grp", "hub", "cid"), kept, width, least), "differences")
        found.append(against.where("linked").select(F.col("hub").alias("u"), F.col("cid").alias("v")))
        compare(sized(against.select("grp", "hub", "cid", F.col("far").alias("probe"))))
        again = against.where("NOT far").select(F.xxhash64("grp", "hub").alias("grp"), "cid", "probe", "least", F.explode("differences").alias("difference"))
        again = again.select("grp", "cid", "probe", "least", F.xxhash64("grp", "difference").alias("key"))
        posted = posts(again, ["grp", "cid"], ["probe"]).select("grp", "key", "cid", "weight", "probe")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _texts(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(cid, n_words, signature, text) of some classes, the text of one of their documents."""
    wanted = classes.select("cid", "n_words", "signature", F.col("place.doc").alias("doc"), F.col("place.text_hash").alias("text_hash"))
    rows = _keyed(docs).select("doc", "text_hash", "text").join(wanted, ["doc", "text_hash"])
    return rows.groupBy("cid").agg(*[F.first(c).alias(c) for c in ("n_words", "signature", "text")])  # repeats of the row


def near_duplicates(docs: DataFrame, width: int = WORDS, least: int = LEAST, **options) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable over links of ``least`` in 100
    shingles or more, the row's own included (NULL doc_ids are passed over; NULL
    if there is no other); kept says that it is the row's own.  A text without
    words (NULL, empty, white space) has no shingles and is linked with nothing;
    one of fewer than ``width`` words has one shingle, of all its words.  Rows
    that repeat are linked if they have words, and all come back; an empty table
    gives an empty result; other columns are ignored.
    """
    rows = _written(_hashed(docs, width), "hashed")
    some = rows.where("n_words > 0").groupBy("a", "b").agg(F.min(F.struct("doc", "text_hash")).alias("place"), F.min("doc_id").alias("least"),
                                                          *[F.first(c).alias(c) for c in ("n_words", "signature")])
    classes = _written(some.withColumn("cid", F.monotonically_increasing_id()), "classes")
    reached = common.components(links(classes, docs, width, least, **options)).withColumnRenamed("node", "cid")
    named = classes.select("cid", "a", "b", "least").join(reached, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = named.select("a", "b", "component").join(smallest, "component").select("a", "b", "component_id")
    own: Column = F.when(F.col("n_words") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = rows.select("doc_id", "n_shingles", "n_words", "a", "b").join(labels, ["a", "b"], "left").withColumn("component_id", own)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
