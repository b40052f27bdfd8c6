"""Conversation structure repair by Knuth's lightest derivations.

A repaired conversation's role initials match ``(s?(ua)+)?``.  That language has
four states: nothing yet, after s, after u, after a.  A deduction item says that
rows l..r lead from one state to another; axioms are single edits:

    Keep 0, Rerole to user/assistant 1, Delete 2 (must for blank and duplicate
    rows), Insert an empty user/assistant row 5; a truncated row that isn't
    deleted adds 5.

Items are joined by a superior function: costs add up, audits (initials of the
edits) are strung together, so no item is lighter than one it follows from.  An
agenda pops items by (cost, audit); a popped item is final, and so is the goal
when it is popped.  Audits fix costs, so of two audits of equal cost neither
begins the other and the order lasts under any continuation.

*At scale.*  Rows are range-partitioned in order of conversation and turn, so a
conversation of any length is spread over tasks.  A conversation inside one
partition is settled there.  One that crosses partitions leaves for each of them
its items between all pairs of states; these are joined pairwise, and the edits
go back to the rows, which one task streams through the hash.  What meets in one
task grows with the audit, which the result holds anyway, never with the texts.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import scratch_dir

from . import common

WHITE, ENDS = " \t\n\x0b\x0c\r", ".!?"
START, AFTER_S, AFTER_U, AFTER_A = range(4)
RIGHT, BLANK, DUPLICATE, TRUNCATED = range(4)
INSERT, DELETE, REROLE, CUT = 5, 2, 1, 5
#: The next state by the initial of a row that stays, and the role that an inserted or reroled row gets.
_STEP = {START: {"s": AFTER_S, "u": AFTER_U}, AFTER_S: {"u": AFTER_U}, AFTER_U: {"a": AFTER_A}, AFTER_A: {"u": AFTER_U}}
_NEXT = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
_LEGAL = {"su", "ua", "au"}
#: Rows of which items are derived at once; longer runs are joined from such blocks.
BLOCK = 64

Item = tuple[int, str]
Items = dict[tuple[int, int], Item]


# deduction


def lightest(length: int, deductions: Callable[[int, int], Iterable[tuple[int, int, int, str]]], start: int, goals: set[int] | None = None) -> dict[int, Item]:
    """Final items from ``start`` over the whole length, by end state; with ``goals`` only the lightest of those states.

    ``deductions(place, state)`` gives (places further, state, cost, audit) of each rule that takes an item there.
    """
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final, out = set(), {}
    while agenda:
        cost, audit, place, state = heapq.heappop(agenda)
        if (place, state) in final:
            continue
        final.add((place, state))
        if place == length and (goals is None or state in goals):
            out[state] = (cost, audit)
            if goals is not None:
                break
        for further, then, more, edits in deductions(place, state):
            if place + further <= length and (place + further, then) not in final:
                heapq.heappush(agenda, (cost + more, audit + edits, place + further, then))
    return out


def _edits(codes: tuple[tuple[str, int], ...]):
    """The rules over rows, each given by its role's initial and its fault."""

    def deductions(place: int, state: int):
        given = _STEP[state][_NEXT[state][0]]
        yield 0, given, INSERT, "I"
        if place < len(codes):
            initial, fault = codes[place]
            yield 1, state, DELETE, "D"
            if fault not in (BLANK, DUPLICATE):
                more = CUT if fault == TRUNCATED else 0
                if initial in _STEP[state]:
                    yield 1, _STEP[state][initial], more, "K"
                yield 1, given, REROLE + more, "R"

    return deductions


@functools.lru_cache(1 << 16)
def _block(codes: tuple[tuple[str, int], ...]) -> Items:
    rules = _edits(codes)
    return {(p, q): item for p in range(4) for q, item in lightest(len(codes), rules, p).items()}


def joined(runs: list[Items]) -> Items:
    """Items over runs that follow each other, pair by pair."""
    while len(runs) > 1:
        pairs = []
        for k in range(0, len(runs) - 1, 2):
            def deductions(place: int, state: int, k=k):
                return [(1, q, *item) for (p, q), item in runs[k + place].items() if p == state] if place < 2 else ()

            pairs.append({(p, q): item for p in range(4) for q, item in lightest(2, deductions, p).items()})
        runs = pairs + runs[2 * len(pairs):]
    return runs[0] if runs else _block(())


def items_of(codes: list[tuple[str, int]]) -> Items:
    """The lightest item between each pair of states over some rows."""
    return joined([_block(tuple(codes[i:i + BLOCK])) for i in range(0, len(codes), BLOCK)])


@functools.lru_cache(1 << 16)
def _short(codes: tuple[tuple[str, int], ...]) -> Item:
    return next(iter(lightest(len(codes), _edits(codes), START, {START, AFTER_A}).values()))


def repair(codes: list[tuple[str, int]]) -> Item:
    """(cost, audit) of the cheapest repair of a whole conversation."""
    if len(codes) <= BLOCK:
        return _short(tuple(codes))
    return min(item for (p, q), item in items_of(codes).items() if p == START and q in (START, AFTER_A))


class Repaired:
    """Applies an audit to rows that come one by one; holds the hash of what stays, not the text."""

    def __init__(self):
        self.state, self.hash, self.first = START, hashlib.sha256(), True

    def _add(self, role: str, text: str) -> None:
        self.hash.update((role + ":" + text if self.first else "\n" + role + ":" + text).encode())
        self.first = False
        self.state = _STEP[self.state][role[:1]]

    def row(self, audit: str, at: int, role: str, text: str) -> int:
        """Applies the edits up to this row's and the insertions behind it; gives the place in the audit behind them."""
        while audit[at] == "I":
            self._add(_NEXT[self.state], "")
            at += 1
        if audit[at] == "K":
            self._add(role, text)
        elif audit[at] == "R":
            self._add(_NEXT[self.state], text)
        at += 1
        while at < len(audit) and audit[at] == "I":
            self._add(_NEXT[self.state], "")
            at += 1
        return at


# rows


def damaged(rows: DataFrame) -> DataFrame:
    """The damage of the contract: by crc32(``conv_id:turn``) % 20 a row is dropped, emptied, loses its ends, is repeated or becomes the user's."""
    spaced = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = (F.crc32(name.cast("binary")) % 20).cast("int")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (spaced.withColumn("kind", kind).where("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy"))


def _ordered(rows: DataFrame) -> DataFrame:
    """(part, at, first_copy key and fault of the row): rows in order of conversation, turn, role and text, written so that places last."""
    spark = rows.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    # rows that agree in all of these may be parted anywhere
    ranged = rows.withColumn("_any", F.monotonically_increasing_id()).repartitionByRange(*keys, "_any").sortWithinPartitions(*keys)
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(trimmed == "", BLANK).when(~F.right(trimmed, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(RIGHT)
    folder = scratch_dir(spark, "turns")
    ranged.drop("_any").select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), fault.alias("fault"),
                               F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256).alias("said")).write.option("compression", "zstd").parquet(folder)
    return spark.read.parquet(folder)


def _with_duplicates(rows: DataFrame) -> DataFrame:
    """Rows whose role and text stand earlier in their conversation are DUPLICATE, unless BLANK."""
    said = rows.select(F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("unnamed"), "said", "at", "fault").where(F.col("fault") != BLANK).drop("fault")
    key = ["conv", "unnamed", "said"]
    again = said.groupBy(key).agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").select(*key, "first")
    later = said.join(again, key).where("at > first").select("at", F.lit(DUPLICATE).alias("again"))
    return rows.drop("said").join(later, "at", "left").withColumn("fault", F.coalesce("again", "fault")).drop("again")


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_RUN = ("conv_id long, part int, at long, whole boolean, " + "".join(f"{c} long, " for c in _COUNTS)
        + "least long, most long, turns long, first string, last string, cost long, audit string, sha string, "
        "items array<struct<from_state:int,to_state:int,cost:long,audit:string>>")


class _Run:
    """The rows of one conversation in one partition."""

    def __init__(self, conv, part, at):
        self.conv, self.part, self.at = conv, part, at
        self.codes, self.rows, self.turns = [], [], []

    def add(self, turn, role, text, fault):
        self.codes.append((role[:1], fault))
        self.rows.append((role, text))
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def result(self, whole: bool) -> dict:
        faults = [f for _, f in self.codes]
        out = {"conv_id": self.conv, "part": self.part, "at": self.at, "whole": whole, "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
               "truncated": faults.count(TRUNCATED), "illegal": sum(a + b not in _LEGAL for (a, _), (b, _) in zip(self.codes, self.codes[1:])),
               "least": min(self.turns, default=None), "most": max(self.turns, default=None), "turns": len(self.turns),
               "first": self.codes[0][0], "last": self.codes[-1][0], "cost": None, "audit": None, "sha": None, "items": None}
        if whole:
            cost, audit = repair(self.codes)
            done, at = Repaired(), 0
            for role, text in self.rows:
                at = done.row(audit, at, role, text)
            out |= {"cost": cost, "audit": audit, "sha": done.hash.hexdigest()}
        else:
            out["items"] = [{"from_state": p, "to_state": q, "cost": c, "audit": a} for (p, q), (c, a) in items_of(self.codes).items()]
        return out


def _runs(rows: DataFrame) -> DataFrame:
    """One row a conversation and partition: counts, and the repair if the conversation lies inside the partition, else its items."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("whole", pa.bool_()), *[(c, pa.int64()) for c in _COUNTS],
                        ("least", pa.int64()), ("most", pa.int64()), ("turns", pa.int64()), ("first", pa.string()), ("last", pa.string()),
                        ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string()),
                        ("items", pa.list_(pa.struct([("from_state", pa.int32()), ("to_state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leads, out = None, True, []
        for batch in batches:
            for conv, part, at, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or (part, conv) != (now.part, now.conv):
                    if now is not None:  # the first and the last of a partition may go on in others
                        out.append(now.result(not leads and part == now.part))
                        leads = part != now.part
                    now = _Run(conv, part, at)
                now.add(turn, role, text, fault)
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if now is not None:
            out.append(now.result(False))
        yield pa.RecordBatch.from_pylist(out, schema)

    dealt = rows.select("conv_id", "part", "at", "turn", "role", "text", "fault").repartition("part").sortWithinPartitions("part", "at")
    return dealt.mapInArrow(run, _RUN)


def _join_runs(batch_rows: list[dict]) -> tuple[dict, list[tuple[int, str]]]:
    """A conversation's counts, cost and audit from its runs, and the audit of each run by its first row's place."""
    runs = sorted(batch_rows, key=lambda r: r["at"])
    out = {c: sum(r[c] for r in runs) for c in [*_COUNTS, "turns"]}
    out["illegal"] += sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(runs, runs[1:]))
    met = None
    for r in runs:
        if r["least"] is not None:
            out["turns"] -= r["least"] == met
            met = r["most"]
    out |= {"least": min((r["least"] for r in runs if r["least"] is not None), default=None), "most": max((r["most"] for r in runs if r["most"] is not None), default=None)}
    tables = [{(i["from_state"], i["to_state"]): (i["cost"], i["audit"]) for i in r["items"]} for r in runs]
    out["cost"], out["audit"] = min(item for (p, q), item in joined(list(tables)).items() if p == START and q in (START, AFTER_A))
    # audits fix states: cut the audit at each run's number of rows (insertions behind a run belong to the next, or to the last)
    pieces, at = [], 0
    for k, r in enumerate(runs):
        rows = len(tables[k][(START, START)][1].replace("I", ""))  # deleting all rows is an item of each run
        begin = at
        while rows:
            rows -= out["audit"][at] != "I"
            at += 1
        pieces.append((r["at"], out["audit"][begin:at if k + 1 < len(runs) else None]))
    return out, pieces


def _crossing(runs: DataFrame, rows: DataFrame) -> DataFrame:
    """The repairs of conversations that cross partitions."""
    names = ["conv_id", *_COUNTS, "least", "most", "turns", "cost", "audit"]
    kinds = "conv_id long, " + "".join(f"{c} long, " for c in _COUNTS) + "least long, most long, turns long, cost long, audit string, pieces array<struct<at:long,piece:string>>"
    parts = runs.where("NOT whole").select("conv_id", F.struct("at", *_COUNTS, "least", "most", "turns", "first", "last", "items").alias("run"))
    gathered = parts.groupBy("conv_id").agg(F.collect_list("run").alias("runs"))
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in [*_COUNTS, "least", "most", "turns", "cost"]], ("audit", pa.string()),
                        ("pieces", pa.list_(pa.struct([("at", pa.int64()), ("piece", pa.string())])))])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, own in zip(*(c.to_pylist() for c in batch.columns)):
                result, pieces = _join_runs(own)
                out.append(result | {"conv_id": conv, "pieces": [{"at": a, "piece": p} for a, p in pieces]})
            yield pa.RecordBatch.from_pylist(out, schema)

    folder = scratch_dir(rows.sparkSession, "crossing")
    gathered.mapInArrow(run, kinds).write.option("compression", "zstd").parquet(folder)
    settled = rows.sparkSession.read.parquet(folder)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, audit, at = None, None, "", 0
        out = pa.schema([("conv_id", pa.int64()), ("sha", pa.string())])
        for batch in batches:
            for conv, role, text, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if done is None or conv != now:
                    if done is not None:
                        yield pa.RecordBatch.from_pylist([{"conv_id": now, "sha": done.hash.hexdigest()}], out)
                    now, done = conv, Repaired()
                if piece is not None:
                    audit, at = piece, 0
                at = done.row(audit, at, role, text)
        if done is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": now, "sha": done.hash.hexdigest()}], out)

    convs = settled.select(F.col("conv_id").alias("conv"))
    pieces = settled.select(F.explode("pieces").alias("p")).select("p.*")
    own = rows.select("conv_id", "at", "role", "text").join(convs, F.col("conv_id").eqNullSafe(F.col("conv")), "left_semi")
    each = own.join(pieces, "at", "left").repartition("conv_id").sortWithinPartitions("conv_id", "at")
    hashes = each.select("conv_id", "role", "text", "piece").mapInArrow(stream, "conv_id long, sha string").withColumnRenamed("conv_id", "conv")
    return settled.join(hashes, F.col("conv_id").eqNullSafe(F.col("conv"))).select(*names, "sha")


def repairs(rows: DataFrame) -> DataFrame:
    """One row a conversation of (conv_id, turn, role, text): gaps, counts of faults, cost, audit and hash of its repair.

    Rows stand by turn (NULL first), then role and text.  A row's first fault
    counts: blank, duplicate (role and text seen earlier in the conversation),
    truncated.  NULL role or text count as one space; an empty role has no
    initial and is never legal; NULL conv_id is a conversation of its own;
    rows that repeat all columns are duplicates of each other; other columns
    are ignored; an empty table gives an empty result.
    """
    given = common.narrow(rows, conv_id="long", turn="long", role="string", text="string").withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    ordered = _ordered(given)
    folder = scratch_dir(rows.sparkSession, "runs")
    marked = _with_duplicates(ordered)
    _runs(marked).write.option("compression", "zstd").parquet(folder)
    runs = rows.sparkSession.read.parquet(folder)
    inside = runs.where("whole").select("conv_id", *_COUNTS, "least", "most", "turns", "cost", "audit", "sha")
    every = inside.union(_crossing(runs, ordered))
    gaps: Column = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0).cast("long"))
    return every.select("conv_id", gaps.alias("gaps"), *_COUNTS, "cost", "audit", F.col("sha").alias("repaired_sha256"))


def repaired_after_damage(rows: DataFrame) -> DataFrame:
    """``repairs`` of the damaged rows for every conversation of ``rows``; one of which no row is left has zeros, no audit and the hash of nothing."""
    given = common.narrow(rows, conv_id="long", turn="long", role="string", text="string")
    found = repairs(damaged(given)).withColumnRenamed("conv_id", "found_id")
    convs = given.select("conv_id").distinct()
    every = convs.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    zero, nothing = F.lit(0).cast("long"), F.lit(hashlib.sha256(b"").hexdigest())
    return every.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", *_COUNTS, "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
