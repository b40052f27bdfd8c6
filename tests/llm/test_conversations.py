import hashlib
import itertools
import random
import re
import zlib

import pytest

from lodestone.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string, cost string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(codes):
    """All audits over up to two insertions a place, tried one by one."""
    best = None
    inserts = ["", "I", "II"] if len(codes) < 3 else ["", "I"]
    for edits in itertools.product("DKR", repeat=len(codes)):
        if any(e != "D" and f in (conv.BLANK, conv.DUPLICATE) for e, (_, f) in zip(edits, codes)):
            continue
        for gaps in itertools.product(inserts, repeat=len(codes) + 1):
            audit = gaps[0] + "".join(e + g for e, g in zip(edits, gaps[1:]))
            cost = 5 * audit.count("I") + sum({"D": 2, "K": 0, "R": 1}[e] + (5 if e != "D" and f == conv.TRUNCATED else 0) for e, (_, f) in zip(edits, codes))
            if best is not None and (cost, audit) >= best:
                continue
            slots, left = [], list(codes)
            for e in audit:
                own = left.pop(0) if e != "I" else None
                if e != "D":
                    slots.append([own[0]] if e == "K" else ["u", "a"])
            if any(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in itertools.product(*slots) if all(x)):
                best = (cost, audit)
    return best


def plain(rows):
    out = []
    for c in {r[0] for r in rows}:
        damaged = []
        for _, turn, role, text in sorted((r[:4] for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0)):
            role, text = (" " if x is None else x for x in (role, text))
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            damaged += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        codes, seen = [], set()
        for _, role, text in damaged:
            last = WORD.findall(text)[-1:]
            codes.append((role[:1], conv.BLANK if not last else conv.DUPLICATE if (role, text) in seen else conv.RIGHT if last[0] in ".!?" else conv.TRUNCATED))
            seen.add((role, text))
        turns = {r[0] for r in damaged} - {None}
        cost, audit = cheapest(codes)
        stay, k, names = [], 0, []
        for e in audit:
            own = damaged[k] if e != "I" else None
            k += e != "I"
            if e != "D":
                need = "user" if not names or names[-1] in "sa" else "assistant"
                name, text = (own[1], own[2]) if e == "K" else (need, own[2] if own else "")
                names.append(name[:1])
                stay.append(f"{name}:{text}")
        faults = [f for _, f in codes]
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(conv.BLANK), faults.count(conv.DUPLICATE), faults.count(conv.TRUNCATED),
                    sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(codes, codes[1:])), cost, audit, hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(n, seed, most=4):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "cut off", "", " \t\n", None, "a. b", "é…", "Tail.\n ", "\x0b\x0c."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "userland", "User"]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, most)):
            turn = rng.choice([t, t, t, t + 3, None, -t])
            if turn not in [r[1] for r in rows if r[0] == c]:
                rows.append((c, turn, rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("n", range(5))
def test_lightest_derivations_against_all_edits(n):
    rng = random.Random(n)
    for _ in range(150 if n < 4 else 60):
        codes = [(rng.choice("ssuuuaaax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
        assert conv.repair(codes) == cheapest(codes), codes


def test_joined_items_are_those_of_one_run():
    rng = random.Random(4)
    for n in (0, 1, 3, 17, 200):
        codes = [(rng.choice("suuuaaa"), rng.choice([0, 0, 0, 0, 1, 3])) for _ in range(n)]
        whole = conv._block(tuple(codes))
        cut = sorted(rng.randint(0, n) for _ in range(4))
        runs = [conv.items_of(codes[a:b]) for a, b in zip([0, *cut], [*cut, n])]
        assert conv.joined(runs) == whole == conv.items_of(codes)
        assert conv.repair(codes) == min(v for (p, q), v in whole.items() if p == 0 and q in (0, 3))


def run(spark, rows, parts=4):
    df = spark.createDataFrame([(*r[:4], "x") for r in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, conv.repaired_after_damage(df).collect()), key=str)


def test_against_brute_force(spark):
    rows = rows_of(60, 1) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, None, None, None)]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_repeated_rows_are_duplicates(spark):
    rows = [(7, 1, "user", "Hi."), (7, 1, "user", "Hi."), (7, 1, "user", "Hi.")]
    assert run(spark, rows) == plain(rows)


def test_one_conversation_over_many_partitions(spark):
    """A long conversation with all kinds of faults, spread over tasks, is repaired as one run."""
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"turn {t % 700}" + rng.choice([".", "!", ""])) for t in range(3000)] + rows_of(5, 2)[5:]
    got = {r.conv_id: r for r in conv.repairs(spark.createDataFrame([(*r[:4], "x") for r in rows], SCHEMA).repartition(5)).collect()}
    codes, seen, texts = [], set(), []
    for _, _, role, text in sorted(r for r in rows if r[0] == 1):
        codes.append((role[0], conv.DUPLICATE if (role, text) in seen else conv.RIGHT if text[-1] in ".!?" else conv.TRUNCATED))
        seen.add((role, text))
        texts.append((role, text))
    cost, audit = conv.repair(codes)
    done, at = conv.Repaired(), 0
    for role, text in texts:
        at = done.row(audit, at, role, text)
    assert (got[1].cost, got[1].audit, got[1].repaired_sha256, got[1].gaps) == (cost, audit, done.hash.hexdigest(), 0)
    assert (got[1].duplicate, got[1].truncated) == (sum(f == conv.DUPLICATE for _, f in codes), sum(f == conv.TRUNCATED for _, f in codes))


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "end."), (1, 1, "assistant", "x" * 2_000_000), (1, 2, "assistant", " " * 1_000_000)]
    assert run(spark, rows) == plain(rows)
