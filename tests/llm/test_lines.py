import random
import re

import pytest

from lodestone.llm import lines, queries


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def words(line):
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", line) if w]


def plain(rows):
    """Removed lines by comparing every two lines; rows in order of doc_id, which is unique and not NULL."""
    seen, out = [], {}
    for d, t in sorted(rows):
        kept = []
        for i, line in enumerate((t or "").split("\n")):
            w = words(line)
            if not w:
                continue
            near = any(w == v or (len(w) >= 4 and len(v) >= 4 and abs(len(w) - len(v)) <= 1 and distance(w, v) <= 1) for v in seen)
            if not near:
                kept.append(i)
            seen.append(w)
        out[d] = kept
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, kept string, n_chars long").repartition(3)


def edited(rng, w):
    w, i = list(w), rng.randrange(len(w))
    kind = rng.randrange(3)
    if kind == 0:
        w[i] = f"new{rng.randrange(9)}"
    elif kind == 1:
        w.insert(i, f"new{rng.randrange(9)}")
    else:
        del w[i]
    return w


def test_random_edits_against_brute_force(spark):
    rng = random.Random(7)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randint(1, 30))] for _ in range(40)] + [["a"] * 12, ["a", "b"] * 6]
    rows = []
    for d in range(60):
        picked = [rng.choice(base) for _ in range(rng.randint(0, 6))]
        for _ in range(2):
            picked = [edited(rng, w) if rng.random() < 0.4 and w else w for w in picked]
        rows.append((d, "\n".join((" " if rng.random() < 0.8 else " \t ").join(w) for w in picked) + rng.choice(["", "\n", "\n\n"])))
    got = {r.doc_id: r for r in lines.line_duplicates(frame(spark, rows)).collect()}
    want = plain(rows)
    assert {d: r.kept_lines for d, r in got.items()} == want
    assert all(r.n_removed == r.n_lines - len(r.kept_lines) for r in got.values())
    assert sum(r.n_removed for r in got.values()) > 20


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.kept_lines for r in queries.QUERIES["op6_line_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert got == plain(rows)


def test_main_path_is_native(spark):
    text = lines.line_duplicates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", text)


def test_odd_rows(spark):
    long = "one two three four five six seven eight nine"
    rows = [(1, None), (2, ""), (3, "\n \n"), (4, "same\nsame\n\nother"), (5, "same"), (6, long), (7, long.replace("five", "5")), (8, f"{long} ten"), (9, "x " * 30000), (10, "x " * 29999)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_lines) for r in lines.line_duplicates(frame(spark, rows)).collect()}
    assert got == {1: (0, 0, []), 2: (0, 0, []), 3: (0, 0, []), 4: (3, 1, [0, 3]), 5: (1, 1, []), 6: (1, 0, [0]), 7: (1, 1, []), 8: (1, 1, []), 9: (1, 0, [0]), 10: (1, 1, [])}
    repeated = lines.line_duplicates(frame(spark, [(1, "a\nb")] * 2 + [(None, "b\nc")])).collect()
    assert sorted(((r.doc_id, r.kept_lines) for r in repeated), key=str) == sorted([(1, [0, 1]), (1, [0, 1]), (None, [1])], key=str)
    assert lines.line_duplicates(frame(spark, [])).count() == 0


def test_documents_without_their_duplicate_lines(spark):
    rows = [(1, "a\n\nb"), (2, "b\nc\n"), (3, "a\nb"), (4, None), (5, " ")]
    kept = lines.without_duplicates(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "kept", "n_chars"]
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "a\n\nb", 2: "c\n", 4: None, 5: " "}


@pytest.mark.parametrize("n", [3, 4, 5, 7, 8, 9])
def test_lines_of_every_short_length(spark, n):
    """Each line with every word deleted, replaced, and with a word put in at every place."""
    base = [f"w{i}" for i in range(n)]
    rows = [(0, " ".join(base))]
    rows += [(1 + i, " ".join(base[:i] + base[i + 1:])) for i in range(n)] + [(50 + i, " ".join(base[:i] + ["new"] + base[i + 1:])) for i in range(n)]
    rows += [(100 + i, " ".join(base[:i] + ["more"] + base[i:])) for i in range(n + 1)]
    got = {r.doc_id: r.kept_lines for r in lines.line_duplicates(frame(spark, rows)).collect()}
    assert got == plain(rows)
    assert sum(len(k) for k in got.values()) == (1 if n > 4 else 1 + n if n == 4 else len(rows))


@pytest.mark.parametrize("m", [8, 9, 100, 5000])
def test_segments_cover_the_line(spark, m):
    from pyspark.sql import functions as F
    one = spark.range(1).select(F.lit(m).alias("m"))
    q = one.select(lines._segments(F.col("m")).alias("q")).first().q
    bounds = [one.select(*lines._bounds(F.col("m"), F.lit(j))).first() for j in range(q)] if q < 10 else []
    assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))
    assert not bounds or (bounds[0][0], bounds[-1][1]) == (0, m)
