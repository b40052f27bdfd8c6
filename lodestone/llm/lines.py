"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

A line's words are its runs of non-white characters.  Equal lines are found by
a 128-bit hash of their words, which stands for them.  Lines of at least
``LEAST_WORDS`` words are also duplicates within one word inserted, deleted or
replaced.

*Fewer variants.*  Two lines of 2 k words or more that are one edit apart agree on
their first or on their last k words, whichever the edit doesn't touch (k is
``EDGE``, and half of that for lines of fewer than 2 ``EDGE`` words, with which
lines of just so many are compared both ways); lines that share neither with
another line are done.  The others are cut into ``q`` segments; the line
without one segment is a hashed key, and only where two lines share such a key
are variants made, with one word of that segment deleted.

*Links.*  Lines of m words with the same word place deleted and equal otherwise
are a replacement apart, all of them: a group needs only its earliest line,
found by an aggregation that combines map-side.  A line of m + 1 words that
equals, with a word deleted, a whole line of m words is an insertion apart.
Every such link is verified on the words of both lines before a line goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import scratch_dir

LEAST_WORDS, EDGE, SEGMENTS = 4, 4, 4
_ID = ["doc", "text_hash", "line"]


def _written(df: DataFrame, name: str) -> DataFrame:
    folder = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _documents(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, doc_id, text): a NULL doc_id stands behind all others."""
    have = set(docs.columns)
    doc_id, text = ((F.col(c) if c in have else F.lit(None)).cast(t) for c, t in (("doc_id", "long"), ("text", "string")))
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    return rows.select(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("text_hash"), "doc_id", "text")


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, "\\s+"), "")


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, line, words): the lines that have words; ``line`` counts from 0."""
    rows = _documents(docs).select("doc", "text_hash", F.posexplode(_split(F.col("text"))).alias("line", "value"))
    return rows.select(*_ID, _words(F.col("value")).alias("words")).where(F.size("words") > 0)


def distinct_lines(docs: DataFrame) -> DataFrame:
    """The earliest place of each different line, its number of words and the hashes of its edges (none for very short lines)."""
    rows = lines_of(docs)
    n = F.size("words")

    def edges(k: int, some: Column) -> Column:
        first, last = F.xxhash64(F.lit(f"first {k}"), F.slice("words", 1, k)), F.xxhash64(F.lit(f"last {k}"), F.slice("words", -k, k))
        return F.when(some, F.array(first, last)).otherwise(F.array().cast("array<bigint>"))

    wide = edges(EDGE, n >= 2 * EDGE)
    narrow = edges(EDGE // 2, (n >= LEAST_WORDS) & (n <= 2 * EDGE))
    hashed = rows.select(F.xxhash64("words").alias("a"), F.xxhash64(F.lit(1), F.col("words")).alias("b"), F.struct(*_ID).alias("place"), F.concat(wide, narrow).alias("edges"))
    found = hashed.groupBy("a", "b").agg(F.min("place").alias("place"), F.first("edges").alias("edges"))
    return found.select("place.*", "edges")


def _shared(rows: DataFrame, key: list[str], least: Column) -> DataFrame:
    """Rows whose key's group is large enough (the groups are written, so that a hot key's rows can be split in the join)."""
    groups = _written(rows.groupBy(key).agg(least.alias("_shared")).where("_shared").select(*key), "shared")
    return rows.join(groups, key, "left_semi")


def _candidates(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc, text_hash, line, words) of lines that share an edge with another line."""
    edges = lines.select(*_ID, F.explode("edges").alias("edge"))
    some = _shared(edges, ["edge"], F.count("*") > 1)
    wanted = some.groupBy("doc", "text_hash").agg(F.collect_set("line").alias("wanted"))
    texts = _documents(docs).select("doc", "text_hash", "text").join(wanted, ["doc", "text_hash"])
    each = texts.select("doc", "text_hash", "wanted", F.posexplode(_split(F.col("text"))).alias("line", "value"))
    return each.where(F.array_contains("wanted", F.col("line"))).select(*_ID, _words(F.col("value")).alias("words")).distinct()


def _segments(m: Column) -> Column:
    return F.greatest(F.lit(SEGMENTS), F.ceil(F.sqrt(m) / 2).cast("int"))


def _bounds(m: Column, j: Column) -> tuple[Column, Column]:
    q = _segments(m)
    return F.floor(m * j / q).cast("int"), F.floor(m * (j + 1) / q).cast("int")


def _without_segment(lines: DataFrame) -> DataFrame:
    """Each line as one of m words and, with a word to spare, as one of m + 1: keyed by all words outside a segment."""
    n = F.size("words")
    as_m = lines.select("*", F.explode(F.array(F.struct(n.alias("m"), F.lit(False).alias("spare")), F.struct((n - 1).alias("m"), F.lit(True).alias("spare")))).alias("r"))
    each = as_m.where(f"r.m >= {LEAST_WORDS}").select("place", "words", "r.m", "r.spare", F.explode(F.sequence(F.lit(0), _segments(F.col("r.m")) - 1)).alias("j"))
    low, high = _bounds(F.col("m"), F.col("j"))
    cut = each.select("*", low.alias("low"), (F.col("m") - high).alias("behind"))
    rest = F.xxhash64(F.slice("words", F.lit(1), F.col("low")), F.slice("words", F.size("words") - F.col("behind") + 1, F.col("behind")))
    return cut.select("place", "m", "spare", "j", rest.alias("rest"))


def _segment() -> Column:
    low, high = _bounds(F.col("m"), F.col("j"))
    return F.slice("words", low + 1, F.size("words") - (F.col("m") - high) - low)


def _links(candidates: DataFrame) -> DataFrame:
    """(place, earlier): places of lines one edit apart by the hashes of their variants."""
    keyed = _written(_without_segment(candidates), "keyed")
    key = ["m", "j", "rest"]
    whole, spare = F.count_if(~F.col("spare")), F.count_if(F.col("spare"))
    shared = _shared(keyed, key, (whole > 1) | ((whole > 0) & (spare > 0)))
    live = _written(shared.join(candidates, "place").select("place", *key, "spare", _segment().alias("segment")), "segments")
    size = F.size("segment")  # the hash of two arrays is that of their elements in a row
    without = F.xxhash64(F.slice("segment", F.lit(1), F.col("i")), F.slice("segment", F.col("i") + 2, size))
    deleted = live.select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias("i")).select("place", *key, "spare", "i", without.alias("variant"))
    # a word replaced: the same place deleted, the rest equal
    group = [*key, "i", "variant"]
    replaced = deleted.where("NOT spare").drop("spare")
    least = replaced.groupBy(group).agg(F.min("place").alias("earlier"), F.count("*").alias("n")).where("n > 1").drop("n")
    same = replaced.join(least, group).where("place > earlier").select("place", "earlier")
    # a word more: a line with one deleted against whole lines
    full = live.where("NOT spare").select(F.col("place").alias("whole"), *key, F.xxhash64("segment").alias("variant"))
    one_more = deleted.where("spare").join(full, [*key, "variant"]).select("place", "whole")
    later = F.greatest("place", "whole")
    return same.union(one_more.select(later, F.least("place", "whole"))).distinct()


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words are at most one insertion, deletion or replacement apart."""
    shorter, longer = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))

    def common(x: Column, y: Column) -> Column:
        first = F.array_position(F.zip_with(F.slice(x, F.lit(1), shorter), F.slice(y, F.lit(1), shorter), lambda p, q: p != q), True)
        return F.when(first == 0, shorter).otherwise(first - 1)

    return (longer - shorter <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longer - 1)


def near_duplicates(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc, text_hash, line) of different lines that have an earlier line within one edit."""
    words = _written(_candidates(docs, lines).select(F.struct(*_ID).alias("place"), "words"), "candidates")
    links = _links(words)
    both = (links.join(words, "place").withColumnRenamed("words", "own")
            .join(words.withColumnRenamed("place", "earlier"), "earlier"))
    return both.where(_one_edit(F.col("own"), F.col("words"))).select("place.*").distinct()


def kept_lines(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, kept): the numbers of the lines with words that stay."""
    lines = _written(distinct_lines(docs), "lines")
    near = near_duplicates(docs, lines)
    return lines.select(*_ID).join(near, _ID, "left_anti").groupBy("doc", "text_hash").agg(F.sort_array(F.collect_list("line")).alias("kept"))


def line_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_lines (with words), n_removed and kept_lines (numbers from 0).

    Lines stand in order of doc_id (NULL last; then of a hash of the text) and
    number; a line goes if an earlier line has the same words, or if both have
    at least ``LEAST_WORDS`` words and are one word inserted, deleted or
    replaced apart.  Earlier lines count whether they stay or not.  Lines
    without words stay and aren't counted.  A NULL or empty text has no lines;
    rows that repeat both doc_id and text are treated alike; an empty table
    gives an empty result; other columns are ignored.
    """
    rows = _documents(docs).select("doc", "text_hash", "doc_id", F.size(F.filter(_split(F.col("text")), lambda x: x.rlike("\\S"))).alias("n_lines"))
    joined = rows.join(kept_lines(docs), ["doc", "text_hash"], "left")
    kept = F.coalesce("kept", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", (F.col("n_lines") - F.size(kept)).alias("n_removed"), kept.alias("kept_lines"))


def without_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that stay; documents of which no line with words stays go, unless they had none.

    Repeated rows are treated alike; NULL and blank texts stay as they are; all
    columns stay, whatever their names; an empty table gives an empty result.
    """
    keyed = docs.select(F.struct("*").alias("row"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    joined = keyed.join(kept_lines(docs), ["doc", "text_hash"], "left")
    own = F.col("row.text")
    numbered = F.transform(_split(own), lambda x, i: F.when(~x.rlike("\\S") | F.array_contains("kept", i), x))
    text = F.array_join(F.filter(numbered, lambda x: x.isNotNull()), "\n")
    blank = ~F.coalesce(own, F.lit("")).rlike("\\S")
    stays = joined.where(F.col("kept").isNotNull() | blank)
    return stays.select(*[F.when(blank, own).otherwise(text).alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
