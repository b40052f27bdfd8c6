"""Rule-based row validation: ordered rules, first failure wins.

The reference validates row by row in loops with exception handlers; here a
rule list becomes one ``CASE WHEN`` chain evaluated on every row in
parallel, producing a status and a message column.  Valid and rejected rows
come from the same tagged DataFrame (persist it when both sides are
written), and error-log rows carry a JSON payload built with ``to_json``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.joins import bounded

Rule = tuple[Column, Column]      # (failure condition, message)


def first_failure(rules: Sequence[Rule]) -> Column:
    """Message of the first rule whose condition is TRUE, else NULL.  A NULL
    condition does not fire (like an IF in the reference)."""
    out = F.lit(None).cast("string")
    for cond, msg in reversed(list(rules)):
        out = F.when(F.coalesce(cond, F.lit(False)), msg).otherwise(out)
    return out


def any_failure(rules: Sequence[Rule]) -> Column:
    acc = F.lit(False)
    for cond, _ in rules:
        acc = acc | F.coalesce(cond, F.lit(False))
    return acc


def tag(df: DataFrame, rules: Sequence[Rule], status_col: str = "status", msg_col: str = "error_msg",
        ok: str = "VALID", bad: str = "ERROR") -> DataFrame:
    """Add ``status`` (ok / bad) and ``error_msg`` (first failing rule)."""
    failed = any_failure(rules)
    return (df.withColumn(status_col, F.when(failed, bad).otherwise(ok))
            .withColumn(msg_col, F.when(failed, first_failure(rules))))


def split(tagged: DataFrame, status_col: str = "status", ok: str = "VALID") -> tuple[DataFrame, DataFrame]:
    return tagged.filter(F.col(status_col) == ok), tagged.filter(F.col(status_col) != ok)


def json_payload(*cols: str) -> Column:
    """``jsonb_build_object(k, v, ...)`` -> JSON text."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def range_check(df: DataFrame, type_col: str, value_col: str, ranges: DataFrame,
                unknown_code: str, range_code: str) -> DataFrame:
    """Validate ``value_col`` against an inclusive range per ``type_col``.

    ``ranges`` is a small fixed table (type, lo, hi, unit) — broadcast.  A
    type missing from it is ``unknown_code``; a value outside is
    ``range_code`` with a hint; a NULL value passes (a comparison with NULL
    is not TRUE).
    """
    r = ranges.select(F.col(ranges.columns[0]).alias("_rt"), F.col(ranges.columns[1]).alias("_lo"),
                      F.col(ranges.columns[2]).alias("_hi"), F.col(ranges.columns[3]).alias("_unit"))
    j = df.join(bounded(r), F.col(type_col) == F.col("_rt"), "left")
    v = F.col(value_col)
    unknown = F.col("_rt").isNull()
    out_of = (v < F.col("_lo")) | (v > F.col("_hi"))
    code = F.when(unknown, unknown_code).when(F.coalesce(out_of, F.lit(False)), range_code)
    return (j.withColumn("status", F.when(code.isNull(), "OK").otherwise("ERROR"))
            .withColumn("error_code", code)
            .withColumn("message", F.when(unknown, F.format_string("unknown sensor type: %s", F.col(type_col)))
                        .when(F.coalesce(out_of, F.lit(False)),
                              F.format_string("value %s out of range for type %s",
                                              v.cast("decimal(12,2)").cast("string"), F.col(type_col))))
            .withColumn("hint", F.when(F.coalesce(out_of, F.lit(False)) & ~unknown,
                                       F.format_string("allowed range: %s..%s %s", F.col("_lo").cast("string"),
                                                       F.col("_hi").cast("string"), F.col("_unit"))))
            .drop("_rt", "_lo", "_hi", "_unit"))


def batch_gate(batches: DataFrame, batch_col: str, ok_col: str) -> DataFrame:
    """Per batch: rows, failing rows and whether the whole batch passes (a
    batch loads only if every row is valid — the savepoint rollback)."""
    return (batches.groupBy(batch_col)
            .agg(F.count(F.lit(1)).alias("batch_rows"),
                 F.count_if(~F.col(ok_col)).alias("bad_rows"))
            .withColumn("accepted", F.col("bad_rows") == 0))
