"""Classification of rows by the first check that fails, with counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import reason_bucket


def classified(df: DataFrame, checks: list[tuple[str | Column, Column]], out: str = "drop_reason") -> DataFrame:
    """Adds the name of the first check whose condition (true: failed; null: passed) holds, null where none does."""
    first = None
    for name, failed in checks:
        value = F.lit(name) if isinstance(name, str) else name
        first = F.when(F.coalesce(failed, F.lit(False)), value) if first is None else first.when(F.coalesce(failed, F.lit(False)), value)
    return df.withColumn(out, first)


def counters(df: DataFrame, reason: str = "drop_reason", fixed: Column | None = None) -> DataFrame:
    """(counter, n): total, kept, dropped, rows_with_text_fixes and one drop_<bucket> for each reason met; counters of none are left out."""
    fixed = F.lit(False) if fixed is None else fixed
    base = df.select(F.explode(F.array_compact(F.array(
        F.lit("total"),
        F.when(F.col(reason).isNull(), F.lit("kept")).otherwise(F.lit("dropped")),
        F.when(F.col(reason).isNull() & fixed, F.lit("rows_with_text_fixes")),
        F.when(F.col(reason).isNotNull(), F.concat(F.lit("drop_"), reason_bucket(F.col(reason)))),
    ))).alias("counter"))
    return base.groupBy("counter").agg(F.count("*").alias("n"))


def keep_rate(df: DataFrame, reason: str = "drop_reason") -> DataFrame:
    """One row: total, kept and their ratio, 0.0 for no rows."""
    kept = F.count_if(F.col(reason).isNull())
    return df.agg(F.count("*").alias("total"), kept.alias("kept"), F.coalesce(F.try_divide(kept, F.count("*")), F.lit(0.0)).alias("keep_rate"))


def first_failures(df: DataFrame, order: str, reason: str = "drop_reason", n: int = 20) -> DataFrame:
    """The first failures in input order (a report of n rows)."""
    return df.where(F.col(reason).isNotNull()).orderBy(order).limit(n)
