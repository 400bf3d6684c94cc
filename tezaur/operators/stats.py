"""Distributions, hints and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def summary_counts(df: DataFrame, plain: list[str], listed: list[str]) -> DataFrame:
    """(facet, value, n): rows by each plain column (as text) and by each element of the listed columns (an empty list counts nothing).
    One pass over the table."""
    one = [F.array(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))) for c in plain]
    none = F.array().cast("array<struct<facet:string,value:string>>")

    def pairs(c: str) -> Column:
        return F.coalesce(F.transform(F.col(c), lambda x: F.struct(F.lit(c).alias("facet"), x.cast("string").alias("value"))), none)

    many = [pairs(c) for c in listed]
    return df.select(F.explode(F.flatten(F.array(*one, *many))).alias("x")).groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


def number_summary(df: DataFrame, c: str) -> DataFrame:
    """One row: least, most and mean, 0 where there are no rows."""
    return df.agg(F.coalesce(F.min(c), F.lit(0)).alias("least"), F.coalesce(F.max(c), F.lit(0)).alias("most"), F.coalesce(F.avg(c), F.lit(0.0)).alias("mean"))


def distinct_values(df: DataFrame, c: str, n: int = 50) -> DataFrame:
    """The first n distinct non-null values in order (a report); values are stripped and empty ones dropped only then."""
    first = df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).limit(n)
    return first.select(strip(F.col(c).cast("string")).alias("value")).where("value <> ''")


def top_counts(df: DataFrame, other: DataFrame, on: str, label: str, n: int = 20) -> DataFrame:
    """The n keys with most rows, by label on ties (a report).  Rows are counted by key before the join, so a hot key is no hot task;
    null labels are dropped after the cut."""
    counts = df.groupBy(on).agg(F.count("*").alias("n"))
    top = counts.join(other.select(on, label), on).orderBy(F.desc("n"), F.asc_nulls_first(label), on).limit(n)
    return top.where(F.col(label).isNotNull())


def ordered_tokens(df: DataFrame, c: str, order: list[str], n: int = 20, sep: str = ",") -> DataFrame:
    """The first n distinct tokens of a list column in the order they are first seen (a report): (token, place)."""
    cells = df.select(*order, F.posexplode(F.split(c, sep)).alias("pos", "t")).withColumn("token", strip(F.col("t"))).where("token <> ''")
    first = cells.groupBy("token").agg(F.min(F.struct(*order, "pos")).alias("place"))
    return first.orderBy("place").limit(n)


def joined_distinct(c: Column, sep: str = ", ") -> Column:
    """Aggregate: distinct values in order, joined; null for none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(c)), sep), F.lit(""))


def record(summary: DataFrame, numbers: DataFrame) -> dict:
    """The statistics record of summary_counts() and number_summary(): values in order within each facet."""
    out: dict = {}
    for r in summary.orderBy("facet", "value").collect():
        out.setdefault(r.facet, {})[r.value] = r.n
    return {"total": sum(out.get("domain", {}).values()), **{f"by_{k}": v for k, v in out.items()}, "row_count": numbers.first().asDict()}
