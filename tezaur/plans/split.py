"""Evaluation split, its training complement and shard merge as whole plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sampling import complement, exact_sample, shuffled, tagged_union


def evaluation_split(queries: DataFrame, operators: DataFrame, id_col: str, ratio: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(evaluation, training): exact samples of both tracks in one seeded order, and the rows left, so that no row is in both."""
    parts = {"queries": queries, "operators": operators}
    samples = {k: exact_sample(df, id_col, ratio, seed) for k, df in parts.items()}
    rest = {k: complement(df, samples[k], id_col) for k, df in parts.items()}
    return shuffled(tagged_union(samples, "track"), id_col, seed), tagged_union(rest, "track")


def first_written(df: DataFrame, order: str, written: str, most: int | None) -> DataFrame:
    """Rows up to the one by which ``most`` rows (those where ``written`` is true) were written; later rows do not even count as read."""
    if most is None:
        return df
    last, n = df.where(F.col(written)).orderBy(order).limit(most).agg(F.max(order), F.count("*")).first()
    return df if n < most else df.where(F.col(order) <= last)


def file_counts(df: DataFrame, source: str, written: str) -> DataFrame:
    """(source, read, written, dropped) and the total under the name all."""
    counts = [F.count("*").alias("read"), F.count_if(written).alias("written"), F.count_if(~F.col(written)).alias("dropped")]
    out = df.rollup(source).agg(*counts, F.grouping(source).alias("g"))
    return out.select(F.when(F.col("g") == 1, "all").otherwise(F.col(source)).alias("source"), "read", "written", "dropped")
