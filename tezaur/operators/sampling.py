"""Exact samples, their complement, orders by seed and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import numbered


def rank_key(seed: int, id_col: str) -> Column:
    """A pseudorandom key that any engine computes alike."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def sample_size(n: int, ratio: float) -> int:
    if not 0 < ratio <= 1:
        raise ValueError("the ratio must be above 0 and at most 1")
    return max(1, min(n, int(n * ratio))) if n else 0


def exact_sample(df: DataFrame, id_col: str, ratio: float, seed: int = 42) -> DataFrame:
    """Exactly clamp(int(n * ratio), 1, n) rows: those of the smallest rank keys.  Ties of equal ids go by the id's order."""
    k = sample_size(df.count(), ratio)
    ranked = numbered(df.withColumn("__key", rank_key(seed, id_col)), ["__key", id_col], "__rank")
    return ranked.where(F.col("__rank") <= k).drop("__key", "__rank")


def complement(df: DataFrame, sample: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id is not in the sample."""
    return df.join(sample.select(id_col), id_col, "left_anti").select(*df.columns)


def shuffled(df: DataFrame, id_col: str, seed: int = 42, place: str = "place") -> DataFrame:
    """Adds each row's place from 1 in a seeded order."""
    return numbered(df.withColumn("__key", rank_key(seed, id_col)), ["__key", id_col], place).drop("__key")


def merged_shards(shards: list[tuple[int | None, DataFrame]]) -> DataFrame:
    """UNION ALL of shards in stable order of their index (0 where it lacks); adds shard and shard_place for the order."""
    out = None
    for place, (index, df) in enumerate(sorted(shards, key=lambda x: x[0] or 0)):
        one = df.withColumn("shard", F.lit(index or 0)).withColumn("shard_place", F.lit(place))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("no shards")
    return out


def tagged_union(parts: dict[str, DataFrame], tag: str = "source_dataset") -> DataFrame:
    out = None
    for name, df in parts.items():
        one = df.withColumn(tag, F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def interleaved(first: DataFrame, second: DataFrame, id_col: str, share: float, seed: int = 42) -> DataFrame:
    """Both tables in one seeded order in which each prefix has about ``share`` of rows from the first, until the smaller one is used up
    (``used`` tells the rows up to there)."""
    a = shuffled(first, id_col, seed, "place").withColumn("at", (F.col("place") - 0.5) / share).withColumn("part", F.lit(0))
    b = shuffled(second, id_col, seed + 1, "place").withColumn("at", (F.col("place") - 0.5) / (1 - share)).withColumn("part", F.lit(1))
    both = a.unionByName(b)
    end = both.groupBy("part").agg(F.max("at").alias("end")).agg(F.min("end")).first()[0]
    return both.withColumn("used", F.col("at") <= F.lit(end))
