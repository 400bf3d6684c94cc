"""Deduplication and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def hashed(key: Column) -> Column:
    """A 128-bit key for grouping by a text; null is a key of its own."""
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("0"))))


def first_by_key(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key (null is a key of its own).  The minimum is taken before the shuffle, so hot keys do not pile up; the key
    is shuffled as a hash."""
    cols = df.columns
    row = F.min_by(F.struct(*[F.col(f"`{c}`") for c in cols]), order).alias("__row")
    return df.withColumn("__key", hashed(key)).groupBy("__key").agg(row).select("__row.*")


def _without(rows: DataFrame, key: str, dead: DataFrame, heavy: int) -> DataFrame:
    """Rows whose key is not dead(k, n).  Keys of more than ``heavy`` rows (at most rows / heavy) go by broadcast, so none fills a task."""
    hot, rest = (dead.where(c).select(F.col("k").alias(key)) for c in (F.col("n") > heavy, F.col("n") <= heavy))
    return rows.join(F.broadcast(hot), key, "left_anti").join(rest, key, "left_anti")


def _greedy(batches):
    """The accepted ``o`` of rows (o, a, b) in order."""
    import pandas as pd

    seen_a, seen_b = set(), set()
    for pdf in batches:
        out = []
        for o, a, b in zip(pdf["o"], pdf["a"], pdf["b"]):
            if a not in seen_a and b not in seen_b:
                seen_a.add(a)
                seen_b.add(b)
                out.append(o)
        yield pd.DataFrame({"o": out})


def two_key_dedup(df: DataFrame, order: str, key_a: Column, key_b: Column, finish_at: int = 200_000, heavy: int = 100_000) -> DataFrame:
    """Rows in ``order`` are accepted unless an accepted row has the same first or the same second key; rejected rows block nothing.

    Rounds of peeling: a row that comes first in both its groups among the rows left is accepted, and the rows that share a key with it
    leave (the first round settles every row with unique keys).  Once at most ``finish_at`` rows are left, one task goes through their
    hashes in order, so long chains of rows that hang on each other end there.  Null keys count as values.  ``order`` must be unique.
    """
    left = cut(df.select(F.col(order).alias("o"), hashed(key_a).alias("a"), hashed(key_b).alias("b")))
    kind, keep = left.schema["o"].dataType.simpleString(), None
    add = lambda keep, x: x if keep is None else keep.unionByName(x)
    while (n := left.count()) > finish_at:
        # The first row of each key of either side, in one shuffle of partial minima.
        sides = left.select("o", "a", "b", F.explode(F.array(F.struct(F.lit("a").alias("s"), F.col("a").alias("k")), F.struct(F.lit("b").alias("s"), F.col("b").alias("k")))).alias("x"))
        firsts = cut(sides.groupBy("x.s", "x.k").agg(F.min(F.struct("o", "a", "b")).alias("m"), F.count("*").alias("n")))
        won = firsts.groupBy("m.o").agg(F.count("*").alias("c")).where("c = 2").select("o")
        dead = cut(firsts.select("s", "k", "n", F.col("m.o").alias("o")).join(won, "o"))
        keep = add(keep, dead.where("s = 'a'").select("o"))
        for side in "ab":
            left = _without(left, side, dead.where(F.col("s") == side).select("k", "n"), heavy)
        left = cut(left)
    if n:
        keep = add(keep, cut(left.coalesce(1).sortWithinPartitions("o").mapInPandas(_greedy, f"o {kind}")))
    if keep is None:
        return df.limit(0)
    return df.join(keep.withColumnRenamed("o", order), order, "left_semi")


def dense_ids(df: DataFrame, value: Column, name: str, id_name: str) -> DataFrame:
    """Distinct non-empty values, numbered from 1 in their order.  The values are one dimension's: few."""
    one = df.select(value.alias(name)).where(F.col(name).isNotNull() & (F.col(name) != "")).distinct()
    return numbered(one, [name], id_name)


def first_seen_ids(df: DataFrame, keys: list[Column], order: str, keep: list[str], id_name: str) -> DataFrame:
    """One row for each key, with the first row's ``keep`` columns, numbered from 1 in the order the keys were first seen."""
    names = [f"__k{i}" for i in range(len(keys))]
    keyed = df.select(*[k.alias(n) for k, n in zip(keys, names)], F.col(order).alias("__o"), *keep)
    first = keyed.groupBy(*names).agg(F.min_by(F.struct("__o", *keep), "__o").alias("x")).select(*names, "x.*")
    return numbered(first, ["__o"], id_name)


def numbered(df: DataFrame, order: list[str], id_name: str) -> DataFrame:
    """Numbers rows from 1 in a total order, without one task for all: rows are sorted by range, counted by partition, and numbered by
    the partition's offset.  The offsets are one row for each partition."""
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("n"))
    base = sizes.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__base"))
    return ranged.join(F.broadcast(base), "__p").withColumn(id_name, F.col("__base") + F.col("__i") + 1).drop("__p", "__i", "__base")
