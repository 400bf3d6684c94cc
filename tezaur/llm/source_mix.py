"""One mixture of several sources with target shares, sized in tokens.

Method: each source's tokens are packed, in a pseudorandom order of its documents, into blocks of fixed length.  Every output shard draws
how many of its slots go to each source: multinomial draws given the sources' totals, made by splitting the totals down a binary tree of
shards with seeded hypergeometric draws, so that any shard finds its counts and offsets by itself.  A slot's running number within
its source is mapped through the source's pseudorandom permutation of block indices (another one on each pass), and blocks are joined by
index.  A block, and so every token of a document, comes at most ``max_repeats`` times.

The documents are encoded once, to ids of two or four bytes; the shares are planned from their counts, and only blocks that some slot
draws are packed.  Slots are as many as blocks, so both sides are sorted and merged; neither is ever broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .tokenizer import VOCABULARY, packed_ids

BUCKET = 50_000
_M = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _rounds(size: int) -> tuple[np.uint64, np.uint64]:
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    return np.uint64(half), np.uint64((1 << half) - 1)


def permuted(index: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1, applied to ``index`` (or its inverse): four Feistel rounds, walked until inside."""
    half, mask = _rounds(size)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        left, right = x >> half, x & mask
        for r in range(4):
            if back:
                left, right = right ^ (_mix(left, key * 31 + 3 - r) & mask), left
            else:
                left, right = right, left ^ (_mix(right, key * 31 + r) & mask)
        out[todo] = (left << half) | right
        todo = out >= np.uint64(size)
    return out.astype(np.int64)


def hypergeometric(good: int, bad: int, n: int, u: float) -> int:
    """How many of ``n`` items drawn from ``good`` + ``bad`` ones are good, at the uniform number u: the distribution added up within twelve
    standard deviations of its mode (what lies beyond is below the precision of u)."""
    lo, hi = max(0, n - bad), min(n, good)
    if lo >= hi:
        return lo
    total = good + bad
    sd = (n * (good / total) * (bad / total) * ((total - n) / max(total - 1, 1))) ** 0.5
    mode = (n + 1) * (good + 1) // (total + 2)
    lo, hi = max(lo, mode - int(12 * sd) - 12), min(hi, mode + int(12 * sd) + 12)
    k = np.arange(lo, hi, dtype=np.float64)
    logs = np.concatenate([[0.0], np.cumsum(np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1)))])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(mass, u * mass[-1], "right"))


class Split:
    """The sources' totals split among shards of ``slots`` slots."""

    def __init__(self, totals: list[int], slots: int, shards: int, seed: int) -> None:
        self.totals, self.slots, self.shards, self.seed = tuple(map(int, totals)), slots, shards, seed
        self.first = lru_cache(1000)(self._first)  # shards come in order: the way down to the last one is enough

    def _first(self, lo: int, hi: int, left: tuple[int, ...]) -> tuple[int, ...]:
        """What the first half of the shards lo..hi gets of what is left for them: one hypergeometric draw for each source."""
        rng = np.random.default_rng([self.seed, lo, hi])
        rest, here, out = sum(left), ((lo + hi) // 2 - lo) * self.slots, []
        here = min(rest, here)
        for n in left:
            rest -= n
            out.append(hypergeometric(n, rest, here, rng.random()))
            here -= out[-1]
        return tuple(out)

    def __call__(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """(counts, offsets) of one shard: how many slots each source gets in it and in all shards before it."""
        lo, hi, left, offset = 0, self.shards, self.totals, (0,) * len(self.totals)
        while hi - lo > 1:
            first = self.first(lo, hi, left)
            if shard < (mid := (lo + hi) // 2):
                left, hi = first, mid
            else:
                offset, left, lo = tuple(map(sum, zip(offset, first))), tuple(a - b for a, b in zip(left, first)), mid
        return np.array(left, np.int64), np.array(offset, np.int64)


def plan(sources: list[tuple[str, float, int, int]]) -> dict[str, int]:
    """sources(name, share, most repeats, blocks) -> blocks of the mixture: the largest total at which every source that has blocks
    keeps its share of what these sources' shares add up to."""
    some = [x for x in sources if x[3] > 0 and x[1] > 0 and x[2] > 0]
    if not some:
        return {}
    total = min(blocks * repeats / share for _, share, repeats, blocks in some)
    return {name: min(blocks * repeats, max(1, round(total * share))) for name, share, repeats, blocks in some}


def _key(seed: int, source: int, turn: int) -> int:
    return seed * 1_000_003 + source * 1009 + turn


def _packer(block: int, width: int, drawn: dict[str, Callable[[int], bool]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Documents of a bucket in order, after a row that has its ``base`` (-1 in theirs) -> pieces of blocks: (source, block, at, pieces, raw),
    whole blocks but at the bucket's ends."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, at, number, start, pieces, raws = None, 0, -1, 0, [], []
        out: list[tuple] = []

        def close() -> None:
            if pieces:
                out.append((source, number, start, list(pieces), b"".join(raws)))
                pieces.clear()
                raws.clear()

        for pdf in batches:
            for s, base, i, raw in zip(pdf["source"], pdf["base"], pdf["id"], pdf["raw"]):
                if base >= 0:
                    close()
                    source, at = s, base
                    continue
                wanted, n, done = drawn.get(s), len(raw) // width, 0
                while done < n and wanted is not None:
                    b, inside = divmod(at + done, block)
                    take = min(n - done, block - inside)
                    if b != number or not pieces:
                        close()
                        number, start = b, inside
                    if wanted(b):
                        pieces.append((i, done, take))
                        raws.append(raw[done * width : (done + take) * width])
                    done += take
                at += n
                if len(out) >= 2000:
                    yield pd.DataFrame(out, columns=["source", "block", "at", "pieces", "raw"])
                    out.clear()
        close()
        yield pd.DataFrame(out, columns=["source", "block", "at", "pieces", "raw"])

    return run


def packed(encoded: DataFrame, documents: int, block: int, width: int, drawn: dict[str, Callable[[int], bool]]) -> DataFrame:
    """encoded(id, source, raw) -> (source, block, pieces array<struct<id, start, n>>, raw), blocks numbered from 0 in each source, only
    those ``drawn``.  A bucket of about BUCKET of the ``documents`` is packed in one go; only pieces at its ends meet others."""
    kind = encoded.schema["id"].dataType.simpleString()
    hashed = encoded.where(F.col("source").isin(list(drawn))).withColumn("h", F.xxhash64("id", F.lit(7)))
    rows = hashed.withColumn("bucket", F.pmod("h", F.lit(max(1, -(-documents // BUCKET)))))
    sums = rows.groupBy("source", "bucket").agg(F.sum(F.length("raw").cast("long")).alias("all_n"), F.min("id").alias("id"))
    base = ((F.sum("all_n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("all_n")) / width).cast("long")
    # A bucket's base comes as its first row.  A join would be shuffled by the same keys, so that the planner may leave out the shuffle below
    # and read the join's in parts: buckets were cut and their blocks met under one number.  The row's id is any (a null would turn ids to floats).
    heads = sums.select("source", "bucket", F.lit(None).cast("long").alias("h"), "id", F.lit(b"").alias("raw"), base.alias("base"))
    both = rows.select("source", "bucket", "h", "id", "raw", F.lit(-1).cast("long").alias("base")).unionByName(heads)
    ordered = both.repartition("source", "bucket").sortWithinPartitions("source", "bucket", F.asc_nulls_first("h"), "id", "raw").select("source", "base", "id", "raw")
    made = ordered.mapInPandas(_packer(block, width, drawn), f"source string, block long, at int, pieces array<struct<id:{kind},start:int,n:int>>, raw binary")
    grouped = made.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("at", "pieces", "raw"))).alias("ps"))
    raw = F.aggregate("ps", F.lit(b""), lambda a, p: F.concat(a, p["raw"]))
    return grouped.select("source", "block", F.flatten(F.transform("ps", lambda p: p["pieces"])).alias("pieces"), raw.alias("raw"))


def mixture(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", block: int = 512, slots: int = 256, seed: int = 42, vocabulary: str = VOCABULARY) -> DataFrame:
    """(shard, slot, source, block, copy, pieces, ids): the mixture's blocks.

    ``copy`` counts from 1.  A source's last block may be shorter.  Null and empty texts have no tokens and take no room; documents of a
    null source, or of one without a target, stay out; a target without documents gets nothing and the others share its part.
    """
    spark = docs.sparkSession
    goals = targets.where("source is not null").select(F.col("source"), "target_share", "max_repeats")
    encode, width = packed_ids(spark, vocabulary)
    own = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.col(text).alias("text")).join(F.broadcast(goals.select("source").distinct()), "source", "left_semi")
    encoded = cut(own.where(F.length("text") > 0).select("id", "source", encode("text").alias("raw")))  # encoded once, counted and packed
    sizes = encoded.groupBy("source").agg(F.ceil(F.sum(F.length("raw")) / (block * width)).alias("blocks"), F.count(F.lit(1)).alias("documents"))
    # One row for each target: the fixed list of sources, not the corpus.
    fixed = goals.join(sizes, "source", "left").orderBy("source").collect()
    told = [(r.source, r.target_share, r.max_repeats, r.blocks or 0) for r in fixed]
    wanted = plan(told)
    names = sorted(wanted)
    totals, have = [wanted[n] for n in names], {n: int(b) for n, _, _, b in told}
    shards = -(-sum(totals) // slots) if names else 0
    split = (totals, slots, shards, seed)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts_of = Split(*split)
        for pdf in batches:
            for shard in pdf["id"]:
                counts, offsets = counts_of(int(shard))
                which = np.repeat(np.arange(len(names)), counts)
                index = np.concatenate([np.arange(o, o + c) for o, c in zip(offsets, counts)]) if len(which) else np.zeros(0, np.int64)
                size = np.array([have[n] for n in names], np.int64)[which]
                copy, place = index // np.maximum(size, 1), index % np.maximum(size, 1)
                number = np.zeros(len(which), np.int64)
                for k in range(len(names)):
                    for c in np.unique(copy[which == k]):
                        at = (which == k) & (copy == c)
                        number[at] = permuted(place[at], have[names[k]], _key(seed, k, int(c)))
                order = np.random.default_rng([seed, 1, int(shard)]).permutation(len(which))
                yield pd.DataFrame({"shard": shard, "slot": np.arange(len(which), dtype=np.int32), "source": np.array(names, object)[which[order]], "block": number[order], "copy": copy[order] + 1})

    def is_drawn(k: int) -> Callable[[int], bool]:
        size, most, key = have[names[k]], totals[k], _key(seed, k, 0)
        known: dict[int, np.ndarray] = {}  # of the last blocks asked for

        def some(b: int) -> bool:
            page, at = divmod(b, 4096)
            if page not in known:
                known.clear()
                known[page] = permuted(np.arange(page * 4096, min(size, page * 4096 + 4096)), size, key, back=True) < most
            return bool(known[page][at])

        return (lambda b: True) if most >= size else some

    drawn = spark.range(shards).mapInPandas(draw, "shard long, slot int, source string, block long, copy long")
    blocks = packed(encoded, sum(r.documents or 0 for r in fixed), block, width, {n: is_drawn(k) for k, n in enumerate(names)})

    @F.arrow_udf("array<int>")
    def ids(raws: pa.Array) -> pa.Array:  # a batch's bytes at once, no object for each block
        raws = raws.cast(pa.binary())
        if not len(raws):
            return pa.array([], pa.list_(pa.int32()))
        ends = np.frombuffer(raws.buffers()[1], np.int32)[raws.offset : raws.offset + len(raws) + 1] // width
        values = np.frombuffer(raws.buffers()[2], f"<u{width}", ends[-1])[ends[0] :].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends - ends[0]), pa.array(values))

    # A shard's row is estimated as one slot, so without the hint the slots of some thousand shards are broadcast.
    joined = drawn.hint("merge").join(blocks, ["source", "block"])
    return joined.select("shard", "slot", "source", "block", "copy", "pieces", ids("raw").alias("ids"))


def report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, reached_share, tokens, most_copies, max_repeats) for every target."""
    per = mixed.groupBy("source").agg(F.sum(F.size("ids")).alias("tokens"), F.max("copy").alias("most_copies"))
    joined = targets.join(per, "source", "left").withColumn("all_tokens", F.sum("tokens").over(Window.partitionBy(F.lit(1))))  # the targets: few rows
    return joined.select("source", "target_share", F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)).alias("reached_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats")
