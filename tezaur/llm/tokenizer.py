"""Ids of a public byte-level BPE vocabulary.

Method: a rank queue per pre-token.  Each merge rank has a bucket of linked-list positions; a hierarchical bitmap (words of 64 ranks,
two levels above) tells which buckets hold anything, find-first-set picks the next rank, and entries whose pair has changed since are
skipped.  Merging n bytes takes O(n) queue operations, so very long pre-tokens are no worse than short ones.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's published split pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Positions by rank; ``pop`` gives the lowest rank's leftmost position."""

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.words: dict[int, int] = {}
        self.middle: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, at: int) -> None:
        b = self.buckets.get(rank)
        if b is None:
            self.buckets[rank] = [at]
            w = rank >> 6
            self.words[w] = self.words.get(w, 0) | 1 << (rank & 63)
            self.middle[w >> 6] = self.middle.get(w >> 6, 0) | 1 << (w & 63)
            self.top |= 1 << (w >> 6)
        else:
            b.append(at)

    def pop_bucket(self) -> tuple[int, list[int]] | None:
        """Takes the whole bucket of the lowest rank; its positions in ascending order."""
        if not self.top:
            return None
        m = (self.top & -self.top).bit_length() - 1
        x = self.middle[m]
        w = m << 6 | ((x & -x).bit_length() - 1)
        y = self.words[w]
        rank = w << 6 | ((y & -y).bit_length() - 1)
        y &= y - 1
        self.words[w] = y
        if not y:
            x &= ~(1 << (w & 63))
            self.middle[m] = x
            if not x:
                self.top &= ~(1 << m)
        b = self.buckets.pop(rank)
        b.sort()
        return rank, b


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = RankQueue()
    for i in range(n - 1):
        r = ranks.get(piece[i : i + 2])
        if r is not None:
            queue.push(r, i)
    while (got := queue.pop_bucket()) is not None:
        rank, places = got
        for i in places:
            j = after[i]
            if parts[i] is None or j >= n:
                continue
            pair = parts[i] + parts[j]
            if ranks.get(pair) != rank:  # stale: the pair at i has changed
                continue
            parts[i], parts[j] = pair, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = ranks.get(pair + parts[k])
                if r is not None:
                    queue.push(r, i)
            h = before[i]
            if h >= 0:
                r = ranks.get(parts[h] + pair)
                if r is not None:
                    queue.push(r, h)
    return [ranks[p] for p in parts if p is not None]


# A blank and what follows it up to the next white space, or white space: the pattern never joins what two such chunks hold.
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+").findall
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space for ``re``, not for the pattern


class Encoder:
    """Encodes whole texts; dictionaries of chunks and pre-tokens met before are kept up to ``keep`` entries and then begun anew."""

    def __init__(self, ranks: dict[bytes, int], keep: int = 200_000) -> None:
        self.ranks, self.keep, self.known, self.merged = ranks, keep, {}, {}
        self.split = regex.compile(PATTERN).findall

    def _pieces(self, chunk: str) -> list[int]:
        ids: list[int] = []
        for p in self.split(chunk):
            x = self.merged.get(p)
            if x is None:
                x = merge(p.encode("utf-8", "replace"), self.ranks)
                if len(self.merged) >= self.keep:
                    self.merged.clear()
                if len(p) <= 64:
                    self.merged[p] = x
            ids += x
        return ids

    def __call__(self, text: str | None) -> list[int]:
        if not text:
            return []
        if _SEPARATORS.search(text):
            return self._pieces(text)
        known, ids = self.known, []
        for c in _CHUNK(text):
            x = known.get(c)
            if x is None:
                x = self._pieces(c)
                if len(known) >= self.keep:
                    known.clear()
                if len(c) <= 64:
                    known[c] = x
            ids += x
        return ids


def ids_udf(spark: SparkSession, vocabulary: str = VOCABULARY):
    """Column function: text -> list of ids.  The vocabulary (about 1 MB, fixed) is broadcast."""
    shared = spark.sparkContext.broadcast(read_ranks(vocabulary))

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for texts in batches:
            yield pd.Series([encoder(t) for t in texts], index=texts.index, dtype=object)

    return encode


def encode_corpus(df: DataFrame, text: str | Column = "text", out: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds the ids of each text: an empty list for null and for empty text, never null.  Strings that look like special tokens are ordinary text."""
    return df.withColumn(out, ids_udf(df.sparkSession, vocabulary)(F.col(text) if isinstance(text, str) else text))


def packed_ids(spark: SparkSession, vocabulary: str = VOCABULARY):
    """Column function: text -> its ids as bytes, and how many bytes each takes (two for a vocabulary of up to 65,536 ids, else four)."""
    ranks = read_ranks(vocabulary)
    shared, kind = spark.sparkContext.broadcast(ranks), "H" if max(ranks.values(), default=0) < 1 << 16 else "I"

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for texts in batches:
            yield pd.Series([array(kind, encoder(t)).tobytes() for t in texts], index=texts.index, dtype=object)

    return encode, array(kind).itemsize
