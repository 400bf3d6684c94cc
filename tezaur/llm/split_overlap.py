"""Records of evaluation splits that occur, the same or nearly so, in the training split.

Two records are a pair where each of two fields differs in at most ``most`` words (a word one text has and the other lacks counts one,
with repeats; order, case, marks, accents and disguised characters do not count).

Method: each text becomes the sequence of its words, the rarest of the training texts first.  An evaluation record's sequence is cut
into ``most`` + 1 passages: its ``most`` rarest words, and the rest.  At most ``most`` words differ, each touching one passage, so a
partner's sequence holds at least one passage whole.  The passages, dealt to shards, become Aho-Corasick automata that scan the training
sequences.  A sequence goes only to shards where one of its own rarest words begins a passage (with j words of the record and q of the sequence
before the first common one the record has from 2 j - most to most - 2 q words more), found by bitmaps of bounded size whose errors
cost rows, not results.
Candidates are counted out exactly; the words that are matched are merged into the coverage of the evaluation record.

Exact copies (equal words in both fields) are scanned once.  Pairs of ids are made at the end from groups of ids of bounded size, so no
task gets a hot group of copies.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, shared_folder
from .gathering import bits_for, gathered, mark, marked
from .normal_form import LOOK_ALIKE, mapping

_WORD = re.compile(r"[^\W_]+")
_OTHER = re.compile("[Ͱ-ӿ]")
_LATIN = re.compile("[A-Za-z]")
COUNTERS = 1 << 18
FOUND = ["train_key", "eval_key", "difference_a", "difference_b", "cover"]
_G, _H = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(1)
def _folding() -> dict[int, str]:
    table = {ord(c): "".join(x for x in d if not unicodedata.combining(x)) for c, d in mapping().items()}
    table |= {n: "" for n in range(0x300, 0x370)}
    return table


@lru_cache(1)
def _looks() -> dict[int, str]:
    return {ord(a): b for a, b in LOOK_ALIKE.items()}


class _Folded(dict):
    """Character -> what stands for it: without accents, '' for combining and invisible ones."""

    def __missing__(self, c: str) -> str:
        x = _folding().get(ord(c))
        self[c] = x = ("" if unicodedata.combining(c) else c) if x is None else x
        return x


class _Hashes(dict):
    """Word -> 31-bit hash; begun anew when full."""

    def __missing__(self, w: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[w] = x = xxhash.xxh32_intdigest(w) >> 1
        return x


_FOLDED, _HASHES = _Folded(), _Hashes()


def words(text: str | None) -> list[str]:
    """Words of a text in lower case, without accents and disguises."""
    if not text:
        return []
    if text.isascii():
        return _WORD.findall(text.lower())
    for c in set(text):
        if c > "\x7f" and (x := _FOLDED[c]) != c:
            text = text.replace(c, x)
    if not text.isascii() and _OTHER.search(text):  # before the case goes: some look-alikes are capitals only
        text = re.sub(r"[^\W\d_]+", lambda m: m[0].translate(_looks()) if _LATIN.search(m[0]) else m[0], text)
    return _WORD.findall(text.lower())


def sequence(text: str | None) -> np.ndarray:
    """31-bit hashes of a text's words, in order of the hashes."""
    return np.array(sorted([_HASHES[w] for w in words(text)]), dtype=np.int32)


def difference(a: list[int], b: list[int], most: int) -> int:
    """Words that one of two ascending lists has and the other lacks, with repeats; more than ``most`` counts as ``most`` + 1."""
    i = j = d = 0
    n, m = len(a), len(b)
    while i < n and j < m:
        x, y = a[i], b[j]
        if x == y:
            i += 1
            j += 1
        else:
            d += 1
            if d > most:
                return d
            if x < y:
                i += 1
            else:
                j += 1
    return min(most + 1, d + n - i + m - j)


def matched(a: list[int], b: list[int]) -> list[int]:
    """The places of ``a`` that ``b`` holds as well, as bits of 63-bit numbers (both lists ascending)."""
    out = [0] * -(-len(a) // 63)
    j = 0
    for i, x in enumerate(a):
        while j < len(b) and b[j] < x:
            j += 1
        if j < len(b) and b[j] == x:
            out[i // 63] |= 1 << i % 63
            j += 1
    return out


def rare_first(flat: np.ndarray, sizes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """(texts x k) the first k words of each text in order of (count, hash), -1 where a text has fewer.  ``flat`` holds the texts'
    words one after the other.  Counts from 2^19 - 1 on are taken as equal, so that text, count and hash fit one number to sort."""
    out = np.full((len(sizes), k), -1, np.int64)
    ends = np.cumsum(sizes)
    for at in range(0, len(sizes), 1 << 14):
        n = sizes[at : at + (1 << 14)]
        part = flat[ends[at] - sizes[at] : ends[at + len(n) - 1]]
        row = np.repeat(np.arange(len(n), dtype=np.uint64), n)
        told = np.minimum(counts[part & (COUNTERS - 1)], (1 << 19) - 1).astype(np.uint64)
        order = np.sort((row << np.uint64(50)) | (told << np.uint64(31)) | part.astype(np.uint64))
        place = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
        some = place < k
        out[at + row[some].astype(np.int64), place[some]] = (order[some] & np.uint64((1 << 31) - 1)).astype(np.int64)
    return out


def anchors(word: np.ndarray, field: int, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit anchors: a word at a place of an evaluation record with so many words."""
    with np.errstate(over="ignore"):
        x = ((word.astype(np.uint64) << np.uint64(1)) | np.uint64(field)) * np.uint64(64) + place.astype(np.uint64)
        x = (x * _H) ^ (size.astype(np.uint64) + np.uint64(1)) * _G
        x = (x ^ (x >> np.uint64(29))) * _H
        return x ^ (x >> np.uint64(32))


SHORT = np.uint64(0x5ED1)  # the anchor of records of at most ``most`` words in both fields


def _flat(raws: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(raws), np.int32), np.array([len(x) >> 2 for x in raws], np.int64)


class Layout:
    """Where the anchors of records lie, in the order of the counted words."""

    def __init__(self, counts: np.ndarray, most: int) -> None:
        self.counts, self.most = counts, most

    def _rare(self, pdf: pd.DataFrame) -> tuple[list[np.ndarray], list[np.ndarray]]:
        got = [_flat(pdf[c]) for c in "ab"]
        return [rare_first(flat, sizes, self.counts[f], self.most + 1) for f, (flat, sizes) in enumerate(got)], [s for _, s in got]

    def of_training(self, pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) of training texts: a word with q words before it may be the record's word with j before it where the record has
        from 2 j - ``most`` to ``most`` - 2 q words more."""
        rare, sizes = self._rare(pdf)
        most = self.most
        ways = np.array([(q, j, more) for q in range(most + 1) for j in range(most + 1 - q) for more in range(2 * j - most, most - 2 * q + 1)], np.int64)
        rows, out = [], []
        for f in (0, 1):
            word, size = rare[f][:, ways[:, 0]], sizes[f][:, None] + ways[:, 2]
            ok = (word >= 0) & (size > 0)
            rows.append(np.nonzero(ok)[0])
            out.append(anchors(word[ok], f, np.broadcast_to(ways[:, 1], ok.shape)[ok], size[ok]))
        short = np.nonzero((sizes[0] <= most) & (sizes[1] <= most))[0]
        return np.concatenate([*rows, short]), np.concatenate([*out, np.full(len(short), SHORT)])

    def of_evaluation(self, pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
        """(row, anchor, field, place, word) of evaluation records: of the field whose first words promise fewer matches (more than ``most``
        words at least); of both fields, and the anchor of the short ones, where neither has so many."""
        rare, sizes = self._rare(pdf)
        cost = np.stack([np.where(r[:, :3] >= 0, self.counts[f][r[:, :3] & (COUNTERS - 1)], 0).sum(axis=1) for f, r in enumerate(rare)])
        fits = [s > self.most for s in sizes]
        first = fits[0] & (~fits[1] | (cost[0] <= cost[1]))
        neither = ~fits[0] & ~fits[1]
        parts = []
        for f, mine in ((0, first | neither), (1, fits[1] & ~first | neither)):
            row, place = np.nonzero((rare[f] >= 0) & mine[:, None])
            parts.append((row, anchors(rare[f][row, place], f, place, sizes[f][row]), np.full(len(row), f), place, rare[f][row, place]))
        short = np.nonzero(neither)[0]
        parts.append((short, np.full(len(short), SHORT), np.full(len(short), -1), np.zeros(len(short), np.int64), np.zeros(len(short), np.int64)))
        return tuple(np.concatenate(x) for x in zip(*parts))


class Automaton:
    """Passages of evaluation records in one field, each word one character (of 20 bits: an equal one is a candidate, no more)."""

    def __init__(self, most: int) -> None:
        import ahocorasick

        self.most, self.trie, self.lists = most, ahocorasick.Automaton(), {}

    @staticmethod
    def text(words_: list[int]) -> str:
        return "".join([chr(0x10000 + (w & 0xFFFFF)) for w in words_])

    def add(self, passage: list[int], place: int, size: int, other: int, record: int) -> None:
        self.lists.setdefault(self.text(passage), {}).setdefault(place, []).append((size, other, record))

    def close(self) -> None:
        for p, places in self.lists.items():
            self.trie.add_word(p, (len(p), [(j, sorted(r)) for j, r in places.items()]))
        if self.lists:
            self.trie.make_automaton()

    def scan(self, words_: list[int], size: int, other: int) -> set[int]:
        """Records with a passage in the sequence that may be the first common one: with j words of the record and q of the sequence
        before it the record has at least 2 j - ``most`` and at most ``most`` - 2 q words more.  ``size`` and ``other``: words of this
        field and of the other one."""
        out, most = set(), self.most
        if self.lists and words_:
            for last, (n, places) in self.trie.iter(self.text(words_)):
                q = last + 1 - n
                for j, records in places:
                    if j + q <= most:
                        upto = size + most - 2 * q
                        for k in range(bisect_left(records, (size + 2 * j - most,)), len(records)):
                            x = records[k]
                            if x[0] > upto:
                                break
                            if -most <= x[1] - other <= most:
                                out.add(x[2])
        return out


def _contents(df: DataFrame, id_col: str, fields: tuple[str, str], extra: list[str]) -> DataFrame:
    """(id, key, a, b, ...): word sequences of both fields as bytes; the key is equal for copies."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for x, y in batches:
            a, b = [sequence(t).tobytes() for t in x], [sequence(t).tobytes() for t in y]
            key = [xxhash.xxh3_128_digest(len(p).to_bytes(4, "little") + p + q) for p, q in zip(a, b)]
            yield pd.DataFrame({"key": key, "a": a, "b": b})

    told = F.pandas_udf(run, "key binary, a binary, b binary")(F.col(fields[0]), F.col(fields[1]))
    return df.select(F.col(id_col).alias("id"), *extra, told.alias("w")).select("id", *extra, "w.*")


def key_pairs(rows: DataFrame, most: int, shard: int, most_bits: int, spread: int) -> DataFrame:
    """rows(key, a, b, __train) -> (train_key, eval_key, difference_a, difference_b, cover) of all pairs of distinct texts."""
    spark = rows.sparkSession
    texts = cut(rows.groupBy("key").agg(F.first("a").alias("a"), F.first("b").alias("b"), F.max("__train").alias("in_train"), F.max(~F.col("__train")).alias("in_eval")))
    training, evaluation = texts.where("in_train").select("key", "a", "b"), texts.where("in_eval").select("key", "a", "b")

    def count(own: np.ndarray, pdf: pd.DataFrame) -> None:
        for f, c in enumerate("ab"):
            own[f * COUNTERS : (f + 1) * COUNTERS] += np.bincount(_flat(pdf[c])[0] & (COUNTERS - 1), minlength=COUNTERS)

    counted = gathered(training.select("a", "b"), 2 * COUNTERS, "int64", count, np.add).reshape(2, COUNTERS)
    layout = spark.sparkContext.broadcast(Layout(counted, most))
    evals = evaluation.count()
    shards = max(1, -(-evals // shard))
    bits = bits_for(evals, 64 * (most + 1), most_bits)

    # What the other side asks for: bitmaps of at most ``most_bits`` bits each, the second one of what is asked for in the first.
    told = gathered(evaluation.select("a", "b"), bits // 8, "uint8", lambda own, pdf: mark(own, layout.value.of_evaluation(pdf)[1]), np.bitwise_or)
    of_evaluation = spark.sparkContext.broadcast(told)

    def fill(own: np.ndarray, pdf: pd.DataFrame) -> None:
        x = layout.value.of_training(pdf)[1]
        mark(own, x[marked(of_evaluation.value, x)])

    of_training = spark.sparkContext.broadcast(gathered(training.select("a", "b"), bits // 8, "uint8", fill, np.bitwise_or))

    def shard_of(x: np.ndarray) -> np.ndarray:
        return ((x >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            row, x, field, place, word = layout.value.of_evaluation(pdf)
            ok = marked(of_training.value, x)
            out = pdf.iloc[row[ok]].reset_index(drop=True)
            yield out.assign(shard=shard_of(x[ok]).astype(np.int32), field=field[ok].astype(np.int32), place=place[ok].astype(np.int32), word=word[ok].astype(np.int32))

    def route(slim: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if not len(pdf):
                    continue
                row, x = layout.value.of_training(pdf)
                ok = marked(of_evaluation.value, x)
                both = np.unique(row[ok] * shards + shard_of(x[ok]))
                if slim:
                    at, n = np.unique(both % shards, return_counts=True)
                    yield pd.DataFrame({"shard": at.astype(np.int32), "n": n})
                else:
                    yield pdf.iloc[both // shards].reset_index(drop=True).assign(shard=(both % shards).astype(np.int32))

        return run

    # Each shard is one folder of bounded size; the training sequences routed to it are split where they are many.
    folder = f"{shared_folder(spark).rstrip('/')}/passages-{uuid.uuid4().hex}"
    laid = evaluation.mapInPandas(lay, "key binary, a binary, b binary, shard int, field int, place int, word int")
    laid.repartition(min(shards, 2000), "shard").write.partitionBy("shard").parquet(folder)
    per_shard = training.mapInPandas(route(True), "shard int, n long").groupBy("shard").agg(F.sum("n").alias("n"))
    splits = per_shard.withColumn("splits", F.ceil(F.col("n") / spread).cast("int"))
    parts = max(splits.agg(F.sum("splits")).first()[0] or 1, 1)
    routed = training.mapInPandas(route(False), "key binary, a binary, b binary, shard int").join(F.broadcast(splits.select("shard", "splits")), "shard")
    routed = routed.withColumn("part", F.pmod(F.xxhash64("key"), F.col("splits"))).repartition(min(parts, 20_000), "shard", "part").sortWithinPartitions("shard")
    found = cut(routed.select("shard", "key", "a", "b").mapInPandas(_scanner(folder, counted_by=layout, most=most), "train_key binary, eval_key binary, difference_a int, difference_b int, cover array<long>"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return found


def _scanner(folder: str, counted_by, most: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Scans training sequences, sorted by shard, with the automata of one shard at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, shard = None, None
        for pdf in batches:
            out = []
            if len(pdf):
                rare = [rare_first(*_flat(pdf[c]), counted_by.value.counts[f], most + 1).tolist() for f, c in enumerate("ab")]
                for i, (s, key, a, b) in enumerate(zip(pdf["shard"], pdf["key"], pdf["a"], pdf["b"])):
                    if s != at:
                        at, shard = s, _Shard(f"{folder}/shard={s}", most)
                    out += shard.partners(key, (a, b), [[w for w in r[i] if w >= 0] for r in rare])
            yield pd.DataFrame(out, columns=FOUND)

    return run


class _Shard:
    """Records of one shard with the automata of their passages."""

    def __init__(self, folder: str, most: int) -> None:
        import pyarrow.dataset as ds
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        there = system.get_file_info(path).type == fs.FileType.Directory
        t = ds.dataset(path, filesystem=system, format="parquet").to_table(columns=["key", "a", "b", "field", "place", "word"]).to_pydict() if there else {"key": []}
        number: dict[bytes, int] = {}
        self.most, self.keys, self.sides, self.short = most, [], [], []
        self.automata = [Automaton(most), Automaton(most)]
        for i, key in enumerate(t["key"]):
            if key not in number:
                number[key] = len(self.keys)
                self.keys.append(key)
                self.sides.append((t["a"][i], t["b"][i]))
            record, field = number[key], t["field"][i]
            if field < 0:
                self.short.append(record)
            else:
                # The first words are passages of one word; what is left of the sequence is the last one, known by its first word.
                self.automata[field].add([t["word"][i]], t["place"][i], len(self.sides[record][field]) >> 2, len(self.sides[record][1 - field]) >> 2, record)
        for x in self.automata:
            x.close()
        self.lists: dict[int, tuple[list[int], list[int]]] = {}

    def partners(self, key: bytes, raws: tuple[bytes, bytes], rare: list[list[int]]) -> list[tuple]:
        m, most = (len(raws[0]) >> 2, len(raws[1]) >> 2), self.most
        some = self.automata[0].scan(rare[0], m[0], m[1]) | self.automata[1].scan(rare[1], m[1], m[0])
        if self.short and max(m) <= most:
            some.update(i for i in self.short if all(len(x) // 4 + n <= most for x, n in zip(self.sides[i], m)))
        if not some:
            return []
        mine, out = [np.frombuffer(x, np.int32).tolist() for x in raws], []
        for i in some:
            if i not in self.lists:
                self.lists[i] = tuple(np.frombuffer(x, np.int32).tolist() for x in self.sides[i])
            d = [difference(mine[f], self.lists[i][f], most) for f in (0, 1)]
            if max(d) <= most:
                out.append((key, self.keys[i], d[0], d[1], matched(self.lists[i][0], mine[0]) + matched(self.lists[i][1], mine[1])))
        return out


def _rows(df: DataFrame, id_col: str, fields: tuple[str, str], split: str, train: str, carry: tuple[str, ...]) -> DataFrame:
    base = df.where(F.col(split).isNotNull() & F.col(id_col).isNotNull()).withColumn("__train", F.col(split) == train)
    return cut(_contents(base, id_col, fields, ["__train", *carry]))


def _groups(rows: DataFrame, size: int) -> DataFrame:
    """(key, ids): the ids of each key in groups of about ``size``."""
    many = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > size).select("key", F.ceil(F.col("n") / size).alias("k"))
    # At most rows / size keys have more than one group.
    salted = rows.join(F.broadcast(many), "key", "left") if many.count() * size <= 100_000_000 else rows.join(many, "key", "left")
    return salted.groupBy("key", F.pmod(F.xxhash64("id"), F.coalesce("k", F.lit(1))).alias("salt")).agg(F.collect_set("id").alias("ids")).select("key", "ids")


def overlaps(df: DataFrame, id_col: str, fields: tuple[str, str], split: str, train: str = "train", most: int = 5, shard: int = 20_000, most_bits: int = 1 << 28, spread: int = 20_000, group: int = 500) -> DataFrame:
    """(train_id, eval_id, difference_a, difference_b) of all pairs across the splits.

    Rows without split or without id take no part.  Null and empty fields count as texts of no words.  Of repeated rows with one id and
    equal texts one counts; an empty table, or one without either side, gives no rows.
    """
    rows = _rows(df, id_col, fields, split, train, ())
    pairs = key_pairs(rows, most, shard, most_bits, spread)
    left, right = (_groups(rows.where(F.col("__train") == t).select("key", "id"), group) for t in (True, False))
    joined = pairs.drop("cover").join(left.select(F.col("key").alias("train_key"), F.col("ids").alias("t")), "train_key")
    joined = joined.join(right.select(F.col("key").alias("eval_key"), F.col("ids").alias("e")), "eval_key")
    spread_out = joined.select("t", F.explode("e").alias("eval_id"), "difference_a", "difference_b")
    return spread_out.select(F.explode("t").alias("train_id"), "eval_id", "difference_a", "difference_b")


def pairs_found(df: DataFrame, id_col: str = "id", fields: tuple[str, str] = ("question_ro", "sql"), split: str = "split") -> DataFrame:
    """(id_a, id_b): the ids of each pair, the smaller first."""
    p = overlaps(df, id_col, fields, split)
    return p.select(F.least("train_id", "eval_id").alias("id_a"), F.greatest("train_id", "eval_id").alias("id_b")).distinct()


def counts_found(df: DataFrame, id_col: str = "id", fields: tuple[str, str] = ("question_ro", "sql"), split: str = "split", source: str = "source", train: str = "train", most: int = 5) -> DataFrame:
    """(split, source, pairs, records, coverage): pairs, evaluation records with a partner, and the share of these records' words that
    their partners' texts hold together.  Pairs are counted from the numbers of copies, not listed."""
    rows = _rows(df, id_col, fields, split, train, (split, source))
    pairs = key_pairs(rows, most, 20_000, 1 << 28, 20_000)
    copies = rows.where("__train").groupBy("key").agg(F.countDistinct("id").alias("n"))
    per = pairs.join(copies.withColumnRenamed("key", "train_key"), "train_key").groupBy("eval_key").agg(F.sum("n").alias("pairs"))
    bits = pairs.select("eval_key", F.posexplode("cover")).groupBy("eval_key", "pos").agg(F.bit_or("col").alias("x"))
    covered = bits.groupBy("eval_key").agg(F.sum(F.bit_count("x")).alias("covered"))
    own = rows.where("not __train").groupBy("key", split, source).agg(F.countDistinct("id").alias("ids"), F.first((F.length("a") + F.length("b")) / 4).alias("words"))
    told = own.withColumnRenamed("key", "eval_key").join(per, "eval_key").join(covered, "eval_key", "left")
    share = F.sum(F.col("ids") * F.coalesce("covered", F.lit(0))) / F.greatest(F.sum(F.col("ids") * F.col("words")), F.lit(1))
    return told.groupBy(split, source).agg(F.sum(F.col("ids") * F.col("pairs")).alias("pairs"), F.sum("ids").alias("records"), F.round(share, 6).alias("coverage"))
