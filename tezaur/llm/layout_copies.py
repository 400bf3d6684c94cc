"""Records that repeat another one in a different layout.

Method: every record gets a canonical key.  Each partition sketches its keys for two Bloom filters, one of keys seen, one of keys seen
again; the filters are cut into segments of bounded size (a key's bits lie in one), and each segment merges the partitions' sketches (a
bit seen in two of them was seen again) and answers which of their keys may be repeats.  The answers, one bit a key, lie in the shared
folder, where each partition reads its own: nothing comes to the driver, nothing is broadcast, and no row is shuffled for it.  Keys
whose bits were not all seen again are certain to be single and leave without a shuffle; only the others are grouped, by the exact key.
A false positive of the filter costs a shuffled row and changes no result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..session import cut, shared_folder
from .gathering import bits_for

HASHES = 3

# Marks that carry no meaning in a sentence.
SENTENCE_MARKS = r"""[.,;:?!…'"“”„‟‘’‚‹›«»()\[\]{}*_`~¿¡]"""


def canonical_prose(text: Column) -> Column:
    """Lower case, one blank between words, no marks but those within numbers and times, comparison and minus signs."""
    t = F.regexp_replace(F.lower(text), r"(?U)^[\s\"'“„(\[*_`]*(?:[-*>•#–—]+\s+)+", "")
    t = F.regexp_replace(t, rf"(?<![0-9]){SENTENCE_MARKS}|{SENTENCE_MARKS}(?![0-9])", " ")
    t = F.regexp_replace(t, r"(?U)(?<=\s)[–—]+(?=\s)", " ")
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


_TOKEN = re.compile(
    r"""'(?:[^']|'')*'?|"((?:[^"]|"")*)"|`([^`]*)`|\[([^\]]*)\]|[0-9]+(?:[.,:][0-9]+)*|[^\W0-9]\w*|<>|<=|>=|!=|==|\|\||[^\s]""",
    re.DOTALL,
)


def _select_lists(tokens: list[str]) -> list[str]:
    """Sorts the fields between each SELECT and its FROM."""
    out: list[str] = []
    i, n = 0, len(tokens)
    while i < n:
        t = tokens[i]
        out.append(t)
        i += 1
        if t != "select":
            continue
        if i < n and tokens[i] in ("distinct", "all"):
            out.append(tokens[i])
            i += 1
        fields: list[list[str]] = [[]]
        depth = 0
        while i < n:
            t = tokens[i]
            if depth == 0 and (t in ("from", ")", "union", "intersect", "except", "where", "limit") or t == "order"):
                break
            depth += (t == "(") - (t == ")")
            if t == "," and depth == 0:
                fields.append([])
            else:
                fields[-1].append(t)
            i += 1
        for k, f in enumerate(sorted(_select_lists(f) for f in fields)):
            out += ([","] if k else []) + f
    return out


def canonical_sql(text: str | None) -> str | None:
    """Lower case, tokens apart by one blank, bare identifiers, no closing semicolons or wrapping marks, fields after SELECT in order."""
    if text is None:
        return None
    tokens = []
    for m in _TOKEN.finditer(text.lower()):
        bare = m[1] if m[1] is not None else m[2] if m[2] is not None else m[3]
        tokens.append(" ".join((bare if bare is not None else m[0]).split()))
    while tokens and tokens[-1] == ";":
        tokens.pop()
    while len(tokens) > 1 and tokens[0] == "(" and tokens[-1] == ")":
        depth, closes = 0, 0
        for k, t in enumerate(tokens):
            depth += (t == "(") - (t == ")")
            if depth == 0:
                closes = k
                break
        if closes != len(tokens) - 1:
            break
        tokens = tokens[1:-1]
    return " ".join(_select_lists(tokens))


def canonical_sql_column(sql: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(canonical_sql, na_action="ignore")

    return F.pandas_udf(run, "string")(sql)


def with_key(df: DataFrame, prose: str, sql: str, key: str = "key") -> DataFrame:
    """Adds the 128-bit canonical key.  A null field is a value of its own, equal to no text."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    return df.withColumn(key, F.unhex(F.md5(F.concat_ws("\x1f", part(canonical_prose(F.col(prose))), part(canonical_sql_column(F.col(sql)))))))


class _Sketch:
    """The distinct keys of some rows, by segment."""

    def __init__(self, keys: list[bytes], segments: int, bits: int) -> None:
        raw = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
        segment = ((raw[:, 1] >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)
        order = np.lexsort((raw[:, 0], raw[:, 1], segment))
        new = np.ones(len(raw), bool)
        new[1:] = (raw[order][1:] != raw[order][:-1]).any(axis=1)
        group = np.cumsum(new) - 1
        self.of_row = np.empty(len(raw), np.int64)
        self.of_row[order] = group
        first = order[new]
        self.segment, self.again = segment[first], np.bincount(group) > 1
        # Two numbers of 32 bits tell all places of a key in its segment.
        low = np.uint64(0xFFFFFFFF)
        self.codes = np.stack([raw[first, 0] & low, (raw[first, 1] & low) ^ (raw[first, 0] >> np.uint64(32))], axis=1).astype(np.uint32)
        self.starts = np.flatnonzero(np.concatenate([[True], self.segment[1:] != self.segment[:-1]])) if len(first) else np.zeros(0, np.int64)

    def parts(self) -> Iterator[tuple[int, slice]]:
        for a, b in zip(self.starts, [*self.starts[1:], len(self.segment)]):
            yield int(self.segment[a]), slice(int(a), int(b))


def _places(codes: np.ndarray, bits: int) -> np.ndarray:
    """Bit places (keys x HASHES) in a segment."""
    a, b = codes[:, 0].astype(np.uint64), codes[:, 1].astype(np.uint64) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(a + np.uint64(i) * b) & np.uint64(bits - 1) for i in range(HASHES)], axis=1).astype(np.int64)


def _chunks(batches: Iterator[pd.DataFrame], key: str, size: int) -> Iterator[pd.DataFrame]:
    """A partition's rows in chunks of at least ``size``, the same ones on each reading."""
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= size:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def split_by_bitmap(keyed: DataFrame, key: str = "key", bits_per_row: int = 16, most_bits: int = 1 << 23, chunk: int = 500_000) -> DataFrame:
    """keyed(..., key), written rows -> the same with ``__maybe``: whether the key may occur more than once (never false for a key that does).

    A segment has at most ``most_bits`` bits; where the rows need more, keys are dealt to more segments.
    """
    spark = keyed.sparkSession
    need = keyed.count() * bits_per_row
    bits = bits_for(need, 1, most_bits)
    segments = max(1, -(-need // bits))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for number, pdf in enumerate(_chunks(batches, key, chunk)):
            x = _Sketch(pdf[key].map(bytes).tolist(), segments, bits)
            rows = [(s, part, number, x.codes[at].tobytes(), np.packbits(x.again[at]).tobytes()) for s, at in x.parts()]
            yield pd.DataFrame(rows, columns=["segment", "part", "chunk", "codes", "again"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        once, again, places = np.zeros(bits, bool), np.zeros(bits, bool), []
        for codes, repeated in zip(pdf["codes"], pdf["again"]):
            at = _places(np.frombuffer(codes, np.uint32).reshape(-1, 2), bits)
            places.append(at)
            flat = np.unique(at)
            again[flat] |= once[flat]
            once[flat] = True
            again[at[np.unpackbits(np.frombuffer(repeated, np.uint8), count=len(at)).astype(bool)]] = True
        maybe = [np.packbits(again[at].all(axis=1)).tobytes() for at in places]
        return pd.DataFrame({"segment": pdf["segment"], "part": pdf["part"], "chunk": pdf["chunk"], "maybe": maybe})

    folder = f"{shared_folder(spark).rstrip('/')}/repeats-{uuid.uuid4().hex}"
    sketches = keyed.select(key).mapInPandas(build, "segment long, part int, chunk int, codes binary, again binary")
    answers = sketches.groupBy("segment").applyInPandas(answer, "segment long, part int, chunk int, maybe binary")
    answers.repartition("part").write.partitionBy("part").parquet(folder)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        told: dict[tuple[int, int], bytes] = {}
        for number, pdf in enumerate(_chunks(batches, key, chunk)):
            told = told or read_answers(folder, TaskContext.get().partitionId())
            x = _Sketch(pdf[key].map(bytes).tolist(), segments, bits)
            maybe = np.zeros(len(x.segment), bool)
            for s, at in x.parts():
                maybe[at] = np.unpackbits(np.frombuffer(told[number, s], np.uint8), count=at.stop - at.start)
            yield pdf.assign(__maybe=maybe[x.of_row])

    out = cut(keyed.mapInPandas(mark, StructType([*keyed.schema.fields, StructField("__maybe", BooleanType())])))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return out


def read_answers(folder: str, part: int) -> dict[tuple[int, int], bytes]:
    """(chunk, segment) -> bits, of one partition."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(f"{folder}/part={part}")
    t = ds.dataset(path, filesystem=system, format="parquet").to_table(columns=["chunk", "segment", "maybe"]).to_pydict()
    return {(c, s): m for c, s, m in zip(t["chunk"], t["segment"], t["maybe"])}


def _first_and_count(rows: DataFrame, key: str, id_col: str, heavy_at: int) -> DataFrame:
    """(key, id, first, copies) of rows in groups of two and more.

    Groups of more than ``heavy_at`` rows (at most rows / heavy_at of them) are joined by broadcast, so no task gets a hot group.
    """
    groups = cut(rows.groupBy(key).agg(F.min(id_col).alias("first"), F.count("*").alias("copies")).where("copies > 1"))
    heavy, light = groups.where(F.col("copies") > heavy_at), groups.where(F.col("copies") <= heavy_at)
    hot = F.broadcast(heavy.select(key, F.lit(True).alias("__hot")))
    marked = rows.join(hot, key, "left")
    return marked.where("__hot").join(F.broadcast(heavy), key).select(key, id_col, "first", "copies").unionByName(marked.where("__hot is null").join(light, key).select(key, id_col, "first", "copies"))


def layout_copies(df: DataFrame, id_col: str, prose: str, sql: str, heavy_at: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(pairs, records): pairs (id_a, id_b) with id_a the smallest id of the group, one row for every other id_b; records
    (id, copies), one for each group, singletons included.

    An empty table gives empty results; equal ids count once; null ids are left out of pairs and counted in records' copies.
    """
    keyed = cut(with_key(df.select(F.col(id_col).alias("id"), F.col(prose).alias("__p"), F.col(sql).alias("__s")), "__p", "__s").select("id", "key"))
    split = split_by_bitmap(keyed)
    rows = split.where("__maybe")
    heavy = heavy_at or max(10_000, split.count() // 1000)
    members = _first_and_count(rows, "key", "id", heavy)
    pairs = members.where("id <> first").select(F.col("first").alias("id_a"), F.col("id").alias("id_b")).distinct()
    singles = split.where("not __maybe").select("id", F.lit(1).cast("long").alias("copies"))
    grouped = rows.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies")).select("id", "copies")
    return pairs, singles.unionByName(grouped)
