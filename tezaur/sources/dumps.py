"""SQL dumps: a data source that reads CREATE TABLE and multi-row INSERT statements, and the writer."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.keys import numbered

_CREATE = re.compile(r'CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?["`\[]?(\w+)["`\]]?\s*\(', re.IGNORECASE)
_INSERT = re.compile(r'INSERT\s+INTO\s+["`\[]?(\w+)["`\]]?\s*(?:\(([^)]*)\))?\s*VALUES', re.IGNORECASE)
_CONSTRAINTS = {"PRIMARY", "FOREIGN", "UNIQUE", "CHECK", "CONSTRAINT"}


_LEXEME = re.compile(r"""'(?:[^']|'')*'?|"(?:[^"]|"")*"?|`(?:[^`]|``)*`?|--[^\n]*|;""")


def statements(text: str) -> Iterator[str]:
    """Statements of a script; semicolons, quotes and comment marks inside literals do not count, comments become blanks."""
    parts, start = [], 0
    for m in _LEXEME.finditer(text):
        if m[0] == ";" or m[0].startswith("--"):
            parts.append(text[start : m.start()])
            start = m.end()
        if m[0] == ";":
            if whole := " ".join(parts).strip():
                yield whole
            parts = []
    if whole := " ".join([*parts, text[start:]]).strip():
        yield whole


def split_top(text: str) -> list[str]:
    """Pieces between commas outside literals and brackets."""
    out, depth, start, i = [], 0, 0, 0
    while i < len(text):
        c = text[i]
        if c == "'":
            i += 1
            while i < len(text) and not (text[i] == "'" and text[i + 1 : i + 2] != "'"):
                i += 2 if text[i] == "'" else 1
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif c == "," and depth == 0:
            out.append(text[start:i])
            start = i + 1
        i += 1
    return [x.strip() for x in [*out, text[start:]] if x.strip()]


def table_columns(script: str) -> dict[str, list[tuple[str, str]]]:
    """Table -> (column, declared type) in declared order."""
    out = {}
    for s in statements(script):
        m = _CREATE.match(s)
        if m:
            body = s[m.end() : s.rindex(")")]
            cells = [p.split(None, 2) for p in split_top(body)]
            out[m[1]] = [(c[0].strip('"`[]'), c[1].upper() if len(c) > 1 else "TEXT") for c in cells if c[0].upper().split("(")[0] not in _CONSTRAINTS]
    return out


def value(text: str) -> str | None:
    if text.upper() == "NULL":
        return None
    return text[1:-1].replace("''", "'") if text.startswith("'") else text


def _rows(statement: str, table: str, columns: list[str]) -> Iterator[tuple]:
    m = _INSERT.match(statement)
    if not m or m[1].lower() != table.lower():
        return
    given = [c.strip().strip('"`[]') for c in m[2].split(",")] if m[2] else columns
    for row in split_top(statement[m.end() :]):
        cells = dict(zip(given, (value(v) for v in split_top(row.strip()[1:-1]))))
        yield tuple(cells.get(c) for c in columns)


class _Part(InputPartition):
    def __init__(self, inserts: list[str]) -> None:
        self.inserts = inserts


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.options, self.schema = options, schema

    def partitions(self) -> list[InputPartition]:
        table = self.options["table"].lower()
        with open(self.options["path"], encoding="utf-8") as f:
            found = [s for s in statements(f.read()) if (m := _INSERT.match(s)) and m[1].lower() == table]
        return [_Part([s]) for s in found] or [_Part([])]

    def read(self, partition: _Part) -> Iterator[tuple]:
        kinds = [isinstance(f.dataType, LongType) for f in self.schema.fields]
        for s in partition.inserts:
            for row in _rows(s, self.options["table"], self.schema.fieldNames()):
                yield tuple(_number(v) if k else v for k, v in zip(kinds, row))


def _number(v: str | None) -> int | None:
    try:
        return int(v) if v is not None else None
    except ValueError:
        return None


class SqlDump(DataSource):
    """spark.read.format("sqldump").option("table", name).load(path): a table of a dump; INTEGER columns are long (null where the value
    is no number), all others string.  Each INSERT statement is a partition."""

    @classmethod
    def name(cls) -> str:
        return "sqldump"

    def schema(self) -> StructType:
        with open(self.options["path"], encoding="utf-8") as f:
            found = {k.lower(): v for k, v in table_columns(f.read()).items()}
        columns = found[self.options["table"].lower()]
        return StructType([StructField(c, LongType() if t.startswith("INT") else StringType()) for c, t in columns])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)


def read_dump(spark: SparkSession, path: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """The dump's tables, registered as temporary views."""
    spark.dataSource.register(SqlDump)
    with open(path, encoding="utf-8") as f:
        names = tables or list(table_columns(f.read()))
    out = {t: spark.read.format("sqldump").option("table", t).load(path) for t in names}
    for t, df in out.items():
        df.createOrReplaceTempView(t)
    return out


def insert_statements(df: DataFrame, table: str, order: list[str], values: list[tuple[str, Column]], size: int = 500) -> DataFrame:
    """(batch, statement): multi-row INSERTs of ``size`` rows in a total order.  ``values`` are (column, SQL text of its value)."""
    names = ", ".join(n for n, _ in values)
    row = F.concat(F.lit("("), F.concat_ws(", ", *[v for _, v in values]), F.lit(")"))
    rows = numbered(df.select(*order, row.alias("__row")), order, "__n").withColumn("batch", F.floor((F.col("__n") - 1) / size))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", "__row"))), lambda x: x["__row"]), ",\n")
    return rows.groupBy("batch").agg(F.concat(F.lit(f"INSERT INTO {table} ({names}) VALUES\n"), body, F.lit(";")).alias("statement"))


def dump_script(ddl: list[str], inserts: list[DataFrame]) -> DataFrame:
    """(part, value): a whole script in order: header, tables, batches in one transaction."""
    spark = inserts[0].sparkSession
    head = spark.createDataFrame([(0, -1, "PRAGMA foreign_keys = ON;\nBEGIN TRANSACTION;\n" + "\n".join(ddl))], "part int, batch long, value string")
    for i, df in enumerate(inserts, 1):
        head = head.unionByName(df.select(F.lit(i).alias("part"), "batch", F.col("statement").alias("value")))
    return head.unionByName(spark.createDataFrame([(len(inserts) + 1, 0, "COMMIT;")], "part int, batch long, value string"))
