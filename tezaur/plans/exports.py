"""Training formats, registries and manifests."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

MASTER = ["id", "task", "domain", "db_id", "question_en", "question_ro", "sql", "difficulty", "query_type", "tables", "row_count", "validation_flags", "expected_result_description_en", "notes"]


# Sentences of the formats, by task.
ASK_OPERATOR = ("Write one valid SQLite operator statement for database '", "' (INSERT/UPDATE/DELETE/CREATE/ALTER/DROP). Return SQL only.")
ASK_USER = ("Write a valid read-only SQLite SQL query for database '", "' (SELECT/WITH). Return SQL only.")
SYSTEM_OPERATOR = "You generate SQLite operator statements for Romanian NL-to-SQL tasks. Use DML/DDL only and return only SQL."
SYSTEM_USER = "You generate SQLite read-only queries for Romanian NL-to-SQL tasks. Use SELECT/WITH only and return only SQL."


def instruction() -> Column:
    asked = lambda parts: F.concat(F.lit(parts[0]), F.col("db_id"), F.lit(parts[1]))
    return F.when(F.col("task") == "operator", asked(ASK_OPERATOR)).otherwise(asked(ASK_USER))


def system_message() -> Column:
    return F.when(F.col("task") == "operator", SYSTEM_OPERATOR).otherwise(SYSTEM_USER)


def metadata() -> Column:
    return F.struct("task", "domain", "difficulty", "query_type", "tables").alias("metadata")


def master(df: DataFrame) -> DataFrame:
    return df.select(*MASTER)


def alpaca(df: DataFrame) -> DataFrame:
    asked = F.format_string("Task: %s\nRomanian question: %s\nEnglish question: %s", "task", "question_ro", "question_en")
    return df.select("id", "task", instruction().alias("instruction"), asked.alias("input"), F.col("sql").alias("output"), metadata())


def chat(df: DataFrame) -> DataFrame:
    asked = F.format_string("Task: %s\nDatabase: %s\nQuestion (RO): %s\nQuestion (EN): %s", "task", "db_id", "question_ro", "question_en")
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return df.select("id", "task", F.array(turn("system", system_message()), turn("user", asked), turn("assistant", F.col("sql"))).alias("messages"), metadata())


def sft(df: DataFrame, source: str | Column, default_system: str, system: str = "system") -> DataFrame:
    """Normalised training records (instruction, input, output, system, ...): stripped, the default system prompt where there is none,
    rows without instruction or output left out."""
    i, o, s = (strip(F.coalesce(c, F.lit(""))) for c in ("instruction", "output", system))
    src = F.lit(source) if isinstance(source, str) else source
    out = df.withColumn("instruction", i).withColumn("output", o).withColumn("input", F.coalesce("input", F.lit("")))
    out = out.withColumn("system", F.when(s == "", default_system).otherwise(s)).withColumn("source_dataset", src)
    return out.where((F.col("instruction") != "") & (F.col("output") != ""))


def metadata_json(metadata: str, id_col: str | None, task_col: str | None, source: str) -> Column:
    """Open metadata as JSON text: no object becomes {}, id and task are added where absent, the source is set; key order stays."""

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for metas, ids, tasks, sources in batches:
            out = []
            for m, i, t, s in zip(metas, ids, tasks, sources):
                try:
                    d = json.loads(m) if m else {}
                except ValueError:
                    d = {}
                d = d if isinstance(d, dict) else {}
                for k, v in (("id", i), ("task", t)):
                    if v is not None:
                        d.setdefault(k, v)
                d["source_dataset"] = s
                out.append(json.dumps(d, ensure_ascii=False))
            yield pd.Series(out)

    none = F.lit(None).cast("string")
    return F.pandas_udf(run, "string")(F.col(metadata), F.col(id_col) if id_col else none, F.col(task_col) if task_col else none, F.col(source))


def py_text(json_text: str) -> Column:
    """What Python's str() makes of a JSON value (given as JSON text): null becomes None, true True, 1.0 1.0; an absent value (SQL null) ''."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(["" if t is None else str(json.loads(t)) for t in texts])

    return F.pandas_udf(run, "string")(F.col(json_text))


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None, single: bool = False) -> None:
    """JSON lines, nulls kept, non-ASCII as it is.  ``single`` writes one ordered file (for small artifacts)."""
    rows = df.orderBy(*order) if order else df
    line = rows.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    (line.coalesce(1) if single else line).write.mode("overwrite").text(path)


def registry(files: dict[str, str]) -> dict:
    """Registry of training files: name -> file and column map."""
    columns = {"prompt": "instruction", "query": "input", "response": "output", "system": "system"}
    return {name: {"file_name": f, "columns": dict(columns)} for name, f in files.items()}


def write_json(path: str, data: dict) -> None:
    """Pretty-printed JSON of a small report."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(json.dumps(data, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")


def ratio_suffix(percent: float) -> str:
    """20.0 -> "20", 12.5 -> "12p5"."""
    return f"{percent:g}".replace(".", "p")
