"""Cleaning of an external corpus and validation of a generated one: one classification, one repair, one count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..operators.sandbox import executed, valid_in_context
from ..operators.waterfall import classified

# Statement families by track, and the tracks' tasks.
FAMILIES = {"operators": ["INSERT", "UPDATE", "DELETE", "CREATE", "ALTER", "DROP", "TRUNCATE"], "queries": ["SELECT", "WITH"]}
TRACK_TASK = {"operators": "operator", "queries": "user"}


def as_text(c: str) -> Column:
    """A value as the checks read it: null reads ``None``."""
    return F.coalesce(F.col(c), F.lit("None"))


def record_checks(track: str, strict_type: bool = False) -> list[tuple[str | Column, Column]]:
    """Checks of a record's columns after those of its JSON."""
    sql = T.strip(as_text("output"))
    word = T.first_keyword(sql)
    out: list[tuple[str | Column, Column]] = [("empty_output_sql", sql == "")]
    if strict_type:
        out.append((F.concat(F.lit("sql_keyword_not_allowed:"), word), ~word.isin(FAMILIES[track])))
    return [*out, ("input_parse_failed", T.input_parts(F.coalesce("input", F.lit(""))).isNull())]


def cleaned(df: DataFrame, track: str, strict_type: bool = False, run_sql: bool = False, before: list | None = None) -> DataFrame:
    """df(instruction, input, output, system, ...) -> the same with drop_reason, repaired texts, canonical label and task, and the names of
    changed fields.  An ``explanation`` column (metadata.sql_explanation_ro) is repaired as well, a ``metadata`` struct with a task gets
    the canonical one.  Cheap checks come first; statements run only for rows that passed them (``run_sql``).  Texts without anything to
    repair stay as they are, null ones too."""
    df = classified(df, [*(before or []), *record_checks(track, strict_type)])
    kept = F.col("drop_reason").isNull()
    repaired = {"instruction": "instruction", "system": "system", "explanation": "metadata.sql_explanation_ro"}
    repaired = {c: name for c, name in repaired.items() if c in df.columns}
    for c in repaired:
        df = df.withColumn(f"__{c}", F.when(kept, T.repaired(F.col(c))))
    df = df.withColumn("__parts", T.input_parts("input")).withColumn("__question", F.when(kept, T.repaired(F.col("__parts.question"))))
    changed = [F.when(F.col(f"__{c}.changed"), F.lit(name)) for c, name in repaired.items()]
    df = df.withColumn("changed_fields", F.array_compact(F.array(*changed, F.when(F.col("__question.changed"), F.lit("input.question_ro")))))
    if run_sql:
        passed = valid_in_context(df.where(kept).withColumn("__context", F.col("__parts.context")), "__context", "output", "__error").drop("__context")
        passed = passed.withColumn("drop_reason", F.when(F.col("__error").isNotNull(), F.concat(F.lit("sql_exec_failed:"), F.col("__error")))).drop("__error")
        df = passed.unionByName(df.where(~kept))
    kept = F.col("drop_reason").isNull()
    df = df.withColumn("changed_fields", F.when(kept, F.col("changed_fields")).otherwise(F.array().cast("array<string>")))
    for c in repaired:
        df = df.withColumn(c, F.when(kept & F.col(f"__{c}.changed"), F.col(f"__{c}.text")).otherwise(F.col(c)))
    df = df.withColumn("input", F.when(kept, T.rebuilt_input(F.col("__parts.context"), F.col("__question.text"))).otherwise(F.col("input")))
    task = F.lit(TRACK_TASK[track])
    if "metadata" in df.columns and isinstance(df.schema["metadata"].dataType, StructType) and "task" in df.schema["metadata"].dataType.names:
        df = df.withColumn("metadata", F.when(F.col("metadata").isNotNull(), F.col("metadata").withField("task", task)))
    return df.withColumn("task", task).drop(*[f"__{c}" for c in repaired], "__parts", "__question")


def changed_counts(df: DataFrame) -> DataFrame:
    return df.select(F.explode("changed_fields").alias("field")).groupBy("field").agg(F.count("*").alias("n"))


def validated(df: DataFrame, dumps: dict[str, str], min_rows: dict[str, int] | None = None, strict_non_empty: bool = True) -> DataFrame:
    """df(db_id, sql, task, ...) -> the same with result and status: valid, unknown_db, sql_failed or empty_result (user tasks with fewer
    rows than their domain asks for)."""
    df = executed(df, "db_id", "sql", dumps)
    least = F.lit(1)
    for name, n in (min_rows or {}).items():
        least = F.when(F.col("db_id") == name, n).otherwise(least)
    short = (T.task(F.col("task")) == "user") & F.lit(strict_non_empty) & (F.col("result.row_count") < least)
    checks = [("unknown_db", ~F.coalesce(F.col("db_id").isin(list(dumps)), F.lit(False))), ("sql_failed", ~F.col("result.success")), ("empty_result", short)]
    out = classified(df, checks, "status")
    return out.withColumn("status", F.coalesce("status", F.lit("valid")))


def status_counts(df: DataFrame) -> DataFrame:
    """One row: total and the count of each status."""
    return df.agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in ("valid", "unknown_db", "sql_failed", "empty_result")])
