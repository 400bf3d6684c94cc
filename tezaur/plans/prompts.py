"""Prompt texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import task as task_of

# Sentences of the prompts.
OPERATOR_RULES = "Task target is operator.\nGenerate exactly one SQLite operator statement from DML/DDL families (INSERT, UPDATE, DELETE, CREATE, ALTER, DROP).\nDo not generate SELECT-only queries."
USER_RULES = "Task target is user.\nGenerate a read-only SQLite query (SELECT or WITH + SELECT).\nNo DDL/DML statements.\n"
AVOID = (
    "Duplicate-avoidance requirement:\nThe previous attempt was rejected as duplicate.\nGenerate a materially different candidate.\n"
    "Change at least two of the following dimensions:\n- join path or primary table set\n- filter column/value\n- aggregation/grouping strategy\n- ordering/limit strategy\n"
    "Do not reuse the same SQL skeleton with minor text changes."
)
GENERATE = "You are a precise NL-to-SQL data generator. Return only JSON without markdown."
REPAIR = "You repair NL-to-SQL examples. Return only JSON without markdown."
TRANSLATE = "Translate English user questions into natural Romanian. Return only the Romanian question text, no quotes."


def schema_text(tables: DataFrame, hints: DataFrame | None, domain: str, db_id: str, most: int = 10) -> DataFrame:
    """tables(name, columns array), hints(key, values array) -> one row ``text``: tables and hints by name, the first values of each."""
    line = F.concat(F.lit("- "), F.col("name"), F.lit("("), F.array_join("columns", ", "), F.lit(")"))
    a = tables.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", line.alias("line")))), lambda x: x["line"]), "\n").alias("a"))
    head = F.concat(F.lit(f"Domain: {domain}\nDB ID: {db_id}\nTables and columns:\n"), F.col("a"))
    if hints is None:
        return a.select(head.alias("text"))
    shown = F.concat(F.lit("- "), F.col("key"), F.lit(": "), F.array_join(F.slice("values", 1, most), ", "))
    b = hints.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", shown.alias("line")))), lambda x: x["line"]), "\n").alias("b"))
    one = F.lit(1).alias("one")  # both have one row
    return a.select("a", one).join(b.select("b", one), "one").select(F.when(F.col("b") == "", head).otherwise(F.concat(head, F.lit("\nValue hints:\n"), F.col("b"))).alias("text"))


def rules(task: Column, min_rows: Column, strict: Column) -> Column:
    need = F.when(strict, F.format_string("The SQL should return at least %d rows.", min_rows)).otherwise("Empty results are allowed.")
    return F.when(task == "operator", OPERATOR_RULES).otherwise(F.concat(F.lit(USER_RULES), need))


def type_hint(task: Column) -> Column:
    return F.when(task == "operator", '"query_type": ["UPDATE", "..."]').otherwise('"query_type": ["SELECT", "..."]')


def avoidance(feedback: Column) -> Column:
    return F.when(F.contains(F.lower(feedback), F.lit("duplicate")), AVOID).otherwise("")


def last_of(c: Column, n: int = 5) -> Column:
    return F.slice(c, F.greatest(F.size(c) - n + 1, F.lit(1)), F.lit(n))


def generation_prompt(domain: Column, task: Column, difficulty: Column, min_rows: Column, strict: Column, feedback: Column, schema: Column) -> Column:
    t, last = task_of(task), last_of(feedback)
    block = F.when(F.size(feedback) > 0, F.concat(F.lit("\nPrevious validation feedback:\n"), F.array_join(F.transform(last, lambda x: F.concat(F.lit("- "), x)), "\n"), F.lit("\n"))).otherwise("")
    # The texts of this prompt and of the next one.
    return F.concat(
        F.lit('Generate one training item for domain "'), domain, F.lit('".\nTask: '), t, F.lit("\nDifficulty target: "), difficulty.cast("string"), F.lit("\n"), rules(t, min_rows, strict),
        F.lit('\n\nUse SQLite SQL and only tables/columns from schema below.\nNo comments.\n\nOutput JSON format:\n{\n  "task": "'), t,
        F.lit('",\n  "question_en": "...",\n  "sql": "...",\n  "difficulty": '), difficulty.cast("string"), F.lit(",\n  "), type_hint(t),
        F.lit(',\n  "tables": ["table_name", "..."],\n  "notes": "short rationale"\n}\n'), block, F.lit("\n"), avoidance(F.array_join(last, "\n")), F.lit("\nSchema and hints:\n"), schema,
    )


def repair_prompt(domain: Column, task: Column, question: Column, sql: Column, difficulty: Column, error: Column, min_rows: Column, strict: Column, schema: Column) -> Column:
    t = task_of(task)
    return F.concat(
        F.lit("Repair the following candidate while keeping similar intent.\nDomain: "), domain, F.lit("\nTask: "), t, F.lit("\nUse only valid schema names from the snapshot.\nSQLite only.\n"), rules(t, min_rows, strict),
        F.lit("\n\nValidation error:\n"), error, F.lit("\n"), avoidance(error), F.lit("\n\nOriginal candidate:\ntask: "), task, F.lit("\nquestion_en: "), question, F.lit("\nsql: "), sql,
        F.lit('\n\nReturn JSON:\n{\n  "task": "'), t, F.lit('",\n  "question_en": "...",\n  "sql": "...",\n  "difficulty": '), difficulty.cast("string"), F.lit(",\n  "), type_hint(t),
        F.lit(',\n  "tables": ["table_name", "..."],\n  "notes": "what changed"\n}\n\nSchema and hints:\n'), schema,
    )


def translation_prompt(question: Column, domain: Column) -> Column:
    return F.concat(F.lit("Domain: "), domain, F.lit("\nEnglish question:\n"), question)


def messages(system: str, user: Column) -> Column:
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(turn("system", F.lit(system)), turn("user", user))
