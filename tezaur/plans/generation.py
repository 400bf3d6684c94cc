"""Model calls as iterator functions, and the loop that generates, runs, repairs, translates and deduplicates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normal, strip
from ..functions.text import task as task_of
from ..operators.keys import two_key_dedup
from ..session import cut
from .cleaning import validated

# A model: called once for each Python worker, gives a function from prompts to answers.
Model = Callable[[], Callable[[list[str]], list[str]]]


def answered(prompt: Column, model: Model) -> Column:
    """Answers of a model, loaded once for each task and called by batch; empty and null prompts give an empty answer without a call."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ask = model()
        for prompts in batches:
            there = [p for p in prompts if isinstance(p, str) and p.strip()]
            answers = iter(ask(there) if there else [])
            yield pd.Series([next(answers) if isinstance(p, str) and p.strip() else "" for p in prompts], dtype=object)

    return F.pandas_udf(run, "string")(prompt)


def mock(answers: dict[str, str], default: str = "SELECT 1") -> Model:
    """A model without a network: the answer of the first key that a prompt holds."""

    def load() -> Callable[[list[str]], list[str]]:
        return lambda prompts: [next((a for k, a in answers.items() if k in p), default) for p in prompts]

    return load


def identity() -> Callable[[list[str]], list[str]]:
    return lambda prompts: list(prompts)


def candidate(answer: Column) -> Column:
    """struct(task, question_en, sql, difficulty, query_type, tables, notes) of a model's answer: a JSON object in the text (an answer without
    one counts as the statement alone)."""
    text = F.coalesce(answer, F.lit(""))
    body = F.when(text.contains("{"), F.regexp_extract(text, r"(?s)(\{.*\})", 1))
    v = F.try_parse_json(body)
    get = lambda k, kind="string": F.try_variant_get(v, f"$.{k}", kind)
    words = lambda k: F.coalesce(get(k, "array<string>"), F.array().cast("array<string>"))
    said = lambda k: strip(F.coalesce(get(k), F.lit("")))
    return F.struct(
        task_of(get("task")).alias("task"), said("question_en").alias("question_en"), F.when(v.isNull(), strip(text)).otherwise(said("sql")).alias("sql"),
        F.coalesce(get("difficulty", "int"), F.lit(1)).alias("difficulty"), words("query_type").alias("query_type"), words("tables").alias("tables"), said("notes").alias("notes"),
    )


def examples(df: DataFrame, order: str) -> DataFrame:
    """Accepted records as generated examples (all columns of the master format)."""
    return df.select(
        F.col(order).alias("id"), "task", "domain", "db_id", "question_en", "question_ro", "sql", "difficulty", "query_type", "tables", "row_count", F.array(F.lit("sql_executed")).alias("validation_flags"),
        F.format_string("Rows: %d", "row_count").alias("expected_result_description_en"), "notes",
    )


def generated(requests: DataFrame, order: str, prompt: str, question: str | None, model: Model, repair: Callable[[Column, Column, Column], Column], dumps: dict[str, str], translator: Model = identity, repairs: int = 2, min_rows: dict[str, int] | None = None) -> DataFrame:
    """requests(order, db_id, task, prompt, question) -> accepted records with the candidate's columns, question_ro and row_count.

    ``question`` names the column of questions for answers that bring none.  Statements that fail are repaired at most ``repairs`` times, and so are those that repeat an accepted statement or question
    (``repair(prompt, sql, error)`` gives the prompt; the error of a repeat is ``duplicate``).  Accepted ones are translated.  Each round
    is written, so no answer is asked for twice.
    """

    def answers(df: DataFrame, ask: str) -> DataFrame:
        out = df.withColumn("__c", candidate(answered(F.col(ask), model)))
        asked = F.coalesce(F.nullif(F.col("__c.question_en"), F.lit("")), F.col(question)) if question else F.col("__c.question_en")
        names = ("difficulty", "query_type", "tables", "notes")
        return cut(out.withColumns({"sql": F.col("__c.sql"), "question_en": asked, **{n: F.col(f"__c.{n}") for n in names}}).drop("__c", "__again"))

    todo, kept = answers(requests, prompt), None
    for left in range(repairs, -1, -1):
        tried = cut(validated(todo, dumps, min_rows))
        good = tried.where("status = 'valid'").withColumn("__turn", F.lit(repairs - left))
        pool = good if kept is None else kept.unionByName(good)
        # An order that keeps what was accepted before what came later.
        ranked = cut(pool.withColumn("__o", F.concat(F.lpad(F.col("__turn").cast("string"), 4, "0"), F.lpad(F.col(order).cast("string"), 40, "0"))))
        kept = cut(two_key_dedup(ranked, "__o", normal(F.col("sql")), normal(F.col("question_en"))).drop("__o"))
        if not left:
            break
        repeats = good.join(kept.select(order), order, "left_anti").drop("__turn").withColumn("__error", F.lit("duplicate"))
        failed = tried.where("status <> 'valid'").withColumn("__error", F.coalesce("result.error", "status")).unionByName(repeats)
        if failed.isEmpty():
            break
        todo = answers(failed.withColumn("__again", repair(F.col(prompt), F.col("sql"), F.col("__error"))).drop("__error", "status", "result"), "__again")
    out = kept.withColumn("question_ro", answered(F.col("question_en"), translator)).withColumn("row_count", F.col("result.row_count"))
    return out.drop("result", "status", "__turn", prompt, *([question] if question else []))
