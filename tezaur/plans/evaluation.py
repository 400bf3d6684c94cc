"""Evaluation by execution, and the comparison of two runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..operators.keys import numbered
from ..operators.sandbox import executed

# Databases of the domains.
DOMAIN_DB = {"education": "edu_reteaua_scolara", "trains": "rail_mers_tren"}


def case_rows(lines: DataFrame) -> DataFrame:
    """Lines of JSON(line_no, value) -> the columns that cases() reads; those a line lacks are null, ``prompted`` tells whether it has an
    instruction or an input at all."""
    get = lambda path: F.try_variant_get("json", path, "string")
    rows = lines.withColumn("json", F.try_parse_json("value")).where("json is not null").withColumn("keys", F.json_object_keys("value"))
    names = ["id", "db_id", "domain", "system", "instruction", "input", "question_ro", "question_en", "sql", "output"]
    meta = F.struct(*[get(f"$.metadata.{k}").alias(k) for k in ("id", "db_id", "domain")]).alias("metadata")
    return rows.select("line_no", *[get(f"$.{k}").alias(k) for k in names], meta, (F.array_contains("keys", "instruction") | F.array_contains("keys", "input")).alias("prompted"))


def cases(df: DataFrame, order: str, default_system: str, most: int | None = None, romanian: bool = True) -> DataFrame:
    """Evaluation cases of master or alpaca rows (columns that lack are given as null): rows without gold statement, database or prompt are
    skipped; ``most`` keeps the first valid ones in order.  What a row lacks of id, db_id and domain its metadata gives; question rows
    take the default system prompt.  ``prompted`` tells the kinds apart where rows of both are mixed."""
    fields = df.schema["metadata"].dataType.names if "metadata" in df.columns and isinstance(df.schema["metadata"].dataType, StructType) else []
    text = lambda c: T.strip(F.coalesce(c.cast("string"), F.lit("")))
    have = lambda c: text(F.col(c)) if c in df.columns else F.lit("")
    meta = lambda c: text(F.col(f"metadata.{c}")) if c in fields else F.lit("")
    either = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])
    by_domain = F.create_map(*[F.lit(x) for kv in DOMAIN_DB.items() for x in kv])
    both = F.when((have("instruction") != "") & (have("input") != ""), F.concat(have("instruction"), F.lit("\n\n"), have("input")))
    asked = [have("question_ro"), have("question_en")] if romanian else [have("question_en"), have("question_ro")]
    prompted = F.col("prompted") if "prompted" in df.columns else F.lit("instruction" in df.columns or "input" in df.columns)
    out = df.select(
        either(have("id"), meta("id"), F.concat(F.lit("line_"), F.col(order).cast("string"))).alias("case_id"),
        F.coalesce(either(have("db_id"), meta("db_id")), F.try_element_at(by_domain, F.lower(either(have("domain"), meta("domain"))))).alias("db_id"),
        F.when(prompted, either(have("system"))).alias("system_prompt"),
        F.when(prompted, F.coalesce(both, either(have("instruction"), have("input")))).otherwise(either(*asked)).alias("user_prompt"),
        either(have("sql"), have("output")).alias("gold_sql"),
        F.col(order).alias("source_line"),
    ).where("gold_sql is not null and db_id is not null and user_prompt is not null")
    out = out.withColumn("system_prompt", F.coalesce("system_prompt", F.lit(default_system)))
    return out.orderBy("source_line").limit(most) if most else out


def last_gold(gold: DataFrame, case_id: str = "case_id", order: str = "source_line") -> DataFrame:
    """One gold row for each case id: the last one's."""
    cols = [c for c in gold.columns if c != case_id]
    return gold.groupBy(case_id).agg(F.max_by(F.struct(*cols), order).alias("x")).select(case_id, "x.*")


def chosen_attempt(attempts: Column) -> Column:
    """The first attempt that starts as SQL, else the last one."""
    good = F.filter(attempts, T.starts_as_sql)
    return F.coalesce(F.get(good, F.lit(0)), F.try_element_at(attempts, F.lit(-1)))


def judged(predictions: DataFrame, gold: DataFrame, dumps: dict[str, str]) -> DataFrame:
    """predictions(variant, case_id, pred_sql, optionally error of the model) against gold(case_id, db_id, gold_sql, source_line): outcome of each
    prediction.  Gold runs once.  A prediction that does not start as SQL is not run and never exact."""
    g = executed(last_gold(gold), "db_id", "gold_sql", dumps, "gold", as_signature=True)
    p = executed(predictions.join(g.select("case_id", "db_id", "gold_sql", "source_line", "gold"), "case_id"), "db_id", "pred_sql", dumps, "pred", as_signature=True)
    same = (F.col("pred.kind") == F.col("gold.kind")) & (F.col("pred.columns") == F.col("gold.columns")) & (F.col("pred.rows") == F.col("gold.rows")) & (F.col("pred.n") == F.col("gold.n"))
    failed = F.col("error").isNotNull() if "error" in predictions.columns else F.lit(False)
    outcome = (
        F.when(F.col("gold.error").isNotNull(), "gold_failed").when(failed, "no_answer").when(~T.starts_as_sql(F.col("pred_sql")), "bad_prefix")
        .when(F.col("pred.error").isNotNull(), "failed").when(F.coalesce(same, F.lit(False)), "match").otherwise("mismatch")
    )
    exact = T.normal_statement(F.col("pred_sql")) == T.normal_statement(F.col("gold_sql"))
    out = p.withColumn("outcome", outcome)
    ran = F.col("outcome").isin("failed", "match", "mismatch")
    return out.select("variant", "case_id", "db_id", "source_line", "gold_sql", "pred_sql", "outcome", (ran & exact).alias("exact"))


def metrics(df: DataFrame) -> DataFrame:
    """df(variant, outcome, exact) -> (variant, total, gold_failures, generation_errors, generated, prefix_failures, executed, exact_matches,
    exec_matches, rates): rates over max(1, total - gold failures).  Only predictions that start as SQL can match."""
    is_ = lambda *names: F.count_if(F.col("outcome").isin(*names))
    base = df.groupBy("variant").agg(
        F.count("*").alias("total"), is_("gold_failed").alias("gold_failures"), is_("no_answer").alias("generation_errors"), is_("bad_prefix", "failed", "match", "mismatch").alias("generated"),
        is_("bad_prefix").alias("prefix_failures"), is_("match", "mismatch").alias("executed"), F.count_if(F.col("exact") & F.col("outcome").isin("failed", "match", "mismatch")).alias("exact_matches"), is_("match").alias("exec_matches"),
    )
    d = F.greatest(F.lit(1), F.col("total") - F.col("gold_failures"))
    return base.select("*", (F.col("executed") / d).alias("executed_rate"), (F.col("exact_matches") / d).alias("exact_rate"), (F.col("exec_matches") / d).alias("match_rate"))


# The names that a summary file gives the metrics.
SUMMARY_NAMES = {
    "total": "total", "generated": "generated", "generation_errors": "generation_errors", "prefix_failures": "sql_prefix_failures", "exact_matches": "exact_sql_match", "executed": "pred_exec_ok",
    "exec_matches": "exec_match", "gold_failures": "gold_exec_failures", "exact_rate": "exact_sql_match_rate", "executed_rate": "pred_exec_ok_rate", "match_rate": "exec_match_rate",
}


def summary_names(metrics_row: dict) -> dict:
    return {name: metrics_row[k] for k, name in SUMMARY_NAMES.items()}


def compared(variants: DataFrame, left: DataFrame, right: DataFrame, rate: str) -> DataFrame:
    """(variant, left_rate, right_rate, delta, left_text, right_text, delta_text): both runs for each listed variant, 0 where one lacks it."""
    a, b = left.select("variant", F.col(rate).alias("l")), right.select("variant", F.col(rate).alias("r"))
    out = variants.join(a, "variant", "left").join(b, "variant", "left").select("variant", F.coalesce("l", F.lit(0.0)).alias("left_rate"), F.coalesce("r", F.lit(0.0)).alias("right_rate"))
    out = out.withColumn("delta", F.col("right_rate") - F.col("left_rate"))
    return out.select("*", T.percent(F.col("left_rate")).alias("left_text"), T.percent(F.col("right_rate")).alias("right_text"), T.points(F.col("delta")).alias("delta_text"))


def decision(rows: DataFrame, variant: str = "C") -> str:
    got = rows.where(F.col("variant") == variant).select("delta").collect()
    delta = got[0].delta if got else 0.0
    return "right" if delta > 0 else "left" if delta < 0 else "tie"


def markdown(rows: DataFrame, left: str, right: str) -> str:
    """Comparison table (one line for each variant) and the decision."""
    lines = [f"| Variant | {left} | {right} | Delta |", "|---|---|---|---|"]
    lines += [f"| {r.variant} | {r.left_text} | {r.right_text} | {r.delta_text} |" for r in rows.orderBy("variant").toLocalIterator()]
    return "\n".join([*lines, "", f"Decision: {decision(rows)}"])


def signature_of(df: DataFrame) -> DataFrame:
    """One row (n, signature): equal for tables of equal column names and equal rows, whatever their order.  A sum of row hashes, so no task
    gathers the rows."""
    row = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    h = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.select(h.alias("h")).agg(F.count("*").alias("n"), F.coalesce(F.sum("h"), F.lit(0).cast("decimal(38,0)")).cast("string").alias("signature"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal column names and equal rows, repeats counted."""
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def line_numbered(df: DataFrame, order: list[str]) -> DataFrame:
    return numbered(df, order, "source_line")
