"""Whole plans from JSON-lines files to JSON-lines files with their manifests: cleaning, preparation, merge, evaluation, comparison."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.waterfall import counters, first_failures
from ..session import cut
from ..sources.config import shard_folders
from ..sources.lines import json_checks, numbered_lines
from . import cleaning, evaluation, exports
from .split import file_counts, first_written

# Keys that a record of an external corpus must have, its files, and the system prompts of preparation and evaluation.
REQUIRED = ["instruction", "input", "output", "system", "metadata"]
TRACK_FILES = {"operators": "operators_alpaca_ro", "queries": "queries_alpaca_ro"}
PREPARE_SYSTEM = "You are a text-to-SQL assistant. Return only valid SQL."
EVALUATE_SYSTEM = (
    "You are a SQLite text-to-SQL engine.\nReturn exactly one valid SQLite SQL statement and nothing else.\nUse SQL keywords in English only.\n"
    "Do not translate SQL keywords to Romanian.\nDo not include markdown fences, comments, or explanations."
)


def write_lines(df: DataFrame, path: str, order: list[str], single: bool = False) -> None:
    """The column ``value`` as text lines in order: a folder of parts in that order, or with ``single`` one part (for small files)."""
    rows = df.orderBy(*order).select("value")
    (rows.coalesce(1) if single else rows).write.mode("overwrite").text(path)


def edited(value: str, **fields: str) -> Column:
    """The JSON object of a line with some keys set (key order stays).  A name like ``metadata__task`` sets a key inside an object; a null
    leaves the key as it is."""
    names = list(fields)

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            values, *columns = batch if isinstance(batch, tuple) else (batch,)
            out = []
            for v, *new in zip(values, *columns):
                d = json.loads(v)
                for name, x in zip(names, new):
                    if x is not None:
                        at, _, key = name.rpartition("__")
                        (d[at] if at else d)[key] = x
                out.append(json.dumps(d, ensure_ascii=False))
            yield pd.Series(out)

    return F.pandas_udf(run, "string")(F.col(value), *[F.col(c) for c in fields.values()])


def cleaned_lines(lines: DataFrame, track: str, strict_type: bool = False, run_sql: bool = True) -> DataFrame:
    """numbered lines(file, line_no, value) -> (file, line_no, value, drop_reason, changed_fields); value is the cleaned line of kept ones."""
    get = lambda path: F.try_variant_get("json", path, "string")
    rows = lines.withColumn("json", F.try_parse_json("value"))
    rows = rows.select("file", "line_no", "value", "json", *[get(f"$.{k}").alias(k) for k in REQUIRED[:4]], get("$.metadata.sql_explanation_ro").alias("explanation"))
    blank = ("empty_line", strip(F.col("value")) == "")
    told = cleaning.cleaned(rows, track, strict_type, run_sql, [blank, *json_checks(REQUIRED)])
    kept = told.where("drop_reason is null")
    changed = lambda name, c: F.when(F.array_contains("changed_fields", name), F.col(c))
    kept = kept.withColumns({"__i": changed("instruction", "instruction"), "__s": changed("system", "system"), "__e": changed("metadata.sql_explanation_ro", "explanation")})
    line = edited("value", instruction="__i", system="__s", task="task", metadata__task="task", metadata__sql_explanation_ro="__e", input="input")
    cols = ["file", "line_no", "value", "drop_reason", "changed_fields"]
    return kept.withColumn("value", line).select(*cols).unionByName(told.where("drop_reason is not null").select(*cols))


def clean_file(spark: SparkSession, source: str, target: str, track: str, strict_type: bool = False, run_sql: bool = True, most: int | None = None, single: bool = False) -> dict:
    """Cleans a file and returns its summary: counters, keep rate, changed fields, the first 20 drops."""
    rows = cut(cleaned_lines(numbered_lines(spark, source, most), track, strict_type, run_sql))
    write_lines(rows.where("drop_reason is null"), target, ["file", "line_no"], single)
    counted = {r.counter: r.n for r in counters(rows, fixed=F.size("changed_fields") > 0).collect()}
    drops = first_failures(rows.select("file", "line_no", "drop_reason"), "line_no").collect()
    return {
        "input_path": source, "output_path": target, "track": track, "validate_sql": run_sql, "strict_sql_type": strict_type, "max_lines": most, "counters": counted,
        "keep_rate": counted.get("kept", 0) / counted["total"] if counted.get("total") else 0.0,
        "changed_fields": {r.field: r.n for r in cleaning.changed_counts(rows).collect()}, "sample_drops": [{"line_no": r.line_no, "drop_reason": r.drop_reason} for r in drops],
    }


def _there(path: str) -> str:
    if not Path(path).exists():
        raise FileNotFoundError(f"missing input file: {path}")
    return path


def clean_folder(spark: SparkSession, source: str, target: str, strict_type: bool = False, run_sql: bool = True, most: int | None = None, single: bool = False) -> dict:
    """Cleans the operators' and the queries' file of a folder; writes and returns the manifest."""
    results = {t: clean_file(spark, _there(f"{source}/{name}.jsonl"), f"{target}/{name}.clean.jsonl", t, strict_type, run_sql, most, single) for t, name in TRACK_FILES.items()}
    manifest = {"source_dir": source, "output_dir": target, "validate_sql": run_sql, "strict_sql_type": strict_type, "max_lines": most, "results": results}
    exports.write_json(f"{target}/manifest_clean.json", manifest)
    return manifest


def training_lines(lines: DataFrame, source: str, default_system: str = PREPARE_SYSTEM) -> DataFrame:
    """lines(value, ...) without blank ones -> the same with ``written``, and value the normalised training record of written ones: texts
    stripped, the default system prompt where there is none, id and task copied into the metadata where absent, the source set."""

    def text(d: dict, key: str) -> str:
        return str(d.get(key, ""))

    def record(line: str) -> str | None:
        try:
            d = json.loads(line)
        except ValueError:
            return None
        if not isinstance(d, dict) or not text(d, "instruction").strip() or not text(d, "output").strip():
            return None
        given = d.get("metadata")
        meta = dict(given) if isinstance(given, dict) else {}
        for k in ("id", "task"):
            if k in d:
                meta.setdefault(k, d[k])
        meta["source_dataset"] = source
        out = {"instruction": text(d, "instruction").strip(), "input": text(d, "input"), "output": text(d, "output").strip()}
        return json.dumps(out | {"system": text(d, "system").strip() or default_system, "metadata": meta}, ensure_ascii=False)

    made = F.pandas_udf(lambda values: values.map(record), "string")("value")
    rows = lines.where(strip(F.col("value")) != "").withColumn("__made", made)
    return rows.withColumn("written", F.col("__made").isNotNull()).withColumn("value", F.col("__made")).drop("__made")


def prepare(spark: SparkSession, generated: str, queries: str, operators: str, target: str, limit: int | None = None, single: bool = False, own: str = "generated", own_source: str | None = None, prefix: str = "") -> dict:
    """Training files of a generated corpus and of an external one (by track and together), their registry and manifest.  ``own`` and
    ``own_source`` name the generated corpus and its records' source, ``prefix`` goes before the names of the registry."""
    paths = {"external_queries": _there(queries), "external_operators": _there(operators), own: _there(generated)}
    if Path(generated).is_file() and not Path(generated).stat().st_size:
        raise ValueError(f"empty input file: {generated}")
    stats, parts = {}, []
    for place, (name, path) in enumerate(paths.items()):
        source = (own_source or own) if name == own else name
        rows = cut(training_lines(numbered_lines(spark, path), source).withColumn("place", F.lit(place)).withColumn("source", F.lit(source)))
        rows = first_written(rows, "line_no", "written", limit)
        counted = file_counts(rows, "source", "written").where("source <> 'all'").first()
        stats[name] = {k: (counted[k] if counted else 0) for k in ("read", "written", "dropped")}
        written = rows.where("written").select("place", "file", "line_no", "value")
        write_lines(written, f"{target}/{name}.alpaca.jsonl", ["file", "line_no"], single)
        if name != own:
            parts.append(written)
    write_lines(parts[0].unionByName(parts[1]), f"{target}/external_all.alpaca.jsonl", ["place", "file", "line_no"], single)
    outputs = {n: f"{target}/{n}.alpaca.jsonl" for n in ("external_queries", "external_operators", "external_all", own)}
    info = {f"{prefix}{n}_sft": {"file_name": Path(p).name, "formatting": "alpaca", "columns": exports.registry({n: p})[n]["columns"]} for n, p in outputs.items()}
    exports.write_json(f"{target}/dataset_info.json", info)
    stats = {"external_queries": stats["external_queries"], "external_operators": stats["external_operators"], "external_all_rows": stats["external_queries"]["written"] + stats["external_operators"]["written"], own: stats[own]}
    manifest = {"inputs": {**{k: paths[k] for k in (own, "external_queries", "external_operators")}, "limit_per_file": limit}, "outputs": outputs | {"dataset_info": f"{target}/dataset_info.json"}, "stats": stats}
    exports.write_json(f"{target}/manifest_prep.json", manifest)
    return manifest


def merge_shards(spark: SparkSession, folders: list[str] | None, target: str, root: str = ".", pattern: str = "*", single: bool = False) -> dict:
    """Shards' files one after the other in the order of their manifests' index, with a manifest of the whole."""
    given = [(d, json.loads(Path(_there(f"{d}/manifest.json")).read_text(encoding="utf-8"))) for d in shard_folders(folders, root, pattern)]
    given.sort(key=lambda x: int(x[1].get("shard_index", 0)))
    counts = {}
    for name in TRACK_FILES.values():
        rows = None
        for place, (folder, _) in enumerate(given):
            one = numbered_lines(spark, _there(f"{folder}/{name}.jsonl")).where(strip(F.col("value")) != "").withColumn("place", F.lit(place))
            rows = one if rows is None else rows.unionByName(one)
        rows = cut(rows.select("place", "file", "line_no", edited("value").alias("value")))
        write_lines(rows, f"{target}/{name}.jsonl", ["place", "file", "line_no"], single)
        counts[name] = rows.count()
    manifest = {
        "merged_from": [d for d, _ in given], "num_shards": len(given), "queries_count": counts[TRACK_FILES["queries"]], "operators_count": counts[TRACK_FILES["operators"]],
        "shards": [{"shard_index": int(m.get("shard_index", 0)), "shard_dir": d, "manifest": m} for d, m in given],
    }
    exports.write_json(f"{target}/manifest_merged.json", manifest)
    return manifest


def evaluate_files(spark: SparkSession, test_set: str, predictions: DataFrame, dumps: dict[str, str], target: str, most: int | None = 200, romanian: bool = True, single: bool = False) -> dict:
    """predictions(variant, case_id, pred_sql, error) against the cases of a JSON-lines file: details in predictions.jsonl, the summary in
    summary.json (keys in order within each variant)."""
    lines = numbered_lines(spark, _there(test_set)).where(strip(F.col("value")) != "")
    found = cut(evaluation.cases(evaluation.case_rows(lines), "line_no", EVALUATE_SYSTEM, most, romanian))
    told = cut(evaluation.judged(predictions.join(F.broadcast(found.select("case_id").distinct()), "case_id", "left_semi") if most else predictions, found, dumps))
    rows = told.withColumn("value", F.to_json(F.struct(*[c for c in told.columns])))
    write_lines(rows, f"{target}/predictions.jsonl", ["variant", "source_line", "case_id"], single)
    summary = {"test_set": test_set, "num_cases": found.count(), "variants": {}}
    for r in evaluation.metrics(told).orderBy("variant").collect():
        d = r.asDict()
        summary["variants"][d.pop("variant")] = evaluation.summary_names(d)
    exports.write_json(f"{target}/summary.json", summary)
    return summary


def read_summary(path: str) -> dict:
    """An evaluation's summary; an error where it has no object of variants."""
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(data, dict) or not isinstance(data.get("variants"), dict):
        raise ValueError(f"no variants in {path}")
    return data


def compare_files(spark: SparkSession, left: str, right: str, variants: list[str], out_json: str | None = None) -> list[dict]:
    """Rates of two summaries side by side for each variant, 0 where one lacks it, with their differences."""
    sides = [read_summary(p)["variants"] for p in (left, right)]
    rates = ["exact_sql_match_rate", "pred_exec_ok_rate", "exec_match_rate"]
    frames = [spark.createDataFrame([(v, *[float(m.get(r, 0.0)) for r in rates]) for v, m in side.items()], "variant string, " + ", ".join(f"{r} double" for r in rates)) for side in sides]
    listed = spark.createDataFrame([(v,) for v in variants], "variant string")
    by_rate = {r: {x.variant: x for x in evaluation.compared(listed, *frames, r).collect()} for r in rates}
    short = {"exact_sql_match_rate": "delta_exact", "pred_exec_ok_rate": "delta_exec_ok", "exec_match_rate": "delta_exec_match"}
    rows = [{"variant": v, "left": {r: by_rate[r][v].left_rate for r in rates}, "right": {r: by_rate[r][v].right_rate for r in rates}, **{short[r]: by_rate[r][v].delta for r in rates}} for v in variants]
    if out_json:
        exports.write_json(out_json, {"left": left, "right": right, "variants": rows})
    return rows
