"""python -m tezaur introspect|validate|split|clean|prepare|merge|evaluate|compare|generate ..."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import cleaning, exports, files, generation, introspect, prompts
from .plans.split import evaluation_split
from .session import local_session
from .sources.config import database_map, load_config
from .sources.dumps import read_dump


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tezaur")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, what: str, *places: str) -> argparse.ArgumentParser:
        a = sub.add_parser(name, help=what)
        for x in places:
            a.add_argument(x)
        return a

    add("introspect", "print each domain's schema text", "config")
    add("validate", "run every statement of a JSONL corpus; exit code 1 where any fails", "config", "corpus").add_argument("--allow-empty", action="store_true")
    a = add("split", "draw an evaluation split and write it and its complement", "queries", "operators", "out")
    a.add_argument("--ratio", type=float, default=0.2)
    a.add_argument("--seed", type=int, default=42)
    a.add_argument("--single", action="store_true")
    a = add("clean", "clean the files of an external corpus", "source", "out")
    a.add_argument("--max-lines", type=int)
    a.add_argument("--no-validate-sql", action="store_true")
    a.add_argument("--strict-sql-type", action="store_true")
    a.add_argument("--single", action="store_true")
    a = add("prepare", "write training files, their registry and manifest", "generated", "queries", "operators", "out")
    a.add_argument("--limit", type=int)
    a.add_argument("--own", default="generated", help="name of the generated corpus")
    a.add_argument("--own-source", help="source that its records name")
    a.add_argument("--prefix", default="", help="before the names of the registry")
    a.add_argument("--single", action="store_true")
    a = add("merge", "merge shard folders in the order of their index", "out")
    a.add_argument("--shards", nargs="+")
    a.add_argument("--root", default=".")
    a.add_argument("--pattern", default="*")
    a.add_argument("--single", action="store_true")
    a = add("evaluate", "run stored predictions (JSONL of variant, case_id, pred_sql, error) against a test set", "test_set", "predictions", "out")
    a.add_argument("--db", action="append", default=[], help="db_id=script.sql")
    a.add_argument("--max-cases", type=int, default=200)
    a.add_argument("--english", action="store_true")
    a.add_argument("--single", action="store_true")
    a = add("compare", "compare two evaluation summaries", "left", "right")
    a.add_argument("--variants", default="O,A,B,C")
    a.add_argument("--out-json")
    a = add("generate", "generate, run and deduplicate records with stored answers (JSON of prompt part to answer)", "config", "answers", "out")
    a.add_argument("--single", action="store_true")
    return p


def generate(spark: SparkSession, config_path: str, answers: dict[str, str], out: str, single: bool) -> dict:
    """One record asked for each place of a domain's target count, in the cycle of its tasks; accepted ones in all training formats."""
    config, kept = load_config(config_path), None
    for d in config.domains:
        schema = introspect.snapshot(read_dump(spark, d.sql_dump), d.name, d.db_id)
        cycle = F.array(*[F.lit(t) for t in config.generation["task_cycle"]])
        ask = spark.range(d.target_count).select(F.format_string(f"{d.id_prefix}_%06d", F.col("id") + 1).alias("order"), F.lit(d.db_id).alias("db_id"), F.lit(d.name).alias("domain"), F.get(cycle, F.col("id") % F.size(cycle)).alias("task"))
        args = (F.lit(1), F.lit(d.min_rows), F.lit(True))
        ask = ask.withColumn("prompt", prompts.generation_prompt(F.col("domain"), F.col("task"), *args, F.array().cast("array<string>"), F.lit(schema)))
        repair = lambda p, sql, error, d=d, schema=schema: prompts.repair_prompt(F.lit(d.name), F.lit("user"), F.lit(""), sql, F.lit(1), error, F.lit(d.min_rows), F.lit(True), F.lit(schema))
        rows = generation.generated(ask, "order", "prompt", None, generation.mock(answers), repair, {d.db_id: Path(d.sql_dump).read_text(encoding="utf-8")}, min_rows={d.db_id: d.min_rows})
        rows = rows.withColumn("domain", F.lit(d.name))
        kept = rows if kept is None else kept.unionByName(rows)
    full = generation.examples(kept, "order")
    for name, form in (("master", exports.master), ("alpaca", exports.alpaca), ("chat", exports.chat)):
        exports.write_jsonl(form(full), f"{out}/{name}.jsonl", ["id"], single)
    return {"accepted": full.count()}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = local_session("*")
    if args.command == "introspect":
        for d in load_config(args.config).domains:
            print(introspect.snapshot(read_dump(spark, d.sql_dump), d.name, d.db_id))
        return 0
    if args.command == "validate":
        config = load_config(args.config)
        dumps = {d.db_id: Path(d.sql_dump).read_text(encoding="utf-8") for d in config.domains}
        rows = spark.read.json(args.corpus)
        out = cleaning.validated(rows, dumps, {d.db_id: d.min_rows for d in config.domains}, not args.allow_empty)
        summary = cleaning.status_counts(out).first().asDict()
        print(json.dumps(summary))
        return int(summary["total"] != summary["valid"])
    if args.command == "split":
        ev, tr = evaluation_split(spark.read.json(args.queries), spark.read.json(args.operators), "id", args.ratio, args.seed)
        exports.write_jsonl(ev, f"{args.out}/evaluation", ["place"], single=args.single)
        exports.write_jsonl(tr, f"{args.out}/training")
        out = {"evaluation": ev.count(), "training": tr.select(F.lit(1)).count()}
    elif args.command == "clean":
        out = files.clean_folder(spark, args.source, args.out, args.strict_sql_type, not args.no_validate_sql, args.max_lines, args.single)
    elif args.command == "prepare":
        out = files.prepare(spark, args.generated, args.queries, args.operators, args.out, args.limit, args.single, args.own, args.own_source, args.prefix)
    elif args.command == "merge":
        out = files.merge_shards(spark, args.shards, args.out, args.root, args.pattern, args.single)
    elif args.command == "evaluate":
        dumps = {k: Path(v).read_text(encoding="utf-8") for k, v in database_map(args.db).items()}
        predictions = spark.read.schema("variant string, case_id string, pred_sql string, error string").json(args.predictions)
        out = files.evaluate_files(spark, args.test_set, predictions, dumps, args.out, args.max_cases, not args.english, args.single)
    elif args.command == "compare":
        out = files.compare_files(spark, args.left, args.right, [v.strip() for v in args.variants.split(",") if v.strip()], args.out_json)
    else:
        out = generate(spark, args.config, json.loads(Path(args.answers).read_text(encoding="utf-8")), args.out, args.single)
    print(json.dumps(out, ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
