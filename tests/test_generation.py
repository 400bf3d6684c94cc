import json

from pyspark.sql import functions as F

from tezaur import __main__ as cli
from tezaur.plans import generation, introspect

DUMP = "CREATE TABLE t (a INTEGER, b TEXT);\nINSERT INTO t VALUES (1, 'x'), (2, 'y');\n"


def test_loop(spark):
    rows = [(1, "d", "user", "ask one", "Q one"), (2, "d", "user", "ask two", "Q two"), (3, "d", "user", "ask one", "Q three"), (4, "d", "user", "ask bad", "Q four"), (5, "d", "user", "ask fix", "Q five"), (6, "x", "user", "", "")]
    df = spark.createDataFrame(rows, "o int, db_id string, task string, prompt string, question string")
    model = generation.mock({"REPAIR ask fix": "SELECT a, b FROM t", "ask one": "SELECT a FROM t", "ask two": "SELECT b FROM t"}, "SELECT nothing")
    out = generation.generated(df, "o", "prompt", "question", model, lambda p, s, e: F.concat(F.lit("REPAIR "), p), {"d": DUMP})
    assert [(r.o, r.sql, r.question_ro, r.row_count) for r in out.orderBy("o").collect()] == [(1, "SELECT a FROM t", "Q one", 2), (2, "SELECT b FROM t", "Q two", 2), (5, "SELECT a, b FROM t", "Q five", 2)]


def test_candidates_and_repeats(spark):
    one = json.dumps({"task": "Queries", "question_en": " A? ", "sql": " SELECT a FROM t ", "difficulty": 2, "query_type": ["SELECT"], "tables": ["t"]})
    df = spark.createDataFrame([("01", "d", "user", "ask one"), ("02", "d", "user", "ask one again")], "o string, db_id string, task string, prompt string")
    answers = {"NEW": json.dumps({"question_en": "B?", "sql": "SELECT b FROM t"}), "ask one": f"Here: {one}."}
    out = generation.generated(df, "o", "prompt", None, generation.mock(answers), lambda p, s, e: F.when(e == "duplicate", F.lit("NEW")).otherwise(p), {"d": DUMP})
    got = {r.o: r for r in out.collect()}
    assert (got["01"].sql, got["01"].question_en, got["01"].difficulty, got["01"].tables) == ("SELECT a FROM t", "A?", 2, ["t"]) and (got["02"].sql, got["02"].question_ro, got["02"].notes) == ("SELECT b FROM t", "B?", "")
    c = df.select(generation.candidate(F.lit(one)).alias("c")).first().c
    assert c.task == "user" and c.query_type == ["SELECT"]


def test_no_presets(spark):
    text = introspect.snapshot({"t": spark.createDataFrame([(1, "x")], "a int, b string")}, "other", "d")
    assert text == "Domain: other\nDB ID: d\nTables and columns:\n- t(a, b)"


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "d.sql").write_text(DUMP)
    (tmp_path / "c.json").write_text(json.dumps({"domains": [{"name": "other", "db_id": "d", "sql_dump": "d.sql", "target_count": 1}]}))
    (tmp_path / "m.jsonl").write_text("\n".join(json.dumps({"id": str(i), "db_id": "d", "task": "user", "sql": s}) for i, s in enumerate(["SELECT a FROM t", "SELECT z FROM t"])))
    assert cli.main(["introspect", str(tmp_path / "c.json")]) == 0 and "- t(a, b)" in capsys.readouterr().out
    assert cli.main(["validate", str(tmp_path / "c.json"), str(tmp_path / "m.jsonl")]) == 1 and '"sql_failed": 1' in capsys.readouterr().out
    assert cli.main(["split", str(tmp_path / "m.jsonl"), str(tmp_path / "m.jsonl"), str(tmp_path / "o"), "--ratio", "0.5"]) == 0
    (tmp_path / "answers.json").write_text(json.dumps({"other": json.dumps({"question_en": "Which?", "sql": "SELECT a FROM t"})}))
    assert cli.main(["generate", str(tmp_path / "c.json"), str(tmp_path / "answers.json"), str(tmp_path / "g")]) == 0 and '"accepted": 1' in capsys.readouterr().out
    made = [json.loads(x) for p in (tmp_path / "g" / "master.jsonl").glob("part-*") for x in p.read_text().splitlines()]
    assert made[0]["id"] == "oth_000001" and made[0]["row_count"] == 2 and made[0]["question_ro"] == "Which?"
