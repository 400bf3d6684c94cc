import glob
import json

import pytest
from pyspark.sql import functions as F

from tezaur.plans import evaluation, files

CONTEXT = "Schema / context SQL:\nCREATE TABLE t (a INTEGER, b TEXT);\nINSERT INTO t VALUES (1, 'x');\n\nQ:\n"


def record(**more):
    return {"id": "r", "instruction": "Arată", "input": CONTEXT + "Ce e?", "output": "SELECT a FROM t", "system": "s", "metadata": {"z": 1, "a": "ă"}} | more


def write(path, rows):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def read(path):
    lines = [x for p in sorted(glob.glob(f"{path}/part-*")) for x in open(p, encoding="utf-8").read().splitlines()]
    return [json.loads(x) for x in lines]


def without(key):
    r = record()
    del r[key]
    return r


def test_clean_folder(spark, tmp_path):
    queries = [
        record(), "", "{bad", without("system"), record(metadata=[1]), record(output="  "), record(output=None), record(output="DELETE FROM t"), record(input="x"), record(output="SELECT nope FROM t"),
        record(instruction="È™coală Ã®n", metadata={"sql_explanation_ro": "Ã®n", "task": "old"}), record(instruction=None),
    ]
    write(tmp_path / "queries_alpaca_ro.jsonl", queries)
    write(tmp_path / "operators_alpaca_ro.jsonl", [record(output="DELETE FROM t")])
    out = tmp_path / "out"
    m = files.clean_folder(spark, str(tmp_path), str(out), strict_type=True)
    q = m["results"]["queries"]
    assert q["counters"] == {
        "total": 12, "kept": 3, "dropped": 9, "rows_with_text_fixes": 1, "drop_empty_line": 1, "drop_invalid_json": 1, "drop_missing_key": 1, "drop_metadata_not_object": 1, "drop_empty_output_sql": 1,
        "drop_sql_keyword_not_allowed": 2, "drop_input_parse_failed": 1, "drop_sql_exec_failed": 1,
    }
    assert q["keep_rate"] == 0.25 and q["changed_fields"] == {"instruction": 1, "metadata.sql_explanation_ro": 1} and [x["line_no"] for x in q["sample_drops"]] == [2, 3, 4, 5, 6, 7, 8, 9, 10]
    kept = read(f"{out}/queries_alpaca_ro.clean.jsonl")
    assert [k["instruction"] for k in kept] == ["Arată", "școală în", None] and kept[1]["metadata"] == {"sql_explanation_ro": "în", "task": "user"}
    assert list(kept[0]) == [*record(), "task"] and kept[0]["input"] == CONTEXT.replace("Q:", "Întrebare:") + "Ce e?" and kept[0]["task"] == "user"
    assert m["results"]["operators"]["counters"]["kept"] == 1 and json.loads((out / "manifest_clean.json").read_text())["results"]["queries"]["keep_rate"] == 0.25
    with pytest.raises(FileNotFoundError):
        files.clean_folder(spark, str(tmp_path / "none"), str(out))


def test_prepare(spark, tmp_path):
    q = write(tmp_path / "q.jsonl", [record(), "{bad", "", record(instruction=" "), record(system=" ", metadata=None, task="user"), record(id="late")])
    o = write(tmp_path / "o.jsonl", [record(output="DELETE FROM t ")])
    g = write(tmp_path / "g.jsonl", [record(metadata={"id": "own", "source_dataset": "x"}), record(input=None)])
    m = files.prepare(spark, g, q, o, str(tmp_path / "out"), limit=2, own="made", own_source="made_here", prefix="x_")
    assert m["stats"] == {"external_queries": {"read": 4, "written": 2, "dropped": 2}, "external_operators": {"read": 1, "written": 1, "dropped": 0}, "external_all_rows": 3, "made": {"read": 2, "written": 2, "dropped": 0}}
    rows = read(m["outputs"]["external_all"])
    assert [r["output"] for r in rows] == ["SELECT a FROM t", "SELECT a FROM t", "DELETE FROM t"] and rows[1]["system"] == files.PREPARE_SYSTEM
    assert list(rows[0]["metadata"].items()) == [("z", 1), ("a", "ă"), ("id", "r"), ("source_dataset", "external_queries")] and rows[1]["metadata"] == {"id": "r", "task": "user", "source_dataset": "external_queries"}
    own = read(m["outputs"]["made"])
    assert own[0]["metadata"] == {"id": "own", "source_dataset": "made_here"} and own[1]["input"] == "None"
    info = json.loads((tmp_path / "out" / "dataset_info.json").read_text())
    assert info["x_external_all_sft"] == {"file_name": "external_all.alpaca.jsonl", "formatting": "alpaca", "columns": {"prompt": "instruction", "query": "input", "response": "output", "system": "system"}}
    (tmp_path / "empty.jsonl").write_text("")
    with pytest.raises(ValueError):
        files.prepare(spark, str(tmp_path / "empty.jsonl"), q, o, str(tmp_path / "out"))


def test_merge(spark, tmp_path):
    for name, index in (("b", 0), ("a", 1)):
        d = tmp_path / f"shard_{name}"
        d.mkdir()
        write(d / "queries_alpaca_ro.jsonl", [{"id": f"{name}{i}"} for i in range(3)] + [""])
        write(d / "operators_alpaca_ro.jsonl", [{"id": name}])
        (d / "manifest.json").write_text(json.dumps({"shard_index": index, "n": 3}))
    m = files.merge_shards(spark, None, str(tmp_path / "out"), str(tmp_path), "shard_*")
    assert [r["id"] for r in read(tmp_path / "out" / "queries_alpaca_ro.jsonl")] == ["b0", "b1", "b2", "a0", "a1", "a2"]
    assert (m["num_shards"], m["queries_count"], m["operators_count"]) == (2, 6, 2) and [s["shard_index"] for s in m["shards"]] == [0, 1] and m["merged_from"][0].endswith("shard_b")
    with pytest.raises(FileNotFoundError):
        files.merge_shards(spark, None, str(tmp_path / "out"), str(tmp_path), "nothing_*")


def test_evaluate_and_compare(spark, tmp_path):
    rows = [
        {"instruction": "Câte?", "input": "ctx", "output": "SELECT count(*) AS n FROM t", "metadata": {"domain": "Trains", "id": "m1"}},
        {"id": "q1", "domain": "education", "question_ro": "", "question_en": "all", "sql": "SELECT a FROM t", "system": "own"},
        {"id": "bad", "domain": "trains", "question_ro": "?", "sql": "SELECT nope"}, {"id": "nodb", "question_ro": "?", "sql": "SELECT 1"}, {"id": "nogold", "domain": "trains", "question_ro": "?"}, "",
    ]
    test_set = write(tmp_path / "t.jsonl", rows)
    lines = files.numbered_lines(spark, test_set).where(F.col("value") != "")
    got = {r.case_id: r for r in evaluation.cases(evaluation.case_rows(lines), "line_no", "D").collect()}
    assert sorted(got) == ["bad", "m1", "q1"] and got["m1"].db_id == "rail_mers_tren" and got["m1"].user_prompt == "Câte?\n\nctx" and got["q1"].user_prompt == "all" and got["q1"].system_prompt == "D"
    toy = "CREATE TABLE t (a INTEGER); INSERT INTO t VALUES (1), (2);"
    told = [("A", c, s, e) for c, s, e in (("m1", "select COUNT(*) AS n from t;", None), ("q1", "Iată", None), ("bad", "SELECT 1", None))]
    told += [("B", "m1", "SELECT 3 AS n", None), ("B", "q1", None, "no memory"), ("B", "bad", "x", None)]
    predictions = spark.createDataFrame(told, "variant string, case_id string, pred_sql string, error string")
    dumps = {"rail_mers_tren": toy, "edu_reteaua_scolara": toy}
    s = files.evaluate_files(spark, test_set, predictions, dumps, str(tmp_path / "l"))
    a, b = s["variants"]["A"], s["variants"]["B"]
    assert (a["total"], a["generated"], a["generation_errors"], a["sql_prefix_failures"], a["exact_sql_match"], a["pred_exec_ok"], a["exec_match"], a["gold_exec_failures"], a["exec_match_rate"]) == (3, 2, 0, 1, 1, 1, 1, 1, 0.5)
    assert (b["generated"], b["generation_errors"], b["exact_sql_match"], b["pred_exec_ok"], b["exec_match"]) == (1, 1, 0, 1, 0)
    assert [(r["variant"], r["case_id"], r["outcome"]) for r in read(tmp_path / "l" / "predictions.jsonl")][:3] == [("A", "m1", "match"), ("A", "q1", "bad_prefix"), ("A", "bad", "gold_failed")]
    files.evaluate_files(spark, test_set, predictions.where("variant = 'A'"), dumps, str(tmp_path / "r"))
    rows = files.compare_files(spark, f"{tmp_path}/l/summary.json", f"{tmp_path}/r/summary.json", ["A", "B"], f"{tmp_path}/c.json")
    assert rows[0]["delta_exec_match"] == 0.0 and rows[1]["left"]["pred_exec_ok_rate"] == 0.5 and rows[1]["delta_exec_ok"] == -0.5 and json.loads((tmp_path / "c.json").read_text())["variants"] == rows
    (tmp_path / "x.json").write_text('{"variants": []}')
    with pytest.raises(ValueError):
        files.read_summary(f"{tmp_path}/x.json")


def test_rail_xml(spark, tmp_path):
    from tezaur.plans.relational import rail_frames, rail_tables
    from tezaur.sources.sheets import read_trains

    stop = '<ElementTrasa CodStaDest="{}" DenStaDestinatie="{}" OraS="{}" OraP="{}" Rci="R">{}</ElementTrasa>'
    trains = '<Tren Numar="10" Operator="74" CategorieTren="R"><Trase><Trasa>' + stop.format(1, "Arad", 3600, 3660, "") + stop.format(2, "Gara Deva ", 90000, "", '<CalendarTren Zile="31"/>') + '</Trasa></Trase><RestrictiiTren><CalendarTren Zile="96"/></RestrictiiTren></Tren>'
    trains += '<Tren Numar="" Operator="1"><Trase><Trasa>' + stop.format(3, "x", 0, 0, "") + "</Trasa></Trase></Tren>"
    trains += '<Tren Numar="11" Operator="74"><Trase><Trasa>' + stop.format(1, "ARAD", 60, 120, "") + stop.format(4, " ", 0, 0, "") + "</Trasa></Trase></Tren>"
    (tmp_path / "t.xml").write_text(f"<R>{trains}</R>", encoding="utf-8")
    made = rail_tables(*rail_frames(read_trains(spark, str(tmp_path / "t.xml"))))
    assert [tuple(r) for r in made["stations"].orderBy("station_id").collect()] == [(1, 1, "Arad", "Arad"), (2, 2, "Gara Deva", "Hunedoara")]
    assert [tuple(r)[1:] for r in made["timetables"].orderBy("timetable_id").collect()] == [(1, 1, "01:00", "01:01", "R", "Sâmbătă - Duminică"), (1, 2, "01:00", None, "R", "Luni - Vineri"), (2, 1, "00:01", "00:02", "R", "Zilnic")]
