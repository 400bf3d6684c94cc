import json
import zipfile

from pyspark.sql import functions as F

from tezaur.functions import text as T
from tezaur.operators.waterfall import classified
from tezaur.plans import cleaning, exports, prompts, relational
from tezaur.sources import config, dumps, lines, sheets
from tezaur.streaming.state import first_seen, window_counts

DUMP = """-- a comment; with a semicolon
CREATE TABLE s (id INTEGER PRIMARY KEY, name VARCHAR(20) NOT NULL, PRIMARY KEY (id));
INSERT INTO s (id, name) VALUES (1, 'L''Aquila; (x)'), ('2', NULL);
INSERT INTO s VALUES (3, 'ș');"""


def test_dump_round_trip(spark, tmp_path):
    p = tmp_path / "d.sql"
    p.write_text(DUMP, encoding="utf-8")
    t = dumps.read_dump(spark, str(p))["s"]
    rows = [(1, "L'Aquila; (x)"), (2, None), (3, "ș")]
    assert [tuple(r) for r in t.orderBy("id").collect()] == rows and spark.table("s").count() == 3
    made = dumps.insert_statements(t, "s", ["id"], [("id", F.col("id").cast("string")), ("name", T.literal(F.col("name")))], size=2)
    script = dumps.dump_script(["CREATE TABLE s (id INTEGER, name TEXT);"], [made])
    assert script.count() == 4 and config.catalog(spark)["s"] == ["id", "name"]
    p.write_text("\n".join(r.value for r in script.orderBy("part", "batch").collect()), encoding="utf-8")
    assert [tuple(r) for r in dumps.read_dump(spark, str(p))["s"].orderBy("id").collect()] == rows


def test_lines_and_checks(spark, tmp_path):
    good = {"instruction": "i", "input": "x", "output": "SELECT 1", "system": "", "metadata": {}}
    out = [json.dumps(good), "", "{bad", json.dumps({**good, "metadata": 1}), json.dumps({k: v for k, v in good.items() if k != "output"}), "[1]", json.dumps({**good, "output": None})]
    (tmp_path / "a.jsonl").write_text("\n".join(out) + "\n", encoding="utf-8")
    got = lines.numbered_lines(spark, str(tmp_path / "a.jsonl"))
    assert [r.line_no for r in got.orderBy("line_no").collect()] == list(range(1, 8)) and lines.numbered_lines(spark, str(tmp_path), 2).count() == 2
    rows = classified(lines.parsed(got), lines.json_checks(list(good)), "reason").orderBy("line_no").collect()
    assert [r.reason for r in rows] == [None, "invalid_json", "metadata_not_object", "missing_key:output", "not_an_object", None]
    assert lines.latest_file(spark, str(tmp_path), "*.jsonl").endswith("a.jsonl") and lines.non_empty_lines(spark, str(tmp_path)).count() == 6
    many = "\n".join(str(i) for i in range(5000))
    (tmp_path / "b.txt").write_text(many)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert lines.numbered_lines(spark, str(tmp_path / "b.txt")).where("line_no - 1 <> cast(value as int)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sheet_and_xml(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda r, v: f'<c r="{r}" t="inlineStr"><is><t>{v}</t></is></c>'
    sheet = f'<worksheet {ns}><sheetData><row>{cell("A1", "x")}</row><row>{cell("A2", "a")}{cell("C2", "a")}</row><row>{cell("A3", "1")}{cell("B3", "2")}{cell("C3", "3")}</row><row></row></sheetData></worksheet>'
    with zipfile.ZipFile(tmp_path / "s.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    got = sheets.read_sheet(spark, str(tmp_path / "s.xlsx"), header=1)
    assert got.columns == ["a", "col_1"] and [tuple(r) for r in got.collect()] == [("3", "2")]
    (tmp_path / "t.xml").write_text('<X><Tren Numar="017"/><Tren Numar="2"/></X>')
    assert [r._Numar for r in sheets.read_trains(spark, str(tmp_path / "t.xml")).collect()] == ["017", "2"]


def test_config(tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"domains": [{"name": "trains", "db_id": "r", "sql_dump": "d.sql", "target_count": 5}], "generation": {"task_cycle": []}}))
    c = config.load_config(str(p))
    assert c.domains[0].id_prefix == "tra" and c.domains[0].sql_dump == str(tmp_path / "d.sql") and c.generation["task_cycle"] == ["user"]
    assert config.database_map(["a=b"]) == {"a": "b"} and config.shard_folders(None, str(tmp_path.parent), tmp_path.name) == [str(tmp_path)]


def test_schools_and_rail(spark):
    cols = ["Cod SIIIR unitate", "Cod SIIIR PJ", "Statut unitate", "Denumire PJ", "Denumire lunga unitate", "Denumire scurta unitate", "Forma proprietate", "Localitate unitate", "Mediu loc. unitate", "Judet PJ"]
    net = [("12", "12", "PJ", "A", "long", "", "pub", "Turda", "U", "CJ"), ("13", "12", "AR", "A", "", "s", "", "TURDA", "R", "CJ"), ("12", "12", "PJ", "B", "", "", "", "Aiud", "U", "AB"), ("14", "14", "PJ", "C", "", "", "", "Aiud", "U", "AB")]
    network = spark.createDataFrame([(i, *r) for i, r in enumerate(net)], ", ".join(["o int", *(f"`{c}` string" for c in cols)]))
    enrol = spark.createDataFrame([("12", "x", "Liceal"), ("000014", "5", "Primar"), ("14", "6", "Gimnazial")], "`Cod unitate PJ` string, `Elevi exist anterior-asoc` string, `Nivel` string")
    t = relational.school_tables(network, enrol, "o")
    assert [tuple(r) for r in t["counties"].orderBy("county_id").collect()] == [(1, "AB", "Alba"), (2, "CJ", "Cluj")]
    assert [(r.locality_name, r.county_id) for r in t["localities"].orderBy("locality_id").collect()] == [("Turda", 2), ("Aiud", 1)]
    s = t["schools"].orderBy("school_id").collect()
    assert [(r.siiir_code, r.school_name, r.number_of_students, r.education_level, r.locality_id) for r in s] == [("0000000012", "A", 0, "Liceal", 1), ("0000000013", "A", None, None, 1), ("0000000014", "C", 11, "Gimnazial, Primar", 2)]
    trains = spark.createDataFrame([(1, "10", "7", "R", "31"), (2, "", "7", "R", None)], "train_order int, number string, operator string, category string, mask string")
    stops = spark.createDataFrame([(1, 0, "5", "Arad", "3600", "60", "R", None), (1, 1, "5", "ARAD", "7200", "x", "R", "96"), (2, 0, "6", "x", "0", "0", "R", None)], "train_order int, place int, code string, station string, seconds_in string, seconds_out string, kind string, mask string")
    r = relational.rail_tables(trains, stops, [("Arad", ["ARAD"])])
    assert [tuple(x) for x in r["stations"].collect()] == [(1, 5, "Arad", "Arad")] and r["trains"].count() == 1
    assert [tuple(x)[3:] for x in r["timetables"].orderBy("timetable_id").collect()] == [("01:00", "00:01", "R", "Luni - Vineri"), ("02:00", None, "R", "Sâmbătă - Duminică")]


def test_cleaning_with_sql(spark):
    text = "Schema / context SQL:\nCREATE TABLE t (a INT);\n\nQ:\nÃ®n?"
    df = spark.createDataFrame([("È™i", text, "SELECT a FROM t", "s"), ("x", text, "SELECT b FROM t", "s"), ("x", "y", "SELECT 1", None), ("x", text, None, "s")], "instruction string, input string, output string, system string")
    rows = cleaning.cleaned(df, "queries", strict_type=True, run_sql=True).collect()
    ok = [r for r in rows if r.drop_reason is None]
    assert len(ok) == 1 and ok[0].instruction == "și" and ok[0].input.endswith("Întrebare:\nîn?") and sorted(ok[0].changed_fields) == ["input.question_ro", "instruction"]
    assert sorted(r.drop_reason.split(":")[0] for r in rows if r.drop_reason) == ["input_parse_failed", "sql_exec_failed", "sql_keyword_not_allowed"]


def test_exports_and_prompts(spark, tmp_path):
    df = spark.createDataFrame([('{"b": 1.0, "a": null}', "7", "user", "src"), ("[1]", None, None, "src"), (None, "8", None, "src")], "m string, i string, t string, s string")
    got = [r.x for r in df.select(exports.metadata_json("m", "i", "t", "s").alias("x")).collect()]
    assert got == ['{"b": 1.0, "a": null, "id": "7", "task": "user", "source_dataset": "src"}', '{"source_dataset": "src"}', '{"id": "8", "source_dataset": "src"}']
    js = spark.createDataFrame([("null",), ("true",), ("1.0",), (None,), ('[1, "a"]',)], "j string")
    assert [r.x for r in js.select(exports.py_text("j").alias("x")).collect()] == ["None", "True", "1.0", "", "[1, 'a']"]
    exports.write_jsonl(spark.createDataFrame([(2, "ș"), (1, None)], "a int, b string"), str(tmp_path / "o"), ["a"], single=True)
    assert [r.value for r in spark.read.text(str(tmp_path / "o")).collect()] == ['{"a":1,"b":null}', '{"a":2,"b":"ș"}']
    assert exports.ratio_suffix(20.0) == "20" and exports.ratio_suffix(12.5) == "12p5"
    one = spark.createDataFrame([(["a", "b", "c", "d", "e", "duplicate f"],), ([],)], "f array<string>")
    made = one.select(prompts.generation_prompt(F.lit("d"), F.lit("operators"), F.lit(2), F.lit(1), F.lit(True), F.col("f"), F.lit("S")).alias("x")).collect()
    assert "- b\n" in made[0].x and "- a\n" not in made[0].x and "Duplicate-avoidance" in made[0].x and "feedback" not in made[1].x and made[1].x.endswith("hints:\nS")


def test_streams(spark, tmp_path):
    rows = spark.sql("select * from values (timestamp'2025-01-01 00:10:00', 'a'), (timestamp'2025-01-01 00:20:00', 'a'), (timestamp'2025-01-03 00:00:00', 'b') t(ts, k)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for name, df, mode in (("seen", first_seen(stream(), F.col("k"), "ts"), "append"), ("counts", window_counts(stream(), "ts", ["k"]), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(60)
    assert sorted(r.k for r in spark.table("seen").collect()) == ["a", "b"]
    assert sorted((r.k, r.n) for r in spark.table("counts").collect()) == [("a", 2), ("b", 1)]
