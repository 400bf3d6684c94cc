import random

from pyspark.sql import functions as F

from tezaur.operators import keys, sampling, sandbox, stats
from tezaur.operators.waterfall import classified, counters, first_failures, keep_rate
from tezaur.plans import evaluation
from tezaur.plans.split import evaluation_split, file_counts, first_written


def test_two_keys_equal_a_loop(spark):
    for seed in range(2):
        r = random.Random(seed)
        rows = [(i, r.choice("abcdef") + r.choice("xy"), r.choice([None, "1", "2", "3", "4", "5", "6", "7"])) for i in range(120)]
        seen_a, seen_b, want = set(), set(), []
        for i, a, b in rows:
            if a not in seen_a and b not in seen_b:
                seen_a.add(a)
                seen_b.add(b)
                want.append(i)
        df = spark.createDataFrame(rows, "o int, a string, b string")
        assert sorted(x.o for x in keys.two_key_dedup(df, "o", F.col("a"), F.col("b")).collect()) == want
    assert keys.two_key_dedup(df.limit(0), "o", F.col("a"), F.col("b")).count() == 0


def test_numbered_and_first_seen(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("k", F.col("id") % 13)
    got = keys.numbered(df.select("id"), ["id"], "n").collect()
    assert all(r.n == r.id + 1 for r in got) and len(got) == 1000
    seen = keys.first_seen_ids(df, [F.col("k")], "id", ["k"], "n").collect()
    assert sorted((r.n, r.k) for r in seen) == [(i + 1, i) for i in range(13)]
    assert keys.numbered(df.limit(0), ["id"], "n").count() == 0


def test_waterfall(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "x"), (3, None, None)], "i int, a string, b string")
    out = classified(df, [("no_a", F.col("a").isNull()), (F.concat(F.lit("bad:"), "b"), F.col("b") == "x"), ("no_b", F.col("b").isNull())])
    assert [r.drop_reason for r in out.orderBy("i").collect()] == ["no_b", "no_a", "no_a"]
    assert dict(map(tuple, counters(out).collect())) == {"total": 3, "dropped": 3, "drop_no_a": 2, "drop_no_b": 1}
    assert tuple(keep_rate(out.limit(0)).first()) == (0, 0, 0.0) and first_failures(out, "i", n=2).count() == 2


def test_samples(spark):
    q, o = spark.range(0, 103).withColumnRenamed("id", "x"), spark.range(1000, 1003).withColumnRenamed("id", "x")
    ev, tr = evaluation_split(q, o, "x", 0.2)
    a, b = {r.x for r in ev.collect()}, {r.x for r in tr.collect()}
    assert len(a) == 21 and not a & b and len(a | b) == 106 and sorted(r.place for r in ev.collect()) == list(range(1, 22))
    assert sampling.sample_size(3, 0.01) == 1 and sampling.sample_size(0, 0.5) == 0
    both = sampling.interleaved(q, o, "x", 0.8).where("used")
    assert both.where("part = 1").count() == 3 and 8 <= both.where("part = 0").count() <= 13
    rows = spark.createDataFrame([(i, "s", i % 2 == 0) for i in range(10)], "line int, source string, ok boolean")
    assert first_written(rows, "line", "ok", 2).count() == 3 and first_written(rows, "line", "ok", 99).count() == 10
    assert {tuple(r) for r in file_counts(rows, "source", "ok").collect()} == {("s", 10, 5, 5), ("all", 10, 5, 5)}


def test_stats(spark):
    df = spark.createDataFrame([("b, a", 1), ("a ,c", 2), (None, 3)], "v string, o int")
    assert [r.token for r in stats.ordered_tokens(df, "v", ["o"]).collect()] == ["b", "a", "c"]
    assert [r.value for r in stats.distinct_values(spark.createDataFrame([(" x",), ("x",), ("",), (None,)], "v string"), "v", 3).collect()] == ["x", "x"]
    assert tuple(stats.number_summary(df.limit(0), "o").first()) == (0, 0, 0.0)


DUMP = "CREATE TABLE t (a INTEGER, b TEXT); INSERT INTO t VALUES (1, 'x'), (2, NULL), (2, 'y');"


def test_sandbox():
    db = sandbox.database(DUMP)
    assert sandbox.execute(db, "SELECT * FROM t") == {"success": True, "row_count": 3, "error": None, "column_names": ["a", "b"]}
    assert sandbox.execute(db, "DELETE FROM t WHERE a = 2")["row_count"] == 2
    assert sandbox.execute(db, "WITH q AS (SELECT 9 AS a) INSERT INTO t SELECT a, 'z' FROM q")["success"]
    assert sandbox.execute(db, "SELECT count(*) FROM t WHERE a = 9")["row_count"] == 1 and db.execute("SELECT count(*) FROM t").fetchone() == (3,)
    assert not sandbox.execute(db, "TRUNCATE t")["success"] and not sandbox.execute(db, "SELECT 1; SELECT 2")["success"]
    assert sandbox.execute(db, "VALUES (1)")["row_count"] == 0 and sandbox.signature(db, " ")["error"]
    endless = "WITH RECURSIVE r(x) AS (SELECT 1 UNION ALL SELECT x + 1 FROM r) SELECT count(*) FROM r"
    assert not sandbox.execute(db, endless, steps=100_000)["success"] and sandbox.execute(db, "SELECT 1")["success"]


def test_evaluation(spark):
    gold = spark.createDataFrame([("1", "d", "SELECT a FROM t WHERE a = 9", 1), ("1", "d", "SELECT a FROM t", 2), ("2", "d", "DROP", 3), ("3", "d", "DELETE FROM t", 4)], "case_id string, db_id string, gold_sql string, source_line int")
    pred = spark.createDataFrame([("A", "1", "SELECT a FROM t ORDER BY a DESC;"), ("A", "2", "SELECT 1"), ("A", "3", "DELETE FROM t"), ("B", "1", "proza"), ("B", "3", "DELETE FROM t WHERE a = 1"), ("B", "2", None)], "variant string, case_id string, pred_sql string")
    out = evaluation.judged(pred, gold, {"d": DUMP})
    got = {(r.variant, r.case_id): r.outcome for r in out.collect()}
    assert got == {("A", "1"): "match", ("A", "2"): "gold_failed", ("A", "3"): "match", ("B", "1"): "bad_prefix", ("B", "3"): "mismatch", ("B", "2"): "gold_failed"}
    m = {r.variant: r for r in evaluation.metrics(out).collect()}
    assert m["A"].match_rate == 1.0 and m["A"].exact_matches == 1 and m["B"].match_rate == 0.0
    rows = evaluation.compared(spark.createDataFrame([("A",), ("C",)], "variant string"), evaluation.metrics(out), evaluation.metrics(out.where("variant = 'B'")), "match_rate")
    assert evaluation.decision(rows, "A") == "left" and evaluation.decision(rows) == "tie" and "-100.00pp" in evaluation.markdown(rows, "l", "r")
    assert evaluation.same_rows(pred, pred.orderBy("case_id")) and not evaluation.same_rows(pred, pred.limit(2))
    attempts = spark.createDataFrame([(["x", "SELECT 1", "SELECT 2"],), (["x", "y"],), ([],)], "a array<string>")
    assert [r.x for r in attempts.select(evaluation.chosen_attempt(F.col("a")).alias("x")).collect()] == ["SELECT 1", "y", None]
    case = spark.createDataFrame([(1, None, "trains", None, "ro", "en", "SELECT 1"), (2, "x", "?", None, "ro", "en", "S"), (3, "y", None, "d", "", "", "S")], "line int, id string, domain string, db_id string, question_ro string, question_en string, sql string")
    assert [tuple(r)[:2] + (r.user_prompt,) for r in evaluation.cases(case, "line", "sys").collect()] == [("line_1", "rail_mers_tren", "ro")]
