import re

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tezaur.functions import temporal
from tezaur.functions import text as T


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r.x for r in df.select("i", f(F.col("c")).alias("x")).orderBy("i").collect()]


def test_normal_and_strip(spark):
    assert column(spark, ["  A\u00a0 b\n", "", None, "\u2003x"], T.normal) == ["a b", "", None, "x"]
    assert column(spark, [" select 1 ;; ", "a ; ;", None], T.normal_statement) == ["select 1", "a ;", ""]


def test_task_keyword(spark):
    assert column(spark, [" Queries ", "operations", None, "x"], T.task) == ["user", "operator", "user", "user"]
    assert column(spark, ["  select_x 1", "1", "", "șters"], T.first_keyword) == ["SELECT_X", "UNKNOWN", "UNKNOWN", "ȘTERS"]
    assert column(spark, ["with x", "vacuum", "selectx", None], T.starts_as_sql) == [True, True, False, False]


def test_extract(spark):
    cases = {"```sql\nSELECT 1\n```": "SELECT 1", "```\nSELECT 1; x\n```": "SELECT 1;", "SQL: SELECT 2": "SELECT 2", "SELECT ';' x": "SELECT ';", "\n\nA\nB": "A", "": "", ";": ";", "proza": "proza"}
    assert column(spark, list(cases), T.extract_statement) == list(cases.values())


def test_input_parts(spark):
    text = "Schema / context SQL:\nCREATE TABLE t (a INT); \n\nQ: \nce e?\nx "
    got = column(spark, [text, "fără", None, "Schema / context SQL:\nx\n\ny", "Schema / context SQL:\nx\ny"], T.input_parts)
    assert tuple(got[0]) == ("CREATE TABLE t (a INT); ", "Q:", "ce e?\nx") and tuple(got[3]) == ("x", "y", "")
    assert got[1] is got[2] is got[4] is None


def plain_repair(text):
    """From the description alone: every reading is repaired first and rated then; a better rating must be strictly better."""

    def quality(t):
        return 3 * sum(map(t.count, T.DIACRITICS)) - 4 * sum(map(t.count, T.SUSPICIOUS)) - 8 * t.count("\ufffd")

    def fixed(t):
        for a, b in T.REPAIRS:
            t = t.replace(a, b)
        return t

    if not any(t in text for t in T.SUSPICIOUS):
        return text
    readings = [text]
    for codec in ("latin-1", "cp1252"):
        try:
            readings.append(text.encode(codec).decode("utf-8"))
        except UnicodeError:
            pass
    best = max([text, *map(fixed, readings)], key=quality)  # max takes the first of equals
    return fixed(best) if quality(fixed(best)) >= quality(best) else best


@settings(max_examples=2, phases=[Phase.generate], deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from(list("ăâîșțÎ a\u00c3\u0192\u0099\u2122\u00aex")), max_size=9), min_size=30, max_size=60))
def test_repair(spark, texts):
    texts = texts + [t.encode().decode("latin-1") for t in texts] + ["È™coală Ã®n", "Bună", "Ã\x83", "Ã®n gara â€“ nord", "stop â€¦ Ã®n"]
    got = column(spark, texts, T.repaired)
    assert [r.text for r in got][-2:] == ["în gara - nord", "stop ... în"]
    assert [r.text for r in got] == [plain_repair(t) for t in texts] and all(r.changed == (r.text != t) for r, t in zip(got, texts))


def test_small(spark):
    assert column(spark, ["12", "12345678901", None], T.padded) == ["0000000012", "12345678901", None]
    assert column(spark, ["a'b", "„x” ‘y’", None], lambda c: T.literal(c, True)) == ["'a''b'", "'\"x\" ''y'''", "NULL"]
    assert column(spark, [" 7 ", "x", None], T.whole_number) == ["7", "NULL", "NULL"]
    assert column(spark, ["a:b:c", "d"], T.reason_bucket) == ["a", "d"]
    assert column(spark, ["Gara Arad", "x"], lambda c: T.first_match(c, [("a", ["ARAD"]), ("g", ["GARA"])], "?")) == ["a", "?"]


def test_times(spark):
    masks = {"127": "Zilnic", "799": "Luni - Vineri", "96": "Sâmbătă - Duminică", "5": "Luni, Miercuri", "0": "Zilnic", "x": "Zilnic", None: "Zilnic", "16767": "Zilnic"}
    assert column(spark, list(masks), temporal.weekdays) == list(masks.values())
    clocks = {"0": "00:00", "59": "00:00", "3600": "01:00", "90000": "01:00", "-60": "23:59", "x": None, None: None, "": None}
    assert column(spark, list(clocks), temporal.clock) == list(clocks.values())
    assert all(v is None or re.fullmatch(r"\d\d:\d\d", v) for v in clocks.values())
