import pytest

from tezaur.llm import broken_pairs as B

ASK = "Scrie o interogare SQL care să întoarcă stațiile din județul Arad, cel mult 12 rânduri."
CONTEXT = "Schema:\nCREATE TABLE stations (station_id INTEGER);\n\nÎntrebare:\nArată stațiile din județul Arad, cel mult 12 rânduri"
SQL = "SELECT s.station_name FROM stations s WHERE s.county = 'Arad' ORDER BY s.station_name LIMIT 12"
TOLD = "Interogarea unește tabelele și păstrează doar rândurile cerute. Rezultatul este ordonat după prima coloană."


@pytest.fixture(scope="module")
def model():
    return B.fit([ASK, "Explica in limba romana ce face interogarea"]), B.fit_stance()


@pytest.mark.parametrize("text", [None, "", " \n", "​", "```sql\n```", ";", "--", "...", "NULL", "N/A", '""', "nimic"])
def test_empty(model, text):
    assert B.judge(ASK, CONTEXT, text, *model)["defect"] == "empty"


@pytest.mark.parametrize("text", ["Scuze, la asta nu răspund.", "I'm sorry, but I cannot help.", "Es tut mir leid, das kann ich nicht.", "Sajnos nem tudok segíteni.", "Ca model de limbaj, nu pot să răspund", "Îmi pare rău, dar nu pot să răspund la această întrebare. " * 8])
def test_refusal(model, text):
    assert B.judge(ASK, CONTEXT, text, *model)["defect"] == "refusal"


@pytest.mark.parametrize("text", [ASK, ASK.upper(), "Răspuns: " + ASK, "-- " + ASK, "Cererea ta, așa cum am înțeles-o eu de la tine: " + ASK, "Arată staţiile din judeţul Arad, cel mult 12 rânduri...", ASK.replace("ă", "a").replace("ț", "t")])
def test_copy(model, text):
    assert B.judge(ASK, CONTEXT, text, *model)["defect"] == "copy"


@pytest.mark.parametrize("text", ["The query joins the tables and keeps only the rows asked for.", "La requête relie les tables et ne garde que les lignes.", "Die Abfrage verbindet die Tabellen.", "La richiesta collega le tabelle.", "A lekérdezés összekapcsolja a táblákat."])
def test_language(model, text):
    assert B.judge(ASK, CONTEXT, text, *model)["defect"] == "language"


@pytest.mark.parametrize(
    "text",
    [SQL, SQL + ";", f"```sql\n{SQL}\n```", f"-- nu pot folosi LIMIT aici\n{SQL}", f"-- {ASK}\n{SQL}", f"Iată interogarea:\n{SQL}", TOLD, "Imi pare rau ca schema e greu de citit, dar iata pe scurt. " + TOLD, B.fold(TOLD), f"Cerința era: „{ASK}”. {TOLD}"],
)
def test_answers(model, text):
    got = B.judge(ASK, CONTEXT, text, *model)
    assert got["defect"] is None and not got["short"]


@pytest.mark.parametrize("text", [SQL[:60], SQL[:-9], SQL[:-1], "```sql\n" + SQL, SQL.split(" ORDER")[0] + " AND ("])
def test_short(model, text):
    assert B.judge(ASK, CONTEXT, text, *model)["short"]


def test_found(spark):
    rows = [(f"g{i}", ASK, CONTEXT, SQL + (";" if i % 2 else "")) for i in range(40)]
    rows += [("t1", ASK, CONTEXT, SQL.replace(" LIMIT 12", "")), ("t2", ASK.replace(", cel mult 12 rânduri", ""), None, SQL[:-13]), ("t3", ASK, CONTEXT, "UPDATE timetables"), ("n", None, None, None), ("x", None, None, SQL)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id string, instruction string, input string, output string, end int")
    got = dict(map(tuple, B.broken_pairs(df, "instruction", "input", "output").collect()))
    assert got == {"t1": "truncated", "t2": "truncated", "t3": "truncated", "n": "empty"}
    assert B.broken_pairs(df.limit(0), "instruction", "input", "output").count() == 0
