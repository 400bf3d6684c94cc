from tezaur.llm import layout_copies as L

Q = "Show stops at Gara A, at most 3 rows."
S = "SELECT a.x, COUNT(*) AS n FROM t a WHERE a.y = 'Gr. B' AND a.z > -5 LIMIT 12"
ROWS = [
    ("i03", Q, S),
    ("i01", '  “SHOW stops at gara a; at most 3 rows”', 'select count(*) as n,a."x" from t a where a.[y]=\'gr. b\' and a.`z`>-5\nlimit 12;;\n'),
    ("i02", "> Show\tstops at Gara A – at most 3 rows?", S + " ;"),
    ("i04", Q, S.replace("> -5", "> 5")),
    ("i05", Q, S.replace("> -5", ">= -5")),
    ("i06", Q, S.replace("12", "1,2")),
    ("i07", None, S),
    ("i08", None, S),
    ("i09", "", S),
    ("i10", Q, None),
    ("i11", "At 10:30", "SELECT 1"),
    ("i12", "At 10,30", "SELECT 1"),
]


def test_found_and_counts(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "id string, question_en string, sql string, key string")
    pairs, records = L.layout_copies(df, "id", "question_en", "sql")
    assert sorted(map(tuple, pairs.collect())) == [("i01", "i02"), ("i01", "i03"), ("i07", "i08")]
    counts = dict(map(tuple, records.collect()))
    assert counts["i01"] == 3 and counts["i07"] == 2 and sum(counts.values()) == len(ROWS) and len(counts) == 9


def test_hot_group_and_several_bitmaps(spark):
    rows = [(f"h{i:04d}", Q, S) for i in range(500)] + [(f"s{i:04d}", f"{Q} {i}", S) for i in range(1000)]
    df = spark.createDataFrame(rows, "id string, question_en string, sql string").repartition(7)
    pairs, records = L.layout_copies(df, "id", "question_en", "sql", heavy_at=100)
    assert pairs.count() == 499 and pairs.where("id_a = 'h0000'").count() == 499 and records.count() == 1001
    keyed = L.cut(L.with_key(df, "question_en", "sql"))
    split = L.split_by_bitmap(keyed, most_bits=1 << 16, bits_per_row=160, chunk=50)
    assert split.count() == 1500 and split.where("__maybe").where("question_en = sql or id like 'h%'").count() == 500
    assert split.where("__maybe and id like 's%'").count() < 20
    assert L.split_by_bitmap(keyed).where("__maybe and id like 's%'").count() < 100


def test_empty(spark):
    df = spark.createDataFrame([], "id string, question_en string, sql string")
    pairs, records = L.layout_copies(df, "id", "question_en", "sql")
    assert pairs.count() == 0 and records.count() == 0
