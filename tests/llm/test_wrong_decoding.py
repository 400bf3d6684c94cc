from tezaur.llm import wrong_decoding as D

CLEAN = "Explică în limba română ce stații și școli, fără județul Brăila"


def rows(spark, texts):
    return spark.createDataFrame([(f"{i:02d}", t, "x") for i, t in enumerate(texts)], "id string, instruction string, form string")


def test_found_and_restored(spark):
    texts = [
        CLEAN,
        D.misread(CLEAN, "cp1252"),
        D.misread(D.misread(CLEAN, "cp1252"), "cp1252"),
        D.misread(CLEAN, "cp1250"),
        D.misread(CLEAN, "cp852"),
        D.written(CLEAN, "iso8859-2", "latin-1"),
        "".join(c if c < "Ā" else "?" for c in CLEAN),
        "rețeaua Øvrelund™, peronul nr. 2º, São Belmiro, 12 €, „Θηλάδι” Kőszörd?",
        "Câte stații?",
        None,
        "",
        "Explică în limba " + D.misread("română", "latin-1") + " ce",
        "la stația � Nord",
    ]
    df = rows(spark, texts)
    got = {r.id: r.restored for r in D.wrongly_decoded(df, "id", ["instruction"], ["instruction"]).collect()}
    assert sorted(got) == ["01", "02", "03", "04", "05", "06", "11", "12"]
    assert all(got[f"{i:02d}"] == CLEAN for i in range(1, 7))
    assert got["11"] == "Explică în limba română ce"
    told = {r.id: r.by_word for r in D.garbled_fields(df, "id", ["instruction"], ["instruction"]).collect()}
    assert sorted(told) == sorted(got) and [k for k in told if not told[k]] == ["12"]


def test_one_letter_words_and_all_chains(spark):
    texts = ["calea Ă la gară, câte două", "calea " + D.misread("Ă", "cp852") + " la", D.misread(D.misread("două", "cp437"), "cp1251"), D.misread(D.written("gară", "cp1250", "latin-1"), "cp1252"), "literele ş și ţ: şi ţară"]
    df = rows(spark, [*texts, "și țară"])
    got = {r.id: r.restored for r in D.wrongly_decoded(df, "id", ["instruction"], ["instruction"]).collect()}
    assert got == {"01": "calea Ă la", "02": "două", "03": "gară"}


def test_unknown_word_by_the_chain(spark):
    df = rows(spark, [CLEAN, D.misread("Explică în limba Zăvoieștița", "cp1252")])
    got = D.wrongly_decoded(df, "id", ["instruction"], ["instruction"]).collect()
    assert [r.restored for r in got] == ["Explică în limba Zăvoieștița"]


def test_empty_and_round_trip(spark):
    df = rows(spark, [])
    assert D.wrongly_decoded(df, "id", ["instruction"], ["instruction"]).count() == 0
    for codec in D.READ_AS:
        assert D.undo(D.misread(CLEAN, codec), codec) == CLEAN
