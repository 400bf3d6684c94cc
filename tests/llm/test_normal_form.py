import unicodedata as U

import regex
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tezaur.llm import normal_form as N


def plain(text):
    """The same form, one character after another."""
    m = N.mapping()
    out = []
    d = "".join(m.get(c, c) for c in text)
    words = regex.findall(r"(?:\p{L}\p{M}*)+|[^\p{L}]", d, flags=regex.V1)
    for w in words:
        if regex.search(r"\p{Latin}", w):
            w = "".join(N.LOOK_ALIKE.get(c, c) for c in w)
        for base, old, new in N.ROMANIAN:
            while (fixed := regex.sub(rf"{base}(\p{{M}}*){old}", rf"{base}\1{new}", w)) != w:
                w = fixed
        out.append(w)
    return U.normalize("NFC", "".join(out))


def forms(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.form for r in N.consistent_form(df, "text").orderBy("i").collect()]


def test_cases(spark):
    cases = {
        "Valea Vlăovețu": "Valea Vlăovețu",
        "Gura Teşăşeţu Ţintă": "Gura Teșășețu Țintă",
        "Ｌｕｎｃａ　Ｆａ̂ｎ": "Lunca Fân",
        "Nucigotu Bǎi": "Nucigotu Băi",
        "Vale﻿a Vâlu‍dean": "Valea Vâludean",
        "Μăgurа Сetate": "Măgura Cetate",
        "Gara / Жълтица Γωνιάδα": "Gara / Жълтица Γωνιάδα",
        "Identiﬁcă aﬂate": "Identifică aflate",
        "m² „scris” – și…\n\tnou": "m² „scris” – și…\n\tnou",
        "Teşu": "Teșu",
        "şa": "șa",
        "": "",
        "​⁠": "",
    }
    assert forms(spark, list(cases) + [None]) == [*cases.values(), None]


def test_columns_copies_and_empty(spark):
    df = spark.createDataFrame([("ﬁ", "a", 1), ("ﬁ", "a", 1), (None, "b", 2)], "text string, token string, grp int")
    got = N.consistent_form(df, "text")
    assert got.columns == ["text", "token", "grp", "form"]
    assert sorted(map(str, (r.form for r in got.collect()))) == ["None", "fi", "fi"]
    assert N.consistent_form(df.limit(0), "text").count() == 0


def test_long_text(spark):
    long = "ş" * 20000 + " a" * 20000
    assert forms(spark, [long]) == ["ș" * 20000 + " a" * 20000]


@settings(max_examples=3, phases=[Phase.generate], deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from(list("aAsStTxĂțş ǎéο̧̣̦̆̂̌ ​ﬁＡа/1.кЖ\n")), max_size=12), min_size=20, max_size=60))
def test_against_plain(spark, texts):
    assert forms(spark, texts) == [plain(t) for t in texts]
