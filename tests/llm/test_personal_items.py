import pytest

from tezaur.llm import personal_items as P

CASES = [
    ("Scrie la ana.pop+x@mail.example.com, mersi", "email", "ana.pop+x@mail.example.com"),
    ("mail: &lt;m.s AT gari dot example&gt;.", "email", "m.s AT gari dot example"),
    ("write f (at) mail [dot] example [dot] com today", "email", "f (at) mail [dot] example [dot] com"),
    ("SUNA C@SCOALA.INVALID", "email", "C@SCOALA.INVALID"),
    ("tel. +40 700 040 849.", "phone", "+40 700 040 849"),
    ("tel (0209) 716380\n", "phone", "(0209) 716380"),
    ("meu: 0040-700-014-357", "phone", "0040-700-014-357"),
    ("Call (555) 555-0136 after", "phone", "(555) 555-0136"),
    ("0209 03 04 03 T", "phone", "0209 03 04 03"),
    ("appelez le 01.99.00.12.34", "phone", "01.99.00.12.34"),
    ("☎ 030/23125-754", "phone", "030/23125-754"),
    ("CNP: 2780310642860.", "identity_number", "2780310642860"),
    ("CNP 5 130128 663900\n", "identity_number", "5 130128 663900"),
    ("number is QQ275991A or QQ 27 59 91 A", "identity_number", "QQ275991A"),
    ("Steuer-ID: 06 336 537 760", "identity_number", "06 336 537 760"),
    ("sécurité sociale : 1 84 32 76 451 089 46", "identity_number", "1 84 32 76 451 089 46"),
    ("Adresa: str. Cărămidarilor, nr. 56, Colțeni", "street_address", "str. Cărămidarilor, nr. 56"),
    ("pe Calea Moților de Sus nr.105A, Vadu", "street_address", "Calea Moților de Sus nr.105A"),
    ("I live at Flat 18, 17 Old Mill Road.", "street_address", "Flat 18, 17 Old Mill Road"),
    ("Adresse : 79 bis, avenue du Vieux Moulin\n", "street_address", "79 bis, avenue du Vieux"),
    ("Ich wohne Alte Mühlstraße 85b.", "street_address", "Alte Mühlstraße 85b"),
]
NONE = [
    "AWB 1586609561637 e blocat", "Cod SIIIR 3906115436", "log: 2025-03-14T08:35:00.6833229382", "Serverul are 192.0.2.66", "Vagonul 50 53 20-05 643-7 era",
    "Comanda 3523-235 nu", "Pe 08.08.2025 08:21", "WHERE email LIKE '%@%'", "@toți am venit", "versiunea 3.10.82", "Strada din fața gării e", "biletul de 1.549,40 lei", "",
]


@pytest.mark.parametrize("text,kind,item", CASES)
def test_shapes(text, kind, item):
    got = [(k, text[a:b]) for k, a, b, *_ in P.proposals(text)[0]]
    assert (kind, item) in [(k, x[: len(item)]) for k, x in got] and all(k == kind for k, _ in got)


def rows():
    given, family = ["Vlad", "Ilinca", "Matei", "Corina"], ["Zăvoiea", "Ghimpescu", "Morăraru", "Tomșinea"]
    out = []
    for i in range(80):
        g, f = given[i % 4], family[i // 4 % 4]
        mail = f"{P.fold(g)}.{P.fold(f)}{i}@mail.example"
        out.append((i, f"Trenul din Valea Mare spre Gara Nord. Podu Veche. colegul meu {g} {f} zice altceva. Scrie la {mail} acum, Lunca Sud Valea Mare."))
    out += [(100, "colegul meu Radu Vășcici zice altceva"), (101, "Mă uit la Valea Mare"), (102, None), (103, ""), (104, out[0][1]), (105, "Domnul Ilinca-Vlad ZĂVOIEA are x")]
    return out


def test_found_and_sanitised(spark):
    data = rows()
    df = spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, key string")
    got = {(r.doc_id, r.pii_type, r.start_at) for r in P.found(df).collect()}
    want = set()
    for i, t in data:
        if t and "@" in t:
            want |= {(i, "name", t.index("meu ") + 5), (i, "email", t.index("la ") + 4)}
    want |= {(100, "name", 13), (105, "name", 8)}
    assert got == want
    texts = {r.doc_id: r.text for r in P.sanitised(df).collect()}
    assert texts[100] == "colegul meu [NAME] zice altceva" and texts[101] == data[81][1] and texts[102] is None and texts[103] == ""
    many = {(r.id, i.pii_type, i.start) for r in P.find_items(df, heavy=1).collect() for i in r["items"]}
    assert many == want  # a repeated text counts as a frequent one
    assert texts[104] == texts[0] and "[EMAIL] acum, Lunca Sud" in texts[0]


def test_shapes_only_propose(spark):
    """Numbers of a phone's or a personal number's shape are items where what stands before them tells so in the corpus."""
    told = [(i, f"Scrie-mi: tel. +40 700 040 {i + 100}, te rog.") for i in range(60)] + [(60 + i, f"tel. 0700 040 {i + 100}") for i in range(20)]
    told += [(100 + i, f"Trenul {i} are {i} locuri, comanda {i}-22.") for i in range(60)]
    none = [(200 + i, t) for i, t in enumerate(NONE)] + [(300 + i, f"AWB 15866095616{i}") for i in range(30, 60)]
    df = spark.createDataFrame([*told, *none], "doc_id long, text string")
    got = {(r.doc_id, r.pii_type) for r in P.found(df).collect()}
    assert got == {(i, "phone") for i in range(80)}


def test_check_digit_and_label(spark):
    texts = ["CNP: 2780310642860", "AWB 2780310642861", "Steuer-ID: 07827615123.", "☎ 07827615123", "mon NIR est le 2 51 13 99 186 728 92"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.pii_type) for r in P.found(df).collect()}
    assert {(0, "identity_number"), (2, "identity_number"), (4, "identity_number")} <= got and not any(i == 1 for i, _ in got) and (3, "identity_number") not in got


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.found(df).count() == 0 and P.sanitised(df).count() == 0
