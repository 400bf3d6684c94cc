import unicodedata

from tezaur.llm import lost_ends as E


def test_automaton():
    assert E.left_open("(a [b] „c” **d** <b>e</b> <br>") == ["("]
    assert E.left_open("a) b] c” „d” “e”") == []
    assert E.left_open('**unu "doi') == ["**", '"']
    assert E.left_open("<p>x") == ["p"]


def test_ends():
    assert E.end_of("Arată stațiile, cel mult 10 rânduri.", None)["stopped"]
    assert E.end_of("**Arată stațiile?**", None)["stopped"]
    assert not E.end_of("Arată stațiile din Podu Mic Gr.", None)["stopped"]
    assert E.end_of("Arată stațiile din Podu M...", None)["dots"]
    assert E.end_of("Arată stațiile din", None)["bad"] and E.end_of("Arată stațiile,", None)["bad"]
    assert E.end_of("din Podu Lăp", "WHERE n = 'Podu Lăpoveni'")["part"]
    assert E.end_of("din Podu Lăpoveni", "WHERE n = 'Podu Lăpoveni Veche'")["part"]
    assert not E.end_of("din Podu Lăpoveni Veche", "WHERE n = 'Podu Lăpoveni Veche'")["part"]
    assert E.end_of("între 10 și 20", None, "between 10 and 20, at most 5 rows")["missing"]
    assert E.skeleton("numărul") == E.skeleton("numÄƒrul") == E.skeleton("num?rul") == "numrul"


def rows():
    out = []
    for i in range(400):
        end = "." if i % 4 else ""
        out.append(("q", f"a{i}", "good", f"Arată stațiile din județul Arad, cel mult {i} rânduri{end}", None, None))
    for i in range(40):
        out.append(("q", f"l{i}", "limit", f"Arată stațiile din județul Arad {i:02d}, cel mult 10 rânduri deoarece tabelul este"[:60], None, None))
        out.append(("q", f"w{i}", "wire", f"Arată stațiile din județul Arad {i:02d}, cel mult 10 rân", None, None))
    return [*out, ("q", None, None, None, None, None), ("q", "b", "good", "  ", None, None), ("q", "e", "good", "", None, None)]


SCHEMA = "field_name string, record_id string, source string, text string, sibling string, named string"


def test_found_and_rates(spark):
    judged = E.lost_ends(spark.createDataFrame(rows(), SCHEMA))
    lost = {r.record_id for r in judged.where("lost").collect()}
    assert lost == {f"{c}{i}" for c in "lw" for i in range(40)}
    share = {r.source: r.share for r in E.rates(judged).collect()}
    assert share["limit"] == share["wire"] == 1 and share["good"] == 0 and judged.count() == len(rows())


def test_empty(spark):
    assert E.lost_ends(spark.createDataFrame([], SCHEMA)).count() == 0


def test_limits_below_the_longest_text(spark):
    def text(n, i, end=" cel mult 10 rânduri"):
        return (f"Arată {i:02d} " + "gara Arad " * 30)[: n - len(end) - 1] + "a" + end

    # Texts of many lengths, a quarter of them without terminator.
    data = [("q", f"{s}{i}", s, text(45 + i * k // 4, i, " cel mult 10 rânduri" + "." * (i % 4 > 0)), None, None) for s, k in (("limit", 1), ("parts", 2)) for i in range(280)]
    # Whole words up to a limit; texts that letters decomposed afterwards make longer; two limits in one source, with longer texts.
    data += [("q", f"x{i}", "limit", text(120, i), None, None) for i in range(20)] + [("q", "y", "limit", text(131, 0) + ".", None, None)]
    data += [("q", f"d{i}", "limit", unicodedata.normalize("NFD", text(120, i)), None, None) for i in range(3)]
    data += [("q", f"u{n}_{i}", "parts", text(n, i), None, None) for n in (100, 150) for i in range(60)]
    lost = {r.record_id for r in E.lost_ends(spark.createDataFrame(data, SCHEMA)).where("lost").collect()}
    limited = {r[1] for r in data if r[1][0] in "xdu"}
    assert limited <= lost
    # Beside them only texts that end at a limit by chance.
    assert {r[1] for r in data if r[1] in lost - limited} <= {r[1] for r in data if len(r[3]) in (100, 120, 150)}


def test_complete_text_at_a_limit(spark):
    ends = [("scrise în română", "written in Romanian"), ("încărcate târziu", "loaded late"), ("pe o singură pagină", "on a single page")]
    data = [("q", f"a{i}", "free", f"Arată {'gara ' * (i % 30)}cu date {ends[i % 3][0]}{'.' * (i % 4 > 0)}", None, f"Show data {ends[i % 3][1]}.") for i in range(300)]
    data += [("q", f"l{i}", "limit", ("Arată " + "gara " * 30)[:80] + " cu date scrise în română", None, f"Show data {ends[i > 0][1]}.") for i in range(20)]
    lost = {r.record_id for r in E.lost_ends(spark.createDataFrame(data, SCHEMA)).where("lost").collect()}
    assert lost == {f"l{i}" for i in range(1, 20)}


def test_usual_last_word_in_another_context(spark):
    data = [("q", f"a{i}", "s", f"Arată {'gara ' * (i % 30)}cu cel mult {i} rânduri{'.' * (i % 4 > 0)}", None, None) for i in range(300)]
    data += [("q", f"t{i}", "s", f"Arată {'gara ' * (i % 30)}încărcate târziu{'.' * (i % 4 > 0)}", None, None) for i in range(100)]
    data += [("q", f"l{i}", "s", f"Arată {'gara ' * i}ținând cont că unele rânduri", None, None) for i in range(2)]
    data += [("q", "near", "s", "Arată cu cel mult 10 rândrui", None, None), ("q", "plain", "s", "Arata ce a fost incarcate tarziu", None, None), ("q", "part", "s", "Arată ce a fost încărcate târzi", None, None)]
    assert E._near("rndrui", {"rnduri"}) and not E._near("rnduri", {"rnduri"})
    lost = {r.record_id for r in E.lost_ends(spark.createDataFrame(data, SCHEMA)).where("lost").collect()}
    assert lost == {"l0", "l1", "part"}
