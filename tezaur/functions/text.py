"""Column functions on text.  Every function takes and returns Columns and stays in the JVM (but for the two of reports at the end)."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Task names and their canonical form.
TASKS = {"user": "user", "users": "user", "query": "user", "queries": "user", "operator": "operator", "operators": "operator", "operation": "operator", "operations": "operator"}

# Character sequences that betray a wrong decoding, and their repairs in the order they are applied.
SUSPICIOUS = ["Ã", "ÃŽ", "Ã®", "Ã¢", "Ã‚", "Äƒ", "Ä‚", "È™", "È˜", "È›", "Èš", "ÅŸ", "Å£", "Å¢", "â€™", "â€œ", "â€", "â€“", "â€”", "â€¦"]
REPAIRS = [
    ("â€™", "’"), ("â€œ", "“"), ("â€\x9d", "”"), ("â€“", "-"), ("â€”", "-"), ("â€¦", "..."), ("ÃŽ", "Î"), ("Ã®", "î"), ("Äƒ", "ă"), ("Ä‚", "Ă"),
    ("Ã¢", "â"), ("Ã‚", "Â"), ("È™", "ș"), ("È˜", "Ș"), ("È›", "ț"), ("Èš", "Ț"), ("ÅŸ", "ș"), ("Å¢", "Ț"), ("Å£", "ț"),
]
DIACRITICS = "ăâîșțĂÂÎȘȚ"

# How an input names its schema part and its question.
SCHEMA_MARKER = "Schema / context SQL:\n"
QUESTION_LABEL = "Întrebare:"
SQL_STARTS = ["SELECT", "WITH", "INSERT", "UPDATE", "DELETE", "CREATE", "ALTER", "DROP", "REPLACE", "PRAGMA", "EXPLAIN", "VACUUM"]

_BLANK = r"(?U)\s"


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, rf"^{_BLANK}+|{_BLANK}+$", "")


def normal(c: Column) -> Column:
    """Stripped, white space collapsed, lower case."""
    return F.lower(strip(F.regexp_replace(c, rf"{_BLANK}+", " ")))


def normal_statement(c: Column) -> Column:
    """Normal form of a statement for comparison: one trailing run of semicolons is dropped."""
    return F.lower(strip(F.regexp_replace(strip(F.regexp_replace(F.coalesce(c, F.lit("")), rf"{_BLANK}+", " ")), ";+$", "")))


def task(c: Column, default: str = "user") -> Column:
    """Canonical task of an alias; unknown and null ones get the default's."""
    names = F.create_map(*[F.lit(x) for kv in TASKS.items() for x in kv])
    return F.coalesce(F.try_element_at(names, F.lower(strip(F.coalesce(c, F.lit(""))))), F.lit(TASKS.get(default.strip().lower(), "user")))


def first_keyword(c: Column) -> Column:
    """First run of letters and underscores after white space, upper case; UNKNOWN where there is none."""
    word = F.regexp_extract(F.regexp_replace(c, rf"^{_BLANK}+", ""), r"^[\p{L}_]+", 0)
    return F.when(word == "", "UNKNOWN").otherwise(F.upper(word))


def starts_as_sql(c: Column) -> Column:
    return F.upper(F.regexp_extract(strip(F.coalesce(c, F.lit(""))), "^[A-Za-z_]+", 0)).isin(SQL_STARTS)


def extract_statement(c: Column) -> Column:
    """The statement in a model's answer: the first closed code fence, without its language tag and a leading ``sql:``; up to and with the
    first semicolon, else the first line that is not blank."""
    raw = strip(F.coalesce(c, F.lit("")))
    parts = F.split(raw, "```")
    inner = strip(F.get(parts, F.lit(1)))
    tagged = F.when(F.lower(inner).startswith("sql"), strip(F.substring(inner, 4, 1 << 30))).otherwise(inner)
    raw = F.when(F.size(parts) >= 3, tagged).otherwise(raw)
    raw = F.when(F.lower(raw).startswith("sql:"), strip(F.substring(raw, 5, 1 << 30))).otherwise(raw)
    head = strip(F.substring_index(raw, ";", 1))
    line = strip(F.regexp_extract(raw, rf"(?:^|[\n\r])[^\S\n\r]*([^\s][^\n\r]*)", 1))
    return F.when(F.contains(raw, F.lit(";")) & (head != ""), F.concat(head, F.lit(";"))).when(line != "", line).otherwise(raw)


def input_parts(c: Column) -> Column:
    """struct(context, label, question) of an input: what lies between the schema marker and the first blank line, as it is; the next line;
    the rest (empty where that line is the last).  Null without marker or blank line."""
    at = F.instr(c, SCHEMA_MARKER)
    rest = F.when(at > 0, F.substring(c, at + len(SCHEMA_MARKER), F.lit(1 << 30)))
    gap = F.instr(rest, "\n\n")
    tail = F.when(gap > 0, F.substring(rest, gap + 2, F.lit(1 << 30)))
    line = F.instr(tail, "\n")
    whole = F.struct(
        F.substring(rest, F.lit(1), gap - 1).alias("context"),
        strip(F.when(line > 0, F.substring(tail, F.lit(1), line - 1)).otherwise(tail)).alias("label"),
        F.when(line > 0, strip(F.substring(tail, line + 1, F.lit(1 << 30)))).otherwise("").alias("question"),
    )
    return F.when(gap > 0, whole)


def rebuilt_input(context: Column, question: Column) -> Column:
    return F.concat(F.lit(SCHEMA_MARKER), context, F.lit("\n\n"), F.lit(QUESTION_LABEL + "\n"), question)


def count_of(c: Column, part: str) -> Column:
    """How often a string occurs, not overlapping itself."""
    return ((F.char_length(c) - F.char_length(F.replace(c, F.lit(part), F.lit("")))) / len(part)).cast("int")


def is_suspicious(c: Column) -> Column:
    return reduce(Column.__or__, [F.contains(c, F.lit(t)) for t in SUSPICIOUS])


def quality(c: Column) -> Column:
    """Three points for each Romanian letter, minus four for each suspicious sequence and eight for each lost character."""
    good = F.char_length(c) - F.char_length(F.regexp_replace(c, f"[{DIACRITICS}]", ""))
    bad = reduce(Column.__add__, [count_of(c, t) for t in SUSPICIOUS])
    return good * 3 - bad * 4 - count_of(c, "�") * 8


def replaced(c: Column, pairs=REPAIRS) -> Column:
    """Literal replacements, one after the other."""
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


# Characters that cp1252 has at 0x80-0x9F, and these bytes as Latin-1 characters.
_CP1252 = "".join(bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0))
_C1 = "".join(chr(b) for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore"))


def reread(c: Column, codec: str) -> Column:
    """The text's bytes in latin-1 or cp1252, read as UTF-8; null where either step fails."""
    if codec == "cp1252":
        ok = ~c.rlike(r"[\x{80}-\x{9F}]")
        c = F.translate(c, _CP1252, _C1)
    else:
        ok = F.lit(True)
    ok = ok & c.rlike(r"^[\x00-\x{FF}]*$")
    return F.when(ok, F.try_validate_utf8(F.encode(F.when(ok, c).otherwise(F.lit("")), "ISO-8859-1").cast("string")))


def bound(c: Column, f) -> Column:
    """f(c) with c computed once."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def best_reading(c: Column) -> Column:
    """Of the text as it is, and of the text and its two other readings after the replacements, the one of highest quality; the earlier
    wins ties."""
    found = F.array(*[F.struct(x.alias("text")) for x in (c, reread(c, "latin-1"), reread(c, "cp1252"))])
    fixed = F.transform(F.filter(found, lambda x: x["text"].isNotNull()), lambda x: F.struct(replaced(x["text"]).alias("text")))
    rated = F.transform(fixed, lambda x: F.struct(x["text"].alias("text"), quality(x["text"]).alias("q")))
    zero = F.struct(c.alias("text"), quality(c).alias("q"))
    return F.aggregate(rated, zero, lambda a, x: F.when(x["q"] > a["q"], x).otherwise(a), lambda a: a["text"])


def repaired(c: Column) -> Column:
    """struct(text, changed): mojibake repaired where the text has suspicious sequences; a further pass of replacements on the best reading
    is kept where it is no worse."""

    def choose(best: Column) -> Column:
        pair = F.struct(best.alias("best"), replaced(best).alias("fixed"))
        return bound(pair, lambda p: F.when(quality(p["fixed"]) >= quality(p["best"]), p["fixed"]).otherwise(p["best"]))

    out = F.when(~is_suspicious(c), c).otherwise(bound(best_reading(c), choose))
    return bound(out, lambda o: F.struct(o.alias("text"), (o != c).alias("changed")))


def padded(c: Column, width: int = 10) -> Column:
    """Left-padded with zeros, never cut."""
    return F.when(F.char_length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def literal(c: Column, fold_quotes: bool = False) -> Column:
    """SQL literal of a text; NULL for null.  ``fold_quotes`` turns curly quotes into straight ones first."""
    if fold_quotes:
        c = F.translate(c, "“”„‘’", "\"\"\"''")
    return F.coalesce(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))


def quoted_name(c: Column) -> Column:
    """A name as an SQL identifier."""
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def printable(c: Column, plain: bool = True) -> Column:
    """A text for consoles without Unicode: every character beyond ASCII becomes a question mark."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", "?") if plain else c


def whole_number(c: Column) -> Column:
    """SQL number of a text that is one; NULL otherwise."""
    return F.coalesce(strip(c).try_cast("long").cast("string"), F.lit("NULL"))


def reason_bucket(c: Column) -> Column:
    return F.substring_index(c, ":", 1)


def first_match(c: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The name of the first rule one of whose parts occurs in the upper-case text."""
    up = F.upper(c)
    hit = [reduce(Column.__or__, [F.contains(up, F.lit(p)) for p in parts]) for _, parts in rules]
    out = F.when(hit[0], rules[0][0])
    for (name, _), h in zip(rules[1:], hit[1:]):
        out = out.when(h, name)
    return out.otherwise(default)


def _rounded(c: Column, sign: bool) -> Column:
    """Two digits after the point, rounded as the binary number lies (ties to even): the JVM's format rounds its decimal text.  For reports of
    a few rows, so a Python function may do it."""

    def run(numbers: pd.Series) -> pd.Series:
        return numbers.map(lambda x: f"{'+' if sign and x >= 0 else ''}{x:.2f}", na_action="ignore")

    return F.pandas_udf(run, "string")(c)


def percent(c: Column) -> Column:
    return F.concat(_rounded(c * 100, False), F.lit("%"))


def points(c: Column) -> Column:
    """Signed difference in percentage points."""
    return F.concat(_rounded(c * 100, True), F.lit("pp"))
