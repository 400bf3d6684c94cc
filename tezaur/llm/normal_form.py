"""One consistent form for text that looks the same but is spelled with other characters.

Method: texts are cut at ordinary blanks; the distinct tokens that may change are exploded to positioned code points, which are
broadcast-joined with a decomposition table and a look-alike table, combining marks are ordered by class inside each starter's group,
groups are recomposed, and tokens and texts are rebuilt.  Both tables follow from the Unicode character data (a fixed size).

The form: canonical composition; ordinary width; ordinary spaces; no invisible characters; no joined letter pairs; Romanian
comma-below and breve letters; words that mix scripts in Latin letters.  Words of one script, superscripts, typographic
quotes and dashes, letter case, ``\\n`` and ``\\t`` stay; so do conjoining Hangul letters.
"""

from __future__ import annotations

import json
import sys
import unicodedata as U
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut

# Letters of Cyrillic and Greek and the Latin letters they look like.
LOOK_ALIKE = dict(
    zip(
        "АВЕКМНОРСТУХІЈЅҮԌԚԜаеорсухіјѕүһԁԛԝѵгкмтвн" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαεικνορτυχϲϳ",
        "ABEKMHOPCTYXIJSYGQWaeopcyxijsyhdqwvrkmtbh" + "ABEZHIKMNOPTYXaeikvoptuxcj",
    )
)
# Fixed values: (starter, mark as found, mark of the Romanian letter).
ROMANIAN = [(c, "̧", "̦") for c in "sStT"] + [(c, "̌", "̆") for c in "aA"]
SALT = 64
KEPT_BLANKS = "\t\n\x0b\x0c\r\x85   "


@lru_cache(1)
def mapping() -> dict[str, str]:
    """Code point -> what it decomposes to, for every code point that is not its own decomposition ('' for invisible ones)."""
    out = {}
    for n in range(sys.maxunicode + 1):
        if 0xD800 <= n < 0xE000 or 0xAC00 <= n < 0xD7A4:  # surrogates; Hangul syllables stay composed
            continue
        c, kind = chr(n), U.category(chr(n))
        if c in KEPT_BLANKS:
            continue
        tag, _, rest = U.decomposition(c).partition(" ")
        if kind == "Zs":
            out[c] = " "
        elif kind in ("Cf", "Cc") or n in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0x180B <= n <= 0x180F or 0xFE00 <= n <= 0xFE0F or 0xE0100 <= n <= 0xE01EF:
            out[c] = ""
        elif tag in ("<wide>", "<narrow>"):
            out[c] = U.normalize("NFD", "".join(chr(int(x, 16)) for x in rest.split()))
        elif tag == "<compat>" and kind[0] == "L" and len(rest.split()) > 1 and (d := U.normalize("NFKD", c)).isalpha():
            out[c] = d
        elif (d := U.normalize("NFD", c)) != c:
            out[c] = d
    return out


@lru_cache(1)
def compositions() -> dict[str, str]:
    """Starter and mark -> composed letter, for all canonical pairs."""
    out = {}
    for n in range(sys.maxunicode + 1):
        d = U.decomposition(chr(n))
        if d and d[0] != "<" and len(d.split()) == 2:
            pair = "".join(chr(int(x, 16)) for x in d.split())
            if U.normalize("NFC", pair) == chr(n):
                out[pair] = chr(n)
    return out


@lru_cache(1)
def inert_class() -> str:
    """Regex class of code points whose texts are their own consistent form (nothing maps, composes or mixes)."""
    m, ranges = mapping(), []
    romanian = {U.normalize("NFC", a + b) for a, b, _ in ROMANIAN}
    for n in range(0x2E80):
        c = chr(n)
        composed = len(m.get(c, "")) > 1 and U.normalize("NFC", c) == c and U.normalize("NFC", m[c]) == c
        ok = (c not in m or composed) and c not in romanian and not U.combining(c) and U.category(c)[0] != "M" and not (0x370 <= n < 0x530 or 0x1100 <= n < 0x1200 or 0x1F00 <= n < 0x2000)
        if ok and ranges and ranges[-1][1] == n - 1:
            ranges[-1][1] = n
        elif ok:
            ranges.append([n, n])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def _tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    rows = [(c, [(x, U.combining(x)) for x in d] or [("", -1)]) for c, d in mapping().items()]  # -1: invisible, of no group's sequence
    rows += [(chr(n), [(chr(n), U.combining(chr(n)))]) for n in range(0x300, 0x1F000) if U.combining(chr(n)) and chr(n) not in mapping()]
    return (
        spark.createDataFrame(rows, "ch string, parts array<struct<p:string,ccc:int>>"),
        spark.createDataFrame(list(LOOK_ALIKE.items()), "p string, latin string"),
    )


def token_forms(tokens: DataFrame) -> DataFrame:
    """tokens(token) distinct -> (token, form).  Tokens hold no ordinary blank."""
    spark = tokens.sparkSession
    decomposition, look_alike = _tables(spark)
    points = tokens.select("token", F.posexplode(F.regexp_extract_all("token", F.lit("(?s)."), F.lit(0))).alias("pos", "ch"))
    parts = points.join(F.broadcast(decomposition), "ch", "left").select(
        "token", "pos", F.posexplode(F.coalesce("parts", F.array(F.struct(F.col("ch").alias("p"), F.lit(0).alias("ccc"))))).alias("sub", "part")
    )
    parts = parts.select("token", "pos", "sub", "part.p", "part.ccc")
    # Each starter and the marks after it form a group; a token may begin with marks, their group is 0.
    by_place = Window.partitionBy("token").orderBy("pos", "sub")
    parts = parts.withColumn("grp", F.sum((F.col("ccc") == 0).cast("int")).over(by_place))
    groups = parts.groupBy("token", "grp").agg(F.array_sort(F.collect_list(F.struct("ccc", "pos", "sub", "p"))).alias("xs"))
    groups = groups.withColumn("p", F.get(F.filter("xs", lambda x: x["ccc"] == 0), 0)["p"])
    # Words: runs of letters.  A word with Latin letters and letters of another script has the latter replaced.
    by_group = Window.partitionBy("token").orderBy("grp")
    letter = F.coalesce(F.col("p").rlike(r"^\p{L}"), F.lit(False))
    groups = groups.withColumn("letter", letter).withColumn("edge", (F.col("letter") != F.coalesce(F.lag("letter").over(by_group), F.lit(False))).cast("int"))
    groups = groups.withColumn("word", F.sum("edge").over(by_group))
    groups = groups.withColumn("mixed", F.max(F.coalesce(F.col("p").rlike(r"^\p{IsLatin}"), F.lit(False))).over(Window.partitionBy("token", "word")))
    groups = groups.join(F.broadcast(look_alike), "p", "left")
    starter = F.when(F.col("mixed") & F.col("latin").isNotNull(), F.col("latin")).otherwise(F.coalesce("p", F.lit("")))
    groups = groups.withColumn("starter", starter)
    # Romanian marks, then the order of classes again (the marks' classes differ).
    mark = lambda x: x["p"]
    fixed = mark
    for base, old, new in ROMANIAN:
        fixed = lambda x, f=fixed, b=base, o=old, n=new: F.when((F.col("starter") == b) & (x["p"] == o), F.lit(n)).otherwise(f(x))
    ccc = lambda x: F.when(fixed(x) == "̦", F.lit(220)).otherwise(x["ccc"])
    groups = groups.withColumn(
        "marks",
        F.array_sort(F.transform(F.filter("xs", lambda x: x["ccc"] > 0), lambda x: F.struct(ccc(x).alias("ccc"), x["pos"].alias("pos"), x["sub"].alias("sub"), fixed(x).alias("p")))),
    )
    pairs = F.from_json(F.lit(json.dumps(compositions())), "map<string,string>")  # one constant

    def step(acc, x):
        made = F.try_element_at(pairs, F.concat(acc["s"], x["p"]))
        free = (acc["rest"] == "") | (acc["last"] < x["ccc"])
        take = free & made.isNotNull()
        return F.struct(
            F.when(take, made).otherwise(acc["s"]).alias("s"),
            F.when(take, acc["rest"]).otherwise(F.concat(acc["rest"], x["p"])).alias("rest"),
            F.when(take, acc["last"]).otherwise(x["ccc"]).alias("last"),
        )

    zero = F.struct(F.col("starter").alias("s"), F.lit("").alias("rest"), F.lit(0).alias("last"))
    recomposed = F.when(F.size("marks") == 0, F.col("starter")).otherwise(F.aggregate("marks", zero, step, lambda a: F.concat(a["s"], a["rest"])))
    groups = groups.select("token", "grp", recomposed.alias("s"))
    return groups.groupBy("token").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("grp", "s"))), lambda x: x["s"]), "").alias("form"))


def consistent_form(df: DataFrame, text: str, out: str = "form") -> DataFrame:
    """Adds column ``out``: the consistent form of ``text``.

    Null text gives null, empty text empty text; a text of invisible characters only gives empty text.  Rows, repeated rows and other
    columns stay as they are.  Texts of any length are handled whole; an empty table gives an empty table.
    """
    inert = inert_class()
    k, t, tokens, forms = (f"__{x}_{text}" for x in ("k", "t", "tokens", "forms"))
    suspect = F.coalesce(~F.col(text).rlike(f"\\A{inert}*+\\z"), F.lit(False))
    keyed = df.withColumn(k, F.when(suspect, F.md5(F.col(text))))
    some = keyed.where(F.col(k).isNotNull()).select(k, F.col(text).alias(t)).dropDuplicates([k])
    places = cut(some.select(k, F.posexplode(F.split(t, " ")).alias("place", "token")).where(~F.col("token").rlike(f"\\A{inert}*+\\z")))
    changed = cut(token_forms(places.select("token").distinct()).where(F.col("token") != F.col("form")))
    if changed.count() <= 200_000:
        hits = places.join(F.broadcast(changed), "token")
    else:  # a frequent token is spread over ``SALT`` tasks
        salted = changed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        hits = places.withColumn("salt", F.pmod(F.xxhash64(k), F.lit(SALT)).cast("int")).join(salted, ["token", "salt"])
    at = hits.groupBy(k).agg(F.map_from_entries(F.collect_list(F.struct("place", "form"))).alias(forms))
    joined = keyed.join(at, k, "left")
    rebuilt = F.array_join(F.transform(F.split(text, " "), lambda w, i: F.coalesce(F.try_element_at(F.col(forms), i), w)), " ")
    return joined.withColumn(out, F.when(F.col(forms).isNull(), F.col(text)).otherwise(rebuilt)).drop(k, forms)
