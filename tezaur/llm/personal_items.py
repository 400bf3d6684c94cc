"""Personal information in free text, and the text with typed placeholders in its place.

Method: shapes (of mail addresses, numbers, street addresses, pairs of capitalised terms) only propose.  The protected entities are the
items that vouch for themselves: mail addresses with their sign, phone numbers written internationally, personal numbers whose check
digit fits.  Over the whole corpus it is counted how much each feature of a proposal discloses about them, in bits: the term before it
(how often a protected entity follows, against all numbers and mail addresses of the corpus), and its shape (how often it is protected, follows a disclosing
term or shares its post with a protected entity, against all posts).  Proposals beyond the thresholds are items.  Names follow in the
same way: for every capitalised term its share in the local parts of mail addresses against its share of all text gives the bits by
which it discloses a person; left contexts are weighed by how often terms that disclose follow them.  Items are generalised to their type.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

TYPES = ["email", "phone", "identity_number", "street_address", "name"]
_AT = r"(?:@|\s?[\[({]\s?(?:at|AT|arond)\s?[\])}]\s?|\s(?:AT|arond)\s)"
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|DOT|punct)\s?[\])}]\s?|\s(?:dot|DOT|punct)\s)"
EMAIL = re.compile(rf"(?<![\w.+\-])([A-Za-z0-9](?:[\w.+\-]*\w)?){_AT}([A-Za-z0-9][\w\-]*(?:{_DOT}[A-Za-z0-9][\w\-]*)+)")
_SEP = r"[ .\-/ ]?"
PHONE = re.compile(rf"(?<![\w+(.,:/\-])(?:\+[1-9][0-9]{{0,2}}(?:{_SEP}\(?[0-9]{{1,9}}\)?){{1,6}}|00[1-9][0-9](?:{_SEP}[0-9]{{1,9}}){{1,6}}|\(0?[0-9]{{2,5}}\)(?:{_SEP}[0-9]{{2,8}}){{1,4}}|0[1-9](?:[ .\-][0-9]{{2}}){{4}}|0[0-9]{{2,4}}(?:{_SEP}[0-9]{{2,8}}){{1,4}}|[2-9][0-9]{{2}}[ .\-][2-9][0-9]{{2}}[ .\-][0-9]{{4}})(?![0-9])")
CNP = re.compile(r"(?<![\w+.\-/])[1-9](?: ?)[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])(?: ?)[0-9]{6}(?![\w])")
INSURANCE = re.compile(r"(?<!\w)[A-Z]{2} ?[0-9]{2} ?[0-9]{2} ?[0-9]{2} ?[A-D](?!\w)")
TAX_ID = re.compile(r"(?<![\w.\-/+])(?:[0-9]{2} [0-9]{3} [0-9]{3} [0-9]{3}|[0-9]{11})(?!\w)")
# Labels of numbers whose shape others share, for the exact check that follows.
_LABELS = {
    "11": re.compile(r"(?i)(?:steuer\w*|ident\w*|\bID|tin)\b[^0-9\n]{0,25}\Z"),
    "15": re.compile(r"(?i)(?:sociale|sécu\w*|insee|nir)\b[^0-9\n]{0,25}\Z"),
}
SOCIAL = re.compile(r"(?<![\w.\-/])[1-4] ?[0-9]{2} ?[0-9]{2} ?[0-9][0-9AB] ?[0-9]{3} ?[0-9]{3}(?: ?[0-9]{2})?(?!\w)")
SSN = re.compile(r"(?<![\w.\-/])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w\-])")
_UP, _LOW = "A-ZĂÂÎȘȚŞŢÀ-ÖØ-ÞŐŰ", "a-zăâîșțşţß-öø-ÿőű"
_W = rf"[{_UP}][{_UP}{_LOW}'’\-]+"
_N = r"[0-9]{1,4}(?: ?[A-Za-z])?(?![\w:])"
ADDRESSES = [
    # Romanian: kind of street, name, number.
    re.compile(rf"(?<![\w.])(?:(?:(?:ap|bl|sc|et|Ap|Bl|Sc|Et)\. ?\w{{1,4}}, ?)+)?(?:[Ss]tr(?:ada|\.)|STR(?:ADA|\.)|[Bb]d(?:ul)?\.?|[Bb]-dul|[Bb]ulevardul|[Aa]leea|[Cc]alea|[ȘșŞşSs]os(?:\.|eaua)|[Pp]ia[țţt]a|[Ii]ntrarea|[Ss]plaiul|[Ff]und(?:ătura|\.)|[Dd]rumul|[Pp]asajul) (?:(?:de|din|lui|cu|la|și|[0-9]{{1,2}}|{_W}|[A-Z]\.)(?: |(?=,))){{1,5}},? ?(?:[Nn]r\.? ?|[Nn]um[ăa]rul )?{_N}"),
    # English: flat, number, name, kind of street.
    re.compile(rf"(?<![\w.,:/\-])(?:(?:[Ff]lat|[Aa]pt\.?|[Aa]partment|[Uu]nit) [0-9]{{1,4}}[A-Za-z]?, ?)?[0-9]{{1,4}}[A-Za-z]? (?:{_W} ){{1,3}}(?:Lane|Road|Street|Avenue|Close|Drive|Way|Court|Place|Gardens|Terrace|Square|Crescent|Hill|Row|Grove|Walk|Mews|Rd|St|Ave)\b"),
    # French: number, kind of street, name.
    re.compile(rf"(?<![\w.,:/\-])[0-9]{{1,4}}(?: ?(?:bis|ter|quater))?,? (?:[Rr]ue|[Aa]venue|[Bb]oulevard|[Cc]hemin|[Pp]lace|[Ii]mpasse|[Aa]llée|[Qq]uai|[Cc]ours|[Rr]oute|[Pp]assage|[Ss]quare) (?:(?:de la|de l['’]|du|des|de|d['’]|aux?|à la) ?)?{_W}"),
    # German: name with kind of street, number.
    re.compile(rf"(?<![\w.])(?:(?:{_W}|Am|An der|Zur|Zum|Im) )?(?:{_W})?(?:[Ss]traße|[Ss]trasse|[Ss]tr\.|[Ww]eg|[Gg]asse|[Pp]latz|[Aa]llee|[Rr]ing|[Dd]amm|[Uu]fer|[Ss]teig|[Hh]of|[Mm]arkt) [0-9]{{1,4}}(?: ?[a-zA-Z])?(?![\w:.][0-9]|\w)"),
    # After a label: name and number.
    re.compile(rf"(?<=\w: )(?:(?:Am|An|Im|Zur|Zum|Auf|In) (?:der |dem |den )?)?{_W}(?: {_W})? [0-9]{{1,4}}(?: ?[a-z])?(?!\w)"),
]
# Parts one of which every address of the rule has; the label rule has its label.
_KEYS = [
    "str. strada STR Bd bd Bul bul B-dul b-dul Bulevardul bulevardul Aleea aleea Calea calea șos Șos şos Şos sos Sos Piața piața Piata piata Piaţa piaţa Intrarea intrarea Splaiul splaiul Fund fund Drumul drumul Pasajul pasajul Str. Strada".split(),
    [f" {x}" for x in "Lane Road Street Avenue Close Drive Way Court Place Gardens Terrace Square Crescent Hill Row Grove Walk Mews Rd St Ave".split()],
    [f" {y} " for x in "rue avenue boulevard chemin place impasse allée quai cours route passage square".split() for y in (x, x.capitalize())],
    [f"{y} " for x in "traße trasse tr. weg gasse platz allee ring damm ufer steig hof markt".split() for y in (x, x.capitalize())],
]
# Where a mail address spelled out may be.
_AT_KEYS = [f"{x}{y}" for x in "[({" for y in ("at", "AT", "arond", " at", " AT", " arond")] + [f"{x}{y}{z}" for x in " \n\t" for y in ("AT", "arond") for z in " \n\t"]
# Words that open a German sentence and are no part of a street's name.
_GERMAN_LEAD = {"Die", "Der", "Das", "In", "Ich", "Meine"}
NAME = re.compile(rf"(?<![\w@.\-/'])(?=((?:[{_UP}][{_LOW}]+(?:-[{_UP}][{_LOW}]+)*|[{_UP}]\.|[{_UP}]{{3,}}(?:-[{_UP}]{{3,}})?)) ((?:[{_UP}][{_LOW}]+(?:-[{_UP}][{_LOW}]+)*|[{_UP}]{{3,}}(?:-[{_UP}]{{3,}})?))(?![\w@]))")
_CAPITAL = re.compile(rf"(?<![\w@.])[{_UP}][{_UP}{_LOW}]+")
_CONTEXT = re.compile(r"[^\W\d_]+|[^\w\s]|\n")
# Titles, which are no part of a name.
TITLES = set("mr mrs ms miss dr prof sir herr herrn frau monsieur madame mme mlle domnul doamna domnisoara dl dna d-na ing inginer inginerul m".split())




@lru_cache(1)
def _gates():
    """One automaton over the parts of all rules: which rules a text is worth trying."""
    import ahocorasick

    found: dict[str, int] = {}
    for k, parts in enumerate([*_KEYS, [": "], ["@"], _AT_KEYS]):
        for x in parts:
            found[x] = found.get(x, 0) | 1 << k
    trie = ahocorasick.Automaton()
    for x, mask in found.items():
        trie.add_word(x, mask)
    trie.make_automaton()
    return trie


_MAIL, _SPELLED = 1 << len(_KEYS) + 1, 1 << len(_KEYS) + 2


def gates(text: str) -> int:
    out = 0
    for _, mask in _gates().iter(text):
        out |= mask
    return out


_SPAN = re.compile(r"[+(]?[0-9](?:(?:[0-9 .\-/()]|(?<=[0-9])[AB](?=[ 0-9]))*[0-9])?")
_LETTERED = re.compile(r"[A-Z]{2} ?[0-9]{2} ?[0-9]{2}")


def valid_personal(digits: str) -> bool:
    """Whether the last of thirteen digits is the check digit of the others."""
    x = sum(int(a) * int(b) for a, b in zip(digits, "279146358279")) % 11
    return (1 if x == 10 else x) == int(digits[12])


def _term(text: str, at: int) -> str:
    """The term before a place in its line, folded: past one mark the word before it, else the mark."""
    part = text[max(text.rfind("\n", 0, at) + 1, at - 40) : at].rstrip()
    if not part:
        return "^"
    end = len(part)
    if not part[-1].isalnum() and end > 1 and part[-2].isalpha():
        end -= 1
    k = end
    while k and part[k - 1].isalpha():
        k -= 1
    return fold(part[k:end]) if k < end else "#" if part[-1].isalnum() else part[-1]


def proposals(text: str) -> tuple[list[tuple[str, int, int, str, str, bool, bool]], list[str]]:
    """((type, start, end, shape, term before, protected, labelled) of what may be an item of fixed shape, the terms before all numbers).  Of overlapping
    ones the first in the order of TYPES counts."""
    out: list[tuple[str, int, int, str, str, bool, bool]] = []
    before: list[str] = []

    def put(kind: str, a: int, b: int, shape: str, sure: bool, label: bool = False) -> None:
        if all(b <= x[1] or a >= x[2] for x in out):
            out.append((kind, a, b, f"{kind}:{shape}", _term(text, a), sure, label))

    open_ = gates(text)
    if open_ & (_MAIL | _SPELLED):
        for m in EMAIL.finditer(text):
            sign = "@" in m[0]
            put("email", m.start(), m.end(), "@" if sign else "spelled", sign)
    spans = [(m.start(), m.end()) for m in _SPAN.finditer(text)]
    if not spans:
        return out, before
    before = [_term(text, a) for a, _ in spans]
    long = [(a, b) for a, b in spans if b - a > 8 and sum(map(str.isdigit, text[a:b])) > 7]
    for a, b in long:
        for m in CNP.finditer(text, a, min(len(text), b + 1)):
            put("identity_number", m.start(), m.end(), "13", valid_personal(re.sub("[^0-9]", "", m[0])))
    if _LETTERED.search(text):
        for m in INSURANCE.finditer(text):
            put("identity_number", m.start(), m.end(), "letters", False)
    for rule, name in ((SOCIAL, "15"), (TAX_ID, "11"), (SSN, "9")):
        for a, b in long:
            for m in rule.finditer(text, a, min(len(text), b + 1)):
                label = name in _LABELS and bool(_LABELS[name].search(text[max(0, m.start() - 45) : m.start()]))
                if label or name != "11" or m[0][0] != "0" or " " in m[0]:  # elsewhere a zero begins a phone number
                    put("identity_number", m.start(), m.end(), name, False, label)
    for k, rule in enumerate(ADDRESSES):
        if open_ >> k & 1:
            for m in rule.finditer(text):
                a, first = m.start(), m[0].split(" ", 1)
                if first[0] in _GERMAN_LEAD and len(first) == 2:
                    a += len(first[0]) + 1
                # After a label, the label is the shape: it must disclose by itself.
                put("street_address", a, m.end(), f"{k}{_term(text, a) if k == len(ADDRESSES) - 1 else ''}", False)
    for a, b in long:
        for m in PHONE.finditer(text, a, min(len(text), b + 1)):
            digits = sum(map(str.isdigit, m[0]))
            kind = "+" if m[0][0] == "+" else "00" if m[0].startswith("00") else "(" if m[0][0] == "(" else "0" if m[0][0] == "0" else "1"
            least = {"+": 9, "00": 11, "(": 8}.get(kind, 10)
            if least <= digits <= 20 and max(map(len, re.findall("[0-9]+", m[0]))) <= 12:
                put("phone", m.start(), m.end(), kind, kind == "+")
    return out, before


def _mail_terms(address: str) -> list[str]:
    local = re.split(r"@|\s?[\[({]|\s(?:AT|arond)\s", fold(address), maxsplit=1, flags=re.IGNORECASE)[0].split("+")[0]
    parts = [p for p in re.split(r"[._\-0-9]+", local) if len(p) > 2]
    return [f"{k}:{p}" for p in parts for k in "gf"] + ([f"f:{parts[0][1:]}"] if len(parts) == 1 and len(parts[0]) > 5 else [])


def _read(text: str) -> tuple[list[tuple], list[tuple], list[str]]:
    """(proposals, name candidates (start, size, first, second, left context or None where it may begin before the text, shouted), what counts)."""
    items, before = proposals(text)
    told = [f"x:{t}" for t in before] + [f"x:{x[4]}" for x in items if x[0] == "email"]
    for kind, a, b, *_ in items:
        if kind == "email":
            told += _mail_terms(text[a:b])
    names = []
    for m in NAME.finditer(text):
        a, b = m.start(1), m.end(2)
        first = fold(m[1])
        if first.rstrip(".") not in _NO_NAMES:
            names.append((a, b - a, first, fold(m[2]), _left(text, a), m[2].isupper()))
    told += [f"w:{fold(w)}" for w in _CAPITAL.findall(text)]
    return items, names, told


def _left(text: str, at: int, whole: bool = False) -> str | None:
    """The two terms, marks or line ends before a place; None where there are fewer and the text is not the whole one."""
    left = _CONTEXT.findall(text[max(0, at - 24) : at].replace("\r", ""))[-2:]
    if len(left) < 2 and not whole:
        return None
    return " ".join([x.lower() for x in left]).replace("\n", "/") or "^"


class Reader:
    """Reads texts line by line; lines met before (quotes, signatures) are read once.  Texts with a mail address spelled out, which may
    run over a line's end, are read in one piece."""

    def __init__(self, keep: int = 50_000) -> None:
        self.keep, self.known = keep, {}

    def __call__(self, text: str, told: Counter) -> tuple[list[tuple], list[tuple]]:
        """(proposals of fixed shape, name candidates with their left context).  What is counted over the corpus goes to ``told``: w: capitalised
        terms, g: and f: terms of mail addresses (given, family), x: terms before numbers and mail addresses, posts and those with a
        protected entity."""
        items, names, at = [], [], 0
        for line in [text] if gates(text) & _SPELLED else text.split("\n"):
            if line:
                got = self.known.get(line)
                if got is None:
                    if len(self.known) >= self.keep:
                        self.known.clear()
                    got = self.known[line] = _read(line)
                told.update(got[2])
                items += [(k, at + a, at + b, *rest) for k, a, b, *rest in got[0]]
                names += [(at + a + 1, n, first, second, _left(text, at + a, True) if left is None else left, shouted) for a, n, first, second, left, shouted in got[1]]
            at += len(line) + 1
        sure = [x[5] for x in items]
        told["posts"] += 1
        told["protected"] += any(sure)
        # Whether another proposal of the post is a protected entity.
        others = [sum(sure) > y for y in sure]
        return [(k, a + 1, b - a, s, f"x:{t}", y, o, z) for (k, a, b, s, t, y, z), o in zip(items, others)], names


_NO_NAMES = TITLES - {"m", "d"}
ITEM = "struct<pii_type:string,start:int,size:int,shape:string,term:string,sure:boolean,near:boolean,label:boolean>"
SCHEMA = f"key binary, copies long, items array<{ITEM}>, names array<struct<start:int,size:int,first:string,second:string,left:string,shouted:boolean>>, t string, n long"


class _Folded(dict):
    """Text -> folded text; begun anew when full."""

    def __missing__(self, text: str) -> str:
        if len(self) > 200_000:
            self.clear()
        self[text] = x = text.lower() if text.isascii() else "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
        return x


_FOLDED = _Folded()


def fold(text: str) -> str:
    return _FOLDED[text]


def _readings(docs: DataFrame) -> DataFrame:
    """docs(key, text, copies) -> (key, copies, items, names) of each text, and (t, n): partial sums of what is counted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = Reader()
        for pdf in batches:
            told: Counter = Counter()
            rows = [(key, copies, *read(text, told), None, None) for key, text, copies in zip(pdf["key"], pdf["text"], pdf["copies"])]
            rows += [(None, None, None, None, t, n) for t, n in told.items()]
            yield pd.DataFrame(rows, columns=["key", "copies", "items", "names", "t", "n"]).astype({"copies": "Int64", "n": "Int64"})

    return docs.select("key", "text", "copies").mapInPandas(run, SCHEMA)


def given_key(first):
    return F.concat(F.lit("g:"), F.substring_index(first, "-", 1))


def family_key(second):
    return F.concat(F.lit("f:"), F.substring_index(second, "-", 1))


def shape_disclosure(readings: DataFrame, counted: DataFrame, bits: float, shape_bits: float) -> DataFrame:
    """(key, bits) of terms before numbers (x:) and of shapes that disclose a protected entity."""
    sums = {r.t: r.n for r in counted.where(F.col("t").isin("posts", "protected")).collect()}
    share = max(sums.get("protected") or 0, 1) / max(sums.get("posts") or 0, 1)
    numbers = counted.where(F.col("t").startswith("x:")).select(F.col("t").alias("term"), "n")
    items = readings.where("key is not null").select(F.explode("items").alias("i")).select("i.*")
    items = items.groupBy("pii_type", "shape", "term", "sure", "near").agg(F.count("*").alias("n"))
    protected = items.where("sure").groupBy("term").agg(F.sum("n").alias("k"))
    all_n, all_k = (x.first()[0] or 1 for x in (numbers.agg(F.sum("n")), protected.agg(F.sum("k"))))
    terms = protected.join(numbers, "term").select("term", F.log2((F.col("k") / all_k) / (F.col("n") / all_n)).alias("bits")).where(F.col("bits") >= bits)
    told = items.join(terms.select("term", F.lit(True).alias("tells")), "term", "left")
    vouched = F.col("sure") | F.col("near") | F.coalesce(F.col("tells") & (F.col("pii_type") != "street_address"), F.lit(False))
    shapes = told.groupBy("shape").agg(F.sum("n").alias("n"), F.sum(F.when(vouched, F.col("n")).otherwise(0)).alias("k"))
    shapes = shapes.select(F.col("shape").alias("key"), F.log2(F.col("k") / F.col("n") / share).alias("bits")).where(F.col("bits") >= shape_bits)
    return terms.select(F.col("term").alias("key"), "bits").unionByName(shapes)


def disclosure(readings: DataFrame, counted: DataFrame, bits: float, context_share: float, context_count: int) -> DataFrame:
    """(key, bits): terms (g: given, f: family) and left contexts (c:) that disclose a person by at least ``bits``."""
    terms = counted.where(F.col("t").startswith("w:")).select(F.substring("t", 3, 1 << 20).alias("t"), "n")
    mail = counted.where(F.col("t").startswith("g:") | F.col("t").startswith("f:")).select(F.col("t").alias("k"), F.col("n").alias("m"))
    all_n, all_m = (x.first()[0] or 1 for x in (terms.agg(F.sum("n")), mail.agg(F.sum("m"))))
    both = mail.withColumn("t", F.substring("k", 3, 1 << 20)).join(terms, "t")
    weighed = both.select(F.col("k").alias("key"), "t", F.log2((F.col("m") / all_m) / (F.col("n") / all_n)).alias("bits"))
    # A term is a given name where it comes first in pairs more often than second, otherwise a family name.  Pairs are counted once, by both
    # terms and context.
    pairs = readings.where("key is not null").select(F.explode("names").alias("x")).groupBy("x.first", "x.second", "x.left").agg(F.count("*").alias("n"))
    ends = pairs.select("n", F.explode(F.array(F.struct(F.substring(given_key(F.col("first")), 3, 1 << 20).alias("t"), F.lit(1).alias("d")), F.struct(F.substring(family_key(F.col("second")), 3, 1 << 20).alias("t"), F.lit(-1).alias("d")))).alias("e"))
    lean = ends.groupBy("e.t").agg(F.sum(F.col("e.d") * F.col("n")).alias("lean"))
    fits = F.coalesce("lean", F.lit(0)) * F.when(F.col("key").startswith("g:"), 1).otherwise(-1) >= 0
    known = cut(weighed.where(F.col("bits") >= bits).join(lean, "t", "left").where(fits).select("key", "bits"))
    per = pairs.groupBy(given_key(F.col("first")).alias("key"), F.concat(F.lit("c:"), F.col("left")).alias("c")).agg(F.sum("n").alias("n")).join(known, "key", "left")
    contexts = per.groupBy("c").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("bits").isNotNull(), F.col("n")).otherwise(0)).alias("k"))
    contexts = contexts.where((F.col("n") >= context_count) & (F.col("k") >= context_share * F.col("n")))
    return known.unionByName(contexts.select(F.col("c").alias("key"), (F.col("k") / F.col("n")).alias("bits")))


def find_items(df: DataFrame, id_col: str = "doc_id", text: str = "text", bits: float = 1.5, shape_bits: float = 0.5, context_share: float = 0.8, context_count: int = 3, heavy: int = 100_000) -> DataFrame:
    """(id, items array<struct<pii_type, start, size>>) of every row, starts counted in characters from 1.

    Null and empty texts have no items.  Equal texts are read once.  ``bits`` is the disclosure threshold of terms, ``shape_bits`` that of
    shapes; a left context counts where terms beyond it follow in ``context_share`` of at least ``context_count`` cases.
    """
    keyed = df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).withColumn("key", F.when(F.length("text") > 0, F.unhex(F.md5("text"))))
    texts = keyed.where("key is not null").groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    readings = cut(_readings(texts))
    counted = cut(readings.where("t is not null").groupBy("t").agg(F.sum("n").alias("n")))
    known = cut(disclosure(readings, counted, bits, context_share, context_count).unionByName(shape_disclosure(readings, counted, bits, shape_bits)))
    some = readings.where("key is not null and (size(names) > 0 or size(items) > 0)").select("key", "copies", "items", "names")
    of_name = lambda x: F.array(given_key(x["first"]), family_key(x["second"]), given_key(x["second"]), F.concat(F.lit("c:"), x["left"]))
    asked = F.array_distinct(F.concat(F.flatten(F.transform("names", of_name)), F.transform("items", lambda x: x["shape"]), F.transform("items", lambda x: x["term"])))
    n = known.count()
    if n <= 500_000:
        # Few terms disclose: their list goes to every task.
        everything = df.sparkSession.sparkContext.broadcast(frozenset(r.key for r in known.select("key").toLocalIterator()))
        joined = some.withColumn("known", F.lit(None).cast("array<string>"))
    else:
        everything = None
        told = some.select("key", F.explode(asked).alias("k")).join(known.select(F.col("key").alias("k")), "k").groupBy("key").agg(F.collect_set("k").alias("known"))
        joined = some.join(told, "key", "left")

    def choose(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for items, names, known in batches:
            yield pd.Series([_chosen(i, n, everything.value if everything else frozenset(k if k is not None else ())) for i, n, k in zip(items, names, known)], dtype=object)

    full = cut(joined.select("key", "copies", F.pandas_udf(choose, "array<struct<pii_type:string,start:int,size:int>>")("items", "names", "known").alias("items")))
    # Texts that more than ``heavy`` rows repeat (at most rows / heavy of them) are joined by broadcast; their rows then go by a key of
    # their own, so no task gets all of one.
    hot = full.where(F.col("copies") > heavy).select("key", F.col("items").alias("__hot"))
    cold = full.where((F.col("copies") <= heavy) & (F.size("items") > 0)).select(F.col("key").alias("__k"), "items")
    own = F.unhex(F.md5(F.concat(F.lit("own "), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    marked = keyed.join(F.broadcast(hot), "key", "left").withColumn("__k", F.when(F.col("__hot").isNull() & F.col("key").isNotNull(), F.col("key")).otherwise(own))
    return marked.join(cold, "__k", "left").select("id", "text", F.coalesce("__hot", "items", F.array().cast("array<struct<pii_type:string,start:int,size:int>>")).alias("items"))


def _chosen(items, names, known: frozenset[str]) -> list[dict]:
    out = []
    for i in items:
        # Exact checks follow: the label of a number, and for thirteen digits the check digit or the term before them.
        told = i["sure"] or i["label"] or i["term"] in known and i["pii_type"] != "street_address" or i["shape"] in known and i["shape"] != "identity_number:13"
        if told:
            out.append({"pii_type": i["pii_type"], "start": int(i["start"]), "size": int(i["size"])})
    by_start = {int(n["start"]): n for n in names}
    taken, reach = [(x["start"], x["start"] + x["size"]) for x in out], 0
    for a in sorted(by_start):
        n = by_start[a]
        b = a + int(n["size"])
        if a < reach or any(a < y and b > x for x, y in taken):
            continue
        first, second = n["first"], n["second"]
        given = not first.endswith(".") and f"g:{first.split('-')[0]}" in known
        family = f"f:{second.split('-')[0]}" in known
        context = f"c:{n['left']}" in known
        # The second term begins a name of its own: the first is a title or closes the text before.
        later = by_start.get(a + len(first) + 1)
        if later is not None and not given and f"g:{second.split('-')[0]}" in known:
            continue
        if given or family or context and not n["shouted"]:
            out.append({"pii_type": "name", "start": a, "size": int(n["size"])})
            reach = b
    return out


def found(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, pii_type, start_at), one row for every occurrence."""
    x = find_items(df, id_col, text).select(F.col("id").alias("doc_id"), F.explode("items").alias("i"))
    return x.select("doc_id", F.col("i.pii_type").alias("pii_type"), F.col("i.start").alias("start_at"))


def sanitised(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with a typed placeholder in place of each item and the rest unchanged; null and empty texts stay."""

    def replace(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, items in batches:
            out = []
            for t, xs in zip(texts, items):
                for i in sorted(xs if t else [], key=lambda i: -i["start"]):
                    t = f"{t[: i['start'] - 1]}[{i['pii_type'].upper()}]{t[i['start'] - 1 + i['size'] :]}"
                out.append(t)
            yield pd.Series(out, dtype=object)

    return find_items(df, id_col, text).select(F.col("id").alias("doc_id"), F.pandas_udf(replace, "string")("text", "items").alias("text"))
