"""Texts whose end was lost, by a limit of their source or in transfer.

Method: a stack automaton walks over the marks of each text and tells what is left open at its end (quotes, brackets, markup), broken
multibyte sequences and escapes, and whether a terminator closes the text.  How often complete texts lack the terminator is the
source's baseline: it is measured on the ends (last words) that terminated texts share.  A text without terminator is cut where its end
occurs more often without than the baseline explains, where its last word is a part of a word, or where values that the record's other
fields name are missing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .normal_form import LOOK_ALIKE

PAIRS = {"(": ")", "[": "]", "{": "}", "„": "”", "“": "”", "«": "»"}
CLOSERS = {c: o for o, c in PAIRS.items()}
_MARK = re.compile(r"\*\*|__|```|[()\[\]{}”»\"`]|(?<![^\s(\[*\"])[„“«]|“|<(/?)([a-zA-Z]\w*)[^<>]*>")
_CLOSING = re.compile(r"[\s\"'“”’»)\]}*_`̀-ͯ​-‏⁠﻿\xad]+\Z")
_BROKEN = re.compile(r"(?:\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?)?|&#?\w{0,8}|%[0-9A-Fa-f]?|<[^<>]{0,40})\Z")
_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~„“”‘’«»…–—"
_VALUE = re.compile(r"[0-9]+(?::[0-9]+)?")
_LATIN = re.compile(r"[A-Za-z]")
_LOOKS = str.maketrans(LOOK_ALIKE)
# Short forms with a stop that end names, and words that never close a sentence.
SHORT = {"gr", "hm", "hc", "ram", "nr", "str", "ap", "bl", "sc", "et", "jud", "loc"}
OPEN_WORDS = set("și si sau de la din pe cu în in între intre ale al că ca să sa dar care cel cei cele peste sub după dupa până pana fără fara prin spre dintre iar unde cu".split())


def clean_word(word: str) -> str:
    """Composed, of ordinary width, without invisible characters, look-alikes in Latin letters, without marks at its edges."""
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKC", word) if unicodedata.category(c) != "Cf")
        if _LATIN.search(word):
            word = word.translate(_LOOKS)
    return word.strip(_EDGE)


def skeleton(word: str) -> str:
    """What is left of a word in lower case when every character that a wrong decoding or missing accents may change is gone."""
    w = word.lower()
    if not w.isascii():
        w = w.encode("ascii", "ignore").decode()
    return re.sub(r"[0-9]+", "#", w.replace("?", ""))


def left_open(text: str) -> list[str]:
    """What the automaton has on its stack at the end of the text.  Marks that may stand alone (a closer without opener) are passed over."""
    stack: list[str] = []
    for m in _MARK.finditer(text):
        t = m[0]
        if m[2]:
            name = m[2].lower()
            if m[1]:
                if name in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(name) :]
            elif name not in ("br", "hr", "img") and not t.endswith("/>"):
                stack.append(name)
        elif t in ("**", "__", "```", '"', "`"):
            if t in stack:
                del stack[stack.index(t) :]
            else:
                stack.append(t)
        elif t in PAIRS and not (t == "“" and "„" in stack):
            stack.append(t)
        else:
            openers = {"”": ("„", "“"), "“": ("„",)}.get(t, (CLOSERS.get(t),))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] in openers:
                    del stack[k:]
                    break
    return stack


def end_of(text: str, sibling: str | None, values: str | None = None) -> dict:
    """Features of a text's end.  ``sibling`` is text of the same record that names the same things, ``values`` the part of it whose
    numbers a complete text names too."""
    tail = text.rstrip()
    core = _CLOSING.sub("", tail)
    raw = last_words(core)
    words = [clean_word(w) for w in raw]
    last = words[-1].lower() if words else ""
    dots = core.endswith(("...", "…")) or core.endswith("..") and last not in SHORT
    stop = core[-1:] in (".", "?", "!", ";") and not dots
    if stop and core.endswith(".") and not core.endswith("..") and last in SHORT:
        stop = False
    if stop:
        return {"stopped": True, "dots": False, "bad": False, "end": _end(words), "last": skeleton(words[-1]) if words else "", "part": False, "weak": False, "missing": False}
    out = {
        "stopped": False,
        "dots": dots,
        "bad": bool(left_open(tail) or _BROKEN.search(tail) or tail.endswith("�") and tail.count("�") == 1 or not dots and core.endswith((",", ":", "–", "-", "(", "/", "=")) or last in OPEN_WORDS),
        "end": _end(words),
        "last": skeleton(words[-1]) if words else "",
        "part": False,
        "weak": False,
        "missing": False,
    }
    if sibling and words:
        others = {clean_word(w).lower() for w in sibling.split()}
        starts = last not in others and any(w.startswith(last) for w in others)
        if starts:
            out["part" if words[-1][:1].isupper() or words[-1][:1].isdigit() else "weak"] = True
        elif words[-1][:1].isupper() and "'" in sibling:
            # A name that goes on wherever the record's SQL has it.
            name = re.escape(" ".join(raw[-2:] if len(raw) > 1 and raw[-2][:1].isupper() else raw[-1:]).strip(_EDGE))
            found = re.findall(rf"'(?:[^']* )?{name}\.?( [^']+)?'", sibling)
            out["part"] = bool(found) and all(found)
    if values is not None:
        mine = _VALUE.findall(unicodedata.normalize("NFKC", text))
        wanted = _VALUE.findall(values)
        out["missing"] = len(mine) < len(wanted) and any(v not in mine for v in wanted)
    return out


def last_words(core: str, n: int = 6) -> list[str]:
    """The last ``n`` tokens that are more than marks, whole ones however long, in order."""
    out: list[str] = []
    parts = core.rsplit(None, 1)
    while parts and len(out) < n:
        if clean_word(parts[-1]):
            out.append(parts[-1])
        parts = parts[0].rsplit(None, 1) if len(parts) == 2 else []
    return out[::-1]


def _end(words: list[str]) -> str:
    """The last words as a context; a name at the end counts as one word N."""
    k = len(words)
    while k and (words[k - 1][:1].isupper() and not words[k - 1].isupper() or len(words) > k and words[k - 1] == "de" or words[k - 1] in ("A", "B", "C")):
        k -= 1
    if k < len(words) and k < 1 or len(words) - k > 4:
        k = len(words)
    return " ".join([*(skeleton(w) for w in words[max(0, k - 2) : k]), *["N"] * (k < len(words))])


SCHEMA = "stopped boolean, dots boolean, bad boolean, end string, last string, part boolean, weak boolean, missing boolean"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
_ACCENTED = re.compile("[aist]")
# Lengths that a limit may count, of the text as it is and of the composed one (letters decomposed after the cut make it longer).
UNITS = ["chars", "bytes", "composed_chars", "composed_bytes"]


def question_of(context: str) -> Column:
    """The part of an input after its context: question, and SQL where one follows."""
    return F.coalesce(F.expr(f"if(instr({context}, '\\n\\n') > 0, substring({context}, instr({context}, '\\n\\n') + 2), {context})"), F.lit(""))


def with_ends(df: DataFrame) -> DataFrame:
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, siblings, named in batches:
            rows = [(end_of(t, s, v) if t and t.strip() else dict.fromkeys(NAMES)) | lengths_of(t) | {"other": _end([clean_word(w) for w in last_words(_CLOSING.sub("", v.rstrip()))]) if v else ""} for t, s, v in zip(texts, siblings, named)]
            yield pd.DataFrame(rows, columns=[*NAMES, *UNITS, "other"]).astype(dict.fromkeys(UNITS, "Int64"))

    return df.withColumn("e", F.pandas_udf(run, ", ".join([SCHEMA, *[f"{u} int" for u in UNITS], "other string"]))("text", "sibling", "named"))


def lengths_of(text: str | None) -> dict:
    composed = None if text is None else unicodedata.normalize("NFC", text)
    return dict(zip(UNITS, [n for t in (text, composed) for n in ((None, None) if t is None else (len(t), len(t.encode())))]))


def source_limits(lengths: DataFrame) -> DataFrame:
    """lengths(field_name, source, unit, n, texts, open) -> (field_name, source, unit, most): limits of a source, the lengths where its texts
    pile up.  ``open`` counts the texts without terminator.  A pile has at least five texts, three times what the twenty lengths below have
    on average, and three times what the twenty lengths above have together (few texts grew after the cut); or, where a limit held for a
    part of the source only, at least ten open texts, ten times the average of the open ones on either side, and three times the terminated
    texts that are longer by the terminator (else texts of one make pile up)."""
    own = Window.partitionBy("field_name", "source", "unit").orderBy("n")
    near = lambda c, a, b: F.coalesce(F.sum(c).over(own.rangeBetween(a, b)), F.lit(0))
    sides = lengths.select("*", *[near(c, a, b).alias(f"{c}_{side}") for c in ("texts", "open") for side, a, b in (("below", -20, -1), ("above", 1, 20))])
    sides = sides.withColumn("closed", near(F.col("texts") - F.col("open"), 1, 1))
    last = (F.col("texts") >= 5) & (F.col("texts") * 20 > F.col("texts_below") * 3) & (F.col("texts") > F.col("texts_above") * 3)
    part = (F.col("open") >= 10) & (F.col("open") * 2 > F.greatest("open_below", "open_above")) & (F.col("open") > F.col("closed") * 3)
    return sides.where(last | part).select("field_name", "source", "unit", F.col("n").alias("most"))


def lost_ends(df: DataFrame, usual: float = 0.001, unusual: float = 0.008, slack: float = 12.0, heavy: int = 100_000) -> DataFrame:
    """df(field_name, record_id, source, text, sibling, named) -> (field_name, record_id, source, lost).

    ``usual``: share of a field's terminated texts that makes an end a usual one outright; ``unusual``: share of its texts without
    terminator that does so where terminated texts never have it.  Null and blank texts are complete.  Rows come out as they came in,
    repeated ones repeatedly.
    """
    e = cut(with_ends(df).select("field_name", "record_id", "source", "e.*"))
    sizes = e.where("chars is not null").select("field_name", "source", "stopped", F.explode(F.array(*[F.struct(F.lit(u).alias("unit"), F.col(u).alias("n")) for u in UNITS])).alias("x"))
    lengths = sizes.groupBy("field_name", "source", "x.unit", "x.n").agg(F.count("*").alias("texts"), F.count_if(~F.col("stopped")).alias("open"))
    limits = source_limits(lengths).groupBy("field_name", "source").agg(*[F.collect_set(F.when(F.col("unit") == u, F.col("most"))).alias(f"most_{u}") for u in UNITS])
    whole = ~F.col("missing") & ~F.col("part") & ~F.col("bad")
    by_source = cut(e.where("stopped is not null").groupBy("field_name", "source", "end").agg(F.max("last").alias("last"), F.count_if("stopped").alias("with_stop"), F.count_if(~F.col("stopped") & whole).alias("without")))
    ends = by_source.groupBy("field_name", "end").agg(F.max("last").alias("last"), F.sum("with_stop").alias("with_stop"), F.sum("without").alias("without"))
    totals = ends.groupBy("field_name").agg(F.sum("with_stop").alias("all_with"), F.sum("without").alias("all_without"))
    ends = ends.join(F.broadcast(totals), "field_name")
    # Ends that many texts share: at most 1 / usual for each field.
    strong = (F.col("with_stop") >= F.greatest(F.lit(2), F.col("all_with") * usual)) | (F.col("without") >= F.greatest(F.lit(3), F.col("all_without") * unusual))
    known, accented = {}, {}
    strong_ends = ends.where(strong).select("field_name", "end").distinct().collect()
    for r in strong_ends:
        for context, word in _gaps(r.end):
            known.setdefault((r.field_name, *context), set()).add(word)
        accented.setdefault((r.field_name, _ACCENTED.sub("", r.end)), set()).add(r.end)

    def spelled(fields: pd.Series, found: pd.Series) -> pd.Series:
        near = lambda f, end: any(_near(w, known.get((f, *c), ())) for c, w in _gaps(end))
        return pd.Series([near(f, end) or any(_without_accents(end, k) for k in accented.get((f, _ACCENTED.sub("", end)), ())) for f, end in zip(fields, found)], dtype=bool)

    # The source's baseline: texts without terminator for each one with, among those with the strong ends (which close whole texts).  An
    # end is usual where the terminated texts that have it, at their sources' baselines, explain those without (``slack`` times).
    listed = e.sparkSession.createDataFrame([tuple(r) for r in strong_ends], "field_name string, end string")
    by_source = by_source.withColumn("source", F.coalesce("source", F.lit("")))
    told = by_source.join(F.broadcast(listed), ["field_name", "end"], "left_semi").groupBy("field_name", "source").agg(((F.sum("without") + 1) / (F.sum("with_stop") + 1)).alias("odds"))
    expected = by_source.join(told, ["field_name", "source"], "left")
    expected = expected.groupBy("field_name", "end").agg(F.sum(F.col("with_stop") * F.coalesce("odds", F.lit(1.0))).alias("expected"))
    ends = cut(ends.withColumn("strong", strong).join(expected, ["field_name", "end"]))
    open_ = e.where("not stopped")
    # Frequent ends (at most rows / heavy of them) are joined by broadcast, so no task gets all texts of one.
    hot = F.broadcast(ends.where(F.col("with_stop") + F.col("without") > heavy).select("field_name", "end", "with_stop", "without", "strong", "expected"))
    rest = ends.where(F.col("with_stop") + F.col("without") <= heavy).select("field_name", "end", "with_stop", "without", "strong", "expected")
    keys = ["field_name", "end"]
    open_ = open_.join(hot, keys).unionByName(open_.join(hot.select(*keys), keys, "left_anti").join(rest, keys))
    open_ = open_.join(limits, ["field_name", "source"], "left")
    usual_end = F.coalesce(F.col("strong"), F.lit(False)) | (F.col("expected") * slack >= F.col("without")) & (F.col("with_stop") > 0)
    usual_end = usual_end | F.pandas_udf(spelled, "boolean")("field_name", "end")
    at_limit = F.coalesce(reduce(Column.__or__, [F.array_contains(f"most_{u}", F.col(u)) for u in UNITS]), F.lit(False))
    # A usual last word that in further contexts, too, closes as many terminated texts as others (a closing thanks) is usual after any.
    further = ends.where("not strong").groupBy("field_name", "last").agg(F.sum("with_stop").alias("closing"), F.sum("without").alias("not_closing"), F.count_if(F.col("with_stop") > 0).alias("contexts"))
    further = further.where("contexts >= 5 and closing >= not_closing").join(ends.where("strong").select("field_name", "last").distinct(), ["field_name", "last"], "left_semi")
    open_ = open_.join(F.broadcast(further.select("field_name", "last", F.lit(True).alias("closes"))), ["field_name", "last"], "left")
    usual_end = usual_end | F.col("closes").isNotNull()
    # A text as long as a limit is complete where its record's other text closes with what goes with its end in terminated texts (three
    # times as often as by chance).
    pairs = e.where("stopped and other <> ''").groupBy("field_name", "end", "other").agg(F.count("*").alias("both"))
    alone = lambda *cs: F.sum("both").over(Window.partitionBy("field_name", *cs))
    pairs = pairs.select("*", alone("end").alias("of_end"), alone("other").alias("of_other"))
    pairs = pairs.join(F.broadcast(pairs.groupBy("field_name").agg(F.sum("both").alias("of_all"))), "field_name")
    pairs = pairs.where(F.col("both") > 1).where(F.col("both").cast("double") * F.col("of_all") >= 3 * F.col("of_end").cast("double") * F.col("of_other"))
    open_ = open_.join(pairs.select("field_name", "end", "other", F.lit(True).alias("paired")), ["field_name", "end", "other"], "left")
    at_limit = at_limit & F.col("paired").isNull()
    # Where a usual end closes the text with a word, values that lack lack by choice.
    missing = F.col("missing") & ~(F.coalesce(F.col("strong"), F.lit(False)) & ~F.col("last").endswith("#"))
    lost = F.col("bad") | F.col("part") | missing | F.col("weak") & ~F.coalesce(F.col("strong"), F.lit(False)) | ~usual_end | at_limit
    judged = open_.select("field_name", "record_id", "source", lost.alias("lost"))
    return judged.unionByName(e.where("stopped or stopped is null").select("field_name", "record_id", "source", F.lit(False).alias("lost")))


def _gaps(end: str) -> list[tuple[tuple, str]]:
    """Each word of an end, after what stands beside it: its place and the other words."""
    words = end.split(" ")
    return [((i, *words[:i], "", *words[i + 1 :]), w) for i, w in enumerate(words)]


def _without_accents(end: str, known: str) -> bool:
    """Whether an end is a known one in letters without accents, which a skeleton keeps."""
    left = iter(end)
    return end != known and all(c in left for c in known)


def _near(word: str, known: set[str]) -> bool:
    """Whether the word is a known one with one letter wrong, missing, doubled or swapped (not an equal one, and no mere beginning of one)."""
    if len(word) < 5 or any(k.startswith(word) and k != word for k in known):
        return False
    for k in known:
        if k != word and abs(len(k) - len(word)) < 2 and len(k) > 4:
            i = next((i for i, (a, b) in enumerate(zip(k, word)) if a != b), min(len(k), len(word)))
            if word[i + 1 :] in (k[i + 1 :], k[i:]) or word[i:] == k[i + 1 :] or word[i : i + 2] == k[i : i + 2][::-1] and word[i + 2 :] == k[i + 2 :]:
                return True
    return False


def rates(judged: DataFrame) -> DataFrame:
    """Share of cut texts for each field and source."""
    return judged.groupBy("field_name", "source").agg(F.count("*").alias("texts"), F.count_if("lost").alias("lost"), F.avg(F.col("lost").cast("double")).alias("share"))
