"""Text that was decoded with the wrong character encoding.

Method: the garbled forms of every distinct clean corpus word are generated under all encoding chains (one or two wrong readings, a
single-byte error before them, lost characters) and hash-joined with the distinct suspicious tokens of the texts; a bitmap of those
tokens keeps forms out that none of them can be.  A field with a joined token is garbled, and so is one with a lost character or a
control character that only a wrong reading leaves.  Joined tokens are replaced by their originals; other suspicious tokens of the
field are read back through the chain that its joined tokens have in common, and kept where that reading does not verify.  Characters
lost for good stay as they are where no corpus word tells the original.

The texts are read once: one pass gives the distinct words of the corpus and the suspicious tokens of the fields.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .gathering import bits_for, gathered, mark, marked

# Encodings that take part in chains.
READ_AS = ["cp1252", "latin-1", "cp1250", "iso8859-2", "cp852", "cp437", "mac-roman", "cp1251", "iso8859-16"]
WRITTEN_AS = ["cp1250", "iso8859-2", "iso8859-16", "cp852"]
CEDILLA = str.maketrans("șțȘȚ", "şţŞŢ")
COMMA = str.maketrans("şţŞŢ", "șțȘȚ")

ROMANIAN = r"A-Za-z0-9ăâîșțĂÂÎȘȚ'\-"
EDGE = r"""[\x00-\x20!"#$%&'()*+,\-./:;<=>@\[\\\]^_`{|}~]"""
QUOTES = r"[„“”‘’«»…–—]"
# A token that may be a garbled form: a character that is no Romanian letter, or a question mark that is not its last.
SUSPECT = rf"[^\x00-\x7FăâîșțĂÂÎȘȚ]|\?."


@lru_cache(None)
def _tables(codec: str) -> tuple[str, dict[str, int]]:
    """Byte -> character and back; bytes the encoding leaves undefined are read as the control character of their number."""
    there = ""
    for b in range(256):
        try:
            there += bytes([b]).decode(codec)
        except UnicodeDecodeError:
            there += chr(b)
    back: dict[str, int] = {}
    for b, c in enumerate(there):
        back.setdefault(c, b)
    return there, back


def misread(text: str, codec: str) -> str:
    """The text's UTF-8 bytes read as ``codec``."""
    return codecs.charmap_decode(text.encode("utf-8", "surrogatepass"), "strict", _tables(codec)[0])[0]


def reread(text: str, codec: str) -> str | None:
    """Undoes misread; None where that is impossible."""
    back = _tables(codec)[1]
    try:
        return bytes([back[c] for c in text]).decode("utf-8")
    except (KeyError, UnicodeDecodeError):
        return None


def written(text: str, codec: str, codec2: str) -> str | None:
    """The text written in an 8-bit encoding and read in another."""
    try:
        raw = text.encode(codec)
    except UnicodeEncodeError:
        try:
            raw = text.translate(CEDILLA).encode(codec)
        except UnicodeEncodeError:
            return None
    return codecs.charmap_decode(raw, "strict", _tables(codec2)[0])[0]


def forms(word: str) -> dict[str, str]:
    """Garbled form -> the shortest chain to it.  The word in other letters of the same sound (cedilla for comma) is no garbled form."""
    out: dict[str, str] = {}
    own = (word, word.translate(CEDILLA))

    def add(form: str | None, chain: str) -> None:
        if form and form not in own and form.strip("?\ufffd"):
            out.setdefault(form, chain)

    once = {c: misread(word, c) for c in READ_AS}
    for c in READ_AS:
        add(once[c], c)
    single = {}
    for e in WRITTEN_AS:
        for d in READ_AS:
            if e != d and (x := written(word, e, d)) is not None and x not in own:
                single.setdefault(x, f"{e}>{d}")
                add(x, f"{e}>{d}")
    for sign in "?\ufffd":
        for kept in _KEPT:
            add("".join([c if kept(c) else sign for c in word]), "lost")
        add("".join([c if c < "\x80" else sign * len(c.encode()) for c in word]), "lost")
    for chain, form in [*once.items(), *((chain, x) for x, chain in single.items())]:
        for d in READ_AS:
            add(misread(form, d), f"{chain} {d}")
    return out


_KEPT = (lambda c: c < "\x80", lambda c: c < "Ā", lambda c: c in "âîÂÎ" or c < "\x80")


def undo(token: str, chain: str) -> str | None:
    """The token read back through a chain; None where it does not verify."""
    if chain == "lost":
        return None
    for step in reversed(chain.split(" ")):
        if ">" in step:
            e, d = step.split(">")
            back = _tables(d)[1]
            try:
                token = bytes([back[c] for c in token]).decode(e).translate(COMMA)
            except (KeyError, UnicodeDecodeError):
                return None
        else:
            token = reread(token, step)
            if token is None:
                return None
    return token


def core(token):
    return F.regexp_replace(F.regexp_replace(token, rf"^(?:{EDGE}|{QUOTES})+", ""), rf"(?:{EDGE}|{QUOTES})+$", "")


_SUSPECT = re.compile(SUSPECT)
_LOST = re.compile("[\ufffd\x80-\x84\x86-\x9f]")
KEEP = 200_000


def tokens_of(text: str) -> list[str]:
    """Tokens between blanks, tabs and line ends (other white space may be a part of a garbled form)."""
    return text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")


def read_tokens(df: DataFrame, id_col: str, columns: list[str], corpus: list[str]) -> DataFrame:
    """(kind, field_name, id, token) in one pass: the distinct words with a letter beyond ASCII of the ``corpus`` columns (kind w), the suspicious
    tokens of each field of ``columns`` (s), and the fields with a lost character or a stray control character (l)."""
    all_columns = list(dict.fromkeys([*columns, *corpus]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: set[str] = set()
        for pdf in batches:
            out, new = [], set()
            for c in all_columns:
                asked, counts = c in columns, c in corpus
                for i, text in zip(pdf["id"], pdf[f"__{c}"]):
                    if text is None or text.isascii() and (not asked or "?" not in text):
                        continue
                    some = {t for t in tokens_of(text) if not t.isascii() or "?" in t}
                    if counts:
                        new.update(t for t in some if not t.isascii())
                    if asked and _SUSPECT.search(text):
                        out += [("s", c, i, t) for t in some if t.endswith("?") or _SUSPECT.search(t)]
                        if _LOST.search(text):
                            out.append(("l", c, i, None))
            out += [("w", None, None, t) for t in new - known]
            known |= new
            if len(known) > KEEP:
                known.clear()
            yield pd.DataFrame(out, columns=["kind", "field_name", "id", "token"])

    kind = df.schema[id_col].dataType.simpleString()
    slim = df.select(F.col(id_col).alias("id"), *[F.col(c).alias(f"__{c}") for c in all_columns])
    return cut(slim.mapInPandas(run, f"kind string, field_name string, id {kind}, token string"))


def _hashes(texts: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64)


def form_table(words: DataFrame, asked: DataFrame, most_bits: int = 1 << 28) -> DataFrame:
    """words(word), distinct clean candidates; asked(form), what tokens may be -> (form, word, chain), one original for each form: the smallest
    word by the shortest chain, Romanian words first.  A form that is a Romanian word of the corpus itself is left out.  Forms
    that are not asked for go where they are made (a bitmap of at most ``most_bits`` bits tells; its errors cost rows, not results)."""
    native = words.where(F.col("word").rlike(rf"^[{ROMANIAN}]+$") | F.col("word").rlike(r"^(?:\p{IsGreek}+|\p{IsCyrillic}+)$"))
    foreign = words.where(F.col("word").rlike(r"^[\p{L}\p{M}'\-]+$") & ~F.col("word").rlike(rf"^[{ROMANIAN}]+$") & ~F.col("word").rlike(r"^(?:\p{IsGreek}+|\p{IsCyrillic}+)$"))
    all_asked = asked.select("form").unionByName(foreign.select(F.col("word").alias("form")))
    bits = bits_for(all_asked.count(), 32, most_bits)
    bitmap = words.sparkSession.sparkContext.broadcast(gathered(all_asked, bits // 8, "uint8", lambda own, pdf: mark(own, _hashes(pdf["form"].tolist())), np.bitwise_or))

    def expand(ws: DataFrame, rank: int) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for w in pdf["word"]:
                    got = list(forms(w).items())
                    if got:
                        ok = marked(bitmap.value, _hashes([f for f, _ in got]))
                        out += [(f, chain, w, rank) for (f, chain), y in zip(got, ok) if y]
                yield pd.DataFrame(out, columns=["form", "chain", "word", "rank"])

        return ws.select("word").mapInPandas(run, "form string, chain string, word string, rank int")

    first = cut(expand(native, 0))
    second = expand(foreign.join(first.select(F.col("form").alias("word")).distinct(), "word", "left_anti"), 1)
    best = first.unionByName(second).groupBy("form").agg(F.min(F.struct("rank", F.length("chain").alias("n"), "chain", "word")).alias("x"))
    return best.select("form", "x.word", "x.chain").join(native.select(F.col("word").alias("form")), "form", "left_anti")


def garbled_fields(df: DataFrame, id_col: str, columns: list[str], corpus: list[str]) -> DataFrame:
    """(field_name, id, chain, known map<token, struct<form, word>>, by_word) of the fields a part or all of which was decoded wrongly;
    ``by_word`` is false where only a lost or stray character tells.

    Null and empty texts, and an empty table, give no rows; rows with one id count as one.
    """
    read = read_tokens(df, id_col, columns, corpus)
    places = read.where("kind = 's'").select("field_name", "id", "token")
    words = cut(read.where("kind = 'w'").select("token").distinct().select(core(F.col("token")).alias("word")).where("word <> ''").distinct())
    bare = F.regexp_replace(F.col("token"), rf"^(?:{EDGE})+|(?:{EDGE})+$", "")
    looks = places.select("token").distinct().select("token", F.explode(F.array_distinct(F.array(bare, F.regexp_replace(bare, rf"(?:\?|{EDGE})+$", ""), core(F.col("token"))))).alias("form"))
    looks = cut(looks.where("form <> ''"))
    best = looks.join(form_table(words, looks.select("form")), "form").groupBy("token").agg(F.max_by(F.struct("form", "word", "chain"), F.length("form")).alias("x"))
    best = cut(best.select("token", "x.*"))
    hits = places.join(F.broadcast(best) if best.count() <= 200_000 else best, "token")
    # A question mark that only ends its token is no evidence by itself.
    sure = F.col("form").rlike(SUSPECT)
    by_chain = hits.groupBy("field_name", "id", "chain").agg(F.count("*").alias("n"), F.max(sure.cast("int")).alias("sure"), F.map_from_entries(F.collect_set(F.struct("token", F.struct("form", "word")))).alias("m"))
    told = F.col("chain") != "lost"
    per = by_chain.groupBy("field_name", "id").agg(F.max("sure").alias("sure"), F.max_by(F.when(told, F.col("chain")), F.when(told, F.col("n"))).alias("chain"), F.collect_list("m").alias("ms"))
    merged = "aggregate(ms, cast(map() as map<string,struct<form:string,word:string>>), (a, m) -> map_concat(a, map_filter(m, (k, v) -> not map_contains_key(a, k))))"
    by_word = per.where("sure = 1").select("field_name", "id", "chain", F.expr(merged).alias("known"), F.lit(True).alias("by_word"))
    lost = read.where("kind = 'l'").select("field_name", "id").distinct()
    only = lost.join(by_word.select("field_name", "id"), ["field_name", "id"], "left_anti")
    none = F.lit(None)
    return by_word.unionByName(only.select("field_name", "id", none.cast("string").alias("chain"), none.cast("map<string,struct<form:string,word:string>>").alias("known"), F.lit(False).alias("by_word")))


def wrongly_decoded(df: DataFrame, id_col: str, columns: list[str], corpus: list[str]) -> DataFrame:
    """(field_name, id, text, restored) of the fields a part or all of which was decoded wrongly.

    ``corpus`` names the columns whose clean words count; ``restored`` has the original characters where they can be recovered.
    Null and empty texts, and an empty table, give no rows; rows with one id come out each with its own text.
    """
    per = garbled_fields(df, id_col, columns, corpus)
    fields = df.select(F.col(id_col).alias("id"), F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in columns])).alias("x"))
    found = fields.select("id", "x.*").where(F.col("text").rlike(SUSPECT)).join(per, ["field_name", "id"])

    def restore(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        cut_at = re.compile(r"([ \t\r\n]+)")
        for texts, chains, knowns in batches:
            out = []
            for text, chain, known in zip(texts, chains, knowns):
                known = {k: v for k, v in (known.items() if isinstance(known, dict) else known or [])} if known is not None else {}
                parts = cut_at.split(text)
                for i in range(0, len(parts), 2):
                    t = parts[i]
                    if t in known:
                        parts[i] = t.replace(known[t]["form"], known[t]["word"], 1)
                    elif chain and _SUSPECT.search(t):
                        parts[i] = undo(t, chain) or t
                out.append("".join(parts))
            yield pd.Series(out)

    return found.select("field_name", "id", "text", F.pandas_udf(restore, "string")("text", "chain", "known").alias("restored"))
