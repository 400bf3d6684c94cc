"""Instruction-response pairs whose response is no answer.

Method: naive Bayes models of character trigrams give the language posteriors of prompt and response, and tell sentences that decline from
sentences that answer.  A response in prose of another language than its prompt is a defect; one all of whose sentences decline is a
refusal, whatever its length.  Ends of responses (their last words) are counted over the corpus; an end that finished responses hardly
ever have is a truncation, as are an open bracket, quote or code fence and values of the question that the statement no longer reaches.
Empty responses and copies of the request are told by their letters.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .lost_ends import clean_word, last_words, left_open, skeleton

BUCKETS = 1 << 15

# Seed texts of the languages told apart; the prompts' own language is learned from the prompts besides.
SEEDS = {
    "ro": "Interogarea unește mai multe tabele și păstrează doar rândurile cerute. Rezultatul este ordonat după prima coloană, iar valorile lipsă nu sunt numărate. Dacă nu există nicio potrivire, răspunsul rămâne gol. Aceasta este o explicație pentru cine nu știe ce face cererea, scrisă pe înțelesul tuturor. Trebuie să verificați apoi câte rânduri au fost schimbate. Nu este nevoie de altceva, deoarece datele se găsesc deja acolo.",
    "en": "The query joins several tables and keeps only the rows that were asked for. It then sorts the result by the first column, and missing values are not counted. If nothing matches, the answer simply has no rows. This is an explanation for those who do not know what the statement does, written in plain words. You should change the table with one statement and then check the number of rows. There is no need for anything else, because the data is already there.",
    "fr": "La requête relie plusieurs tables et ne garde que les lignes demandées. Le résultat est ensuite trié selon la première colonne, et les valeurs absentes ne sont pas comptées. Si rien ne correspond, la réponse reste sans lignes. Il faut modifier la table avec une seule instruction puis vérifier le nombre de lignes. C'est une explication pour ceux qui ne savent pas ce que fait la commande, écrite avec des mots simples. Vous n'avez besoin de rien d'autre, parce que les données sont déjà là.",
    "de": "Die Abfrage verbindet mehrere Tabellen und behält nur die gewünschten Zeilen. Danach wird das Ergebnis nach der ersten Spalte sortiert, und fehlende Werte werden nicht gezählt. Wenn nichts passt, bleibt die Antwort ohne Zeilen. Man sollte die Tabelle mit einer einzigen Anweisung ändern und dann die Anzahl der Zeilen prüfen. Das ist eine Erklärung für alle, die nicht wissen, was der Befehl macht, in einfachen Worten geschrieben. Sonst ist nichts nötig, weil die Daten schon da sind.",
    "it": "La richiesta collega diverse tabelle e conserva solo le righe richieste. Il risultato viene poi ordinato secondo la prima colonna, e i valori mancanti non vengono contati. Se non c'è nessuna corrispondenza, la risposta resta senza righe. Bisogna modificare la tabella con una sola istruzione e poi contare le righe. Questa è una spiegazione per chi non sa che cosa fa il comando, scritta con parole semplici. Non serve altro, perché i dati sono già lì.",
    "es": "La consulta une varias tablas y conserva solo las filas pedidas. Después ordena el resultado por la primera columna, y los valores ausentes no se cuentan. Si nada coincide, la respuesta queda sin filas. Hay que modificar la tabla con una sola instrucción y luego comprobar el número de filas. Esta es una explicación para quien no sabe lo que hace la orden, escrita con palabras sencillas. No hace falta nada más, porque los datos ya están allí.",
    "pt": "A consulta liga várias tabelas e mantém apenas as linhas pedidas. Depois ordena o resultado pela primeira coluna, e os valores em falta não são contados. Se nada corresponder, a resposta fica sem linhas. Deve-se alterar a tabela com uma única instrução e depois verificar o número de linhas. Esta é uma explicação para quem não sabe o que faz o comando, escrita com palavras simples. Não é preciso mais nada, porque os dados já estão lá.",
    "hu": "A lekérdezés összekapcsolja a táblákat, és csak a kért sorokat tartja meg. Az eredményt ezután az első oszlop szerint rendezi, a hiányzó értékeket pedig nem számolja. Ha nincs egyezés, a válasz üres marad. A táblát egyetlen utasítással kell módosítani, majd ellenőrizni kell a sorok számát. Ez egy magyarázat azoknak, akik nem tudják, mit csinál a parancs, egyszerű szavakkal leírva. Másra nincs szükség, mert az adatok már ott vannak.",
    "pl": "Zapytanie łączy kilka tabel i zachowuje tylko potrzebne wiersze. Wynik jest potem sortowany według pierwszej kolumny, a brakujące wartości nie są liczone. Jeśli nic nie pasuje, odpowiedź pozostaje bez wierszy. Należy zmienić tabelę jednym poleceniem, a następnie sprawdzić liczbę wierszy. To jest wyjaśnienie dla tych, którzy nie wiedzą, co robi polecenie, napisane prostymi słowami. Nic więcej nie jest potrzebne, ponieważ dane już tam są.",
}
LANGUAGES = list(SEEDS)

# Seed texts that decline, in each of the languages.
DECLINING = {
    "ro": "Îmi pare rău, dar nu pot să răspund la această întrebare. Nu am voie să scriu interogarea cerută. Din păcate nu pot ajuta cu solicitarea aceasta. Nu sunt în măsură să generez răspunsul. Refuz să continui. Nu îmi este permis să ofer asistență, deoarece informațiile nu îmi sunt accesibile. Prefer să nu mă pronunț. Te rog reformulează cererea sau adresează-te altcuiva. Scuze, nu știu să rezolv sarcina. Ca model de limbaj nu am cum să răspund la cerința primită. Ca asistent virtual nu ofer acest tip de răspuns fără mai multe detalii. Regret, cererea depășește limitele mele.",
    "en": "I am sorry, but I cannot help with that request. I can't write this query. Unfortunately I am unable to complete the task. As an AI language model I won't be able to answer without access to the data. I must decline, it goes against my guidelines and no answer will be given. Please rephrase your question or ask someone else. Sorry, I do not have the permission to continue. I am unable to produce SQL code for this schema. I'm afraid I can not assist, because the information is not available to me at this time.",
    "fr": "Je suis désolé, mais je ne peux pas répondre à cette demande. Je ne suis pas en mesure de vous aider. Malheureusement, je ne peux pas écrire cette requête. En tant que modèle de langage, je refuse de continuer. Veuillez reformuler votre question, car je n'ai pas accès à ces informations.",
    "de": "Es tut mir leid, aber ich kann diese Anfrage nicht beantworten. Leider darf ich dabei nicht helfen. Ich bin nicht in der Lage, das zu schreiben. Als Sprachmodell kann ich diese Aufgabe nicht erledigen. Bitte formulieren Sie die Frage neu, da mir die Daten nicht zur Verfügung stehen.",
    "it": "Mi dispiace, ma non posso rispondere a questa richiesta. Purtroppo non sono in grado di aiutare. Come modello linguistico non posso continuare. Riformula la domanda, perché i dati non mi sono disponibili.",
    "es": "Lo siento, pero no puedo responder a esta solicitud. Lamentablemente no soy capaz de ayudar. Como modelo de lenguaje no puedo continuar. Reformula la pregunta, porque los datos no están disponibles para mí.",
    "pt": "Desculpe, mas não posso responder a este pedido. Infelizmente não sou capaz de ajudar. Como modelo de linguagem não posso continuar. Reformule a pergunta, porque os dados não estão disponíveis para mim.",
    "hu": "Sajnálom, de nem tudok válaszolni erre a kérésre. Sajnos nem áll módomban segíteni. Nyelvi modellként nem folytathatom. Kérem, fogalmazza át a kérdést, mert az adatok nem érhetők el számomra.",
    "pl": "Przykro mi, ale nie mogę odpowiedzieć na tę prośbę. Niestety nie jestem w stanie pomóc. Jako model językowy nie mogę kontynuować. Proszę przeformułować pytanie, ponieważ dane nie są dla mnie dostępne.",
}
# What the answers' seeds have besides: how explanations of a statement speak.
EXPLAINING = {
    "ro": " Pe scurt, iată ce face comanda. Practic, aflăm care este situația dintr-un loc comparată cu cea din altul. Filtrul lasă afară valorile prea mici sau prea mari. Condițiile cer ca rândul să fie dintr-un anumit loc. Nu pot apărea valori fără legătură, deoarece unirea este interioară. Trenul pleacă de acum la ora nouă.",
    "en": " In short, here is what the command does. In practice we learn how one place compares with another. The filter leaves out values that are too small or too large. Values without a match cannot appear, because the join is an inner one.",
}
_SENTENCE = re.compile(r"(?<=[.!?;])\s+|\n+")
# Fixed value: the words that stand for nothing.
NOTHING = set("none null nil nan na n a n/a undefined empty nothing nimic niciunul gol fara vid void missing unknown necunoscut tbd todo nedefinit indisponibil lipsa lipseste".split())
SQL_START = re.compile(r"(?i)(?:select|insert\s+into|update\s+\w+\s+set|delete\s+from|create\s+(?:table|view|index|temp)|alter\s+table|drop\s+(?:table|view|index)|with\s+\w+\s+as|replace\s+into)\b")
SQL_ANY = re.compile(r"(?:^|\n|:\s)\s*(?:" + SQL_START.pattern.removeprefix("(?i)") + ")", re.IGNORECASE)
_SHOUTED = re.compile(r"\s*(?:SELECT|UPDATE|DELETE|INSERT|CREATE|DROP|ALTER)\b(?!\s+[a-z]+\s+[a-z]+\s+[a-z]+\b)")
OPEN_END = re.compile(r"(?i)(?:[,(=<>.+*/|-]|\b(?:select|distinct|from|where|and|or|not|by|on|join|inner|left|outer|between|like|in|as|is|set|into|values|order|group|having|limit|offset|union|all|case|when|then|else|update|delete|insert|create|table|drop|alter|exists|if))\s*\Z")
_FENCE = re.compile(r"```[a-zA-Z]*\n?")
# Fixed value: how a request names its row limit.
_AT_MOST = re.compile(r"\b(?:cel mult|at most) ([0-9]+)")
_SQL_TOKEN = re.compile(r"'(?:[^']|'')*'?|\w+|[^\s\w]")


_UNSEEN = re.compile("[\u0300-\u036f\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]+")


def fold(text: str) -> str:
    """Lower case without accents and invisible characters."""
    text = text.lower()
    return text if text.isascii() else _UNSEEN.sub("", unicodedata.normalize("NFKD", text))


def buckets(text: str) -> np.ndarray:
    """Trigram buckets of a text; names (inner capitals), numbers and identifiers do not count."""
    words = [w for i, w in enumerate(text.split()) if "_" not in w and not any(c.isdigit() for c in w) and (i == 0 or not w[:1].isupper())]
    t = " " + fold(" ".join(words)) + " "
    c = np.frombuffer(t.encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    if len(c) < 3:
        return np.zeros(0, np.int64)
    return ((c[:-2] * 961 + c[1:-1] * 31 + c[2:]) * 40503 >> 4) & (BUCKETS - 1)


def fit(prompts: list[str]) -> np.ndarray:
    """Log probabilities (languages x buckets).  ``prompts`` (a bounded sample) count for the first language, as much as its seed."""
    counts = np.full((len(LANGUAGES), BUCKETS), 0.02)
    for k, name in enumerate(LANGUAGES):
        np.add.at(counts[k], buckets(SEEDS[name]), 1.0)
    got = [b for p in prompts if p for b in buckets(p)]
    if got:
        own = np.bincount(got, minlength=BUCKETS)
        counts[0] += own * (len(buckets(SEEDS["ro"])) / own.sum())
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def fit_stance() -> np.ndarray:
    """Log probabilities (buckets x languages, first of declining, then of answering texts)."""
    out = []
    for seeds in (DECLINING, {k: v + EXPLAINING.get(k, "") for k, v in SEEDS.items()}):
        for name in LANGUAGES:
            counts = np.full(BUCKETS, 0.05)
            np.add.at(counts, buckets(seeds[name]), 1.0)
            out.append(np.log(counts / counts.sum()))
    return np.ascontiguousarray(np.stack(out, axis=1))


def declines(text: str, stance: np.ndarray) -> bool:
    """Whether every sentence (of letters) leans to declining, each by the language that fits it best."""
    any_ = False
    for sentence in _SENTENCE.split(text):
        b = buckets(sentence)
        if len(b) > 2:
            score = stance[b].sum(axis=0)
            if score[: len(LANGUAGES)].max() <= score[len(LANGUAGES) :].max():
                return False
            any_ = True
    return any_


def posteriors(text: str, model: np.ndarray) -> np.ndarray:
    b = buckets(text)
    score = model[:, b].sum(axis=1) if len(b) else np.zeros(len(LANGUAGES))
    p = np.exp(score - score.max())
    return p / p.sum()


def keys(text: str) -> tuple[str, str]:
    """Letters and digits without accents; and only those that no wrong decoding changes."""
    return re.sub(r"[^a-z0-9]+", "", fold(text)), re.sub(r"[^a-z0-9]+", "", text.lower().encode("ascii", "ignore").decode())


def is_copy(response: str, request: str) -> bool:
    """The request's letters again, or after a lead-in that is shorter than the request."""
    for mine, theirs in zip(keys(response), keys(request)):
        if theirs and (mine == theirs or mine.endswith(theirs) and len(mine) < 2 * len(theirs)):
            return True
    return False


def first_question_line(context: str | None) -> str:
    """The first line of the question in an input: after the first blank line, past the label line."""
    if not context:
        return ""
    rest = context.split("\n\n", 1)[-1].strip().split("\n")
    if len(rest) > 1 and rest[0].rstrip().endswith(":"):
        rest = rest[1:]
    return rest[0] if rest else ""


NONE = {"defect": None, "end": None, "stopped": None, "kind": None, "short": None}


def judge(instruction: str | None, context: str | None, output: str | None, model: np.ndarray, stance: np.ndarray) -> dict:
    text = "" if output is None else output
    bare = _FENCE.sub("", text).replace("```", "")
    letters = re.sub(r"[\W_]+", " ", fold(bare)).strip()
    if not letters or letters in NOTHING or letters in ("n a", "fara raspuns", "no answer", "no output", "sql"):
        return NONE | {"defect": "empty"}
    line = first_question_line(context)
    prose = "\n".join(x[2:].strip() if x.startswith("--") else x for x in bare.strip().split("\n"))
    if instruction and is_copy(prose, instruction) or line and is_copy(prose, line):
        return NONE | {"defect": "copy"}
    code = "\n".join(x for x in bare.split("\n") if not x.strip().startswith("--"))
    sql = SQL_ANY.search(code) or _SHOUTED.match(code)
    if not sql:
        if declines(bare, stance):
            return NONE | {"defect": "refusal"}
        p = posteriors(bare, model)
        if p[0] < 0.5:
            asked = posteriors(instruction or line or SEEDS["ro"], model)
            if asked[0] >= p[0]:
                return NONE | {"defect": "language"}
        tail = text.strip()
        words = [clean_word(w) for w in last_words(tail)]
        core = tail.rstrip("\"'”»)*_` \n")
        dots = core.endswith(("...", "…"))
        stopped = core[-1:] in (".", "?", "!") and not dots
        return NONE | {"kind": "prose", "stopped": stopped, "end": " ".join(skeleton(w) for w in words[-2:]), "short": bool(left_open(tail)) and not stopped or core.endswith((",", ":", "–"))}
    code = code.strip()
    statement = code[sql.start() :].strip() if sql.start() else code
    closed = text.rstrip().endswith("```") and text.count("```") > 1 or statement.endswith(";")
    fence_open = text.count("```") == 1
    tokens = _SQL_TOKEN.findall(statement.rstrip("; \n"))
    quotes = statement.replace("''", "").count("'") % 2
    unclosed = quotes or statement.count("(") > statement.count(")") or fence_open or bool(OPEN_END.search(statement.rstrip("; \n")))
    shapes = ["S" if t[0] == "'" else "#" if t[0].isdigit() else re.sub(r"\d+", "#", t.lower()) for t in tokens[-4:]]
    # A row limit that the request names and the statement does not reach.
    asked = _AT_MOST.findall(" ".join(fold(f"{line} {instruction or ''}").split())) if not closed else []
    got = re.findall(r"(?i)\blimit\s+([0-9]+)", statement)
    missing = bool(asked) and (not got and statement[:6].lower() == "select" or bool(got) and got[-1] not in asked and any(n.startswith(got[-1]) for n in asked))
    return NONE | {"kind": "sql", "stopped": bool(closed), "end": " ".join(shapes), "short": bool(unclosed or missing)}


SCHEMA = "defect string, end string, stopped boolean, kind string, short boolean"
NAMES = list(NONE)


def broken_pairs(df: DataFrame, instruction: str, context: str, output: str, id_col: str = "id", fit_on: int = 2000) -> DataFrame:
    """(id, defect_type) of each defective record, at most one type each.

    The language model is fitted on the ``fit_on`` prompts of smallest hash (a bounded sample) and the seeds; end counts cover all rows.
    Null responses are empty; null instruction and context leave the checks that need them out.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.col(instruction).alias("i"), F.col(context).alias("c"), F.col(output).alias("o"))
    sample = [r.i for r in rows.where("i is not null").select("i", F.xxhash64("i").alias("h")).orderBy("h", "i").limit(fit_on).collect()]
    model = spark.sparkContext.broadcast((fit(sample), fit_stance()))

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for i, c, o in batches:
            yield pd.DataFrame([judge(*x, *model.value) for x in zip(i, c, o)], columns=NAMES)

    judged = cut(rows.select("id", F.pandas_udf(run, SCHEMA)("i", "c", "o").alias("x")).select("id", "x.*"))
    open_ = judged.where("defect is null")
    ends = open_.groupBy("kind", "end").agg(F.count_if("stopped").alias("with_stop"), F.count_if(~F.col("stopped") & ~F.col("short")).alias("without"))
    totals = ends.groupBy("kind").agg(F.sum("with_stop").alias("all_with"), F.sum("without").alias("all_without"))
    ends = ends.join(F.broadcast(totals), "kind")
    # How likely a finished response has this end, against how often it comes without a closing mark.
    rate = F.col("all_without") / F.greatest(F.col("all_with"), F.lit(1))
    usual = F.when(F.col("kind") == "sql", (F.col("with_stop") * rate * 4 >= F.col("without")) & (F.col("with_stop") > 0)).otherwise(
        (F.col("with_stop") * 0.5 >= F.col("without")) & (F.col("with_stop") > 0)
    )
    late = open_.where("not stopped or short").join(ends.select("kind", "end", usual.alias("usual")), ["kind", "end"], "left")
    cut_off = late.where("short or not stopped and not coalesce(usual, false)")
    return judged.where("defect is not null").select("id", F.col("defect").alias("defect_type")).unionByName(cut_off.select("id", F.lit("truncated").alias("defect_type")))
