"""Registered queries of the general operators and the SQL they are compared with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import text as T
from .functions.temporal import clock, weekdays
from .operators import keys, sampling, stats
from .operators.sandbox import valid_in_context
from .operators.waterfall import classified, counters, keep_rate
from .plans import cleaning, evaluation, exports, files, introspect, prompts, relational
from .plans.split import evaluation_split, file_counts
from .session import cut, shared_folder, table
from .sources.config import catalog
from .sources.dumps import insert_statements
from .streaming.state import first_seen, is_late, window_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


# SQL of the white space that strip() and normal() take, and of both functions.
_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _sql_normal(x: str) -> str:
    return f"lower({_sql_strip(f"regexp_replace({x}, '{_WS}+', ' ', 'g')")})"


@query(f"""WITH n AS (SELECT lang, doc_id, coalesce({_sql_normal('text')}, '') AS k FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS r FROM n)
SELECT lang, CASE WHEN k = '' THEN 'empty' WHEN r > 1 THEN 'copy' ELSE 'kept' END AS status, CAST(count(*) AS BIGINT) AS n FROM d GROUP BY ALL""")
def norm_dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalise, keep the first of equal texts, count by language and status.  Texts are grouped by a hash, summed before they
    are shuffled; no text and no hot group travels whole."""
    k = T.normal(F.col("text"))
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.when(F.coalesce(k, F.lit("")) != "", keys.hashed(k)).alias("h"))
    empty = d.where("h is null").groupBy("lang").agg(F.count("*").alias("empty"))
    per = d.where("h is not null").groupBy("h", "lang").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    # Of each text: the language of its first row, and the rows of each language.
    told = per.groupBy("h").agg(F.min(F.struct("first", "lang"))["lang"].alias("owner"), F.collect_list(F.struct("lang", "n")).alias("by"))
    rows = told.select("owner", F.explode("by").alias("x")).select(F.col("x.lang").alias("lang"), F.col("x.n").alias("n"), F.col("owner").eqNullSafe(F.col("x.lang")).cast("long").alias("kept"))
    zero = F.lit(0).cast("long")
    sums = rows.groupBy("lang").agg(F.sum("kept").alias("kept"), F.sum(F.col("n") - F.col("kept")).alias("copy")).select("lang", "kept", "copy", zero.alias("empty"))
    both = sums.unionByName(empty.select("lang", zero.alias("kept"), zero.alias("copy"), "empty")).groupBy("lang").agg(F.sum("kept").alias("kept"), F.sum("copy").alias("copy"), F.sum("empty").alias("empty"))
    return both.unpivot(["lang"], ["kept", "copy", "empty"], "status", "n").where("n > 0")


@query(f"""SELECT domain, CAST(count(*) AS BIGINT) AS records, CAST(count(DISTINCT {_sql_normal('question_en')}) AS BIGINT) AS questions, CAST(count(DISTINCT {_sql_normal('sql')}) AS BIGINT) AS statements
FROM generated_example GROUP BY domain""")
def normal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct normalised questions and statements."""
    g = table(spark, sf_dir, "generated_example")
    return g.groupBy("domain").agg(F.count("*").alias("records"), F.countDistinct(F.md5(T.normal(F.col("question_en")))).alias("questions"), F.countDistinct(F.md5(T.normal(F.col("sql")))).alias("statements"))


@query("""SELECT CASE lower(trim(coalesce(task, ''))) WHEN 'operator' THEN 'operator' WHEN 'operators' THEN 'operator' WHEN 'operation' THEN 'operator' WHEN 'operations' THEN 'operator' ELSE 'user' END AS task, CAST(count(*) AS BIGINT) AS n
FROM (SELECT task FROM generated_example UNION ALL SELECT task FROM queries_alpaca_ro) GROUP BY 1""")
def task_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task names in canonical form."""
    both = table(spark, sf_dir, "generated_example").select("task").union(table(spark, sf_dir, "queries_alpaca_ro").select("task"))
    return both.groupBy(T.task(F.col("task")).alias("task")).agg(F.count("*").alias("n"))


@query(f"""SELECT CASE WHEN w = '' THEN 'UNKNOWN' ELSE upper(w) END AS keyword, CAST(count(*) AS BIGINT) AS n
FROM (SELECT regexp_extract(regexp_replace(coalesce(output, ''), '^{_WS}+', ''), '^[\\p{{L}}_]+') AS w FROM queries_alpaca_ro) GROUP BY 1""")
def first_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First keywords of the outputs."""
    return table(spark, sf_dir, "queries_alpaca_ro").groupBy(T.first_keyword(F.coalesce("output", F.lit(""))).alias("keyword")).agg(F.count("*").alias("n"))


@query(f"""SELECT id, md5(lower({_sql_strip(f"regexp_replace({_sql_strip(f"regexp_replace(sql, '{_WS}+', ' ', 'g')")}, ';+$', '')")})) AS h FROM generated_example""")
def statement_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements in comparable form."""
    return table(spark, sf_dir, "generated_example").select("id", F.md5(T.normal_statement(F.col("sql"))).alias("h"))


_RAW = _sql_strip("coalesce(output, '')")
_EXTRACT = f"""
WITH a AS (SELECT id, {_RAW} AS r FROM queries_alpaca_ro),
b AS (SELECT id, r, string_split(r, '```') AS p FROM a),
c AS (SELECT id, CASE WHEN len(p) >= 3 THEN {_sql_strip('p[2]')} END AS inner_, r FROM b),
d AS (SELECT id, CASE WHEN inner_ IS NULL THEN r WHEN lower(inner_) LIKE 'sql%' THEN {_sql_strip('substring(inner_, 4)')} ELSE inner_ END AS r FROM c),
e AS (SELECT id, CASE WHEN lower(r) LIKE 'sql:%' THEN {_sql_strip('substring(r, 5)')} ELSE r END AS r FROM d),
f AS (SELECT id, r, {_sql_strip("string_split(r, ';')[1]")} AS head, list_filter(list_transform(regexp_split_to_array(r, '[\n\r]+'), lambda x: {_sql_strip('x')}), lambda x: x <> '')[1] AS line FROM e)
SELECT id, md5(CASE WHEN contains(r, ';') AND head <> '' THEN head || ';' WHEN line IS NOT NULL THEN line ELSE r END) AS h,
regexp_matches(upper(CASE WHEN contains(r, ';') AND head <> '' THEN head || ';' WHEN line IS NOT NULL THEN line ELSE r END), '^(SELECT|WITH|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP|REPLACE|PRAGMA|EXPLAIN|VACUUM)([^A-Z_]|$)') AS starts FROM f"""


@query(_EXTRACT)
def extract_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements in answers, and whether they start as SQL."""
    got = table(spark, sf_dir, "queries_alpaca_ro").select("id", T.extract_statement(F.col("output")).alias("s"))
    return got.select("id", F.md5("s").alias("h"), T.starts_as_sql(F.col("s")).alias("starts"))


_PARTS = f"""
WITH a AS (SELECT id, CASE WHEN strpos(input, 'Schema / context SQL:' || chr(10)) > 0 THEN substring(input, strpos(input, 'Schema / context SQL:' || chr(10)) + 22) END AS r FROM queries_alpaca_ro),
b AS (SELECT id, r, strpos(r, chr(10) || chr(10)) AS g FROM a), c AS (SELECT id, r, g, substring(r, g + 2) AS t FROM b WHERE g > 0),
d AS (SELECT id, substring(r, 1, g - 1) AS context, strpos(t, chr(10)) AS l, t FROM c),
e AS (SELECT id, context, CASE WHEN l > 0 THEN {_sql_strip('substring(t, 1, l - 1)')} ELSE {_sql_strip('t')} END AS label, CASE WHEN l > 0 THEN {_sql_strip('substring(t, l + 1)')} ELSE '' END AS question FROM d)
SELECT id, md5(context) AS context, label, md5('Schema / context SQL:' || chr(10) || context || chr(10) || chr(10) || 'Întrebare:' || chr(10) || question) AS rebuilt FROM e"""


@query(_PARTS)
def input_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context, label and question of inputs; inputs rebuilt with the canonical label."""
    q = table(spark, sf_dir, "queries_alpaca_ro").select("id", T.input_parts(F.col("input")).alias("p")).where("p is not null")
    return q.select("id", F.md5("p.context").alias("context"), "p.label", F.md5(T.rebuilt_input(F.col("p.context"), F.col("p.question"))).alias("rebuilt"))


def _sql_count(t: str) -> str:
    return f"CAST((length(instruction) - length(replace(instruction, '{t}', ''))) / {len(t)} AS INTEGER)"


@query(f"""SELECT id, {' OR '.join(f"contains(instruction, '{t}')" for t in T.SUSPICIOUS)} AS suspicious,
CAST(3 * (length(instruction) - length(regexp_replace(instruction, '[{T.DIACRITICS}]', '', 'g'))) - 4 * ({' + '.join(map(_sql_count, T.SUSPICIOUS))}) - 8 * {_sql_count(chr(0xFFFD))} AS BIGINT) AS quality FROM queries_alpaca_ro""")
def text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suspicious sequences and quality of instructions."""
    i = F.col("instruction")
    return table(spark, sf_dir, "queries_alpaca_ro").select("id", T.is_suspicious(i).alias("suspicious"), T.quality(i).cast("long").alias("quality"))


def _sql_quality(x: str) -> str:
    n = lambda t: f"(length({x}) - length(replace({x}, '{t}', ''))) // {len(t)}"
    return f"(3 * (length({x}) - length(regexp_replace({x}, '[{T.DIACRITICS}]', '', 'g'))) - 4 * ({' + '.join(map(n, T.SUSPICIOUS))}) - 8 * {n(chr(0xFFFD))})"


def _sql_replaced(x: str) -> str:
    for a, b in T.REPAIRS:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def _sql_reread(x: str, codec: str) -> str:
    """The bytes of a text in Latin-1 or cp1252, read as UTF-8, null where that fails."""
    ok = f"regexp_full_match({x}, '(?s)[\\x{{00}}-\\x{{FF}}]*')"
    if codec == "cp1252":
        ok, x = f"NOT regexp_matches({x}, '[\\x{{80}}-\\x{{9F}}]')", f"translate({x}, '{T._CP1252}', '{T._C1}')"
        ok = f"({ok} AND regexp_full_match({x}, '(?s)[\\x{{00}}-\\x{{FF}}]*'))"
    return f"CASE WHEN {ok} THEN TRY(decode(unhex(array_to_string(list_transform(regexp_extract_all({x}, '(?s).'), lambda c: printf('%02x', unicode(c))), '')))) END"


def _sql_repaired(source: str, name: str) -> str:
    """Tables named after ``name`` from source(id, t); the last, {name}, has (id, t, fixed)."""
    return f"""{name}_a AS (SELECT id, t, {' OR '.join(f"contains(t, '{x}')" for x in T.SUSPICIOUS)} AS s FROM ({source})),
{name}_b AS (SELECT id, t, {_sql_reread('t', 'latin-1')} AS l, {_sql_reread('t', 'cp1252')} AS w FROM {name}_a WHERE s),
{name}_c AS (SELECT id, t, {_sql_replaced('t')} AS r0, {_sql_replaced('l')} AS r1, {_sql_replaced('w')} AS r2 FROM {name}_b),
{name}_d AS (SELECT *, {_sql_quality('t')} AS q, {_sql_quality('r0')} AS q0, coalesce({_sql_quality('r1')}, -1000000000) AS q1, coalesce({_sql_quality('r2')}, -1000000000) AS q2 FROM {name}_c),
{name}_e AS (SELECT id, t, CASE WHEN q >= greatest(q0, q1, q2) THEN t WHEN q0 >= greatest(q1, q2) THEN r0 WHEN q1 >= q2 THEN r1 ELSE r2 END AS best FROM {name}_d),
{name}_f AS (SELECT id, t, best, {_sql_replaced('best')} AS more FROM {name}_e),
{name} AS (SELECT id, t, CASE WHEN {_sql_quality('more')} >= {_sql_quality('best')} THEN more ELSE best END AS fixed FROM {name}_f UNION ALL SELECT id, t, t FROM {name}_a WHERE s IS NOT TRUE)"""


@query(f"WITH {_sql_repaired('SELECT id, instruction AS t FROM queries_alpaca_ro', 'm')} SELECT id, fixed AS text, fixed <> t AS changed FROM m")
def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instructions after repair by re-reading and replacement."""
    q = table(spark, sf_dir, "queries_alpaca_ro").select("id", T.repaired(F.col("instruction")).alias("r"))
    return q.select("id", "r.text", "r.changed")


_MASK = "((train_id * 37) % 400)"


@query(f"""SELECT train_id, CASE m WHEN 127 THEN 'Zilnic' WHEN 31 THEN 'Luni - Vineri' WHEN 96 THEN 'Sâmbătă - Duminică' WHEN 63 THEN 'Luni - Sâmbătă' WHEN 95 THEN 'Luni - Vineri și Duminică' WHEN 0 THEN 'Zilnic'
ELSE array_to_string(list_filter(['Luni', 'Marți', 'Miercuri', 'Joi', 'Vineri', 'Sâmbătă', 'Duminică'], lambda d, i: (m >> (i - 1)) & 1 = 1), ', ') END AS days
FROM (SELECT train_id, CAST({_MASK} AS INTEGER) % 128 AS m FROM trains)""")
def weekday_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of masks."""
    return table(spark, sf_dir, "trains").select("train_id", weekdays(F.expr(f"cast({_MASK} as string)")).alias("days"))


@query("""SELECT timetable_id, lpad(CAST(((s // 3600) % 24 + 24) % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(((s % 3600) + 3600) % 3600 // 60 AS VARCHAR), 2, '0') AS clock
FROM (SELECT timetable_id, timetable_id * 61 AS s FROM timetables)""")
def clock_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds as clock times."""
    return table(spark, sf_dir, "timetables").select("timetable_id", clock(F.expr("cast(timetable_id * 61 as string)")).alias("clock"))


_AREAS = [("munte", ["MĂGURA", "DEALU", "PODU"]), ("vale", ["VALEA", "LUNCA", "GURA"]), ("izvor", ["IZVORU", "LAC", "BĂI"])]


@query("""SELECT station_id, CASE WHEN contains(u, 'MĂGURA') OR contains(u, 'DEALU') OR contains(u, 'PODU') THEN 'munte' WHEN contains(u, 'VALEA') OR contains(u, 'LUNCA') OR contains(u, 'GURA') THEN 'vale'
WHEN contains(u, 'IZVORU') OR contains(u, 'LAC') OR contains(u, 'BĂI') THEN 'izvor' ELSE 'Alte' END AS area FROM (SELECT station_id, upper(station_name) AS u FROM stations)""")
def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rule that fits a name."""
    return table(spark, sf_dir, "stations").select("station_id", T.first_match(F.col("station_name"), _AREAS, "Alte").alias("area"))


_COUNTIES = ", ".join(f"('{k}', '{v}')" for k, v in relational.COUNTIES.items())


@query(f"""WITH c AS (SELECT DISTINCT code FROM (SELECT trim(county_code) AS code FROM counties UNION ALL SELECT trim(coalesce(county, '')) FROM stations) WHERE code <> '')
SELECT CAST(row_number() OVER (ORDER BY c.code) AS BIGINT) AS county_id, c.code AS county_code, coalesce(n.name, c.code) AS county_name FROM c LEFT JOIN (VALUES {_COUNTIES}) n(code, name) ON n.code = c.code""")
def county_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County codes in order, named by the fixed list, a code without a name by itself."""
    codes = table(spark, sf_dir, "counties").select("county_code").union(table(spark, sf_dir, "stations").select("county"))
    return relational.county_table(codes.select(F.col("county_code").alias("Judet PJ"))).select(F.col("county_id").cast("long").alias("county_id"), "county_code", "county_name")


@query("""SELECT station_id, '"' || replace(station_name, '"', '""') || '"' AS quoted, lpad(CAST(station_number AS VARCHAR), CAST(greatest(10, length(CAST(station_number AS VARCHAR))) AS INTEGER), '0') AS padded, regexp_replace(station_name, '[^\\x00-\\x7F]', '?', 'g') AS printable FROM stations""")
def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as identifiers, padded numbers, console text."""
    s = table(spark, sf_dir, "stations")
    return s.select("station_id", T.quoted_name(F.col("station_name")).alias("quoted"), T.padded(F.col("station_number").cast("string")).alias("padded"), T.printable(F.col("station_name")).alias("printable"))


@query("""WITH v AS (SELECT DISTINCT day_type FROM timetables WHERE day_type IS NOT NULL), r AS (SELECT day_type, row_number() OVER (ORDER BY day_type) AS r FROM v),
t AS (SELECT r, unnest(string_split(day_type, ' ')) AS token, generate_subscripts(string_split(day_type, ' '), 1) AS p FROM r),
f AS (SELECT token, min(r * 1000 + p) AS place FROM t WHERE token <> '' GROUP BY token)
SELECT token, CAST(row_number() OVER (ORDER BY place) AS BIGINT) AS n FROM f QUALIFY n <= 20""")
def token_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First tokens in the order they are seen."""
    v = table(spark, sf_dir, "timetables").select("day_type").where("day_type is not null").distinct()
    got = stats.ordered_tokens(v, "day_type", ["day_type"], 20, " ")
    return got.select("token", F.row_number().over(Window.orderBy("place")).cast("long").alias("n"))


@query("""SELECT trim(county) AS value FROM (SELECT DISTINCT county FROM stations WHERE county IS NOT NULL ORDER BY county LIMIT 30) WHERE trim(county) <> ''""")
def distinct_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first distinct values of a column."""
    return stats.distinct_values(table(spark, sf_dir, "stations"), "county", 30)


@query("""SELECT station_id, station_name, n FROM (SELECT s.station_id, s.station_name, CAST(count(*) AS BIGINT) AS n FROM timetables t JOIN stations s ON s.station_id = t.station_id
GROUP BY s.station_id, s.station_name ORDER BY n DESC, station_name ASC NULLS FIRST, station_id LIMIT 20) WHERE station_name IS NOT NULL""")
def top_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations with most stops."""
    return stats.top_counts(table(spark, sf_dir, "timetables"), table(spark, sf_dir, "stations"), "station_id", "station_name", 20)


@query("""SELECT 'domain' AS facet, domain AS value, CAST(count(*) AS BIGINT) AS n FROM generated_example GROUP BY domain UNION ALL SELECT 'task', task, count(*) FROM generated_example GROUP BY task
UNION ALL SELECT 'difficulty', CAST(difficulty AS VARCHAR), count(*) FROM generated_example GROUP BY difficulty UNION ALL SELECT 'query_type', v, count(*) FROM (SELECT unnest(query_type) AS v FROM generated_example) GROUP BY v""")
def summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2: records by domain, task, difficulty and query type, in one pass."""
    return stats.summary_counts(table(spark, sf_dir, "generated_example"), ["domain", "task", "difficulty"], ["query_type"])


@query("SELECT CAST(coalesce(min(row_count), 0) AS BIGINT) AS least, CAST(coalesce(max(row_count), 0) AS BIGINT) AS most, round(coalesce(avg(row_count), 0.0), 6) AS mean FROM generated_example")
def number_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: least, most and mean row count."""
    r = stats.number_summary(table(spark, sf_dir, "generated_example"), "row_count")
    return r.select(F.col("least").cast("long"), F.col("most").cast("long"), F.round("mean", 6).alias("mean"))


_OUT = _sql_strip("coalesce(output, 'None')")
_WATERFALL = f"""WITH a AS (SELECT *, {_OUT} AS o, strpos(coalesce(input, ''), 'Schema / context SQL:' || chr(10)) AS m FROM queries_alpaca_ro),
b AS (SELECT *, CASE WHEN m > 0 THEN substring(input, m + 22) END AS r FROM a), c AS (SELECT *, CASE WHEN strpos(r, chr(10) || chr(10)) > 0 THEN substring(r, strpos(r, chr(10) || chr(10)) + 2) END AS t FROM b),
w AS (SELECT *, regexp_extract(o, '^[\\p{{L}}_]+') AS word FROM c),
d AS (SELECT *, CASE WHEN o = '' THEN 'empty_output_sql' WHEN upper(word) NOT IN ('SELECT', 'WITH') THEN 'sql_keyword_not_allowed:' || CASE WHEN word = '' THEN 'UNKNOWN' ELSE upper(word) END
 WHEN t IS NULL THEN 'input_parse_failed' END AS reason FROM w)"""


def _dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(table(spark, sf_dir, "queries_alpaca_ro"), cleaning.record_checks("queries", strict_type=True))


@query(_WATERFALL + """ SELECT counter, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(['total', CASE WHEN reason IS NULL THEN 'kept' ELSE 'dropped' END, 'drop_' || split_part(reason, ':', 1)]) AS counter FROM d) WHERE counter IS NOT NULL GROUP BY counter""")
def clean_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the cleaning waterfall."""
    return counters(_dropped(spark, sf_dir))


@query(_WATERFALL + """ SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (reason IS NULL) AS BIGINT) AS kept, coalesce(count(*) FILTER (reason IS NULL) / count(*), 0.0) AS keep_rate FROM d""")
def clean_keep_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep rate."""
    return keep_rate(_dropped(spark, sf_dir))


_QUESTION = f"CASE WHEN strpos(t, chr(10)) > 0 THEN {_sql_strip('substring(t, strpos(t, chr(10)) + 1)')} ELSE '' END"


@query(f"""{_WATERFALL}, k AS (SELECT *, substring(r, 1, strpos(r, chr(10) || chr(10)) - 1) AS context, {_QUESTION} AS question FROM d WHERE reason IS NULL),
{_sql_repaired('SELECT id, instruction AS t FROM k', 'i')}, {_sql_repaired('SELECT id, system_prompt AS t FROM k', 's')}, {_sql_repaired('SELECT id, question AS t FROM k', 'q')}
SELECT k.id, 'user' AS task, md5(i.fixed) AS instruction, md5('Schema / context SQL:' || chr(10) || k.context || chr(10) || chr(10) || 'Întrebare:' || chr(10) || q.fixed) AS input, md5(s.fixed) AS system, NULL AS drop_reason,
array_to_string(list_filter([CASE WHEN i.fixed <> i.t THEN 'instruction' END, CASE WHEN s.fixed <> s.t THEN 'system' END, CASE WHEN q.fixed <> q.t THEN 'input.question_ro' END], lambda x: x IS NOT NULL), ',') AS changed
FROM k JOIN i ON i.id = k.id JOIN s ON s.id = k.id JOIN q ON q.id = k.id
UNION ALL SELECT id, 'user', md5(instruction), md5(input), md5(system_prompt), reason, '' FROM d WHERE reason IS NOT NULL""")
def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned records with repaired texts, changed fields and drop reasons."""
    q = table(spark, sf_dir, "queries_alpaca_ro").withColumnRenamed("system_prompt", "system")
    hashed = [F.md5(c).alias(c) for c in ("instruction", "input", "system")]
    return cleaning.cleaned(q, "queries", strict_type=True).select("id", "task", *hashed, "drop_reason", F.array_join("changed_fields", ",").alias("changed"))


@query(f"SELECT * EXCLUDE (r) FROM (SELECT id, domain, task, row_number() OVER (PARTITION BY {_sql_normal('sql')} ORDER BY id) AS r FROM generated_example) WHERE r = 1")
def dedup_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first record of each statement."""
    g = table(spark, sf_dir, "generated_example").select("id", "domain", "task", "sql")
    return keys.first_by_key(g, T.normal(F.col("sql")), "id").select("id", "domain", "task")


_KEY = "md5(coalesce('=' || {0}, '0'))"


@query(f"""WITH g AS (SELECT id, {_KEY.format(_sql_normal('sql'))} AS a, {_KEY.format(_sql_normal('question_en'))} AS b FROM generated_example),
r AS (SELECT list({{'o': id, 'a': a, 'b': b}} ORDER BY id) AS l FROM g),
f AS (SELECT list_reduce(list_prepend({{'o': NULL, 'a': NULL, 'b': NULL, 'ids': []::VARCHAR[], 'ka': []::VARCHAR[], 'kb': []::VARCHAR[]}}, list_transform(l, lambda x: {{'o': x.o, 'a': x.a, 'b': x.b, 'ids': []::VARCHAR[], 'ka': []::VARCHAR[], 'kb': []::VARCHAR[]}})),
 lambda acc, x: CASE WHEN list_contains(acc.ka, x.a) OR list_contains(acc.kb, x.b) THEN acc ELSE {{'o': NULL, 'a': NULL, 'b': NULL, 'ids': list_append(acc.ids, x.o), 'ka': list_append(acc.ka, x.a), 'kb': list_append(acc.kb, x.b)}} END) AS s FROM r)
SELECT unnest(s.ids) AS id FROM f""")
def dedup_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy deduplication of the generated records on normalised statement or normalised question, in order of id."""
    g = table(spark, sf_dir, "generated_example").select("id", "sql", "question_en")
    return keys.two_key_dedup(g, "id", T.normal(F.col("sql")), T.normal(F.col("question_en"))).select("id")


@query("SELECT CAST(row_number() OVER (ORDER BY county) AS BIGINT) AS county_id, county AS county_code FROM (SELECT DISTINCT county FROM stations WHERE county <> '')")
def dense_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered distinct values."""
    return keys.dense_ids(table(spark, sf_dir, "stations"), F.col("county"), "county_code", "county_id")


@query("""SELECT CAST(row_number() OVER (ORDER BY first) AS BIGINT) AS place_id, name, county FROM (SELECT min(station_id) AS first, arg_min(station_name, station_id) AS name, arg_min(coalesce(county, ''), station_id) AS county
FROM stations GROUP BY station_number, upper(coalesce(county, '')))""")
def first_seen_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys numbered in the order they are first seen, first spelling kept."""
    s = table(spark, sf_dir, "stations").withColumn("county", F.coalesce("county", F.lit("")))
    got = keys.first_seen_ids(s, [F.col("station_number"), F.upper("county")], "station_id", ["station_name", "county"], "place_id")
    return got.select("place_id", F.col("station_name").alias("name"), "county")


@query("SELECT CAST(row_number() OVER (ORDER BY train_id, timetable_id) AS BIGINT) AS n, timetable_id FROM timetables")
def numbered_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequential numbers in a total order, without one task for all rows."""
    return keys.numbered(table(spark, sf_dir, "timetables").select("train_id", "timetable_id"), ["train_id", "timetable_id"], "n").select("n", "timetable_id")


_LEGAL = "CASE WHEN train_id % 3 = 0 THEN 'AR' ELSE 'PJ' END"


@query(f"""WITH n AS (SELECT train_id AS o, upper(left(coalesce(operator_name, ''), 1)) AS code, trim(coalesce(category, '')) || ' ' || CAST(train_id % 40 AS VARCHAR) AS place, CASE WHEN train_id % 2 = 0 THEN 'URBAN' ELSE 'RURAL' END AS area,
 CAST(train_id // 2 AS VARCHAR) AS unit, {_LEGAL} AS legal, 'Școala ' || CAST(train_id AS VARCHAR) AS name, CASE WHEN train_id % 5 > 0 THEN 'Liceul ' || CAST(train_id AS VARCHAR) END AS long_name, trim(coalesce(train_number, '')) AS short FROM trains),
c AS (SELECT code, row_number() OVER (ORDER BY code) AS county_id FROM (SELECT DISTINCT code FROM n WHERE code <> '')),
p AS (SELECT n.*, c.county_id FROM n LEFT JOIN c ON c.code = n.code),
l AS (SELECT upper(place) AS k, county_id, row_number() OVER (ORDER BY min(o)) AS locality_id FROM p WHERE place <> '' AND county_id IS NOT NULL GROUP BY 1, 2),
e AS (SELECT lpad(CAST(train_id // 2 AS VARCHAR), 10, '0') AS code, coalesce(sum(TRY_CAST(substring(arrival_time, 1, 2) AS INTEGER)), 0) AS students, nullif(array_to_string(list_sort(list_distinct(list(trim(day_type)) FILTER (trim(day_type) <> ''))), ', '), '') AS levels FROM timetables GROUP BY 1),
u AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY o) AS r FROM p)
SELECT CAST(row_number() OVER (ORDER BY u.o) AS BIGINT) AS school_id, CASE WHEN u.legal = 'PJ' THEN u.name ELSE coalesce(u.long_name, u.name) END AS school_name, nullif(u.short, '') AS short_name, lpad(u.unit, 10, '0') AS siiir_code, CAST(l.locality_id AS BIGINT) AS locality_id, u.legal AS unit_type,
CASE WHEN u.legal = 'PJ' THEN e.levels END AS education_level, CASE WHEN u.legal = 'PJ' THEN CAST(e.students AS BIGINT) END AS number_of_students
FROM u LEFT JOIN l ON l.k = upper(u.place) AND l.county_id = u.county_id LEFT JOIN e ON e.code = lpad(u.unit, 10, '0') WHERE u.r = 1""")
def gated_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The school plan over a network sheet and an enrolment sheet made of the rail tables."""
    t, tt = table(spark, sf_dir, "trains"), table(spark, sf_dir, "timetables")
    number = F.expr("cast(train_id div 2 as string)")
    network = t.select(
        F.col("train_id").alias("o"), F.upper(F.substring(F.coalesce("operator_name", F.lit("")), 1, 1)).alias("Judet PJ"), F.concat(F.trim(F.coalesce("category", F.lit(""))), F.lit(" "), F.expr("cast(train_id % 40 as string)")).alias("Localitate unitate"),
        F.when(F.col("train_id") % 2 == 0, "URBAN").otherwise("RURAL").alias("Mediu loc. unitate"), number.alias("Cod SIIIR unitate"), number.alias("Cod SIIIR PJ"), F.expr(_LEGAL).alias("Statut unitate"),
        F.concat(F.lit("Școala "), F.col("train_id").cast("string")).alias("Denumire PJ"), F.when(F.col("train_id") % 5 > 0, F.concat(F.lit("Liceul "), F.col("train_id").cast("string"))).alias("Denumire lunga unitate"),
        F.col("train_number").alias("Denumire scurta unitate"), F.lit("Publică").alias("Forma proprietate"),
    )
    enrolment = tt.select(F.expr("cast(train_id div 2 as string)").alias("Cod unitate PJ"), F.substring("arrival_time", 1, 2).alias("Elevi exist anterior-asoc"), F.col("day_type").alias("Nivel"))
    made = relational.school_tables(network, enrolment, "o")["schools"]
    big = lambda c: F.col(c).cast("long").alias(c)
    return made.select(big("school_id"), "school_name", "short_name", "siiir_code", big("locality_id"), "unit_type", "education_level", big("number_of_students"))


@query("""WITH k AS (SELECT train_id AS o, row_number() OVER (ORDER BY train_id) AS train_id, (train_id * 37) % 400 AS mask FROM trains WHERE coalesce(train_number, '') <> ''),
a AS (SELECT k.o, k.train_id, tt.timetable_id AS place, coalesce(CAST(s.station_number AS VARCHAR), '') AS code, upper(trim(s.station_name)) AS name, tt.timetable_id * 61 AS s, CASE WHEN tt.timetable_id % 5 = 0 THEN tt.timetable_id % 400 ELSE k.mask END % 128 AS m
 FROM timetables tt JOIN stations s ON s.station_id = tt.station_id JOIN k ON k.o = tt.train_id WHERE trim(coalesce(s.station_name, '')) <> ''),
st AS (SELECT code, name, row_number() OVER (ORDER BY min((o, place))) AS station_id FROM a GROUP BY 1, 2)
SELECT CAST(row_number() OVER (ORDER BY a.o, a.place) AS BIGINT) AS timetable_id, CAST(a.train_id AS BIGINT) AS train_id, CAST(st.station_id AS BIGINT) AS station_id,
lpad(CAST((s // 3600) % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') AS arrival_time,
CASE m WHEN 127 THEN 'Zilnic' WHEN 31 THEN 'Luni - Vineri' WHEN 96 THEN 'Sâmbătă - Duminică' WHEN 63 THEN 'Luni - Sâmbătă' WHEN 95 THEN 'Luni - Vineri și Duminică' WHEN 0 THEN 'Zilnic'
ELSE array_to_string(list_filter(['Luni', 'Marți', 'Miercuri', 'Joi', 'Vineri', 'Sâmbătă', 'Duminică'], lambda d, i: (CAST(m AS INTEGER) >> (i - 1)) & 1 = 1), ', ') END AS day_type
FROM a JOIN st ON st.code = a.code AND st.name = a.name""")
def rail_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rail plan over train elements nested as a timetable XML gives them, made of the rail tables."""
    t, tt, s = (table(spark, sf_dir, n) for n in ("trains", "timetables", "stations"))
    none = F.lit(None).cast("string")
    stop = F.struct(
        F.col("station_number").cast("string").alias("_CodStaDest"), F.col("station_name").alias("_DenStaDestinatie"), F.expr("cast(timetable_id * 61 as string)").alias("_OraS"), F.expr("cast(timetable_id * 61 + 120 as string)").alias("_OraP"),
        F.col("service_category").alias("_Rci"), F.struct(F.when(F.col("timetable_id") % 5 == 0, (F.col("timetable_id") % 400).cast("string")).alias("_Zile")).alias("CalendarTren"),
    )
    stops = tt.join(F.broadcast(s) if s.count() <= 200_000 else s, "station_id").select("train_id", F.col("timetable_id").alias("place"), stop.alias("x"))
    rows = stops.select(F.col("train_id").alias("train_order"), "place", F.col("x._CodStaDest").alias("code"), F.col("x._DenStaDestinatie").alias("station"), F.col("x._OraS").alias("seconds_in"), F.col("x._OraP").alias("seconds_out"), F.col("x._Rci").alias("kind"), F.col("x.CalendarTren._Zile").alias("mask"))
    trains = t.select(F.col("train_id").alias("train_order"), F.col("train_number").alias("number"), F.col("operator_name").alias("operator"), "category", F.coalesce(F.expr("cast((train_id * 37) % 400 as string)"), none).alias("mask"))
    made = relational.rail_tables(trains, rows)["timetables"]
    big = lambda c: F.col(c).cast("long").alias(c)
    return made.select(big("timetable_id"), big("train_id"), big("station_id"), "arrival_time", "day_type")


_LITERAL = "coalesce('''' || replace({0}, '''', '''''') || '''', 'NULL')"


@query(f"""WITH r AS (SELECT row_number() OVER (ORDER BY station_id) AS n, '(' || station_id || ', ' || station_number || ', ' || {_LITERAL.format('station_name')} || ', ' || {_LITERAL.format('county')} || ')' AS v FROM stations)
SELECT CAST((n - 1) // 500 AS BIGINT) AS batch, md5('INSERT INTO stations (station_id, station_number, station_name, county) VALUES' || chr(10) || string_agg(v, ',' || chr(10) ORDER BY n) || ';') AS h FROM r GROUP BY 1""")
def insert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-row INSERT statements of 500 rows."""
    values = [(c, F.col(c).cast("string")) for c in ("station_id", "station_number")] + [(c, T.literal(F.col(c))) for c in ("station_name", "county")]
    return insert_statements(table(spark, sf_dir, "stations"), "stations", ["station_id"], values).select("batch", F.md5("statement").alias("h"))


@query("SELECT CAST(s AS INTEGER) AS shard, CAST(count(*) AS BIGINT) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM (SELECT doc_id, doc_id % 4 AS s FROM documents) GROUP BY s")
def shard_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards merged in the order of their index, with row counts."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    merged = sampling.merged_shards([(i, d.where(F.col("doc_id") % 4 == i)) for i in (2, 0, 3, 1)])
    return merged.groupBy("shard").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query(f"""WITH a AS (SELECT id, source_dataset, {_sql_strip("coalesce(instruction, '')")} AS i, {_RAW} AS o, {_sql_strip("coalesce(system_prompt, '')")} AS s FROM queries_alpaca_ro)
SELECT id, md5(i) AS instruction, md5(o) AS output, CASE WHEN s = '' THEN 'Răspunde cu SQL.' ELSE s END AS system, source_dataset FROM a WHERE i <> '' AND o <> ''""")
def sft_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised training records."""
    r = exports.sft(table(spark, sf_dir, "queries_alpaca_ro"), F.col("source_dataset"), "Răspunde cu SQL.", system="system_prompt")
    return r.select("id", F.md5("instruction").alias("instruction"), F.md5("output").alias("output"), "system", "source_dataset")


@query(f"""SELECT coalesce(source_dataset, 'all') AS source, CAST(count(*) AS BIGINT) AS read, CAST(count(*) FILTER (w) AS BIGINT) AS written, CAST(count(*) FILTER (NOT w) AS BIGINT) AS dropped
FROM (SELECT source_dataset, {_sql_strip("coalesce(instruction, '')")} <> '' AND {_RAW} <> '' AS w FROM queries_alpaca_ro) GROUP BY ROLLUP (source_dataset)""")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, written and dropped by source, and their total."""
    w = (T.strip(F.coalesce("instruction", F.lit(""))) != "") & (T.strip(F.coalesce("output", F.lit(""))) != "")
    return file_counts(table(spark, sf_dir, "queries_alpaca_ro").withColumn("w", w), "source_dataset", "w")


_ASKED = {k: "'" + parts[0].replace("'", "''") + "' || db_id || '" + parts[1].replace("'", "''") + "'" for k, parts in (("operator", exports.ASK_OPERATOR), ("user", exports.ASK_USER))}
_ASK = f"CASE WHEN task = 'operator' THEN {_ASKED['operator']} ELSE {_ASKED['user']} END"


@query(f"""SELECT id, task, {_ASK} AS instruction, md5('Task: ' || coalesce(task, 'null') || chr(10) || 'Romanian question: ' || coalesce(question_ro, 'null') || chr(10) || 'English question: ' || coalesce(question_en, 'null')) AS input, md5(sql) AS output, difficulty FROM generated_example""")
def alpaca_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, K3: records in instruction form."""
    a = exports.alpaca(exports.master(table(spark, sf_dir, "generated_example")))
    return a.select("id", "task", "instruction", F.md5("input").alias("input"), F.md5("output").alias("output"), "metadata.difficulty")


@query(f"""SELECT id, unnest(['system', 'user', 'assistant']) AS role, unnest([CASE WHEN task = 'operator' THEN '{exports.SYSTEM_OPERATOR}' ELSE '{exports.SYSTEM_USER}' END,
md5('Task: ' || coalesce(task, 'null') || chr(10) || 'Database: ' || db_id || chr(10) || 'Question (RO): ' || question_ro || chr(10) || 'Question (EN): ' || question_en), md5(sql)]) AS content FROM generated_example""")
def chat_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: records as chat turns."""
    c = exports.chat(table(spark, sf_dir, "generated_example")).select("id", F.explode("messages").alias("m"))
    return c.select("id", "m.role", F.when(F.col("m.role") == "system", F.col("m.content")).otherwise(F.md5("m.content")).alias("content"))


_SAMPLE = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY md5('42:' || id), id) AS r, count(*) OVER (PARTITION BY t) AS n FROM (SELECT id, coalesce(task, 'user') = 'operator' AS t FROM queries_alpaca_ro))
SELECT id, CASE WHEN t THEN 'operators' ELSE 'queries' END AS track FROM r WHERE """


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    q = table(spark, sf_dir, "queries_alpaca_ro").select("id", (F.coalesce("task", F.lit("user")) == "operator").alias("t"))
    return evaluation_split(q.where("not t"), q.where("t"), "id", 0.2)


@query(_SAMPLE + "r <= greatest(1, CAST(floor(n * 0.2) AS BIGINT))")
def eval_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact seeded samples of both tracks."""
    return _split(spark, sf_dir)[0].select("id", "track")


@query(_SAMPLE + "r > greatest(1, CAST(floor(n * 0.2) AS BIGINT))")
def train_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that no sample has."""
    return _split(spark, sf_dir)[1].select("id", "track")


@query("SELECT CAST(row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS BIGINT) AS place, doc_id FROM documents")
def seeded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded order."""
    return sampling.shuffled(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 7)


@query("""WITH a AS (SELECT id, 0 AS part, (row_number() OVER (ORDER BY md5('42:' || id), id) - 0.5) / CAST(0.8 AS DOUBLE) AS x FROM queries_alpaca_ro WHERE coalesce(task, 'user') <> 'operator'),
b AS (SELECT id, 1 AS part, (row_number() OVER (ORDER BY md5('43:' || id), id) - 0.5) / (1 - CAST(0.8 AS DOUBLE)) AS x FROM queries_alpaca_ro WHERE coalesce(task, 'user') = 'operator'), u AS (SELECT * FROM a UNION ALL SELECT * FROM b),
e AS (SELECT min(m) AS e FROM (SELECT max(x) AS m FROM u GROUP BY part)) SELECT id, part, x <= e AS used FROM u, e""")
def interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables interleaved 0.8 to 0.2 until one is used up."""
    q = table(spark, sf_dir, "queries_alpaca_ro").select("id", (F.coalesce("task", F.lit("user")) == "operator").alias("t"))
    return sampling.interleaved(q.where("not t").select("id"), q.where("t").select("id"), "id", 0.8).select("id", "part", "used")


@query(f"""SELECT id, md5('Domain: ' || domain || chr(10) || 'English question:' || chr(10) || question_en) AS translation,
md5(CASE WHEN {_sql_normal("coalesce(task, '')")} IN ('operator', 'operators') THEN 'operator' ELSE 'user' END) AS task FROM generated_example""")
def translation_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts for translation."""
    return table(spark, sf_dir, "generated_example").select("id", F.md5(prompts.translation_prompt(F.col("question_en"), F.col("domain"))).alias("translation"), F.md5(T.task(F.col("task"))).alias("task"))


def _hint(t: str, c: str, n: int) -> str:
    return f"SELECT '{t}.{c}' AS key, array_to_string(list_sort(list(v)), '|') AS vals FROM (SELECT trim({c}) AS v FROM (SELECT DISTINCT {c} FROM {t} WHERE {c} IS NOT NULL ORDER BY {c} LIMIT {n}) WHERE trim({c}) <> '')"


@query(" UNION ALL ".join(_hint(*x) for x in introspect.DISTINCT["trains"]) + """ UNION ALL SELECT 'stations.top_station_names', string_agg(station_name, '|' ORDER BY n DESC, station_name) FROM (SELECT s.station_id, s.station_name, count(*) AS n
FROM timetables t JOIN stations s ON s.station_id = t.station_id GROUP BY s.station_id, s.station_name ORDER BY n DESC, station_name ASC NULLS FIRST, station_id LIMIT 20) WHERE station_name IS NOT NULL""")
def hint_presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1-O3: the value hints of the rail domain."""
    tables = {n: table(spark, sf_dir, n) for n in ("stations", "trains", "timetables")}
    return introspect.hints(tables, "trains").select("key", F.array_join("values", "|").alias("vals"))


@query()
def generation_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation and repair prompts of every record, with the schema text of the rail tables."""
    names = ["stations", "timetables", "trains"]
    tables = spark.createDataFrame([(n, table(spark, sf_dir, n).columns) for n in names], "name string, columns array<string>")
    hints = stats.distinct_values(table(spark, sf_dir, "timetables"), "day_type", 20).agg(F.array_sort(F.collect_list("value")).alias("values")).select(F.lit("timetables.day_type").alias("key"), "values")
    schema = prompts.schema_text(tables, hints, "trains", "rail_mers_tren", 12)
    g = table(spark, sf_dir, "generated_example").withColumn("text", F.lit(schema.first().text))
    made = prompts.generation_prompt(F.col("domain"), F.col("task"), F.col("difficulty"), F.lit(1), F.lit(True), F.col("validation_flags"), F.col("text"))
    fixed = prompts.repair_prompt(F.col("domain"), F.coalesce("task", F.lit("user")), F.col("question_en"), F.col("sql"), F.col("difficulty"), F.coalesce("notes", F.lit("duplicate")), F.lit(1), F.lit(True), F.col("text"))
    return g.select("id", made.alias("generation"), fixed.alias("repair"))


@query("""SELECT name, array_to_string(cols, ', ') AS columns FROM (VALUES ('counties', ['county_id', 'county_code', 'county_name']), ('stations', ['station_id', 'station_number', 'station_name', 'county']),
('trains', ['train_id', 'train_number', 'operator_name', 'category'])) t(name, cols)""")
def table_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session's tables and their columns."""
    names = ["counties", "stations", "trains"]
    for n in [*names, "sqlite_stat"]:
        table(spark, sf_dir, "stations" if n.startswith("sqlite") else n).createOrReplaceTempView(n)
    return spark.createDataFrame([(n, ", ".join(c)) for n, c in catalog(spark, [*names, "sqlite_stat"]).items()], "name string, columns string")


@query("""WITH a AS (SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, sum(l_linenumber) AS lines FROM lineitem GROUP BY ALL)
SELECT CAST(count(*) AS BIGINT) AS n, true AS same, CAST(sum(n) AS BIGINT) AS items FROM a""")
def result_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ways to one result have one signature."""
    li = table(spark, sf_dir, "lineitem")
    one = li.groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))
    fine = li.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("c"))
    two = fine.groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("l_linenumber")).alias("lines"))
    a, b, items = evaluation.signature_of(one), evaluation.signature_of(two), one.agg(F.count("*").alias("n"), F.sum("n").alias("items"))
    return a.join(b.select("n", F.col("signature").alias("other")), "n").join(items, "n").select("n", (F.col("signature") == F.col("other")).alias("same"), "items")


_TOY = "CREATE TABLE t (a INTEGER, b TEXT); INSERT INTO t VALUES (1, 'x'), (2, 'y'), (3, 'y');"
_ID = "ascii(substring(md5(id), 1, 1))"
_GOLD = f"CASE WHEN {_ID} % 5 = 0 THEN 'SELECT b, count(*) AS n FROM t GROUP BY b' WHEN {_ID} % 5 = 1 THEN 'UPDATE t SET a = a + 1 WHERE a > 1' WHEN {_ID} % 5 = 2 THEN 'SELECT nope FROM t' WHEN {_ID} % 5 = 3 THEN '' ELSE 'SELECT a FROM t ORDER BY a' END"
_GUESS = f"CASE WHEN {_ID} % 5 = 0 THEN 'select count(*) as n, b from t group by b;' WHEN {_ID} % 5 = 1 THEN 'update t set  a = a + 1 where a > 1;' WHEN {_ID} % 5 = 2 THEN 'SELECT 1' ELSE 'SELECT a FROM t WHERE a IN (3, 2, 1)' END"
_VARIANTS = {"guess": _GUESS, "prose": f"CASE WHEN {_ID} % 2 = 0 THEN 'Interogarea este simplă' ELSE gold END", "wrong": "'SELECT a + 1 AS a FROM t'", "broken": "'SELECT a FROM missing'"}


def _alpaca_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the alpaca table with gold statements that run in a small database, as cases."""
    q = table(spark, sf_dir, "queries_alpaca_ro").withColumn("output", F.expr(_GOLD)).withColumnRenamed("system_prompt", "system").withColumn("line_no", F.col("id"))
    return evaluation.cases(q.withColumn("metadata", F.expr("named_struct('domain', case metadata.domain when 'rail' then 'trains' when 'school' then 'education' else metadata.domain end)")), "line_no", "Default")


_STRIPPED = {c: _sql_strip(f"coalesce({c}, '')") for c in ("instruction", "input", "system_prompt")}
_CASES = f"""WITH q AS (SELECT id, {_GOLD} AS gold, CASE lower(CASE metadata.domain WHEN 'rail' THEN 'trains' WHEN 'school' THEN 'education' ELSE metadata.domain END) WHEN 'trains' THEN 'rail_mers_tren' WHEN 'education' THEN 'edu_reteaua_scolara' END AS db,
{_STRIPPED['instruction']} AS i, {_STRIPPED['input']} AS c, {_STRIPPED['system_prompt']} AS s FROM queries_alpaca_ro),
cs AS (SELECT id, gold, db, CASE WHEN s = '' THEN 'Default' ELSE s END AS s, CASE WHEN i <> '' AND c <> '' THEN i || chr(10) || chr(10) || c WHEN i <> '' THEN i ELSE c END AS p FROM q WHERE gold <> '' AND db IS NOT NULL AND (i <> '' OR c <> ''))"""


@query(f"{_CASES} SELECT id AS case_id, db AS db_id, md5(s) AS system_prompt, md5(p) AS user_prompt, gold AS gold_sql FROM cs")
def eval_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation cases of alpaca rows, the database by the domain in their metadata."""
    return _alpaca_cases(spark, sf_dir).select("case_id", "db_id", F.md5("system_prompt").alias("system_prompt"), F.md5("user_prompt").alias("user_prompt"), "gold_sql")


def _alpaca_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _alpaca_cases(spark, sf_dir)
    forms = F.array(*[F.struct(F.lit(v).alias("variant"), F.expr(x.replace("(id)", "(case_id)").replace("gold", "gold_sql")).alias("pred_sql")) for v, x in _VARIANTS.items()])
    predictions = c.select("case_id", F.explode(forms).alias("x")).select("x.variant", "case_id", "x.pred_sql")
    return evaluation.judged(predictions, c, {"rail_mers_tren": _TOY, "edu_reteaua_scolara": _TOY})


# What the small database must answer, told from the statements.
_OUTCOMES = f"""{_CASES}, v AS (SELECT unnest({list(_VARIANTS)}) AS variant),
o AS (SELECT v.variant, cs.id, CASE WHEN gold LIKE '%nope%' THEN 'gold_failed' WHEN v.variant = 'prose' AND {_ID} % 2 = 0 THEN 'bad_prefix' WHEN v.variant = 'prose' THEN 'match'
 WHEN v.variant = 'broken' THEN 'failed' WHEN v.variant = 'wrong' THEN 'mismatch' WHEN gold LIKE 'SELECT b%' THEN 'mismatch' ELSE 'match' END AS outcome,
 CASE WHEN v.variant = 'prose' AND {_ID} % 2 = 1 THEN true WHEN v.variant = 'guess' AND gold LIKE 'UPDATE%' THEN true ELSE false END AS same FROM cs, v),
m AS (SELECT variant, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (outcome = 'gold_failed') AS BIGINT) AS gold_failures, CAST(0 AS BIGINT) AS generation_errors, CAST(count(*) FILTER (outcome <> 'gold_failed') AS BIGINT) AS generated,
 CAST(count(*) FILTER (outcome = 'bad_prefix') AS BIGINT) AS prefix_failures, CAST(count(*) FILTER (outcome IN ('match', 'mismatch')) AS BIGINT) AS executed,
 CAST(count(*) FILTER (same AND outcome NOT IN ('gold_failed', 'bad_prefix')) AS BIGINT) AS exact_matches, CAST(count(*) FILTER (outcome = 'match') AS BIGINT) AS exec_matches FROM o GROUP BY variant),
r AS (SELECT *, executed / greatest(1, total - gold_failures) AS executed_rate, exact_matches / greatest(1, total - gold_failures) AS exact_rate, exec_matches / greatest(1, total - gold_failures) AS match_rate FROM m)"""


@query(_OUTCOMES + " SELECT * FROM r")
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements of four variants run against the cases' gold in SQLite, counted by variant."""
    return evaluation.metrics(_alpaca_outcomes(spark, sf_dir))


@query(_OUTCOMES + """, h AS (SELECT variant, match_rate AS l, exact_rate AS r FROM r)
SELECT v.variant, coalesce(l, 0.0) AS left_rate, coalesce(r, 0.0) AS right_rate, printf('%.2f', coalesce(l, 0.0) * 100) || '%' AS left_text, CASE WHEN coalesce(r, 0.0) - coalesce(l, 0.0) >= 0 THEN '+' ELSE '' END || printf('%.2f', (coalesce(r, 0.0) - coalesce(l, 0.0)) * 100) || 'pp' AS delta_text
FROM (VALUES ('guess'), ('prose'), ('broken'), ('none')) v(variant) LEFT JOIN h ON h.variant = v.variant""")
def compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rates of judged statements side by side for listed variants."""
    got = cut(evaluation.metrics(_alpaca_outcomes(spark, sf_dir)))
    listed = spark.createDataFrame([(x,) for x in ("guess", "prose", "broken", "none")], "variant string")
    out = evaluation.compared(listed, got.select("variant", F.col("match_rate").alias("rate")), got.select("variant", F.col("exact_rate").alias("rate")), "rate")
    return out.select("variant", "left_rate", "right_rate", "left_text", "delta_text")


_LINE = """CASE ascii(substring(md5(id), 2, 1)) % 6 WHEN 0 THEN '  ' WHEN 1 THEN substring(j, 1, 20) WHEN 2 THEN replace(j, '"system":', '"sistem":') WHEN 3 THEN replace(j, '"metadata":{', '"metadata":1,"rest":{') ELSE j END"""


@query(f"""WITH d AS (SELECT id, ascii(substring(md5(id), 2, 1)) % 6 AS k, coalesce(output, 'None') AS o, input FROM queries_alpaca_ro WHERE instruction IS NOT NULL),
w AS (SELECT *, {_sql_strip('o')} AS s FROM d),
x AS (SELECT CASE k WHEN 0 THEN 'empty_line' WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'missing_key:system' WHEN 3 THEN 'metadata_not_object' ELSE CASE WHEN s = '' THEN 'empty_output_sql' WHEN upper(regexp_extract(s, '^[\\p{{L}}_]+')) NOT IN ('SELECT', 'WITH') THEN 'sql_keyword_not_allowed'
 WHEN strpos(coalesce(input, ''), 'Schema / context SQL:' || chr(10)) = 0 OR strpos(substring(input, strpos(input, 'Schema / context SQL:' || chr(10)) + 22), chr(10) || chr(10)) = 0 THEN 'input_parse_failed' ELSE 'kept' END END AS reason FROM w)
SELECT reason, CAST(count(*) AS BIGINT) AS n FROM x GROUP BY reason""")
def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of the alpaca rows, some blank, broken, without a key or without metadata, through the cleaner."""
    q = table(spark, sf_dir, "queries_alpaca_ro").where("instruction is not null")
    j = F.to_json(F.struct("instruction", "input", "output", F.col("system_prompt").alias("system"), F.struct(F.lit(1).alias("n")).alias("metadata")), {"ignoreNullFields": "false"})
    lines = q.select(F.lit("f").alias("file"), F.col("id").alias("line_no"), "id", j.alias("j")).select("file", "line_no", F.expr(_LINE).alias("value"))
    out = files.cleaned_lines(lines, "queries", strict_type=True, run_sql=False)
    bucket = F.col("drop_reason")
    reason = F.when(bucket.isNull(), "kept").when(bucket.startswith("missing_key"), bucket).otherwise(T.reason_bucket(bucket))
    return out.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(f"""SELECT CAST(count(*) AS BIGINT) AS read, CAST(count(*) FILTER (w) AS BIGINT) AS written FROM (SELECT {_sql_strip("coalesce(instruction, 'None')")} <> '' AND {_OUT} <> '' AS w FROM queries_alpaca_ro)""")
def prepared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of the alpaca rows as training records with their metadata."""
    q = table(spark, sf_dir, "queries_alpaca_ro")
    j = F.to_json(F.struct("id", "task", "instruction", "input", "output", F.col("system_prompt").alias("system"), "metadata"), {"ignoreNullFields": "false"})
    return files.training_lines(q.select(j.alias("value")), "external_queries").agg(F.count("*").alias("read"), F.count_if("written").alias("written"))


_RAIL = """CREATE TABLE stations (station_id INTEGER PRIMARY KEY, station_number INTEGER, station_name VARCHAR(100), county VARCHAR(60));
CREATE TABLE trains (train_id INTEGER PRIMARY KEY, train_number VARCHAR(20), operator_name VARCHAR(80), category VARCHAR(10));
CREATE TABLE timetables (timetable_id INTEGER PRIMARY KEY, train_id INTEGER, station_id INTEGER, arrival_time VARCHAR(10), departure_time VARCHAR(10), service_category VARCHAR(50), day_type VARCHAR(200));
INSERT INTO stations VALUES (1, 10, 'Gara Nord', 'Arnava'); INSERT INTO trains VALUES (1, '2609', '74', 'R'); INSERT INTO timetables VALUES (1, 1, 1, '10:00', '09:50', 'R', 'Zilnic');"""
_SCHOOL = """CREATE TABLE counties (county_id INTEGER PRIMARY KEY, county_code TEXT UNIQUE, county_name TEXT);
CREATE TABLE localities (locality_id INTEGER PRIMARY KEY, locality_name TEXT, residency_area TEXT, county_id INTEGER);
CREATE TABLE schools (school_id INTEGER PRIMARY KEY, school_name TEXT, short_name TEXT, siiir_code TEXT UNIQUE, locality_id INTEGER, ownership_type TEXT, unit_type TEXT, education_level TEXT, number_of_students INTEGER);"""


@query()
def sandbox_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every generated statement run in SQLite over its domain's schema, by status.  The
    databases have a row or none, so most queries that run count as empty results (F11)."""
    g = table(spark, sf_dir, "generated_example").select("id", "db_id", "sql", "task")
    out = cleaning.validated(g, {"mers_tren": _RAIL, "retea_scolara": _SCHOOL})
    return out.groupBy("db_id", "status").agg(F.count("*").alias("n"))


@query()
def eval_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored statements (as they are, in lower case, and limited to no row) run against themselves as gold, by variant.  Over the
    sandbox's few rows."""
    g = table(spark, sf_dir, "generated_example")
    gold = g.select(F.col("id").alias("case_id"), "db_id", F.col("sql").alias("gold_sql"), F.col("id").alias("source_line"))
    none = F.concat(F.lit("SELECT * FROM ("), F.regexp_replace("sql", r"[;\s]+$", ""), F.lit("\n) LIMIT 0"))
    forms = F.array(*[F.struct(F.lit(v).alias("variant"), x.alias("pred_sql")) for v, x in (("stored", F.col("sql")), ("lower", F.lower("sql")), ("none", none))])
    predictions = g.select(F.col("id").alias("case_id"), F.explode(forms).alias("x")).select("x.variant", "case_id", "x.pred_sql")
    return evaluation.metrics(evaluation.judged(predictions, gold, {"mers_tren": _RAIL, "retea_scolara": _SCHOOL}))


@query()
def sandbox_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every output run after its own context script; counts of the errors' first words."""
    q = table(spark, sf_dir, "queries_alpaca_ro").select("id", T.input_parts(F.col("input"))["context"].alias("context"), T.extract_statement(F.col("output")).alias("sql"))
    out = valid_in_context(q.where("context is not null"), "context", "sql")
    return out.groupBy(F.coalesce(F.substring_index("error", ":", 1), F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n"))


@query("""SELECT id, loaded_at > created_at + INTERVAL 7 DAY AS late FROM generated_example""")
def late_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded more than a week after they were made."""
    return table(spark, sf_dir, "generated_example").select("id", is_late("created_at", "loaded_at").alias("late"))


@query("SELECT date_trunc('day', created_at) AS start, source, CAST(count(*) AS BIGINT) AS n FROM generated_example GROUP BY ALL")
def window_counts_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by day and source (the streaming operator over a batch table)."""
    return window_counts(table(spark, sf_dir, "generated_example"), "created_at", ["source"])


@query("SELECT CAST(count(DISTINCT coalesce(sql, '')) AS BIGINT) AS n FROM generated_example")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on a stream: the table's files read as a stream, first-seen filter with a watermark that no row is later than, written and counted."""
    schema = table(spark, sf_dir, "generated_example").select("created_at", "sql").schema
    files_of = spark.readStream.schema(schema).parquet(f"{sf_dir}/generated_example.parque[t]")
    kept = first_seen(files_of.select(F.col("created_at").cast("timestamp").alias("created_at"), F.coalesce("sql", F.lit("")).alias("sql")), F.col("sql"), "created_at", "36500 days")
    folder = f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    run = kept.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{folder}/rows").agg(F.count("*").alias("n"))


# Statements that any SELECT may contain, run natively.


def _native(name: str, tables: list[str], sql: str, oracle: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = sql
        for t in tables:
            view = f"{name}_{t}"
            table(spark, sf_dir, t).createOrReplaceTempView(view)
            text = text.replace("{" + t + "}", view)
        return spark.sql(text)

    run.__name__ = name
    QUERIES[name] = run
    ORACLE[name] = oracle or sql.replace("{", "").replace("}", "")


_native("sql_filter_project", ["orders"], "WITH o AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band FROM {orders} WHERE o_orderpriority LIKE '1%') SELECT * FROM o WHERE o_orderstatus <> 'P'")
_native("sql_star_join", ["lineitem", "orders", "customer", "nation"], "SELECT n.n_name, CAST(count(*) AS BIGINT) AS items, CAST(sum(l.l_linenumber) AS BIGINT) AS lines FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey JOIN {customer} c ON c.c_custkey = o.o_custkey LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey GROUP BY n.n_name")
_native("sql_range_join", ["part"], "SELECT b.name, CAST(count(*) AS BIGINT) AS n FROM {part} p JOIN (VALUES ('small', 1, 15), ('mid', 16, 35), ('large', 36, 50)) b(name, lo, hi) ON p.p_size BETWEEN b.lo AND b.hi GROUP BY b.name")
_native("sql_semi_anti", ["customer", "orders"], "SELECT 'with' AS kind, CAST(count(*) AS BIGINT) AS n FROM {customer} c WHERE EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey) UNION ALL SELECT 'without', CAST(count(*) AS BIGINT) FROM {customer} c WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey)")
_native("sql_group_having", ["lineitem"], "SELECT l_suppkey, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts FROM {lineitem} GROUP BY l_suppkey HAVING count(*) > 10")
_native("sql_string_agg", ["nation", "region"], "SELECT r.r_name, listagg(n.n_name, ', ') WITHIN GROUP (ORDER BY n.n_name) AS nations FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey GROUP BY r.r_name", "SELECT r.r_name, string_agg(n.n_name, ', ' ORDER BY n.n_name) AS nations FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY r.r_name")
_native("sql_window_rank", ["orders"], "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS n, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS BIGINT) AS p FROM {orders}")
_native("sql_running_sum", ["lineitem"], "SELECT l_orderkey, l_linenumber, CAST(sum(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem})")
_native("sql_set_ops", ["customer", "supplier"], "SELECT 'union' AS op, CAST(count(*) AS BIGINT) AS n FROM (SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier}) UNION ALL SELECT 'intersect', CAST(count(*) AS BIGINT) FROM (SELECT c_nationkey AS k FROM {customer} INTERSECT SELECT s_nationkey FROM {supplier}) UNION ALL SELECT 'except', CAST(count(*) AS BIGINT) FROM (SELECT c_custkey AS k FROM {customer} EXCEPT SELECT s_suppkey FROM {supplier})")
_native("sql_topk", ["orders"], "SELECT o_orderkey, o_custkey FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 5")
_native("sql_scalar_subquery", ["customer"], "SELECT c_custkey FROM {customer} c WHERE c_acctbal > (SELECT avg(c_acctbal) FROM {customer} x WHERE x.c_nationkey = c.c_nationkey)")
_native("sql_grouping_sets", ["lineitem"], "SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)")
_native("sql_json", ["events"], "SELECT event_type, CAST(sum(CAST(get_json_object(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM {events} GROUP BY event_type", "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY event_type")
_native("sql_text_date", ["events"], "SELECT upper(substring(event_type, 1, 3)) AS kind, year(ts) AS y, CAST(count(*) AS BIGINT) AS n FROM {events} GROUP BY ALL", "SELECT upper(substring(event_type, 1, 3)) AS kind, CAST(year(ts) AS INTEGER) AS y, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL")
