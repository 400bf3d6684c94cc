import glob
import os

import pytest

import __spark_entry__ as entry
from tezaur import queries as core


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def rows(records, columns):
    def text(x):
        return "null" if x is None else f"{x:.9g}" if isinstance(x, float) else str(x)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", list(core.ORACLE))
def test_equal_to_sql(spark, sf_dir, duck, name):
    df = core.QUERIES[name](spark, sf_dir)
    got = duck.execute(core.ORACLE[name])
    columns = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(got.fetchall(), columns)


@pytest.mark.parametrize("name", [n for n in core.QUERIES if n not in core.ORACLE])
def test_runs(spark, sf_dir, name):
    assert core.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_records_equal_a_greedy_loop(spark, duck, sf_dir):
    normal = lambda x: None if x is None else " ".join(x.split()).lower()
    statements, questions, want = set(), set(), []
    for i, sql, question in duck.execute("SELECT id, sql, question_en FROM generated_example ORDER BY id").fetchall():
        a, b = normal(sql), normal(question)
        if a not in statements and b not in questions:
            want.append(i)
            statements.add(a)
            questions.add(b)
    total = duck.execute("SELECT count(*) FROM generated_example").fetchone()[0]
    got = sorted(r.id for r in core.QUERIES["dedup_two_keys"](spark, sf_dir).collect())
    assert got == want and total / 2 < len(got) < total


def test_judged_statements(spark, sf_dir, duck):
    total = duck.execute("SELECT count(*) FROM generated_example").fetchone()[0]
    got = {r.variant: r for r in core.QUERIES["eval_judged"](spark, sf_dir).collect()}
    stored = got["stored"]
    assert set(got) == {"stored", "lower", "none"} and all(r.total == total and r.gold_failures == stored.gold_failures for r in got.values())
    assert 0 < stored.gold_failures < total and stored.exec_matches == stored.exact_matches == total - stored.gold_failures
    assert 0 < got["none"].exec_matches < got["none"].executed and got["none"].exact_matches == 0
