import os
from collections import Counter

import numpy as np
import pytest

from tezaur.llm import source_mix as M
from tezaur.llm import tokenizer as T

needs = pytest.mark.skipif(not os.path.exists(T.VOCABULARY), reason="no vocabulary here")


def test_permutation():
    for size in (1, 2, 3, 17, 1000):
        assert sorted(M.permuted(np.arange(size), size, 5).tolist()) == list(range(size))
    assert M.permuted(np.arange(1000), 1000, 5).tolist() != M.permuted(np.arange(1000), 1000, 6).tolist()


def test_permutation_and_its_inverse():
    for size in (1, 2, 7, 1000):
        assert M.permuted(M.permuted(np.arange(size), size, 5), size, 5, back=True).tolist() == list(range(size))


@pytest.mark.parametrize("factor", [1, 10**9])  # one way at any size
def test_split_totals(factor):
    totals = [700 * factor, 250 * factor, 53 * factor]
    split = M.Split(totals, 64 * factor, 16, 1)
    parts = [split(s) for s in range(16)]
    assert sum(c for c, _ in parts).tolist() == totals
    seen = np.zeros(3, int)
    for c, o in parts:
        assert o.tolist() == seen.tolist() and 0 <= c.sum() <= 64 * factor and c.min() >= 0
        seen += c


def test_hypergeometric():
    rng = np.random.default_rng(1)
    got = np.array([M.hypergeometric(30, 70, 20, rng.random()) for _ in range(20_000)])
    want = np.random.default_rng(2).hypergeometric(30, 70, 20, 20_000)
    assert abs(got.mean() - 6) < 0.05 and abs(got.var() - want.var()) < 0.15 and got.min() >= 0 and got.max() <= 20
    assert M.hypergeometric(5, 0, 3, 0.4) == 3 and M.hypergeometric(0, 5, 3, 0.4) == 0 and M.hypergeometric(5, 5, 10, 0.9) == 5
    assert abs(M.hypergeometric(3 * 10**10, 7 * 10**10, 10**10, 0.5) - 3 * 10**9) < 10**6


def test_plan():
    assert M.plan([("a", 0.5, 1, 100), ("b", 0.3, 4, 10), ("c", 0.2, 1, 0)]) == {"a": 67, "b": 40}
    assert M.plan([]) == {}


@needs
def test_mixture(spark):
    docs = [(i, "big" if i < 600 else "mid" if i < 800 else "small", f"textul {i} " * (3 + i % 7)) for i in range(830)]
    docs += [(900, None, "x"), (901, "big", None), (902, "big", ""), (903, "other", "y"), (904, "mid", "lung " * 3000), (600, "mid", "dublură")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, source string, text string, block int")
    goals = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.15, 4), ("gone", 0.05, 3)], "source string, target_share double, max_repeats int")
    mixed = M.mixture(df, goals, block=32, slots=16)
    rows = mixed.collect()
    most = {"big": 1, "mid": 2, "small": 4}
    assert max(Counter((r.source, r.block) for r in rows).values()) <= 4
    for s, m in most.items():
        assert max(Counter((r.source, r.block) for r in rows if r.source == s).values()) <= m
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    ranks = T.read_ranks()
    whole = {(d[0], d[1], tuple(T.Encoder(ranks)(d[2]))) for d in docs}
    for r in rows:
        assert len(r.ids) == sum(p.n for p in r.pieces) <= 32
        at = 0
        for p in r.pieces:
            assert any(w[2][p.start : p.start + p.n] == tuple(r.ids[at : at + p.n]) for w in whole if w[0] == p.id and w[1] == r.source)
            at += p.n
    shares = {r.source: r for r in M.report(mixed, goals).collect()}
    assert shares["gone"].tokens == 0 and all(shares[s].most_copies <= m for s, m in most.items())
    assert all(abs(shares[s].reached_share - shares[s].target_share / 0.95) < 0.02 for s in most)
    assert [tuple(r) for r in M.mixture(df, goals, block=32, slots=16).orderBy("shard", "slot").collect()] == sorted(map(tuple, rows))
    assert M.mixture(df.limit(0), goals).count() == 0


@needs
def test_neither_slots_nor_blocks_are_broadcast(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], f"textul {i} " * 9) for i in range(400)], "doc_id long, source string, text string")
    goals = spark.createDataFrame([("a", 0.6, 2), ("b", 0.4, 1)], "source string, target_share double, max_repeats int")
    mixed = M.mixture(df, goals, block=16, slots=8)
    assert mixed.collect()
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.fixture
def joins_change(spark):
    """Joins are planned by sorting, and those with few rows become broadcasts at run time, as with many documents: no bucket may be cut by then."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "4k"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


@needs
def test_large_ids_over_buckets(spark, monkeypatch, joins_change):
    monkeypatch.setattr(M, "BUCKET", 20)  # several buckets, whose blocks meet at their ends
    first = 2**62  # beyond what a float can hold
    df = spark.createDataFrame([(first + i, "a", f"textul {i} " * (1 + i % 5)) for i in range(150)], "doc_id long, source string, text string")
    goals = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    rows = M.mixture(df, goals, block=16, slots=8).collect()
    encode = T.Encoder(T.read_ranks())
    want = {first + i: encode(f"textul {i} " * (1 + i % 5)) for i in range(150)}
    got: dict[int, dict[int, int]] = {}
    for r in rows:
        at = 0
        for p in r.pieces:
            got.setdefault(p.id, {}).update(zip(range(p.start, p.start + p.n), r.ids[at : at + p.n]))
            at += p.n
    assert {k: [v[i] for i in sorted(v)] for k, v in got.items()} == want
    assert sum(len(r.ids) for r in rows) == sum(map(len, want.values())) and all(len(r.ids) == 16 for r in rows if r.block < len(rows) - 1)
