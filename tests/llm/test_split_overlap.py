import random
from collections import Counter

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from tezaur.llm import split_overlap as S

COMMON = "arată toate stațiile din județul cu numărul trenului între și cel mult rânduri care".split()


def plain(a, b):
    x, y = Counter(S.words(a)), Counter(S.words(b))
    return sum(((x - y) + (y - x)).values())


def test_words():
    assert S.words("Ştiu Ｌｕｎｃａ, „Mаgura” t.train_id=10:30 fi​ﬁ") == ["stiu", "lunca", "magura", "t", "train", "id", "10", "30", "fifi"]
    assert S.words("Μare urΒan") == ["mare", "urban"]  # capitals that only look like Latin ones as such
    assert S.words("Жълтица") == S.words("жълтица") and S.words(None) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=25), st.lists(st.tuples(st.booleans(), st.integers(0, 40)), max_size=5))
def test_an_anchor_is_shared(base, edits):
    y = base[:]
    for drop, w in edits:
        if drop and y:
            y.pop(w % len(y))
        elif not drop:
            y.append(w)
    one, other = (pd.DataFrame({"a": [np.sort(np.array(z, np.int32)).tobytes()], "b": [np.array([], np.int32).tobytes()]}) for z in (base, y))
    counts = np.stack([np.bincount(np.array([*y, 0], np.int64), minlength=S.COUNTERS)] * 2)
    layout = S.Layout(counts, 5)
    assert set(layout.of_evaluation(one)[1].tolist()) & set(layout.of_training(other)[1].tolist())
    x, z = sorted(base), sorted(y)
    d = sum(((Counter(x) - Counter(z)) + (Counter(z) - Counter(x))).values())
    assert S.difference(x, z, 5) == d
    assert sum(m.bit_count() for m in S.matched(x, z)) == sum((Counter(x) & Counter(z)).values())


def data(n=240):
    r = random.Random(3)
    rows = []
    for i in range(n):
        if i and r.random() < 0.6:
            q, s = (list(x.split()) for x in rows[r.randrange(len(rows))][2:4])
            for w in (q, s):
                for _ in range(r.randrange(4)):
                    w[r.randrange(len(w))] = r.choice(COMMON + [str(r.randrange(99))])
                if r.random() < 0.3:
                    r.shuffle(w)
        else:
            q, s = ([*r.choices(COMMON, k=12), *(str(r.randrange(9999)) for _ in range(4))] for _ in range(2))
        rows.append((f"i{i:04d}", r.choice(["train", "train", "test", "validation"]), " ".join(q), " ".join(s), r.choice(["a", "b", None])))
    return rows + [("z1", "train", None, "", "a"), ("z2", "test", "", None, "a"), ("z3", "test", "a b", "c", "a"), ("z4", None, "a", "b", "a")]


def test_against_all_pairs(spark):
    rows = data()
    want = {tuple(sorted((x[0], y[0]))) for x in rows for y in rows if x[1] == "train" and y[1] not in ("train", None) and plain(x[2], y[2]) <= 5 and plain(x[3], y[3]) <= 5}
    df = spark.createDataFrame([(*x, 1) for x in rows], "id string, split string, question_ro string, sql string, source string, field int")
    assert {tuple(x) for x in S.pairs_found(df).collect()} == want and len(want) > 20
    small = S.overlaps(df, "id", ("question_ro", "sql"), "split", shard=20, most_bits=1 << 10, spread=7, group=2)
    assert {tuple(sorted((x.train_id, x.eval_id))) for x in small.collect()} == want
    counts = S.counts_found(df).collect()
    assert sum(x.pairs for x in counts) == len(want) and all(0 < x.coverage <= 1 for x in counts if x.source)
    assert S.pairs_found(df.limit(0)).count() == 0 and S.counts_found(df.limit(0)).count() == 0


def test_short_and_repeated_records(spark):
    rows = [("t1", "train", "a b", "c"), ("t2", "train", "x y z", "q"), ("t2", "train", "x y z", "q"), ("t3", "train", "a b c d e f g h", "c"), ("e1", "test", "d", "c e"), ("e2", "test", None, None), ("e3", "test", "a b c d e", "c")]
    want = {tuple(sorted((x[0], y[0]))) for x in rows for y in rows if x[1] == "train" and y[1] == "test" and plain(x[2], y[2]) <= 5 and plain(x[3], y[3]) <= 5}
    df = spark.createDataFrame(rows, "id string, split string, question_ro string, sql string")
    got = [tuple(x) for x in S.pairs_found(df).collect()]
    assert set(got) == want and len(got) == len(want) > 3
