import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tezaur.llm import tokenizer as T

pytestmark = pytest.mark.skipif(not os.path.exists(T.VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def ranks():
    return T.read_ranks()


@pytest.fixture(scope="module")
def known(ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text(st.sampled_from("aăeșț 's12\n<|>"), max_size=80))
def test_equal_to_public(ranks, known, text):
    assert T.Encoder(ranks)(text) == known(text)


def test_long_pre_token(ranks, known):
    text = "abcăîab" * 3000 + "=" * 5000
    assert T.Encoder(ranks)(text) == known(text)


def test_library(ranks):
    import tokenizers

    t = tokenizers.Tokenizer.from_file(T.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    for text in ("<|endoftext|>", "Nu știu voi, dar  \n\n mulțumesc!", " \t 12 ab", "don't we'LL"):
        assert T.Encoder(ranks)(text) == t.encode(text, add_special_tokens=False).ids


def test_column(spark, known):
    texts = [None, "", " ", "Trenul 8984 nu mai oprește", "<|endoftext|>", "x" * 100000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "i int, text string, token int")
    got = T.encode_corpus(df)
    assert got.columns == ["i", "text", "token", "ids"]
    assert [r.ids for r in got.orderBy("i").collect()] == [known(t) if t else [] for t in texts]
    assert T.encode_corpus(df.limit(0)).count() == 0
