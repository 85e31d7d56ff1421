import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ordersight.llm import bpe
from ordersight.llm.queries import op1_byte_bpe

DATA = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, DATA.splitlines())}
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TINY = bpe.ByteBPE(RANKS, P.PATTERN, leaf_chars=3, leaf_bytes=1)
NORMAL = bpe.ByteBPE(RANKS, P.PATTERN)

TEXT = st.one_of(
    st.text(max_size=60),
    st.text(alphabet="ab A'srevl \n\t1.ßé", max_size=80),
    st.lists(st.sampled_from(["the", "'ve", "  ", "\n", "aaaa", "ing", "123", "!!", "日本", "ßt", " "]), max_size=30).map("".join),
)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_tree_equals_library(text):
    want = LIB.encode_ordinary(text)
    for coder in (TINY, NORMAL):
        got = coder.encode(text).tolist()
        assert got == want
        assert coder.decode(got) == text.encode()


@pytest.mark.parametrize("unit", ["a", "aab", "ha", "\n", " ", "é", "=", "a b", "Ab1"])
@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 1000])
def test_long_runs(unit, n):
    text = unit * n
    assert TINY.encode(text).tolist() == LIB.encode_ordinary(text) == NORMAL.encode(text).tolist()


def test_random_bytes_of_one_match():
    import random

    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(17, 200)))
        assert NORMAL.encode(text).tolist() == LIB.encode_ordinary(text)


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, "Hello world", "x"), (2, None, "y"), (3, "", "z"), (None, "tok " * 30_000, None), (1, "Hello world", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, op1_byte_bpe(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, text, _ in rows:
        ids = LIB.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    empty = bpe.encode_documents(df.limit(0), "doc_id", "text", DATA, P.PATTERN)
    assert empty.count() == 0
