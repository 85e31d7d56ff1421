import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ordersight.llm import packing
from ordersight.llm.queries import op9_packing

PATH = P.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
CODER = packing.WordTokenizer(open(PATH, "rb").read(), 2)


def _reference(text):
    return [*LIB.encode(text, add_special_tokens=False).ids, 2]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="aBΣσ 's\n\té́\x1c\x85  <|>1½İ", max_size=60)))
def test_ids_equal_library(text):
    assert np.frombuffer(CODER.encode(text), "<u4").tolist() == _reference(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 40), st.integers(1, 20_000)), max_size=60))
def test_block_holds_every_token_once(lengths):
    seen = {i: [] for i in range(len(lengths))}
    packed = packing.pack_block(lengths)
    for window, pieces in packed:
        assert sum(n for _, _, n in pieces) == window <= 4096 and window & (window - 1) == 0
        for doc, start, n in pieces:
            seen[doc].append((start, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, k in sorted(seen[doc]):
            assert start == at and k > 0
            at += k
        assert at == n
    short = [w for w, _ in packed if w < packing.TIERS[0]]
    assert len(short) <= 12


def test_step_groups_are_balanced():
    windows = [4096] * 50 + [512] * 37 + [2048] * 9
    groups = packing.step_groups(windows)
    load = np.bincount(groups, weights=windows)
    assert load.max() - load.min() <= 4096 and load.sum() == sum(windows)


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, "Hello big World", 1), (2, None, 2), (3, "", 3), (None, "x y's " * 9000, None), (1, "Hello big World", 5), (7, "word with odd\x0bspace", 6)]
    spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    got = op9_packing(spark, str(tmp_path)).collect()
    want = {}
    for i, text, _ in rows:
        want.setdefault(i, []).append(_reference(text or ""))
    for i, lists in want.items():
        mine = [r for r in got if r["doc_id"] == i]
        assert sum(r["length"] for r in mine) == sum(map(len, lists))
        for r in mine:
            assert any(r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for ids in lists)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == pieces[0]["window"] <= 4096
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text", open(PATH, "rb").read(), 2).count() == 0


def test_words_are_parted_by_a_mark_none_contains():
    words = ["a|b", "x~y", "^", "{}", "plain", "\\", "`", "é", "`", "̸<"]
    for some in (words, words[:4], [*words, "<>_="]):
        coder = packing.WordTokenizer(open(PATH, "rb").read(), 2)
        assert np.frombuffer(coder.encode(" ".join(some)), "<u4").tolist() == _reference(" ".join(some))


def test_memo_turns_over(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 5)
    coder = packing.WordTokenizer(open(PATH, "rb").read(), 2)
    for i in range(30):
        text = f"w{i} w{i - 1} w{i - 7} common {'long' * 20}"
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == _reference(text)


DEFAULT = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "a", "Bc", " ", "\n", "\xa0", "é"]), max_size=12).map("".join))
def test_added_tokens_equal_the_default_library(text):
    assert np.frombuffer(CODER.encode(text), "<u4").tolist() == [*DEFAULT.encode(text, add_special_tokens=False).ids, 2]


def test_added_tokens_have_their_ids():
    assert np.frombuffer(CODER.encode("a<|endoftext|>b <|startoftext|>"), "<u4").tolist()[1::2] == [49407, 49406]


def test_words_of_plain_letters_need_no_pattern(monkeypatch):
    monkeypatch.setattr(packing, "_PLAIN", None)
    coder = packing.WordTokenizer(open(PATH, "rb").read(), 2)
    text = "Hello big World unheardofword ABC x"
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == _reference(text)
