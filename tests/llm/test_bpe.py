import hashlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from support import HAVE_TABLES, SF, clashing, documents, rows

from marquee.llm import bpe, codec
from marquee.llm.queries import QUERIES

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PIECES = st.lists(st.sampled_from([
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "The", "don't", "'s", "'", "é", "é", "漢字", "😀", "👩‍👩‍👧", "1", "42", ".", ",", "...",
    "!?", "<|endoftext|>", "<|startoftext|>", "<|endo", "ftext|>", " ", "　", "\x1c", "\x85", "İ", "Σ", "ſ", "ẘ", "W̊",
    "naïve", "ünd", "É", "é.", "×", "×,", "÷.", "ª", "µ", "ß,", "hello world", "aaaaaaaa", "====", "     ", "​", "ﬁ",
]), max_size=40).map("".join)


@cache
def made(name):
    return codec.Codec(codec.read_spec(public_tokenizers.path(name)))


def sha(data):
    return hashlib.sha256(data).hexdigest()


def by_hand(docs):
    out, c = [], made(FILES[0])
    for i, text in docs:
        ids = c.tokenizer.encode(text or "", add_special_tokens=False).ids
        back = c.tokenizer.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(back.encode())))
    return sorted(out, key=str)


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=4))
def test_units_give_the_library_ids(name, texts):
    c = made(name)
    for text, ids in zip(texts, c.encode(pa.array(texts, pa.string()))):
        assert np.frombuffer(ids, "<u4").tolist() == c.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(PIECES, st.integers(1, 7), st.integers(0, 3))
def test_joined_parts_give_the_library_ids(text, size, times):
    c, text = made(FILES[0]), text * (3**times)
    size = max(size, len(text) // 40)
    parts = [c.plain(text[i : i + size]) for i in range(0, len(text), size)]
    assert bpe.join_all(parts, c).tolist() == c.plain(text).tolist()


@pytest.mark.parametrize("text", [
    "x" * 5_000, "ab" * 3_000, " " * 3_000, "\n" * 2_500, "=-" * 2_000, "1" * 3_001, "é" * 2_000, "漢字" * 1_000, "'s" * 1_500,
    "<|endoftext|>" * 300, "the quick brown fox " * 300, "a\n\n  b" * 700,
    "".join(np.random.default_rng(7).choice(list("abcdefghij "), 6_000)), "".join(np.random.default_rng(8).choice(list("thein"), 6_000)),
])
@pytest.mark.parametrize("size", [97, 1_000])
def test_long_unsplit_texts(text, size):
    c = made(FILES[0])
    parts = [c.plain(text[i : i + size]) for i in range(0, len(text), size)]
    assert bpe.join_all(parts, c).tolist() == c.plain(text).tolist()


def test_decoding_is_that_of_the_library():
    c = made(FILES[0])
    for ids in ([], [50256], [220, 198], [447, 105], [447], [105, 447], list(range(0, 50257, 7))):
        assert c.decode(np.array(ids, "<u4")).decode("utf-8", "replace") == c.tokenizer.decode(ids, skip_special_tokens=False)


def test_rows(spark):
    long = "".join(np.random.default_rng(9).choice(list("abcde é\n"), 3 * bpe.LEAF + 5))
    docs = [(1, None), (2, ""), (3, "plain"), (3, "plain"), (None, "no id"), (4, long), (5, long), (5, long), (6, "z" * (bpe.LEAF + 1)),
            (7, "<|endoftext|> in a text"), (None, long)]
    result = bpe.digest(documents(spark, docs), codec.read_spec(public_tokenizers.path(FILES[0])))
    assert rows(result) == by_hand(docs)
    assert rows(bpe.digest(clashing(spark, docs), codec.read_spec(public_tokenizers.path(FILES[0])))) == by_hand(docs)


def test_decode_of_stored_ids(spark):
    docs = [(1, "plain"), (2, ""), (3, "é 漢字 <|endoftext|>")]
    sent = spark.sparkContext.broadcast(codec.read_spec(public_tokenizers.path(FILES[0])))
    coded = bpe.encode_short(documents(spark, docs), sent, text="text").selectExpr("doc_id", "coded.ids AS ids")
    assert sorted((r.doc_id, r.decoded) for r in bpe.decode(coded, sent).collect()) == docs


def test_empty_table(spark):
    assert bpe.digest(documents(spark, []), codec.read_spec(public_tokenizers.path(FILES[0]))).collect() == []


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op5_bpe"](spark, SF)) == by_hand(docs)
